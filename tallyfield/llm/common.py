"""What several operators of this subpackage share: durable cuts, hashing of words, components."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# White space of a word boundary: space and the six control characters 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))


def shared_folder(spark: SparkSession) -> str:
    """Folder of ``spark.checkpoint.dir``; a temporary one where that is unset and Spark runs on one machine only.

    On a cluster an unset folder is an error: executors would not see each other's files.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="tallyfield-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the shared folder and continue from there: it survives lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Like ``cut``, as a Parquet table: for wide rows of which later passes read few columns."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession, rows: int, per_part: int) -> int:
    """Partitions for ``rows``: as many as needed for ``per_part`` each, no fewer than the session asks for."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_part))


def small(df: DataFrame, most: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most`` rows, else as it is (a shuffled join then)."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def pack(values: np.ndarray) -> bytes:
    """Compressed integers, byte plane by byte plane, so that small ones cost little."""
    import zstandard

    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes, kind) -> np.ndarray:
    import zstandard

    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", _P), ("down", _P_INV)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def release() -> None:
    """Give memory that is free in this Python worker back to the machine: workers live on between tasks and stages."""
    import ctypes

    import pyarrow as pa

    _powers.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc; elsewhere the allocator decides
    if trim:
        trim(0)


def string_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of an Arrow string column; nulls become empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int, rows: int = 1 << 20):
    """Row ranges of at most ``most`` bytes and ``rows`` rows each; a longer row comes alone, whole."""
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1)
        stop = min(stop, start + rows, n)
        yield start, stop
        start = stop


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and for each row the index of its first word (n + 1)."""
    solid = ~_SPACE[data]
    before, after = np.empty_like(solid), np.empty_like(solid)
    if len(data):
        before[0], before[1:] = False, solid[:-1]
        after[-1], after[:-1] = False, solid[1:]
        inner = offsets[1:-1]
        before[inner[inner < len(data)]] = False
        after[inner[inner > 0] - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums of a sequence, from which any span's hash follows."""
    up, _ = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    weighed = data.astype(np.uint64)
    weighed += np.uint64(1)
    weighed *= up[: len(data)]
    np.cumsum(weighed, out=sums[1:])
    return sums


def raw_between(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial value of each span: cheaper than ``hash_between``, for spans of one length."""
    _, down = _power_tables(len(sums))
    return (sums[ends] - sums[starts]) * down[starts]


def hash_between(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span; equal content gives equal hashes wherever it lies."""
    _, down = _power_tables(len(sums))
    value = sums[ends]
    value -= sums[starts]
    value *= down[starts]
    lengths = (ends - starts).astype(np.uint64)
    lengths *= np.uint64(0xD6E8FEB86659FD93)
    value += lengths
    return mix64(value)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return hash_between(prefix_sums(data), starts, ends)


def grams(words: np.ndarray, firsts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``n``-word shingles of each row, and each row's first shingle (rows + 1).

    A row of one to ``n - 1`` words has one shingle, of all its words; a row without words has none.
    """
    counts = np.diff(firsts)
    short = (counts > 0) & (counts < n)
    made = np.where(short, 1, np.maximum(counts - n + 1, 0))
    bounds = np.concatenate([[0], np.cumsum(made)])
    at = np.arange(bounds[-1]) + np.repeat(firsts[:-1] - bounds[:-1], made)
    out = np.zeros(len(at), dtype=np.uint64)
    padded = np.concatenate([words, np.zeros(n, np.uint64)])
    limit = np.repeat(firsts[1:], made) if short.any() else None
    for k in range(n):
        w = padded[at + k]
        if limit is not None:
            w = np.where(at + k < limit, w, np.uint64(0))
        out = out * np.uint64(0x9FB21C651E98DF25) + w
    return mix64(out), bounds


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b longs): rows (node, component), the smallest node.

    Alternating large-star and small-star steps; each keeps at most as many edges as it was given and
    is cut to the shared folder.  So are the smallest neighbours: then both sides of their join are shuffled
    for it, and Spark can split the partition of a node that very many others are linked to.  Only a count
    and a checksum reach the driver.  Nodes without an edge are not returned.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    pairs = cut(pairs.distinct())
    seen = None
    while True:
        both = pairs.union(pairs.select("b", "a"))
        least = cut(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")))
        pairs = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = pairs.groupBy("a").agg(F.min("b").alias("m"))
        linked = pairs.join(least, "a").select("b", "m", "a")
        pairs = cut(
            linked.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(linked.where("b = m").select("a", "b")).distinct()
        )
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    nodes = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(pairs.select(F.col("b"), F.col("b")).distinct())


def forest(left: np.ndarray, right: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among ``n`` local nodes: at most ``n`` of them."""
    label = np.arange(n)
    while True:  # every round takes the smallest label of each node's neighbours, then of that label's
        new = label.copy()
        np.minimum.at(new, left, label[right])
        np.minimum.at(new, right, label[left])
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    at = np.flatnonzero(label != np.arange(n))
    return at, label[at]
