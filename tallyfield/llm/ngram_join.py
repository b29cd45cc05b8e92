"""N-gram Jaccard join: MinHash banding finds candidates, whole shingle sets decide."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, components, cut, forest, grams, mix64, release, slices, small, span_hashes, string_buffers, word_spans

_SLICE = 1 << 20  # bytes of text hashed at once


def plan_bands(similarity: float, recall: float, most: int = 128) -> tuple[int, int]:
    """Bands and rows: the most rows a band for which pairs at ``similarity`` meet with probability ``recall``."""
    for rows in range(16, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))
        if bands * rows <= most:
            return bands, rows
    raise ValueError("no banding of so few hashes reaches that recall")


def _shingle_sets(column, n: int):
    """For each slice of a text column: first row, shingle hashes of its rows, and bounds (rows + 1)."""
    data, offsets = string_buffers(column)
    for lo, hi in slices(offsets, _SLICE):
        part, local = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        starts, ends, firsts = word_spans(part, local)
        shingles, bounds = grams(span_hashes(part, starts, ends), firsts, n)
        yield lo, shingles, bounds


def _signatures(n: int, bands: int, rows: int, seed: int):
    rng = np.random.default_rng(seed)
    mul = rng.integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 2**63, bands * rows, dtype=np.uint64)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for lo, shingles, bounds in _shingle_sets(batch.column(2), n):
                count = np.diff(bounds)
                full = np.flatnonzero(count)
                band_hashes = np.zeros((len(count), bands), np.uint64)
                key = np.zeros((len(count), 2), np.uint64)
                if len(full):
                    at = bounds[:-1][full]
                    for band in range(bands):
                        acc = np.full(len(full), band + 1, np.uint64)
                        for r in range(band * rows, band * rows + rows):
                            acc = acc * np.uint64(0x9FB21C651E98DF25) + np.minimum.reduceat(shingles * mul[r] + add[r], at)
                        band_hashes[full, band] = mix64(acc)
                    # The set's own key ignores order and repeats: both sums run over distinct shingles.
                    row = np.repeat(np.arange(len(count)), count)
                    order = np.lexsort((shingles, row))
                    first = np.ones(len(order), bool)
                    first[1:] = (shingles[order][1:] != shingles[order][:-1]) | (row[order][1:] != row[order][:-1])
                    unique, owner = shingles[order][first], row[order][first]
                    begin = np.flatnonzero(np.diff(owner, prepend=-1))
                    key[full, 0] = np.add.reduceat(mix64(unique + np.uint64(1)), begin)
                    key[full, 1] = np.add.reduceat(mix64(unique ^ np.uint64(0xA5A5A5A5A5A5A5A5)), begin)
                ids, h = batch.column(0).slice(lo, len(count)), batch.column(1).slice(lo, len(count))
                packed = pa.FixedSizeListArray.from_arrays(pa.array(band_hashes.view(np.int64).ravel()), bands)
                yield pa.RecordBatch.from_arrays(
                    [ids, h, pa.array(key[:, 0].view(np.int64)), pa.array(key[:, 1].view(np.int64)),
                     pa.array(count > 0), pa.array(count.astype(np.int64)), packed.cast(pa.list_(pa.int64()))],
                    names=["id", "h", "k1", "k2", "filled", "size", "bands"],
                )
        release()

    return run


def _verify(n: int, similarity: float):
    def block(bucket, ids, weights, own, low, high, shared, sets):
        """Links between the rows of two chunks of a bucket: a row's linked weight, and a forest.

        A pair that meets in several buckets links in the first of them.
        """
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        sizes = np.array([len(s) for s in sets])
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        values, code = np.unique(flat, return_inverse=True)
        common = np.bincount(code, minlength=len(values)) > 1  # a shingle of one row alone meets nothing
        rank = np.cumsum(common) - 1
        use = common[code]
        code, owner = rank[code[use]], owner[use]
        order = np.argsort(code, kind="stable")
        code, owner = code[order], owner[order]
        both = np.zeros((len(left), len(right)), np.float64)
        step, total = 4096, int(common.sum())
        for lo in range(0, total, step):
            a, b = np.searchsorted(code, [lo, lo + step])
            has = np.zeros((len(sets), min(step, total - lo)), np.float32)
            has[owner[a:b], code[a:b] - lo] = 1
            both += has[left] @ has[right].T
        alike = both >= similarity / (1 + similarity) * (sizes[left][:, None] + sizes[right][None]) - 1e-9
        at = np.argwhere(alike)
        x, y = left[at[:, 0]], right[at[:, 1]]
        keep = x < y if low == high else x != y
        x, y = x[keep], y[keep]
        met = (shared[x] == shared[y]) & (shared[x] != 0)
        first = np.where(met, shared[x], np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max) == bucket
        x, y = x[first], y[first]
        linked = np.bincount(x, weights[y], len(ids)) + np.bincount(y, weights[x], len(ids))
        return linked.astype(np.int64), forest(x, y, len(ids))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        import pyarrow as pa

        out = {"a": [], "b": [], "links": []}
        for (bucket, low, high), part in group.groupby(["bucket", "low", "high"], sort=False):
            part = part.drop_duplicates("node")
            ids = part["node"].to_numpy()
            sets = []
            for _, shingles, bounds in _shingle_sets(pa.array(part["text"], pa.large_string()), n):
                sets += [np.unique(shingles[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            linked, (up, down) = block(bucket, ids, part["n"].to_numpy(), part["own"].to_numpy(), low, high, np.stack(part["shared"].to_list()), sets)
            has = np.flatnonzero(linked)
            out["a"] += [*ids[has].tolist(), *ids[up].tolist()]
            out["b"] += [None] * len(has) + ids[down].tolist()
            out["links"] += linked[has].tolist() + [None] * len(up)
        return pd.DataFrame({k: pd.array(v, dtype="Int64") for k, v in out.items()})

    return run


def _buckets(classes: DataFrame, bands: int) -> DataFrame:
    """Every class that shares a band with another: node and ``shared``, for each band the bucket it shares (0: none).

    Buckets of several bands with the very same members are one bucket: its name follows from the members.
    """
    posted = classes.select("node", F.posexplode("bands").alias("band", "hash"))
    mark = lambda seed: F.bit_xor(F.xxhash64("node", F.lit(seed)))
    met = (
        posted.groupBy("hash").agg(F.count("*").alias("c"), mark(1).alias("m1"), mark(2).alias("m2")).where("c > 1")
        .select("hash", F.xxhash64("c", "m1", "m2").alias("bucket"))
    )
    found = posted.join(met, "hash").groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("band", "bucket"))).alias("at"))
    shared = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.coalesce(F.try_element_at("at", b), F.lit(0)))
    return found.select("node", shared.alias("shared"))


def _linked_classes(docs: DataFrame, n: int, similarity: float, recall: float, chunk: int, block: int, seed: int, id_col: str, text: str):
    """Signed rows (id, h, k1, k2, filled), and the classes of equal shingle sets with links and components."""
    bands, rows = plan_bands(similarity, recall)
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    signed = cut(named.mapInArrow(_signatures(n, bands, rows, seed), "id long, h long, k1 long, k2 long, filled boolean, size long, bands array<long>"))
    # The first row of a class stands for it; nodes are numbered in the order of their ids, null last.
    first = F.min(F.struct(F.col("id").isNull().alias("no"), "id", "h", "bands", "size")).alias("m")
    grouped = signed.where("filled").groupBy("k1", "k2").agg(first, F.count("*").alias("n"))
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = grouped.repartitionByRange(ranges, "m.no", "m.id", "m.h", "k1").sortWithinPartitions("m.no", "m.id", "m.h", "k1")
    classes = cut(grouped.select(
        F.monotonically_increasing_id().alias("node"), "k1", "k2", "n", F.col("m.id").alias("rep"), F.col("m.h").alias("h"),
        F.col("m.bands").alias("bands"), F.least(F.col("m.size"), F.lit(block)).alias("size"),
    ))
    members = cut(_buckets(classes, bands).join(classes.select("node", "rep", "h", "n", "size"), "node"))
    # As many chunks as rows and shingles ask for; one text of more than ``block`` counts as a chunk.
    chunks = F.greatest(F.ceil(F.count("*") / chunk), F.ceil(F.sum("size") / block)).cast("int")
    bundles = max(1, members.agg(chunks).first()[0] or 0)
    texts = (
        named.withColumn("rep", F.coalesce("id", F.lit(-1))).select("rep", "h", "text")
        .join(members.withColumn("rep", F.coalesce("rep", F.lit(-1))), ["rep", "h"]).dropDuplicates(["rep", "h", "node"])
        .select("node", "n", "shared", "text", F.explode(F.array_distinct(F.filter("shared", lambda b: b != 0))).alias("bucket"))
    )
    sizes = members.select(F.explode(F.array_distinct("shared")).alias("bucket"), "size").where("bucket <> 0").groupBy("bucket")
    large = sizes.agg(chunks.alias("chunks")).where("chunks > 1")
    texts = (
        texts.join(small(cut(large), 100_000), "bucket", "left").withColumn("m", F.coalesce("chunks", F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("m")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
        .withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
        # Small buckets share a bundle; the pairs of chunks of a large one are bundles of their own.
        .withColumn("bundle", F.when(F.col("m") == 1, F.pmod(F.xxhash64("bucket"), F.lit(bundles))).otherwise(F.xxhash64("bucket", "low", "high")))
        .select("bundle", "bucket", "low", "high", "own", "node", "n", "shared", "text")
    )
    found = cut(texts.groupBy("bundle").applyInPandas(_verify(n, similarity), "a long, b long, links long"))
    links = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    comps = components(found.where("b IS NOT NULL").select("a", "b"))
    least = classes.select(F.col("node").alias("component"), F.col("rep").alias("component_rep"))
    known = (
        classes.drop("bands", "size").join(links, "node", "left").join(comps.join(least, "component"), "node", "left")
        .select("k1", "k2", "rep", "h", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
                F.when(F.col("component").isNull(), F.col("rep")).otherwise(F.col("component_rep")).alias("component_id"),
                (F.coalesce("component", "node") == F.col("node")).alias("stands"))
    )
    return signed.drop("bands", "size"), known


def ngram_jaccard_join(
    docs: DataFrame, n: int = 5, similarity: float = 0.8, recall: float = 0.99999, chunk: int = 128, block: int = 1 << 18,
    seed: int = 3, id_col: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Link documents whose sets of ``n``-word shingles have a Jaccard similarity of ``similarity`` or more.

    Documents with one and the same shingle set form a class with one representative, so exact
    copies never meet in pairs.  Band and row counts follow from ``recall`` at ``similarity``
    (22 bands of 4 rows for the defaults).  Band hashes of classes are shuffled; classes that share a band
    hash form a bucket, and pairs are verified on whole shingle sets inside their buckets only, in the
    first one that they share.  Buckets of equal members are one.  A bucket of more than ``chunk`` classes or
    ``block`` shingles is dealt into chunks (a longer text is one by itself) and every pair of chunks is verified apart, so no bucket is gathered in one place and no
    partner is capped.  Components are built from verified links alone.

    One row per document: ``id_col``; ``class_id``, the smallest id of equal shingle sets; ``n_links``,
    the other documents linked directly (copies counted); ``component_id``, the smallest id reachable;
    ``kept``, whether the document stands for its component.  Texts without a word (null, empty) link with
    nothing and stay.  A text of fewer than ``n`` words is one shingle.  Rows with a null id take part like
    others and stay null; ids that are null count after all others.  Rows that repeat are documents of their
    own, and different texts under one id are classes of their own.  Other columns are dropped.
    """
    signed, known = _linked_classes(docs, n, similarity, recall, chunk, block, seed, id_col, text)
    known = known.drop("h").withColumn("filled", F.lit(True))
    out = signed.join(known, ["k1", "k2", "filled"], "left")
    own = lambda c: F.when(F.col("filled"), F.col(c)).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_col), own("rep").alias("class_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        own("component_id").alias("component_id"),
        F.when(F.col("filled"), F.col("stands") & F.col("id").eqNullSafe(F.col("rep"))).otherwise(True).alias("kept"),
    )


def drop_near_copies(
    docs: DataFrame, n: int = 5, similarity: float = 0.8, recall: float = 0.99999, chunk: int = 128, block: int = 1 << 18,
    seed: int = 3, id_col: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``docs`` with one document of each component of ``ngram_jaccard_join`` (the smallest id), columns unchanged.

    Documents linked with nothing stay; those without a word all stay.  Of rows that repeat the kept id and
    text one stays; other texts under that id are judged by their own links.
    """
    _, known = _linked_classes(docs, n, similarity, recall, chunk, block, seed, id_col, text)
    key = ["rep", "h", "no"]
    kept = known.where("stands").select(F.coalesce("rep", F.lit(-1)).alias("rep"), "h", F.col("rep").isNull().alias("no"))
    # Whole rows travel as one column, so that no name of theirs meets one of these.
    rows = docs.select(
        F.struct("*").alias("whole"), F.coalesce(F.col(id_col).cast("long"), F.lit(-1)).alias("rep"), F.xxhash64(text).alias("h"),
        F.col(id_col).isNull().alias("no"), F.coalesce(F.col(text).rlike(WORD), F.lit(False)).alias("filled"),
    )
    found = rows.where("filled").dropDuplicates(key).join(kept, key, "left_semi")
    return found.select("whole").union(rows.where("NOT filled").select("whole")).select("whole.*")
