"""Best-fit packing of token sequences, improved by swaps between underfull bins until bins empty."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parts, release, slices, stored, string_buffers
from .token_file import SLICE, Encoder

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_state: dict = {}


def cut_points(size: int, capacity: int) -> list[int]:
    """Where a document of ``size`` ids is cut: every piece but the first has ``capacity`` ids."""
    first = (size - 1) % capacity + 1
    return [0, *range(first, size + 1, capacity)]


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, id_col: str = "doc_id", text: str = "text", added: bool = True,
) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32): each text's ids and an id 0, cut only where longer than ``capacity``.

    Null text is empty, the end id alone; null ids stay null and rows that repeat are pieces of their own.  The checksum is
    that of the ids as little-endian 32 bits.  Texts are encoded whole, in slices of a megabyte; a longer text is a slice.
    """

    def encode(batches):
        import pyarrow as pa

        if _state.get("encodes") != (tokenizer, added):
            _state["encoder"], _state["encodes"] = Encoder(tokenizer, added=added), (tokenizer, added)
        for batch in batches:
            data, offsets = string_buffers(batch.column(1))
            for lo, hi in slices(offsets, SLICE):
                ids, sizes = _state["encoder"].encode(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                raw, begin = memoryview(ids.astype("<u4").tobytes()), 0
                row, piece, start, length, crc = [], [], [], [], []
                for i, size in enumerate(sizes.tolist()):
                    cuts = cut_points(size, capacity)
                    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                        row.append(i)
                        piece.append(k)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(raw[4 * (begin + a) : 4 * (begin + b)]))
                    begin += size
                names = batch.column(0).slice(lo, hi - lo).take(pa.array(row, pa.int64()))
                columns = [names, pa.array(piece, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, length, crc))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"])
        release()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(encode, PIECE)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Longest first, each into the fullest bin that has room: bins of indexes."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins that have exactly so much room
    open_rooms = 0  # a bit for each room that some bin has
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = open_rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            which = by_room[room].pop()
            if not by_room[room]:
                open_rooms ^= 1 << room
            bins[which].append(i)
        else:
            room, which = capacity, len(bins)
            bins.append([i])
        left = room - size
        if left:
            by_room[left].append(which)
            open_rooms |= 1 << left
    return bins


def fewest_bins(lengths: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins: the best of Martello and Toth's bounds, over what counts as a small document."""
    many = np.bincount(lengths, minlength=capacity + 1)
    count, total = np.concatenate([[0], np.cumsum(many)]), np.concatenate([[0], np.cumsum(many * np.arange(capacity + 1))])
    half = capacity // 2 + 1  # the first length that shares no bin with its like
    small = np.arange(half)
    large, rest = capacity - small + 1, total[half] - total[small]  # lengths from ``large`` on have room for no small one
    room = (count[large] - count[half]) * capacity - (total[large] - total[half])
    return int((count[-1] - count[half] + np.maximum(0, -((room - rest) // capacity))).max())


def _offers(which: int, lengths: list[int], capacity: int) -> tuple[np.ndarray, ...]:
    """What a bin would give for a document: nothing, one of its own or two; with how many, its room and number."""
    own = np.unique(np.array(lengths, np.int64))  # equal lengths are equal offers
    pairs = _pair_sums(own, np.bincount(lengths, minlength=capacity + 1))
    take = np.concatenate([[0], own, pairs])
    return take, np.repeat([0, 1, 2], [1, len(own), len(pairs)]), np.full(len(take), capacity - sum(lengths)), np.full(len(take), which)


def _pair_sums(own: np.ndarray, many: np.ndarray) -> np.ndarray:
    a, b = np.triu_indices(len(own), 1)
    return np.unique(np.concatenate([own[a] + own[b], own[many[own] > 1] * 2]))


def _remove(items: list[int], lengths: np.ndarray, total: int, count: int) -> list[int]:
    """Take ``count`` documents of together ``total`` out of a bin; it has such."""
    if count == 0:
        return []
    if count == 1:
        k = next(k for k, i in enumerate(items) if lengths[i] == total)
        return [items.pop(k)]
    at = {}
    for k, i in enumerate(items):
        if (other := at.get(total - int(lengths[i]))) is not None:
            return [items.pop(k), items.pop(other)]
        at.setdefault(int(lengths[i]), k)
    raise AssertionError("no two documents of that length together")


def swap_search(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Empty bins by moves and swaps, each of which raises the sum of squared fill; the bins that are left.

    The least full bin gives to the others, which are all at least as full: one document for none (a move), for one or for
    two, or two for none or one, whatever moves most length into their room.  As the giver is the least full, length that
    leaves it raises the squares, so the search ends: with as few bins as ``fewest_bins`` allows, or when no bin can give
    anything to a fuller one.
    """
    bins = {k: list(b) for k, b in enumerate(bins)}
    fill = np.array([int(lengths[b].sum()) for b in bins.values()], np.int64)
    fewest = fewest_bins(lengths, capacity)
    if len(bins) <= fewest:
        return list(bins.values())
    offers = [_offers(k, lengths[b].tolist(), capacity) for k, b in bins.items() if fill[k] < capacity]
    take, count, room, where = (np.concatenate(c) for c in zip(*offers, strict=True))

    def renew(*changed: int) -> None:
        nonlocal take, count, room, where
        stay = ~np.isin(where, changed)
        new = [_offers(k, lengths[bins[k]].tolist(), capacity) for k in changed if bins.get(k) and fill[k] < capacity]
        take, count, room, where = (np.concatenate([old[stay], *more]) for old, more in
                                    zip((take, count, room, where), zip(*new, strict=True) if new else [()] * 4, strict=True))

    changed, stuck = True, set()
    while changed and len(bins) > fewest:
        changed = False
        for donor in sorted((k for k in bins if fill[k] < capacity), key=lambda k: (fill[k], k)):
            if len(bins) <= fewest:
                break
            while bins[donor] and fill[donor] < capacity:
                held = tuple(sorted(lengths[bins[donor]].tolist()))
                if held in stuck:  # its like found nothing, and no bin has changed since
                    break
                own = np.unique(np.array(held, np.int64))
                pairs = _pair_sums(own, np.bincount(held, minlength=capacity + 1))
                fuller = (where != donor) & (fill[where] >= fill[donor])
                best = (0, 0, 0)
                for give, n, most in ((own, 1, 2), (pairs, 2, 1)):
                    if not len(give) or not len(take):
                        continue
                    at = np.searchsorted(give, take + room, side="right") - 1
                    gain = np.where((at >= 0) & fuller & (count <= most), give[at] - take, 0)
                    k = int(np.argmax(gain))
                    if gain[k] > best[0]:
                        best = int(gain[k]), n, k
                gain, n, k = best
                if gain <= 0:
                    stuck.add(held)
                    break
                target = int(where[k])
                out = _remove(bins[donor], lengths, int(take[k]) + gain, n)
                bins[donor] += _remove(bins[target], lengths, int(take[k]), int(count[k]))
                bins[target] += out
                fill[target], fill[donor], changed = fill[target] + gain, fill[donor] - gain, True
                stuck.clear()
                renew(target, donor)
            if not bins[donor]:
                del bins[donor]
    return list(bins.values())


def _pack(capacity: int, level: int):
    """Pack one shard: by best fit where nothing is packed yet, then by swaps."""

    def run(key, table):
        import pyarrow as pa

        shard = key[0].as_py()
        lengths = table["length"].to_numpy()
        if level == 0:
            bins = best_fit(lengths, capacity)
        else:
            _, group = np.unique(table["sequence_id"].to_numpy(), return_inverse=True)
            order = np.argsort(group, kind="stable")
            bins = [b.tolist() for b in np.split(order, np.flatnonzero(np.diff(group[order])) + 1)]
        bins = swap_search(bins, lengths, capacity)
        which, offset, room = (np.zeros(len(lengths), np.int64) for _ in range(3))
        for k, b in enumerate(bins):
            ends = np.cumsum(lengths[b])
            which[b], offset[b], room[b] = k, ends - lengths[b], capacity - ends[-1]
        number = (level << 56) + (shard << 20) + which
        kept = table.select(["doc_id", "piece", "start", "length", "ids_crc32"])
        for name, column in (("sequence_id", number), ("offset", offset), ("room", room)):
            kept = kept.append_column(name, pa.array(column, pa.int64()))
        return kept

    return run


def pack_sequences(pieces: DataFrame, capacity: int = 2048, shard: int = 4096) -> DataFrame:
    """``pieces`` (as of ``token_pieces``) with sequence_id and offset: sequences of at most ``capacity`` ids, without gaps.

    Pieces that fill a sequence have it alone.  The others are dealt evenly, whatever their ids, into shards of about ``shard``
    pieces, packed by best fit, and improved by ``swap_search``.  Sequences that stay underfull are dealt anew, whole, with those
    of other shards, and improved again, until one shard holds them all or they no longer get fewer.  Ties of equal
    lengths fall to the row that was read first.  An empty table gives no rows; a piece longer than ``capacity`` or without length
    raises a ValueError.

    Shards are as many as the pieces need; only numbers of rows reach the driver, and each level is written to the shared folder.
    """
    pieces = stored(pieces.select("doc_id", "piece", "start", "length", "ids_crc32", F.monotonically_increasing_id().alias("nth")))
    sizes = pieces.agg(F.count_if(~F.coalesce(F.col("length").between(1, capacity), F.lit(False))), F.count_if(F.col("length") < capacity)).first()
    if sizes[0]:
        raise ValueError(f"{sizes[0]} pieces have no length from 1 to {capacity}")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    full = pieces.where(F.col("length") == capacity).withColumns({"sequence_id": -1 - F.col("nth"), "offset": F.lit(0).cast("long")})
    out, left, rows, level, sequences = full.select(*columns), pieces.where(F.col("length") < capacity), sizes[1], 0, None
    schema = ", ".join([PIECE, "sequence_id long, offset long, room long"])
    while rows:
        shards = -(-rows // shard)
        by = F.col("nth") if level == 0 else F.col("sequence_id")
        dealt = left.withColumn("shard", F.pmod(F.xxhash64(by, F.lit(level)), F.lit(shards)))
        tasks = min(shards, parts(left.sparkSession, shards, 16))  # asked for by number, so that small shards are not packed one by one
        packed = stored(dealt.repartition(tasks, "shard").groupBy("shard").applyInArrow(_pack(capacity, level), schema))
        left = packed.where("room > 0")
        state = left.agg(F.count("*"), F.count_if(F.col("offset") == 0)).first()
        if shards == 1 or (sequences is not None and state[1] * 100 > sequences * 99):
            return out.union(packed.select(*columns))
        out = out.union(packed.where("room = 0").select(*columns))
        rows, sequences, level = state[0], state[1], level + 1
    return out
