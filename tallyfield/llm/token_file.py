"""Token-id files: byte-level BPE ids in ascending document order, compressed by Re-Pair per shard."""

from __future__ import annotations

import json
import uuid
import zlib
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, parts, shared_folder, slices, small, span_hashes, string_buffers

_LETTER, _NUMBER, _OTHER, _WHITE = 0, 1, 2, 3
SLICE = 1 << 20  # bytes of text that are encoded at once
_state: dict = {}


def _classes() -> np.ndarray:
    """Class of every code point as the vocabulary's split pattern sees it."""
    if "classes" not in _state:
        import regex

        points = [chr(c) if not 0xD800 <= c < 0xE000 else "x" for c in range(0x110000)]
        everything = "".join(points)
        table = np.full(0x110000, _OTHER, np.uint8)
        for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_WHITE, r"\s+")):
            for m in regex.finditer(pattern, everything):
                table[m.start() : m.end()] = kind
        _state["classes"] = table
    return _state["classes"]


def split_points(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """First code points of the parts that byte-level BPE treats one by one.

    Parts are runs of letters, of digits or of other signs, each with one space before it; white
    space otherwise; and the English endings after an apostrophe that begins a part.
    ``bounds`` are the texts' first code points (rows + 1).
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = _classes()[points]
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    run = edge[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    white = kind == _WHITE
    blank = points == 0x20
    before_solid = np.zeros(n, bool)  # the last white space before a solid sign of the same text
    before_solid[:-1] = white[:-1] & ~white[1:] & ~edge[1:n]
    start = run.copy()
    start |= before_solid
    attached = np.zeros(n, bool)
    attached[1:] = before_solid[:-1] & blank[:-1]
    start &= ~attached
    # An apostrophe that is a part's first sign and a known ending after it.
    quote = np.flatnonzero((points == 0x27) & start)
    if len(quote):
        ahead = np.concatenate([points, np.zeros(3, points.dtype)])
        last = np.searchsorted(bounds, quote, side="right")
        room = bounds[last] - quote - 1
        one, two = ahead[quote + 1], ahead[quote + 2]
        single = np.isin(one, [ord(c) for c in "stmd"]) & (room >= 1)
        double = (room >= 2) & (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l")))
        for q, size in ((quote[single], 1), (quote[double], 2)):
            start[q + 1] = False
            after = q + 1 + size
            inside = after[after < n]
            start[inside[~attached[inside]]] = True
    return np.flatnonzero(start)


class Encoder:
    """Ids of many texts at once: every distinct part is encoded once by the library and remembered.

    With ``added`` the file's added tokens ('<|endoftext|>') have their own ids where a text spells them, as in a
    plain call of the library; without, they are signs like any others.
    """

    def __init__(self, path: str, most: int = 2_000_000, added: bool = False):
        import os
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        made = json.loads(self.tokenizer.to_str())
        split = made["pre_tokenizer"] or {}
        if made["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
            raise ValueError("parts are split as by byte-level BPE without a normalizer; this file asks for something else")
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids beyond 16 bits are not supported")
        tokens = self.tokenizer.get_added_tokens_decoder().values() if added else ()
        if any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in tokens):
            raise ValueError("added tokens that depend on their surroundings are not supported")
        self.added = re.compile("|".join(re.escape(t.content) for t in sorted(tokens, key=lambda t: -len(t.content)))) if tokens else None
        (self.line_break,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.most = most
        self._forget()

    def _forget(self) -> None:
        self.places = np.full((2, 1 << 22), -1, np.int32)  # two places for a key; the second may be overwritten
        self.count = self.total = 0  # entries, and ids in all of them; the arrays have room for more
        self.known = np.zeros(1 << 12, np.uint64)
        self.first = np.zeros(1 << 12, np.int32)
        self.size = np.zeros(1 << 12, np.int32)
        self.ids = np.zeros(1 << 14, np.uint16)

    def _put(self, name: str, at: int, values: np.ndarray) -> None:
        """Write ``values`` into an array from ``at`` on; it grows by half where it is too short."""
        held = getattr(self, name)
        if at + len(values) > len(held):
            grown = np.zeros(max(at + len(values), len(held) * 3 // 2), held.dtype)
            grown[:at] = held[:at]
            setattr(self, name, grown)
        getattr(self, name)[at : at + len(values)] = values

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Entry of each key, -1 for those not remembered."""
        entry = self.places[0][keys >> np.uint64(42)]
        if not self.count:
            return entry
        miss = np.flatnonzero((entry < 0) | (self.known[entry] != keys))
        second = self.places[1][(keys[miss] >> np.uint64(20)) & np.uint64(0x3FFFFF)]
        entry[miss] = np.where((second >= 0) & (self.known[second] == keys[miss]), second, -1)
        return entry

    def _learn(self, keys: np.ndarray, solid: np.ndarray, parts_: list[str]) -> None:
        """Remember the ids of new parts.  Solid parts go to the library as lines: a line break is a part of its own."""
        alone = [p for p, s in zip(parts_, solid.tolist(), strict=True) if not s]
        words = [p for p, s in zip(parts_, solid.tolist(), strict=True) if s]
        lines = ["\n".join(words[i : i + 256]) + "\n" for i in range(0, len(words), 256)]
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(alone + lines, add_special_tokens=False)]
        blank = np.fromiter(chain.from_iterable(encoded[: len(alone)]), np.uint16)
        flat = np.fromiter(chain.from_iterable(encoded[len(alone) :]), np.uint16)
        breaks = np.flatnonzero(flat == self.line_break)
        keys = np.concatenate([keys[~solid], keys[solid]])
        sizes = np.concatenate([np.fromiter(map(len, encoded[: len(alone)]), np.int64), np.diff(breaks, prepend=-1) - 1])
        ids = np.concatenate([blank, flat[flat != self.line_break]])
        entry = np.arange(self.count, self.count + len(keys), dtype=np.int32)
        self._put("ids", self.total, ids)
        self._put("first", self.count, self.total + np.cumsum(sizes) - sizes)
        self._put("size", self.count, sizes)
        self._put("known", self.count, keys)
        self.count, self.total = self.count + len(keys), self.total + len(ids)
        slot = keys >> np.uint64(42)
        free = self.places[0][slot] < 0
        self.places[0][slot[free]] = entry[free]
        left = np.flatnonzero(self.places[0][slot] != entry)
        self.places[1][(keys[left] >> np.uint64(20)) & np.uint64(0x3FFFFF)] = entry[left]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts with an id 0 after each, and how many each has."""
        lead = (data & 0xC0) != 0x80  # first bytes of characters
        text = data.tobytes().decode("utf-8")
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        place = np.flatnonzero(lead)
        bounds = np.searchsorted(place, offsets)
        if self.added and self.added.search(text):
            limits = bounds.tolist()
            tokens = np.array([m.span() for a, b in zip(limits[:-1], limits[1:], strict=True) for m in self.added.finditer(text, a, b)]).reshape(-1, 2)
            starts = split_points(points, np.union1d(bounds, tokens))  # what is around a token is split as if alone
            inside = np.searchsorted(tokens[:, 0], starts, side="left") - 1  # the last token that begins before
            starts = starts[(inside < 0) | (starts >= np.append(tokens[:, 1], 0)[inside])]
        else:
            starts = split_points(points, bounds)
        ends = np.append(starts[1:], len(points))[: len(starts)]
        byte = np.append(place, len(data))
        keys = span_hashes(data, byte[starts], byte[ends])
        if self.count > self.most:
            self._forget()
        entry = self._find(keys)
        miss = np.flatnonzero(entry < 0)
        if len(miss):
            new, where, which = np.unique(keys[miss], return_index=True, return_inverse=True)
            begin, at = self.count, miss[where]
            solid = _classes()[points[ends[at] - 1]] != _WHITE
            self._learn(new, solid, [text[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
            order = np.argsort(solid, kind="stable")  # as learnt: white space first
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            entry[miss] = begin + rank[which]
        sizes, source = self.size[entry].astype(np.int64), self.first[entry]
        total = np.concatenate([[0], np.cumsum(sizes)])
        place = np.repeat((source - total[:-1]).astype(np.int32), sizes)
        place += np.arange(len(place), dtype=np.int32)
        ids = self.ids[place].astype(np.uint32)
        per_text = total[np.searchsorted(starts, bounds)]
        return np.insert(ids, per_text[1:], 0), np.diff(per_text) + 1


def _grouped(left: np.ndarray, right: np.ndarray, at: np.ndarray, use: np.ndarray | None = None):
    """Pairs in ascending order, each with its places together: places, and each pair's first place among them and code.

    Of places ``at`` only those that ``use`` marks, if it is given.
    """
    sign, place = int(max(left.max(initial=0), right.max(initial=0))).bit_length(), int(at.max(initial=0)).bit_length()
    if 2 * sign + place > 64:
        if use is not None:
            left, right, at = left[use], right[use], at[use]
        pair = left.astype(np.int64) << 32 | right
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
        first = np.flatnonzero(np.append(len(pair) > 0, np.diff(pair)))
        return at[order], first, pair[first]
    key = left.astype(np.uint64)  # pair and place in one number: sorting it is faster than sorting by it
    for value, bits in ((right, sign), (at.view(np.uint32), place)):
        key <<= np.uint64(bits)
        key |= value
    if use is not None:
        key = key[use]
    key.sort()
    at = key.astype(np.uint32)
    at &= np.uint32((1 << place) - 1)
    key >>= np.uint64(place)
    pair = key.astype(np.uint32) if 2 * sign <= 32 else key
    first = np.flatnonzero(np.append(len(pair) > 0, pair[1:] != pair[:-1]))
    pair = pair[first].astype(np.int64)
    return at.view(np.int32), first, pair >> sign << 32 | pair & ((1 << sign) - 1)


def _slices_of(pool: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Several stretches of an array, one after the other."""
    return pool[np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)]


def repair(ids: np.ndarray, docs: np.ndarray, base: int, least: int = 24):
    """Re-Pair: rules (left, right), the sequence rewritten with them, and each document's first symbol in it.

    A round replaces the most frequent pairs of neighbours that do not touch each other, leftmost first;
    rounds go on until no pair is left that occurs ``least`` times without overlap.  All counts are exact:
    a pair only arises in the round that makes its younger symbol and only loses occurrences after that, so
    its places are found once, its count is lowered as places change, and a pair under ``least`` is let go for
    good.  Pairs never reach across the end of a document, so documents decode alone.
    """
    n, rules = len(ids), []
    symbols = np.append(ids, 0).astype(np.uint32)
    after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)  # n: none
    after[docs[1:] - 1], before[docs[:-1]] = n, n
    alive = np.ones(n, bool)
    kind = np.full(n + 1, -1, np.int32)  # the pair that begins at a place, of those that occur often enough
    pool, codes, tally, first, size = np.zeros(0, np.int32), *(np.zeros(0, np.int64) for _ in range(4))
    arose = symbols[:n], symbols[1:], np.arange(n, dtype=np.int32), after[:n] != n
    while True:
        # Name the pairs that arose often enough; their places lie together in the pool.
        at, begin, pair = _grouped(*arose)
        count = np.diff(np.append(begin, len(at)))
        enough = np.flatnonzero(count >= least)
        at = _slices_of(at, begin[enough], count[enough])
        kind[at] = np.repeat(np.arange(len(codes), len(codes) + len(enough), dtype=np.int32), count[enough])
        first = np.concatenate([first, len(pool) + np.cumsum(count[enough]) - count[enough]])
        pool, codes, size = np.concatenate([pool, at]), np.concatenate([codes, pair[enough]]), np.concatenate([size, count[enough]])
        tally = np.concatenate([tally, count[enough]])
        often = np.flatnonzero(tally >= least)
        if not len(often):
            break
        often = often[np.argsort(-tally[often], kind="stable")]
        lefts, rights, chosen = set(), set(), []
        for which, code in zip(often.tolist(), codes[often].tolist(), strict=True):
            a, b = code >> 32, code & 0xFFFFFFFF
            if a in rights or b in lefts or (a == b and (a in lefts or b in rights)):
                continue
            lefts.add(a)
            rights.add(b)
            chosen.append(which)
        chosen = np.array(chosen)
        places = _slices_of(pool, first[chosen], size[chosen])
        slot = np.repeat(np.arange(len(chosen)), size[chosen])
        still = kind[places] == chosen[slot]
        where, slot = places[still], slot[still]
        twin = (codes[chosen] >> 32) == (codes[chosen] & 0xFFFFFFFF)
        if twin.any():  # within a run of one sign: every second pair
            double = twin[slot]
            order = np.argsort(where[double], kind="stable")
            runs, own = where[double][order], slot[double][order]
            apart = np.ones(len(runs), bool)
            apart[1:] = after[runs[:-1]] != runs[1:]
            nth = np.arange(len(runs))
            second_ones = (nth - np.maximum.accumulate(np.where(apart, nth, 0))) % 2 == 0
            runs, own = runs[second_ones], own[second_ones]
            rare = twin & (np.bincount(own, minlength=len(chosen)) < least)  # never again often enough
            tally[chosen[rare]] = -1
            runs, own = runs[~rare[own]], own[~rare[own]]
            where, slot = np.concatenate([where[~double], runs]), np.concatenate([slot[~double], own])
            slot = (np.cumsum(~rare) - 1)[slot]
            chosen = chosen[~rare]
        first_made = base + len(rules)
        rules += [(code >> 32, code & 0xFFFFFFFF) for code in codes[chosen].tolist()]
        second = after[where]
        onward = after[second]
        symbols[where] = (first_made + slot).astype(np.uint32)
        alive[second] = False
        after[where] = onward
        before[onward] = where
        ahead = before[where]
        lost = []
        for changed in (where, second, ahead):
            lost.append(kind[changed])
            kind[changed] = -1
        lost = np.concatenate(lost)
        tally -= np.bincount(lost[lost >= 0], minlength=len(tally))
        ahead = ahead[ahead != n]
        new = np.concatenate([where[onward != n], ahead[symbols[ahead] < first_made]])
        arose = symbols[new], symbols[after[new]], new
    begins = np.concatenate([[0], np.cumsum(alive)])[docs]
    return np.array(rules, np.int64).reshape(-1, 2), symbols[:n][alive], begins


def spans(rules: np.ndarray, base: int) -> np.ndarray:
    """How many ids each rule expands to."""
    out: list[int] = []
    for a, b in rules.tolist():
        out.append((out[a - base] if a >= base else 1) + (out[b - base] if b >= base else 1))
    return np.array(out, np.uint32)


def expansions(rules: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """All rules written out, and where each begins (rules + 1)."""
    lengths = spans(rules, base).astype(np.int64)
    return expand(rules.ravel(), rules, base), np.concatenate([[0], np.cumsum(lengths)])


def decode(sequence: np.ndarray, written: np.ndarray, bounds: np.ndarray, base: int) -> np.ndarray:
    """Ids of a stretch of the sequence: any document decodes alone."""
    every = np.concatenate([np.arange(base, dtype=np.uint32), written])  # what symbols write, one after the other
    first = np.concatenate([np.arange(base), base + bounds[:-1]]).astype(np.int32)[sequence]
    size = np.concatenate([np.ones(base, np.int32), np.diff(bounds).astype(np.int32)])[sequence]
    total = np.cumsum(size)
    first -= (total - size).astype(np.int32)
    source = np.repeat(first, size)
    source += np.arange(len(source), dtype=np.int32)
    return every[source]


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """Ids of a few symbols, without writing out the rules that they do not use."""
    out = symbols.astype(np.int64)
    while (at := np.flatnonzero(out >= base)).size:
        sizes = np.ones(len(out), np.int64)
        sizes[at] = 2
        first = (np.cumsum(sizes) - sizes)[at]
        pairs, out = rules[out[at] - base], np.repeat(out, sizes)
        out[first], out[first + 1] = pairs[:, 0], pairs[:, 1]
    return out.astype(np.uint32)


def ids_between(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int, lo: int, hi: int) -> np.ndarray:
    """Ids ``lo`` to ``hi`` of a document: expansion lengths find the symbols that hold them, only those are written out."""
    rule = symbols >= base
    sizes = np.where(rule, np.append(lengths, 0)[np.where(rule, symbols - base, len(lengths))], 1)
    ends = np.cumsum(sizes)
    lo, hi = max(lo, 0), min(hi, int(ends[-1]) if len(ends) else 0)
    if lo >= hi:
        return np.zeros(0, np.uint32)
    a, b = np.searchsorted(ends, lo, side="right"), np.searchsorted(ends, hi, side="left") + 1
    begin = int(ends[a] - sizes[a])
    return expand(symbols[a:b], rules, base)[lo - begin : hi - begin]


FILE = "part int, shard int, doc_ids binary, named binary, firsts binary, sizes binary, rules binary, spans binary, wide boolean, sequence binary"


def write_token_file(
    docs: DataFrame, path: str, tokenizer: str, base: int = 50_257, shard_bytes: int = 4 << 20,
    id_col: str = "doc_id", text: str = "text", added: bool = False,
) -> None:
    """Encode whole texts and write them, in ascending ``id_col`` order, as a table of Re-Pair shards.

    Documents are range-partitioned and sorted by id (null first; rows that repeat an id by a hash
    of the text).  A partition is written as shards of about ``shard_bytes`` of text: the documents' ids
    and token counts, each document's first symbol, the grammar's rules, the length each rule expands to,
    and the rewritten sequence (16 or 32 bits a symbol).  Null text is empty: the end id alone.
    ``added`` gives the tokenizer's added tokens their own ids (see ``Encoder``).
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    total = rows.count()

    def encode(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        if _state.get("encodes") != (tokenizer, added):
            _state["encoder"], _state["encodes"] = Encoder(tokenizer, added=added), (tokenizer, added)
        encoder, part, shard = _state["encoder"], TaskContext.get().partitionId(), 0
        if encoder.tokenizer.get_vocab_size() > base:
            raise ValueError(f"rules begin at {base}, among the tokenizer's ids")
        for batch in batches:
            data, offsets = string_buffers(batch.column(1))
            named = np.asarray(batch.column(0).is_valid())
            doc_ids = batch.column(0).fill_null(0).to_numpy()
            for lo, hi in slices(offsets, shard_bytes):
                # Smaller slices than shards: what encoding needs at once is some 40 bytes a byte of text.
                coded = [encoder.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in
                         ((lo + a, lo + b) for a, b in slices(offsets[lo : hi + 1], SLICE))]
                ids, sizes = (np.concatenate(parts_) for parts_ in zip(*coded, strict=True))
                del coded
                rules, sequence, firsts = repair(ids, np.concatenate([[0], np.cumsum(sizes)]), base)
                wide = base + len(rules) >= 1 << 16
                row = {
                    "part": part, "shard": shard, "doc_ids": doc_ids[lo:hi].astype(np.int64).tobytes(), "named": named[lo:hi].tobytes(),
                    "firsts": firsts.astype(np.uint32).tobytes(), "sizes": sizes.astype(np.uint32).tobytes(),
                    "rules": rules.astype(np.uint32).tobytes(), "spans": spans(rules, base).tobytes(), "wide": wide,
                    "sequence": sequence.astype(np.uint32 if wide else np.uint16).tobytes(),
                }
                shard += 1
                yield pa.RecordBatch.from_pylist([row], schema=_file_schema())

    ranged = rows.repartitionByRange(parts(docs.sparkSession, total, 20_000), "id", "h").sortWithinPartitions("id", "h")
    ranged.select("id", "text").mapInArrow(encode, FILE).write.mode("overwrite").parquet(path)


def _file_schema():
    import pyarrow as pa

    kinds = {"int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in FILE.split(", "))])


def read_token_file(shards: DataFrame, base: int = 50_257) -> DataFrame:
    """Documents of a token file: doc_id, start, n_tokens, ids_crc32 (of ids as little-endian 32 bits).

    ``start`` counts the ids of all documents before: totals of partitions and of shards in a partition
    are summed separately, so no task sees all shards.
    """
    from pyspark.sql.types import LongType

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            totals = [int(np.frombuffer(s, np.uint32).sum(dtype=np.int64)) for s in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(totals, pa.int64())], names=["part", "shard", "tokens"])

    totals = cut(shards.select("part", "shard", "sizes").mapInArrow(sizes, "part int, shard int, tokens long"))
    before = lambda w: F.coalesce(F.sum("tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    by_part = totals.groupBy("part").agg(F.sum("tokens").alias("tokens")).select("part", before(Window.orderBy("part")).alias("ahead"))
    begins = (
        totals.withColumn("inside", before(Window.partitionBy("part").orderBy("shard"))).join(by_part, "part")
        .select("part", "shard", (F.col("ahead") + F.col("inside")).cast(LongType()).alias("begin"))
    )

    def digest(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                rules = np.frombuffer(row["rules"], np.uint32).astype(np.int64).reshape(-1, 2)
                written, bounds = expansions(rules, base)
                sequence = np.frombuffer(row["sequence"], np.uint32 if row["wide"] else np.uint16).astype(np.int64)
                counts = np.frombuffer(row["sizes"], np.uint32).astype(np.int64)
                ids = decode(sequence, written, bounds, base)
                ends = np.concatenate([[0], np.cumsum(counts)])
                named = np.frombuffer(row["named"], bool)
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(row["doc_ids"], np.int64), mask=~named), pa.array(row["begin"] + ends[:-1]), pa.array(counts), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # A row a shard: while few they go to every task, and the shards themselves are not shuffled.
    return shards.join(small(begins, 200_000), ["part", "shard"]).mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_ids(shards: DataFrame, wanted: DataFrame, first: int = 0, count: int = 1 << 62, base: int = 50_257) -> DataFrame:
    """Random access: (doc_id, ids), ids ``first`` to ``first + count`` of the documents whose doc_id is in ``wanted``.

    The doc_ids of all shards are read, then the shards that hold a wanted document; there only its own symbols are
    looked at (``firsts``), and of those only the ones that the expansion lengths (``spans``) place in the
    range are written out.  Documents not in the file give no row, those that repeat an id one each; null is no document.
    """

    def listed(batches):
        import pyarrow as pa

        for batch in batches:
            for part, shard, ids, named in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                nth = np.flatnonzero(np.frombuffer(named, bool))
                ids = np.frombuffer(ids, np.int64)[nth]
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part] * len(nth), pa.int32()), "shard": pa.array([shard] * len(nth), pa.int32()),
                    "nth": pa.array(nth, pa.int64()), "doc_id": pa.array(ids),
                })

    def cut_out(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                rules = np.frombuffer(row["rules"], np.uint32).astype(np.int64).reshape(-1, 2)
                lengths = np.frombuffer(row["spans"], np.uint32).astype(np.int64)
                sequence = np.frombuffer(row["sequence"], np.uint32 if row["wide"] else np.uint16)
                firsts, doc_ids = np.frombuffer(row["firsts"], np.uint32).astype(np.int64), np.frombuffer(row["doc_ids"], np.int64)
                for nth in row["found"]:
                    symbols = sequence[firsts[nth] : firsts[nth + 1]].astype(np.int64)
                    ids = ids_between(symbols, rules, lengths, base, first, first + count)
                    yield pa.RecordBatch.from_pydict({"doc_id": pa.array([int(doc_ids[nth])]), "ids": pa.array([ids.astype(np.int64)], pa.list_(pa.int64()))})

    places = shards.select("part", "shard", "doc_ids", "named").mapInArrow(listed, "part int, shard int, nth long, doc_id long")
    asked = wanted.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    found = places.join(asked, "doc_id", "left_semi").groupBy("part", "shard").agg(F.collect_list("nth").alias("found"))
    columns = ["doc_ids", "firsts", "rules", "spans", "wide", "sequence", "found"]
    return shards.join(found, ["part", "shard"]).select(*columns).mapInArrow(cut_out, "doc_id long, ids array<long>")


def token_path(spark) -> str:
    """A fresh place for a token file in the shared checkpoint folder."""
    return f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
