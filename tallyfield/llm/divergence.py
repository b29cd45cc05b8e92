"""How far the sources of each language lie apart: exact divergences of term shares, from dense blocks of terms."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import LOWER, cut, release, slices, small, stored, string_buffers

SCALE = 1_000_000_000
_SLICE = 8 << 20  # bytes of text counted at once
_STRIP = 1 << 20  # differences held at once
_TERM = np.zeros(256, bool)  # bytes of a term: letters of ASCII and all of other code points
_TERM[65:91] = _TERM[97:123] = _TERM[128:] = True


def terms_of(data: np.ndarray, offsets: np.ndarray):
    """All terms of some texts, lower-cased, as one Arrow array, and the row of each."""
    import pyarrow as pa

    inside = _TERM[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True  # no term goes on into the next text
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    sizes = np.flatnonzero(inside & (~after | edge[1:])) + 1 - starts
    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    letters = LOWER[data[inside]]
    terms = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(letters))
    return terms, np.searchsorted(offsets, starts, side="right") - 1


def _counted(batches):
    """Counts of each term, and of the documents that hold it, by language and source; a row without a term for each group."""
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        named = [pc.fill_null(batch.column(i), "").dictionary_encode() for i in (0, 1)]
        langs, sources = (np.asarray(c.indices).astype(np.int64) for c in named)
        width = max(len(named[1].dictionary), 1)
        group = langs * width + sources
        data, offsets = string_buffers(batch.column(2))

        def rows(groups, terms, counts, docs, named=named, width=width):
            return pa.RecordBatch.from_arrays([
                named[0].dictionary.take(pa.array(groups // width)), named[1].dictionary.take(pa.array(groups % width)),
                terms.cast(pa.string()), pa.array(counts, pa.int64()), pa.array(docs, pa.int64()),
            ], names=["lang", "source", "term", "count", "docs"])

        for lo, hi in slices(offsets, _SLICE):
            here = np.unique(group[lo:hi])
            nothing = np.zeros(len(here), np.int64)
            yield rows(here, pa.nulls(len(here), pa.string()), nothing, nothing)
            terms, row = terms_of(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            if not len(terms):
                continue
            coded = terms.dictionary_encode()
            size = len(coded.dictionary)
            code = np.asarray(coded.indices).astype(np.int64)
            code += row * size
            code, times = np.unique(code, return_counts=True)  # a row for each document and term
            key, inverse, docs = np.unique(group[lo:hi][code // size] * size + code % size, return_inverse=True, return_counts=True)
            counts = np.bincount(inverse, weights=times).astype(np.int64)
            yield rows(key // size, coded.dictionary.take(pa.array(key % size)), counts, docs)
    release()


def share(counts: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(10^9 * counts / total), exactly, for counts up to total and totals under 9 * 10^15: long division, three digits a step."""
    out, rest = np.zeros_like(counts), counts
    for _ in range(3):
        rest = rest * 1000
        digits = rest // total
        rest = rest - digits * total
        out = out * 1000 + digits
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _tiles(top: int):
    """Of one block of terms and two chunks of groups: a partial pair matrix, and the best terms of each group."""

    def tile(key, left, right):
        import pyarrow as pa

        lang, a, b = key[0].as_py(), key[2].as_py(), key[3].as_py()
        if not right.num_rows:  # no group of these chunks: cannot be, every group meets every block
            return _tile_rows(pa, lang, [])
        right = right.sort_by("nth")
        names, nth = right["source"].to_pylist(), right["nth"].to_numpy()
        n, terms_all, whole = (right[c].to_numpy() for c in ("n", "terms", "lang_n"))
        terms_all, whole = int(terms_all[0]), int(whole[0])
        first, second = (np.flatnonzero(right["chunk"].to_numpy() == c) for c in (a, b))
        coded = left["term"].combine_chunks().dictionary_encode()
        words = coded.dictionary
        order = np.asarray(pa.compute.sort_indices(words))  # ascending by bytes, so that ties fall to the smaller term
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        at = rank[np.asarray(coded.indices)] if left.num_rows else np.zeros(0, np.int64)
        counts = np.zeros((len(nth), len(order)), np.int64)
        counts[np.searchsorted(nth, left["nth"].to_numpy()), at] = left["count"].to_numpy()
        total = np.zeros(len(order), np.int64)
        total[at] = left["total"].to_numpy()
        out: list[tuple] = []
        if terms_all:
            under = n + 2 * terms_all
            p = share(counts + 2, under[:, None])
            base = share(np.full(len(nth), 2, np.int64), under)  # the share of a term that a group lacks
        else:
            p, base = counts, np.ones(len(nth), np.int64)
        x, y = p[first], p[second]
        sums = np.zeros((len(first), len(second)), np.int64)
        step = max(1, _STRIP // max(1, sums.size))
        for s in range(0, len(order), step):
            sums += divergence(x[:, None, s : s + step], y[None, :, s : s + step]).sum(axis=2)
        rest = divergence(base[first][:, None], base[second][None, :])
        for i, g in enumerate(first.tolist()):
            for j, h in enumerate(second.tolist()):
                if g != h:
                    value, absent = int(sums[i, j]), int(rest[i, j])
                    out.append((names[g], "pair", names[h], value, len(order), absent))
                    if a != b:
                        out.append((names[h], "pair", names[g], value, len(order), absent))
        if a == b and len(order):
            q = share(total + 2, whole + 2 * terms_all)
            for g in range(len(nth)):
                there = np.flatnonzero((counts[g] > 0) & (p[g] > q))
                value = divergence(p[g][there], q[there])
                for k in np.argsort(-value, kind="stable")[:top]:
                    out.append((names[g], "term", words[int(order[there[k]])].as_py(), int(value[k]), 0, 0))
        return _tile_rows(pa, lang, out)

    return tile


def _tile_rows(pa, lang: str, out: list[tuple]):
    columns = list(zip(*out, strict=True)) if out else [()] * 6
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    names = ["source", "part", "item", "value", "present", "absent"]
    return pa.table({"lang": pa.array([lang] * len(out), pa.string())} | {n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)})


def source_divergence(
    docs: DataFrame, least: int = 10, top: int = 10, block: int = 4096, chunk: int = 64,
    text: str = "text", lang: str = "lang", source: str = "source",
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): how each source differs from the others of its language, and in which terms.

    Terms are runs of ASCII letters (lower-cased) and of code points beyond ASCII; a language keeps those in at least ``least``
    of its documents.  A group's share of a term is p = 1 + floor(10^9 (count + 2) / (N + 2 V)) of its N kept terms out of V; the
    divergence of two shares is floor((p - q)^2 / (p + q)).  Part ``pair``: the sum over all kept terms for each other source.  Part
    ``term``: the ``top`` terms in which the group exceeds its language most.  Ranks follow value, then the item's bytes.

    Null text, lang and source are ''; a group without terms counts none of any term; a language without kept terms has values of 0; a
    language with one source has no pairs; an empty table gives no rows.  Other columns are not read.

    One scan counts terms in Arrow batches, and sums go ahead of the shuffle.  A block of about ``block`` terms and two chunks of ``chunk``
    groups meet as one dense tile of int64, whatever their number, so no task holds a language or a hot source; pairs are taken
    within a tile in strips of a million differences, partial matrices are summed and best terms merged in Spark.
    """
    read = docs.select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text"))
    schema = "lang string, source string, term string, count long, docs long"
    counts = read.mapInArrow(_counted, schema).groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    w = Window.partitionBy("lang", "term")
    summed = counts.select(
        "lang", "source", "term", "count", F.sum("count").over(w).alias("total"), F.sum("docs").over(w).alias("in_docs"),
        (F.col("term").isNotNull() & (F.min("source").over(w) == F.col("source"))).alias("leads"),
    )
    kept = stored(summed.where(F.col("term").isNull() | (F.col("in_docs") >= least)).drop("in_docs"))
    by_group = kept.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    by_lang = kept.groupBy("lang").agg(F.sum("count").alias("lang_n"), F.count_if("leads").alias("terms"), F.count_if(F.col("term").isNull()).alias("groups"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1
    blocks = F.greatest(F.lit(1), F.ceil(F.col("terms") / block)).cast("long")
    chunks = F.ceil(F.col("groups") / chunk).cast("long")
    info = cut(
        by_group.join(by_lang, "lang")
        .select("lang", "source", "n", "lang_n", "terms", nth.alias("nth"), blocks.alias("blocks"), chunks.alias("chunks"))
        .withColumn("chunk", F.floor(F.col("nth") / chunk))
    )

    def dealt(df: DataFrame) -> DataFrame:
        """Every row once for each chunk that its own chunk meets."""
        met = df.withColumn("met", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        return met.withColumns({"a": F.least("chunk", "met"), "b": F.greatest("chunk", "met")})

    placed = small(info.select("lang", "source", "nth", "blocks", "chunks", "chunk"), 200_000)
    cells = dealt(kept.where("term IS NOT NULL").join(placed, ["lang", "source"]).withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks"))))
    groups = dealt(info.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))))
    keys = ["lang", "block", "a", "b"]
    tiles = cut(
        cells.select(*keys, "nth", "term", "count", "total").groupBy(*keys)
        .cogroup(groups.select(*keys, "nth", "source", "chunk", "n", "lang_n", "terms").groupBy(*keys))
        .applyInArrow(_tiles(top), "lang string, source string, part string, item string, value long, present long, absent long")
    )
    langs = small(info.select("lang", "terms").distinct(), 200_000)
    pairs = (
        tiles.where("part = 'pair'").groupBy("lang", "source", "part", "item")
        .agg(F.sum("value").alias("value"), F.sum("present").alias("present"), F.max("absent").alias("absent"))
        .join(langs, "lang").withColumn("value", F.col("value") + (F.col("terms") - F.col("present")) * F.col("absent"))
    )
    best = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    columns = ["lang", "source", "part", "item", "value"]
    ranked = lambda df: df.select(*columns, F.row_number().over(best).alias("rank"))
    return ranked(pairs).union(ranked(tiles.where("part = 'term'")).where(F.col("rank") <= top))
