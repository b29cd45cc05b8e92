"""Language-model scoring by deleted interpolation of n-gram estimates."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .classifiers import crc_of
from .common import LOWER, cut, mix64, pack, slices, span_hashes, string_buffers, unpack, word_spans

_END, _START = np.uint64(0xE4D0E4D0E4D0E4D1), np.uint64(0x57A2757A2757A275)
_BINS, _STEP = 241, 0.05  # probability grid of the sufficient statistics: decades of 0.05, the last bin is 0
_BUCKETS = 24  # context frequencies by powers of two
BLOCK = 8 << 20  # bytes of text that are counted and looked up together
RANGE = 32 << 20  # bytes of text whose n-grams a range of the hash sums


def _tokens(column) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every token of every text, an end after each, and the first token of each text (rows + 1)."""
    data, offsets = string_buffers(column)
    hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for lo, hi in slices(offsets, 1 << 20):
        part, local = LOWER[data[offsets[lo] : offsets[hi]]], offsets[lo : hi + 1] - offsets[lo]
        starts, ends, firsts = word_spans(part, local)
        hashes.append(np.insert(span_hashes(part, starts, ends), firsts[1:], _END))
        counts.append(np.diff(firsts) + 1)
    return np.concatenate(hashes), np.concatenate([[0], np.cumsum(np.concatenate(counts))])


def _gram_keys(tokens: np.ndarray, firsts: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1 .. order the key of the n-gram that ends at each token; starts of texts are padded."""
    keys, back = [mix64(tokens)], tokens
    joined = tokens
    for n in range(2, order + 1):
        back = np.concatenate([[_START], back[:-1]])
        back[firsts[:-1]] = _START
        joined = joined * np.uint64(0x9FB21C651E98DF25) + back
        keys.append(mix64(joined ^ np.uint64(n * 0x51ED2701)))
    return keys


def _bucket_bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in ascending keys: buckets are ranges of the hash."""
    edges = np.array([(b << 64) // buckets for b in range(buckets)], dtype=np.uint64)
    return np.append(np.searchsorted(keys, edges), len(keys))


def _estimates(counts: list[np.ndarray], firsts: np.ndarray, total: int, texts: int):
    """Maximum-likelihood estimates n = 1 .. order of each token, and its context's frequency."""
    estimates, context = [counts[0] / max(total, 1)], None
    for n in range(2, len(counts) + 1):
        context = np.concatenate([[0], counts[n - 2][:-1]]).astype(np.float64)
        context[firsts[:-1]] = texts
        estimates.append(np.where(context > 0, counts[n - 1] / np.maximum(context, 1), 0.0))
    if context is None:
        context = np.full(len(counts[0]), float(total))
    return estimates, np.minimum(np.floor(np.log2(context + 1)).astype(np.int64), _BUCKETS - 1)


def expectation_maximisation(bucket, estimates, times, rounds: int = 60) -> np.ndarray:
    """Mixture weights (buckets by estimates) that make the held-out counts likeliest."""
    weights = np.full((_BUCKETS, estimates.shape[1]), 1 / estimates.shape[1])
    for _ in range(rounds):
        share = weights[bucket] * estimates
        share *= (times / np.maximum(share.sum(1), 1e-300))[:, None]
        gathered = np.stack([np.bincount(bucket, share[:, k], _BUCKETS) for k in range(share.shape[1])], 1)
        seen = gathered.sum(1) > 0
        weights[seen] = gathered[seen] / gathered[seen].sum(1, keepdims=True)
    return np.maximum(weights, 1e-9) / np.maximum(weights, 1e-9).sum(1, keepdims=True)


def score_texts(
    docs: DataFrame, order: int = 2, folds: int = 10, held: int = 0, tuning: int = 1,
    id_col: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Log10 probability of every whole text under an interpolated n-gram model of the corpus.

    Texts whose ``crc32(id) mod folds`` is not ``held`` are learnt from.  Estimates of n = 1 .. ``order`` and a
    uniform floor ``1 / (V + 1)`` are mixed with weights that depend on the context's frequency (powers
    of two).  The weights come from expectation-maximisation on the counts of fold ``tuning``, held out from
    counts of the other folds; the final counts take in every learnable text.

    Counting and looking up is one exchange: blocks of texts (``BLOCK`` bytes; a longer text is one by itself) are
    packed and cut to the shared folder; each sends its distinct n-grams with its own counts to ranges of the hash,
    each range sums and answers with totals.  A message holds the n-grams of one block in one range and there is none
    where a block has none, so messages never outnumber a block's distinct n-grams: what moves grows with those,
    in proportion to the texts.  No vocabulary is gathered or broadcast.  The driver sees N, V, the number of texts,
    and held-out statistics on a fixed grid.  (A row for every distinct n-gram of a block instead of a
    packed message moves several times the bytes; the README has the figures.)

    One row per document: ``id_col``, held_out, n_tokens, n_known, train_tokens, base_score (add-0.1
    unigrams), score.  Null text counts as empty: one end token.  Rows with a null id are scored, never
    learnt from, and count as held out.  Repeated rows count each time.  Other columns are dropped.
    """
    import pyarrow as pa

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"), F.pmod(crc_of(id_col), F.lit(folds)).cast("int").alias("fold"))
    rows = rows.withColumn("fold", F.coalesce("fold", F.lit(held)))
    facts = rows.agg(
        F.count_if(F.col("fold") != held).alias("all"), F.count_if(F.col("fold") == tuning).alias("tune"),
        F.sum(F.octet_length("text")).alias("bytes"),
    ).first()
    buckets = max(1, -(-(facts.bytes or 0) // RANGE))
    block = pa.schema([("batch", pa.string()), ("tune", pa.bool_()), ("texts", pa.binary())])

    def gather(batches):
        import zstandard
        from pyspark import TaskContext

        name, nth = f"{TaskContext.get().partitionId()}.{TaskContext.get().taskAttemptId()}", 0
        for batch in batches:
            fold, (_, offsets) = batch.column(2).to_numpy(), string_buffers(batch.column(1))
            for tune in (False, True):
                mine = np.flatnonzero((fold == tuning) == tune)
                part = batch.take(pa.array(mine))
                for lo, hi in slices(np.concatenate([[0], np.cumsum(np.diff(offsets)[mine])]), BLOCK):
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, part.schema) as out:
                        out.write_batch(part.slice(lo, hi - lo))
                    packed = zstandard.ZstdCompressor(level=3).compress(sink.getvalue().to_pybytes())
                    nth += 1
                    yield pa.RecordBatch.from_pylist([{"batch": f"{name}.{nth}", "tune": tune, "texts": packed}], schema=block)

    def texts_of(blob):
        import zstandard

        return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(blob)).read_all()

    # Blocks are written once, so their names hold even if a task that made them ran twice.
    blocks = cut(rows.mapInArrow(gather, "batch string, tune boolean, texts binary"))
    ask_schema = pa.schema([
        ("kind", pa.int32()), ("bucket", pa.int32()), ("batch", pa.string()), ("tune", pa.bool_()),
        ("size", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()),
    ])

    def ask(batches):
        for batch in batches:
            for row in batch.to_pylist():
                table = texts_of(row["texts"])
                tokens, firsts = _tokens(table.column("text").combine_chunks())
                learnt = np.repeat(table.column("fold").to_numpy() != held, np.diff(firsts))
                for kind_, keys in enumerate(_gram_keys(tokens, firsts, order)):
                    distinct, which = np.unique(keys, return_inverse=True)
                    counts = np.bincount(which[learnt], minlength=len(distinct)).astype(np.uint32)
                    bounds = _bucket_bounds(distinct, buckets)
                    out = []
                    for b in np.flatnonzero(np.diff(bounds)):
                        keys_b, counts_b = distinct[bounds[b] : bounds[b + 1]], counts[bounds[b] : bounds[b + 1]]
                        steps = np.diff(keys_b, prepend=np.uint64(0))
                        out.append({
                            "kind": kind_, "bucket": int(b), "batch": row["batch"], "tune": row["tune"],
                            "size": len(keys_b), "keys": pack(steps), "counts": pack(counts_b),
                        })
                    yield pa.RecordBatch.from_pylist(out, schema=ask_schema)

    reply = pa.schema([("batch", pa.string()), ("tune", pa.bool_()), ("kind", pa.int32()), ("bucket", pa.int32()), ("total", pa.binary()), ("early", pa.binary()),
                       ("n", pa.int64()), ("v", pa.int64()), ("n0", pa.int64()), ("v0", pa.int64())])

    def answer(table):
        kind_, bucket = int(table.column("kind")[0].as_py()), int(table.column("bucket")[0].as_py())
        names, tune, sizes = table.column("batch").to_pylist(), table.column("tune").to_numpy(), table.column("size").to_numpy()
        keys = np.concatenate([np.cumsum(unpack(k, np.uint64), dtype=np.uint64) for k in table.column("keys").to_pylist()])
        counts = np.concatenate([unpack(c, np.uint32) for c in table.column("counts").to_pylist()]).astype(np.float64)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        distinct, which = np.unique(keys, return_inverse=True)
        total = np.bincount(which, counts, len(distinct)).astype(np.uint64)
        late = np.repeat(tune, sizes)
        early = np.bincount(which[~late], counts[~late], len(distinct)).astype(np.uint64)
        rows = []
        for i, (name, held_back) in enumerate(zip(names, tune.tolist(), strict=True)):
            mine = which[ends[i] : ends[i + 1]]
            answered = {"total": pack(total[mine]), "early": pack(early[mine]) if held_back else None}
            rows.append({"batch": name, "tune": held_back, "kind": kind_, "bucket": bucket, **answered})
        if kind_ == 0:
            rows.append({
                "kind": 0, "bucket": bucket, "n": int(total.sum()), "v": int((total > 0).sum()),
                "n0": int(early.sum()), "v0": int((early > 0).sum()),
            })
        return pa.Table.from_pylist(rows, schema=reply)

    asked = blocks.mapInArrow(ask, "kind int, bucket int, batch string, tune boolean, size long, keys binary, counts binary")
    answers = cut(asked.groupBy("kind", "bucket").applyInArrow(
        answer, "batch string, tune boolean, kind int, bucket int, total binary, early binary, n long, v long, n0 long, v0 long"))
    sums = answers.where("batch IS NULL").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "v", "n0", "v0")]).first()

    def looked_up(blocks_, replies, column: str):
        """The block's texts, their first tokens and, for n = 1 .. order, the count of the n-gram that ends at each token."""
        table = texts_of(blocks_.column("texts")[0].as_py())
        tokens, firsts = _tokens(table.column("text").combine_chunks())
        sorted_ = replies.sort_by([("kind", "ascending"), ("bucket", "ascending")])
        kinds, parts = sorted_.column("kind").to_numpy(), sorted_.column(column).to_pylist()
        counts = []
        for kind_, keys in enumerate(_gram_keys(tokens, firsts, order)):
            _, which = np.unique(keys, return_inverse=True)
            counts.append(np.concatenate([unpack(parts[i], np.uint64) for i in np.flatnonzero(kinds == kind_)]).astype(np.int64)[which])
        return table, firsts, counts

    def statistics(blocks_, replies):
        _, firsts, counts = looked_up(blocks_, replies, "early")
        estimates, bucket = _estimates(counts, firsts, sums.n0, facts["all"] - facts.tune)
        cell = bucket
        for p in estimates:
            bins = np.where(p > 0, np.minimum(np.rint(-np.log10(np.maximum(p, 1e-300)) / _STEP), _BINS - 2), _BINS - 1)
            cell = cell * _BINS + bins.astype(np.int64)
        cells, times = np.unique(cell, return_counts=True)
        return pa.table({"cell": pa.array(cells, pa.int64()), "times": pa.array(times, pa.int64())})

    held_counts = (
        blocks.where("tune").groupBy("batch").cogroup(answers.where("tune").groupBy("batch"))
        .applyInArrow(statistics, "cell long, times long").groupBy("cell").agg(F.sum("times").alias("times")).toPandas()
    )
    cells, grid = held_counts["cell"].to_numpy().astype(np.int64), []
    for _ in range(order):
        bins = cells % _BINS
        grid.insert(0, np.where(bins < _BINS - 1, 10.0 ** (-bins * _STEP), 0.0))
        cells = cells // _BINS
    floor0 = np.full(len(cells), 1 / (sums.v0 + 1))
    weights = expectation_maximisation(cells, np.stack([floor0, *grid], 1), held_counts["times"].to_numpy().astype(float))

    def score(blocks_, replies):
        table, firsts, counts = looked_up(blocks_, replies, "total")
        estimates, bucket = _estimates(counts, firsts, sums.n, facts["all"])
        mixed = weights[bucket, 0] / (sums.v + 1)
        for k, p in enumerate(estimates):
            mixed += weights[bucket, k + 1] * p
        per_text = lambda x: np.add.reduceat(x, firsts[:-1])  # noqa: E731  every text has its end token
        base = np.log10((counts[0] + 0.1) / (sums.n + 0.1 * (sums.v + 1)))
        return pa.table({
            "id": table.column("id"), "held_out": pa.array(table.column("fold").to_numpy() == held),
            "n_tokens": pa.array(np.diff(firsts)), "n_known": pa.array(per_text((counts[0] > 0).astype(np.int64))),
            "train_tokens": pa.array(np.full(len(firsts) - 1, sums.n)), "base_score": pa.array(per_text(base)),
            "score": pa.array(per_text(np.log10(mixed))),
        })

    scored = (
        blocks.groupBy("batch", "tune").cogroup(answers.where("batch IS NOT NULL").groupBy("batch", "tune"))
        .applyInArrow(score, f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    )
    return scored.withColumnRenamed("id", id_col)
