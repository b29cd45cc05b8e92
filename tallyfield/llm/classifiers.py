"""Toxicity by non-negative positive-unlabelled learning, quality by nearest-neighbour voting."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, cut, pack, release, slices, span_hashes, stored, string_buffers, unpack, word_spans

_SLICE, _ROWS = 1 << 20, 512


def crc_of(id_col: str) -> Column:
    """Unsigned crc32 of the id as decimal text."""
    return F.crc32(F.col(id_col).cast("string"))


# ---------------------------------------------------------------- toxicity

TOXIC_BITS = 20
CLEAR = 5.5  # standard errors by which a feature's document frequencies must differ


WINDOW = 5
DECAY = 0.06  # weight of the squared weights in the risk, over the root of the number of positives, as a mean's deviation is


def _windows(data: np.ndarray) -> np.ndarray:
    """Hash of the ``WINDOW`` lower-cased bytes from each position on, to ``TOXIC_BITS`` bits: they run across words."""
    padded = np.concatenate([LOWER[data], np.full(WINDOW, 32, np.uint8)]).astype(np.uint32)
    h = np.zeros(len(data), np.uint32)
    for k in range(WINDOW):
        h = h * np.uint32(0x01000193) + padded[k : k + len(data)] + np.uint32(1)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return h >> np.uint32(32 - TOXIC_BITS)


def _separated(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The batch with a space before every row and spaces after it, the new offsets, and where a window begins inside a row.

    Windows that begin in the spaces after a row are no features of it, and none reaches the next row's text.
    """
    n = len(offsets) - 1
    spaced = np.insert(data, np.concatenate([offsets[:-1], np.repeat(offsets[1:], WINDOW - 1)]), 32)
    bounds = offsets + np.arange(n + 1) * WINDOW
    inside = np.ones(len(spaced), bool)
    inside[(bounds[1:, None] - np.arange(1, WINDOW)).ravel()] = False
    return spaced, bounds, inside


def _present(column, place: np.ndarray, width: int):
    """For each slice: first row, rows, and the distinct (row, feature) pairs of the placed features."""
    data, offsets = string_buffers(column)
    for lo, hi in slices(offsets, _SLICE):
        part, local, inside = _separated(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        feature = place[_windows(part)]
        at = np.flatnonzero((feature >= 0) & inside)
        row = np.searchsorted(local, at, side="right") - 1
        pair = np.unique(row.astype(np.int64) * width + feature[at])
        yield lo, hi - lo, pair // width, pair % width


def fit_nnpu(rows, features, positive, unlabelled, width, prior, steps=400, rate=0.05, decay=1e-4):
    """Linear logistic classifier minimising the non-negative positive-unlabelled risk.

    Risk: ``prior * E_p[l(+g)] + max(0, E_u[l(-g)] - prior * E_p[l(-g)])``.  While the corrected negative
    part is below zero, a step goes up along it instead, as in the published algorithm.
    """
    n, blocks = len(positive), [slice(lo, lo + (1 << 18)) for lo in range(0, len(rows), 1 << 18)]  # bounds what a step needs at once
    w, b = np.zeros(width), float(np.log(prior / (1 - prior)))

    def summed(by, of, values, size):
        out = np.zeros(size)
        for part in blocks:
            out += np.bincount(by[part], values[of[part]], size)
        return out

    first, second = np.zeros(width + 1), np.zeros(width + 1)
    n_p, n_u = max(positive.sum(), 1), max(unlabelled.sum(), 1)
    for step in range(1, steps + 1):
        g = np.clip(summed(rows, features, w, n) + b, -60, 60)
        sig = 1 / (1 + np.exp(-g))
        minus = np.log1p(np.exp(g))
        negative = minus[unlabelled].mean() - prior * minus[positive].mean()
        down = sig * unlabelled / n_u - prior * sig * positive / n_p
        pull = down - prior * (1 - sig) * positive / n_p if negative >= 0 else -down
        grad = np.append(summed(features, rows, pull, width) + decay * w, pull.sum())
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def toxicity(
    docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, positives: int = 4000, features: int = 2048,
    prior: float | None = None, decay: float = DECAY, passes: int = 40, threshold: float = 0.5,
    id_col: str = "doc_id", text: str = "text", label: str = "toxic",
) -> DataFrame:
    """Every input column with ``held_out``, ``score`` (0 to 1) and ``predicted``.

    Positive-unlabelled learning: confirmed toxic examples (label 1, at most ``positives`` documents, chosen by a hash of the id)
    against the whole corpus as unlabelled text: all documents, with a label or without, whose label is not looked at.
    Both are outside the fold ``held`` of ``crc32(id) mod folds``.  Features are presences of lower-cased five-byte windows inside
    a text; the ``features`` with the most different document frequencies among positives and the corpus are kept.  The
    non-negative risk (``fit_nnpu``) is minimised over all of them: equal feature sets are one row with a count, and each of at most
    ``passes`` evaluations sums loss and gradient over that table in Spark.

    The class prior is ``prior`` if given, else the toxic share of the learnable labels if they name both classes, else it is
    estimated from positives and corpus alone (``_estimated_prior``).  Whole texts are scored; a text's score does not
    depend on other rows but through what is learnt.

    Null text scores as empty.  Rows with a null id are scored, never learnt from, and not held out.  An id
    with several labels is toxic if one of them says so.  Without a positive example the score is the prior.
    Input columns with one of the added names are replaced.
    """
    learn = F.coalesce(F.pmod(crc_of(id_col), F.lit(folds)) != held, F.lit(False))
    truth = (
        labels.where(learn & F.col(label).isNotNull()).groupBy(F.col(id_col).alias("_id"))
        .agg(F.max((F.col(label) == 1).cast("int")).alias("_toxic"))
    )
    share = truth.agg(F.avg("_toxic")).first()[0] or 0.0
    picked = truth.where("_toxic = 1").orderBy(F.xxhash64("_id", F.lit(23)), "_id").limit(positives).select("_id")
    corpus = docs.where(learn).select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    # At most ``positives`` ids: a bound given by a parameter, so a broadcast is safe.
    known = cut(corpus.join(F.broadcast(picked), "_id").dropDuplicates(["_id"]).orderBy("_id").select("_text"))
    if prior is None and (share < 1 or known.isEmpty()):
        prior = share
    weights, bias = _fit_toxicity(known, corpus.select("_text"), prior, features, decay, passes)
    added = F.coalesce(F.pmod(crc_of(id_col), F.lit(folds)) == held, F.lit(False))
    scored = _scored(docs.drop("score"), text, _toxicity_scores(weights, bias))
    return scored.withColumn("held_out", added).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def _frequencies(texts: DataFrame) -> DataFrame:
    """In how many texts each feature is present: (f, n).  A task gives its sums as packed stretches of all features."""
    everything, stretch = np.arange(1 << TOXIC_BITS), 1 << (TOXIC_BITS - 6)

    def count(batches):
        import pyarrow as pa

        total = np.zeros(1 << TOXIC_BITS, np.int64)
        for batch in batches:
            for _, _, _, found in _present(batch.column(0), everything, 1 << TOXIC_BITS):
                total += np.bincount(found, minlength=1 << TOXIC_BITS)
        parts = total.reshape(-1, stretch)
        has = np.flatnonzero(parts.any(1))
        yield pa.RecordBatch.from_pydict({"part": pa.array(has, pa.int64()), "sums": pa.array([pack(parts[k]) for k in has.tolist()], pa.binary())})
        release()

    def added(key, table):
        import pyarrow as pa

        total = np.sum([unpack(blob, np.int64) for blob in table["sums"].to_pylist()], axis=0)
        at = np.flatnonzero(total)
        return pa.table({"f": key[0].as_py() * stretch + at, "n": total[at]})

    return texts.mapInArrow(count, "part long, sums binary").groupBy("part").applyInArrow(added, "f long, n long")


def _feature_sets(texts: DataFrame, place: np.ndarray, width: int) -> DataFrame:
    """Distinct sets of the placed features with the number of texts that have them: (f as packed 16 bits, n)."""

    def project(batches):
        import pyarrow as pa

        for batch in batches:
            for _, n, rows, found in _present(batch.column(0), place, width):
                ends = np.searchsorted(rows, np.arange(n + 1))
                packed = [found[a:b].astype(np.int16).tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], names=["f"])
        release()

    return texts.mapInArrow(project, "f binary").groupBy("f").agg(F.count("*").alias("n"))


def _flat(sets) -> tuple[np.ndarray, np.ndarray]:
    """Rows and features of packed sets, one after the other."""
    found = [np.frombuffer(f, np.int16) for f in sets]
    rows = np.repeat(np.arange(len(found), dtype=np.int64), [len(f) for f in found])
    return rows, np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64)


def _summed(sets: DataFrame, wanted, size: int, spread: int = 16) -> np.ndarray:
    """Sum of ``wanted(rows, features, counts)``, arrays of ``size``, over all batches of a table of feature sets.

    Tasks' sums are added up in ``spread`` groups first, so that few arrays reach the driver however many tasks there are.
    """

    def partial(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        total = np.zeros(size)
        for batch in batches:
            total += wanted(*_flat(batch.column(0).to_pylist()), batch.column(1).to_numpy().astype(np.float64))
        yield pa.RecordBatch.from_pydict({"g": pa.array([TaskContext.get().partitionId() % spread], pa.int32()), "v": pa.array([total.tobytes()], pa.binary())})

    def added(key, table):
        import pyarrow as pa

        total = np.sum([np.frombuffer(v) for v in table["v"].to_pylist()], axis=0)
        return pa.table({"v": pa.array([total.tobytes()], pa.binary())})

    sums = sets.mapInArrow(partial, "g int, v binary").groupBy("g").applyInArrow(added, "v binary").collect()
    return np.sum([np.frombuffer(r.v) for r in sums], axis=0) if sums else np.zeros(size)


def nnpu_risk(theta, known: tuple[np.ndarray, np.ndarray, np.ndarray], unlabelled, total: float, prior: float, decay: float):
    """The non-negative risk at ``theta`` (weights and bias) and its gradient.

    ``known``: rows, features and counts of the positives' sets; ``unlabelled(theta)`` gives the corpus's summed loss as negatives
    and its gradient, of ``total`` texts.  Where the corrected negative part is below zero it counts as zero.
    """
    rows, features, counts = known
    g = np.clip(np.bincount(rows, theta[features], len(counts)) + theta[-1], -60, 60)
    sig, n_p = 1 / (1 + np.exp(-g)), counts.sum()
    back = lambda pull: np.append(np.bincount(features, pull[rows], len(theta) - 1), pull.sum())
    u = unlabelled(theta) / total
    negative = u[0] - prior * (counts * np.log1p(np.exp(g))).sum() / n_p
    value, grad = prior * (counts * np.log1p(np.exp(-g))).sum() / n_p, back(-prior * (1 - sig) * counts / n_p)
    if negative >= 0:
        value, grad = value + negative, grad + u[1:] + back(-prior * sig * counts / n_p)
    shrunk = np.append(theta[:-1], 0.0)
    return value + decay / 2 * float(shrunk @ shrunk), grad + decay * shrunk


def minimise(risk, theta: np.ndarray, passes: int, memory: int = 8, enough: float = 1e-6) -> np.ndarray:
    """Limited-memory BFGS with halved steps; at most ``passes`` evaluations of ``risk`` (value, gradient)."""
    value, grad = risk(theta)
    used, moves = 1, []
    while used < passes and np.abs(grad).max() > enough:
        q, scales = grad.copy(), []
        for s, y in reversed(moves):
            scales.append(float(s @ q) / float(s @ y))
            q -= scales[-1] * y
        if moves:
            q *= float(moves[-1][0] @ moves[-1][1]) / float(moves[-1][1] @ moves[-1][1])
        else:
            q /= max(np.linalg.norm(grad), 1e-12)
        for (s, y), a in zip(moves, reversed(scales), strict=True):
            q += s * (a - float(y @ q) / float(s @ y))
        step = 1.0
        while True:
            tried = theta - step * q
            new, slope = risk(tried)
            used += 1
            if new <= value - 1e-4 * step * float(grad @ q) or used >= passes:
                break
            step /= 2
        if new >= value:
            break
        if float((tried - theta) @ (slope - grad)) > 1e-14:
            moves = [*moves, (tried - theta, slope - grad)][-memory:]
        done = value - new < enough * abs(value)
        theta, value, grad = tried, new, slope
        if done:
            break
    return theta


def _negatives(sets: DataFrame, width: int):
    """The corpus's part of the risk: summed loss as negatives and its gradient, at any weights."""

    def at(theta: np.ndarray) -> np.ndarray:
        def wanted(rows, features, counts):
            g = np.clip(np.bincount(rows, theta[features], len(counts)) + theta[-1], -60, 60)
            pull = counts / (1 + np.exp(-g))
            return np.concatenate([[(counts * np.log1p(np.exp(g))).sum()], np.bincount(features, pull[rows], width), [pull.sum()]])

        return _summed(sets, wanted, width + 2)

    return at


def _estimated_prior(known, sets: DataFrame, total: float, width: int, decay: float, passes: int, guess: float = 0.05) -> float:
    """The toxic share of the corpus, from positives and corpus alone.

    A classifier learnt from every other positive ranks the rest and the corpus.  Above any cut at least as large a share
    of the corpus lies as ``prior`` times that of the positives, so the smallest ratio of the two bounds it; both shares are
    taken a standard deviation to the side that makes the ratio larger, which sees to cuts with few texts above them.
    """
    rows, features, counts = known
    if len(counts) < 4:
        return guess
    even = np.arange(len(counts)) % 2 == 0
    mine = even[rows]
    part = (np.cumsum(even)[rows[mine]] - 1, features[mine], counts[even])
    start = np.append(np.zeros(width), np.log(guess / (1 - guess)))
    theta = minimise(lambda t: nnpu_risk(t, part, _negatives(sets, width), total, guess, decay), start, passes)
    own = np.sort((np.bincount(rows, theta[features], len(counts)) + theta[-1])[~even])
    cuts = np.unique(np.quantile(own, np.linspace(0, 0.75, 31)))

    def above(rows, features, counts):
        g = np.bincount(rows, theta[features], len(counts)) + theta[-1]
        return (counts[:, None] * (g[:, None] >= cuts[None] - 1e-9)).sum(0)

    over = _summed(sets, above, len(cuts))
    share_p = (own[None] >= cuts[:, None] - 1e-9).mean(1)
    surely = share_p - np.sqrt(share_p * (1 - share_p) / len(own))
    return float(np.min((over + np.sqrt(over) + 1) / total / surely))


def _fit_toxicity(known: DataFrame, corpus: DataFrame, prior: float | None, width: int, decay: float, passes: int) -> tuple[np.ndarray, float]:
    """Weights of all features, and the bias."""
    inside = lambda share: min(max(share, 1e-6), 1 - 1e-6)
    size_p, size_u = known.count(), corpus.count()
    decay /= max(size_p, 1) ** 0.5
    if not size_p:
        return np.zeros(1 << TOXIC_BITS, np.float32), float(np.log(inside(prior) / (1 - inside(prior))))
    counted = _frequencies(known).withColumnRenamed("n", "p").join(_frequencies(corpus).withColumnRenamed("n", "u"), "f", "full").na.fill(0)
    share_u, share_p = F.col("u") / size_u, F.col("p") / size_p
    apart = F.abs(share_p - share_u) / F.sqrt(F.greatest(share_u * (1 - share_u), F.lit(1e-9)) / size_p + 1e-6)
    best = counted.where("p + u >= 5").withColumn("apart", apart).where(F.col("apart") > CLEAR).orderBy(F.desc("apart"), "f").limit(width).select("f").collect()
    place = np.full(1 << TOXIC_BITS, -1, np.int32)
    place[[r.f for r in best]] = np.arange(len(best))
    width = max(len(best), 1)
    sets, few = stored(_feature_sets(corpus, place, width)), _feature_sets(known, place, width).orderBy("f").toPandas()
    toxic = (*_flat(few["f"]), few["n"].to_numpy(np.float64))
    if prior is None:
        prior = _estimated_prior(toxic, sets, size_u, width, decay, passes)
    start = np.append(np.zeros(width), np.log(inside(prior) / (1 - inside(prior))))
    theta = minimise(lambda t: nnpu_risk(t, toxic, _negatives(sets, width), size_u, inside(prior), decay), start, passes)
    weights = np.zeros(1 << TOXIC_BITS, np.float32)
    weights[[r.f for r in best]] = theta[: len(best)]
    return weights, float(theta[-1])


def _toxicity_scores(weights: np.ndarray, bias: float):
    used = np.flatnonzero(weights)
    place = np.full(len(weights), -1, np.int32)
    place[used] = np.arange(len(used))
    value = weights[used].astype(np.float64)

    def scores(column) -> np.ndarray:
        out = [np.zeros(0)]
        for _, n, rows, found in _present(column, place, max(len(used), 1)):
            out.append(np.bincount(rows, value[found], n) + bias)
        return 1 / (1 + np.exp(-np.clip(np.concatenate(out), -60, 60)))

    return scores


def _scored(docs: DataFrame, text: str, scores) -> DataFrame:
    """``docs`` with a column ``score`` computed from the whole text, batch by batch."""

    @F.arrow_udf("double")
    def score(texts):
        import pyarrow as pa

        scored = pa.array(scores(texts), pa.float64())
        release()
        return scored

    return docs.withColumn("score", score(F.col(text)))


# ---------------------------------------------------------------- quality

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123], _SHAPE[128:], _SHAPE[65:91], _SHAPE[48:58], _SHAPE[9:14] = 97, 97, 65, 48, 10
SHAPES, WORDS = 1 << 12, 1 << 12  # hashed three-byte shapes, hashed lower-cased words
TERMS = SHAPES + WORDS + 1


def _term_rates(column):
    """For each slice: rows by ``TERMS`` terms, log(1 + rate).

    Terms are three neighbouring byte shapes (lower-case letter, capital, digit, line end, any other
    byte itself) a thousand bytes, lower-cased words a thousand words (half weight), and words that repeat the word before
    them, a thousand words.
    """
    data, offsets = string_buffers(column)
    for lo, hi in slices(offsets, _SLICE, _ROWS):
        part, local = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        n, sizes = hi - lo, np.diff(local)
        q = np.concatenate([_SHAPE[part], np.full(2, 32, np.uint8)]).astype(np.uint32)
        h = ((q[:-2] * np.uint32(0x01000193) + q[1:-1]) * np.uint32(0x01000193) + q[2:])[: len(part)]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        shape = (h >> np.uint32(20)).astype(np.int32)
        starts, ends, firsts = word_spans(part, local)
        words, count = span_hashes(LOWER[part], starts, ends), np.diff(firsts)
        word = (words >> np.uint64(52)).astype(np.int32)
        out = np.empty((n, TERMS), np.float32)
        for r in range(n):
            out[r, :SHAPES] = np.bincount(shape[local[r] : max(local[r], local[r + 1] - 2)], minlength=SHAPES)
            out[r, SHAPES : SHAPES + WORDS] = np.bincount(word[firsts[r] : firsts[r + 1]], minlength=WORDS)
        owner = np.repeat(np.arange(n), count)
        again = np.zeros(len(words), bool)
        again[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
        out[:, -1] = np.bincount(owner[again], minlength=n)
        out[:, :SHAPES] *= 1000 / np.maximum(sizes, 1)[:, None]
        out[:, SHAPES:] *= 1000 / np.maximum(count, 1)[:, None]
        np.log1p(out, out=out)
        out[:, SHAPES:-1] *= 0.5  # words tell topics apart first: shapes weigh more
        yield out


def latent_space(terms: np.ndarray, dims: int, seed: int = 1) -> np.ndarray:
    """Weighted projection (terms by dims): inverse document frequency, then a truncated SVD by subspace iteration."""
    seen = np.count_nonzero(terms, axis=0)
    idf = np.where(seen > 0, np.log((1 + len(terms)) / (1 + seen)) + 1, 0).astype(np.float32)
    # Rows are weighted and scaled to length one inside the products: the driver holds the table once.
    norms = np.array([np.linalg.norm(row * idf) for row in terms], np.float32)
    scale = (1 / np.maximum(norms, 1e-9))[:, None]
    forth = lambda basis: (terms @ (idf[:, None] * basis)) * scale
    back = lambda y: idf[:, None] * (terms.T @ (y * scale))
    basis = np.random.default_rng(seed).standard_normal((terms.shape[1], dims + 16)).astype(np.float32)
    for _ in range(6):
        basis, _ = np.linalg.qr(back(forth(basis)))
    _, _, vt = np.linalg.svd(forth(basis), full_matrices=False)
    return (idf[:, None] * (basis @ vt[:dims].T)).astype(np.float32)


def _project(terms: np.ndarray, space: np.ndarray) -> np.ndarray:
    z = terms @ space
    return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)


def quality(
    docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, examples: int = 3000, dims: int = 32, neighbours: int = 9,
    threshold: float = 0.7, id_col: str = "doc_id", text: str = "text", label: str = "quality",
) -> DataFrame:
    """Every input column with ``held_out``, ``score`` (0 to 1) and ``predicted``.

    Nearest-neighbour voting: at most ``examples`` labelled documents outside the fold ``held`` of
    ``crc32(id) mod folds`` (chosen by a hash of the id) become latent-semantic vectors of ``dims`` numbers: a
    truncated SVD of their words and byte shapes.  They are a bounded table sent to every task.  Each document is
    projected likewise, its cosines with all examples are computed in blocks, and its ``neighbours`` nearest
    vote with the fourth power of their similarity; equally near ones are taken in the order of their ids.

    Null text scores as empty.  A text near no example (an empty one) scores the examples' mean, and 0.5
    where there are no examples.  Rows with a null id are scored, never learnt from, and not held out.
    Of several labels of an id the smallest counts.  Input columns with an added name are replaced.
    """
    learn = F.coalesce(F.pmod(crc_of(id_col), F.lit(folds)) != held, F.lit(False))
    truth = (
        labels.where(learn & F.col(label).isNotNull()).groupBy(F.col(id_col).alias("_id"))
        .agg(F.min((F.col(label) == 1).cast("int")).alias("_good"))
        .orderBy(F.xxhash64("_id", F.lit(29)), "_id").limit(examples)
    )
    sample = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(truth), "_id").dropDuplicates(["_id"])

    def terms(batches):
        import pyarrow as pa

        for batch in batches:
            lo = 0
            for x in _term_rates(batch.column(1)):
                at = [np.flatnonzero(r).astype(np.int16) for r in x]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(x)), pa.array([a.tobytes() for a in at], pa.binary()),
                     pa.array([r[a].tobytes() for r, a in zip(x, at, strict=True)], pa.binary())], names=["good", "at", "rate"],
                )
                lo += len(x)

    table = sample.orderBy("_id").select("_good", "_text").mapInArrow(terms, "good int, at binary, rate binary").toPandas()
    x = np.zeros((len(table), TERMS), np.float32)
    for r, (at, rate) in enumerate(zip(table["at"], table["rate"], strict=True)):
        x[r, np.frombuffer(at, np.int16)] = np.frombuffer(rate, np.float32)
    good = table["good"].to_numpy().astype(np.float32)
    del table
    space = latent_space(x, min(dims, max(len(x), 1))) if len(x) else np.zeros((TERMS, 1), np.float32)
    examples_z, usual = _project(x, space), float(good.mean()) if len(good) else 0.5
    del x
    k = min(neighbours, len(good))

    def scores(column) -> np.ndarray:
        out = [np.zeros(0)]
        for block in _term_rates(column):
            if not k:
                out.append(np.full(len(block), usual))
                continue
            cosine = _project(block, space) @ examples_z.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            last = np.take_along_axis(cosine, near, 1).min(1)
            for r in np.flatnonzero((cosine >= last[:, None]).sum(1) > k):  # ties at the border: first examples first
                near[r] = np.argsort(-cosine[r], kind="stable")[:k]
            vote = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** 4
            total = vote.sum(1)
            out.append(np.where(total > 1e-9, (vote * good[near]).sum(1) / np.maximum(total, 1e-9), usual))
        return np.clip(np.concatenate(out), 0, 1)

    added = F.coalesce(F.pmod(crc_of(id_col), F.lit(folds)) == held, F.lit(False))
    scored = _scored(docs.drop("score"), text, scores)
    return scored.withColumn("held_out", added).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
