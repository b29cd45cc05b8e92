"""Vector operators: near-duplicate links by spherical k-means cells, and search by a permutation index."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import components, cut, forest, small


def _usable(embedding: str) -> Column:
    """Not null, not empty, every component there and finite, and not all zero."""
    e = F.col(embedding)
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(e.isNotNull() & finite & F.exists(e, lambda x: x != 0), F.lit(False))


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaling by the largest component first keeps very large and very small vectors finite.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _sample(rows: DataFrame, most: int, id_col: str, embedding: str) -> np.ndarray:
    """At most ``most`` vectors, chosen by a hash of their id: of the dimension most of them have."""
    picked = rows.orderBy(F.xxhash64(id_col, F.lit(11)), id_col).limit(most).select(embedding).collect()
    sizes = pd.Series([len(r[0]) for r in picked], dtype="int64")
    size = int(sizes.mode().iloc[0]) if len(sizes) else 0
    return np.array([r[0] for r in picked if len(r[0]) == size], dtype=np.float64).reshape(-1, max(size, 1))


def spherical_kmeans(unit: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """``k`` unit centres of unit vectors; an empty cell takes the vector farthest from its centre."""
    centres = unit[np.random.default_rng(seed).choice(len(unit), k, replace=False)]
    for _ in range(rounds):
        cosines = unit @ centres.T
        home = cosines.argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, unit)
        norms = np.linalg.norm(sums, axis=1)
        far = np.argsort(cosines.max(1), kind="stable")
        empty = np.flatnonzero(norms < 1e-12)
        sums[empty], norms[empty] = unit[far[: len(empty)]], 1.0
        centres = sums / norms[:, None]
    return centres


def _reach(unit: np.ndarray, centres: np.ndarray, sine: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each vector, and the cells it is dealt to (rows by cells).

    Those are its home and the lower-numbered cells where a vector within the angle of ``sine`` could be at
    home: then ``y.(c_home - c) <= |c_home - c| sine``.  A pair thus meets in the lower of its two homes.
    A smaller ``sine`` takes only the cells near the border; pairs then meet with high probability.
    """
    cosines = unit @ centres.T
    home = cosines.argmax(1)
    rows = np.arange(len(unit))
    # Unit centres are sqrt(2 - 2 cosine) apart; the slack covers the rounding of that root.
    gaps = np.sqrt(np.maximum(2 - 2 * (centres[home] @ centres.T), 0)) * sine + 1e-7
    reach = cosines[rows, home][:, None] - cosines <= gaps
    reach &= np.arange(len(centres)) < home[:, None]
    reach[rows, home] = True
    return home, reach


def _places(unit: np.ndarray, centres: np.ndarray, sine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, cell, and whether that is the row's home, for every cell a row is dealt to."""
    if unit.shape[1] != centres.shape[1]:  # other dimensions meet in one cell of their own
        return np.arange(len(unit)), np.zeros(len(unit), np.int64), np.ones(len(unit), bool)
    home, reach = _reach(unit, centres, sine)
    src, cell = np.nonzero(reach)
    return src, cell, cell == home[src]


def _spread(unit: np.ndarray) -> float:
    """Effective number of dimensions in which vectors differ (the participation ratio of their covariance)."""
    if len(unit) < 2:
        return 1.0
    powers = np.linalg.svd(unit - unit.mean(0), compute_uv=False) ** 2
    return max(1.0, float(powers.sum() ** 2 / max((powers**2).sum(), 1e-300)))


def near_duplicate_vectors(
    vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", embedding: str = "embedding",
    label: str = "label", sample: int = 4096, block: int = 4096, margin: float | None = 3.0, cells: int | None = None,
) -> DataFrame:
    """Link vectors of equal label whose cosine is at least ``threshold``; one row per input row.

    Exact copies (same label, same components) fold into one representative with a count.  Spherical
    k-means centres, fitted on at most ``sample`` vectors, deal the representatives into ``cells`` cells: by default
    the square root of the rows of a label, which balances finding a vector's cell against comparing in it.
    A vector is compared in its own cell and is a guest in the lower-numbered cells whose border is near.
    More cells than a quarter of ``sample`` come in two levels: the square root of them are fitted on the sample, and
    each is divided by centres fitted in its own task on at most ``sample`` of its vectors.  A pair meets in the lower
    home of the first level, where both are dealt, and there in the lower home of the second.

    How near follows from the threshold's angle.  In the worst direction a linked vector reaches over a border
    ``sin(angle)`` away; in a random direction of ``d`` dimensions it gets ``1 / sqrt(d)`` of that far in one standard
    deviation.  Guests go ``margin`` standard deviations, with the effective ``d`` of the sample: pairs at the very
    threshold meet with some 0.999, nearer ones more surely, and no pair below the threshold links.  With
    ``margin=None`` guests go all the way, and every link is found whatever the data.

    A large cell is dealt into blocks of ``block`` rows and every pair of blocks is one task's work, so no
    cell is gathered in one place.  Each block gives link counts and a spanning forest of its links,
    never all its pairs.

    Returns ``id_col``, ``n_links`` (rows linked directly), ``component_id`` (smallest id reachable) and
    ``kept`` (the representative of its component).  Rows without an id or label, and unusable
    vectors (null, empty, zero, null or non-finite components) link with nothing and are kept.  Rows
    that repeat an id count as rows of their own.  Other columns of the input are dropped.
    """
    base = vectors.select(
        F.col(id_col).cast("long").alias("vid"), F.col(label).cast("string").alias("lab"), F.col(embedding).alias("emb"),
    )
    usable = base.where(F.col("vid").isNotNull() & F.col("lab").isNotNull() & _usable("emb"))
    keyed = lambda df: df.withColumns({"h1": F.xxhash64("emb"), "h2": F.xxhash64(F.lit(17), "emb")})
    key = ["lab", "h1", "h2"]
    reps = cut(
        keyed(usable).groupBy(*key).agg(F.min(F.struct("vid", "emb")).alias("m"), F.count("*").alias("n"))
        .select(*key, F.col("m.vid").alias("rep"), "n", F.col("m.emb").alias("emb"))
    )
    pairs = cut(_compared(reps, threshold, sample, block, margin, cells))
    links = pairs.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    comps = components(pairs.where("b IS NOT NULL").select("a", "b"))
    known = (
        reps.select(*key, "rep", "n").join(links, "rep", "left")
        .join(comps.withColumnRenamed("node", "rep"), "rep", "left")
        .select(*key, (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "rep").alias("component"))
    )
    usable_hash = lambda c: F.when(F.col("vid").isNotNull() & _usable("emb"), F.col(c)).alias(c)
    rows = keyed(base).select("vid", "lab", usable_hash("h1"), usable_hash("h2"))
    return rows.join(known, key, "left").select(
        F.col("vid").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vid").alias("component_id"), F.coalesce("component", "vid").eqNullSafe(F.col("vid")).alias("kept"),
    )


def _levels(reps: DataFrame, sample: int, cells: int | None) -> tuple[int, int]:
    """How many cells, and into how many each is divided again: one level as long as a quarter of ``sample`` suffices."""
    counts = reps.agg(F.count("*").alias("n"), F.approx_count_distinct("lab").alias("labels")).first()
    wanted = cells or max(1, round(np.sqrt(counts.n / max(counts.labels, 1))))
    most = max(1, sample // 4)
    if wanted <= most or counts.n <= sample:
        return wanted, 1
    outer = min(most, int(np.ceil(np.sqrt(wanted))))
    return outer, -(-wanted // outer)


def _centres(reps: DataFrame, sample: int, cells: int | None) -> np.ndarray:
    """Cell centres: no more than a quarter of the fitted vectors."""
    unit = _unit(_sample(reps, sample, "rep", "emb"))
    k = max(1, min(cells or _levels(reps, sample, None)[0], len(unit) // 4))
    return spherical_kmeans(unit, k) if len(unit) else np.ones((1, max(unit.shape[1], 1)))


def _divided(dealt: DataFrame, inner: int, sine: float, sample: int, share: int = 8192) -> DataFrame:
    """``dealt`` again, over ``inner`` cells inside each cell; bit 2 of ``home`` tells the home among these.

    Centres stay in tasks: those of a cell meet its rows in shares of about ``share``.
    """
    cell = ["size", "cell"]
    nth = F.row_number().over(Window.partitionBy(*cell).orderBy(F.xxhash64("rep", F.lit(13)), "rep"))
    picked = dealt.where("home = 1").select(*cell, "rep", "unit").withColumn("nth", nth).where(F.col("nth") <= sample)

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        unit = np.frombuffer(b"".join(group["unit"]), np.float64).reshape(len(group), -1)
        centres = spherical_kmeans(unit, max(1, min(inner, len(unit) // 4)))
        return group[cell].head(1).assign(centres=[centres.tobytes()])

    def deal(rows: pd.DataFrame, fitted: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or fitted.empty:  # guests alone never link
            return rows.iloc[:0][columns]
        unit = np.frombuffer(b"".join(rows["unit"]), np.float64).reshape(len(rows), -1)
        centres = np.frombuffer(fitted["centres"].iloc[0], np.float64).reshape(-1, unit.shape[1])
        made = []
        for lo in range(0, len(rows), 1024):
            src, sub, at_home = _places(unit[lo : lo + 1024], centres, sine)
            part = rows.iloc[lo + src][columns]
            made.append(part.assign(cell=part["cell"] * inner + sub, home=part["home"] | at_home.astype(np.int64) << 1))
        return pd.concat(made)

    columns = ["lab", "size", "cell", "rep", "n", "home", "unit"]
    shares = cut(dealt.groupBy(*cell).agg(F.ceil(F.count("*") / share).cast("int").alias("m")))
    part = F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("part")
    fitted = picked.groupBy(*cell).applyInPandas(fit, "size int, cell int, centres binary").join(shares, cell).select(*cell, "centres", part)
    rows = dealt.join(small(shares, 100_000), cell).withColumn("part", F.pmod(F.xxhash64("rep", "lab"), F.col("m")).cast("int")).drop("m")
    both = rows.groupBy(*cell, "part").cogroup(fitted.groupBy(*cell, "part"))
    return cut(both.applyInPandas(deal, dealt.schema))


def _compared(reps, threshold, sample, block, margin, cells) -> DataFrame:
    """(a, null, linked rows) for representatives with links, and (a, b, null) for a forest of the links."""
    sine = float(np.sqrt(max(0.0, 1 - threshold * threshold))) if threshold > 0 else 2.0
    outer, inner = _levels(reps, sample, cells)
    centres = _centres(reps, sample, outer)
    if margin is not None:
        sine *= min(1.0, margin / np.sqrt(_spread(_unit(_sample(reps, 1024, "rep", "emb")))))

    def deal(batches):
        import pyarrow as pa

        for batch in batches:
            ids, labels, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2))
            vectors = batch.column(3)
            sizes = np.diff(vectors.offsets.to_numpy())
            flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
            firsts = np.concatenate([[0], np.cumsum(sizes)])
            for size in np.unique(sizes):
                same = np.flatnonzero(sizes == size)
                for at in np.split(same, range(1024, len(same), 1024)):
                    unit = _unit(flat[firsts[at][:, None] + np.arange(size)])
                    src, cell, at_home = _places(unit, centres, sine)
                    written = [v.tobytes() for v in unit]
                    yield pa.RecordBatch.from_pydict({
                        "lab": pa.array(labels[at][src], pa.string()), "size": pa.array(np.full(len(src), size), pa.int32()),
                        "cell": pa.array(cell, pa.int32()), "rep": pa.array(ids[at][src], pa.int64()), "n": pa.array(n[at][src], pa.int64()),
                        "home": pa.array(at_home, pa.int8()), "unit": pa.array([written[i] for i in src], pa.binary()),
                    })

    dealt = cut(reps.select("rep", "lab", "n", "emb").mapInArrow(
        deal, "lab string, size int, cell int, rep long, n long, home tinyint, unit binary"
    ))
    if inner > 1:
        dealt = _divided(dealt, inner, sine, sample)
    full = 1 if inner == 1 else 3
    cell = ["lab", "size", "cell"]
    blocks = dealt.groupBy(*cell).agg(F.ceil(F.count("*") / block).cast("int").alias("m"))
    dealt = (
        dealt.join(small(blocks, 100_000), cell)
        .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("m")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
        .withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        ids, n, own, home = (group[c].to_numpy() for c in ("rep", "n", "own", "home"))
        i, j = group["i"].iloc[0], group["j"].iloc[0]
        unit = np.frombuffer(b"".join(group["unit"]), np.float64).reshape(len(group), -1)
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        linked, ups, downs = np.zeros(len(ids)), [], []
        for strip in np.split(left, range(256, len(left), 256)):  # bounds the matrix, whatever share of it links
            hit = (unit[strip] @ unit[right].T >= threshold) & ((home[strip][:, None] | home[right]) == full)  # guests meet at a home
            at = np.argwhere(hit)
            a, b = strip[at[:, 0]], right[at[:, 1]]
            keep = ids[a] < ids[b] if i == j else ids[a] != ids[b]
            a, b = a[keep], b[keep]
            linked += np.bincount(a, n[b], len(ids)) + np.bincount(b, n[a], len(ids))
            up, down = forest(a, b, len(ids))
            ups.append(up)
            downs.append(down)
        up, down = forest(np.concatenate(ups), np.concatenate(downs), len(ids))
        has = np.flatnonzero(linked)
        return pd.DataFrame({
            "a": np.concatenate([ids[has], ids[up]]),
            "b": pd.array([None] * len(has) + list(ids[down]), dtype="Int64"),
            "links": pd.array([*linked[has].astype(np.int64), *[None] * len(up)], dtype="Int64"),
        })

    return dealt.groupBy(*cell, "i", "j").applyInPandas(compare, "a long, b long, links long")


def _pivots(rows: DataFrame, most: int, longest2: float) -> dict[int, np.ndarray]:
    """Up to ``most`` vectors of each dimension, chosen by a hash of their id, with the component that evens out lengths."""
    order = Window.partitionBy("size").orderBy(F.xxhash64("vid", F.lit(11)), "vid")
    picked = rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most).select("size", "emb").collect()
    found: dict[int, list] = {}
    for size, emb in picked:
        found.setdefault(size, []).append(emb)
    made = {}
    for size, vectors in found.items():
        x = np.array(vectors, np.float64)
        rest = np.sqrt(np.maximum(longest2 - (x * x).sum(1), 0))
        made[size] = np.hstack([x, rest[:, None]]) / np.sqrt(longest2)
    return made


def nearest_vectors(
    vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", embedding: str = "embedding",
    pivots: int = 512, prefix: int = 48, share: float = 0.2, shard_rows: int = 8192, query_rows: int = 4096,
) -> DataFrame:
    """The ``k`` rows of largest inner product for each row of ``vectors`` that ``queries`` selects.

    A permutation index: every vector is represented by its ``prefix`` nearest of ``pivots`` pivots, in
    order.  Pivots are drawn from at most ``pivots`` hashed rows of each dimension; every row is indexed.  Rows are
    dealt into shards by a hash of id and vector; in each shard a pivot's inverted file lists the rows that have it
    and at which place.  A query reads the files of its own prefix, sums the footrule distance, and
    reranks the nearest ``share`` of the shard (4 ``k`` rows at least) exactly, in double precision.  For the largest
    inner product, vectors get one more component that evens out their lengths, so that the nearest direction
    is the largest product.  Query blocks times shards is the unit of work; each gives ``k`` rows a query.

    Returns query_id, rank (from 1), vec_id, score.  Unusable vectors and rows without an id take no part; a row
    is never its own candidate.  Rows that repeat id and vector are one candidate; they are folded before the
    search, wherever they lie.  Vectors of several dimensions are searched apart: a product of two dimensions is
    not defined.  Ties go to the smaller id.  Other columns are dropped, whatever their names.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vid"), F.col(embedding).alias("emb"), queries.alias("q"))
    rows = rows.where(F.col("vid").isNotNull() & _usable("emb")).withColumn("q", F.coalesce("q", F.lit(False)))
    rows = cut(
        rows.dropDuplicates(["vid", "emb", "q"]).withColumn("size", F.size("emb"))
        .withColumn("norm2", F.aggregate("emb", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    )
    stats = rows.agg(F.max("norm2"), F.count("*"), F.count_if("q")).first()
    longest2, total, asked = float(stats[0] or 1.0), stats[1], stats[2]
    pivot = _pivots(rows, pivots, longest2)
    n_shards, n_blocks = max(1, -(-total // shard_rows)), max(1, -(-asked // query_rows))

    def permuted(as_query: bool):
        def run(batches):
            import pyarrow as pa

            for batch in batches:
                every, emb = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
                sizes = np.diff(emb.offsets.to_numpy())
                for size in np.unique(sizes):
                    at = np.flatnonzero(sizes == size)
                    ids, part = every[at], emb.take(pa.array(at))
                    flat = np.asarray(part.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(ids), size)
                    rest = np.zeros(len(ids)) if as_query else np.sqrt(np.maximum(longest2 - (flat * flat).sum(1), 0))
                    near = np.hstack([flat, rest[:, None]]) @ pivot[int(size)].T
                    order = np.argsort(-near, axis=1, kind="stable")[:, :prefix].astype(np.int16)
                    yield pa.RecordBatch.from_pydict({
                        "vid": pa.array(ids, pa.int64()), "size": pa.array(np.full(len(ids), size), pa.int32()),
                        "emb": pa.array([v.tobytes() for v in flat], pa.binary()), "perm": pa.array([p.tobytes() for p in order], pa.binary()),
                    })

        return run

    schema, unit = "vid long, size int, emb binary, perm binary", ["part", "shard", "size"]
    index = (
        rows.select("vid", "emb").distinct().mapInArrow(permuted(False), schema)
        .withColumn("shard", F.pmod(F.xxhash64("vid", "emb"), F.lit(n_shards)).cast("int"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    )
    asks = (
        rows.where("q").select("vid", "emb").mapInArrow(permuted(True), schema)
        .withColumn("part", F.pmod(F.xxhash64("vid", "emb", F.lit(3)), F.lit(n_blocks)).cast("int"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
    )

    def search(ask: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(ask) and len(data):
            ids = data["vid"].to_numpy()
            vectors = np.frombuffer(b"".join(data["emb"]), np.float64).reshape(len(ids), -1)
            perms = np.frombuffer(b"".join(data["perm"]), np.int16).reshape(len(ids), -1)
            width = perms.shape[1]
            by_pivot = np.argsort(perms.ravel(), kind="stable")  # the inverted files, one after the other
            posted, places = (by_pivot // width).astype(np.int32), (by_pivot % width).astype(np.int16)
            bounds = np.searchsorted(perms.ravel()[by_pivot], np.arange(pivots + 1))
            short = min(len(ids), max(int(np.ceil(share * len(ids))), 4 * k))
            place = np.arange(width, dtype=np.int16)
            for qid, q, perm in zip(ask["vid"], ask["emb"], ask["perm"], strict=True):
                # Footrule over both prefixes, absent pivots at place ``width``: less is nearer.
                # Both prefixes absent would cost the constant; each shared pivot gives part of it back.
                gain = np.zeros(len(ids), np.int16)
                for at, p in enumerate(np.frombuffer(perm, np.int16)):
                    lo, hi = bounds[p], bounds[p + 1]
                    back = (width - at) + (width - place) - np.abs(place - at)
                    gain[posted[lo:hi]] += back.astype(np.int16)[places[lo:hi]]
                best = np.argpartition(-gain, short - 1)[:short] if short < len(ids) else np.arange(len(ids))
                best = best[ids[best] != qid]
                scores = vectors[best] @ np.frombuffer(q, np.float64)
                top = np.lexsort((ids[best], -scores))[:k]
                out["query_id"] += [qid] * len(top)
                out["vec_id"] += ids[best][top].tolist()
                out["score"] += scores[top].tolist()
        return pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    found = asks.groupBy(*unit).cogroup(index.groupBy(*unit)).applyInPandas(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast(T.IntegerType()), "vec_id", "score")
    )
