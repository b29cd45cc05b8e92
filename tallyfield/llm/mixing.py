"""Mixing sources to target weights by Pareto order sampling: DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, cut, small, stored

SOURCES = 100_000  # up to so many sources, their table goes to every task; beyond, joins are shuffled
FINE = 4096  # key buckets of one level; two levels leave one row in 16 million to the last ordering
ADDED = ("size", "source_size", "target", "inclusion", "copies", "taken")


def mix_sources(
    docs: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0,
    seed: int = 7, id_col: str = "doc_id", text: str = "text", source: str = "source", carry: list[str] | None = None,
) -> DataFrame:
    """The input columns (of ``carry`` only, if given), and how often the mix takes each row.

    A row's size is its number of words.  Sources in code point order (null last) have ``weights``
    in turn and share ``share`` times all sizes; a target stops at ``most`` times its source's size and
    the excess goes to the others by weight: ``target = min(most * size, level * weight)``, where the level
    is the largest of the levels reached by filling the sources in the order of cap over weight.

    Every row first gets the certain whole copies ``floor(target / source size)``.  The words that
    remain are drawn by Pareto order sampling: with a random ``u`` from a hash of seed, id and text
    and the inclusion probability ``p`` of the row (remaining words over its source's size), rows
    rank by ``(u / (1 - u)) / (p / (1 - p))`` and the lowest are taken until the source's words are
    reached; the last row is taken if that comes nearer to the target.  The cut is found by summing
    words in ``FINE`` buckets of the key, twice, so only distinct rows of one bucket of a bucket are ordered.

    Texts are read once: sizes and random numbers are written with the carried columns as a table of the shared
    folder, and all later passes read its narrow columns.  Adds ``size``, ``source_size``, ``target``, ``inclusion``
    (p), ``copies`` and ``taken`` (size times copies).  Null text has size 0.  Equal keys order by id.  Rows that
    repeat are rows of their own: where the cut falls among equal rows, as many of them are taken as the target
    needs, counted by parts of the table.  Input columns with one of the added names are replaced.  An empty
    table gives an empty result.
    """
    names = [c for c in (docs.columns if carry is None else carry) if c not in ADDED]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string"), F.md5(text)))
    rows = stored(docs.select(
        F.struct(*names).alias("_in"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.coalesce(F.concat(F.lit("0"), F.col(source).cast("string")), F.lit("1")).alias("_src"),  # null sorts last
        ((F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))).alias("_u"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("_tie"), F.monotonically_increasing_id().alias("_row"),
    ))
    sizes = cut(rows.groupBy("_src").agg(F.sum("size").alias("source_size")))
    targets = small(cut(_targets(sizes, weights, share, most)), SOURCES)
    p, u = F.col("inclusion"), F.col("_u")
    odds = (u / (1 - u)) / (p / (1 - p))
    keyed = (
        rows.join(targets, "_src")
        .withColumn("_key", F.when(p > 0, odds / (1 + odds)))
        .withColumn("_one", F.floor(F.col("_key") * FINE).cast("int"))
        .withColumn("_two", F.floor((F.col("_key") * FINE - F.col("_one")) * FINE).cast("int"))
    )
    drawn = keyed.where("_key IS NOT NULL").select("_src", "size", "_key", "_one", "_two", "_tie", "_row", "_need")
    first = _boundary(drawn.groupBy("_src", F.col("_one").alias("_at")), "_need", "1")
    inside = drawn.join(small(first, SOURCES), "_src").where("_one = _cut1")
    second = _boundary(inside.groupBy("_src", F.col("_two").alias("_at")), "_need1", "2")
    last = _last_rows(cut(inside.join(small(second, SOURCES), "_src").where("_two = _cut2")))
    ends = cut(first.select("_src", "_cut1").join(second.select("_src", "_cut2"), "_src", "left").join(last, "_src", "left"))
    mine = F.struct("_key", "_tie", "size")
    within = (mine < F.col("_last")) | ((mine == F.col("_last")) & (F.col("_row") <= F.coalesce("_limit", F.lit(2**63 - 1))))
    extra = (
        F.when(F.col("_key").isNull(), False).when(F.col("_cut1").isNull(), True)
        .when(F.col("_one") != F.col("_cut1"), F.col("_one") < F.col("_cut1"))
        .when(F.col("_two") != F.col("_cut2"), F.col("_two") < F.col("_cut2")).otherwise(F.coalesce(within, F.lit(False)))
    )
    return (
        keyed.join(small(ends, SOURCES), "_src", "left").withColumn("copies", F.col("_whole") + extra.cast("long"))
        .select("_in.*", "size", "source_size", "target", "inclusion", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def _boundary(summed: GroupedData, need: str, level: str) -> DataFrame:
    """Per source the bucket ``_cut`` in which its running words reach what it needs, and the words needed inside it."""
    before = F.sum("_words").over(Window.partitionBy("_src").orderBy("_at")) - F.col("_words")
    return cut(
        summed.agg(F.sum("size").alias("_words"), F.max(need).alias("_aim")).withColumn("_before", before)
        .where("_before < _aim AND _before + _words >= _aim")
        .select("_src", F.col("_at").alias(f"_cut{level}"), (F.col("_aim") - F.col("_before")).alias(f"_need{level}"))
    )


def _last_rows(rows: DataFrame) -> DataFrame:
    """Per source the last key taken (``_last``), and the last row of that key if only some of its rows are (``_limit``)."""
    key = ["_src", "_key", "_tie", "size"]
    before = Window.partitionBy("_src").orderBy("_key", "_tie", "size").rowsBetween(Window.unboundedPreceding, -1)
    equal = rows.groupBy(*key).agg(F.count("*").alias("_n"), F.max("_need2").alias("_need2"))
    left = F.col("_need2") - F.coalesce(F.sum(F.col("size") * F.col("_n")).over(before), F.lit(0))
    fits = F.when(F.col("size") > 0, F.floor(left / F.col("size") + 0.5)).when(left >= 0, F.col("_n")).otherwise(0)
    taken = equal.withColumn("_fits", F.least(F.col("_n"), F.greatest(fits, F.lit(0))).cast("long")).where("_fits > 0")
    last = cut(taken.groupBy("_src").agg(F.max(F.struct("_key", "_tie", "size", "_fits", "_n")).alias("m")).select("_src", "m.*"))
    # Rows of that key are counted by parts of the table, then in one part: equal rows never meet in one task.
    some = last.where("_fits < _n").select(*key, "_fits")
    parted = rows.join(small(some, SOURCES), key).withColumn("_p", F.shiftright("_row", 33))
    ahead = Window.partitionBy("_src").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    counts = parted.groupBy("_src", "_p").agg(F.count("*").alias("_c"), F.max("_fits").alias("_f"))
    part = (
        counts.withColumn("_ahead", F.coalesce(F.sum("_c").over(ahead), F.lit(0)))
        .where("_ahead < _f AND _ahead + _c >= _f").select("_src", "_p", (F.col("_f") - F.col("_ahead")).alias("_nth"))
    )
    nth = F.row_number().over(Window.partitionBy("_src").orderBy("_row"))
    limit = parted.join(small(part, SOURCES), ["_src", "_p"]).withColumn("_i", nth).where("_i = _nth").select("_src", F.col("_row").alias("_limit"))
    return last.select("_src", F.struct("_key", "_tie", "size").alias("_last")).join(limit, "_src", "left")


def _before(table: DataFrame, order: list[str], **sums: Column) -> DataFrame:
    """``table`` with sums over the rows before each in ``order``; ranges of rows are summed apart, then put together."""
    ranges = 1 + table.count() // SOURCES
    dealt = cut(table.repartitionByRange(ranges, *order).withColumn("_p", F.spark_partition_id()))
    inside = Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    offsets = dealt.groupBy("_p").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    offsets = offsets.select("_p", *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in sums])
    together = {n: F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"_{n}") for n, c in sums.items()}
    return dealt.join(small(offsets, SOURCES), "_p").withColumns(together).drop("_p", *[f"_{n}" for n in sums])


def _targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """One row a source: its target, certain copies, inclusion probability and the words that remain."""
    weight = F.array(*[F.lit(float(w)) for w in weights])
    weighed = cut(
        _before(sizes, ["_src"], nth=F.lit(1)).withColumn("_weight", F.element_at(weight, (F.col("nth") % len(weights) + 1).cast("int")))
        .withColumn("_cap", F.col("source_size") * F.lit(float(most))).withColumn("_ratio", F.col("_cap") / F.col("_weight"))
    )
    whole = weighed.agg(F.sum("source_size").alias("size"), F.sum("_weight").alias("weight")).first()
    filled = _before(weighed, ["_ratio", "_src"], caps=F.col("_cap"), weights=F.col("_weight"))
    reached = (F.lit(float((whole.size or 0) * share)) - F.col("caps")) / (F.lit(whole.weight or 1.0) - F.col("weights"))
    level = filled.agg(F.max(reached)).first()[0] or 0.0
    return (
        weighed.withColumn("target", F.least("_cap", F.lit(level) * F.col("_weight")))
        .withColumn("_whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("_need", F.col("target") - F.col("_whole") * F.col("source_size"))
        .withColumn("inclusion", F.when(F.col("source_size") > 0, F.col("_need") / F.col("source_size")).otherwise(0.0))
        .select("_src", "source_size", "target", "_whole", "inclusion", "_need")
    )
