"""Joins beyond plain equality: null-safe anti and semi chains, as-of, top-1, bands, patterns, containment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .dedup import dedup_latest


def bounded(df: DataFrame, most: int = 50_000) -> DataFrame:
    """``df`` marked for broadcast when it has at most ``most`` rows; otherwise Spark chooses the join."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def null_safe_anti(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` without a partner, where null equals null."""
    right = right.select(*keys).distinct()
    return left.join(right, _same(left, right, keys), "left_anti")


def null_safe_semi(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    right = right.select(*keys).distinct()
    return left.join(right, _same(left, right, keys), "left_semi")


def anti_unless(left: DataFrame, removed: DataFrame, kept: DataFrame, keys: list[str]) -> DataFrame:
    """Anti join inside an anti join: a removal does not count where ``kept`` supersedes it."""
    return null_safe_anti(left, null_safe_anti(removed, kept, keys), keys)


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], at: str, since: str, columns: list[str], strict: bool = False) -> DataFrame:
    """For each left row the latest right row with ``since`` at or before ``at`` (before it, if ``strict``).

    Both sides are unioned and sorted once per key, and the last right row is carried forward: no pair of rows is
    formed, so many rows on both sides of one key stay linear.  Equal right ``since``: the largest columns win.
    """
    packed = F.struct(F.col(since).alias("_since"), *columns)
    right = right.select(*keys, F.col(since).alias("_at"), packed.alias("_row"), F.lit(None).cast(left_schema(left)).alias("_left"))
    rows = left.select(*keys, F.col(at).alias("_at"), F.lit(None).cast(right.schema["_row"].dataType).alias("_row"),
        F.struct(*left.columns).alias("_left"))
    # At equal times a right row comes before a left one, or after it for a strict comparison.
    side = F.when(F.col("_left").isNull(), 1 if strict else 0).otherwise(0 if strict else 1)
    order = Window.partitionBy(*keys).orderBy(F.col("_at").asc_nulls_first(), side, F.col("_row"))
    found = F.last("_row", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    both = right.unionByName(rows).withColumn("_found", found).where("_left IS NOT NULL")
    # Keys come from the window's own columns, so that a filter on them goes below it, to the scans of both sides.
    own = [F.col(c) if c in keys else F.col(f"_left.{c}").alias(c) for c in left.columns]
    return both.select(*own, F.col("_found._since").alias(since), *[F.col(f"_found.{c}").alias(c) for c in columns])


def asof_join_split(
    left: DataFrame, right: DataFrame, keys: list[str], at: str, since: str, columns: list[str], strict: bool = False, per_range: int = 250_000,
) -> DataFrame:
    """``asof_join`` in which no task sorts a hot key alone: keys of more than ``per_range`` rows are cut into ranges of time.

    Ranges are of equal length between a key's first and last time, as many as its rows need.  Within a range the last right row is
    carried forward as ever; a left row with none before it in its range takes the last one of the ranges before, of which there is
    one row a range.  Keys are rarely hot, so their list goes to every task while small; without any this is ``asof_join``.
    """
    times = left.select(*keys, F.col(at).alias("_at")).unionByName(right.select(*keys, F.col(since).alias("_at")))
    number = lambda c: F.col(c).cast("timestamp").cast("double") if dict(times.dtypes)["_at"].startswith(("timestamp", "date")) else F.col(c).cast("double")
    sized = times.groupBy(*keys).agg(F.count("*").alias("_n"), F.min(number("_at")).alias("_lo"), F.max(number("_at")).alias("_hi"))
    hot = sized.where((F.col("_n") > per_range) & (F.col("_hi") > F.col("_lo"))).select(
        *keys, "_lo", ((F.col("_hi") - F.col("_lo")) / F.ceil(F.col("_n") / per_range)).alias("_step"))
    if hot.isEmpty():
        return asof_join(left, right, keys, at, since, columns, strict)
    hot = bounded(hot)

    def ranged(df: DataFrame, c: str) -> DataFrame:
        """``_range`` of each row: 0 for keys that are not hot and for rows without a time."""
        cell = F.floor((number(c) - F.col("_lo")) / F.col("_step"))
        return df.join(hot, keys, "left").withColumn("_range", F.coalesce(cell, F.lit(0))).drop("_lo", "_step")

    cut_left, cut_right = ranged(left, at), ranged(right.select(*keys, since, *columns, F.lit(True).alias("_hit")), since)
    near = asof_join(cut_left, cut_right, [*keys, "_range"], at, since, [*columns, "_hit"], strict)
    packed = F.struct(F.col(since).alias("_since"), *columns)
    lasts = cut_right.join(hot.select(*keys), keys, "left_semi").groupBy(*keys, "_range").agg(F.max(packed).alias("_last"))
    spots = near.join(hot.select(*keys), keys, "left_semi").select(*keys, "_range").distinct().withColumn("_last", F.lit(None).cast(lasts.schema["_last"].dataType))
    order = Window.partitionBy(*keys).orderBy("_range").rangeBetween(Window.unboundedPreceding, -1)
    carried = lasts.unionByName(spots).withColumn("_carried", F.last("_last", ignorenulls=True).over(order))
    carried = carried.groupBy(*keys, "_range").agg(F.max("_carried").alias("_carried"))
    both = near.join(carried, [*keys, "_range"], "left")
    here = F.col("_hit")
    filled = {c: F.when(here, F.col(c)).otherwise(F.col(f"_carried.{'_since' if c == since else c}")) for c in [since, *columns]}
    return both.withColumns(filled).select(*left.columns, since, *columns)


def left_schema(df: DataFrame):
    return df.select(F.struct(*df.columns).alias("s")).schema["s"].dataType


def top1_lookup(left: DataFrame, right: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Left join to the first right row of each key."""
    return left.join(dedup_latest(right, keys, order), keys, "left")


def or_join(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], left_id: str, right_id: str) -> DataFrame:
    """Pairs that agree in any of several columns: one equality join each, then distinct, never a nested loop."""
    found = [left.join(right, left[a] == right[b]).select(left_id, right_id) for a, b in pairs]
    return reduce(DataFrame.union, found).distinct()


def band_join(df: DataFrame, value: str, bands: DataFrame, low: str, high: str, width: float | None = None, most: int = 1000) -> DataFrame:
    """Each row with the bands [low, high) that hold its value.

    Up to ``most`` bands go to every task.  More meet by equality on cells of the value range: a band lies in every cell that it
    touches, a value in one; ``width`` is the cells', by default the bands' mean width.  A band of several thousand cells (an open
    end, say) would be copied as often, so such wide ones, if few, go to every task as well.
    """
    inside = (F.col(value) >= F.col(low)) & (F.col(value) < F.col(high))
    if bands.limit(most + 1).count() <= most:
        return df.join(F.broadcast(bands), inside)
    size = width or max(float(bands.agg(F.expr(f"percentile_approx({high} - {low}, 0.5)")).first()[0] or 1.0), 1e-12)
    cell = lambda c: F.floor(F.col(c).cast("double") / size)
    cells = cell(high) - cell(low) + 1
    narrow = bands.where(cells <= 1000).withColumn("_cell", F.explode(F.sequence(cell(low), cell(high))))
    met = df.withColumn("_cell", cell(value)).join(narrow, "_cell").where(inside).drop("_cell")
    wide = bands.where(F.coalesce(cells > 1000, F.lit(True)))
    return met.unionByName(df.join(bounded(wide), inside))


def pattern_case(column: Column, rules: list[tuple[str, str]], otherwise: str | None = None) -> Column:
    """First rule whose LIKE pattern matches decides."""
    out = F.lit(otherwise)
    for pattern, value in reversed(rules):
        out = F.when(column.like(pattern), F.lit(value)).otherwise(out)
    return out


def containment_match(df: DataFrame, text: Column, terms: list[str], to: str = "term") -> DataFrame:
    """Longest term found as a whole word sequence in the padded text (ties by spelling); null if none."""
    padded = F.concat(F.lit(" "), text, F.lit(" "))
    ordered = sorted(terms, key=lambda t: (-len(t), t))
    hits = [F.when(F.contains(padded, F.lit(f" {t} ")), F.lit(t)) for t in ordered]
    return df.withColumn(to, F.coalesce(*hits))


def json_anti(df: DataFrame, key: str, lists: DataFrame, column: str) -> DataFrame:
    """Rows whose ``key`` is in none of the JSON arrays of ``lists``."""
    kind = df.schema[key].dataType.simpleString()
    named = lists.select(F.explode(F.from_json(column, f"array<{kind}>")).alias(key)).where(F.col(key).isNotNull()).distinct()
    return df.join(named, key, "left_anti")


def rule_join(df: DataFrame, column: str, rules: DataFrame, order: str, pattern: str, value: str, otherwise=None) -> DataFrame:
    """First rule by ``order`` of a rule table whose LIKE pattern matches.

    The distinct values of the column meet the rules, not the rows; the table of rules goes to every task while small.
    """
    kinds = df.select(column).distinct()
    met = kinds.join(bounded(rules, 10_000), F.expr(f"`{column}` LIKE `{pattern}`"))
    first = met.groupBy(column).agg(F.min_by(value, F.struct(order, pattern)).alias(value))
    return df.join(first, column, "left").withColumn(value, F.coalesce(value, F.lit(otherwise)))


def key_containment(df: DataFrame, row: str, path: str, keys: DataFrame, key: str, order: list[str], words: int = 8) -> DataFrame:
    """For each row the best key that its path holds as whole words: an equal path first, then ``order``, the longest, its spelling.

    Keys of up to ``words`` words meet the path's word sequences by equality, so no row is held against every key; longer
    keys are held against paths by containment, with the keys sent to every task while few.
    """
    keys = keys.withColumn("_n", F.size(F.split(key, " ")))
    parts, at = F.split(path, " "), F.sequence(F.lit(1), F.size(F.split(path, " ")))
    runs = F.flatten(F.transform(at, lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(words), F.size(parts) - i + 1)),
        lambda n: F.array_join(F.slice(parts, i, n), " "))))
    short = df.select(row, path, F.explode(F.array_distinct(runs)).alias(key)).join(keys.where(F.col("_n") <= words), key)
    padded = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    long = df.select(row, path).join(bounded(keys.where(F.col("_n") > words), 10_000), F.contains(padded(F.col(path)), padded(F.col(key))))
    found = short.unionByName(long)
    best = F.min_by(key, F.struct((F.col(path) != F.col(key)).alias("o"), *order, (-F.length(key)).alias("l"), F.col(key).alias("k")))
    return df.join(found.groupBy(row).agg(best.alias(key)), row, "left")
