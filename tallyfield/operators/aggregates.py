"""Aggregates of the reports: shares, evidence, conflicts, content hashes, exact allocation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def cents(amount: str | Column) -> Column:
    """Money as whole cents, before any sum."""
    return F.round((F.col(amount) if isinstance(amount, str) else amount) * 100).cast("long")


def tenth_percent(part: Column, whole: Column) -> Column:
    """100 * part / whole to one decimal, halves up, from whole numbers; 0 where the whole is 0."""
    return F.when(whole > 0, F.floor((part * 2000 + whole) / (whole * 2)).cast("long") / 10).otherwise(F.lit(0.0))


def percent_of_total(df: DataFrame, keys: list[str], within: list[str]) -> DataFrame:
    """Rows of each key and their share of all rows of ``within`` (two aggregates, no window over all rows)."""
    counted = df.groupBy(*within, *keys).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(*within))
    return counted.withColumn("pct", tenth_percent(F.col("n"), total))


def allocate(df: DataFrame, keys: list[str], amount: str, weight: str, to: str = "share") -> DataFrame:
    """``amount`` of each key shared by ``weight``, in whole units rounded half up; 0 where all weights are 0."""
    total = F.sum(weight).over(Window.partitionBy(*keys))
    share = F.expr(f"CAST(({amount} * {weight} * 2 + _total) AS DECIMAL(38,0)) div CAST(_total * 2 AS DECIMAL(38,0))")
    return df.withColumn("_total", total).withColumn(to, F.when(F.col("_total") > 0, share).otherwise(0).cast("long")).drop("_total")


def accept_evidence(df: DataFrame, key: str, value: str, share_percent: int = 80, least: int = 3) -> DataFrame:
    """Keys whose rows name one value in at least ``share_percent`` of cases and ``least`` times: (key, value, n, total)."""
    counted = df.groupBy(key, value).agg(F.count("*").alias("n"))
    best = counted.groupBy(key).agg(F.sum("n").alias("total"), F.max(F.struct("n", value)).alias("b"))
    found = best.select(key, F.col(f"b.{value}").alias(value), F.col("b.n").alias("n"), "total")
    return found.where((F.col("n") >= least) & (F.col("n") * 100 >= F.col("total") * share_percent))


def conflicts(df: DataFrame, key: str, value: str) -> DataFrame:
    """Per key whether it has several values; the value itself only where it has one."""
    grouped = df.groupBy(key).agg(F.countDistinct(value).alias("n_values"), F.min(value).alias("v"))
    conflict = F.col("n_values") > 1
    return grouped.select(key, "n_values", conflict.alias("is_conflict"), F.when(~conflict, F.col("v")).alias(value))


def content_hash(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """md5 of each key's rows (of all rows, without keys): the order of input does not matter.

    Hashed in two levels: sorted row digests that share their first four signs, then those hashes in order.  What one
    task gathers is a 65,536th of a group, so groups of billions of rows can be hashed.
    """
    row = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))
    digest = lambda c: F.md5(F.array_join(c, ","))
    parts = df.select(*keys, row.alias("_h")).groupBy(*keys, F.substring("_h", 1, 4).alias("_p"))
    parts = parts.agg(F.count("*").alias("_n"), digest(F.array_sort(F.collect_list("_h"))).alias("_d"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("_p", "_d"))), lambda x: x["_d"])
    return parts.groupBy(*keys).agg(F.sum("_n").alias("n"), digest(ordered).alias("content_hash"))


def bundled(df: DataFrame, key: str, cents: str, is_a: Column, approved: Column) -> DataFrame:
    """Revenue of paired tasks A and B of a key: while no B is approved, A earns both and B nothing.

    ``pricing_status``: priced, bundled (A earns for B too) or unpriced (no A).
    """
    sums = df.groupBy(key).agg(
        F.sum(F.when(is_a, F.col(cents))).alias("a"), F.sum(F.when(~is_a, F.col(cents))).alias("b"), F.bool_or(~is_a & approved).alias("ok")
    )
    joined = F.col("a").isNotNull() & F.col("b").isNotNull() & ~F.col("ok")
    status = F.when(F.col("a").isNull(), "unpriced").when(joined, "bundled").otherwise("priced")
    return sums.select(
        key, status.alias("pricing_status"), F.when(joined, F.col("a") + F.col("b")).otherwise(F.coalesce("a", F.lit(0))).alias("a_cents"),
        F.when(joined | F.col("b").isNull(), 0).otherwise(F.col("b")).alias("b_cents"),
    )


def quantiles(df: DataFrame, keys: list[str], value: str, wanted: dict[str, tuple[float, Column | None]]) -> DataFrame:
    """Exact interpolated quantiles per key: ``wanted`` gives for each name a share and a condition on its rows (None: all).

    Distinct values are counted before the shuffle and summed in order by windows, which spill: no task holds a key's values in memory.
    A key without a row that fulfils a condition has null there.
    """
    each = {name: F.lit(True) if condition is None else condition for name, (_, condition) in wanted.items()}
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(*[F.count_if(c).alias(f"_n_{n}") for n, c in each.items()])
    upto = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    rows = counted.withColumns({f"_u_{n}": F.sum(f"_n_{n}").over(upto) for n in wanted} | {f"_t_{n}": F.sum(f"_n_{n}").over(whole) for n in wanted})
    found = []
    for name, (share, _) in wanted.items():
        at = (F.col(f"_t_{name}") - 1) * share
        here = lambda i, n=name: F.min(F.when((F.col(f"_t_{n}") > 0) & (F.col(f"_u_{n}") > i), F.col(value)))
        found += [here(F.floor(at)).alias(f"_a_{name}"), here(F.ceil(at)).alias(f"_b_{name}"), F.max(at - F.floor(at)).alias(f"_w_{name}")]
    between = lambda n: (F.col(f"_a_{n}") + (F.col(f"_b_{n}") - F.col(f"_a_{n}")) * F.col(f"_w_{n}")).alias(n)
    return rows.groupBy(*keys).agg(*found).select(*keys, *[between(n) for n in wanted])
