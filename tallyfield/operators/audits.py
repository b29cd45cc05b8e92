"""Audits: duplicates, schedule findings, health of runs, counts and column differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import bounded


def duplicate_groups(df: DataFrame, key: str, id_col: str, used: str) -> DataFrame:
    """Keys with several ids: how many are used, and what to do about it."""
    counted = df.groupBy(key).agg(F.count("*").alias("assets"), F.count_if(used).alias("used"), F.min(id_col).alias("first_id")).where("assets > 1")
    return counted.withColumn("verdict", F.when(F.col("used") > 1, "merge_needed").when(F.col("used") == 1, "delete_empty").otherwise("all_empty"))


def schedule_findings(df: DataFrame, planned: str, seen: str) -> DataFrame:
    """``finding`` of two minutes of the day, the first rule that holds: equal, swapped halves of the day, no time given, far, moved, near."""
    apart = F.abs(F.col(planned) - F.col(seen))
    finding = (
        F.when(apart == 0, "ok").when(apart == 720, "12 h flip").when(F.col(planned) == 0, "date only")
        .when(apart > 360, "ghost").when(apart > 60, "moved").otherwise("near")
    )
    return df.withColumn("finding", finding)


def health(runs: DataFrame, key: str, today: Column, stale_days: int, slow_seconds: int) -> DataFrame:
    """State of every pipeline from its runs (run, status, day, seconds): failed, stale, slow or healthy."""
    last = F.max_by("status", F.struct("day", "run")).alias("last")
    good = F.max(F.when(F.col("status") == "success", F.col("day"))).alias("last_good")
    seen = runs.groupBy(key).agg(last, good, F.count_if(F.col("status") == "failed").alias("failed"), F.max("seconds").alias("longest"))
    stale = F.col("last_good").isNull() | (F.date_diff(today, "last_good") > stale_days)
    state = F.when(F.col("last") == "failed", "failed").when(stale, "stale").when(F.col("longest") > slow_seconds, "slow").otherwise("healthy")
    return seen.select(key, state.alias("state"), "failed", "last_good")


def counts_differ(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> DataFrame:
    """Row counts of tables before and after a step, and whether they are equal."""
    count = lambda df, to: df.agg(F.count("*").alias(to))
    rows = [count(df, "raw_rows").withColumn("name", F.lit(n)).join(count(after[n], "loaded_rows").withColumn("name", F.lit(n)), "name") for n,
        df in before.items()]
    return reduce(DataFrame.unionByName, rows).withColumn("equal", F.col("raw_rows") == F.col("loaded_rows"))


def column_differences(old: DataFrame, new: DataFrame, keys: list[str], columns: dict[str, float | None]) -> DataFrame:
    """Keys that are missing in ``new``, extra in it, or differ: ``finding`` names that or the columns.

    A number beside a column is the difference that is let pass.
    """
    both = old.withColumn("_o", F.lit(True)).alias("o").join(new.withColumn("_n", F.lit(True)).alias("n"), keys, "full")

    def differs(c: str, tolerance: float | None) -> Column:
        a, b = F.col(f"o.{c}"), F.col(f"n.{c}")
        return ~a.eqNullSafe(b) if tolerance is None else F.coalesce(F.abs(a - b) > tolerance, ~a.eqNullSafe(b))

    names = F.array_compact(F.array(*[F.when(differs(c, tolerance), F.lit(c)) for c, tolerance in columns.items()]))
    finding = F.when(F.col("_n").isNull(), "missing").when(F.col("_o").isNull(), "extra").when(F.size(names) > 0, F.array_join(names, ","))
    return both.select(*keys, finding.alias("finding")).where("finding IS NOT NULL")


def digests(df: DataFrame, group: str, keys: list[str], columns: list[str], buckets: int) -> DataFrame:
    """Rows and digests of each bucket of keys in each group: sums of hashes of whole rows, nulls told apart, so order does not count."""
    told = [c for name in [*keys, *columns] for c in (F.col(name), F.col(name).isNull())]
    total = lambda seed: F.sum(F.xxhash64(F.lit(seed), *told).cast("decimal(38,0)"))
    return df.groupBy(group, key_bucket(keys, buckets).alias("bucket")).agg(F.count("*").alias("n"), total(1).alias("d1"), total(2).alias("d2"))


def key_bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets))


def digest_differences(old: DataFrame, new: DataFrame, group: str, keys: list[str], columns: list[str], buckets: int) -> DataFrame:
    """Two levels: every group with (old_rows, new_rows, hash_match), and ``open``: its buckets whose digests differ, as an array."""
    sides = [digests(df, group, keys, columns, buckets).select(F.col(group).alias(f"{s}_g"), F.col("bucket").alias(f"{s}_b"),
        F.struct("n", "d1", "d2").alias(s)) for s, df in (("o", old), ("w", new))]
    both = sides[0].join(sides[1], F.col("o_g").eqNullSafe(F.col("w_g")) & (F.col("o_b") == F.col("w_b")), "full")
    name = F.when(F.col("o").isNull(), F.col("w_g")).otherwise(F.col("o_g")).alias(group)
    differs = F.when(~F.col("o").eqNullSafe(F.col("w")), F.coalesce("o_b", "w_b"))
    n = lambda side: F.coalesce(F.sum(f"{side}.n"), F.lit(0)).cast("long")
    rolled = both.groupBy(name).agg(n("o").alias("old_rows"), n("w").alias("new_rows"), F.collect_list(differs).alias("open"))
    return rolled.withColumn("hash_match", F.size("open") == 0)


def rows_of_open_buckets(df: DataFrame, tree: DataFrame, group: str, keys: list[str], buckets: int) -> DataFrame:
    """Rows of those buckets whose digests differ: what is equal is left out before anything is shuffled."""
    open_ = bounded(tree.where("NOT hash_match").select(F.col(group).alias("_g"), F.explode("open").alias("_b")))
    return df.join(open_, F.col(group).eqNullSafe(F.col("_g")) & (key_bucket(keys, buckets) == F.col("_b")), "left_semi")


def audit_by_hash(
    old: DataFrame, new: DataFrame, group: str, keys: list[str], columns: dict[str, float | None], asset: str, at: str, today: Column,
    lag_columns: tuple[str, ...], lag_days: int, buckets: int = 4096,
) -> DataFrame:
    """Does a second load agree with the first?  One row a group, by rules that tell what is explained from what is not.

    Groups of equal digests match; of the others only rows of differing buckets are compared.  Rows that ``new`` lacks are
    ``ghost`` where it has no row of their ``asset`` at all, else ``missing``; rows it has beyond are ``extra``, which is let pass.
    Rows that differ (beyond the tolerance that ``columns`` names) only in ``lag_columns``, and whose ``at`` is at most ``lag_days`` before
    ``today``, are ``lag``, else ``differing``.  A group passes with nothing missing and nothing differing.
    """
    # The digests are small, and four steps read them: they are written once.
    tree = digest_differences(old, new, group, keys, list(columns), buckets).persist()
    sides = [rows_of_open_buckets(df, tree, group, keys, buckets) for df in (old, new)]
    found = column_differences(sides[0], sides[1], [group, *keys], columns)
    live = new.select(F.col(asset).alias("_asset")).distinct().withColumn("_live", F.lit(True))
    told = sides[0].select(group, *keys, F.col(asset).alias("_asset"), F.col(at).alias("_at"))
    named = found.join(told, [group, *keys], "left").join(live, "_asset", "left")
    only_lag = F.size(F.array_except(F.split("finding", ","), F.array(*[F.lit(c) for c in lag_columns]))) == 0
    fresh = F.date_diff(today, F.col("_at")).between(0, lag_days)
    verdict = (
        F.when(F.col("finding") == "extra", "extra").when(F.col("finding") == "missing", F.when(F.col("_live"), "missing").otherwise("ghost"))
        .when(only_lag & F.coalesce(fresh, F.lit(False)), "lag").otherwise("differing")
    )
    kinds = ["ghost", "missing", "extra", "lag", "differing"]
    counted = named.withColumn("verdict", verdict).groupBy(F.col(group).alias("_g")).agg(*[F.count_if(F.col("verdict") == k).alias(k) for k in kinds])
    joined = tree.join(counted, F.col(group).eqNullSafe(F.col("_g")), "left")
    filled = [F.coalesce(k, F.lit(0)).cast("long").alias(k) for k in kinds]
    out = joined.select(group, "old_rows", "new_rows", "hash_match", *filled)
    return out.withColumn("passes", (F.col("missing") == 0) & (F.col("differing") == 0))
