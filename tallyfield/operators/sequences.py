"""Spines, day explosion, snapshot flow, overlays and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .joins import bounded


def fill_spine(counted: DataFrame, keys: list[str], at: str, step: str, columns: list[str]) -> DataFrame:
    """Every step from each key's first to its last with zeros for steps without a row."""
    edges = counted.groupBy(*keys).agg(F.min(at).alias("_a"), F.max(at).alias("_b"))
    spine = edges.select(*keys, F.explode(F.expr(f"sequence(_a, _b, interval {step})")).alias(at))
    return spine.join(counted, [*keys, at], "left").fillna(0, subset=columns)


def explode_days(df: DataFrame, start: str, end: str, to: str = "day") -> DataFrame:
    """One row for every day from ``start`` to ``end``, both included; none where end is before start."""
    return df.where(F.col(end) >= F.col(start)).withColumn(to, F.explode(F.sequence(F.col(start), F.col(end))))


def snapshot_flow(df: DataFrame, key: str, snapshot: str) -> DataFrame:
    """Per snapshot (but the first) how many keys are new, carried and gone against the one before.

    The previous snapshot is the lag over distinct dates; one full outer join on key and date.
    """
    dates = df.select(snapshot).distinct()
    before = F.lag(snapshot).over(Window.orderBy(snapshot))  # distinct dates only: few rows
    follows = dates.withColumn("_prev", before).where("_prev IS NOT NULL")
    rows = df.select(key, snapshot).distinct()
    follows = bounded(follows)
    now = rows.join(follows.select(snapshot), snapshot).withColumn("_now", F.lit(True))
    then = rows.withColumnRenamed(snapshot, "_prev").join(follows, "_prev").select(key, snapshot).withColumn("_then", F.lit(True))
    both = now.join(then, [key, snapshot], "full")
    return both.groupBy(snapshot).agg(
        F.count_if(F.col("_then").isNull()).alias("new"), F.count_if(F.col("_then") & F.col("_now")).alias("carried"),
        F.count_if(F.col("_now").isNull()).alias("gone"),
    )


def overlay(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """All of ``first``, and of ``second`` what has no key there."""
    return first.unionByName(second.join(first.select(*keys).distinct(), keys, "left_anti"))


def grants(role: DataFrame, deny: DataFrame, allow: DataFrame, keys: list[str]) -> DataFrame:
    """Granted by role and not denied, or allowed."""
    return role.select(*keys).join(deny.select(*keys), keys, "left_anti").union(allow.select(*keys)).distinct()


def filtered(df: DataFrame, equal: dict | None = None, least: dict | None = None, contains: dict | None = None) -> DataFrame:
    """Optional parameters: those that are None add no predicate at all."""
    for column, value in (equal or {}).items():
        df = df if value is None else df.where(F.col(column).isin(value) if isinstance(value, list) else F.col(column) == value)
    for column, value in (least or {}).items():
        df = df if value is None else df.where(F.col(column) >= value)
    for column, value in (contains or {}).items():
        df = df if value is None else df.where(F.contains(F.lower(column), F.lit(value.lower())))
    return df


def page(df: DataFrame, sort: list[tuple[str, bool]], tie: str, offset: int, limit: int) -> DataFrame:
    """Rows in the order of ``sort`` (column, descending), nulls last, then ``tie``; the limit is kept within 0 to 1000."""
    order: list[Column] = [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in sort]
    return df.orderBy(*order, tie).offset(max(0, offset)).limit(min(1000, max(0, limit)))


def effective_date(df: DataFrame, due: str, planned: str, stale_days: int, to: str = "effective") -> DataFrame:
    """A planned date overrides the due one unless it is an anomaly, which ``anomaly`` names.

    none: nothing planned; same: no change; ghost: planned before it was due; stale: too far ahead to be believed; moved: taken.
    """
    anomaly = (
        F.when(F.col(planned).isNull(), "none").when(F.col(planned).eqNullSafe(F.col(due)), "same").when(F.col(planned) < F.col(due), "ghost")
        .when(F.date_diff(planned, due) > stale_days, "stale").otherwise("moved")
    )
    return df.withColumn("anomaly", anomaly).withColumn(to, F.when(F.col("anomaly") == "moved", F.col(planned)).otherwise(F.col(due)))


def options(df: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct values of a column that are not blank, under the name of their list."""
    return df.where(F.trim(F.coalesce(column, F.lit(""))) != "").select(F.lit(name).alias("list"), F.col(column).alias("option")).distinct()
