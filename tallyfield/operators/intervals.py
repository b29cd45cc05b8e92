"""Interval algebra: union of touching intervals, overlap clusters, gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def blocks(df: DataFrame, keys: list[str], start: str, end: str, strict: bool = False) -> DataFrame:
    """``df`` with ``block``, the number of its merged interval within the key (from 0).

    A block opens where a start lies beyond every earlier end: intervals that touch merge.  ``strict``
    opens at an equal end too, so only overlapping intervals meet, and those with equal starts.
    """
    order = Window.partitionBy(*keys).orderBy(start, end)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    reached, same = F.max(end).over(before), F.max(start).over(before)
    opens = (F.col(start) >= reached) & (F.col(start) > same) if strict else F.col(start) > reached
    marked = df.withColumn("_opens", F.coalesce(opens, F.lit(False)).cast("int"))
    return marked.withColumn("block", F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_opens")


def union_intervals(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Merged blocks (keys, block, block_start, block_end, entries) of closed intervals of positive length."""
    closed = df.where(F.col(end).isNotNull() & (F.col(end) > F.col(start)))
    grouped = blocks(closed, keys, start, end).groupBy(*keys, "block")
    return grouped.agg(F.min(start).alias("block_start"), F.max(end).alias("block_end"), F.count("*").alias("entries"))


def overlap_clusters(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Transitive clusters of strictly overlapping intervals, with their size."""
    clustered = blocks(df, keys, start, end, strict=True)
    return clustered.withColumn("cluster_size", F.count("*").over(Window.partitionBy(*keys, "block")))


def gaps(merged: DataFrame, keys: list[str], anchor: str, cap: str, least: int) -> DataFrame:
    """Per key the number and length of pauses between blocks, in the unit of the block columns.

    The first pause runs from ``anchor``; starts are capped; blocks that end at or before the anchor do not count.
    """
    order = Window.partitionBy(*keys).orderBy("block_start")
    after = merged.where(F.col("block_end") > F.col(anchor))
    pause = F.least("block_start", cap) - F.coalesce(F.lag("block_end").over(order), F.col(anchor))
    counted = after.withColumn("pause", pause)
    long = F.col("pause") >= least
    return counted.groupBy(*keys).agg(
        F.count_if(long).alias("gap_count"), F.coalesce(F.sum(F.when(long, F.col("pause"))), F.lit(0)).alias("gap_total"),
        F.coalesce(F.max(F.when(long, F.col("pause"))), F.lit(0)).alias("longest_gap"),
    )


def day_blocks(merged: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the union's length and its block starts and ends as aligned lists, written with commas."""
    pairs = F.array_sort(F.collect_list(F.struct("block_start", "block_end")))
    listed = lambda c: F.array_join(F.transform("_pairs", lambda p: p[c].cast("string")), ",")
    grouped = merged.groupBy(*keys).agg(F.sum(F.col("block_end") - F.col("block_start")).alias("union_seconds"), pairs.alias("_pairs"))
    return grouped.withColumns({"starts": listed("block_start"), "ends": listed("block_end")}).drop("_pairs")


def current_row(df: DataFrame, keys: list[str], since: str, until: str, today: Column, order: list[Column]) -> DataFrame:
    """``is_current``: of a key's rows that cover ``today`` (open ends count) the first by ``order``."""
    covers = F.coalesce(F.col(since) <= today, F.lit(True)) & F.coalesce(F.col(until) >= today, F.lit(True))
    rank = F.row_number().over(Window.partitionBy(*keys, "_covers").orderBy(*order))
    return df.withColumn("_covers", covers).withColumn("is_current", F.col("_covers") & (rank == 1)).drop("_covers")


def close_by_next(df: DataFrame, keys: list[str], order: list[str], start: str, to: str = "closes") -> DataFrame:
    """An interval is open until the key's next one begins: ``to`` is that time, ``is_open`` where there is none yet."""
    after = F.lead(start).over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(to, after).withColumn("is_open", F.col(to).isNull())
