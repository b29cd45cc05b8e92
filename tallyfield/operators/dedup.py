"""One row per key: latest, first, marked duplicates, dominant spelling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def dedup_latest(df: DataFrame, keys: list, order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``; state null placement in the order itself."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def latest_by(df: DataFrame, keys: list[str], by: list[str], columns: list[str]) -> DataFrame:
    """Like ``dedup_latest`` with ``by`` descending, as one aggregate: combines before the shuffle, so a hot key is cheap."""
    top = F.max(F.struct(*by, *[c for c in columns if c not in by])).alias("_top")
    return df.groupBy(*keys).agg(top).select(*keys, *[F.col("_top")[c].alias(c) for c in columns])


def mark_duplicates(df: DataFrame, keys: list, order: list[Column], to: str = "is_duplicate") -> DataFrame:
    """Every row but the first of its key marked."""
    return df.withColumn(to, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) > 1)


def dominant_spelling(df: DataFrame, key: Column, spelling: str) -> DataFrame:
    """Per key the most frequent spelling, ties to the smallest: (key, spelling, n, spellings)."""
    counted = df.groupBy(key.alias("key"), spelling).agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("m"), F.col(spelling).alias("s")))
    return (
        counted.groupBy("key").agg(best.alias("b"), F.sum("n").alias("n"), F.count("*").alias("spellings"))
        .select("key", F.col("b.s").alias("spelling"), "n", "spellings")
    )
