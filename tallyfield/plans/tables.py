"""The driver tables as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Tables:
    """Parquet tables of one folder by attribute: ``Tables(spark, folder).orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def minute(column: str):
    """Whole minutes since 1970 of a timestamp without zone (the session's zone is UTC)."""
    return F.floor(F.unix_timestamp(F.col(column).cast("timestamp")) / 60).cast("long")


def second(column: str):
    return F.unix_timestamp(F.col(column).cast("timestamp"))
