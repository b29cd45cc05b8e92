"""Streams: upserts by micro-batch, windows under a watermark, sessions, alert states."""

from __future__ import annotations

import re
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import latest_by
from ..operators.joins import bounded


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder under the session's checkpoint directory; a local one only where none is set and Spark runs on one machine."""
    import tempfile

    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tallyfield-"))
    return f"{context.getCheckpointDir()}/stream-{uuid.uuid4().hex}"


def file_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The files of one table of a folder as a stream; its schema is read once."""
    schema = spark.read.parquet(f"{folder}/{name}").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", name).option("maxFilesPerTrigger", 1).parquet(folder)


def upserted(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame:
    """The table that ``upsert`` keeps in ``folder``: of every bucket its latest version (of those before ``before``)."""
    written = spark.read.option("basePath", f"{folder}/table").parquet(f"{folder}/table/version=*")
    if before is not None:
        written = written.where(F.col("version") < before)
    latest = written.groupBy("bucket").agg(F.max("version").alias("version"))
    return written.join(bounded(latest), ["bucket", "version"])


def upsert(
    stream: DataFrame, keys: list[str], by: list[str], columns: list[str], folder: str, trigger: dict | None = None, buckets: int = 64,
) -> DataFrame:
    """Keep the latest row of each key in a table of hash buckets; returns the table when the stream has stopped.

    Every micro-batch is reduced to its latest row a key, merged with the buckets that those keys lie in, and only these are
    written, as a version of the batch's number: a batch that runs twice writes the same version again.
    """

    def merge(batch: DataFrame, number: int) -> None:
        new = latest_by(batch, keys, by, columns).withColumn("bucket", F.pmod(F.hash(*keys), F.lit(buckets)))
        if number > 0:
            held = upserted(batch.sparkSession, folder, number).join(bounded(new.select("bucket").distinct()), "bucket", "left_semi")
            new = latest_by(held.drop("version").unionByName(new), [*keys, "bucket"], by, columns)
        new.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/table/version={number}")

    job = stream.writeStream.foreachBatch(merge).option("checkpointLocation",
        f"{folder}/state").trigger(**(trigger or {"availableNow": True})).start()
    job.awaitTermination()
    return upserted(stream.sparkSession, folder).drop("bucket", "version")


def windowed(stream: DataFrame, at: str, delay: str, length: str, keys: list[str]) -> DataFrame:
    """Counts and sums of tumbling windows; rows later than ``delay`` are left out by the watermark."""
    return stream.withWatermark(at, delay).groupBy(F.window(at, length), *keys).agg(F.count("*").alias("n"))


def sessions(stream: DataFrame, at: str, delay: str, gap: str, keys: list[str]) -> DataFrame:
    """Rows of a key that lie less than ``gap`` apart form one session."""
    return stream.withWatermark(at, delay).groupBy(F.session_window(at, gap), *keys).agg(F.count("*").alias("n"))


def deduplicated(stream: DataFrame, at: str, delay: str, keys: list[str]) -> DataFrame:
    """First row of each key; a key is forgotten once the watermark has passed it."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def alerts(stream: DataFrame, key: str, failed: str, remind_every: int) -> DataFrame:
    """Per row of a key, in the order of ``seq``: alert at the first failure, remind at every ``remind_every``-th, recover after one, else none."""

    def step(keys, frames, state):
        failures = state.get[0] if state.exists else 0
        kinds, counts = [], []
        held = pd.concat([frame[["seq", failed]] for frame in frames])  # a key's rows of a batch come in frames of 10,000, in no order
        for bad in held.sort_values("seq")[failed]:
            if bad:
                failures += 1
                kinds.append("alert" if failures == 1 else "remind" if (failures - 1) % remind_every == 0 else "none")
            else:
                kinds.append("recover" if failures else "none")
                failures = 0
            counts.append(failures)
        state.update((failures,))
        yield pd.DataFrame({key: [keys[0]] * len(kinds), "state": kinds, "failures": counts})

    kind = stream.schema[key].dataType.simpleString()
    return stream.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, state string, failures long", "failures long", "append", "NoTimeout")


def write_available(stream: DataFrame, folder: str, mode: str = "append") -> str:
    """Run a stream over what is there now into a Parquet folder."""
    out = f"{folder}/out"
    stream.writeStream.outputMode(mode).format("parquet").option("path", out).option("checkpointLocation",
        f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return out
