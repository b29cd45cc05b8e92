"""Tables on disk: partitions that are appended and refreshed under a guard, versions that one small file makes current, change logs."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import bounded
from .files import exists, names, read_text, write_once


def write_partitions(df: DataFrame, path: str, by: list[str], mode: str = "append") -> None:
    """Write by partition: rows are added (``append``), or the partitions that ``df`` brings are replaced (``overwrite``).

    Rows of a partition come together first, so that it has few files; a large one is split over tasks while they do.
    """
    dealt = df.hint("rebalance", *by)
    dealt.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def refresh_partitions(path: str, batch: DataFrame, by: list[str], percent: float = 90.0) -> DataFrame:
    """Replace those partitions of a table for which ``batch`` has at least ``percent`` of their rows; what was done to each.

    Rows (*by, old_rows, new_rows, action): ``added``, ``refreshed``, ``kept`` (too few new rows) or ``untouched`` (none).  Old rows
    are counted from partition folders and file footers; only partitions that pass are written, the others' files stay as they are.  Null is a
    partition of its own.  ``batch`` must not read the table itself.
    """
    spark = batch.sparkSession
    old = spark.read.parquet(path).groupBy(*by).agg(F.count("*").alias("old_rows"))
    new = batch.groupBy(*by).agg(F.count("*").alias("new_rows"))
    right = new.select(*[F.col(k).alias(f"_{k}") for k in by], "new_rows")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in by])
    action = (
        F.when(F.col("old_rows").isNull(), "added").when(F.col("new_rows").isNull(), "untouched")
        .when(F.col("new_rows") * 100 >= F.col("old_rows") * percent, "refreshed").otherwise("kept")
    )
    key = [F.when(F.col("old_rows").isNull(), F.col(f"_{k}")).otherwise(F.col(k)).alias(k) for k in by]
    rows = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("old_rows", "new_rows")]
    aside = f"{path.rstrip('/')}-refreshes/{uuid.uuid4().hex}"
    old.join(right, same, "full").select(*key, *rows, action.alias("action")).write.parquet(aside)
    done = spark.read.parquet(aside)
    passed = bounded(done.where(F.col("action").isin("added", "refreshed")).select(*by))
    write_partitions(batch.join(passed, _null_safe(batch, passed, by), "left_semi"), path, by, "overwrite")
    return done


def content_hash(df: DataFrame) -> str:
    """Hash of a table's rows, whatever their order: their number and two sums of 64-bit hashes, nulls told apart."""
    told = [c for name in df.columns for c in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())]
    total = lambda seed: F.coalesce(F.sum(F.xxhash64(F.lit(seed), *told).cast("decimal(38,0)")), F.lit(0))
    n, a, b = df.agg(F.count("*"), total(1), total(2)).first()
    return f"{n}:{a}:{b}"


def commits(spark: SparkSession, table: str) -> list[dict]:
    """All versions that were ever made current, oldest first."""
    done = [n for n in names(spark, f"{table}/commits") if n.endswith(".json") and not n.startswith("_")]
    return [json.loads(read_text(spark, f"{table}/commits/{n}")) for n in done]


def publish(df: DataFrame, table: str, about: dict | None = None) -> int:
    """Write ``df`` aside as a whole, then make it the table by one small commit file; its version.

    Readers see the version before or this one, never a part.  If another writer has committed meanwhile, its version
    stands, and this call fails: the number of a commit is given once.
    """
    spark = df.sparkSession
    version, data = len(names(spark, f"{table}/commits")) + 1, f"data/{uuid.uuid4().hex}"
    df.write.parquet(f"{table}/{data}")
    write_once(spark, f"{table}/commits/{version:012d}.json", json.dumps({"version": version, "data": data} | (about or {})))
    return version


def current(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """The table as last committed, or as of an earlier ``version``: its folder never changes under a reader."""
    found = [c for c in commits(spark, table) if version is None or c["version"] == version]
    if not found:
        raise FileNotFoundError(f"{table} has no version{'' if version is None else f' {version}'}")
    return spark.read.parquet(f"{table}/{found[-1]['data']}")


def reload(spark: SparkSession, table: str, load: Callable[[], DataFrame], guard: Callable[[int, int], None] | None = None) -> dict:
    """Clear and reload a table as one step: the record of the run, which is also kept in ``table``/runs.

    A load that fails, or that ``guard`` (rows before, rows after) refuses, leaves the table as it was; one whose content hash is
    that of the current version is ``skipped``, else it is ``success``.  The start of a run is recorded before it.
    """
    number = sum(n.endswith("-start.json") for n in names(spark, f"{table}/runs")) + 1
    write_once(spark, f"{table}/runs/{number:012d}-start.json", json.dumps({"run": number}))
    last = (commits(spark, table) or [None])[-1]
    record = {"run": number, "status": "failed", "rows": None, "version": last["version"] if last else None, "error": None}
    try:
        df = load()
        made = content_hash(df)
        record["rows"] = int(made.split(":")[0])
        if guard and last:
            guard(last["rows"], record["rows"])
        if last and last["hash"] == made:
            record["status"] = "skipped"
        else:
            record |= {"version": publish(df, table, {"hash": made, "rows": record["rows"], "run": number}), "status": "success"}
    except Exception as error:  # whatever stopped the load, the table stands; the record says what it was
        record["error"] = f"{type(error).__name__}: {error}"[:500]
    write_once(spark, f"{table}/runs/{number:012d}-end.json", json.dumps(record))
    return record


def run_records(spark: SparkSession, table: str) -> DataFrame:
    """Runs of a table with status, rows and version; one that never ended is ``running``."""
    schema = "run long, status string, rows long, version long, error string"
    if not exists(spark, f"{table}/runs"):
        return spark.createDataFrame([], schema)
    read = spark.read.schema(schema).option("wholetext", True).json(f"{table}/runs")
    return read.groupBy("run").agg(F.coalesce(F.max("status"), F.lit("running")).alias("status"),
        *[F.max(c).alias(c) for c in ("rows", "version", "error")])


def log_changes(log: str, old: DataFrame | None, new: DataFrame, keys: list[str], run: int, kind: str) -> None:
    """Append what a load changed: (run, *keys, action, old_row, new_row, previous_type), rows whole, on one side null.

    ``previous_type`` is the old row's ``kind``.  A run that is logged again replaces what it had logged.  Keys that repeat
    on a side raise a ValueError: a history has one row a key.
    """
    rest = [c for c in new.columns if c not in keys]
    packed = lambda df, to: df.select(*keys, F.struct(*rest).alias(to), F.lit(1).alias(f"_{to}"))
    sides = [packed(old, "old_row") if old is not None else packed(new.limit(0), "old_row"), packed(new, "new_row")]
    for df in sides:
        if not df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            raise ValueError(f"{', '.join(keys)} repeat in one load")
    both = sides[0].join(sides[1], keys, "full")
    action = (
        F.when(F.col("_old_row").isNull(), "insert").when(F.col("_new_row").isNull(), "delete")
        .when(~F.col("old_row").eqNullSafe(F.col("new_row")), "update")
    )
    changed = both.withColumns({"action": action, "previous_type": F.col(f"old_row.{kind}"), "run": F.lit(run)}).where("action IS NOT NULL")
    rows = changed.select("run", *keys, "action", "old_row", "new_row", "previous_type")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(log)


def replay(changes: DataFrame, keys: list[str], upto: int) -> DataFrame:
    """The table after run ``upto``, from its change log alone: (*keys, the row's columns, run, previous_type) of each key's last change."""
    last = F.max_by(F.struct("action", "new_row", "run", "previous_type"), "run").alias("c")
    state = changes.where(F.col("run") <= upto).groupBy(*keys).agg(last).where("c.action <> 'delete'")
    return state.select(*keys, "c.new_row.*", "c.run", "c.previous_type")
