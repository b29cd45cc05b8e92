"""Queries over tables on disk: partitions under a guard, pruned scans, versions, run records, change logs, audits by digests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audits, merge
from ..sources import layout
from ..streaming.loads import shared_folder
from .reports import query


def _monthly(t):
    month = F.trunc(F.to_date("o_orderdate"), "month").alias("month")
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"), month)


MONTHLY = """m AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
  CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS month FROM orders)"""


@query(f"""
WITH {MONTHLY}, held AS (SELECT * FROM m WHERE month < DATE '1998-01-01'),
batch AS (SELECT o_orderkey, cents + 1 AS cents, month FROM m WHERE month >= DATE '1997-01-01' AND NOT (month(month) % 3 = 0 AND o_orderstatus = 'F')),
sizes AS (SELECT month, COALESCE(a.n, 0) AS old_rows, COALESCE(b.n, 0) AS new_rows FROM (SELECT month, count(*) AS n FROM held GROUP BY 1) a
  FULL JOIN (SELECT month, count(*) AS n FROM batch GROUP BY 1) b USING (month)),
done AS (SELECT *, CASE WHEN old_rows = 0 THEN 'added' WHEN new_rows = 0 THEN 'untouched' WHEN new_rows * 100 >= old_rows * 90 THEN 'refreshed'
  ELSE 'kept' END AS action FROM sizes),
now AS (SELECT h.month, h.cents FROM held h JOIN done d ON h.month = d.month AND action IN ('kept', 'untouched')
  UNION ALL SELECT b.month, b.cents FROM batch b JOIN done d ON b.month = d.month AND action IN ('added', 'refreshed'))
SELECT month, action, old_rows, new_rows, n, cents FROM done JOIN (SELECT month, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM now
  GROUP BY 1) USING (month)""")
def partition_refresh(t):
    path, rows = f"{shared_folder(t.spark)}/orders", _monthly(t)
    layout.write_partitions(rows.where("month < DATE '1996-01-01'"), path, ["month"])
    layout.write_partitions(rows.where("month >= DATE '1996-01-01' AND month < DATE '1998-01-01'"), path, ["month"])
    pulled = rows.where("month >= DATE '1997-01-01' AND NOT (month(month) % 3 = 0 AND o_orderstatus = 'F')")
    done = layout.refresh_partitions(path, pulled.withColumn("cents", F.col("cents") + 1), ["month"])
    now = t.spark.read.parquet(path).groupBy("month").agg(F.count("*").alias("n"), F.sum("cents").alias("cents"))
    return done.join(now, "month").select("month", "action", "old_rows", "new_rows", "n", "cents")


@query(f"""
WITH {MONTHLY}, calendar AS (SELECT DISTINCT month, quarter(month) AS quarter FROM m)
SELECT month, o_orderstatus, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM m JOIN calendar USING (month)
WHERE quarter = 3 AND month >= DATE '1996-01-01' GROUP BY 1, 2""")
def pruned_scan(t):
    folder = shared_folder(t.spark)
    layout.write_partitions(_monthly(t), f"{folder}/orders", ["month"])
    months = t.spark.read.parquet(f"{folder}/orders").select("month").distinct()
    months.withColumn("quarter", F.quarter("month")).write.parquet(f"{folder}/calendar")
    return pruned(t.spark.read.parquet(f"{folder}/orders"), t.spark.read.parquet(f"{folder}/calendar"))


def pruned(orders, calendar):
    """Late third quarters: one filter prunes partitions when the query is planned, the join prunes them when it runs."""
    both = orders.where("month >= DATE '1996-01-01'").join(calendar.where("quarter = 3"), "month")
    return both.groupBy("month", "o_orderstatus").agg(F.count("*").alias("n"), F.sum("cents").alias("cents"))


def _reloads(t):
    """Five loads of one table: a good one, one that breaks in the middle, a good one, the same again, and one that lost too much."""
    table = f"{shared_folder(t.spark)}/customers"
    rows = t.customer.select("c_custkey", "c_mktsegment", F.round(F.col("c_acctbal") * 100).cast("long").alias("cents"))
    broken = rows.withColumn("cents", F.when(F.col("cents") < 0, F.raise_error(F.lit("the source broke off"))).otherwise(F.col("cents")))
    loads = [rows.where("c_mktsegment <> 'BUILDING'"), broken, rows, rows.orderBy("cents"), rows.where("cents < 0")]
    for df in loads:
        layout.reload(t.spark, table, lambda df=df: df, merge.guard_wipe)
    return table


@query("""SELECT c_custkey, c_mktsegment, CAST(round(c_acctbal * 100) AS BIGINT) AS cents FROM customer""")
def swap_reload(t):
    return layout.current(t.spark, _reloads(t))


@query("""
WITH n AS (SELECT count(*) AS n, count(*) FILTER (WHERE c_mktsegment <> 'BUILDING') AS part, count(*) FILTER (WHERE round(c_acctbal * 100) < 0) AS few
  FROM customer)
SELECT CAST(1 AS BIGINT) AS run, 'success' AS status, part AS rows, CAST(1 AS BIGINT) AS version FROM n UNION ALL SELECT 2, 'failed', NULL, 1 FROM n
UNION ALL SELECT 3, 'success', n, 2 FROM n UNION ALL SELECT 4, 'skipped', n, 2 FROM n UNION ALL SELECT 5, 'failed', few, 2 FROM n""")
def load_records(t):
    return layout.run_records(t.spark, _reloads(t)).select("run", "status", "rows", "version")


@query("""
WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, year(o_orderdate) AS y FROM orders)
SELECT o_orderkey, o_custkey, o_orderstatus, cents, CASE WHEN y < 1996 AND o_orderstatus = 'O' THEN 1 ELSE 2 END AS run,
  CASE WHEN y < 1996 AND o_orderstatus <> 'O' THEN 'O' END AS previous_type FROM o WHERE y < 1997""")
def history_replay(t):
    """Three loads of orders (all still open; as they are, a year more; without the pending ones, all years), and the state after the second."""
    log, keys = f"{shared_folder(t.spark)}/orders-log", ["o_orderkey"]
    year = F.year("o_orderdate")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"), year.alias("y"))
    loads = [rows.where("y < 1996").withColumn("o_orderstatus", F.lit("O")), rows.where("y < 1997"), rows.where("o_orderstatus <> 'P'")]
    before = None
    for run, df in enumerate(loads, 1):
        df = df.drop("y")
        layout.log_changes(log, before, df, keys, run, "o_orderstatus")
        before = df
    return layout.replay(t.spark.read.parquet(log), keys, 2).select("o_orderkey", "o_custkey", "o_orderstatus", "cents", "run", "previous_type")


@query("""
WITH a AS (SELECT o_orderpriority AS g, o_orderkey AS k, o_custkey AS c, o_orderstatus AS s, o_totalprice AS v, CAST(o_orderdate AS DATE) AS d FROM orders),
b AS (SELECT g, k, c, CASE WHEN g = '1-URGENT' AND d >= DATE '2001-05-01' THEN 'X' WHEN g = '2-HIGH' AND s = 'P' THEN 'X' ELSE s END AS s,
  v + CASE WHEN g = '3-MEDIUM' THEN 0.001 WHEN g = '2-HIGH' AND v < 2000 THEN 5 ELSE 0 END AS v, d FROM a
  WHERE NOT (g = '1-URGENT' AND c < 20) AND NOT (g = '2-HIGH' AND v > 300000)
  UNION ALL SELECT g, -k, c, s, v, d FROM a WHERE g = '3-MEDIUM' AND v < 3000),
live AS (SELECT DISTINCT c FROM b),
j AS (SELECT COALESCE(a.g, b.g) AS g, a.k IS NULL AS extra, b.k IS NULL AS gone, a.c IN (SELECT c FROM live) AS live,
  a.s IS DISTINCT FROM b.s AS ds, abs(a.v - b.v) > 0.01 AS dv, a.d BETWEEN DATE '2001-07-31' - 60 AND DATE '2001-07-31' AS fresh, a.k IS NULL OR b.k IS NULL OR ds
  OR a.v IS DISTINCT FROM b.v AS differs FROM a FULL JOIN b ON a.g = b.g AND a.k = b.k),
n AS (SELECT g AS o_orderpriority, count(*) FILTER (WHERE NOT extra) AS old_rows, count(*) FILTER (WHERE NOT gone) AS new_rows,
  NOT bool_or(differs) AS hash_match, count(*) FILTER (WHERE gone AND NOT live) AS ghost, count(*) FILTER (WHERE gone AND live) AS missing,
  count(*) FILTER (WHERE extra) AS extra, count(*) FILTER (WHERE NOT extra AND NOT gone AND ds AND NOT dv AND fresh) AS lag,
  count(*) FILTER (WHERE NOT extra AND NOT gone AND (ds OR dv) AND NOT (ds AND NOT dv AND fresh)) AS differing FROM j GROUP BY g)
SELECT *, missing = 0 AND differing = 0 AS passes FROM n""")
def hashed_audit(t):
    old = t.orders.select("o_orderpriority", F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_orderstatus").alias("s"),
        F.col("o_totalprice").alias("v"), F.to_date("o_orderdate").alias("d"))
    urgent, high, medium = (F.col("o_orderpriority") == p for p in ("1-URGENT", "2-HIGH", "3-MEDIUM"))
    status = F.when((urgent & (F.col("d") >= "2001-05-01")) | (high & (F.col("s") == "P")), "X").otherwise(F.col("s"))
    value = F.col("v") + F.when(medium, 0.001).when(high & (F.col("v") < 2000), 5.0).otherwise(0.0)
    new = old.where(~(urgent & (F.col("c") < 20)) & ~(high & (F.col("v") > 300_000))).withColumns({"s": status, "v": value})
    new = new.unionByName(old.where(medium & (F.col("v") < 3000)).withColumn("k", -F.col("k")))
    today = F.lit("2001-07-31").cast("date")
    return audits.audit_by_hash(old, new, "o_orderpriority", ["k"], {"s": None, "v": 0.01}, "c", "d", today, ("s",), 60)
