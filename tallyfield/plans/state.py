"""Queries over intervals, snapshots and stateful tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import intervals, merge, sequences
from .reports import query
from .tables import second

SPANS = """SELECT event_id, user_id, CAST(ts AS DATE) AS day, floor(epoch(ts))::BIGINT AS s,
  floor(epoch(ts))::BIGINT + CAST(floor(value) AS BIGINT) * 60 AS e FROM events"""


def _spans(t):
    start = second("ts")
    return t.events.select("event_id", "user_id", F.to_date("ts").alias("day"), start.alias("s"), (start + F.floor("value") * 60).alias("e"))


BLOCKS = f"""x AS ({SPANS}), y AS (SELECT *, max(e) OVER (PARTITION BY user_id, day ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING
  AND 1 PRECEDING) AS m FROM x WHERE e > s),
z AS (SELECT *, sum(CASE WHEN s > m THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, day ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING
  AND CURRENT ROW) AS block FROM y),
b AS (SELECT user_id, day, block, min(s) AS bs, max(e) AS be, count(*) AS entries FROM z GROUP BY 1, 2, 3)"""


@query(f"""WITH {BLOCKS} SELECT user_id, day, count(*) AS blocks, CAST(sum(be - bs) AS BIGINT) AS union_seconds,
  CAST(sum(entries) AS BIGINT) AS entries, min(bs) AS first_start, max(be) AS last_end FROM b GROUP BY 1, 2""")
def interval_union(t):
    merged = intervals.union_intervals(_spans(t), ["user_id", "day"], "s", "e")
    return merged.groupBy("user_id", "day").agg(F.count("*").alias("blocks"),
        F.sum(F.col("block_end") - F.col("block_start")).alias("union_seconds"), F.sum("entries").alias("entries"),
                                                F.min("block_start").alias("first_start"), F.max("block_end").alias("last_end"))


@query(f"""
WITH {BLOCKS}, a AS (SELECT *, epoch(day::TIMESTAMP)::BIGINT + 28800 AS anchor, epoch(day::TIMESTAMP)::BIGINT + 64800 AS cap FROM b),
g AS (SELECT *, least(bs, cap) - COALESCE(lag(be) OVER (PARTITION BY user_id, day ORDER BY bs), anchor) AS pause FROM a WHERE be > anchor)
SELECT user_id, day, count(*) FILTER (WHERE pause >= 1260) AS gap_count, CAST(COALESCE(sum(pause) FILTER (WHERE pause >= 1260),
  0) AS BIGINT) AS gap_total, COALESCE(max(pause) FILTER (WHERE pause >= 1260), 0) AS longest_gap FROM g GROUP BY 1, 2""")
def gap_stats(t):
    merged = intervals.union_intervals(_spans(t), ["user_id", "day"], "s", "e")
    midnight = F.unix_timestamp(F.col("day").cast("timestamp"))
    anchored = merged.withColumns({"anchor": midnight + 28800, "cap": midnight + 64800})
    return intervals.gaps(anchored, ["user_id", "day"], "anchor", "cap", 1260)


@query(f"""
WITH x AS ({SPANS}), y AS (SELECT *, max(e) OVER w AS m, max(s) OVER w AS ms FROM x WINDOW w AS (PARTITION BY user_id ORDER BY s,
  e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
z AS (SELECT *, sum(CASE WHEN s >= m AND s > ms THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING
  AND CURRENT ROW) AS block FROM y)
SELECT event_id, user_id, CAST(block AS BIGINT) AS block, count(*) OVER (PARTITION BY user_id, block) AS cluster_size FROM z""")
def interval_overlap_clusters(t):
    return intervals.overlap_clusters(_spans(t), ["user_id"], "s", "e").select("event_id", "user_id", "block", "cluster_size")


REVENUE = f"""WITH {BLOCKS}, d AS (SELECT user_id, day, CAST(sum(be - bs) AS BIGINT) AS worked FROM b GROUP BY 1, 2),
m AS (SELECT user_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS amount FROM events WHERE event_type = 'purchase' GROUP BY 1),
j AS (SELECT d.*, amount, CAST(sum(worked) OVER (PARTITION BY user_id) AS BIGINT) AS total FROM d JOIN m USING (user_id))
SELECT user_id, day, worked, CASE WHEN total > 0 THEN CAST((CAST(amount AS HUGEINT) * worked * 2 + total) // (CAST(total AS HUGEINT) * 2) AS BIGINT)
  ELSE 0 END AS revenue_cents FROM j"""


@query(REVENUE)
def revenue_member_day(t):
    from ..operators.aggregates import allocate, cents

    worked = interval_union(t).select("user_id", "day", F.col("union_seconds").alias("worked"))
    earned = t.events.where("event_type = 'purchase'").groupBy("user_id").agg(F.sum(cents("value")).cast("decimal(19,0)").alias("amount"))
    return allocate(worked.join(earned, "user_id"), ["user_id"], "amount", "worked", "revenue_cents").select("user_id", "day", "worked",
        "revenue_cents")


TARGET = "SELECT o_orderkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders WHERE o_orderkey % 10 <> 1"
SOURCE = """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
  CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders WHERE o_orderkey % 10 <> 2"""


def _snapshots(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    new = rows.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus")))
    return rows.where("o_orderkey % 10 <> 1"), new.where("o_orderkey % 10 <> 2")


@query(f"""SELECT COALESCE(t.o_orderkey, s.o_orderkey) AS o_orderkey, CASE WHEN t.o_orderkey IS NULL THEN 'insert'
  WHEN s.o_orderkey IS NULL THEN 'delete'
  WHEN t.o_orderstatus IS DISTINCT FROM s.o_orderstatus OR t.cents IS DISTINCT FROM s.cents THEN 'update' ELSE 'keep' END AS action FROM ({TARGET}) t
  FULL JOIN ({SOURCE}) s ON t.o_orderkey = s.o_orderkey""")
def snapshot_merge_actions(t):
    return merge.snapshot_actions(*_snapshots(t), ["o_orderkey"])


@query(f"""SELECT o_orderkey, CASE WHEN written THEN new_status ELSE old_status END AS o_orderstatus, CASE WHEN written THEN new_cents
  ELSE old_cents END AS cents, CASE WHEN written THEN 'r1' ELSE 'r0' END AS run FROM (
SELECT COALESCE(t.o_orderkey, s.o_orderkey) AS o_orderkey, t.o_orderstatus AS old_status, s.o_orderstatus AS new_status, t.cents AS old_cents,
  s.cents AS new_cents,
  t.o_orderkey IS NULL OR (s.o_orderkey IS NOT NULL AND (t.o_orderstatus IS DISTINCT FROM s.o_orderstatus OR t.cents IS DISTINCT
  FROM s.cents)) AS written
FROM ({TARGET}) t FULL JOIN ({SOURCE}) s ON t.o_orderkey = s.o_orderkey)""")
def snapshot_merged(t):
    old, new = _snapshots(t)
    return merge.merge_snapshot(old.withColumn("run", F.lit("r0")), new.withColumn("run", F.lit("r1")), ["o_orderkey"], ignore=("run",), delete=False)


@query(f"""SELECT t.o_orderkey, t.o_orderstatus FROM ({TARGET}) t LEFT JOIN ({SOURCE}) s ON t.o_orderkey = s.o_orderkey
  WHERE s.o_orderkey IS NULL OR s.o_orderstatus IS DISTINCT FROM t.o_orderstatus""")
def set_diff_snapshots(t):
    old, new = _snapshots(t)
    return old.select("o_orderkey", "o_orderstatus").subtract(new.select("o_orderkey", "o_orderstatus"))


@query(f"""SELECT t.o_orderkey, CASE WHEN s.o_orderkey IS NOT NULL THEN NULL WHEN t.o_orderkey % 3 = 0 THEN DATE '2001-01-01'
  ELSE DATE '2001-09-01' END AS missing_since FROM ({TARGET}) t LEFT JOIN ({SOURCE}) s ON t.o_orderkey = s.o_orderkey""")
def presence_tombstone(t):
    old, new = _snapshots(t)
    known = old.select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit("2001-01-01").cast("date")).alias("missing_since"))
    return merge.tombstones(known, new, ["o_orderkey"], F.lit("2001-09-01").cast("date"))


@query("""
SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r
  FROM events e WHERE ts < TIMESTAMP '2024-01-28'
AND NOT EXISTS (SELECT 1 FROM events n WHERE n.ts >= TIMESTAMP '2024-01-28' AND n.user_id = e.user_id AND n.event_type = e.event_type))
  WHERE r = 1""")
def carry_forward(t):
    new = F.col("ts") >= F.lit("2024-01-28").cast("timestamp_ntz")
    lost = merge.carry_forward(t.events.where(~new), t.events.where(new), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")])
    return lost.select("user_id", "event_type", "event_id")


@query("""
WITH batch AS (SELECT o_orderkey + 10000000 AS o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE year(o_orderdate) = 1997
  AND month(o_orderdate) < 4)
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE date_trunc('month', o_orderdate) NOT IN (SELECT DISTINCT date_trunc('month',
  day::TIMESTAMP) FROM batch) UNION ALL SELECT * FROM batch""")
def replace_by_period(t):
    rows = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    batch = rows.where("year(day) = 1997 AND month(day) < 4").withColumn("o_orderkey", F.col("o_orderkey") + 10000000)
    return merge.replace_by_period(rows, batch, F.trunc("day", "month"))


@query("""
WITH a AS (SELECT p_type, p_size, min(p_brand) AS v0 FROM part GROUP BY 1, 2 HAVING count(DISTINCT p_brand) = 1), b AS (SELECT p_type,
  min(p_brand) AS v1 FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) = 1)
SELECT p_partkey, COALESCE(CASE WHEN p_partkey % 4 <> 0 THEN p_brand END, v0, v1) AS brand FROM part p LEFT JOIN a ON p.p_type = a.p_type
  AND p.p_size = a.p_size LEFT JOIN b ON p.p_type = b.p_type""")
def unique_only_backfill(t):
    holes = t.part.select("p_partkey", "p_type", "p_size", F.when(F.col("p_partkey") % 4 != 0, F.col("p_brand")).alias("brand"))
    return merge.unique_backfill(holes, "brand", t.part.withColumnRenamed("p_brand", "value"), [["p_type", "p_size"], ["p_type"]],
        "value").select("p_partkey", "brand")


@query("""
WITH k AS (SELECT DISTINCT o_custkey, CAST(date_trunc('year', o_orderdate) AS DATE) AS year FROM orders), d AS (SELECT year,
  lag(year) OVER (ORDER BY year) AS prev FROM (SELECT DISTINCT year FROM k)),
n AS (SELECT k.o_custkey, k.year FROM k JOIN d ON k.year = d.year AND prev IS NOT NULL), p AS (SELECT k.o_custkey, d.year FROM k
  JOIN d ON k.year = d.prev)
SELECT COALESCE(n.year, p.year) AS year, count(*) FILTER (WHERE p.year IS NULL) AS new, count(*) FILTER (WHERE p.year IS NOT NULL
  AND n.year IS NOT NULL) AS carried, count(*) FILTER (WHERE n.year IS NULL) AS gone
FROM n FULL JOIN p ON n.o_custkey = p.o_custkey AND n.year = p.year GROUP BY 1""")
def lag_snapshot_flow(t):
    return sequences.snapshot_flow(t.orders.select("o_custkey", F.trunc(F.to_date("o_orderdate"), "year").alias("year")), "o_custkey", "year")


@query("""
WITH c AS (SELECT event_type, CAST(date_trunc('week', ts - INTERVAL 1 DAY) AS DATE) + 1 AS week, count(*) AS n FROM events GROUP BY 1, 2),
s AS (SELECT event_type, CAST(unnest(generate_series(min(week), max(week), INTERVAL 7 DAY)) AS DATE) AS week FROM c GROUP BY 1)
SELECT s.event_type, s.week, COALESCE(n, 0) AS n FROM s LEFT JOIN c ON s.event_type = c.event_type AND s.week = c.week""")
def week_spine_zero_fill(t):
    tuesday = F.date_add(F.to_date(F.date_trunc("week", F.col("ts") - F.expr("INTERVAL 1 DAY"))), 1)
    counted = t.events.groupBy("event_type", tuesday.alias("week")).agg(F.count("*").alias("n"))
    return sequences.fill_spine(counted, ["event_type"], "week", "7 days", ["n"])


@query("""SELECT c_custkey, CAST(unnest(generate_series(DATE '2000-01-01' + CAST(c_custkey % 28 AS INT),
  DATE '2000-01-01' + CAST(c_custkey % 28 AS INT) + c_nationkey % 4, INTERVAL 1 DAY)) AS DATE) AS day FROM customer""")
def explode_days(t):
    start = F.date_add(F.lit("2000-01-01").cast("date"), (F.col("c_custkey") % 28).cast("int"))
    leave = t.customer.select("c_custkey", start.alias("a"), F.date_add(start, (F.col("c_nationkey") % 4)).alias("b"))
    return sequences.explode_days(leave, "a", "b").select("c_custkey", "day")


@query("""SELECT 'supplier' AS kind, s_suppkey AS id, s_name AS name, NULL AS segment FROM supplier UNION ALL SELECT 'customer', c_custkey, c_name,
  c_mktsegment FROM customer""")
def union_tagged(t):
    suppliers = t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    customers = t.customer.select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"))
    return suppliers.unionByName(customers, allowMissingColumns=True)


@query("""SELECT s_suppkey AS id, s_name AS name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer
  WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""")
def overlay_union(t):
    return sequences.overlay(t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")),
        t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), ["id"])


@query("""SELECT n_nationkey FROM nation WHERE n_regionkey < 3 AND n_nationkey % 4 <> 0 UNION SELECT n_nationkey FROM nation
  WHERE n_nationkey % 6 = 0""")
def grants_overlay(t):
    return sequences.grants(t.nation.where("n_regionkey < 3"), t.nation.where("n_nationkey % 4 = 0"), t.nation.where("n_nationkey % 6 = 0"),
        ["n_nationkey"])


@query("""
WITH a AS (SELECT user_id, CAST(ts AS DATE) AS day, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS m FROM events GROUP BY 1, 2),
  b AS (SELECT user_id, CAST(ts AS DATE) AS day, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS m FROM events WHERE event_id % 9 <> 0
  GROUP BY 1, 2)
SELECT COALESCE(a.user_id, b.user_id) AS user_id, COALESCE(a.day, b.day) AS day, CASE WHEN b.m IS NULL THEN 'missing' WHEN a.m IS NULL THEN 'extra'
  WHEN a.m > 4 * b.m THEN 'mostly lost' WHEN abs(a.m - b.m) > 1 THEN 'differs' END AS cause,
 COALESCE(a.m, 0) - COALESCE(b.m, 0) AS difference FROM a FULL JOIN b ON a.user_id = b.user_id AND a.day = b.day WHERE abs(COALESCE(a.m,
  0) - COALESCE(b.m, 0)) > 1""")
def parity_causes(t):
    rollup = lambda df, to: df.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.sum(F.floor("value")).alias(to))
    both = rollup(t.events, "a").join(rollup(t.events.where("event_id % 9 <> 0"), "b"), ["user_id", "day"], "full")
    cause = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").when(F.col("a") > 4 * F.col("b"),
        "mostly lost").when(F.abs(F.col("a") - F.col("b")) > 1, "differs")
    difference = F.coalesce("a", F.lit(0)) - F.coalesce("b", F.lit(0))
    return both.where(F.abs(difference) > 1).select("user_id", "day", cause.alias("cause"), difference.alias("difference"))
