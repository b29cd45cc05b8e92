"""Queries of the loads that rewrite tables: merges, guarded refreshes, rebuilt entries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates, intervals, joins, merge
from ..operators.dedup import dedup_latest
from .reports import query
from .state import BLOCKS, SOURCE, SPANS, TARGET, _snapshots, _spans
from .tables import second

ACTION = """CASE WHEN t.o_orderkey IS NULL THEN 'insert' WHEN s.o_orderkey IS NULL THEN 'delete'
  WHEN t.o_orderstatus IS DISTINCT FROM s.o_orderstatus OR t.cents IS DISTINCT FROM s.cents THEN 'update' ELSE 'keep' END"""


@query(f"""
SELECT count(*) FILTER (WHERE action <> 'delete') AS total, count(*) FILTER (WHERE action = 'insert') AS "insert",
  count(*) FILTER (WHERE action = 'update') AS "update", count(*) FILTER (WHERE action = 'delete') AS "delete",
  count(*) FILTER (WHERE action = 'keep') AS keep
FROM (SELECT {ACTION} AS action FROM ({TARGET}) t FULL JOIN ({SOURCE}) s ON t.o_orderkey = s.o_orderkey)""")
def snapshot_merge_counts(t):
    return merge.action_counts(*_snapshots(t), ["o_orderkey"])


@query("""
WITH t AS (SELECT o_orderkey AS k, o_orderstatus AS status, 'r0' AS run, 1 AS created FROM orders WHERE o_orderkey % 10 <> 1),
b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS status FROM orders WHERE o_orderkey % 3 = 0),
j AS (SELECT COALESCE(t.k, b.k) AS o_orderkey, t.*, b.status AS new_status,
  t.k IS NULL OR (b.k IS NOT NULL AND t.status IS DISTINCT FROM b.status) AS written FROM t FULL JOIN b ON t.k = b.k)
SELECT o_orderkey, CASE WHEN written THEN new_status ELSE status END AS status, CASE WHEN written THEN 'r1' ELSE run END AS run,
  COALESCE(created, 2) AS created FROM j""")
def merge_batch(t):
    rows = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("status"))
    target = rows.where("o_orderkey % 10 <> 1").withColumns({"run": F.lit("r0"), "created": F.lit(1)})
    came = rows.where("o_orderkey % 3 = 0").withColumns({"run": F.lit("r1"), "created": F.lit(2)})
    last = came.withColumn("status", F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("status"))).withColumn("seq", F.lit(2))
    batch = came.withColumns({"status": F.lit("stale"), "seq": F.lit(1)}).unionByName(last)
    return merge.merge_batch(target, batch, ["o_orderkey"], "seq", ignore=("run",), insert_only=("created",))


def _capped_sql(tag: str, gone: str) -> str:
    return f"""
SELECT '{tag}' AS kind, o_orderkey, CASE WHEN inside AND NOT gone THEN 'Z' ELSE o_orderstatus END AS o_orderstatus FROM (
SELECT *, {gone} AND inside AS gone, count(*) FILTER (WHERE inside AND {gone}) OVER () AS lost, count(*) FILTER (WHERE inside) OVER () AS held
FROM (SELECT *, year(o_orderdate) = 1998 AND month(o_orderdate) <= 3 AS inside FROM orders))
WHERE NOT (gone AND lost <= greatest(10, held * 20 / 100.0))"""


@query(_capped_sql("few", "o_orderkey % 40 = 0") + " UNION ALL " + _capped_sql("many", "o_orderkey % 2 = 0"))
def merge_capped_delete(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"))
    window = F.expr("year(day) = 1998 AND month(day) <= 3")
    listed = lambda gone: rows.where(window).where(f"NOT ({gone})").withColumn("o_orderstatus", F.lit("Z"))
    few, _ = merge.merge_capped(rows, listed("o_orderkey % 40 = 0"), ["o_orderkey"], window)
    many, _ = merge.merge_capped(rows, listed("o_orderkey % 2 = 0"), ["o_orderkey"], window)
    both = few.withColumn("kind", F.lit("few")).unionByName(many.withColumn("kind", F.lit("many")))
    return both.select("kind", "o_orderkey", "o_orderstatus")


@query("""
SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1998 AND o_orderkey % 9 = 0 THEN 'N' ELSE o_orderstatus END AS o_orderstatus
FROM orders WHERE NOT (year(o_orderdate) = 1998 AND o_orderkey % 50 = 0)""")
def windowed_refresh(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_custkey", F.year("o_orderdate").alias("year"))
    status = F.when(F.col("o_orderkey") % 9 == 0, "N").otherwise(F.col("o_orderstatus"))
    rebuilt = rows.where("year = 1998 AND o_orderkey % 50 <> 0").withColumn("o_orderstatus", status)
    return merge.refresh_window(rows, rebuilt, ["o_orderkey"], F.col("year") == 1998, "o_custkey").select("o_orderkey", "o_orderstatus")


@query("""
WITH new AS (SELECT c_custkey, c_mktsegment FROM customer WHERE CASE WHEN c_mktsegment = 'BUILDING' THEN c_custkey % 4 = 0
  ELSE c_custkey % 40 <> 0 END),
n AS (SELECT c_mktsegment, count(*) AS n FROM new GROUP BY 1), o AS (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1),
good AS (SELECT o.c_mktsegment FROM o JOIN n USING (c_mktsegment) WHERE n.n * 100 >= o.n * 90)
SELECT c_custkey, c_mktsegment, 'new' AS load FROM new WHERE c_mktsegment IN (FROM good)
UNION ALL SELECT c_custkey, c_mktsegment, 'old' FROM customer WHERE c_mktsegment NOT IN (FROM good)""")
def replace_if_enough(t):
    rows = t.customer.select("c_custkey", "c_mktsegment")
    few = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_custkey") % 4 == 0).otherwise(F.col("c_custkey") % 40 != 0)
    return merge.replace_if_enough(rows.withColumn("load", F.lit("old")), rows.where(few).withColumn("load", F.lit("new")), "c_mktsegment")


@query("""
SELECT c_custkey, COALESCE(s_nationkey, c_nationkey) AS c_nationkey, s_suppkey IS NOT NULL AND s_nationkey IS DISTINCT FROM c_nationkey AS changed
FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""")
def enrich_changed(t):
    lookup = t.supplier.select(F.col("s_suppkey").alias("c_custkey"), F.col("s_nationkey").alias("c_nationkey"))
    return merge.enrich_changed(t.customer.select("c_custkey", "c_nationkey"), lookup, ["c_custkey"], ["c_nationkey"])


@query("""
SELECT DISTINCT p_type, CASE WHEN p_type LIKE 'PROMO%' THEN 'promo' WHEN p_type LIKE '%STEEL' THEN 'steel' ELSE 'unclassified' END AS class
FROM part WHERE p_type NOT IN (SELECT p_type FROM part WHERE p_partkey % 200 = 0)""")
def seed_unknown_signatures(t):
    rule = joins.pattern_case(F.col("p_type"), [("PROMO%", "promo"), ("%STEEL", "steel")], "unclassified")
    return merge.seed_unknown(t.part, t.part.where("p_partkey % 200 = 0").select("p_type").distinct(), "p_type", rule)


@query(f"""
SELECT t.o_orderkey, 'o_orderstatus' AS "column", t.o_orderstatus AS old, s.o_orderstatus AS new
FROM ({TARGET}) t JOIN ({SOURCE}) s ON t.o_orderkey = s.o_orderkey WHERE t.o_orderstatus IS DISTINCT FROM s.o_orderstatus""")
def change_history(t):
    return merge.changes(*_snapshots(t), ["o_orderkey"], ["o_orderstatus", "cents"])


@query("""
WITH e AS (SELECT c_custkey, lower(c_mktsegment) || c_custkey % 9 || '@a.io' AS email, false AS now FROM customer
  UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN lower(c_mktsegment) || '@b.io'
  ELSE lower(c_mktsegment) || c_custkey % 9 || '@a.io' END, true FROM customer)
SELECT email, c_custkey, bool_or(now) AS is_current FROM e GROUP BY 1, 2""")
def identity_aliases(t):
    old = t.customer.select("c_custkey", F.concat(F.lower("c_mktsegment"), F.col("c_custkey") % 9, F.lit("@A.io")).alias("email"))
    new = old.join(t.customer, "c_custkey").select(
        "c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.concat("c_mktsegment", F.lit("@b.io"))).otherwise(F.col("email")).alias("email")
    )
    return merge.alias_table([old, new], "c_custkey", "email")


@query(f"""
SELECT 'blank' AS kind, count(*) AS n FROM ({TARGET}) UNION ALL SELECT 'filled', count(*) FROM ({SOURCE})""")
def stale_not_blank(t):
    old, new = _snapshots(t)
    size = lambda df, kind: df.agg(F.lit(kind).alias("kind"), F.count("*").alias("n"))
    return size(merge.not_blank(old, new.limit(0)), "blank").union(size(merge.not_blank(old, new), "filled"))


@query("""
WITH h AS (SELECT p_brand, md5(string_agg(md5(p_partkey::VARCHAR || '|' || p_type), ',' ORDER BY md5(p_partkey::VARCHAR || '|' || p_type))) AS h
  FROM part GROUP BY 1)
SELECT p_brand, CASE WHEN p_brand LIKE '%1' THEN 'new' ELSE 'changed' END AS state FROM h
WHERE p_brand LIKE '%1' OR EXISTS (SELECT 1 FROM part p WHERE p.p_brand = h.p_brand AND p_partkey % 50 = 7)""")
def changed_sources(t):
    now = aggregates.content_hash(t.part, ["p_brand"], ["p_partkey", "p_type"])
    kind = F.when(F.col("p_partkey") % 50 == 7, "was another").otherwise(F.col("p_type"))
    then = aggregates.content_hash(t.part.withColumn("p_type", kind).where("p_brand NOT LIKE '%1'"), ["p_brand"], ["p_partkey", "p_type"])
    return merge.changed_groups(now, then, ["p_brand"])


@query("""
WITH o AS (SELECT c_custkey AS k, c_name AS name, c_nationkey AS unit, c_mktsegment AS title FROM customer WHERE c_custkey % 11 <> 0),
n AS (SELECT c_custkey AS k, c_name AS name, CASE WHEN c_custkey % 5 = 0 THEN 99 ELSE c_nationkey END AS unit,
  CASE WHEN c_custkey % 4 = 0 THEN 'MOVED' ELSE c_mktsegment END AS title FROM customer WHERE c_custkey % 13 <> 0)
SELECT COALESCE(o.k, n.k) AS k, CASE WHEN o.k IS NULL THEN 'new' WHEN n.k IS NULL THEN 'removed' WHEN o.unit IS DISTINCT FROM n.unit THEN 'tracked'
  WHEN o.title IS DISTINCT FROM n.title THEN 'simple' ELSE 'same' END AS change,
  CASE WHEN o.k IS NULL OR n.k IS NULL THEN NULL WHEN o.unit IS DISTINCT FROM n.unit AND o.title IS DISTINCT FROM n.title THEN 'unit,title'
  WHEN o.unit IS DISTINCT FROM n.unit THEN 'unit' WHEN o.title IS DISTINCT FROM n.title THEN 'title' END AS fields
FROM o FULL JOIN n ON o.k = n.k""")
def roster_diff(t):
    rows = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("unit"),
        F.col("c_mktsegment").alias("title"))
    new = rows.withColumns({
        "unit": F.when(F.col("k") % 5 == 0, 99).otherwise(F.col("unit")), "title": F.when(F.col("k") % 4 == 0, "MOVED").otherwise(F.col("title")),
    })
    return merge.roster_diff(rows.where("k % 11 <> 0"), new.where("k % 13 <> 0"), ["k"], ["unit"], ["title", "name"])


ENTRY = "user_id, CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_type END AS kind, ts AS moment, CAST(floor(value) AS BIGINT) AS minutes, event_id"


@query(f"""
WITH x AS (SELECT {ENTRY} FROM events), dup AS (SELECT * FROM x UNION ALL SELECT user_id, kind, moment, minutes + 1, event_id + 10000000 FROM x
  WHERE event_id % 10 = 0),
first AS (SELECT * EXCLUDE r FROM (SELECT *, row_number() OVER (PARTITION BY user_id, kind, moment ORDER BY event_id DESC) AS r FROM dup)
  WHERE r = 1),
rej AS (SELECT * FROM x WHERE event_id % 23 = 0), rem AS (SELECT * FROM x WHERE event_id % 17 = 0),
cor AS (SELECT user_id, kind, moment, minutes + 5 AS minutes FROM x WHERE event_id % 34 = 0 AND event_id % 23 <> 0
  UNION ALL SELECT user_id + 100000, kind, moment, minutes FROM x WHERE event_id % 101 = 0),
remaining AS (SELECT * FROM first f WHERE NOT EXISTS (SELECT 1 FROM rej r WHERE r.user_id = f.user_id AND r.kind IS NOT DISTINCT FROM f.kind
  AND r.moment = f.moment)
  AND NOT EXISTS (SELECT 1 FROM rem r WHERE r.user_id = f.user_id AND r.kind IS NOT DISTINCT FROM f.kind AND r.moment = f.moment
    AND NOT EXISTS (SELECT 1 FROM cor c WHERE c.user_id = r.user_id AND c.kind IS NOT DISTINCT FROM r.kind AND c.moment = r.moment))),
applied AS (SELECT f.user_id, f.kind, f.moment, COALESCE(c.minutes, f.minutes) AS minutes, CASE WHEN c.minutes IS NOT NULL THEN 'corrected'
  ELSE 'raw' END AS provenance
  FROM remaining f LEFT JOIN cor c ON c.user_id = f.user_id AND c.kind IS NOT DISTINCT FROM f.kind AND c.moment = f.moment
  UNION ALL SELECT user_id, kind, moment, minutes, 'orphan' FROM cor c WHERE NOT EXISTS (SELECT 1 FROM remaining f WHERE c.user_id = f.user_id
  AND c.kind IS NOT DISTINCT FROM f.kind AND c.moment = f.moment)
  UNION ALL SELECT user_id + 200000, kind, moment, minutes, 'added' FROM x WHERE event_id % 97 = 0)
SELECT user_id, kind, moment, minutes, provenance FROM applied WHERE provenance <> 'raw' OR minutes <= 50""")
def timer_rebuild(t):
    kind = F.when(F.col("event_id") % 13 != 0, F.col("event_type"))
    x = t.events.select("user_id", kind.alias("kind"), F.col("ts").alias("moment"), F.floor("value").cast("long").alias("minutes"), "event_id")
    again = x.where("event_id % 10 = 0").withColumns({"minutes": F.col("minutes") + 1, "event_id": F.col("event_id") + 10000000})
    fixed = x.where("event_id % 34 = 0 AND event_id % 23 <> 0").withColumn("minutes", F.col("minutes") + 5)
    orphans = x.where("event_id % 101 = 0").withColumn("user_id", F.col("user_id") + 100000)
    added = x.where("event_id % 97 = 0").withColumn("user_id", F.col("user_id") + 200000)
    return merge.rebuilt_entries(
        x.unionByName(again), fixed.unionByName(orphans), x.where("event_id % 23 = 0"), x.where("event_id % 17 = 0"), added,
        ["user_id", "kind", "moment"], [F.desc("event_id")], "minutes", 50,
    )


@query(f"""
WITH raw AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day, floor(epoch(ts))::BIGINT AS s,
  CASE WHEN event_id % 6 = 0 THEN NULL ELSE floor(epoch(ts))::BIGINT + CAST(floor(value) AS BIGINT) * 60 END AS e FROM events),
y AS (SELECT *, max(e) OVER (PARTITION BY user_id, day ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM raw WHERE e > s),
z AS (SELECT *, sum(CASE WHEN s > m THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, day ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING
  AND CURRENT ROW) AS block FROM y),
b AS (SELECT user_id, day, block, min(s) AS bs, max(e) AS be FROM z GROUP BY 1, 2, 3),
u AS (SELECT user_id, day, CAST(sum(be - bs) AS BIGINT) AS union_seconds, string_agg(bs::VARCHAR, ',' ORDER BY bs) AS starts, string_agg(be::VARCHAR,
  ',' ORDER BY bs) AS ends FROM b GROUP BY 1, 2),
d AS (SELECT user_id, day, count(*) AS entries, count(*) FILTER (WHERE e IS NULL) AS open_entries, min(s) AS first_start, max(e) AS last_end FROM raw
  GROUP BY 1, 2)
SELECT CASE WHEN user_id % 4 = 0 THEN 'email:' || user_id || '@x.io' ELSE 'E' || user_id END AS person_key, day, COALESCE(union_seconds,
  0) AS union_seconds,
  entries, open_entries, first_start, last_end, starts, ends FROM d LEFT JOIN u USING (user_id, day)""")
def timer_day_rollup(t):
    spans = _spans(t).withColumn("e", F.when(F.col("event_id") % 6 != 0, F.col("e")))
    days = spans.groupBy("user_id", "day").agg(
        F.count("*").alias("entries"), F.count_if(F.col("e").isNull()).alias("open_entries"), F.min("s").alias("first_start"),
            F.max("e").alias("last_end")
    )
    merged = intervals.union_intervals(spans, ["user_id", "day"], "s", "e")
    rollup = intervals.day_blocks(merged, ["user_id", "day"])
    alias = t.events.select("user_id").distinct().where("user_id % 4 <> 0").withColumn("emp_id", F.concat(F.lit("E"), "user_id"))
    person = F.coalesce("emp_id", F.concat(F.lit("email:"), "user_id", F.lit("@x.io")))
    rows = days.join(rollup, ["user_id", "day"], "left").join(alias, "user_id", "left")
    return rows.select(
        person.alias("person_key"), "day", F.coalesce("union_seconds", F.lit(0)).alias("union_seconds"),
        "entries", "open_entries", "first_start", "last_end", "starts", "ends",
    )


@query("""
WITH g(region, removed) AS (VALUES (0, '[0, 5, 14]'), (1, '[1]'), (2, '[]'), (3, NULL))
SELECT n_nationkey FROM nation WHERE n_nationkey NOT IN (SELECT CAST(unnest(from_json(removed, '["INTEGER"]')) AS INTEGER) FROM g
  WHERE removed IS NOT NULL)""")
def json_anti(t):
    lists = t.spark.createDataFrame([(0, "[0, 5, 14]"), (1, "[1]"), (2, "[]"), (3, None)], "region int, removed string")
    return joins.json_anti(t.nation, "n_nationkey", lists, "removed").select("n_nationkey")


@query("""
SELECT user_id, string_agg(event_type || ':' || CAST(floor(value) AS BIGINT), ',' ORDER BY ts, event_id) AS trail,
  arg_max(event_type, (ts, event_id)) FILTER (WHERE event_type <> 'error') AS last_good
FROM events GROUP BY 1""")
def aligned_arrays(t):
    row = F.struct("ts", "event_id", "event_type", F.floor("value").alias("minutes"))
    trail = F.transform(F.array_sort(F.collect_list(row)), lambda x: F.concat_ws(":", x["event_type"], x["minutes"]))
    good = F.when(F.col("event_type") != "error", F.struct("ts", "event_id"))
    return t.events.groupBy("user_id").agg(F.array_join(trail, ",").alias("trail"), F.max_by("event_type", good).alias("last_good"))


@query("""
WITH v AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS since, o_orderkey, o_orderstatus,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INT) END AS until FROM orders),
r AS (SELECT *, since <= DATE '1998-06-01' AND (until IS NULL OR until >= DATE '1998-06-01') AS covers FROM v)
SELECT o_custkey, o_orderkey, covers AND row_number() OVER (PARTITION BY o_custkey, covers ORDER BY since DESC NULLS LAST, until DESC NULLS FIRST,
  o_orderstatus, o_orderkey DESC) = 1 AS is_current FROM r""")
def schedule_current(t):
    since = F.to_date("o_orderdate")
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", since.alias("since"),
                           F.when(F.col("o_orderkey") % 5 != 0, F.date_add(since, (F.col("o_orderkey") % 400).cast("int"))).alias("until"))
    order = [F.desc_nulls_last("since"), F.desc_nulls_first("until"), F.asc("o_orderstatus"), F.desc("o_orderkey")]
    return intervals.current_row(rows, ["o_custkey"], "since", "until", F.lit("1998-06-01").cast("date"), order).select("o_custkey", "o_orderkey",
        "is_current")


@query("""
WITH x AS (SELECT user_id, event_type, ts, event_id, lead(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS nxt FROM events)
SELECT event_id, nxt AS closed_at, nxt IS NULL AS is_open FROM x""")
def open_interval_closed_later(t):
    return intervals.close_by_next(t.events, ["user_id", "event_type"], ["ts", "event_id"], "ts").select("event_id",
        F.col("closes").alias("closed_at"), "is_open")


@query("""
WITH a AS (SELECT l_orderkey, l_returnflag FROM lineitem), b AS (SELECT l_orderkey, l_returnflag FROM lineitem WHERE l_linenumber <= 2)
SELECT * FROM a EXCEPT ALL SELECT * FROM b""")
def rows_left_over(t):
    rows = t.lineitem.select("l_orderkey", "l_returnflag")
    return rows.exceptAll(t.lineitem.where("l_linenumber <= 2").select("l_orderkey", "l_returnflag"))


@query("""
SELECT s_suppkey, s_name FROM supplier s WHERE (SELECT count(DISTINCT l_partkey) FROM lineitem WHERE l_suppkey = s_suppkey) >
  (SELECT avg(n) FROM (SELECT s2.s_nationkey AS nk, l_suppkey, count(DISTINCT l_partkey) AS n FROM lineitem
  JOIN supplier s2 ON l_suppkey = s2.s_suppkey GROUP BY 1, 2) WHERE nk = s.s_nationkey)""")
def above_group_average(t):
    counted = t.lineitem.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.countDistinct("l_partkey").alias("n")).join(t.supplier, "s_suppkey")
    usual = counted.groupBy("s_nationkey").agg(F.avg("n").alias("usual"))
    return counted.join(usual, "s_nationkey").where("n > usual").select("s_suppkey", "s_name")


@query("""
SELECT p.p_partkey, p.p_type, c.p_partkey IS NOT NULL AS has_standard, CASE WHEN p.p_type LIKE '%BRASS' THEN 1 WHEN p.p_type LIKE '%STEEL' THEN 2
  ELSE 9 END AS class
FROM part p LEFT JOIN (SELECT p_brand, p_type, min(p_partkey) AS p_partkey FROM part GROUP BY 1, 2) c
  ON c.p_brand = p.p_brand AND c.p_type = replace(p.p_type, 'PROMO', 'STANDARD') WHERE p.p_type LIKE 'PROMO%'""")
def paired_status_audit(t):
    done = t.part.groupBy("p_brand", F.col("p_type").alias("pair")).agg(F.count("*").alias("n"))
    rows = t.part.where("p_type LIKE 'PROMO%'").withColumn("pair", F.expr("replace(p_type, 'PROMO', 'STANDARD')")).join(done, ["p_brand", "pair"],
        "left")
    rules = t.spark.createDataFrame([(2, "%STEEL", 2), (1, "%BRASS", 1)], "match_order int, pattern string, class int")
    return joins.rule_join(rows, "p_type", rules, "match_order", "pattern", "class", 9).select("p_partkey", "p_type",
        F.col("n").isNotNull().alias("has_standard"), "class")


@query("""
WITH k(key, kind, weight) AS (VALUES ('EN', 'a', 1), ('EXAMPLE ORG EN', 'b', 2), ('EXAMPLE COM', 'c', 2), ('DE', 'd', 3), ('BLOG', 'e', 3), ('COM',
  'f', 9)),
p AS (SELECT page_id, ' ' || upper(trim(regexp_replace(split_part(split_part(url, '://', 2), '?', 1), '[^A-Za-z0-9]+', ' ', 'g'))) || ' ' AS path
  FROM pages),
m AS (SELECT page_id, key, row_number() OVER (PARTITION BY page_id ORDER BY trim(path) = key DESC, weight, length(key) DESC, key) AS r FROM p
  JOIN k ON contains(path, ' ' || key || ' '))
SELECT p.page_id, m.key FROM p LEFT JOIN m ON p.page_id = m.page_id AND r = 1""")
def key_table_containment(t):
    made = [("EN", "a", 1), ("EXAMPLE ORG EN", "b", 2), ("EXAMPLE COM", "c", 2), ("DE", "d", 3), ("BLOG", "e", 3), ("COM", "f", 9)]
    keys = t.spark.createDataFrame(made, "key string, kind string, weight int")
    bare = F.regexp_replace(F.split_part(F.split_part("url", F.lit("://"), F.lit(2)), F.lit("?"), F.lit(1)), "[^A-Za-z0-9]+", " ")
    paths = t.pages.select("page_id", F.upper(F.trim(bare)).alias("path"))
    return joins.key_containment(paths, "page_id", "path", keys, "key", ["weight"]).select("page_id", "key")
