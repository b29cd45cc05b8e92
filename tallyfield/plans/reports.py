"""Report queries: joins, aggregates, rankings, pages."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import dates, text
from ..operators import aggregates, joins, sequences
from ..operators.dedup import dedup_latest, dominant_spelling, mark_duplicates
from .tables import Tables, second

QUERIES: dict = {}
SQL: dict[str, str] = {}
EXAMPLES: dict = {}
EXAMPLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the decorated function under its name, with its SQL counterpart."""

    def register(f):
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def example(sql: str):
    """Keep the decorated function, which reads no table but rows that it names, for the tests: it is no registered query."""

    def keep(f):
        EXAMPLES[f.__name__], EXAMPLE_SQL[f.__name__] = lambda spark, folder: f(Tables(spark, folder)), sql
        return f

    return keep


@query("""
SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS order_day, c_name, c_mktsegment, n_name, r_name
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey""")
def flat_order_dims(t):
    nations = joins.bounded(t.nation.join(joins.bounded(t.region), F.col("n_regionkey") == F.col("r_regionkey"), "left"))
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(nations,
        F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return rows.select("o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("order_day"), "c_name", "c_mktsegment", "n_name", "r_name")


@query("""
SELECT c_mktsegment, count(*) AS total, count(*) FILTER (WHERE lower(o_orderstatus) = 'o') AS open_count,
  count(*) FILTER (WHERE lower(o_orderstatus) = 'f') AS finished_count, count(*) FILTER (WHERE lower(o_orderstatus) = 'p') AS pending_count
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def status_counts_by_group(t):
    status = F.lower("o_orderstatus")
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment").agg(
        F.count("*").alias("total"), F.count_if(status == "o").alias("open_count"), F.count_if(status == "f").alias("finished_count"),
        F.count_if(status == "p").alias("pending_count"))


@query("""
WITH o AS (SELECT o_custkey, count(*) AS orders, count(*) FILTER (WHERE o_orderstatus = 'F') AS finished,
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS order_cents FROM orders GROUP BY 1),
l AS (SELECT o_custkey, count(*) AS lines, count(*) FILTER (WHERE l_returnflag = 'R') AS returned FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
SELECT c_custkey, c_name, COALESCE(orders, 0) AS orders, COALESCE(order_cents, 0) AS order_cents, COALESCE(lines, 0) AS lines,
  CASE WHEN COALESCE(orders, 0) > 0 THEN CAST(floor((finished * 2000 + orders) / (orders * 2)) AS BIGINT) / 10.0::DOUBLE
  ELSE 0.0::DOUBLE END AS finished_pct,
  CASE WHEN COALESCE(lines, 0) > 0 THEN CAST(floor((returned * 2000 + lines) / (lines * 2)) AS BIGINT) / 10.0::DOUBLE
  ELSE 0.0::DOUBLE END AS returned_pct
FROM customer LEFT JOIN o ON c_custkey = o.o_custkey LEFT JOIN l ON c_custkey = l.o_custkey""")
def customer_summary(t):
    orders = t.orders.groupBy("o_custkey").agg(F.count("*").alias("orders"), F.count_if(F.col("o_orderstatus") == "F").alias("finished"),
        F.sum(aggregates.cents("o_totalprice")).alias("order_cents"))
    lines = (t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("r"))
             .join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(F.sum("n").alias("lines"),
                 F.sum("r").alias("returned")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    rows = t.customer.withColumnRenamed("c_custkey", "o_custkey").join(orders, "o_custkey", "left").join(lines, "o_custkey", "left")
    return rows.select(F.col("o_custkey").alias("c_custkey"), "c_name", zero("orders").alias("orders"), zero("order_cents").alias("order_cents"),
        zero("lines").alias("lines"),
                       aggregates.tenth_percent(zero("finished"), zero("orders")).alias("finished_pct"),
                           aggregates.tenth_percent(zero("returned"), zero("lines")).alias("returned_pct"))


@query("""
SELECT s_suppkey, count(l_orderkey) AS lines, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts,
  min(CAST(l_shipdate AS DATE)) AS first_day, max(CAST(l_shipdate AS DATE)) AS last_day
FROM supplier LEFT JOIN lineitem ON s_suppkey = l_suppkey GROUP BY 1""")
def agent_stats(t):
    stats = t.lineitem.groupBy("l_suppkey").agg(
        F.count("*").alias("lines"), F.countDistinct("l_orderkey").alias("orders"), F.countDistinct("l_partkey").alias("parts"),
        F.min(F.to_date("l_shipdate")).alias("first_day"), F.max(F.to_date("l_shipdate")).alias("last_day"))
    return t.supplier.select("s_suppkey").join(stats, F.col("s_suppkey") == F.col("l_suppkey"), "left").drop("l_suppkey").fillna(0,
        ["lines", "orders", "parts"])


@query("""SELECT CAST(l_shipdate AS DATE) AS day, l_returnflag, l_linestatus, count(*) AS n, count(DISTINCT l_suppkey) AS suppliers FROM lineitem
  GROUP BY 1, 2, 3""")
def daily_completion(t):
    return t.lineitem.groupBy(F.to_date("l_shipdate").alias("day"), "l_returnflag", "l_linestatus").agg(F.count("*").alias("n"),
        F.countDistinct("l_suppkey").alias("suppliers"))


@query("""SELECT event_type, CAST(json_extract_string(props, '$.k') AS INT) AS k, count(*) AS n FROM events GROUP BY 1, 2""")
def json_extract_events(t):
    return t.events.groupBy("event_type", F.get_json_object("props", "$.k").cast("int").alias("k")).agg(F.count("*").alias("n"))


@query("""SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC,
  event_id DESC) AS r FROM events) WHERE r = 1""")
def dedup_latest_event(t):
    return dedup_latest(t.events, ["user_id", "event_type"], [F.col("ts").desc_nulls_last(), F.desc("event_id")]).select("user_id", "event_type",
        "event_id", "value")


@query("""
SELECT l.event_id, l.user_id, (SELECT r.event_id FROM events r WHERE r.user_id = l.user_id AND r.event_type = 'purchase' AND r.ts <= l.ts
  ORDER BY r.ts DESC, r.event_id DESC LIMIT 1) AS last_purchase
FROM events l WHERE l.event_type = 'click'""")
def asof_prior_event(t):
    clicks = t.events.where("event_type = 'click'").select("event_id", "user_id", "ts")
    bought = t.events.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("bought_at"), F.col("event_id").alias("last_purchase"))
    found = joins.asof_join_split(clicks, bought, ["user_id"], "ts", "bought_at", ["last_purchase"])
    return found.select("event_id", "user_id", "last_purchase")


@query("""
SELECT o_orderkey, l_partkey, l_linenumber FROM orders LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey) AS r
  FROM lineitem) l ON o_orderkey = l_orderkey AND r = 1""")
def top1_lateral_part(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_linenumber", "l_extendedprice")
    return joins.top1_lookup(t.orders.select("o_orderkey"), lines, ["o_orderkey"],
        [F.desc("l_extendedprice"), F.asc("l_linenumber"), F.asc("l_partkey")]).select("o_orderkey", "l_partkey", "l_linenumber")


@query("""
WITH k AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_partkey END AS pk, CASE WHEN l_suppkey % 5 = 0 THEN NULL
  ELSE l_suppkey END AS sk, l_quantity FROM lineitem),
rej AS (SELECT * FROM k WHERE l_orderkey % 10 = 3), rem AS (SELECT * FROM k WHERE l_orderkey % 10 = 4), cor AS (SELECT * FROM k
  WHERE l_orderkey % 20 = 4)
SELECT l_orderkey, l_linenumber, pk, sk FROM k t
WHERE NOT EXISTS (SELECT 1 FROM rej r WHERE r.l_orderkey = t.l_orderkey AND r.pk IS NOT DISTINCT FROM t.pk AND r.sk IS NOT DISTINCT FROM t.sk)
AND NOT EXISTS (SELECT 1 FROM rem r WHERE r.l_orderkey = t.l_orderkey AND r.pk IS NOT DISTINCT FROM t.pk AND r.sk IS NOT DISTINCT FROM t.sk
  AND NOT EXISTS (SELECT 1 FROM cor c WHERE c.l_orderkey = r.l_orderkey AND c.pk IS NOT DISTINCT FROM r.pk AND c.sk IS NOT DISTINCT FROM r.sk))""")
def nullsafe_anti_chain(t):
    k = t.lineitem.select("l_orderkey", "l_linenumber", F.when(F.col("l_partkey") % 7 != 0, F.col("l_partkey")).alias("pk"),
        F.when(F.col("l_suppkey") % 5 != 0, F.col("l_suppkey")).alias("sk"))
    keys = ["l_orderkey", "pk", "sk"]
    left = joins.null_safe_anti(k, k.where("l_orderkey % 10 = 3"), keys)
    return joins.anti_unless(left, k.where("l_orderkey % 10 = 4"), k.where("l_orderkey % 20 = 4"), keys)


@query("""SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS has_orders, EXISTS (SELECT 1 FROM orders
  WHERE o_custkey = c_custkey AND o_orderpriority LIKE '1%') AS has_urgent FROM customer""")
def semi_has_history(t):
    seen = t.orders.groupBy("o_custkey").agg(F.bool_or(F.col("o_orderpriority").like("1%")).alias("has_urgent"))
    rows = t.customer.select("c_custkey").join(seen, F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.select("c_custkey", F.col("o_custkey").isNotNull().alias("has_orders"), F.coalesce("has_urgent", F.lit(False)).alias("has_urgent"))


@query("""SELECT l_returnflag, l_linestatus, n, CAST(floor((n * 2000 + tot) / (tot * 2)) AS BIGINT) / 10.0::DOUBLE AS pct FROM (
SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY l_returnflag) AS BIGINT) AS tot FROM lineitem GROUP BY 1,
  2)""")
def pct_of_total(t):
    return aggregates.percent_of_total(t.lineitem, ["l_linestatus"], ["l_returnflag"])


@query("""
WITH s AS (SELECT p_brand AS key, CASE p_partkey % 3 WHEN 0 THEN upper(p_type) WHEN 1 THEN lower(p_type) ELSE p_type END AS spelling FROM part),
c AS (SELECT lower(spelling) AS key, spelling, count(*) AS n FROM s GROUP BY 1, 2)
SELECT key, spelling, CAST(tot AS BIGINT) AS n, spellings FROM (SELECT *, sum(n) OVER (PARTITION BY key) AS tot,
  count(*) OVER (PARTITION BY key) AS spellings,
  row_number() OVER (PARTITION BY key ORDER BY n DESC, spelling) AS r FROM c) WHERE r = 1""")
def dominant_spelling_types(t):
    case = F.when(F.col("p_partkey") % 3 == 0, F.upper("p_type")).when(F.col("p_partkey") % 3 == 1, F.lower("p_type")).otherwise(F.col("p_type"))
    return dominant_spelling(t.part.select(case.alias("written")), F.lower("written"), "written")


@query("""SELECT p_brand, string_agg(DISTINCT p_type, ' | ' ORDER BY p_type) AS types, count(DISTINCT p_type) AS n_types FROM part GROUP BY 1""")
def string_agg_distinct(t):
    return t.part.groupBy("p_brand").agg(F.array_join(F.array_sort(F.collect_set("p_type")), " | ").alias("types"),
        F.countDistinct("p_type").alias("n_types"))


@query("""
SELECT event_type, round(quantile_cont(value, 0.5), 4) AS p50, round(quantile_cont(value, 0.9), 4) AS p90, round(quantile_cont(value,
  0.5) FILTER (WHERE user_id % 2 = 0), 4) AS p50_even, max(value) AS longest FROM events GROUP BY 1""")
def percentiles_by_group(t):
    even = F.col("user_id") % 2 == 0
    made = aggregates.quantiles(t.events, ["event_type"], "value", {"p50": (0.5, None), "p90": (0.9, None), "p50_even": (0.5, even)})
    longest = t.events.groupBy("event_type").agg(F.max("value").alias("longest"))
    return made.join(longest, "event_type").select("event_type", *[F.round(c, 4).alias(c) for c in ("p50", "p90", "p50_even")], "longest")


@query("""SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT user_id) FILTER (WHERE value > 50) AS big_users,
  bool_or(value > 99) AS any_huge, bool_and(value >= 0) AS none_negative FROM events GROUP BY 1""")
def distinct_filter_counts(t):
    return t.events.groupBy("event_type").agg(F.countDistinct("user_id").alias("users"),
        F.countDistinct(F.when(F.col("value") > 50, F.col("user_id"))).alias("big_users"),
                                              F.bool_or(F.col("value") > 99).alias("any_huge"),
                                                  F.bool_and(F.col("value") >= 0).alias("none_negative"))


@query("""
WITH w AS (SELECT l_orderkey, l_suppkey, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS weight FROM lineitem GROUP BY 1, 2),
j AS (SELECT w.*, CAST(round(o_totalprice * 100) AS BIGINT) AS amount, CAST(sum(weight) OVER (PARTITION BY l_orderkey) AS BIGINT) AS total FROM w
  JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey, l_suppkey, weight, CASE WHEN total > 0
  THEN CAST((CAST(amount AS HUGEINT) * weight * 2 + total) // (CAST(total AS HUGEINT) * 2) AS BIGINT) ELSE 0 END AS share_cents FROM j""")
def allocate_share(t):
    weights = t.lineitem.groupBy("l_orderkey", "l_suppkey").agg(F.sum(aggregates.cents("l_extendedprice")).alias("weight"))
    rows = weights.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), aggregates.cents("o_totalprice").alias("amount")), "l_orderkey")
    wide = rows.withColumn("amount", F.col("amount").cast("decimal(19,0)"))
    return aggregates.allocate(wide, ["l_orderkey"], "amount", "weight", "share_cents").select("l_orderkey", "l_suppkey", "weight", "share_cents")


@query("""
WITH w AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, CAST(sum(l_quantity) AS BIGINT) AS minutes,
  CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM lineitem GROUP BY 1, 2),
m AS (SELECT l_suppkey, date_trunc('month', day)::DATE AS month, day, minutes, CAST(sum(cents) OVER (PARTITION BY l_suppkey, date_trunc('month',
  day)) AS BIGINT) AS amount,
  CAST(sum(minutes) OVER (PARTITION BY l_suppkey, date_trunc('month', day)) AS BIGINT) AS total FROM w)
SELECT l_suppkey, day, minutes, CASE WHEN total > 0
  THEN CAST((CAST(amount AS HUGEINT) * minutes * 2 + total) // (CAST(total AS HUGEINT) * 2) AS BIGINT) ELSE 0 END AS day_cents FROM m""")
def allocate_daily(t):
    days = t.lineitem.groupBy("l_suppkey", F.to_date("l_shipdate").alias("day")).agg(F.sum("l_quantity").cast("long").alias("minutes"),
        F.sum(aggregates.cents("l_extendedprice")).alias("cents"))
    days = days.withColumn("month", F.trunc("day", "month"))
    days = days.withColumn("amount", F.sum("cents").over(Window.partitionBy("l_suppkey", "month")).cast("decimal(19,0)"))
    return aggregates.allocate(days, ["l_suppkey", "month"], "amount", "minutes", "day_cents").select("l_suppkey", "day", "minutes", "day_cents")


@query("""
SELECT c_mktsegment, count(*) FILTER (WHERE age < 90) AS under_90, count(*) FILTER (WHERE age >= 90 AND age < 365) AS under_365,
  count(*) FILTER (WHERE age >= 365 AND age < 1000) AS under_1000,
  count(*) FILTER (WHERE age >= 1000) AS older, max(age) AS oldest
FROM (SELECT c_mktsegment, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-02') AS age FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE o_orderstatus = 'O') GROUP BY 1""")
def aging_buckets(t):
    age = F.date_diff(F.lit("2001-08-02").cast("date"), F.to_date("o_orderdate"))
    rows = t.orders.where("o_orderstatus = 'O'").join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_mktsegment", age.alias("age"))
    edge = lambda lo, hi: F.count_if((F.col("age") >= lo) & (F.col("age") < hi))
    return rows.groupBy("c_mktsegment").agg(edge(-(10**6), 90).alias("under_90"), edge(90, 365).alias("under_365"),
        edge(365, 1000).alias("under_1000"), edge(1000, 10**6).alias("older"), F.max("age").cast("long").alias("oldest"))


@query("""
SELECT r_name, CAST(sum(n) AS BIGINT) AS orders, max(n) AS most, count(*) AS nations FROM (
SELECT r_name, n_name, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2) GROUP BY 1""")
def json_rollup(t):
    by_nation = flat_order_dims(t).groupBy("r_name", "n_name").agg(F.count("*").alias("n"))
    document = F.to_json(F.struct(F.sum("n").alias("orders"),
        F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("down"), "n_name", "n"))).alias("nations")))
    parsed = by_nation.groupBy("r_name").agg(document.alias("document"))
    number = lambda path: F.get_json_object("document", path).cast("long")
    return parsed.select("r_name", number("$.orders").alias("orders"), number("$.nations[0].n").alias("most"),
        F.json_array_length(F.get_json_object("document", "$.nations")).cast("long").alias("nations"))


@query("""
SELECT c_mktsegment, CAST(sum(n) AS BIGINT) AS n, md5(string_agg(d, ',' ORDER BY p)) AS content_hash FROM (
SELECT c_mktsegment, substr(h, 1, 4) AS p, count(*) AS n, md5(string_agg(h, ',' ORDER BY h)) AS d FROM (
SELECT c_mktsegment, md5(CAST(c_custkey AS VARCHAR) || '|' || c_name || '|' || CAST(c_nationkey AS VARCHAR)) AS h FROM customer) GROUP BY 1, 2)
  GROUP BY 1""")
def content_hash_groups(t):
    return aggregates.content_hash(t.customer, ["c_mktsegment"], ["c_custkey", "c_name", "c_nationkey"])


@query("""
WITH c AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2),
b AS (SELECT *, CAST(sum(n) OVER (PARTITION BY o_custkey) AS BIGINT) AS total, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC,
  o_orderstatus DESC) AS r FROM c)
SELECT o_custkey, o_orderstatus, n, total FROM b WHERE r = 1 AND n >= 3 AND n * 100 >= total * 60""")
def evidence_accept(t):
    return aggregates.accept_evidence(t.orders, "o_custkey", "o_orderstatus", share_percent=60, least=3)


@query("""SELECT p_type, count(DISTINCT p_brand) AS n_values, count(DISTINCT p_brand) > 1 AS is_conflict, CASE
  WHEN count(DISTINCT p_brand) > 1 THEN NULL ELSE min(p_brand) END AS p_brand FROM part GROUP BY 1""")
def conflict_keys(t):
    return aggregates.conflicts(t.part, "p_type", "p_brand")


@query("""
WITH b(band, lo, hi) AS (VALUES ('low', 0.0, 1000.0), ('middle', 1000.0, 1500.0), ('wide', 1200.0, 1800.0), ('high', 1500.0, 1e9))
SELECT band, count(*) AS n, min(p_partkey) AS first_part FROM part JOIN b ON p_retailprice >= lo AND p_retailprice < hi GROUP BY 1""")
def range_join_bands(t):
    bands = t.spark.createDataFrame([("low", 0.0, 1000.0), ("middle", 1000.0, 1500.0), ("wide", 1200.0, 1800.0), ("high", 1500.0, 1e9)],
        "band string, lo double, hi double")
    return joins.band_join(t.part, "p_retailprice", bands, "lo", "hi").groupBy("band").agg(F.count("*").alias("n"),
        F.min("p_partkey").alias("first_part"))


@query("""
SELECT s_suppkey, c_custkey FROM supplier JOIN customer ON s_nationkey = c_nationkey AND floor(s_acctbal) = floor(c_acctbal)
UNION SELECT s_suppkey, c_custkey FROM supplier JOIN customer ON s_suppkey = c_custkey""")
def or_join_pairs(t):
    key = lambda side: F.concat_ws("/", f"{side}_nationkey", F.floor(f"{side}_acctbal"))
    suppliers = t.supplier.select("s_suppkey", key("s").alias("s_key"), F.col("s_suppkey").cast("string").alias("s_id"))
    customers = t.customer.select("c_custkey", key("c").alias("c_key"), F.col("c_custkey").cast("string").alias("c_id"))
    return joins.or_join(suppliers, customers, [("s_key", "c_key"), ("s_id", "c_id")], "s_suppkey", "c_custkey")


TERMS = ["the", "of the", "in", "and the", "was"]


@query("""
SELECT term, count(*) AS n FROM (SELECT CASE WHEN contains(p, ' and the ') THEN 'and the' WHEN contains(p, ' of the ') THEN 'of the' WHEN contains(p,
  ' the ') THEN 'the' WHEN contains(p, ' was ') THEN 'was'
  WHEN contains(p, ' in ') THEN 'in' END AS term FROM (SELECT ' ' || text || ' ' AS p FROM documents)) GROUP BY 1""")
def containment_match(t):
    return joins.containment_match(t.documents, F.col("text"), TERMS).groupBy("term").agg(F.count("*").alias("n"))


@query("""
SELECT p_partkey, CASE WHEN p_type LIKE '%BRASS' THEN 'brass' WHEN p_type LIKE 'PROMO%' THEN 'promo' WHEN p_type LIKE '%STEEL%' THEN 'steel'
  WHEN p_type LIKE 'S%' THEN 'small' ELSE 'other' END AS class FROM part""")
def pattern_first_match(t):
    rules = [("%BRASS", "brass"), ("PROMO%", "promo"), ("%STEEL%", "steel"), ("S%", "small")]
    return t.part.select("p_partkey", joins.pattern_case(F.col("p_type"), rules, "other").alias("class"))


@query("""SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus IN ('O', 'F') AND o_totalprice >= 1000
  ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 50 OFFSET 20""")
def paged_list(t):
    rows = sequences.filtered(t.orders, equal={"o_orderstatus": ["O", "F"], "o_orderpriority": None}, least={"o_totalprice": 1000})
    return sequences.page(rows, [("o_totalprice", True)], "o_orderkey", offset=20, limit=50).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("""SELECT count(*) AS n FROM orders WHERE o_orderstatus IN ('O', 'F') AND o_totalprice >= 1000""")
def paged_count(t):
    return sequences.filtered(t.orders, equal={"o_orderstatus": ["O", "F"], "o_orderpriority": None},
        least={"o_totalprice": 1000}).agg(F.count("*").alias("n"))


@query("""
SELECT c_mktsegment, count(*) AS orders, count(*) FILTER (WHERE days_late > 0) AS late, count(*) FILTER (WHERE days_late <= 0) AS on_time,
  max(days_late) AS worst FROM (
SELECT c_mktsegment, date_diff('day', due, CAST(o_orderdate AS DATE) + 14) AS days_late FROM (SELECT *, CASE WHEN extract(dow FROM e) IN (4,
  5) THEN e + 4 WHEN extract(dow FROM e) = 6 THEN e + 3 ELSE e + 2 END AS due FROM (
  SELECT *, CASE WHEN day(o_orderdate) <= 15 THEN make_date(year(o_orderdate), month(o_orderdate), 15)
  ELSE last_day(CAST(o_orderdate AS DATE)) END AS e FROM orders JOIN customer ON o_custkey = c_custkey))) GROUP BY 1""")
def scorecard(t):
    due = dates.approval_deadline(F.to_date("o_orderdate"))
    late = F.date_diff(F.date_add(F.to_date("o_orderdate"), 14), due)
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_mktsegment", late.alias("late"))
    return rows.groupBy("c_mktsegment").agg(F.count("*").alias("orders"), F.count_if(F.col("late") > 0).alias("late"),
        F.count_if(F.col("late") <= 0).alias("on_time"), F.max("late").cast("long").alias("worst"))


@query("""
SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY value DESC,
  event_id) > 1 AS is_duplicate FROM events""")
def duplicate_marks(t):
    return mark_duplicates(t.events, ["user_id", "event_type", F.to_date("ts")], [F.desc("value"), F.asc("event_id")]).select("user_id",
        "event_type", "event_id", "is_duplicate")


@query("""
SELECT page_id, split_part(split_part(url, '://', 2), '/', 1) AS host, upper(regexp_replace(trim(regexp_replace(regexp_replace(url, '[/_-]', ' ',
  'g'), '\\s+', ' ', 'g')), ' +', ' ', 'g')) AS url_norm,
  nullif(regexp_extract(url, '/([0-9]+)', 1), '') AS number FROM pages""")
def clean_text_keys(t):
    return t.pages.select("page_id", F.split_part(F.split_part("url", F.lit("://"), F.lit(2)), F.lit("/"), F.lit(1)).alias("host"),
        text.quote_norm(F.col("url")).alias("url_norm"),
                          text.blank_to_null(F.regexp_extract("url", "/([0-9]+)", 1)).alias("number"))


@query("""
SELECT page_id, CASE WHEN i > 0 THEN array_to_string(list_slice(parts, i, i + 1), '/') END AS signature FROM (SELECT page_id, parts,
  list_position(list_transform(parts, lambda s: regexp_full_match(s, 'en|de|fr|es')), true) AS i FROM (
SELECT page_id, string_split(split_part(url, '://', 2), '/') AS parts FROM pages))""")
def path_signature(t):
    path = F.split_part("url", F.lit("://"), F.lit(2))
    return t.pages.select("page_id", text.signature(path, "^(en|de|fr|es)$", follow=1).alias("signature"))


@query("""SELECT event_id,
  CAST(((floor((floor(epoch(ts))::BIGINT % 86400 - 32400) / 60.0)::BIGINT + 720) % 1440 + 1440) % 1440 - 720 AS BIGINT) AS minutes_late FROM events""")
def lateness_wrap(t):
    return t.events.select("event_id", dates.lateness(second("ts") % 86400, F.lit(32400)).cast("long").alias("minutes_late"))


@query("""SELECT user_id, CAST(date_trunc('week', ts) AS DATE) AS week, CASE event_type WHEN 'purchase' THEN 'standard' WHEN 'click' THEN 'overhead'
  WHEN 'view' THEN 'overhead' ELSE 'postfill' END AS bucket,
  count(*) AS n, CAST(least(sum(floor(value)), 720) AS BIGINT) AS minutes FROM events GROUP BY 1, 2, 3""")
def task_mix(t):
    bucket = text.first_rule(F.col("event_type"), [("^purchase$", "standard"), ("^(click|view)$", "overhead")], "postfill")
    return t.events.groupBy("user_id", F.to_date(F.date_trunc("week", F.col("ts"))).alias("week"), bucket.alias("bucket")).agg(
        F.count("*").alias("n"), F.least(F.sum(F.floor("value")), F.lit(720)).cast("long").alias("minutes"))


@query("""SELECT event_id, CAST(timezone('America/New_York', timezone('UTC', ts)) AS DATE) AS et_day, CAST(timezone('Asia/Manila', timezone('UTC',
  ts)) AS DATE) AS manila_day, CAST(timezone('America/New_York', timezone('UTC', ts)) - INTERVAL 6 HOUR AS DATE) AS shift_day FROM events""")
def tz_days(t):
    day = lambda zone, h=0: dates.local_day(F.col("ts"), zone, h)
    return t.events.select("event_id", day("America/New_York").alias("et_day"), day("Asia/Manila").alias("manila_day"),
        day("America/New_York", 6).alias("shift_day"))


@query("""SELECT o_orderkey, CASE WHEN extract(dow FROM e) IN (4, 5) THEN e + 4 WHEN extract(dow FROM e) = 6 THEN e + 3 ELSE e + 2 END AS deadline
  FROM (
SELECT o_orderkey, CASE WHEN day(o_orderdate) <= 15 THEN make_date(year(o_orderdate), month(o_orderdate), 15)
  ELSE last_day(CAST(o_orderdate AS DATE)) END AS e FROM orders)""")
def pay_period_deadline(t):
    return t.orders.select("o_orderkey", dates.approval_deadline(F.to_date("o_orderdate")).alias("deadline"))


@query("""
SELECT o_orderkey, CAST((SELECT count(*) FROM unnest(generate_series(CAST(o_orderdate AS DATE),
  CAST(o_orderdate AS DATE) + CAST(o_orderkey % 20 AS INT) - 1, INTERVAL 1 DAY)) u(d)
  WHERE extract(isodow FROM d) < 6 AND CAST(d AS DATE) NOT IN (DATE '1998-12-25', DATE '1999-01-01')) AS INT) AS days FROM orders""")
def workdays_between(t):
    start = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", dates.workdays(start, F.date_add(start, (F.col("o_orderkey") % 20).cast("int")),
        ["1998-12-25", "1999-01-01"]).alias("days"))
