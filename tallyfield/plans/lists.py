"""Lists, trackers and audits: identities, groups, quotes, open items, snapshots, health."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text
from ..operators import aggregates, audits, identities, joins, sequences
from ..operators.dedup import dedup_latest, dominant_spelling
from .reports import example, query

TODAY = "2001-08-02"


# By analogy: suppliers approve for their nation, customers belong to a nation, orders are their history.
GROUPS = """
roster AS (SELECT s_nationkey AS grp, s_name AS name FROM supplier WHERE s_suppkey % 3 = 0),
history AS (SELECT c_nationkey AS grp, upper(o_clerk) AS name FROM orders JOIN customer ON o_custkey = c_custkey),
overlay AS (SELECT n_nationkey AS grp, n_name AS name FROM nation WHERE n_nationkey % 5 = 0)"""


def _groups(t):
    roster = t.supplier.where("s_suppkey % 3 = 0").select(F.col("s_nationkey").alias("grp"), F.col("s_name").alias("name"))
    old = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    history = old.select(F.col("c_nationkey").alias("grp"), F.upper("o_orderpriority").alias("name"))
    overlay = t.nation.where("n_nationkey % 5 = 0").select(F.col("n_nationkey").alias("grp"), F.col("n_name").alias("name"))
    return roster, history, overlay


GROUPS = GROUPS.replace("o_clerk", "o_orderpriority")


@query(f"""WITH {GROUPS}, base AS (SELECT * FROM roster UNION ALL SELECT * FROM history h WHERE NOT EXISTS (SELECT 1 FROM roster r
  WHERE r.grp = h.grp) UNION ALL SELECT * FROM overlay)
SELECT grp, lower(name) AS id, min(name) AS name FROM base GROUP BY 1, 2""")
def group_approvers(t):
    return identities.group_members(*_groups(t), "grp", "name")


@query("""
WITH p AS (SELECT lower(c_mktsegment) || c_custkey % 40 || '@a.io' AS email, c_custkey, c_nationkey AS grp FROM customer),
ok AS (SELECT email, min(c_custkey) AS person FROM p GROUP BY 1 HAVING count(DISTINCT c_custkey) = 1)
SELECT DISTINCT ok.email, o_orderpriority AS grp FROM ok JOIN orders ON o_custkey = person
  WHERE CAST(o_orderdate AS DATE) >= DATE '2001-08-02' - 180""")
def approver_groups_for_email(t):
    people = t.customer.select(F.concat(F.lower("c_mktsegment"), F.col("c_custkey") % 40, F.lit("@a.io")).alias("email"),
        F.col("c_custkey").alias("o_custkey"))
    recent = t.orders.where(F.to_date("o_orderdate") >= F.date_sub(F.lit(TODAY).cast("date"), 180))
    return identities.resolved(people, "email", "o_custkey").join(recent, "o_custkey").select("email",
        F.col("o_orderpriority").alias("grp")).distinct()


@query("""
WITH m AS (SELECT DISTINCT o_custkey AS member, l_suppkey AS approver, 'roster' AS origin FROM orders JOIN lineitem ON l_orderkey = o_orderkey
  UNION ALL SELECT c_custkey, 0, 'overlay' FROM customer WHERE c_acctbal < 0)
SELECT c_custkey AS member, COALESCE(approver, -1) AS approver, COALESCE(min(origin), 'unassigned') AS queue FROM customer LEFT
  JOIN m ON member = c_custkey GROUP BY 1, 2""")
def assigned_members(t):
    sold = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
    roster = sold.select(F.col("o_custkey").alias("member"), F.col("l_suppkey").alias("approver")).distinct().withColumn("origin", F.lit("roster"))
    overlay = t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("member"), F.lit(0).cast("long").alias("approver"),
        F.lit("overlay").alias("origin"))
    both = t.customer.select(F.col("c_custkey").alias("member")).join(roster.unionByName(overlay), "member", "left")
    return both.groupBy("member", F.coalesce("approver", F.lit(-1)).alias("approver")).agg(F.coalesce(F.min("origin"),
        F.lit("unassigned")).alias("queue"))


@query("""
SELECT c_custkey, COALESCE((SELECT o_orderpriority FROM orders WHERE o_custkey = c_custkey ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1),
  c_name) AS display_name FROM customer""")
def employee_directory(t):
    used = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderdate", "o_orderkey", "o_orderpriority")
    rows = joins.top1_lookup(t.customer.select("c_custkey", "c_name"), used, ["c_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return rows.select("c_custkey", F.coalesce("o_orderpriority", "c_name").alias("display_name"))


@query("""
WITH d AS (SELECT c_custkey, c_nationkey AS declared, (SELECT s_nationkey FROM supplier WHERE s_suppkey = c_custkey) AS roster FROM customer)
SELECT c_custkey, declared, roster, CASE WHEN roster IS NULL THEN 'not on roster' WHEN declared IS DISTINCT FROM roster THEN 'mismatch'
  ELSE 'agrees' END AS verdict FROM d""")
def roster_reconciliation(t):
    roster = t.supplier.select(F.col("s_suppkey").alias("c_custkey"), F.col("s_nationkey").alias("roster"))
    rows = t.customer.select("c_custkey", F.col("c_nationkey").alias("declared")).join(roster, "c_custkey", "left")
    verdict = F.when(F.col("roster").isNull(), "not on roster").when(~F.col("declared").eqNullSafe(F.col("roster")), "mismatch").otherwise("agrees")
    return rows.withColumn("verdict", verdict)


@query("""
SELECT 'segment' AS list, c_mktsegment AS option FROM customer WHERE trim(COALESCE(c_mktsegment, '')) <> '' UNION SELECT 'priority', o_orderpriority
  FROM orders WHERE trim(COALESCE(o_orderpriority, '')) <> ''
UNION SELECT 'brand', p_brand FROM part WHERE trim(COALESCE(p_brand, '')) <> ''""")
def option_lists(t):
    made = [sequences.options(df, c, name) for df, c,
        name in ((t.customer, "c_mktsegment", "segment"), (t.orders, "o_orderpriority", "priority"), (t.part, "p_brand", "brand"))]
    return made[0].union(made[1]).union(made[2])


@query("""
SELECT user_id, count(*) AS entries, CAST(max(ts) AS DATE) AS last_seen FROM events WHERE ts >= TIMESTAMP '2024-01-10'
  AND user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0) GROUP BY 1""")
def unmatched_identities(t):
    known = t.customer.where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("user_id"))
    recent = t.events.where(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz"))
    return recent.join(known, "user_id", "left_anti").groupBy("user_id").agg(F.count("*").alias("entries"), F.to_date(F.max("ts")).alias("last_seen"))


@query("""
SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM (SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate,
  o_orderkey)) AS s FROM orders GROUP BY 1) WHERE s <> 'F')""")
def roster_gaps(t):
    latest = dedup_latest(t.orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).where("o_orderstatus <> 'F'")
    return t.customer.join(latest, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@example("""
WITH n(id, name) AS (VALUES (1, 'Ann B. Cole Jr.'), (2, 'ann cole'), (3, 'Bo Diaz'), (4, 'Bo M Diaz III'), (5, 'Cy Orr'), (6, 'Dee')),
r(emp, full_name) AS (VALUES ('e1', 'Ann Cole'), ('e2', 'Bo Diaz'), ('e3', 'Bo X. Diaz'), ('e4', 'Cy Q Orr Sr'), ('e5', 'Dee')),
tok AS (SELECT id, 'n' AS side, regexp_replace(regexp_replace(lower(name), '[^a-z ]', '', 'g'), ' (jr|sr|ii|iii|iv)$', '') AS s FROM n UNION ALL
  SELECT emp, 'r', regexp_replace(regexp_replace(lower(full_name), '[^a-z ]', '', 'g'), ' (jr|sr|ii|iii|iv)$', '') FROM r),
k AS (SELECT id, side, CASE WHEN contains(s, ' ') THEN split_part(s, ' ', 1) || ' ' || regexp_extract(s, '([a-z]+)$', 1) END AS key FROM tok),
u AS (SELECT key, min(id) AS emp FROM k WHERE side = 'r' AND key IS NOT NULL GROUP BY 1 HAVING count(DISTINCT id) = 1)
SELECT CAST(k.id AS INT) AS id, u.emp FROM k LEFT JOIN u ON u.key = k.key WHERE side = 'n'""")
def name_token_identity(t):
    names = t.spark.createDataFrame([(1, "Ann B. Cole Jr."), (2, "ann cole"), (3, "Bo Diaz"), (4, "Bo M Diaz III"), (5, "Cy Orr"), (6, "Dee")],
        "id int, name string")
    roster = t.spark.createDataFrame([("e1", "Ann Cole"), ("e2", "Bo Diaz"), ("e3", "Bo X. Diaz"), ("e4", "Cy Q Orr Sr"), ("e5", "Dee")],
        "emp string, full_name string")
    return identities.by_name_tokens(names, "name", roster, "full_name", "emp").select("id", "emp")


QUOTE = """
q AS (SELECT page_id, split_part(split_part(url, '://', 2), '?', 1) AS path FROM pages),
parsed AS (SELECT page_id, path, split_part(path, '/', 1) AS host, string_split(path, '/') AS parts, CAST(nullif(regexp_extract(path, '/([0-9]+)',
  1), '') AS INT) AS number FROM q),
priced AS (SELECT page_id, host, number, list_extract(list_filter(parts, lambda x: x IN ('en', 'de', 'fr', 'es')), 1) AS market,
  p_retailprice AS price FROM parsed LEFT JOIN part ON p_partkey = number),
over AS (SELECT s_suppkey AS page_id, CAST(100 AS DOUBLE) AS price FROM supplier WHERE s_suppkey % 4 = 0)"""


@query(f"""WITH {QUOTE} SELECT p.page_id, host, market, number, CAST(round(COALESCE(o.price, p.price) * 100) AS BIGINT) AS cents,
  CASE WHEN o.page_id IS NOT NULL THEN 'override' WHEN p.price IS NOT NULL THEN 'matched' WHEN number IS NULL THEN 'no number'
  ELSE 'unmatched' END AS route FROM priced p LEFT JOIN over o ON o.page_id = p.page_id""")
def quote_review(t):
    """Quotes from paths: normalised, parsed, matched with a price, overridden by hand, routed."""
    path = F.split_part(F.split_part("url", F.lit("://"), F.lit(2)), F.lit("?"), F.lit(1))
    parsed = text.path_parts(t.pages.select("page_id", path.alias("path")), "path", ["en", "de", "fr", "es"])
    price = t.part.select(F.col("p_partkey").alias("number"), F.col("p_retailprice").alias("price"))
    manual = t.supplier.where("s_suppkey % 4 = 0").select(F.col("s_suppkey").alias("page_id"), F.lit(100.0).alias("manual"))
    rows = parsed.join(price, "number", "left").join(manual, "page_id", "left")
    route = F.when(F.col("manual").isNotNull(), "override").when(F.col("price").isNotNull(), "matched").when(F.col("number").isNull(),
        "no number").otherwise("unmatched")
    return rows.select("page_id", "host", "market", "number", aggregates.cents(F.coalesce("manual", "price")).alias("cents"), route.alias("route"))


@query(f"""WITH {QUOTE}, c AS (SELECT page_id, p_partkey, row_number() OVER (PARTITION BY page_id ORDER BY (p_size = number % 50) DESC,
  p_retailprice DESC, p_partkey) AS r
  FROM parsed JOIN part ON p_brand = 'Brand#' || (number % 5 + 1) || (number % 3 + 1)) SELECT page_id, p_partkey FROM c WHERE r <= 3""")
def quote_candidates(t):
    path = F.split_part(F.split_part("url", F.lit("://"), F.lit(2)), F.lit("?"), F.lit(1))
    parsed = text.path_parts(t.pages.select("page_id", path.alias("path")), "path", ["en", "de", "fr", "es"])
    wanted = F.concat(F.lit("Brand#"), F.col("number") % 5 + 1, F.col("number") % 3 + 1)
    # Three parts of a brand, and three of a brand and size, are all that any page can take.
    best = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("p_retailprice"), "p_partkey")) <= 3
    parts = t.part.select("p_brand", "p_partkey", "p_size", "p_retailprice")
    top = parts.withColumns({"of_brand": best("p_brand"), "of_size": best("p_brand", "p_size")}).where("of_brand OR of_size")
    met = parsed.withColumn("p_brand", wanted).join(top, "p_brand").where(F.col("of_brand") | (F.col("p_size") == F.col("number") % 50))
    rank = F.row_number().over(Window.partitionBy("page_id").orderBy((F.col("p_size") == F.col("number") % 50).desc(), F.desc("p_retailprice"),
        "p_partkey"))
    return met.withColumn("r", rank).where("r <= 3").select("page_id", "p_partkey")


@query("""
SELECT o_orderkey, (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') AS last_punch
  FROM orders WHERE regexp_matches(o_orderpriority, '^(1|2)-')""")
def punch_requirements(t):
    rejected = t.lineitem.where("l_returnflag = 'R'").withColumnRenamed("l_orderkey", "o_orderkey")
    last = rejected.groupBy("o_orderkey").agg(F.max(F.to_date("l_shipdate")).alias("last_punch"))
    return t.orders.where(F.col("o_orderpriority").rlike("^(1|2)-")).select("o_orderkey").join(last, "o_orderkey", "left")


@query("""
SELECT l_orderkey, l_linenumber, p_partkey IS NOT NULL AS in_catalogue, l_shipdate IS NULL OR l_returnflag = 'R' AS files_missing, date_diff('day',
  CAST(l_shipdate AS DATE), DATE '2001-08-02') > 900 AND l_returnflag <> 'R' AS hidden
FROM lineitem LEFT JOIN (SELECT p_partkey FROM part WHERE p_partkey % 6 <> 0) ON p_partkey = l_partkey""")
def tracker_requirements(t):
    known = t.part.where("p_partkey % 6 <> 0").select(F.col("p_partkey").alias("l_partkey"), F.lit(True).alias("there"))
    rows = t.lineitem.join(known, "l_partkey", "left")
    missing = F.col("l_shipdate").isNull() | (F.col("l_returnflag") == "R")
    old = (F.date_diff(F.lit(TODAY).cast("date"), F.to_date("l_shipdate")) > 900) & (F.col("l_returnflag") != "R")
    return rows.select("l_orderkey", "l_linenumber", F.col("there").isNotNull().alias("in_catalogue"), missing.alias("files_missing"),
        old.alias("hidden"))


SNAP = """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot, o_custkey,
  CASE WHEN o_orderkey % 3 = 0 THEN upper(o_orderpriority) ELSE o_orderpriority END AS pm, o_orderstatus, CAST(o_orderdate AS DATE) AS day FROM orders"""


@query(f"""WITH s AS ({SNAP}) SELECT snapshot, count(*) AS n, count(DISTINCT o_custkey) AS sites, count(*) FILTER (WHERE o_orderstatus = 'O') AS open
  FROM s GROUP BY 1""")
def tracker_totals(t):
    return _tracker(t).groupBy("snapshot").agg(F.count("*").alias("n"), F.countDistinct("o_custkey").alias("sites"),
        F.count_if(F.col("o_orderstatus") == "O").alias("open"))


@query(f"""WITH s AS ({SNAP}) SELECT snapshot, o_orderstatus, n, CAST(floor((n * 2000 + tot) / (tot * 2)) AS BIGINT) / 10.0::DOUBLE AS pct FROM (
SELECT snapshot, o_orderstatus, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY snapshot) AS BIGINT) AS tot FROM s GROUP BY 1, 2)""")
def tracker_status_share(t):
    return aggregates.percent_of_total(_tracker(t), ["o_orderstatus"], ["snapshot"])


@query(f"""WITH s AS ({SNAP}), c AS (SELECT lower(pm) AS key, pm, count(*) AS n FROM s GROUP BY 1, 2),
d AS (SELECT key, pm FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY n DESC, pm) AS r FROM c) WHERE r = 1)
SELECT d.pm, CASE WHEN date_diff('day', day, DATE '{TODAY}') < 400 THEN '0-399' WHEN date_diff('day', day, DATE '{TODAY}') < 1200 THEN '400-1199'
  ELSE '1200+' END AS band, count(*) AS n
FROM s JOIN d ON lower(s.pm) = d.key WHERE o_orderstatus = 'O' GROUP BY 1, 2""")
def tracker_ageing(t):
    rows = _tracker(t)
    spelled = dominant_spelling(rows, F.lower("pm"), "pm").select("key", F.col("spelling").alias("named"))
    age = F.date_diff(F.lit(TODAY).cast("date"), "day")
    band = F.when(age < 400, "0-399").when(age < 1200, "400-1199").otherwise("1200+")
    joined = rows.where("o_orderstatus = 'O'").withColumn("key", F.lower("pm")).join(joins.bounded(spelled), "key")
    return joined.groupBy(F.col("named").alias("pm"), band.alias("band")).agg(F.count("*").alias("n"))


def _tracker(t) -> DataFrame:
    pm = F.when(F.col("o_orderkey") % 3 == 0, F.upper("o_orderpriority")).otherwise(F.col("o_orderpriority"))
    day = F.to_date("o_orderdate")
    return t.orders.select(F.trunc(day, "month").alias("snapshot"), "o_custkey", pm.alias("pm"), "o_orderstatus", day.alias("day"))


@query("""
WITH a AS (SELECT s_suppkey, upper(regexp_replace(s_name, '[^A-Za-z0-9]', '', 'g')) AS k, nullif(regexp_extract(s_name, '([0-9]{6,9})', 1),
  '') AS number FROM supplier),
b AS (SELECT c_custkey, upper(regexp_replace(replace(c_name, 'Customer', 'Supplier'), '[^A-Za-z0-9]', '', 'g')) AS k, nullif(regexp_extract(c_name,
  '([0-9]{6,9})', 1), '') AS number FROM customer)
SELECT s_suppkey, min(c_custkey) AS c_custkey, count(DISTINCT c_custkey) AS matches FROM (SELECT s_suppkey, c_custkey FROM a JOIN b ON a.k = b.k
  UNION SELECT s_suppkey, c_custkey FROM a JOIN b ON a.number = b.number) GROUP BY 1""")
def site_match(t):
    bare = lambda c: F.upper(F.regexp_replace(c, "[^A-Za-z0-9]", ""))
    sites = t.supplier.select("s_suppkey", bare(F.col("s_name")).alias("s_key"), text.longest_number(F.col("s_name")).alias("s_number"))
    other = t.customer.select("c_custkey", bare(F.expr("replace(c_name, 'Customer', 'Supplier')")).alias("c_key"),
        text.longest_number(F.col("c_name")).alias("c_number"))
    pairs = joins.or_join(sites, other, [("s_key", "c_key"), ("s_number", "c_number")], "s_suppkey", "c_custkey")
    return pairs.groupBy("s_suppkey").agg(F.min("c_custkey").alias("c_custkey"), F.count("*").alias("matches"))


@query("""
WITH a AS (SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ' | ' ORDER BY o_orderpriority) AS activity FROM orders WHERE o_orderstatus = 'F'
  GROUP BY 1)
SELECT o_orderkey, o_custkey, activity, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders LEFT JOIN a USING (o_custkey)
  WHERE o_orderstatus = 'O'""")
def ageing_invoices(t):
    seen = t.orders.where("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_set("o_orderpriority")),
        " | ").alias("activity"))
    return t.orders.where("o_orderstatus = 'O'").join(seen, "o_custkey", "left").select("o_orderkey", "o_custkey", "activity",
        aggregates.cents("o_totalprice").alias("cents"))


@query("""
SELECT event_id, user_id, CASE WHEN event_type = 'click' THEN 'leave' WHEN event_type = 'view' THEN 'holiday' WHEN event_type = 'purchase'
  AND value > 50 THEN 'training' ELSE 'other' END AS kind, CAST(ts AS DATE) AS first_day,
  CAST(ts AS DATE) + CAST(floor(value) AS INT) % 3 AS last_day FROM events""")
def calendar_kinds(t):
    kind = F.when(F.col("event_type") == "click", "leave").when(F.col("event_type") == "view",
        "holiday").when((F.col("event_type") == "purchase") & (F.col("value") > 50), "training").otherwise("other")
    day = F.to_date("ts")
    return t.events.select("event_id", "user_id", kind.alias("kind"), day.alias("first_day"),
        F.date_add(day, (F.floor("value") % 3).cast("int")).alias("last_day"))


@query("""
WITH p AS (SELECT p_brand || '/' || p_size AS site, p_partkey, p_retailprice > 1100 AS has_work FROM part), g AS (SELECT site, count(*) AS assets,
  count(*) FILTER (WHERE has_work) AS used, min(p_partkey) AS first_asset FROM p GROUP BY 1 HAVING count(*) > 1)
SELECT site, assets, used, first_asset, CASE WHEN used > 1 THEN 'merge_needed' WHEN used = 1 THEN 'delete_empty' ELSE 'all_empty' END AS verdict
  FROM g""")
def duplicate_assets(t):
    rows = t.part.select(F.concat_ws("/", "p_brand", "p_size").alias("site"), "p_partkey", (F.col("p_retailprice") > 1100).alias("has_work"))
    return audits.duplicate_groups(rows, "site", "p_partkey", "has_work").withColumnRenamed("first_id", "first_asset")


@query("""
WITH s AS (SELECT event_id, (event_id * 7919 % 1440) AS planned, (event_id * 104729 % 1440) AS seen FROM events)
SELECT event_id, CASE WHEN planned = seen THEN 'ok' WHEN abs(planned - seen) = 720 THEN '12 h flip' WHEN planned = 0 THEN 'date only'
  WHEN abs(planned - seen) > 360 THEN 'ghost' WHEN abs(planned - seen) > 60 THEN 'moved' ELSE 'near' END AS finding FROM s""")
def schedule_audit(t):
    rows = t.events.select("event_id", (F.col("event_id") * 7919 % 1440).alias("planned"), (F.col("event_id") * 104729 % 1440).alias("seen"))
    return audits.schedule_findings(rows, "planned", "seen").select("event_id", "finding")


RUNS = """SELECT o_custkey % 12 AS pipeline, o_orderkey AS run, CASE WHEN o_orderstatus = 'P' OR o_orderkey % 19 = 0 THEN 'failed' ELSE 'success' END AS status,
  CAST(o_orderdate AS DATE) AS day, CAST(floor(o_totalprice / 100) AS BIGINT) AS seconds FROM orders"""


def _runs(t) -> DataFrame:
    status = F.when((F.col("o_orderstatus") == "P") | (F.col("o_orderkey") % 19 == 0), "failed").otherwise("success")
    return t.orders.select((F.col("o_custkey") % 12).alias("pipeline"), F.col("o_orderkey").alias("run"), status.alias("status"),
        F.to_date("o_orderdate").alias("day"), F.floor(F.col("o_totalprice") / 100).cast("long").alias("seconds"))


@query(f"""WITH r AS ({RUNS}), l AS (SELECT pipeline, arg_max(status, (day, run)) AS last_status,
  max(day) FILTER (WHERE status = 'success') AS last_good, count(*) FILTER (WHERE status = 'failed') AS failed, max(seconds) AS longest FROM r
  GROUP BY 1)
SELECT pipeline, CASE WHEN last_status = 'failed' THEN 'failed' WHEN last_good IS NULL OR date_diff('day', last_good,
  DATE '{TODAY}') > 20 THEN 'stale' WHEN longest > 4500 THEN 'slow' ELSE 'healthy' END AS state, failed, last_good FROM l""")
def health_findings(t):
    return audits.health(_runs(t), "pipeline", F.lit(TODAY).cast("date"), stale_days=20, slow_seconds=4500)


@query(f"""WITH r AS ({RUNS}) SELECT pipeline, arg_max(status, (day, run)) = 'success' AS may_export FROM r GROUP BY 1""")
def export_guard(t):
    latest = dedup_latest(_runs(t), ["pipeline"], [F.desc("day"), F.desc("run")])
    return latest.select("pipeline", (F.col("status") == "success").alias("may_export"))


@query("""
SELECT 'orders' AS name, (SELECT count(*) FROM orders) AS raw_rows, (SELECT count(*) FROM (SELECT DISTINCT o_orderkey FROM orders)) AS loaded_rows,
  true AS equal
UNION ALL SELECT 'lineitem', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM lineitem WHERE l_linenumber <= 3), (SELECT count(*)
  FROM lineitem) = (SELECT count(*) FROM lineitem WHERE l_linenumber <= 3)""")
def count_validation(t):
    before = {"orders": t.orders, "lineitem": t.lineitem}
    after = {"orders": t.orders.select("o_orderkey").distinct(), "lineitem": t.lineitem.where("l_linenumber <= 3")}
    return audits.counts_differ(before, after)


@query("""
WITH a AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_totalprice AS v FROM orders WHERE o_orderkey % 10 <> 1),
b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS s, o_totalprice + CASE
  WHEN o_orderkey % 11 = 0 THEN 0.001 WHEN o_orderkey % 13 = 0 THEN 5 ELSE 0 END AS v FROM orders WHERE o_orderkey % 10 <> 2)
SELECT COALESCE(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'missing' WHEN a.k IS NULL THEN 'extra' WHEN a.s IS DISTINCT FROM b.s
  AND abs(a.v - b.v) > 0.01 THEN 's,v' WHEN a.s IS DISTINCT FROM b.s THEN 's' ELSE 'v' END AS finding
FROM a FULL JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR a.s IS DISTINCT FROM b.s OR abs(a.v - b.v) > 0.01""")
def dual_audit(t):
    rows = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"), F.col("o_totalprice").alias("v"))
    shift = F.when(F.col("k") % 11 == 0, 0.001).when(F.col("k") % 13 == 0, 5.0).otherwise(0.0)
    new = rows.withColumns({"s": F.when(F.col("k") % 7 == 0, "X").otherwise(F.col("s")), "v": F.col("v") + shift})
    return audits.column_differences(rows.where("k % 10 <> 1"), new.where("k % 10 <> 2"), ["k"], {"s": None, "v": 0.01})


@query("""
SELECT CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS month, day(CAST(o_orderdate AS DATE)) <= 15 AS first_half, count(*) AS filed,
  count(DISTINCT CAST(o_orderdate AS DATE)) AS days,
  count(DISTINCT CAST(o_orderdate AS DATE)) = CASE WHEN day(CAST(o_orderdate AS DATE)) <= 15 THEN 15
  ELSE day(last_day(any_value(CAST(o_orderdate AS DATE)))) - 15 END AS complete FROM orders GROUP BY 1, 2, day(CAST(o_orderdate AS DATE)) <= 15""")
def pay_periods(t):
    day = F.to_date("o_orderdate")
    grouped = t.orders.groupBy(F.trunc(day, "month").alias("month"), (F.dayofmonth(day) <= 15).alias("first_half")).agg(F.count("*").alias("filed"),
        F.countDistinct(day).alias("days"))
    return grouped.withColumn("complete", F.col("days") == F.when(F.col("first_half"), 15).otherwise(F.dayofmonth(F.last_day("month")) - 15))


@query("""
SELECT n_name, count(*) FILTER (WHERE c_mktsegment = 'AUTOMOBILE') AS automobile, count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS building,
  count(*) FILTER (WHERE c_mktsegment = 'MACHINERY') AS machinery FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def pivot_summary(t):
    rows = t.customer.join(joins.bounded(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
    made = rows.groupBy("n_name").pivot("c_mktsegment", ["AUTOMOBILE", "BUILDING", "MACHINERY"]).count().na.fill(0)
    return made.select("n_name", *[F.col(c).alias(c.lower()) for c in ("AUTOMOBILE", "BUILDING", "MACHINERY")])


@query("""
WITH e AS (SELECT o_orderkey, CAST(unnest(from_json('[' || o_custkey % 5 || ',' || o_custkey % 5 + 1 || ',null]', '["INTEGER"]')) AS INTEGER) AS line
  FROM orders)
SELECT e.o_orderkey, line, l_linenumber IS NOT NULL AS was_there FROM e LEFT JOIN (SELECT DISTINCT l_orderkey, l_linenumber
  FROM lineitem) ON l_orderkey = o_orderkey AND l_linenumber IS NOT DISTINCT FROM line""")
def edit_audit(t):
    edits = t.orders.select("o_orderkey",
        F.concat(F.lit("["), F.col("o_custkey") % 5, F.lit(","), F.col("o_custkey") % 5 + 1, F.lit(",null]")).alias("lines"))
    lines = edits.select("o_orderkey", F.explode(F.from_json("lines", "array<int>")).alias("line"))
    there = t.lineitem.select(F.col("l_orderkey").alias("k"), "l_linenumber").distinct()
    found = lines.join(there, (lines["o_orderkey"] == there["k"]) & lines["line"].eqNullSafe(there["l_linenumber"]), "left")
    return found.select("o_orderkey", "line", F.col("k").isNotNull().alias("was_there"))


@query("""
SELECT user_id, len(list_filter(vs, lambda x: x >= 50)) AS big, list_min(list_filter(vs, lambda x: x >= 50)) AS least_big,
  CAST(list_sum(vs) AS BIGINT) AS total FROM (SELECT user_id, list(CAST(floor(value) AS BIGINT)) AS vs FROM events GROUP BY 1)""")
def array_members(t):
    whole = F.floor("value")
    big = F.when(whole >= 50, whole)
    return t.events.groupBy("user_id").agg(F.count(big).alias("big"), F.min(big).alias("least_big"), F.sum(whole).alias("total"))


@query("""
SELECT p_partkey, COALESCE((SELECT r.kind FROM (VALUES (1, 'PROMO%BRASS', 'promo brass'), (2, 'PROMO%', 'promo'), (3, '%STEEL', 'steel'), (4, '%',
  'other')) r(o, pat, kind) WHERE p_type LIKE r.pat ORDER BY o LIMIT 1), 'none') AS kind FROM part""")
def rule_table_match(t):
    rules = t.spark.createDataFrame([(3, "%STEEL", "steel"), (1, "PROMO%BRASS", "promo brass"), (4, "%", "other"), (2, "PROMO%", "promo")],
        "o int, pat string, kind string")
    return joins.rule_join(t.part.select("p_partkey", "p_type"), "p_type", rules, "o", "pat", "kind", "none").select("p_partkey", "kind")


@query("""
SELECT c_custkey, (SELECT o_orderkey FROM orders WHERE o_custkey = c_custkey ORDER BY o_totalprice DESC, o_orderkey LIMIT 1) AS best FROM customer""")
def scalar_top1(t):
    best = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max_by("o_orderkey",
        F.struct("o_totalprice", (-F.col("o_orderkey")).alias("k"))).alias("best"))
    return t.customer.select("c_custkey").join(best, "c_custkey", "left")


@query("""SELECT CAST(sum(n) AS BIGINT) AS n, md5(string_agg(h, ',' ORDER BY p)) AS content_hash FROM (
SELECT substr(x, 1, 4) AS p, md5(string_agg(x, ',' ORDER BY x)) AS h, count(*) AS n FROM (SELECT md5(n_nationkey::VARCHAR || '|' || n_name) AS x
  FROM nation) GROUP BY 1)""")
def snapshot_hash(t):
    return aggregates.content_hash(t.nation, [], ["n_nationkey", "n_name"])
