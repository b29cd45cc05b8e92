"""Sources and scalar functions over small fixtures and the driver tables.

Where a sheet's rows are parsed, the SQL states the rows that must come out.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, text
from ..operators import sequences
from ..sources import scans
from .reports import example, query

TODAY = "2001-08-02"


def _values(t, column: str, values: list, kind: str = "string"):
    return t.spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {column} {kind}")


def _rows(name: str, values: list[str]) -> str:
    """SQL rows (i, name) of text values."""
    rows = ", ".join(f"({i}, {'NULL' if v is None else chr(39) + v.replace(chr(39), chr(39) * 2) + chr(39)})" for i, v in enumerate(values))
    return f"(VALUES {rows}) v(i, {name})"


NAMES = ["1. Dig", "10B. Lay pipe 2", "1. 2a. Test", " X", "Plan 3.", None, "", "2.Plan\t"]


@example(rf"""SELECT i, regexp_replace(regexp_replace(c, '^([0-9]+[A-Za-z]?\.[ \t\n\r\f\v]*)+', ''), '^[ \t\n\r\f\v]+|[ \t\n\r\f\v]+$', '',
  'g') AS clean,
  nullif(upper(trim(regexp_replace(c, '[ \t\n\r\f\v]+', ' ', 'g'))), '') AS norm FROM {_rows('c', NAMES)}""")
def clean_names(t):
    return _values(t, "c", NAMES).select("i", text.clean_task_name(F.col("c")).alias("clean"), text.name_norm(F.col("c")).alias("norm"))


NUMBERS = ["a TS0042 b", "TSX", "fa 12345678 and 654321", "7654321 1234567", "1234567890", "12", None, "$1,234.50", "n/a", "1.2.3", "8.5 h",
    "about 7"]


@example(rf"""SELECT i, TRY_CAST(nullif(regexp_extract(c, 'TS(\d+)', 1), '') AS INT) AS project,
  (SELECT x FROM (SELECT unnest(regexp_extract_all(' ' || replace(c, ' ', '  ') || ' ', '[^0-9]([0-9]{{6,9}})(?:[^0-9]|$)', 1)) AS x)
  ORDER BY length(x) DESC, x LIMIT 1) AS number,
  CAST(TRY_CAST(nullif(regexp_replace(c, '[^0-9.]', '', 'g'), '') AS DECIMAL(18,2)) * 100 AS BIGINT) AS cents,
  COALESCE(TRY_CAST(trim(c) AS DOUBLE), TRY_CAST(nullif(regexp_extract(c, '(\d+\.?\d*)', 1), '') AS DOUBLE)) AS hours FROM {_rows('c', NUMBERS)}""")
def parsed_numbers(t):
    c = F.col("c")
    return _values(t, "c", NUMBERS).select(
        "i", text.project_number(c).alias("project"), text.longest_number(c).alias("number"), (text.money(c) * 100).cast("long").alias("cents"),
            dates.hours(c).alias("hours"))


CLOCKS = ["9 PM", "9PM", "9:00 PM", "12:30 am", "12 pm", "13 PM", "9", "", None]


@example(rf"""SELECT i, CASE WHEN regexp_matches(c, '^\s*\d{{1,2}}(:[0-5]\d)?\s*[AaPp][Mm]\s*$') AND CAST(regexp_extract(c, '(\d{{1,2}})',
  1) AS INT) BETWEEN 1 AND 12 THEN
  (CAST(regexp_extract(c, '(\d{{1,2}})', 1) AS INT) % 12 + CASE WHEN lower(c) LIKE '%p%' THEN 12
  ELSE 0 END) * 60 + COALESCE(TRY_CAST(nullif(regexp_extract(c, ':(\d\d)', 1), '') AS INT), 0) END AS minutes FROM {_rows('c', CLOCKS)}""")
def shift_clocks(t):
    return _values(t, "c", CLOCKS).select("i", dates.shift_minutes(F.col("c")).alias("minutes"))


DAYS = ["3/7/2024", "3/7/24", "2024-03-07", "45358", "2024-03-07T10:00:00", "x", "", None]


@example(f"""SELECT i, CASE WHEN i < 5 THEN DATE '2024-03-07' END AS day FROM {_rows('c', DAYS)}""")
def parsed_days(t):
    return _values(t, "c", DAYS).select("i", dates.parse_day(F.col("c")).alias("day"))


EPOCHS = ["1709769600000", "1709769600", "2024-03-07 00:00:00", "x", None]


@example(f"""SELECT i, CASE WHEN i < 3 THEN DATE '2024-03-06' END AS et_day FROM {_rows('c', EPOCHS)}""")
def epoch_days(t):
    return _values(t, "c", EPOCHS).select("i", dates.local_day(dates.epoch_or_iso(F.col("c")), "America/New_York").alias("et_day"))


PUSHES = ["-NqJ3kLmAbCdEf", "-O000000xyz", "short", "-Nq*3kLmAbCd", None]


@example(rf"""SELECT i, CASE WHEN regexp_matches(c, '^[-0-9A-Z_a-z]{{8}}') THEN CAST((SELECT sum((strpos('{dates.PUSH_SIGNS}', substr(c, k::INT,
  1)) - 1) * pow(64, 8 - k)) FROM generate_series(1, 8) g(k)) AS BIGINT) END AS millis FROM {_rows('c', PUSHES)}""")
def push_times(t):
    return _values(t, "c", PUSHES).select("i", dates.push_time(F.col("c")).alias("millis"))


@query("""
SELECT event_id, CAST(ts AS DATE) AS first_day, CASE WHEN event_type = 'click'
  AND CAST(floor(value) AS INT) % 4 > 0 THEN CAST(ts AS DATE) + CAST(floor(value) AS INT) % 4 - 1
  ELSE CAST(ts AS DATE) + CAST(floor(value) AS INT) % 4 END AS last_day,
  greatest(CAST(floor(value) AS INT) % 4, 1) AS days FROM events""")
def event_spans(t):
    first, n = F.to_date("ts"), (F.floor("value") % 4).cast("int")
    last, days = dates.event_span(first, F.date_add(first, n), F.col("event_type") == "click")
    return t.events.select("event_id", first.alias("first_day"), last.alias("last_day"), days.alias("days"))


CODES = ["vl", "UT/SL", " sl ", "zz", "", None, "X/vl"]


@example("""SELECT * FROM (VALUES (0, 'Vacation'), (1, 'Undertime + Sick'), (2, 'Sick'), (3, 'zz'), (4, NULL), (5, NULL), (6, 'X + Vacation')) v(i,
  label)""")
def leave_labels(t):
    return _values(t, "c", CODES).select("i", text.leave_label(F.col("c"), {"VL": "Vacation", "SL": "Sick", "UT": "Undertime"}).alias("label"))


SUMMARIES = ["VL - North - Ann Bee (half day)", "UT/SL - North - Bo", "US: Labor Day", "Ced's birthday!", "BL - North - Bo birthday leave",
    "Safety course", "Ann", "VL - Mars - Cy", "", None]


@example("""SELECT * FROM (VALUES (0, 'leave', 'VL', 'North', 'Ann Bee', 'half day', false), (1, 'leave', 'UT/SL', 'North', 'Bo', NULL, false), (2,
  'holiday', NULL, NULL, NULL, NULL, false), (3, 'birthday', NULL, NULL, NULL, NULL, false),
  (4, 'leave', 'BL', 'North', 'Bo birthday leave', NULL, false), (5, 'training', NULL, NULL, NULL, NULL, false), (6, 'other', NULL, NULL, NULL, NULL,
  true), (7, 'leave', 'VL', 'Mars', 'Cy', NULL, true),
  (8, 'other', NULL, NULL, NULL, NULL, false), (9, 'other', NULL, NULL, NULL, NULL, false)) v(i, kind, code, team, person, note, needs_review)""")
def calendar_summaries(t):
    parsed = text.calendar_summary(F.col("c"), ["VL", "SL", "BL"], ["NORTH", "SOUTH"])
    return _values(t, "c", SUMMARIES).select("i", parsed.alias("p")).select("i", "p.*")


PATHS = ["Sub/Gc/Netco/North/Scope 1/x", "Netco/East", "a/FTTH/West/z", "a/b/c", None, "Gc/ Netco /South/"]


@example("""SELECT * FROM (VALUES (0, 'Sub', 'Gc', 'Netco', 'North', 'Scope 1', false), (1, NULL, NULL, 'Netco', 'East', NULL, false), (2, NULL, NULL,
  NULL, 'West', NULL, false), (3, NULL, NULL, NULL, NULL, NULL, true),
  (4, NULL, NULL, NULL, NULL, NULL, true), (5, NULL, 'Gc', 'Netco', 'South', NULL, false)) v(i, subcon, gc, carrier, market, project,
  needs_review)""")
def folder_paths(t):
    return _values(t, "c", PATHS).select("i", text.path_fields(F.col("c"), "^netco", "^ftth$").alias("p")).select("i", "p.*")


BUCKETS = [("^excluded", "EXCLUDED"), ("north|artic", "north"), ("east", "east"), ("south", "south"), ("we?st", "west")]
MARKETS = ["Northeast", "East 5", "xsouth", "Excluded east", "WST", "none", "", None]


@example(f"""SELECT i, CASE WHEN regexp_matches(c, '(?i)^excluded') THEN 'EXCLUDED' WHEN regexp_matches(c, '(?i)north|artic') THEN 'north'
  WHEN regexp_matches(c, '(?i)east') THEN 'east' WHEN regexp_matches(c, '(?i)south') THEN 'south'
  WHEN regexp_matches(c, '(?i)we?st') THEN 'west' END AS bucket FROM {_rows('c', MARKETS)}""")
def market_buckets(t):
    return _values(t, "c", MARKETS).select("i", text.first_rule(F.col("c"), BUCKETS).alias("bucket"))


@query("""
SELECT o_orderkey, CAST('0x' || substr(md5(o_orderkey::VARCHAR || '|' || o_orderstatus), 1, 15) AS BIGINT) AS stable_id,
  md5(o_custkey::VARCHAR || '|' || o_orderpriority) AS group_id FROM orders""")
def stable_keys(t):
    key = text.stable_id(F.col("o_orderkey").cast("string"), F.col("o_orderstatus"))
    return t.orders.select("o_orderkey", key.alias("stable_id"),
        F.md5(F.concat_ws("|", F.col("o_custkey").cast("string"), "o_orderpriority")).alias("group_id"))


@query("""
SELECT c_custkey, CASE WHEN ends_with(n, '_E' || c_custkey) THEN left(n, length(n) - length('_E' || c_custkey)) ELSE n END AS name
  FROM (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name || '_E' || c_custkey ELSE c_name || '_E0' END AS n FROM customer)""")
def display_names(t):
    emp = F.concat(F.lit("E"), F.col("c_custkey"))
    name = F.when(F.col("c_custkey") % 2 == 0, F.concat("c_name", F.lit("_"), emp)).otherwise(F.concat("c_name", F.lit("_E0")))
    return t.customer.select("c_custkey", text.display_name(name, emp).alias("name"))


EMAILS = ["B@x.io; a@x.io,,b@X.io", " c@x.io ", ";", "", None]


@example("""SELECT * FROM (VALUES (0, 'a@x.io,b@x.io'), (1, 'c@x.io'), (2, NULL), (3, NULL), (4, NULL)) v(i, canon)""")
def canonical_emails(t):
    return _values(t, "c", EMAILS).select("i", text.email_canon(F.col("c")).alias("canon"))


@query("""
SELECT user_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, json_exists(props, '$.k') AS has_k, json_exists(props, '$.zz') AS has_zz,
  event_id FROM events""")
def json_operators(t):
    return t.events.select("user_id", F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.get_json_object("props", "$.k").isNotNull().alias("has_k"), F.get_json_object("props", "$.zz").isNotNull().alias("has_zz"), "event_id")


RECORDS = ['[{"id": 1, "done": true}, {"id": 2}]', '"[{\\"id\\": 3, \\"done\\": false}]"', "[]", None, "broken"]


@example("""SELECT * FROM (VALUES (0, 1, 1, true), (0, 2, 2, NULL), (1, 1, 3, false)) v(i, ordinality, id, done)""")
def requirement_scan(t):
    return scans.exploded_records(_values(t, "c", RECORDS), "c", "id: int, done: boolean", ["i"])


@query("""
WITH b AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1), a AS (SELECT o_custkey AS k, count(*) AS n FROM orders
  WHERE o_orderkey % 4 <> 0 GROUP BY 1)
SELECT b.k AS o_custkey, b.n AS before, COALESCE(a.n, 0) AS after FROM b LEFT JOIN a ON a.k = b.k WHERE COALESCE(a.n, 0) * 100 < b.n * 70""")
def abnormal_drop(t):
    return scans.abnormal_counts(t.orders, t.orders.where("o_orderkey % 4 <> 0"), "o_custkey", 30)


@query("""
WITH f AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS u FROM orders
  WHERE o_orderkey % 9 <> 0),
s AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) - CAST(CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END AS INT) AS u FROM orders
  WHERE o_orderkey % 7 <> 0)
SELECT f.k, 'visit' AS plan FROM f LEFT JOIN s ON f.k = s.k WHERE s.u IS NULL OR f.u IS NULL OR f.u > s.u UNION ALL SELECT k, 'missing' FROM s
  WHERE k NOT IN (SELECT k FROM f)""")
def incremental_plan(t):
    day = F.to_date("o_orderdate")
    fetched = t.orders.where("o_orderkey % 9 <> 0").select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderkey") % 50 != 0, day).alias("u"))
    stored = t.orders.where("o_orderkey % 7 <> 0").select(F.col("o_orderkey").alias("k"),
        F.when(F.col("o_orderkey") % 4 == 0, F.date_sub(day, 1)).otherwise(day).alias("u"))
    visits = scans.plan_visits(fetched, stored, ["k"], "u").select("k", F.lit("visit").alias("plan"))
    return visits.union(scans.missing_keys(fetched, stored, ["k"]).select("k", F.lit("missing")))


@example("""SELECT CAST(unnest(generate_series(DATE '2024-02-01', DATE '2024-02-29', INTERVAL 1 DAY)) AS DATE) AS day, DATE '2024-02-01' AS month,
  'closed' AS kind
UNION ALL SELECT CAST(unnest(generate_series(DATE '2024-03-01', DATE '2024-03-01', INTERVAL 1 DAY)) AS DATE), DATE '2024-03-01', 'through today'""")
def pull_ranges(t):
    ranges = lambda flag, kind: scans.pull_ranges(t.spark, "2024-03-02 03:00:00", "America/New_York", flag).withColumn("kind",
        F.lit(kind))
    return ranges(False, "closed").unionByName(ranges(True, "through today"))


@query(f"""
SELECT o_orderkey, s NOT IN ('pending', 'cancelled') OR r > 0 OR (s = 'pending' AND d BETWEEN DATE '2001-07-31' AND DATE '{TODAY}') AS fetch FROM (
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'P' THEN 'cancelled' ELSE 'approved' END AS s, CAST(o_orderkey % 2 AS INT) AS r,
  CAST(o_orderdate AS DATE) AS d FROM orders)""")
def fetch_policy(t):
    status = F.when(F.col("o_orderstatus") == "O", "pending").when(F.col("o_orderstatus") == "P", "cancelled").otherwise("approved")
    return t.orders.select("o_orderkey", scans.fetch_timers(status, F.col("o_orderkey") % 2, F.to_date("o_orderdate"),
        F.lit(TODAY).cast("date")).alias("fetch"))


@query("""
SELECT user_id, max(ts) - INTERVAL 60 SECOND AS since, DATE '2025-01-28' AS until FROM events GROUP BY 1""")
def calendar_pull(t):
    since = (F.max("ts") - F.expr("INTERVAL 60 SECOND")).alias("since")
    return t.events.groupBy("user_id").agg(since).withColumn("until", scans.forward_cap(F.lit("2024-01-30").cast("date")))


@query("""SELECT DATE '2024-02-24' AS first_day, DATE '2024-03-02' AS last_day, count(*) AS n FROM events
  WHERE CAST(ts AS DATE) + 40 BETWEEN DATE '2024-02-24' AND DATE '2024-03-02'""")
def report_window(t):
    first, last = scans.pull_window("2024-03-01", 7)
    kept = t.events.where(F.date_add(F.to_date("ts"), 40).between(first, last))
    return kept.agg(F.lit(first).cast("date").alias("first_day"), F.lit(last).cast("date").alias("last_day"), F.count("*").alias("n"))


HEADINGS = ["March 4, 2021", "Apr 11 - 13, 2021", "May 30 – June 1, 2021", "Dec 30, 2020 - January 2, 2021", "February 2020", "2/29/2020", "2/30/2020", "Units by Region", "May Sales 2021", "June", "", None]


@example("""SELECT * FROM (VALUES (0, DATE '2021-03-04'), (1, DATE '2021-04-13'), (2, DATE '2021-06-01'), (3, DATE '2021-01-02'), (4,
  DATE '2020-02-29'), (5, DATE '2020-02-29'), (6, NULL), (7, NULL), (8, NULL), (9, NULL), (10, NULL), (11, NULL)) v(i, day)""")
def heading_days(t):
    return _values(t, "c", HEADINGS).select("i", scans.header_day(F.col("c")).alias("day"))


SALES = [
    ["Acme Inc"], ["Sales by Product"], ["February 6-8, 2026"], [],
        ["", "Date", "Transaction Type", "Num", "Customer", "Qty", "Amount", "P.O. Number"],
    ["Fiber splice"], ["", "02/06/2026", "Invoice", "17", "Bee", "2.00", "$1,200.50", "po-1"],
        [None, "02/07/2026", "Invoice", "18", "Cee", None, "10", None],
    ["Total for Fiber splice", None, None, None, None, "2", "1210.50"], ["Monday, Feb 09, 2026 08:00 AM GMT-5"], ["TOTAL"],
]


@example("""SELECT * FROM (VALUES ('s', DATE '2026-02-08', DATE '2026-02-06', 'Bee', '17', 2, 120050, 'po-1'), ('s', DATE '2026-02-08',
  DATE '2026-02-07', 'Cee', '18', NULL, 1000, NULL)) v(sheet, as_of, date, customer, num, qty, cents, po_number)""")
def sales_sheet(t):
    grid = t.spark.createDataFrame([("s", i, c) for i, c in enumerate(SALES)], "sheet string, row int, cells array<string>")
    return scans.sales_sheet(grid).select("sheet", "as_of", "date", "customer", "num", "qty", (F.col("amount") * 100).cast("int").alias("cents"),
        "po_number")


AGING = [["", "Customer", "Date", "Amount"], ["31-60 days"], ["", "Acme", "3/7/2024", "$10.50"], ["Total", None, None, "10.50"], ["61-90 days"],
    ["", "Dee", "3/9/2024", "7"], ["", "Beta", None, "1"]]


@example("""SELECT * FROM (VALUES ('31-60 days', 'Acme', DATE '2024-03-07', 1050), ('61-90 days', 'Dee', DATE '2024-03-09', 700)) v(aging_bucket,
  customer, date, cents)""")
def aging_sheet(t):
    grid = t.spark.createDataFrame([("s", i, c) for i, c in enumerate(AGING)], "sheet string, row int, cells array<string>")
    rows = scans.aging_sheet(scans.require_header(grid, ["customer", "date", "amount"]))
    return rows.select("aging_bucket", "customer", "date", (F.col("amount") * 100).cast("int").alias("cents"))


SCHEDULE = {
    "North": [["note"], ["ID Number", "Names", "Shift", "Year", "Start", "End"], ["", "PHT"], ["12", "Ann", "DS", "2025", "Dec-30", "Jan 2"],
        ["", "Bo", "NS", "2025", "3/9", ""], ["13", "Cy", "DS", "2025", "3/9/2026", "Mar-9"],
              ["12b", "Dee", "DS", "2025", "3/9", ""], ["14", "Eve", "", "2025", "-", ""], ["15", "Flo", "-", "", "2/30/2025", ""]],
    "Summary": [["Cluster", "ID Number", "Names"], ["x", "12", "Ann"]],
    "Other": [["nothing here"]],
}


@example("""SELECT * FROM (VALUES ('North', 3, '12', 'Ann', 'DS', DATE '2025-12-30', DATE '2026-01-02', 'temporary'), ('North', 4, '', 'Bo', 'NS',
  DATE '2025-03-09', NULL, 'ongoing'),
  ('North', 5, '13', 'Cy', 'DS', DATE '2026-03-09', DATE '2026-03-09', 'one_day')) v(sheet, row, id_number, name, shift, start_date, end_date,
  kind)""")
def schedule_sheet(t):
    rows = [(tab, i, cells) for tab, grid in SCHEDULE.items() for i, cells in enumerate(grid)]
    return scans.schedule_sheet(t.spark.createDataFrame(rows, "sheet string, row int, cells array<string>")).drop("row_hash")


@query("""
SELECT o_custkey % 12 AS pipeline, arg_max(o_orderstatus, o_orderkey) AS status, count(*) AS runs, arg_max(o_orderstatus,
  o_orderkey) = 'F' AS may_go_on FROM orders GROUP BY 1""")
def run_log(t):
    runs = t.orders.select((F.col("o_custkey") % 12).alias("pipeline"),
        F.when(F.col("o_orderstatus") == "F", "success").otherwise(F.col("o_orderstatus")).alias("status"), F.lit(1).alias("rows"),
            F.col("o_orderkey").alias("started"))
    made = scans.run_log(runs)
    return made.select("pipeline", F.when(F.col("may_go_on"), "F").otherwise(F.col("status")).alias("status"), "runs", "may_go_on")


@query("""SELECT 'nation' AS "table", count(*) AS n FROM nation UNION ALL SELECT 'region', count(*) FROM region UNION ALL SELECT 'part', count(*)
  FROM part""")
def row_counts(t):
    return scans.count_snapshot({"nation": t.nation, "region": t.region, "part": t.part})


@query("""
SELECT user_id, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events)
  WHERE r = 1""")
def newest_of_pulls(t):
    pulls = [t.events.where(f"event_type IN ({names})") for names in ("'click', 'view'", "'view', 'purchase'",
        "'purchase', 'click', 'error', 'signup', 'login', 'logout'")]
    rest = t.events.join(pulls[0].unionByName(pulls[1]).unionByName(pulls[2]).select("event_id").distinct(), "event_id", "left_anti")
    return scans.newest_per_key([*pulls, rest.select(*t.events.columns)], ["user_id", "event_type"],
        [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "ts")


USERS = ['[{"email": "Ann@X.io ", "day": "2024-03-07", "minutes": 30}, {"email": "bo@x.io", "day": "2024-03-08"}]',
    '[{"email": "ANN@x.io", "day": "2024-03-07", "minutes": 45}]', "[]", None]


@example("""SELECT * FROM (VALUES ('ann@x.io', DATE '2024-03-07', 45, 2), ('bo@x.io', DATE '2024-03-08', NULL, 1)) v(email, day, minutes, reports)""")
def reports_from_json(t):
    """Reports of a JSON pull by lower-cased address and day; the last of a pull wins."""
    rows = scans.exploded_records(_values(t, "c", USERS), "c", "email: string, day: date, minutes: int", ["i"])
    keyed = rows.withColumn("email", F.lower(F.trim("email")))
    last = F.max_by("minutes", F.struct("i", "ordinality")).alias("minutes")
    return keyed.groupBy("email", "day").agg(last, F.count("*").cast("int").alias("reports"))


@query("""
WITH old AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day, 'history' AS origin FROM events WHERE ts < TIMESTAMP '2024-01-12'),
  new AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day, 'live' AS origin FROM events WHERE ts >= TIMESTAMP '2024-01-10')
SELECT * FROM new UNION ALL SELECT * FROM old WHERE event_id NOT IN (SELECT event_id FROM new)""")
def historical_load(t):
    """Old entries loaded below what the live pull already has."""
    rows = t.events.select("event_id", "user_id", F.to_date("ts").alias("day"), "ts")
    at = lambda day: F.lit(day).cast("timestamp_ntz")
    old = rows.where(F.col("ts") < at("2024-01-12")).withColumn("origin", F.lit("history"))
    new = rows.where(F.col("ts") >= at("2024-01-10")).withColumn("origin", F.lit("live"))
    return sequences.overlay(new, old, ["event_id"]).drop("ts")
