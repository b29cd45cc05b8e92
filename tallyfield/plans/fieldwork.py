"""Reports on filed work and its approval: the fact, its review, pages, backlogs, queues.

By analogy, an order is a daily report: its customer filed it, its date is the work date, its status the decision, its lines the tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..operators import aggregates, joins, sequences
from ..operators.dedup import dedup_latest
from .reports import query

TODAY = "2001-08-02"

FACT = f"""
worked AS (SELECT l_orderkey, CAST(sum(l_quantity) AS BIGINT) AS minutes, count(*) AS tasks FROM lineitem GROUP BY 1),
roster AS (SELECT o_custkey AS person, CAST(o_orderdate AS DATE) AS since, max(o_orderkey % 7) AS unit FROM orders WHERE o_orderkey % 4 = 0
  GROUP BY 1, 2),
filed AS (SELECT o_orderkey AS report_id, o_custkey AS person, CAST(o_orderdate AS DATE) AS work_date, CASE
  WHEN o_orderkey % 31 <> 0 THEN CAST(o_orderkey % 97 AS INT) END AS lag_hours,
  CASE WHEN o_orderkey % 15 = 0 THEN 'returned' WHEN o_orderstatus = 'F' THEN 'approved' WHEN o_orderstatus = 'O' THEN 'pending'
  ELSE 'returned' END AS status,
  o_orderkey % 15 = 0 AS overridden, CAST(o_orderkey * 37 % 86400 AS BIGINT) AS clock_in FROM orders),
fact AS (SELECT f.*, (SELECT unit FROM roster r WHERE r.person = f.person AND r.since <= f.work_date ORDER BY since DESC LIMIT 1) AS unit,
  COALESCE(minutes, 0) AS minutes, COALESCE(tasks, 0) AS tasks,
  f.person IN (SELECT user_id FROM events) AS has_history, COALESCE(minutes, 0) - 120 AS variance, CAST(floor((COALESCE(minutes,
  0) * 2000 + 120) / 240) AS BIGINT) / 10.0::DOUBLE AS coverage,
  CAST((floor((clock_in - 32400) / 60.0)::BIGINT + 720 + 1440 * 10) % 1440 - 720 AS BIGINT) AS late_minutes,
  CASE WHEN extract(dow FROM work_date) = 5 THEN 61 ELSE 49 END AS deadline_hours,
  CASE WHEN status = 'pending' AND lag_hours IS NOT NULL THEN date_diff('day', work_date, DATE '{TODAY}') END AS waiting_days
FROM filed f LEFT JOIN worked ON l_orderkey = report_id),
review AS (SELECT *, date_diff('day', work_date, DATE '{TODAY}') * 24 >= deadline_hours AS matured, CASE WHEN lag_hours IS NULL THEN 'missing'
  WHEN lag_hours > deadline_hours THEN 'late' ELSE 'on time' END AS filing,
  late_minutes BETWEEN 1 AND 240 AS tardy FROM fact)"""


def approvals(t) -> DataFrame:
    """One row a report: decision with overrides before the report's own, unit as of the work date, hours, lateness, waiting."""
    worked = t.lineitem.groupBy(F.col("l_orderkey").alias("report_id")).agg(F.sum("l_quantity").cast("long").alias("minutes"),
        F.count("*").alias("tasks"))
    key, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    own = F.when(F.col("o_orderstatus") == "F", "approved").when(F.col("o_orderstatus") == "O", "pending").otherwise("returned")
    overlay = t.orders.where(key % 15 == 0).select(key.alias("report_id"), F.lit("returned").alias("override"))
    roster = t.orders.where(key % 4 == 0).groupBy(F.col("o_custkey").alias("person"), day.alias("since")).agg(F.max(key % 7).alias("unit"))
    filed = t.orders.select(
        key.alias("report_id"), F.col("o_custkey").alias("person"), day.alias("work_date"),
            F.when(key % 31 != 0, (key % 97).cast("int")).alias("lag_hours"),
        own.alias("own"), (key * 37 % 86400).alias("clock_in"),
    )
    known = joins.asof_join(filed, roster, ["person"], "work_date", "since", ["unit"]).drop("since")
    active = t.events.select(F.col("user_id").alias("person")).distinct().withColumn("_active", F.lit(True))
    rows = known.join(overlay, "report_id", "left").join(worked, "report_id", "left").join(active, "person", "left")
    rows = rows.withColumns({
        "status": F.coalesce("override", "own"), "overridden": F.col("override").isNotNull(), "has_history": F.col("_active").isNotNull(),
        "minutes": F.coalesce("minutes", F.lit(0)), "tasks": F.coalesce("tasks", F.lit(0)),
    })
    waiting = F.when((F.col("status") == "pending") & F.col("lag_hours").isNotNull(),
        F.date_diff(F.lit(TODAY).cast("date"), "work_date").cast("long"))
    return rows.withColumns({
        "variance": F.col("minutes") - 120, "coverage": aggregates.tenth_percent(F.col("minutes"), F.lit(120)),
        "late_minutes": dates.lateness(F.col("clock_in"), F.lit(32400)).cast("long"), "deadline_hours": dates.filing_deadline(F.col("work_date")),
            "waiting_days": waiting,
    }).drop("own", "override", "_active")


def reviewed(t) -> DataFrame:
    """The fact with the filing verdict: matured once the deadline is past; missing, late or on time; tardy clock-ins."""
    hours = F.date_diff(F.lit(TODAY).cast("date"), "work_date") * 24
    filing = F.when(F.col("lag_hours").isNull(), "missing").when(F.col("lag_hours") > F.col("deadline_hours"), "late").otherwise("on time")
    return approvals(t).withColumns({"matured": hours >= F.col("deadline_hours"), "filing": filing, "tardy": F.col("late_minutes").between(1, 240)})


FACT_COLUMNS = ["report_id", "person", "work_date", "lag_hours", "status", "overridden", "unit", "minutes", "tasks", "has_history", "variance",
    "coverage", "late_minutes", "deadline_hours", "waiting_days"]


@query(f"WITH {FACT} SELECT {', '.join(FACT_COLUMNS)} FROM fact")
def approvals_fact(t):
    return approvals(t).select(*FACT_COLUMNS)


@query(f"WITH {FACT} SELECT report_id, matured, filing, tardy, variance, unit FROM review")
def report_review(t):
    return reviewed(t).select("report_id", "matured", "filing", "tardy", "variance", "unit")


def review_filter(rows: DataFrame, filters: dict) -> DataFrame:
    """Rows that pass every filter that is given; null means no filter.

    ``persons``, ``units``, ``statuses``, ``filings``: lists; ``since``, ``until``: work dates; ``tardy``, ``overridden``, ``matured``,
    ``has_history``: flags; ``least_/most_`` ``minutes``, ``variance``, ``coverage``, ``lag_hours``: bounds.
    """
    lists = {"persons": "person", "units": "unit", "statuses": "status", "filings": "filing"}
    kept = {k: v for k, v in filters.items() if v is not None}
    for name, value in kept.items():
        if name in lists:
            rows = rows.where(F.col(lists[name]).isin(value))
        elif name in ("since", "until"):
            bound = F.lit(value).cast("date")
            rows = rows.where(F.col("work_date") >= bound if name == "since" else F.col("work_date") <= bound)
        elif name.startswith("least_"):
            rows = rows.where(F.col(name[6:]) >= value)
        elif name.startswith("most_"):
            rows = rows.where(F.col(name[5:]) <= value)
        else:
            rows = rows.where(F.col(name) == value)
    return rows


FILTERS = {"units": [1, 2, 3], "statuses": ["pending", "approved"], "filings": ["late"], "since": "1996-01-01", "until": "2000-12-31", "tardy": None,
    "overridden": False,
           "matured": True, "has_history": None, "least_minutes": 20, "most_coverage": 400.0, "persons": None}
FILTERED = """unit IN (1, 2, 3) AND status IN ('pending', 'approved') AND filing = 'late' AND work_date BETWEEN DATE '1996-01-01'
  AND DATE '2000-12-31'
  AND NOT overridden AND matured AND minutes >= 20 AND coverage <= 400"""


@query(f"""WITH {FACT} SELECT report_id, person, work_date, minutes, lag_hours FROM review WHERE {FILTERED}
ORDER BY lag_hours DESC NULLS LAST, minutes ASC NULLS LAST, report_id LIMIT 40 OFFSET 10""")
def review_page(t):
    rows = review_filter(reviewed(t), FILTERS)
    return sequences.page(rows, [("lag_hours", True), ("minutes", False)], "report_id", offset=10, limit=40).select("report_id", "person",
        "work_date", "minutes", "lag_hours")


@query(f"WITH {FACT} SELECT count(*) AS n FROM review WHERE {FILTERED}")
def review_count(t):
    return review_filter(reviewed(t), FILTERS).agg(F.count("*").alias("n"))


@query(f"""WITH {FACT} SELECT CAST(date_trunc('month', work_date) AS DATE) AS month, count(*) AS reports,
  count(*) FILTER (WHERE filing = 'late') AS late,
  count(*) FILTER (WHERE filing = 'missing' AND matured) AS missing, count(DISTINCT person) FILTER (WHERE tardy) AS tardy_people,
  bool_or(overridden) AS any_override,
  round(quantile_cont(lag_hours, 0.5), 1) AS lag_p50, round(quantile_cont(lag_hours, 0.9) FILTER (WHERE status = 'approved'), 1) AS lag_p90_approved
  FROM review GROUP BY 1""")
def review_summary(t):
    rows = reviewed(t).withColumn("month", F.trunc("work_date", "month"))
    counted = rows.groupBy("month").agg(
        F.count("*").alias("reports"), F.count_if(F.col("filing") == "late").alias("late"),
        F.count_if((F.col("filing") == "missing") & F.col("matured")).alias("missing"),
        F.countDistinct(F.when(F.col("tardy"), F.col("person"))).alias("tardy_people"), F.bool_or("overridden").alias("any_override"),
    )
    lags = aggregates.quantiles(rows, ["month"], "lag_hours", {"lag_p50": (0.5, None), "lag_p90_approved": (0.9, F.col("status") == "approved")})
    return counted.join(lags, "month", "left").withColumns({c: F.round(c, 1) for c in ("lag_p50", "lag_p90_approved")})


@query(f"""WITH {FACT} SELECT person, count(*) AS reports, count(*) FILTER (WHERE filing <> 'on time') AS bad,
  CAST(floor((count(*) FILTER (WHERE filing <> 'on time') * 2000 + count(*)) / (count(*) * 2)) AS BIGINT) / 10.0::DOUBLE AS rate FROM review
  WHERE matured GROUP BY 1 HAVING count(*) >= 10""")
def review_offenders(t):
    bad = F.count_if(F.col("filing") != "on time").alias("bad")
    counted = reviewed(t).where("matured").groupBy("person").agg(F.count("*").alias("reports"), bad).where("reports >= 10")
    return counted.withColumn("rate", aggregates.tenth_percent(F.col("bad"), F.col("reports")))


@query(f"""WITH {FACT} SELECT unit, count(*) FILTER (WHERE status = 'approved') AS approved, round(quantile_cont(lag_hours,
  0.5) FILTER (WHERE status = 'approved'), 1) AS p50,
  round(quantile_cont(lag_hours, 0.9) FILTER (WHERE status = 'approved'), 1) AS p90, max(lag_hours) FILTER (WHERE status = 'approved') AS worst
  FROM fact GROUP BY 1""")
def approval_latency(t):
    done, facts = F.col("status") == "approved", approvals(t).select("unit", "status", "lag_hours")
    counted = facts.groupBy("unit").agg(F.count_if(done).alias("approved"), F.max(F.when(done, F.col("lag_hours"))).alias("worst"))
    at = aggregates.quantiles(facts, ["unit"], "lag_hours", {"p50": (0.5, done), "p90": (0.9, done)}).withColumnRenamed("unit", "_unit")
    both = counted.join(at, F.col("unit").eqNullSafe(F.col("_unit")), "left")
    return both.select("unit", "approved", *[F.round(p, 1).alias(p) for p in ("p50", "p90")], "worst")


@query(f"""WITH {FACT} SELECT unit, count(*) FILTER (WHERE waiting_days < 400) AS fresh, count(*) FILTER (WHERE waiting_days >= 400
  AND waiting_days < 900) AS amber,
  count(*) FILTER (WHERE waiting_days >= 900) AS red, max(waiting_days) AS longest FROM fact WHERE waiting_days IS NOT NULL GROUP BY 1""")
def approval_queue(t):
    days = F.col("waiting_days")
    return approvals(t).where("waiting_days IS NOT NULL").groupBy("unit").agg(
        F.count_if(days < 400).alias("fresh"), F.count_if((days >= 400) & (days < 900)).alias("amber"), F.count_if(days >= 900).alias("red"),
            F.max(days).alias("longest")
    )


PERIODS = f"""{FACT}, graded AS (SELECT *, CASE WHEN day(work_date) <= 15 THEN make_date(year(work_date), month(work_date), 15)
  ELSE last_day(work_date) END AS period_end FROM fact)"""


@query(f"""WITH {PERIODS}, p AS (SELECT period_end, count(*) AS reports, count(*) FILTER (WHERE status = 'approved') AS approved,
  count(*) FILTER (WHERE waiting_days IS NOT NULL) AS waiting FROM graded GROUP BY 1)
SELECT period_end, reports, approved, waiting, CASE WHEN approved = reports THEN 'done' WHEN waiting * 10 > reports THEN 'behind'
  ELSE 'open' END AS grade, CAST(date_diff('day', DATE '{TODAY}', period_end) AS INT) AS days_left
FROM p ORDER BY period_end DESC LIMIT 7""")
def approval_compliance(t):
    counted = approvals(t).groupBy(dates.period_end(F.col("work_date")).alias("period_end")).agg(
        F.count("*").alias("reports"), F.count_if(F.col("status") == "approved").alias("approved"), F.count("waiting_days").alias("waiting"))
    grade = F.when(F.col("approved") == F.col("reports"), "done").when(F.col("waiting") * 10 > F.col("reports"), "behind").otherwise("open")
    left = F.date_diff("period_end", F.lit(TODAY).cast("date"))
    return counted.withColumns({"grade": grade, "days_left": left}).orderBy(F.desc("period_end")).limit(7)


TRACKS = f"""{FACT}, tracks AS (SELECT person, work_date, 'late filing' AS track FROM review WHERE filing = 'late' UNION ALL SELECT person,
  work_date, 'no filing' FROM review WHERE filing = 'missing' AND matured
  UNION ALL SELECT person, work_date, 'tardy' FROM review WHERE tardy),
decided AS (SELECT person, work_date, report_id % 2 = 0 AS excused, report_id FROM review WHERE report_id % 5 = 0),
latest AS (SELECT person, work_date, arg_max(excused, report_id) AS excused FROM decided GROUP BY 1, 2)"""


@query(f"""WITH {TRACKS} SELECT CAST(date_trunc('month', work_date) AS DATE) AS month, track, count(*) AS n,
  count(*) FILTER (WHERE excused) AS excused FROM tracks LEFT JOIN latest USING (person, work_date) GROUP BY 1, 2""")
def infraction_months(t):
    rows = _infractions(t)
    return rows.groupBy(F.trunc("work_date", "month").alias("month"), "track").agg(F.count("*").alias("n"), F.count_if("excused").alias("excused"))


@query(f"""WITH {TRACKS} SELECT person, work_date, track, COALESCE(excused, false) AS excused FROM tracks LEFT JOIN latest USING (person, work_date)
  WHERE work_date >= DATE '2001-01-01'""")
def infraction_detail(t):
    return _infractions(t).where(F.col("work_date") >= F.lit("2001-01-01").cast("date")).select("person", "work_date", "track",
        F.coalesce("excused", F.lit(False)).alias("excused"))


def _infractions(t) -> DataFrame:
    """All tracks of infractions; of several decisions on a person's day the latest wins."""
    rows = reviewed(t)
    flags = F.array_compact(F.array(
        F.when(F.col("filing") == "late", "late filing"), F.when((F.col("filing") == "missing") & F.col("matured"), "no filing"),
            F.when(F.col("tardy"), "tardy"),
    ))
    decided = rows.where("report_id % 5 = 0").withColumn("excused", F.col("report_id") % 2 == 0)
    latest = dedup_latest(decided, ["person", "work_date"], [F.desc("report_id")]).select("person", "work_date", "excused")
    return rows.select("person", "work_date", F.explode(flags).alias("track")).join(latest, ["person", "work_date"], "left")


@query("""
WITH h AS (SELECT user_id, CAST(ts AS DATE) AS day, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS minutes FROM events
  WHERE event_type = 'purchase' GROUP BY 1, 2),
a AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS seen FROM events WHERE event_type = 'view' GROUP BY 1, 2)
SELECT COALESCE(h.user_id, a.user_id) AS user_id, COALESCE(h.day, a.day) AS day, COALESCE(minutes, 0) AS minutes, COALESCE(seen, 0) AS seen,
  CASE WHEN h.user_id IS NULL THEN 'attendance only' WHEN a.user_id IS NULL THEN 'hours only' ELSE 'both' END AS side FROM h FULL
  JOIN a ON h.user_id = a.user_id AND h.day = a.day""")
def hours_attendance(t):
    by = ["user_id", F.to_date("ts").alias("day")]
    hours = t.events.where("event_type = 'purchase'").groupBy(*by).agg(F.sum(F.floor("value")).alias("minutes"))
    seen = t.events.where("event_type = 'view'").groupBy(*by).agg(F.count("*").alias("seen"))
    side = F.when(F.col("minutes").isNull(), "attendance only").when(F.col("seen").isNull(), "hours only").otherwise("both")
    return hours.join(seen, ["user_id", "day"], "full").select("user_id", "day", F.coalesce("minutes", F.lit(0)).alias("minutes"),
        F.coalesce("seen", F.lit(0)).alias("seen"), side.alias("side"))


@query("""
WITH a AS (SELECT s_suppkey AS user_id, s_name AS alias, s_nationkey AS nk FROM supplier),
f AS (SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS r FROM events
  WHERE event_type = 'purchase')
SELECT f.user_id, CAST(ts AS DATE) AS day, event_id, COALESCE(alias, 'user ' || f.user_id) AS name FROM f LEFT JOIN a USING (user_id) WHERE r = 1""")
def filed_reports(t):
    filed = dedup_latest(t.events.where("event_type = 'purchase'").withColumn("day", F.to_date("ts")), ["user_id", "day"],
        [F.desc("ts"), F.desc("event_id")])
    alias = t.supplier.select(F.col("s_suppkey").alias("user_id"), F.col("s_name").alias("alias"))
    name = F.coalesce("alias", F.concat(F.lit("user "), "user_id")).alias("name")
    return joins.top1_lookup(filed, alias, ["user_id"], [F.asc("alias")]).select("user_id", "day", "event_id", name)


@query("""
SELECT event_id, user_id, c_name, n_name, event_type, CAST(ts AS DATE) AS day, CAST(floor(value) AS BIGINT) AS minutes
FROM events LEFT JOIN customer ON c_custkey = user_id LEFT JOIN nation ON n_nationkey = c_nationkey""")
def timer_activities(t):
    people = t.customer.join(joins.bounded(t.nation), F.col("c_nationkey") == F.col("n_nationkey"),
        "left").select(F.col("c_custkey").alias("user_id"), "c_name", "n_name")
    return t.events.join(people, "user_id", "left").select("event_id", "user_id", "c_name", "n_name", "event_type", F.to_date("ts").alias("day"),
        F.floor("value").alias("minutes"))


@query("""
SELECT l_orderkey, l_linenumber, p_name, s_name, o_orderstatus, l_returnflag = 'R' AS rejected, CAST(l_shipdate AS DATE) AS filed
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey""")
def qa_forms(t):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey"),
        "left").join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    return rows.select("l_orderkey", "l_linenumber", "p_name", "s_name", "o_orderstatus", (F.col("l_returnflag") == "R").alias("rejected"),
        F.to_date("l_shipdate").alias("filed"))


@query(f"""
WITH s AS (SELECT l_orderkey, min(CAST(l_shipdate AS DATE)) AS planned FROM lineitem GROUP BY 1),
j AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS due, planned, CASE WHEN planned IS NULL THEN 'none' WHEN planned IS NOT DISTINCT
  FROM CAST(o_orderdate AS DATE) THEN 'same'
  WHEN planned < CAST(o_orderdate AS DATE) THEN 'ghost' WHEN date_diff('day', CAST(o_orderdate AS DATE), planned) > 90 THEN 'stale'
  ELSE 'moved' END AS anomaly FROM orders LEFT JOIN s ON l_orderkey = o_orderkey)
SELECT o_orderkey, anomaly, CASE WHEN anomaly = 'moved' THEN planned ELSE due END AS effective FROM j""")
def priorities_effective(t):
    planned = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min(F.to_date("l_shipdate")).alias("planned"))
    rows = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("due")).join(planned, "o_orderkey", "left")
    return sequences.effective_date(rows, "due", "planned", stale_days=90).select("o_orderkey", "anomaly", "effective")


@query("""
WITH w AS (SELECT l_orderkey, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) FILTER (WHERE l_linenumber % 2 = 1) AS BIGINT) AS a,
  CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) FILTER (WHERE l_linenumber % 2 = 0) AS BIGINT) AS b,
  bool_or(l_linenumber % 2 = 0 AND l_returnflag <> 'R') AS b_approved FROM lineitem GROUP BY 1)
SELECT l_orderkey, CASE WHEN a IS NULL THEN 'unpriced' WHEN b IS NOT NULL AND NOT b_approved THEN 'bundled' ELSE 'priced' END AS pricing_status,
  CASE WHEN a IS NULL THEN 0 WHEN b IS NOT NULL AND NOT b_approved THEN a + b ELSE a END AS a_cents, CASE WHEN b IS NULL OR (a IS NOT NULL
  AND NOT b_approved) THEN 0 ELSE b END AS b_cents FROM w""")
def revenue_bundled(t):
    return aggregates.bundled(t.lineitem.withColumn("cents", aggregates.cents("l_extendedprice")), "l_orderkey", "cents",
        F.col("l_linenumber") % 2 == 1, F.col("l_returnflag") != "R")


@query(f"""
WITH s AS (SELECT CAST(o_orderdate AS DATE) AS day, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders),
o AS (SELECT day, count(*) AS open_n, CAST(sum(cents) AS BIGINT) AS open_cents FROM s WHERE o_orderstatus <> 'F' GROUP BY 1), i AS (SELECT day,
  count(*) AS done_n, CAST(sum(cents) AS BIGINT) AS done_cents FROM s WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT COALESCE(o.day, i.day) AS day, COALESCE(open_n, 0) AS open_n, COALESCE(done_n, 0) AS done_n, COALESCE(done_cents, 0) - COALESCE(open_cents,
  0) AS variance FROM o FULL JOIN i ON o.day = i.day""")
def forecast_daily(t):
    rows = t.orders.select(F.to_date("o_orderdate").alias("day"), (F.col("o_orderstatus") == "F").alias("done"),
        aggregates.cents("o_totalprice").alias("cents"))
    side = lambda flag, to: rows.where(flag).groupBy("day").agg(F.count("*").alias(f"{to}_n"), F.sum("cents").alias(f"{to}_cents"))
    both = side(~F.col("done"), "open").join(side(F.col("done"), "done"), "day", "full")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return both.select("day", zero("open_n").alias("open_n"), zero("done_n").alias("done_n"),
        (zero("done_cents") - zero("open_cents")).alias("variance"))


@query(f"""
SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '{TODAY}') AS age, CASE WHEN date_diff('day', CAST(o_orderdate AS DATE),
  DATE '{TODAY}') < 400 THEN 'current'
  WHEN date_diff('day', CAST(o_orderdate AS DATE), DATE '{TODAY}') < 900 THEN 'aging' ELSE 'overdue' END AS band,
  CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders WHERE o_orderstatus = 'O'""")
def forecast_open(t):
    age = F.date_diff(F.lit(TODAY).cast("date"), F.to_date("o_orderdate")).cast("long")
    band = F.when(F.col("age") < 400, "current").when(F.col("age") < 900, "aging").otherwise("overdue")
    rows = t.orders.where("o_orderstatus = 'O'").select("o_orderkey", age.alias("age"), aggregates.cents("o_totalprice").alias("cents"))
    return rows.withColumn("band", band)


@query("""
SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS invoices,
  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents,
  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) FILTER (WHERE o_orderkey % 4 = 0) AS BIGINT) AS disputed FROM orders WHERE o_orderstatus = 'F'
  GROUP BY 1, 2""")
def forecast_invoiced(t):
    rows = t.orders.where("o_orderstatus = 'F'").withColumns({"month": F.trunc(F.to_date("o_orderdate"), "month"),
        "c": aggregates.cents("o_totalprice")})
    return rows.groupBy("o_custkey", "month").agg(
        F.count("*").alias("invoices"), F.sum("c").alias("cents"), F.sum(F.when(F.col("o_orderkey") % 4 == 0, F.col("c"))).alias("disputed"))
