"""Queries over documents, and the review as SQL functions that return tables."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions import documents
from .fieldwork import FACT, reviewed
from .reports import query


@query("""
WITH x AS (SELECT event_type, props, json_type(props, '$.k') AS t, CAST(props ->> '$.k' AS BIGINT) AS k, len(json_keys(props)) AS keys FROM events)
SELECT event_type, CASE WHEN t IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN 'number' WHEN t IS NULL THEN 'none' ELSE 'other' END AS kind, count(*) AS n,
  CAST(sum(k) AS BIGINT) AS total, CAST(sum(k // 2) AS BIGINT) AS halves, CAST(sum(keys - 1) AS BIGINT) AS keys_left,
  CAST(sum(keys + 2) AS BIGINT) AS keys_made, count(*) FILTER (WHERE k % 2 = 1) AS odd FROM x GROUP BY 1, 2""")
def variant_props(t):
    """Properties of events: kinds told, a key taken out, fields put in and read back from the text that the new document writes."""
    k = F.try_variant_get("v", "$.k", "bigint")
    rows = t.events.select("event_type", documents.parsed(F.col("props")).alias("v"))
    made = documents.with_fields(F.col("v"), half=F.floor(k / 2).cast("long"), about=documents.document(odd=k % 2 == 1, tags=F.array(F.lit("k"))))
    rows = rows.withColumns({"w": documents.parsed(F.to_json(made)), "left": documents.without(F.col("v"), "k"), "k": k})
    size = lambda c: F.size(documents.fields_of(F.col(c))).cast("long")
    kind = F.coalesce(documents.kind_of(F.variant_get("v", "$.k", "variant")), F.lit("none"))
    return rows.groupBy("event_type", F.when(kind.isin("number", "none"), kind).otherwise("other").alias("kind")).agg(
        F.count("*").alias("n"), F.sum("k").alias("total"), F.sum(F.try_variant_get("w", "$.half", "bigint")).alias("halves"),
        F.sum(size("left")).alias("keys_left"), F.sum(size("w")).alias("keys_made"),
        F.count_if(F.try_variant_get("w", "$.about.odd", "boolean")).alias("odd"))


@query("""
SELECT conv_id, turn // 16 AS page, row_number() OVER (PARTITION BY conv_id, turn // 16 ORDER BY turn) AS ordinality, role,
  CAST(length(text) AS BIGINT) AS chars, count(*) OVER (PARTITION BY conv_id, turn // 16) AS turns,
  count(*) FILTER (WHERE role = 'user') OVER (PARTITION BY conv_id, turn // 16) AS from_user FROM conversations""")
def conversation_documents(t):
    """Conversations as nested documents, one for each sixteen turns so that none grows with its conversation, and their parts read back."""
    turn = F.struct("turn", "role", F.length("text").cast("long").alias("chars"))
    grouped = t.conversations.groupBy("conv_id", F.floor(F.col("turn") / 16).alias("page")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns"), F.count("*").alias("n"), F.count_if(F.col("role") == "user").alias("u"))
    made = documents.document(turns=F.col("turns"), counts=F.struct(F.col("n").alias("turns"), F.col("u").alias("user")))
    held = grouped.select("conv_id", "page", documents.parsed(F.to_json(made)).alias("doc"))
    count = lambda path, to: F.try_variant_get("doc", path, "bigint").alias(to)
    keyed = held.select("conv_id", "page", "doc", count("$.counts.turns", "turns"), count("$.counts.user", "from_user"))
    return documents.elements(keyed, "doc", "$.turns", ["conv_id", "page", "turns", "from_user"], {"role": "string", "chars": "bigint"})


@query(f"""
WITH {FACT}, r AS (SELECT *, CAST(date_trunc('month', work_date) AS DATE) AS month FROM review)
SELECT 'total' AS section, NULL AS name, count(*) AS reports, count(*) FILTER (WHERE filing = 'late') AS late, CAST(sum(minutes) AS BIGINT) AS minutes
FROM r UNION ALL SELECT 'trend', CAST(month AS VARCHAR), count(*), count(*) FILTER (WHERE filing = 'late'), CAST(sum(minutes) AS BIGINT) FROM r GROUP BY 2
UNION ALL SELECT 'groups', CAST(unit AS VARCHAR), count(*), count(*) FILTER (WHERE filing = 'late'), CAST(sum(minutes) AS BIGINT) FROM r GROUP BY 2""")
def review_document(t):
    """The whole review as one document with totals, a trend by month and groups by unit, and its sections read back as rows.

    Summed once by month and unit; only those sums, as many as there are months and units, meet in the document.
    """
    doc = _review_document(t)
    fields = {"name": "string", "reports": "bigint", "late": "bigint", "minutes": "bigint"}
    total = doc.select(F.lit("total").alias("section"), *[F.try_variant_get("doc", f"$.total.{k}", kind).alias(k) for k, kind in fields.items()])
    sections = [documents.elements(doc, "doc", f"$.{s}", [], fields).select(F.lit(s).alias("section"), *fields) for s in ("trend", "groups")]
    return total.union(sections[0]).union(sections[1])


def _review_document(t):
    rows = reviewed(t).groupBy(F.trunc("work_date", "month").cast("string").alias("trend"), F.col("unit").cast("string").alias("groups"))
    summed = rows.agg(F.count("*").alias("reports"), F.count_if(F.col("filing") == "late").alias("late"), F.sum("minutes").alias("minutes"))
    sums = [F.sum(c).alias(c) for c in ("reports", "late", "minutes")]
    by = summed.groupingSets([["trend"], ["groups"], []], "trend", "groups").agg(F.grouping_id().alias("g"), *sums)
    entry = lambda name: F.struct(name.alias("name"), "reports", "late", "minutes")
    listed = lambda g, c: F.sort_array(F.collect_list(F.when(F.col("g") == g, entry(F.col(c)))))
    nested = by.agg(F.max(F.when(F.col("g") == 3, entry(F.lit(None).cast("string")))).alias("total"), listed(1, "trend").alias("trend"), listed(2, "groups").alias("groups"))
    made = documents.document(**{c: F.col(c) for c in ("total", "trend", "groups")})
    return nested.select(documents.parsed(F.to_json(made)).alias("doc"))


# Parameters of the review's table functions, all with null as their default: no such filter.
PARAMETERS = {
    "p_search": "STRING", "p_person": "BIGINT", "p_persons": "ARRAY<BIGINT>", "p_unit": "BIGINT", "p_units": "ARRAY<BIGINT>", "p_status": "STRING",
    "p_statuses": "ARRAY<STRING>", "p_date_from": "DATE", "p_date_to": "DATE", "p_dows": "ARRAY<INT>", "p_flags": "ARRAY<STRING>",
    "p_untimed_min": "INT", "p_untimed_max": "INT", "p_stated_min": "BIGINT", "p_stated_max": "BIGINT", "p_overridden": "BOOLEAN",
    "p_rev_min": "BIGINT", "p_rev_max": "BIGINT", "p_sort_key": "STRING", "p_sort_dir": "STRING",
}
# What each flag asks of a report; of several flags one is enough.
FLAGS = {
    "late": "filing = 'late'", "on_time": "matured AND filing = 'on time'", "missing": "matured AND filing = 'missing'", "variance": "coverage <= 84",
    "tardy": "tardy", "no_history": "NOT has_history", "overridden": "overridden", "waiting": "waiting_days IS NOT NULL", "no_unit": "unit IS NULL",
    "untimed": "minutes = 0",
}
SORTS = ["lag_hours", "minutes", "variance", "coverage"]
COLUMNS = {"report_id": "BIGINT", "person": "BIGINT", "work_date": "DATE", "unit": "BIGINT", "status": "STRING", "filing": "STRING", "minutes": "BIGINT",
    "coverage": "DOUBLE", "lag_hours": "INT"}


def _body() -> str:
    asks = " OR ".join(f"(array_contains(p_flags, '{name}') AND {rule})" for name, rule in FLAGS.items())
    earned = "(SELECT max(d.cents) FROM review_revenue d WHERE d.person = v.person AND d.work_date = v.work_date)"
    return f"""(p_search IS NULL OR p_search = '' OR contains(CAST(person AS STRING), p_search))
    AND (p_person IS NULL OR person = p_person) AND (p_persons IS NULL OR array_contains(p_persons, person))
    AND (p_unit IS NULL OR unit = p_unit) AND (p_units IS NULL OR array_contains(p_units, unit))
    AND (p_status IS NULL OR status = p_status) AND (p_statuses IS NULL OR array_contains(p_statuses, status))
    AND (p_date_from IS NULL OR work_date >= p_date_from) AND (p_date_to IS NULL OR work_date <= p_date_to)
    AND (p_dows IS NULL OR cardinality(p_dows) = 0 OR array_contains(p_dows, dayofweek(work_date) - 1))
    AND (p_untimed_min IS NULL OR coverage <= 100 - p_untimed_min) AND (p_untimed_max IS NULL OR coverage >= 100 - p_untimed_max)
    AND (p_stated_min IS NULL OR minutes >= p_stated_min) AND (p_stated_max IS NULL OR minutes <= p_stated_max)
    AND (p_overridden IS NULL OR overridden = p_overridden)
    AND (p_rev_min IS NULL OR {earned} >= p_rev_min) AND (p_rev_max IS NULL OR {earned} <= p_rev_max)
    AND (p_flags IS NULL OR cardinality(p_flags) = 0 OR {asks})"""


def create_review_functions(spark: SparkSession, t) -> None:
    """``review_rows`` and ``review_total`` in this session: tables from named parameters, to be read, joined and paged in SQL.

    Parameters that a call gives become constants and the others' predicates fold away, so what is left is planned as if written
    out: under the aggregates, and under the windows where it names their keys.  ``sort_value`` is the column that
    ``p_sort_key`` names, falling unless ``p_sort_dir`` is ``asc``: page by it and report_id.
    """
    reviewed(t).createOrReplaceTempView("review_all")
    day = F.to_date("o_orderdate").alias("work_date")
    revenue = t.orders.groupBy(F.col("o_custkey").alias("person"), day).agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"))
    revenue.createOrReplaceTempView("review_revenue")
    named = ", ".join(f"{k} {kind} DEFAULT NULL" for k, kind in PARAMETERS.items())
    key = "CASE p_sort_key " + " ".join(f"WHEN '{c}' THEN CAST({c} AS DOUBLE)" for c in SORTS) + " END"
    columns, returned = ", ".join(COLUMNS), ", ".join(f"{c} {kind}" for c, kind in COLUMNS.items())
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION review_rows({named}) RETURNS TABLE ({returned}, sort_value DOUBLE)
      RETURN SELECT {columns}, CASE WHEN p_sort_dir = 'asc' THEN {key} ELSE -({key}) END FROM review_all v WHERE {_body()}""")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION review_total({named}) RETURNS TABLE (status STRING, n BIGINT)
      RETURN SELECT status, count(*) FROM review_all v WHERE {_body()} GROUP BY status""")


CALL = """p_search => '1', p_units => array(1, 2, 3, 4, 5), p_statuses => array('pending', 'approved'), p_date_from => DATE '1996-01-01',
  p_date_to => DATE '2000-12-31', p_dows => array(1, 2, 3, 4, 5), p_flags => array('late', 'tardy', 'variance'), p_untimed_max => 40,
  p_stated_min => 40, p_stated_max => 200, p_overridden => false, p_rev_min => 500000, p_rev_max => 40000000, p_sort_key => 'minutes', p_sort_dir => 'asc'"""
CALLED = f"""WITH {FACT}, d AS (SELECT o_custkey AS person, CAST(o_orderdate AS DATE) AS work_date, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT)
  AS cents FROM orders GROUP BY 1, 2),
kept AS (SELECT review.* FROM review JOIN d USING (person, work_date) WHERE contains(CAST(person AS VARCHAR), '1') AND unit IN (1, 2, 3, 4, 5)
  AND status IN ('pending', 'approved') AND work_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' AND extract(dow FROM work_date) BETWEEN 1 AND 5
  AND (filing = 'late' OR tardy OR coverage <= 84) AND coverage >= 60 AND minutes BETWEEN 40 AND 200 AND NOT overridden
  AND cents BETWEEN 500000 AND 40000000)"""


@query(f"{CALLED} SELECT {', '.join(COLUMNS)} FROM kept ORDER BY minutes NULLS LAST, report_id LIMIT 40 OFFSET 10")
def review_page_call(t):
    create_review_functions(t.spark, t)
    return t.spark.sql(f"SELECT {', '.join(COLUMNS)} FROM review_rows({CALL}) ORDER BY sort_value NULLS LAST, report_id LIMIT 40 OFFSET 10")


@query(f"{CALLED} SELECT status, count(*) AS n FROM kept GROUP BY 1")
def review_total_call(t):
    create_review_functions(t.spark, t)
    return t.spark.sql(f"SELECT status, n FROM review_total({CALL})")
