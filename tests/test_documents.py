"""Variants, nested documents, the review's table functions, headings, and merges of repeated keys."""

import pytest
from pyspark.sql import functions as F

from tallyfield.functions import documents
from tallyfield.operators import merge
from tallyfield.plans import documents as plans
from tallyfield.plans.tables import Tables
from tallyfield.sources import scans

FOLDER = "/root/testdata/sf0.001"


def one(spark, text, *columns):
    df = spark.createDataFrame([(text,)], "text string").select(documents.parsed(F.col("text")).alias("v"))
    return tuple(df.select(*columns).first())


@pytest.mark.parametrize(("text", "kind"), [
    ('{"a": 1}', "object"), ("[1]", "array"), ('"x"', "string"), ("1", "number"), ("1.5", "number"), ("1e300", "number"), ("true", "boolean"),
    ("null", "null"), ("{", None), ("", None), (None, None),
])
def test_kinds(spark, text, kind):
    assert one(spark, text, documents.kind_of(F.col("v")).alias("k")) == (kind,)


def test_keys_are_taken_out_and_put_in(spark):
    v, text = F.col("v"), '{"a": 1, "b": {"c": [1, null]}, "d": null}'
    back = lambda c: F.to_json(c)
    made = one(spark, text, back(documents.without(v, "a", "zz")), back(documents.with_fields(v, a=F.lit("x"), e=F.array(F.lit(1)))), back(documents.without(v, "a", "b", "d")))
    assert made == ('{"b":{"c":[1,null]},"d":null}', '{"a":"x","b":{"c":[1,null]},"d":null,"e":[1]}', "{}")
    assert one(spark, "[1]", documents.without(v, "a"), documents.with_fields(v, a=F.lit(1)), documents.fields_of(v)) == (None, None, None)


def test_elements_of_what_is_no_array_and_of_other_kinds(spark):
    rows = [(1, '{"x": [{"n": 1}, {"n": "a"}, {}, 5]}'), (2, '{"x": {}}'), (3, "{}"), (4, None), (5, '{"x": []}')]
    df = spark.createDataFrame(rows, "id int, text string").withColumn("v", documents.parsed(F.col("text")))
    got = documents.elements(df, "v", "$.x", ["id"], {"n": "int"}).collect()
    assert [tuple(r) for r in got] == [(1, 1, 1), (1, 2, None), (1, 3, None), (1, 4, None)]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_parameters_that_are_not_given_leave_no_trace(spark):
    t = Tables(spark, FOLDER)
    plans.create_review_functions(spark, t)
    every = spark.sql("SELECT count(*) AS n FROM review_rows()")
    assert every.first().n == t.orders.count()
    assert "array_contains" not in plan_of(every) and "review_revenue" not in plan_of(every)
    assert "cents" not in plan_of(spark.sql("SELECT status, n FROM review_total(p_status => 'pending')"))
    assert "cents" in plan_of(spark.sql("SELECT status, n FROM review_total(p_rev_min => 5)"))


def test_filters_go_below_aggregates_and_windows(spark):
    plans.create_review_functions(spark, Tables(spark, FOLDER))
    total = plan_of(spark.sql("SELECT status, n FROM review_total(p_person => 7, p_flags => array('late', 'tardy'))"))
    # Under the aggregate, at the scan itself; the joins and the window that this call needs nothing of are gone.
    assert total.startswith("Aggregate [status") and " = 7)" in total and "Window" not in total and "l_orderkey" not in total
    rows = plan_of(spark.sql("SELECT report_id FROM review_rows(p_person => 7, p_unit => 1)"))
    assert rows[rows.index("Window [") :].count(" = 7)") >= 2  # both sides of the as-of join read one person


def test_any_flag_is_enough_and_named_arguments_bind(spark):
    plans.create_review_functions(spark, Tables(spark, FOLDER))
    ids = lambda flags: {r[0] for r in spark.sql(f"SELECT report_id FROM review_rows(p_flags => array({flags}))").collect()}
    late, tardy = ids("'late'"), ids("'tardy'")
    assert late and tardy and ids("'late', 'tardy'") == late | tardy and ids("'nothing of the kind'") == set()
    bound = spark.sql("SELECT DISTINCT status FROM review_rows(p_status => :s, p_date_from => :d)", args={"s": "pending", "d": "1999-01-01"})
    assert [r.status for r in bound.collect()] == ["pending"]
    up, down = (spark.sql(f"SELECT minutes FROM review_rows(p_sort_key => 'minutes', p_sort_dir => '{d}') ORDER BY sort_value, report_id").collect() for d in ("asc", "desc"))
    assert [r.minutes for r in up] == sorted(r.minutes for r in up) and up[0].minutes == down[-1].minutes


def test_sheet_days(spark):
    cells = ["Mar-9", "Jan 16", "september 3, 2020", "3/9", "3/9/2026", "3/9/26", "2/30/2025", "-", "", None, "9", "Maybe 3", "Foo 3", "Mar", "3/9/1/2", "3-9", "Mar 40"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    got = [r[0] and str(r[0]) for r in df.orderBy("i").select(scans.sheet_day(F.col("c"), F.lit(2025))).collect()]
    dated = ["2025-03-09", "2025-01-16", "2020-09-03", "2025-03-09", "2026-03-09", "2026-03-09"]
    assert got[:6] == dated and got[6:11] == [None] * 5 and got[12:] == [None] * 5
    assert df.select(scans.sheet_day(F.col("c"), F.lit(None).cast("int")).alias("d")).where("d IS NOT NULL").count() == 3


def test_a_merge_refuses_a_key_that_the_source_repeats(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z")], "k int, v string")
    for made in (merge.merge_snapshot(target, source, ["k"]), merge.snapshot_actions(target, source, ["k"]), merge.merge_capped(target, source, ["k"], F.lit(True))[0]):
        with pytest.raises(Exception, match='repeats in the source: {"k":1}'):
            made.collect()
    last = merge.merge_batch(target, source.withColumn("seq", F.col("v")), ["k"], "seq").collect()
    assert sorted(map(tuple, last)) == [(1, "y"), (2, "b"), (3, "z")]
