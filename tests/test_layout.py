"""Partitioned tables, versions, change logs, audits by digests and the split as-of join."""

import datetime

import pytest
from pyspark.sql import functions as F

from tallyfield.operators import audits, joins
from tallyfield.plans import layouts
from tallyfield.sources import files, layout
from tallyfield.streaming.loads import shared_folder


def leaves(plan):
    """Scans of a plan that has run, those of finished stages and subqueries included."""
    name = plan.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        return leaves(plan.executedPlan())
    if "QueryStage" in name:
        return leaves(plan.plan())
    children = [plan.children().apply(i) for i in range(plan.children().size())]
    return [x for c in children for x in leaves(c)] if children else [plan]


def files_read(df):
    return sorted(int(p.metrics().get("numFiles").get().value()) for p in leaves(df._jdf.queryExecution().executedPlan()) if p.nodeName().startswith("Scan"))


def test_scans_read_only_the_partitions_that_filter_and_join_leave(spark):
    folder = shared_folder(spark)
    days = spark.range(3000).select("id", F.expr("date_add(DATE '1995-01-01', CAST(id AS INT))").alias("d"))
    rows = days.select("id", F.trunc("d", "month").alias("month"), F.lit("O").alias("o_orderstatus"), F.col("id").alias("cents"))
    layout.write_partitions(rows.coalesce(1), f"{folder}/orders", ["month"])
    months = rows.select("month").distinct().withColumn("quarter", F.quarter("month"))
    months.coalesce(1).write.parquet(f"{folder}/calendar")
    orders = spark.read.parquet(f"{folder}/orders")
    df = layouts.pruned(orders, spark.read.parquet(f"{folder}/calendar"))
    made = df.collect()
    wanted = [r.month for r in months.where("month >= '1996-01-01' AND quarter = 3").collect()]
    assert sorted(r.month for r in made) == sorted(wanted)
    plan = df._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "dynamicpruning" in plan
    assert files_read(df)[-1] == len(wanted)  # of 99 months
    one = orders.where("month = DATE '1997-05-01'").select("cents")
    one.collect()
    assert files_read(one) == [1]


def test_only_partitions_that_pass_are_written(spark):
    path = f"{shared_folder(spark)}/t"
    kind = "k string, v int"
    layout.write_partitions(spark.createDataFrame([(k, i) for k in ("a", "b", None) for i in range(10)], kind), path, ["k"])
    layout.write_partitions(spark.createDataFrame([("c", 1)], kind), path, ["k"])  # appended
    before = {n: files.names(spark, f"{path}/{n}") for n in files.names(spark, path) if n.startswith("k=")}
    batch = [("a", i + 100) for i in range(9)] + [("b", 1)] * 8 + [(None, i + 100) for i in range(12)] + [("d", 7)]
    done = layout.refresh_partitions(path, spark.createDataFrame(batch, kind), ["k"])
    assert {r.k: (r.old_rows, r.new_rows, r.action) for r in done.collect()} == {
        "a": (10, 9, "refreshed"), "b": (10, 8, "kept"), None: (10, 12, "refreshed"), "c": (1, 0, "untouched"), "d": (0, 1, "added"),
    }
    now = spark.read.parquet(path).groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("v")).collect()
    assert {r.k: (r.n, r.v) for r in now} == {"a": (9, 108), "b": (10, 9), None: (12, 111), "c": (1, 1), "d": (1, 7)}
    after = {n: files.names(spark, f"{path}/{n}") for n in before}
    assert {n for n in before if before[n] == after[n]} == {"k=b", "k=c"}
    nothing = layout.refresh_partitions(path, spark.createDataFrame([], kind), ["k"])
    assert {r.action for r in nothing.collect()} == {"untouched"} and spark.read.parquet(path).count() == 33


def test_readers_see_a_whole_version(spark, monkeypatch):
    table = f"{shared_folder(spark)}/t"
    with pytest.raises(FileNotFoundError):
        layout.current(spark, table)
    assert layout.publish(spark.range(5), table) == 1
    first = layout.current(spark, table)
    seen = []

    def commit(session, path, text):
        seen.append(layout.current(session, table).count())  # all of the new version lies there, and none of it shows
        files.write_once(session, path, text)

    monkeypatch.setattr(layout, "write_once", commit)
    assert layout.publish(spark.range(70), table) == 2
    assert seen == [5] and first.count() == 5 and layout.current(spark, table).count() == 70
    assert layout.current(spark, table, 1).count() == 5


def test_a_commit_is_given_once(spark):
    table = f"{shared_folder(spark)}/t"
    files.write_once(spark, f"{table}/commits/000000000001.json", "{}")
    with pytest.raises(Exception, match="(?i)exist"):
        files.write_once(spark, f"{table}/commits/000000000001.json", "{}")
    assert files.read_text(spark, f"{table}/commits/000000000001.json") == "{}"
    files.write_once(spark, f"{table}/a", "x")
    with pytest.raises(FileExistsError):
        files.move(spark, f"{table}/a", f"{table}/commits")


def test_content_hashes_tell_nulls_repeats_and_places_but_not_order(spark):
    made = lambda rows: layout.content_hash(spark.createDataFrame(rows, "a int, b int"))
    assert made([(1, 2), (3, 4)]) == made([(3, 4), (1, 2)])
    assert len({made(r) for r in ([], [(1, None)], [(None, 1)], [(1, 1)], [(1, 1)] * 2, [(1, 1)] * 3, [(None, None)])}) == 7


def test_failed_refused_and_equal_loads_leave_the_table(spark):
    table = f"{shared_folder(spark)}/t"
    assert layout.run_records(spark, table).count() == 0

    def broken():
        raise RuntimeError("no source")

    def shrunk(before, after):
        if after < before:
            raise ValueError("fewer rows")

    runs = [layout.reload(spark, table, load, shrunk) for load in (broken, lambda: spark.range(9), broken, lambda: spark.range(9), lambda: spark.range(8))]
    assert [(r["status"], r["version"], r["rows"]) for r in runs] == [
        ("failed", None, None), ("success", 1, 9), ("failed", 1, None), ("skipped", 1, 9), ("failed", 1, 8)]
    assert layout.current(spark, table).count() == 9
    files.write_once(spark, f"{table}/runs/000000000006-start.json", '{"run": 6}')  # a run that never ended
    assert [r.status for r in layout.run_records(spark, table).orderBy("run").collect()] == ["failed", "success", "failed", "skipped", "failed", "running"]


def test_every_state_comes_back_from_the_log(spark):
    log, kind = f"{shared_folder(spark)}/log", "k int, type string, v int"
    states = [
        [(1, "a", 1), (2, "b", None), (3, None, 3)], [(1, "a", 1), (2, "b", 5), (4, "n", 4)], [], [(1, "c", 1), (2, "b", None)],
    ]
    before = None
    for run, rows in enumerate(states, 1):
        df = spark.createDataFrame(rows, kind)
        for _ in range(1 + (run == 2)):  # a run that is logged again
            layout.log_changes(log, before, df, ["k"], run, "type")
        before = df
    changes = spark.read.parquet(log)
    for run, rows in enumerate(states, 1):
        got = layout.replay(changes, ["k"], run).select("k", "type", "v").collect()
        assert sorted(map(tuple, got), key=repr) == sorted(rows, key=repr)
    second = {(r.k, r.action, r.previous_type) for r in changes.where("run = 2").collect()}
    assert second == {(2, "update", "b"), (3, "delete", None), (4, "insert", None)}
    with pytest.raises(ValueError, match="repeat"):
        layout.log_changes(log, None, spark.createDataFrame([(1, "a", 1), (1, "b", 2)], kind), ["k"], 9, "type")


def test_equal_buckets_are_left_out_before_rows_are_compared(spark):
    old = spark.range(20_000).select((F.col("id") % 4).cast("string").alias("g"), "id", F.lit(1).alias("a"), F.lit(None).cast("int").alias("b"))
    new = old.withColumns({"a": F.when(F.col("id") == 5, 2).otherwise(F.col("a")), "b": F.when(F.col("id") == 8, 1).otherwise(F.col("b"))}).where("id <> 10")
    tree = audits.digest_differences(old, new, "g", ["id"], ["a", "b"], 256)
    assert {r.g: (r.old_rows, r.new_rows, len(r.open)) for r in tree.collect()} == {
        "0": (5000, 5000, 1), "1": (5000, 5000, 1), "2": (5000, 4999, 1), "3": (5000, 5000, 0)}
    left = audits.rows_of_open_buckets(old, tree, "g", ["id"], 256)
    assert left.count() < 200 and {5, 8, 10} <= {r.id for r in left.collect()}
    plan = audits.column_differences(left, audits.rows_of_open_buckets(new, tree, "g", ["id"], 256), ["g", "id"], {"a": None, "b": None})
    assert sorted((r.id, r.finding) for r in plan.collect()) == [(5, "a"), (8, "b"), (10, "missing")]
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("BroadcastHashJoin") >= 2 and text.index("SortMergeJoin") < text.index("BroadcastHashJoin")  # left out below the shuffle


def test_swapped_nulls_do_not_look_equal(spark):
    rows = lambda *pair: spark.createDataFrame([("g", 1, *pair)], "g string, k int, a int, b int")
    tree = audits.digest_differences(rows(1, None), rows(None, 1), "g", ["k"], ["a", "b"], 8)
    assert not tree.first().hash_match


def test_a_hot_key_of_an_asof_join_is_split_over_tasks(spark):
    n = 1_000_000
    left = spark.range(n).select(F.lit("hot").alias("k"), "id", F.timestamp_seconds(F.col("id") * 10).alias("at"))
    right = spark.range(300).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 30_000 + 500_000).alias("since"), F.col("id").alias("r"))
    made = joins.asof_join_split(left, right, ["k"], "at", "since", ["r"], per_range=100_000)
    parts = made.select("id", "r", F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(parts) > 1 and max(r["count"] for r in parts) < n  # one window over the key would leave it in one
    expected = F.when(F.col("id") * 10 >= 500_000, F.least(F.lit(299), F.floor((F.col("id") * 10 - 500_000) / 30_000)))
    assert made.where(~F.col("r").eqNullSafe(expected)).isEmpty() and made.count() == n


@pytest.mark.parametrize("strict", [False, True])
def test_split_asof_equals_the_plain_one(spark, strict):
    day = lambda i: datetime.date(2024, 1, 1) + datetime.timedelta(days=i) if i is not None else None
    left = [(k, i, day(d)) for k in ("a", "b", None) for i, d in enumerate([0, 0, 3, 7, 7, 40, 200, None])]
    right = [(k, day(d), r) for k in ("a", None) for d, r in [(0, 1), (0, 2), (3, None), (7, 4), (39, 5), (None, 6)]] + [("c", day(1), 9)]
    lf, rt = spark.createDataFrame(left, "k string, i int, at date"), spark.createDataFrame(right, "k string, since date, r int")
    plain = joins.asof_join(lf, rt, ["k"], "at", "since", ["r"], strict)
    split = joins.asof_join_split(lf, rt, ["k"], "at", "since", ["r"], strict, per_range=2)
    assert split.columns == plain.columns
    assert sorted(map(repr, split.collect())) == sorted(map(repr, plain.collect()))
