"""Edge cases of the operators that the driver tables do not hold."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyfield.functions import dates, text
from tallyfield.operators import aggregates, intervals, joins, merge, sequences
from tallyfield.sources import scans
from tallyfield.streaming import loads


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def one(spark, column, **values):
    fields = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], fields).select(column.alias("x")).first()["x"]


def test_union_merges_touching_and_drops_open_and_empty(spark):
    df = spark.createDataFrame([("a", 0, 10), ("a", 10, 20), ("a", 25, 30), ("a", 26, 27), ("a", 40, None), ("a", 50, 50), ("a", 60, 55)], "k string, s int, e int")
    assert rows(intervals.union_intervals(df, ["k"], "s", "e").select("block_start", "block_end", "entries")) == [(0, 20, 2), (25, 30, 2)]


def test_strict_clusters_keep_touching_apart_but_equal_starts_together(spark):
    df = spark.createDataFrame([("a", 0, 10), ("a", 10, 20), ("a", 30, 30), ("a", 30, 40)], "k string, s int, e int")
    assert rows(intervals.overlap_clusters(df, ["k"], "s", "e").select("s", "e", "cluster_size")) == [(0, 10, 1), (10, 20, 1), (30, 30, 2), (30, 40, 2)]


def test_gaps_start_at_anchor_and_stop_at_cap(spark):
    df = spark.createDataFrame([("a", 0, 50, 0), ("a", 1, 130, 200), ("a", 2, 400, 500)], "k string, block int, block_start int, block_end int")
    df = df.withColumn("block_end", F.when(F.col("block") == 0, 90).otherwise(F.col("block_end"))).withColumns({"anchor": F.lit(100), "cap": F.lit(250)})
    assert rows(intervals.gaps(df, ["k"], "anchor", "cap", 21)) == [("a", 2, 80, 50)]


def test_null_safe_anti_chain(spark):
    t = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "a int, b string")
    removed = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    kept = spark.createDataFrame([(2, "x")], "a int, b string")
    assert rows(joins.null_safe_anti(t, removed, ["a", "b"])) == [(3, "y")]
    assert rows(joins.anti_unless(t, removed, kept, ["a", "b"])) == [(2, "x"), (3, "y")]
    assert joins.null_safe_semi(t, removed, ["a", "b"]).count() == 2


def test_asof_takes_latest_at_or_before(spark):
    left = spark.createDataFrame([("a", 5), ("a", 1), ("b", 9), ("a", None)], "k string, t int")
    right = spark.createDataFrame([("a", 2, "old"), ("a", 5, "new"), ("a", 5, "zz")], "k string, since int, v string")
    found = {(r.k, r.t): r.v for r in joins.asof_join(left, right, ["k"], "t", "since", ["v"]).collect()}
    assert found == {("a", 5): "zz", ("a", 1): None, ("b", 9): None, ("a", None): None}
    strict = {(r.k, r.t): r.v for r in joins.asof_join(left, right, ["k"], "t", "since", ["v"], strict=True).collect()}
    assert strict[("a", 5)] == "old"


def test_merge_writes_only_changes(spark):
    target = spark.createDataFrame([(1, "a", "r0"), (2, "b", "r0"), (3, "c", "r0")], "k int, v string, run string")
    source = spark.createDataFrame([(1, "a", "r1"), (2, "B", "r1"), (4, None, "r1")], "k int, v string, run string")
    assert rows(merge.snapshot_actions(target, source, ["k"], ignore=("run",))) == [(1, "keep"), (2, "update"), (3, "delete"), (4, "insert")]
    merged = {r.k: (r.v, r.run) for r in merge.merge_snapshot(target, source, ["k"], ignore=("run",)).collect()}
    assert merged == {1: ("a", "r0"), 2: ("B", "r1"), 4: (None, "r1")}
    assert merge.merge_snapshot(target, source, ["k"], delete=False).count() == 4
    assert rows(merge.changes(target, source, ["k"], ["v"])) == [(2, "v", "b", "B")]


def test_last_in_batch_wins(spark):
    batch = spark.createDataFrame([(1, "x", 0), (1, "y", 1)], "k int, v string, seq int")
    assert rows(merge.last_in_batch(batch, ["k"], "seq")) == [(1, "y")]


def test_guards():
    merge.guard_shrink(100, 95)
    merge.guard_shrink(1000, 960)
    with pytest.raises(merge.GuardError):
        merge.guard_shrink(100, 80)
    merge.guard_wipe(10, 0)
    with pytest.raises(merge.GuardError):
        merge.guard_wipe(100, 10)


def test_tombstones_and_carry_forward(spark):
    day = lambda d: dt.date(2024, 1, d)
    known = spark.createDataFrame([(1, None), (2, day(1)), (3, day(1))], "k int, missing_since date")
    now = spark.createDataFrame([(3,)], "k int")
    assert {r.k: r.missing_since for r in merge.tombstones(known, now, ["k"], F.lit(day(9))).collect()} == {1: day(9), 2: day(1), 3: None}
    earlier = spark.createDataFrame([("p", "m", 1), ("p", "m", 2), ("p", "n", 1)], "p string, m string, run int")
    current = spark.createDataFrame([("p", "n")], "p string, m string")
    assert rows(merge.carry_forward(earlier, current, ["p", "m"], [F.desc("run")]).select("m", "run")) == [("m", 2)]


def test_allocation_and_conflicts(spark):
    df = spark.createDataFrame([("a", 100, 1), ("a", 100, 2), ("b", 50, 0)], "k string, amount long, w long")
    assert rows(aggregates.allocate(df, ["k"], "amount", "w").select("k", "w", "share")) == [("a", 1, 33), ("a", 2, 67), ("b", 0, 0)]
    who = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), ("b", "y"), ("c", None)], "k string, v string")
    assert {r.k: (r.is_conflict, r.v) for r in aggregates.conflicts(who, "k", "v").collect()} == {"a": (False, "x"), "b": (True, None), "c": (False, None)}


def test_content_hash_ignores_order(spark):
    a = spark.createDataFrame([("g", 1, None), ("g", 2, "x")], "g string, a int, b string")
    same = a.orderBy(F.desc("a"))
    assert rows(aggregates.content_hash(a, ["g"], ["a", "b"])) == rows(aggregates.content_hash(same, ["g"], ["a", "b"]))


def test_optional_filters_and_page_limits(spark):
    df = spark.range(5).withColumn("v", F.when(F.col("id") > 1, F.col("id")))
    assert sequences.filtered(df, equal={"id": None}, least={"v": 3}).count() == 2
    assert [r.id for r in sequences.page(df, [("v", True)], "id", -3, 4).collect()] == [4, 3, 2, 0]
    assert sequences.page(df, [("v", False)], "id", 0, -1).count() == 0


@pytest.mark.parametrize(("raw", "clean"), [("1. X", "X"), ("10B. X", "X"), ("1. 2a. X", "X"), ("X 2", "X 2"), (" X", " X"), (" X\t", "X"), (None, None)])
def test_clean_task_name(spark, raw, clean):
    assert one(spark, text.clean_task_name(F.col("c")), c=raw) == clean


@pytest.mark.parametrize(("raw", "number"), [("a/12345678/9", "12345678"), ("1234567", "1234567"), ("12", None), ("", None), (None, None), ("765432 123456", "123456"), ("1234567890", None)])
def test_longest_number(spark, raw, number):
    assert one(spark, text.longest_number(F.col("c")), c=raw) == number


def test_text_helpers(spark):
    assert one(spark, text.project_number(F.col("c")), c="x TS0042 y") == 42
    assert one(spark, text.project_number(F.col("c")), c="none") is None
    assert one(spark, text.name_norm(F.col("c")), c="  a \t b ") == "A B"
    assert one(spark, text.quote_norm(F.col("c")), c="a/b_c-d") == "A B C D"
    assert one(spark, text.email_canon(F.col("c")), c="B@x.io; a@x.io,,b@X.io") == "a@x.io,b@x.io"
    assert str(one(spark, text.money(F.col("c")), c="$1,234.50")) == "1234.50"
    assert one(spark, text.money(F.col("c")), c="none") is None
    assert one(spark, text.signature(F.col("c"), "^(?i)net"), c="gc/Netco/north/scope/1") == "Netco/north/scope"
    assert one(spark, text.signature(F.col("c"), "^zzz"), c="gc/a") is None
    assert one(spark, text.display_name(F.col("c"), F.lit("e7")), c="Ann Bee_e7") == "Ann Bee"
    assert one(spark, text.first_rule(F.col("c"), [("^a", "first"), ("b", "second")], "else"), c="ABB") == "first"


@pytest.mark.parametrize(("raw", "minutes"), [("9 PM", 1260), ("9PM", 1260), ("9:00 PM", 1260), ("12:30 am", 30), ("12 pm", 720), ("13 PM", None), ("", None)])
def test_shift_clock(spark, raw, minutes):
    assert one(spark, dates.shift_minutes(F.col("c")), c=raw) == minutes


@pytest.mark.parametrize(("day", "deadline"), [("2024-02-15", "2024-02-19"), ("2024-02-16", "2024-03-04"), ("2024-05-31", "2024-06-04"), ("2024-08-31", "2024-09-03"), ("2024-06-30", "2024-07-02")])
def test_approval_deadline(spark, day, deadline):
    assert str(one(spark, dates.approval_deadline(F.to_date("c")), c=day)) == deadline


def test_dates(spark):
    assert str(one(spark, dates.parse_day(F.col("c")), c="3/7/2024")) == str(one(spark, dates.parse_day(F.col("c")), c="3/7/24")) == "2024-03-07"
    assert str(one(spark, dates.parse_day(F.col("c")), c="45358")) == "2024-03-07"
    assert str(one(spark, dates.epoch_or_iso(F.col("c")), c="1709769600000")) == str(one(spark, dates.epoch_or_iso(F.col("c")), c="1709769600"))
    assert one(spark, dates.lateness(F.lit(300), F.lit(86100)), c="") == 10
    assert one(spark, dates.workdays(F.to_date(F.lit("2024-03-08")), F.to_date(F.lit("2024-03-12")), ["2024-03-11"]), c="") == 1
    assert one(spark, dates.filing_deadline(F.to_date("c")), c="2024-03-08") == 61


def test_aging_sheet(spark):
    grid = [("s", 0, ["", "Customer", "Date", "Amount"]), ("s", 1, ["31-60 days"]), ("s", 2, ["", "Acme", "3/7/2024", "$10.50"]), ("s", 3, ["Total", None, None, "10.50"]),
            ("t", 0, ["no header"]), ("s", 4, ["", "Beta", None, "1"])]
    df = scans.aging_sheet(spark.createDataFrame(grid, "sheet string, row int, cells array<string>"))
    assert [(r.aging_bucket, r.customer, str(r.date), str(r.amount), r.po_number) for r in df.collect()] == [("31-60 days", "Acme", "2024-03-07", "10.50", None)]


def test_incremental_plan(spark):
    fetched = spark.createDataFrame([(1, 5), (2, 5), (3, None), (4, 9)], "k int, u int")
    stored = spark.createDataFrame([(1, 5), (2, 4), (3, 1), (5, 1)], "k int, u int")
    assert sorted(r.k for r in scans.plan_visits(fetched, stored, ["k"], "u").collect()) == [2, 3, 4]
    assert rows(scans.missing_keys(fetched, stored, ["k"])) == [(5,)]


def test_sources_round_trip(spark, tmp_path):
    (tmp_path / "raw.json").write_text('{"id": 1, "name": "a", "x": "y"}\nbroken\n')
    raw = scans.json_records(spark, str(tmp_path / "raw.json"), "id long, name string", "run1")
    assert [r.id for r in raw.orderBy("id").collect()] == [None, 1]
    assert scans.overflow(raw, "data", ["id", "name"]).where("id = 1").first().extra_fields == {"x": "y"}
    out = str(tmp_path / "parts")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    scans.write_partitioned(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), out, ["p"])
    scans.write_partitioned(spark.createDataFrame([(3, "b")], "v int, p string"), out, ["p"])
    assert rows(spark.read.parquet(out).select("v", "p")) == [(1, "a"), (3, "b")]
    assert rows(scans.abnormal_counts(spark.range(10).withColumn("k", F.lit(1)), spark.range(8).withColumn("k", F.lit(1)), "k", 10)) == [(1, 10, 8)]
    assert scans.month_ranges(spark, "2024-01-30", "2024-02-02").select("month").distinct().count() == 2


def test_stream_alerts(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([("j", i, i < 3) for i in range(4)], "job string, seq int, bad boolean").coalesce(1).write.parquet(source)
    stream = spark.readStream.schema("job string, seq int, bad boolean").parquet(source)
    out = loads.write_available(loads.alerts(stream, "job", "bad", 2), str(tmp_path / "s"))
    assert sorted(r.state for r in spark.read.parquet(out).collect()) == ["alert", "none", "recover", "remind"]


def test_merge_batch_keeps_first_times_and_takes_the_last_of_a_batch(spark):
    target = spark.createDataFrame([(1, "a", "r0", 1), (2, None, "r0", 1)], "k int, v string, run string, made int")
    batch = spark.createDataFrame([(1, "x", "r1", 2, 1), (1, "a", "r1", 2, 2), (2, "b", "r1", 2, 1), (3, None, "r1", 2, 1)], "k int, v string, run string, made int, seq int")
    merged = merge.merge_batch(target, batch, ["k"], "seq", ignore=("run",), insert_only=("made",))
    assert rows(merged) == [(1, "a", "r0", 1), (2, "b", "r1", 1), (3, None, "r1", 2)]


def test_capped_delete_and_window_refresh(spark):
    target = spark.range(100).select(F.col("id").alias("k"), (F.col("id") < 50).alias("w"))
    inside = F.col("w")
    few, went = merge.merge_capped(target, target.where("w AND k >= 10"), ["k"], inside)
    assert went and few.count() == 90
    many, went = merge.merge_capped(target, target.where("w AND k >= 11"), ["k"], inside)
    assert not went and many.count() == 100
    owned = target.withColumn("owner", F.lit("x"))
    assert merge.refresh_window(owned, owned.where("w AND k > 1"), ["k"], inside, "owner").count() == 98
    with pytest.raises(merge.GuardError):
        merge.refresh_window(owned, owned.where("w").withColumn("owner", F.when(F.col("k") > 20, "x")), ["k"], inside, "owner")
    with pytest.raises(merge.GuardError):
        merge.refresh_window(owned, owned.where("w AND k > 20"), ["k"], inside, "owner")


def test_not_blank_and_part_loads(spark):
    old, none = spark.range(3), spark.range(0)
    assert merge.not_blank(old, none).count() == 3 and merge.not_blank(none, old).count() == 3
    table = spark.createDataFrame([("a", i) for i in range(10)] + [("b", i) for i in range(10)], "p string, v int")
    batch = spark.createDataFrame([("a", 0), *[("b", -i) for i in range(9)], ("c", 1)], "p string, v int")
    assert {(r.p, r["count"]) for r in merge.replace_if_enough(table, batch, "p").groupBy("p").count().collect()} == {("a", 10), ("b", 9), ("c", 1)}


def test_bands_by_cells_equal_bands_by_broadcast(spark):
    df = spark.range(0, 5000, 7).select((F.col("id") / 10 - 20).alias("v"))
    bands = spark.createDataFrame([(i, i * 1.5 - 30, i * 1.5 - 26) for i in range(60)] + [(99, -5.0, 1e9), (98, None, 3.0)], "b int, lo double, hi double")
    assert rows(joins.band_join(df, "v", bands, "lo", "hi")) == rows(joins.band_join(df, "v", bands, "lo", "hi", most=5))


def test_key_containment_prefers_equal_paths_then_order_then_length(spark):
    df = spark.createDataFrame([(1, "A B"), (2, "X A B Y"), (3, "AB"), (4, None)], "i int, path string")
    keys = spark.createDataFrame([("A", 1), ("A B", 2), ("B", 1), ("X A B Y Z Q R S T", 0)], "key string, w int")
    assert rows(joins.key_containment(df, "i", "path", keys, "key", ["w"]).select("i", "key")) == [(1, "A B"), (2, "A"), (3, None), (4, None)]


def test_sheets_without_header_are_refused(spark):
    grid = spark.createDataFrame([("s", 0, ["", "Customer", "Date", "Amount"]), ("t", 0, ["x", None])], "sheet string, row int, cells array<string>")
    assert scans.require_header(grid.where("sheet = 's'"), ["customer", "date"]).count() == 1
    with pytest.raises(scans.SheetError):
        scans.require_header(grid, ["customer", "date"])
    with pytest.raises(ValueError):
        scans.pull_window("2024-03-01", 7, since="2024-05-01")


def test_content_hash_in_parts(spark):
    df = spark.range(2000).select((F.col("id") % 2).alias("g"), F.col("id").alias("v"))
    one = {r.g: (r.n, r.content_hash) for r in aggregates.content_hash(df, ["g"], ["v"]).collect()}
    two = {r.g: (r.n, r.content_hash) for r in aggregates.content_hash(df.repartition(7).orderBy(F.desc("v")), ["g"], ["v"]).collect()}
    assert one == two and one[0][0] == 1000 and one[0] != one[1]


def test_csv_pages_and_watermark(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n2,y\n")
    (tmp_path / "b.csv").write_text("id,name\n3,z\n")
    assert rows(scans.csv_pages(spark, str(tmp_path), "id int, name string")) == [(1, "x"), (2, "y"), (3, "z")]
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 2),), (None,)], "u timestamp")
    assert scans.watermark(df, "u") == dt.datetime(2024, 1, 1, 0, 1) and scans.watermark(df.limit(0), "u") is None
    assert rows(scans.not_yet_received(spark.range(4), spark.range(2), "id")) == [(2,), (3,)]


def test_upserts_rewrite_only_touched_buckets(spark, tmp_path):
    source, folder = tmp_path / "in", str(tmp_path / "s")
    spark.createDataFrame([(i, 1, "a") for i in range(50)], "k int, at int, v string").coalesce(1).write.parquet(str(source))
    read = lambda: spark.readStream.schema("k int, at int, v string").parquet(str(source))
    loads.upsert(read(), ["k"], ["at"], ["at", "v"], folder, buckets=16)
    spark.createDataFrame([(3, 2, "b"), (3, 0, "old"), (77, 1, "new")], "k int, at int, v string").coalesce(1).write.mode("append").parquet(str(source))
    table = loads.upsert(read(), ["k"], ["at"], ["at", "v"], folder, buckets=16)
    got = {r.k: r.v for r in table.collect()}
    assert len(got) == 51 and got[3] == "b" and got[77] == "new" and got[4] == "a"
    assert len(list((tmp_path / "s" / "table" / "version=1").glob("bucket=*"))) <= 2
