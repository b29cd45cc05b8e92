"""Scans of raw records and the plans of incremental pulls."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import parse_day
from ..functions.text import money


def json_records(spark: SparkSession, path: str, schema: str, run_id: str, loaded_at: Column | None = None) -> DataFrame:
    """Raw JSON lines as typed columns, with the record itself and its provenance."""
    raw = spark.read.text(path).withColumnRenamed("value", "data")
    return raw.select(F.from_json("data", schema).alias("r"), "data").select("r.*", "data", F.lit(run_id).alias("run_id"),
        (loaded_at if loaded_at is not None else F.current_timestamp()).alias("loaded_at"))


def csv_pages(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def overflow(df: DataFrame, json_column: str, known: list[str], to: str = "extra_fields") -> DataFrame:
    """Members of a JSON object that no column takes, as a map."""
    fields = F.from_json(json_column, "map<string,string>")
    return df.withColumn(to, F.map_filter(fields, lambda k, v: ~k.isin(*known)))


def newest_per_key(parts: list[DataFrame], keys: list[str], order: list[Column]) -> DataFrame:
    """Union of several pulls of which one key may come in more than one."""
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return both.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")


def plan_visits(fetched: DataFrame, stored: DataFrame, keys: list[str], updated: str) -> DataFrame:
    """Keys to visit: new ones, ones without a time on either side, and ones updated since."""
    then = stored.select(*keys, F.col(updated).alias("_then"))
    return fetched.join(then, keys, "left").where(F.col("_then").isNull() | F.col(updated).isNull() | (F.col(updated) > F.col("_then"))).drop("_then")


def missing_keys(fetched: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    return stored.select(*keys).join(fetched.select(*keys).distinct(), keys, "left_anti")


def not_yet_received(messages: DataFrame, received: DataFrame, at: str) -> DataFrame:
    return messages.join(received.select(at).distinct(), at, "left_anti")


def watermark(df: DataFrame, updated: str, overlap_seconds: int = 60):
    """Time from which the next pull starts again: the newest update less an overlap; null for an empty table."""
    return df.agg((F.max(updated) - F.make_dt_interval(secs=F.lit(overlap_seconds))).alias("since")).first()["since"]


def month_ranges(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Days from ``first`` to ``last`` with the month bucket they are pulled in."""
    days = spark.sql(f"SELECT explode(sequence(DATE '{first}', DATE '{last}')) AS day")
    return days.withColumn("month", F.trunc("day", "month"))


def abnormal_counts(before: DataFrame, after: DataFrame, key: str, drop_percent: int) -> DataFrame:
    """Keys whose row count fell by more than ``drop_percent``: (key, before, after)."""
    old, new = (d.groupBy(key).agg(F.count("*").alias(n)) for d, n in ((before, "before"), (after, "after")))
    both = old.join(new, key, "left").withColumn("after", F.coalesce("after", F.lit(0)))
    return both.where(F.col("after") * 100 < F.col("before") * (100 - drop_percent))


def aging_sheet(grid: DataFrame, sheet: str = "sheet", row: str = "row", cells: str = "cells",
    aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """Receivables by age from the grid of a sheet (one row of text cells each): typed rows with their bucket.

    The header is the first row that holds a date, a customer and an amount column, under any of their names;
    it tells where the columns are.  A row with only a first cell names the bucket of the rows below, ``Total`` rows
    do not count, and a data row has an empty first cell and a date.  A sheet without a header gives no rows;
    ``require_header`` refuses it.
    """
    names = aliases or {
        "date": ["date"], "transaction_type": ["transaction type", "type"], "num": ["num", "no.", "number"], "customer": ["customer", "name"],
        "due_date": ["due date"], "amount": ["amount"], "open_balance": ["open balance", "balance"], "po_number": ["po number", "p.o. number"],
    }
    lowered = F.transform(cells, lambda c: F.lower(F.trim(F.coalesce(c, F.lit("")))))
    place = {k: F.array_max(F.transform(F.array(*[F.lit(a) for a in v]), lambda a: F.array_position(F.col("_low"), a))).cast("int") for k,
        v in names.items()}
    marked = grid.withColumn("_low", lowered).withColumn("_at", F.struct(*[p.alias(k) for k, p in place.items()]))
    is_header = (F.col("_at.date") > 0) & (F.col("_at.customer") > 0) & (F.col("_at.amount") > 0)
    order = Window.partitionBy(sheet).orderBy(row).rowsBetween(Window.unboundedPreceding, 0)
    marked = marked.withColumn("_head", F.first(F.when(is_header, F.col("_at")), ignorenulls=True).over(order)).withColumn("_is_head", is_header)
    first = F.trim(F.coalesce(F.try_element_at(cells, F.lit(1)), F.lit("")))
    others = F.exists(F.slice(F.col("_low"), 2, 1000), lambda c: c != "")
    section = F.when((first != "") & ~others & ~F.lower(first).startswith("total"), first)
    marked = marked.withColumn("aging_bucket", F.last(section, ignorenulls=True).over(order))
    cell = lambda k: F.when(F.col(f"_head.{k}") > 0, F.nullif(F.trim(F.try_element_at(F.col(cells), F.col(f"_head.{k}"))), F.lit("")))
    rows = marked.where(F.col("_head").isNotNull() & ~F.col("_is_head") & (first == "") & cell("date").isNotNull())
    typed = {"date": parse_day(cell("date")), "due_date": parse_day(cell("due_date")), "amount": money(cell("amount")),
        "open_balance": money(cell("open_balance"))}
    return rows.select(sheet, "aging_bucket", *[typed.get(k, cell(k)).alias(k) for k in names])


def write_partitioned(df: DataFrame, path: str, by: list[str], kind: str = "parquet") -> None:
    """One folder a partition value; only partitions that ``df`` brings are replaced."""
    df.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("header",
        True).partitionBy(*by).format(kind).save(path)


def count_snapshot(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts by table, for a report before and after a run."""
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n") for name, df in tables.items()])


class SheetError(ValueError):
    """A sheet that lacks what its rows cannot be read without."""


def require_header(grid: DataFrame, columns: list[str], sheet: str = "sheet", cells: str = "cells") -> DataFrame:
    """``grid`` if every sheet has a row that names all of ``columns``; else ``SheetError`` with the sheets that do not."""
    lowered = F.transform(cells, lambda c: F.lower(F.trim(F.coalesce(c, F.lit("")))))
    named = reduce(lambda a, b: a & b, [F.array_contains(lowered, c) for c in columns])
    bad = [r[0] for r in grid.groupBy(sheet).agg(F.bool_or(named).alias("ok")).where("NOT ok").orderBy(sheet).limit(20).select(sheet).collect()]
    if bad:
        raise SheetError(f"no header with {', '.join(columns)} in: {', '.join(map(str, bad))}")
    return grid


# The months' names, as headings and sheets spell them, whole or by their first three letters.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]


def _months_in(c: Column) -> Column:
    """The words of a text as numbers of months, in order; 0 for a word that is none."""
    whole, short = F.array(*[F.lit(m) for m in MONTHS]), F.array(*[F.lit(m[:3]) for m in MONTHS])
    place = lambda w: F.greatest(F.array_position(whole, w), F.array_position(short, w)).cast("int")
    return F.transform(F.regexp_extract_all(F.lower(c), F.lit("[a-z]+"), F.lit(0)), place)


def _numbers_in(c: Column) -> Column:
    return F.transform(F.regexp_extract_all(c, F.lit("[0-9]+"), F.lit(0)), lambda n: n.try_cast("int"))


def _day_of(year: Column, month: Column, day: Column) -> Column:
    """That day; null where there is none."""
    padded = [F.lpad(part.cast("string"), width, "0") for part, width in ((year, 4), (month, 2), (day, 2))]
    return F.when(year.isNotNull() & month.isNotNull() & day.isNotNull(), F.concat_ws("-", *padded).try_cast("date"))


def header_day(c: Column) -> Column:
    """Day that a sheet's heading names: a single day, the last of a range (in one month or over several), or a month's last.

    The heading is read as its words, all of which must be months, and its numbers: the last is the year, those before are days.
    Without words three numbers around slashes are month, day and year.  Anything else names no day.
    """
    months, numbers = _months_in(c), _numbers_in(c)
    year, days = F.try_element_at(numbers, F.lit(-1)), F.filter(numbers, lambda n: n < 1000)
    month, day = F.try_element_at(months, F.lit(-1)), F.try_element_at(days, F.lit(-1))
    known = (F.size(months) > 0) & (F.array_min(months) > 0) & (year >= 1000)
    last = F.last_day(_day_of(year, month, F.lit(1)))
    slashed = (F.size(months) == 0) & (F.size(numbers) == 3) & F.trim(c).rlike("^[0-9/]+$") & (year >= 1000)
    return F.when(known, F.when(F.size(days) > 0, _day_of(year, month, day)).when(F.size(months) == 1, last)).when(
        slashed, _day_of(year, F.try_element_at(numbers, F.lit(1)), F.try_element_at(numbers, F.lit(2))))


def sales_sheet(grid: DataFrame, sheet: str = "sheet", row: str = "row", cells: str = "cells") -> DataFrame:
    """Sales by product from the grid of a sheet, with the day its heading names (``as_of``).

    Rows 0 to 4 are the heading, row 4 names the columns.  Below, ``Total`` rows, the footer's time stamp and rows that name a group
    (a first cell and no second) do not count; a data row has an empty first cell and a second one.
    """
    # The headings of a sales sheet.
    names = {"date": "date", "customer": "customer", "num": "num", "qty": "qty", "amount": "amount", "po_number": "p.o. number"}
    whole = Window.partitionBy(sheet)
    lowered = F.transform(cells, lambda c: F.lower(F.trim(F.coalesce(c, F.lit("")))))
    place = F.struct(*[F.array_position(lowered, v).cast("int").alias(k) for k, v in names.items()])
    days = F.array_compact(F.transform(F.slice(cells, 1, 3), header_day))
    heading = F.when(F.col(row) < 5, F.try_element_at(days, F.lit(1)))
    as_of = F.min_by(heading, F.when(heading.isNotNull(), F.col(row))).over(whole)
    marked = grid.withColumns({"as_of": as_of, "_head": F.max(F.when(F.col(row) == 4, place)).over(whole)})
    filled = lambda i: F.nullif(F.trim(F.try_element_at(F.col(cells), F.lit(i))), F.lit(""))
    cell = lambda k: F.when(F.col(f"_head.{k}") > 0, F.nullif(F.trim(F.try_element_at(F.col(cells), F.col(f"_head.{k}"))), F.lit("")))
    rows = marked.where((F.col(row) >= 5) & filled(1).isNull() & filled(2).isNotNull())
    typed = {"date": parse_day(cell("date")), "qty": cell("qty").try_cast("double").cast("int"), "amount": money(cell("amount"))}
    return rows.select(sheet, "as_of", *[typed.get(k, cell(k)).alias(k) for k in names])


def sheet_day(c: Column, year: Column) -> Column:
    """``Mar-9``, ``Jan 16``, ``3/9`` or ``3/9/2026``; a year in the text wins over ``year``.  Anything else is null.

    Read as one month's name and one or two numbers, or as two or three numbers around slashes; a year of two digits is of this century.
    """
    words, numbers = F.regexp_extract_all(F.lower(c), F.lit("[a-z]+"), F.lit(0)), _numbers_in(c)
    named = F.try_element_at(_months_in(F.substring(F.try_element_at(words, F.lit(1)), 1, 3)), F.lit(1))
    spelt = (F.size(words) == 1) & (named > 0) & F.trim(c).rlike("^[A-Za-z].*[0-9]$") & ~F.contains(c, F.lit("/"))
    slashed = (F.size(words) == 0) & F.trim(c).rlike("^[0-9/]+$") & F.contains(c, F.lit("/"))
    at = lambda i: F.try_element_at(numbers, F.lit(i))
    full = lambda n: F.coalesce(F.when(n < 100, n + 2000).otherwise(n), year)
    return F.when(spelt & F.size(numbers).between(1, 2), _day_of(full(at(2)), named, at(1))).when(
        slashed & F.size(numbers).between(2, 3), _day_of(full(at(3)), at(1), at(2)))


def schedule_sheet(grid: DataFrame, sheet: str = "sheet", row: str = "row", cells: str = "cells", scan: int = 10) -> DataFrame:
    """Schedule changes from a workbook of tabs: (sheet, row, id_number, name, shift, start_date, end_date, kind, row_hash).

    A tab counts if one of its first ``scan`` rows begins with ``ID Number`` and has ``Names``; its cells tell where the columns are.
    A tab whose heading begins with ``Cluster`` repeats the others and does not.  A data row has a whole number as its id, or none and
    a name and a shift of DS or NS.  An end before the start lies in the next year; no end is ``ongoing``, the same day ``one_day``,
    else ``temporary``.  Rows without a start are left out.
    """
    # The headings of a tab of schedule changes.
    names = {"id_number": "ID Number", "name": "Names", "shift": "Shift", "year": "Year", "start": "Start", "end": "End"}
    first = F.trim(F.coalesce(F.try_element_at(F.col(cells), F.lit(1)), F.lit("")))
    trimmed = F.transform(cells, lambda c: F.trim(F.coalesce(c, F.lit(""))))
    head = (F.col(row) < scan) & (first == "ID Number") & F.array_contains(trimmed, "Names")
    whole, place = Window.partitionBy(sheet), F.struct(F.col(row).alias("at"),
        *[F.array_position(trimmed, v).cast("int").alias(k) for k, v in names.items()])
    marked = grid.withColumns({"_c": trimmed, "_head": F.min(F.when(head, place)).over(whole),
        "_other": F.min(F.when((F.col(row) < scan) & (first == "Cluster"), F.col(row))).over(whole)})
    below = marked.where((F.col(row) > F.col("_head.at")) & (F.col("_other").isNull() | (F.col("_other") > F.col("_head.at"))))
    cell = lambda k: F.coalesce(F.when(F.col(f"_head.{k}") > 0, F.try_element_at(F.col("_c"), F.col(f"_head.{k}"))), F.lit(""))
    is_data = cell("id_number").rlike(r"^\d+$") | ((cell("id_number") == "") & (cell("name") != "") & cell("shift").isin("DS", "NS"))
    start = sheet_day(cell("start"), F.when(cell("year").rlike(r"^\d+$"), cell("year")).try_cast("int"))
    rows = below.where(is_data).withColumn("start_date", start).where("start_date IS NOT NULL").withColumn("_end",
        sheet_day(cell("end"), F.year("start_date")))
    crossed = F.when(F.col("_end") < F.col("start_date"),
        F.make_date(F.year("start_date") + 1, F.month("_end"), F.dayofmonth("_end"))).otherwise(F.col("_end"))
    rows = rows.withColumn("end_date", crossed)
    kind = F.when(F.col("end_date").isNull(), "ongoing").when(F.col("end_date") == F.col("start_date"), "one_day").otherwise("temporary")
    blank = lambda c: F.nullif(F.nullif(c, F.lit("")), F.lit("-"))
    return rows.select(
        sheet, row, cell("id_number").alias("id_number"), cell("name").alias("name"), blank(cell("shift")).alias("shift"), "start_date", "end_date",
        kind.alias("kind"), F.sha2(F.array_join("_c", "\x1f"), 256).alias("row_hash"),
    )


def fetch_timers(status: Column, requirements: Column, day: Column, today: Column, lookback: int = 2) -> Column:
    """Whether a task's timers are pulled: decided ones and those with requirements always, a pending one only while its day is fresh."""
    fresh = (status == "pending") & F.coalesce(day.between(F.date_sub(today, lookback), today), F.lit(False))
    return ~status.isin("pending", "cancelled") | (F.coalesce(requirements, F.lit(0)) > 0) | fresh


def pull_window(today: str, days: int, since: str | None = None) -> tuple[str, str]:
    """First and last day of a pull: from ``since`` or ``days`` back to tomorrow, as a night shift's day may run ahead."""
    from datetime import date, timedelta

    now = date.fromisoformat(today)
    first, last = date.fromisoformat(since) if since else now - timedelta(days=days - 1), now + timedelta(days=1)
    if first > last:
        raise ValueError(f"window begins on {first}, after its end {last}")
    return first.isoformat(), last.isoformat()


def forward_cap(today: Column) -> Column:
    """Twelve months ahead, on the 28th at the latest: no event beyond is pulled."""
    return F.make_date(F.year(today) + 1, F.month(today), F.least(F.dayofmonth(today), F.lit(28)))


def pull_ranges(spark: SparkSession, now: str, zone: str, through_today: bool) -> DataFrame:
    """Days to pull on a clock: from the month's first day of the day before to yesterday, or to today; with their month bucket."""
    today = F.to_date(F.from_utc_timestamp(F.lit(now).cast("timestamp"), zone))
    last = today if through_today else F.date_sub(today, 1)
    days = spark.range(1).select(F.explode(F.sequence(F.trunc(last, "month"), last)).alias("day"))
    return days.withColumn("month", F.trunc("day", "month"))


def exploded_records(df: DataFrame, json_column: str, schema: str, keys: list[str]) -> DataFrame:
    """Records of a JSON array as rows with their place (from 1); an array that was encoded twice is decoded twice."""
    twice = F.when(F.trim(F.col(json_column)).startswith('"'),
        F.get_json_object(F.concat(F.lit('{"a":'), F.col(json_column), F.lit("}")), "$.a")).otherwise(F.col(json_column))
    found = df.withColumn("_r", F.from_json(twice, f"array<struct<{schema}>>"))
    return found.select(*keys, F.posexplode("_r").alias("_p", "_v")).select(*keys, (F.col("_p") + 1).alias("ordinality"), "_v.*")


def run_log(runs: DataFrame, at: str = "started") -> DataFrame:
    """Latest run of each pipeline with its counts, and whether what depends on it may go on."""
    top = F.max_by(F.struct("status", "rows", at), F.col(at)).alias("t")
    return runs.groupBy("pipeline").agg(top, F.count("*").alias("runs")).select("pipeline", "t.*", "runs",
        (F.col("t.status") == "success").alias("may_go_on"))
