"""Queries that run as streams over what is there, compared with their batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import loads, timed
from .reports import query


@query("""SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC,
  event_id DESC) AS r FROM events) WHERE r = 1""")
def stream_upsert(t):
    stream = loads.file_stream(t.spark, t.folder, "events.parquet").select("user_id", "event_type", "ts", "event_id", "value")
    kept = loads.upsert(stream, ["user_id", "event_type"], ["ts", "event_id"], ["ts", "event_id", "value"], loads.shared_folder(t.spark))
    return kept.select("user_id", "event_type", "event_id", "value")


@query("""SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def stream_windows(t):
    stream = loads.file_stream(t.spark, t.folder, "events.parquet").withColumn("at", F.col("ts").cast("timestamp"))
    counted = loads.windowed(stream, "at", "60 days", "1 day", ["event_type"])
    return _complete(t, counted, [F.to_date("window.start").alias("day"), "event_type", "n"])


def _complete(t, counted, columns: list):
    """Run a stream of aggregates over what is there, and read its last complete result."""
    folder = loads.shared_folder(t.spark)

    def write(batch, number):
        batch.select(*columns).write.mode("overwrite").parquet(f"{folder}/out")

    counted.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation",
        f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(f"{folder}/out")


@query("""
WITH x AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w > INTERVAL 3 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS opens
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT user_id, ts, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session FROM x)
SELECT user_id, min(ts) AS began, count(*) AS n FROM s GROUP BY user_id, session""")
def stream_sessions(t):
    stream = loads.file_stream(t.spark, t.folder, "events.parquet").withColumn("at", F.col("ts").cast("timestamp"))
    counted = loads.sessions(stream, "at", "60 days", "3 hours", ["user_id"])
    return _complete(t, counted, ["user_id", F.col("session_window.start").cast("timestamp_ntz").alias("began"), "n"])


@query("""SELECT DISTINCT user_id, event_type FROM events""")
def stream_first_seen(t):
    stream = loads.file_stream(t.spark, t.folder, "events.parquet").withColumn("at", F.col("ts").cast("timestamp"))
    first = loads.deduplicated(stream, "at", "60 days", ["user_id", "event_type"]).select("user_id", "event_type")
    return t.spark.read.parquet(loads.write_available(first, loads.shared_folder(t.spark)))


@query("""
WITH x AS (SELECT user_id, event_id, value > 50 AS bad, count(*) FILTER (WHERE value <= 50) OVER (PARTITION BY user_id ORDER BY event_id) AS run,
  lag(value > 50) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events),
y AS (SELECT *, count(*) FILTER (WHERE bad) OVER (PARTITION BY user_id, run ORDER BY event_id) AS nth FROM x)
SELECT user_id, CASE WHEN NOT bad AND before THEN 'recover' WHEN NOT bad THEN 'none' WHEN nth = 1 THEN 'alert' WHEN (nth - 1) % 2 = 0 THEN 'remind'
  ELSE 'none' END AS state, count(*) AS n FROM y GROUP BY 1, 2""")
def stream_alerts(t):
    stream = loads.file_stream(t.spark, t.folder, "events.parquet").select("user_id", F.col("event_id").alias("seq"),
        (F.col("value") > 50).alias("bad"))
    out = loads.write_available(loads.alerts(stream, "user_id", "bad", 2), loads.shared_folder(t.spark))
    return t.spark.read.parquet(out).groupBy("user_id", "state").agg(F.count("*").alias("n"))


# Every event arrives some hours after its time, as many as six times the number in its properties: up to 25 days late.
ARRIVED = """e AS (SELECT *, CAST(floor((epoch(ts) + 21600 * CAST(props ->> 'k' AS INT) - 1704067200) / 777600) AS INT) AS delivery FROM events),
w AS (SELECT delivery, max(max(date_trunc('milliseconds', ts))) OVER (ORDER BY delivery ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  - INTERVAL 10 DAY AS mark, max(max(date_trunc('milliseconds', ts))) OVER (ORDER BY delivery) - INTERVAL 10 DAY AS after FROM e GROUP BY delivery),
f AS (SELECT max(after) AS final FROM w)"""
DELAY = "10 days"


def _arriving(t, *columns: str):
    """Columns of events with their time, the number of the delivery that brings them (one every nine days), and a folder."""
    lag = F.get_json_object("props", "$.k").cast("int") * 21_600
    number = F.floor((F.unix_timestamp(F.col("ts").cast("timestamp")) + lag - 1_704_067_200) / 777_600)
    events = t.events.select(F.col("ts").cast("timestamp").alias("at"), *columns, number.alias("delivery"))
    return events, loads.shared_folder(t.spark)


@query(f"""
WITH {ARRIVED} SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM e JOIN w USING (delivery), f
WHERE (mark IS NULL OR CAST(ts AS DATE) + INTERVAL 1 DAY > mark) AND CAST(ts AS DATE) + INTERVAL 1 DAY <= final GROUP BY 1, 2""")
def stream_late(t):
    events, folder = _arriving(t, "event_type")

    def build(stream):
        counted = loads.windowed(stream, "at", DELAY, "1 day", ["event_type"])
        return timed.to_folder(counted.select(F.to_date("window.start").alias("day"), "event_type", "n"), folder)

    timed.run_deliveries(events, "delivery", folder, build)
    return t.spark.read.parquet(f"{folder}/out")


@query(f"""
WITH {ARRIVED}, x AS (SELECT user_id, CAST(ts AS DATE) AS day, ts AS s, ts + to_minutes(CAST(floor(value) AS BIGINT)) AS e
  FROM e JOIN w USING (delivery) WHERE floor(value) > 0 AND (mark IS NULL OR ts > mark)),
y AS (SELECT *, max(e) OVER (PARTITION BY user_id, day ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM x),
z AS (SELECT *, sum(CASE WHEN s > m THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, day ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING
  AND CURRENT ROW) AS block FROM y),
b AS (SELECT user_id, day, min(s) AS block_start, max(e) AS block_end, count(*) AS entries FROM z GROUP BY user_id, day, block)
SELECT user_id, day, block_start, block_end, entries FROM b, f WHERE block_end <= final""")
def stream_interval_sessions(t):
    events, folder = _arriving(t, "user_id", "event_id", "value")
    groups = timed.groups_for(events.count())
    again = events.withColumn("delivery", F.col("delivery") + 1)  # every pull brings what the one before had, too

    def build(stream):
        length = F.concat(F.floor("value").cast("long").cast("string"), F.lit(" minutes"))
        merged = timed.interval_sessions(stream.withColumn("day", F.to_date("at")), "event_id", "at", length, DELAY, ["user_id", "day"], groups)
        return timed.to_folder(merged, folder)

    timed.run_deliveries(events.union(again), "delivery", folder, build)
    out = t.spark.read.parquet(f"{folder}/out")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("block_start", "block_end")})


@query(f"""
WITH {ARRIVED}, x AS (SELECT user_id, event_id, ts FROM e JOIN w USING (delivery), f WHERE (mark IS NULL OR ts > mark) AND ts <= final),
y AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next FROM x),
z AS (SELECT y.*, (SELECT min(after) FROM w WHERE after >= y.ts) AS seen, ts + INTERVAL 12 HOUR AS due, final FROM y, f)
SELECT user_id, event_id, CASE WHEN next <= due THEN 'closed' WHEN due <= final THEN 'expired' ELSE 'open' END AS state,
  epoch_us(CASE WHEN next <= due THEN next WHEN due <= final THEN due ELSE final END) - epoch_us(ts) AS counted_us,
  due > seen AND (next IS NULL OR next > seen) AS was_open FROM z""")
def stream_open_intervals(t):
    events, folder = _arriving(t, "user_id", "event_id")
    groups = timed.groups_for(events.count())
    with timed.timers_on(t.spark):
        reports = timed.run_deliveries(events, "delivery", folder,
            lambda stream: timed.to_folder(timed.open_intervals(stream, "user_id", "event_id", "at", DELAY, 12 * 3600, groups), folder))
    as_of = F.unix_micros(F.lit(timed.last_watermark(reports)).cast("timestamp"))
    states = timed.interval_states(t.spark.read.parquet(f"{folder}/out"), as_of)
    return states.select(F.col("key").alias("user_id"), F.col("id").alias("event_id"), "state", "counted_us", "was_open")


@query(f"""
WITH {ARRIVED}, x AS (SELECT user_id, ts, event_id FROM e JOIN w USING (delivery) WHERE mark IS NULL OR ts > mark),
y AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 3 HOUR THEN 0 ELSE 1 END AS opens FROM x),
z AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS burst FROM y),
b AS (SELECT user_id, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us, count(*) AS n, max(ts) AS last FROM z GROUP BY user_id, burst)
SELECT user_id, first_us, last_us, n FROM b, f WHERE last + INTERVAL 3 HOUR <= final""")
def stream_debounced(t):
    events, folder = _arriving(t, "user_id")
    groups = timed.groups_for(events.count())
    with timed.timers_on(t.spark):
        timed.run_deliveries(events, "delivery", folder,
            lambda stream: timed.to_folder(timed.debounced(stream, "user_id", "at", DELAY, 3 * 3600, groups), folder))
    return t.spark.read.parquet(f"{folder}/out").withColumnRenamed("key", "user_id")


@query("""
SELECT CAST(ts AS DATE) AS day, user_id, count(*) AS n, max(event_id) AS last_id FROM events GROUP BY 1, 2""")
def stream_repull(t):
    events, folder = _arriving(t, "user_id", "event_id")
    rebuilt = lambda df: df.groupBy("day", "user_id").agg(F.count("*").alias("n"), F.max("event_id").alias("last_id"))
    replace = timed.replace_periods(f"{folder}/landed", F.to_date("at"), rebuilt, "day", folder)
    timed.run_deliveries(events, "delivery", folder, lambda stream: stream.writeStream.foreachBatch(replace))
    return t.spark.read.parquet(f"{folder}/table").select("day", "user_id", "n", "last_id")
