"""Stream queries: events arrive in slices and are consumed in micro-batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.logs import parse_line
from millrace.operators.aggregate import money_sum
from millrace.plans import derived as D
from millrace.plans.registry import query
from millrace.session import fresh_path
from millrace.streaming import events as S
from millrace.streaming import windows as W
from millrace.tables import load

c = F.col


def _thirds():
    """Slices of a month of events, in the order they arrive."""
    day = F.dayofmonth("ts")
    return [day <= 10, day.between(11, 20), day > 20]


TOTALS = "n bigint, total double"


def _totals():
    return [F.count(F.lit(1)).alias("n"), money_sum("value").alias("total")]


@query(
    "stream_running_total",
    """SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1""",
)
def stream_running_total(spark, folder):
    """Running count and total per type, updated by each micro-batch; the last update is shown."""
    emitted = S.collect_arrivals(
        load(spark, folder, "events"),
        _thirds(),
        lambda stream: stream.groupBy("event_type").agg(*_totals()),
        f"event_type string, {TOTALS}",
        "update",
    )
    return S.latest(emitted, ["event_type"])


_CLOSED = "<= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"


def _windows(spark, folder, slide):
    def build(stream):
        timed = S.with_event_time(stream, "ts", "1 hour")
        windows = W.time_windows(timed, "ts", "1 day", slide, [], _totals())
        return windows.select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n", "total")

    return S.collect_arrivals(load(spark, folder, "events"), _thirds(), build, f"start string, {TOTALS}").drop(S.EPOCH)


@query(
    "stream_tumbling",
    f"""SELECT strftime(ts::DATE, '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n, round(sum(value), 2) AS total FROM events
        GROUP BY ts::DATE HAVING ts::DATE + INTERVAL 1 DAY {_CLOSED}""",
)
def stream_tumbling(spark, folder):
    """One total per day, given once the watermark has passed the day; the open day is held back."""
    return _windows(spark, folder, None)


@query(
    "stream_sliding",
    f"""WITH w AS (SELECT time_bucket(INTERVAL 6 HOUR, ts) - k * INTERVAL 6 HOUR AS start, value
                   FROM events, (SELECT unnest([0, 1, 2, 3]) AS k))
        SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n, round(sum(value), 2) AS total FROM w
        GROUP BY w.start HAVING w.start + INTERVAL 1 DAY {_CLOSED}""",
)
def stream_sliding(spark, folder):
    """Windows of a day that start every six hours."""
    return _windows(spark, folder, "6 hours")


@query(
    "stream_count_windows",
    """SELECT user_id, window_no, round(sum(value), 2) AS total FROM (
         SELECT user_id, value, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 5 AS window_no
         FROM events) GROUP BY ALL HAVING count(*) = 5""",
)
def stream_count_windows(spark, folder):
    """Every five events of a user one total, across micro-batches."""
    emitted = S.collect_arrivals(
        load(spark, folder, "events"),
        _thirds(),
        lambda stream: W.count_windows(stream, "user_id", ["ts", "event_id"], "value", 5),
        "user_id bigint, window_no bigint, total double",
    )
    return emitted.select("user_id", "window_no", F.round("total", 2).alias("total"))


@query(
    "stream_moving_avg",
    """SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS 4 PRECEDING), 6) AS average
       FROM events""",
)
def stream_moving_avg(spark, folder):
    """Average of a user's last five events, for each event as it comes."""
    emitted = S.collect_arrivals(
        load(spark, folder, "events").select("event_id", "ts", "user_id", "value"),
        _thirds(),
        lambda stream: W.moving_average(stream, "user_id", ["ts", "event_id"], "event_id", "value", 5),
        "event_id bigint, average double",
    )
    return emitted.select("event_id", F.round("average", 6).alias("average"))


@query(
    "stream_foreach_batch",
    """SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1""",
)
def stream_foreach_batch(spark, folder):
    """Events sent twice, within a slice and again in the next: each is counted once by batch code."""
    day = F.dayofmonth("ts")
    copies = F.when(c("event_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    sent = load(spark, folder, "events").withColumn("copy", F.explode(copies)).drop("copy")
    out = fresh_path(spark, "per-batch")

    def consume(batch, epoch):
        kpi = batch.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
        S.epoch_sink(out)(kpi, epoch)

    def once(stream):
        return S.with_event_time(stream, "ts", "2 days").dropDuplicatesWithinWatermark(["event_id"])

    S.run_arrivals(sent, [day <= 10, day.between(10, 20), day >= 20], once, consume)
    stored = spark.read.schema("event_type string, n bigint, total double, epoch int").parquet(out)
    return stored.groupBy("event_type").agg(F.sum("n").alias("n"), money_sum("total").alias("total"))


@query(
    "stream_late_upsert",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1""",
)
def stream_late_upsert(spark, folder):
    """Late events change the total of their day, however late they come."""
    late = c("event_id") % 17 == 0
    slices = [*[part & ~late for part in _thirds()], late]
    events = load(spark, folder, "events").select("event_id", "ts", "value")

    def summarize(raw):
        return raw.groupBy("day").agg(F.count(F.lit(1)).alias("n"), money_sum("value").alias("total"))

    out = fresh_path(spark, "days")
    consume = W.recompute_days(
        spark, "event_id bigint, value double, day string", fresh_path(spark, "raw"), out, summarize
    )
    def build(stream):
        return stream.select("event_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("day"))

    S.run_arrivals(events, slices, build, consume)
    return spark.read.schema("n bigint, total double, day string").parquet(out)


@query(
    "stream_error_count",
    f"""WITH {D.LOG_LINES} SELECT regexp_extract(line, 'user=([0-9]+)', 1)::BIGINT AS user_id, count(*) AS n FROM lines
        WHERE line LIKE '____-__-__ __:__:__ ERROR %' GROUP BY 1""",
)
def stream_error_count(spark, folder):
    """Lines of a log stream parsed, errors kept and counted per user."""
    path = fresh_path(spark, "log-stream")
    D.log_lines(spark, folder).select(c("line").alias("value")).write.text(path)
    lines = S.stream_files(spark, path, "value string", kind="text", files_per_batch=1000)
    parsed = lines.select(parse_line(c("value")).alias("p")).filter("p.level = 'ERROR'")
    counts = parsed.groupBy(c("p.user_id").alias("user_id")).agg(F.count(F.lit(1)).alias("n"))
    out = fresh_path(spark, "errors")
    S.run_batches(counts, S.epoch_sink(out), fresh_path(spark, "checkpoint"), "update")
    return S.latest(spark.read.schema("user_id bigint, n bigint, epoch int").parquet(out), ["user_id"])


@query(
    "stream_resume",
    """SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS n_distinct FROM events GROUP BY 1""",
)
def stream_resume(spark, folder):
    """Stopped after some slices and started again with the same checkpoint: nothing is read twice."""
    events, out = load(spark, folder, "events").select("event_id", "ts", "event_type"), fresh_path(spark, "resumed")
    S.run_arrivals(events, _thirds(), lambda stream: stream, S.epoch_sink(out))
    stored = spark.read.schema("event_id bigint, event_type string, epoch int").parquet(out)
    return stored.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("n_distinct")
    )
