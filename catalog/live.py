"""Streams: the readings arrive in files, in time order; results are read when all have arrived."""

from __future__ import annotations


from catalog.inputs import readings, rounded, with_readings
from catalog.registry import query
from catalog.reports import HOURLY_SHARE_SQL
from gridtally.operators.report import baseline
from gridtally.schema import READINGS_SCHEMA
from gridtally.session import scratch_path
from gridtally.streaming import live

FILES = 4


def _arriving(spark, sf_dir):
    path = scratch_path(spark, "arriving")
    df = readings(spark, sf_dir).select(*READINGS_SCHEMA.fieldNames())
    df.repartitionByRange(FILES, "ts", "reading_id").write.parquet(path)
    return live.stream_readings(spark, path)


def _published(spark, running, keys):
    path = scratch_path(spark, "published")
    live.publish(running, path, scratch_path(spark, "stream-state"), keys, fold_every=2).awaitTermination()
    return live.current(spark, path, keys)


@query("stream_accumulate", with_readings("SELECT * FROM readings"))
def stream_accumulate(spark, sf_dir):
    path = scratch_path(spark, "accumulated")
    stream = _arriving(spark, sf_dir)
    live.accumulate(stream, path, scratch_path(spark, "stream-state")).awaitTermination()
    return spark.read.parquet(path)


@query(
    "stream_latest_cards",
    with_readings(
        "SELECT meter_id, ts, usage_kwh, cost_krw, abs(carbon_tco2) AS carbon_tco2 FROM readings "
        "QUALIFY row_number() OVER (PARTITION BY meter_id ORDER BY ts DESC, reading_id DESC) = 1"
    ),
)
def stream_latest_cards(spark, sf_dir):
    return _published(spark, live.latest_cards(_arriving(spark, sf_dir)), ["meter_id"])


def _progress_sql():
    spans = {
        "daily": "CAST(ts AS DATE) = CAST(last AS DATE)",
        "weekly": "ts >= date_trunc('week', last)",
        "monthly": "ts >= date_trunc('month', last)",
    }
    goals = {
        "daily": "(SELECT avg(v) FROM (SELECT sum({0}) AS v FROM nov GROUP BY CAST(ts AS DATE)))",
        "weekly": "(SELECT avg(v) FROM (SELECT sum({0}) AS v FROM nov GROUP BY date_trunc('week', ts)))",
        "monthly": "(SELECT sum({0}) FROM nov)",
    }
    parts = [
        f"SELECT '{m}' AS measure, '{p}' AS period, coalesce(sum({c}) FILTER ({spans[p]}), 0) AS total, "
        f"{goals[p].format(c)} AS baseline FROM readings, (SELECT max(ts) AS last FROM readings)"
        for m, c in (("usage", "usage_kwh"), ("cost", "cost_krw"))
        for p in spans
    ]
    return with_readings(
        "SELECT measure, period, round(total, 5) AS total, round(baseline, 5) AS baseline, "
        "round(least(100, total / baseline * 100), 6) AS percent FROM (" + " UNION ALL ".join(parts) + ")",
        "nov AS (SELECT * FROM readings WHERE date_trunc('month', ts) = DATE '2024-11-01')",
    )


def _progress(spark, sf_dir, lateness=None):
    days = _published(spark, live.daily_totals(_arriving(spark, sf_dir), lateness=lateness), ["day"])
    goal = baseline(readings(spark, sf_dir), "2024-11")
    out = live.progress_vs_baseline(days, goal)
    return rounded(rounded(out, 5, "total", "baseline"), 6, "percent")


@query("stream_progress_vs_baseline", _progress_sql())
def stream_progress_vs_baseline(spark, sf_dir):
    return _progress(spark, sf_dir)


@query("stream_progress_with_watermark", _progress_sql())
def stream_progress_with_watermark(spark, sf_dir):
    """Files arrive in time order here, so a day of lateness loses nothing."""
    return _progress(spark, sf_dir, "1 day")


@query(
    "stream_work_types",
    with_readings("SELECT work_type, count(*) AS readings FROM readings GROUP BY 1"),
)
def stream_work_types(spark, sf_dir):
    return _published(spark, live.running_work_types(_arriving(spark, sf_dir)), ["work_type"])


@query(
    "stream_main_work_type",
    with_readings(
        "SELECT work_type AS main_work_type, count(*) AS readings FROM readings GROUP BY 1 "
        "ORDER BY readings DESC, main_work_type LIMIT 1"
    ),
)
def stream_main_work_type(spark, sf_dir):
    counts = _published(spark, live.running_work_types(_arriving(spark, sf_dir)), ["work_type"])
    return live.main_of_counts(counts)


@query("stream_hourly_share", with_readings(HOURLY_SHARE_SQL))
def stream_hourly_share(spark, sf_dir):
    running = live.running_hourly_counts(_arriving(spark, sf_dir))
    shares = live.running_hourly_share(_published(spark, running, ["hour", "work_type"]))
    return rounded(shares, 8, "share")


@query(
    "stream_series",
    with_readings(
        "SELECT ts, usage_kwh, cost_krw FROM readings "
        "WHERE ts BETWEEN TIMESTAMP '2024-12-01 00:00:00' AND TIMESTAMP '2024-12-31 23:45:00'"
    ),
)
def stream_series(spark, sf_dir):
    series = live.running_series(
        _arriving(spark, sf_dir), "2024-12-01 00:00:00", "2024-12-31 23:45:00", ["usage_kwh", "cost_krw"]
    )
    path = scratch_path(spark, "series")
    live.accumulate(series, path, scratch_path(spark, "stream-state")).awaitTermination()
    return spark.read.parquet(path)
