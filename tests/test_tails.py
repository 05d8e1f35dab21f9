"""Tails through the calendar index against plain sorting."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridtally.operators import ordered
from gridtally.operators.ordered import RANK, Series, calendar_index, tail
from gridtally.operators.relational import latest_n

SERIES = Series(("meter_id",), ("ts", "id"))


def readings(spark, rows=4000):
    """Meter 0 owns most rows, meter 5 a handful, meter None some, and a few rows have no time."""
    meter = F.when(F.col("id") % 10 < 6, 0).when(F.col("id") % 500 == 7, 5).when(F.col("id") % 10 == 8, None).otherwise(F.col("id") % 4 + 1)
    hours = F.pmod(F.xxhash64("id"), F.lit(24 * 900)).cast("int")
    ts = F.when(F.col("id") % 97 != 3, F.timestamp_add("HOUR", hours, F.lit("2022-01-15 00:30:00").cast("timestamp_ntz")))
    return spark.range(rows).select("id", meter.cast("int").alias("meter_id"), ts.alias("ts"), (F.col("id") * 1.5).alias("x"))


def plain(df, rows, keys=("meter_id",)):
    out = df.toPandas()
    out["ts"] = pd.to_datetime(out["ts"])
    out = out.sort_values(["ts", "id"], ascending=False, na_position="last")
    out[RANK] = out.groupby([out[k].fillna(-1) for k in keys] if keys else out["id"] * 0).cumcount() + 1
    out = out[out[RANK] <= rows]
    return {(r.id, r[RANK]) for _, r in out.iterrows()}


def found(df):
    return {(r.id, r[RANK]) for r in df.select("id", RANK).collect()}


@pytest.mark.parametrize("rows", [1, 24, 700, 10_000])
def test_last_rows_of_every_series(spark, rows):
    df = readings(spark).repartition(7)
    assert found(tail(df, rows, SERIES)) == plain(df, rows)


@pytest.mark.parametrize("most", [50, 3, 0])
def test_crowded_months_days_and_hours(spark, monkeypatch, most):
    """Months, then days, then hours hold more rows than a task may sort; at the end positions decide."""
    monkeypatch.setattr(ordered, "UNIT_ROWS", most)
    df = readings(spark)
    assert found(tail(df, 30, SERIES)) == plain(df, 30)


def test_one_series_dates_and_instants(spark):
    df = readings(spark)
    whole = Series((), ("ts", "id"))
    assert found(tail(df, 100, whole)) == plain(df, 100, ())
    dated = df.withColumn("ts", F.col("ts").cast("date"))
    assert found(tail(dated, 20, SERIES)) == plain(dated, 20)
    zoned = df.withColumn("ts", F.col("ts").cast("timestamp"))
    assert found(tail(zoned, 20, SERIES)) == plain(zoned, 20)
    assert tail(df.limit(0), 5, SERIES).count() == 0


def test_index_counts_what_comes_after(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 3)), (1, dt.datetime(2024, 1, 9)), (1, dt.datetime(2024, 3, 1)), (2, dt.datetime(2024, 2, 2)), (1, None)],
        "meter_id int, ts timestamp_ntz",
    )
    rows = [tuple(r) for r in calendar_index(df, Series(("meter_id",), ("ts",))).orderBy("meter_id", "unit").collect()]
    assert rows == [
        (1, None, 1, None, 3), (1, 24289, 2, dt.datetime(2024, 1, 3), 1), (1, 24291, 1, dt.datetime(2024, 3, 1), 0),
        (2, 24290, 1, dt.datetime(2024, 2, 2), 0),
    ]


def test_only_the_last_months_are_read(spark, tmp_path):
    df = readings(spark).filter("ts is not null and meter_id = 0")
    path = f"file:{tmp_path}/readings"
    df.write.parquet(path)
    out = latest_n(spark.read.parquet(path), 10, ("ts", "id"), by=["meter_id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "rangepartitioning" not in plan
    first = out.agg(F.min("ts")).first()[0]
    assert plan.count("PushedFilters") >= 1 and f"{first:%Y-%m}" in plan
