"""Meter readings derived from the given tables, for Spark and, as text, for the comparison SQL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.operators.ordered import Series

MONTH = "2024-05"
FORECAST_START = "2024-12-01 00:00:00"
EVENT_SERIES = Series(keys=(), order=("ts", "event_id"))
ONE_SERIES = Series(keys=(), order=("ts", "reading_id"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as readings of eight meters on a 15-minute grid, 2019 to 2025."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    usage = price / 1000.0
    quarter_hour = F.make_dt_interval(F.lit(0), F.lit(0), (key % 96 * 15).cast("int"), F.lit(0))
    priority = F.col("o_orderpriority")
    pf_lag = (60 + key % 41).cast("double")
    return table(spark, sf_dir, "orders").select(
        key.alias("reading_id"),
        (F.col("o_custkey") % 8).cast("int").alias("meter_id"),
        (F.col("o_orderdate") + F.expr("INTERVAL 24 YEAR") + quarter_hour).alias("ts"),
        F.when(priority.isin("1-URGENT", "2-HIGH"), "Maximum_Load")
        .when(priority == "3-MEDIUM", "Medium_Load")
        .otherwise("Light_Load")
        .alias("work_type"),
        usage.alias("usage_kwh"),
        (usage * (key % 37 / 100)).alias("reactive_lag_kvarh"),
        (usage * (key % 23 / 100)).alias("reactive_lead_kvarh"),
        (usage * 0.00045).alias("carbon_tco2"),
        pf_lag.alias("pf_lag_pct"),
        (100 - pf_lag % 40).alias("pf_lead_pct"),
        (usage * (90 + key * 7 % 170)).alias("cost_krw"),
    )


def train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).filter(F.col("ts") < F.lit(FORECAST_START).cast("timestamp_ntz"))


def to_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        readings(spark, sf_dir)
        .filter(F.col("ts") >= F.lit(FORECAST_START).cast("timestamp_ntz"))
        .select("reading_id", "meter_id", "ts", "work_type")
    )


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def rounded_all(df: DataFrame, digits: int) -> DataFrame:
    return rounded(df, digits, *[c for c, kind in df.dtypes if kind == "double"])


READINGS_SQL = """
readings AS (
  SELECT o_orderkey AS reading_id,
         CAST(o_custkey % 8 AS INTEGER) AS meter_id,
         CAST(o_orderdate + INTERVAL 24 YEAR + INTERVAL 15 MINUTE * CAST(o_orderkey % 96 AS INTEGER)
              AS TIMESTAMP) AS ts,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Maximum_Load'
              WHEN o_orderpriority = '3-MEDIUM' THEN 'Medium_Load' ELSE 'Light_Load' END AS work_type,
         o_totalprice / 1000.0 AS usage_kwh,
         o_totalprice / 1000.0 * ((o_orderkey % 37) / 100) AS reactive_lag_kvarh,
         o_totalprice / 1000.0 * ((o_orderkey % 23) / 100) AS reactive_lead_kvarh,
         o_totalprice / 1000.0 * CAST(0.00045 AS DOUBLE) AS carbon_tco2,
         CAST(60 + o_orderkey % 41 AS DOUBLE) AS pf_lag_pct,
         100 - CAST(60 + o_orderkey % 41 AS DOUBLE) % 40 AS pf_lead_pct,
         o_totalprice / 1000.0 * (90 + (o_orderkey * 7) % 170) AS cost_krw
  FROM orders),
train AS (SELECT * FROM readings WHERE ts < TIMESTAMP '2024-12-01 00:00:00'),
to_forecast AS (
  SELECT reading_id, meter_id, ts, work_type FROM readings
  WHERE ts >= TIMESTAMP '2024-12-01 00:00:00'),
chosen AS (
  SELECT * FROM readings
  WHERE ts >= TIMESTAMP '2024-05-01 00:00:00' AND ts < TIMESTAMP '2024-06-01 00:00:00')"""

SEASON_SQL = """CASE WHEN month(ts) IN (6, 7, 8) THEN '여름'
 WHEN month(ts) IN (3, 4, 5, 9, 10) THEN '봄가을' ELSE '겨울' END"""

BAND_SQL = """CASE WHEN hour(ts) >= 22 OR hour(ts) < 8 THEN '경부하'
 WHEN month(ts) BETWEEN 3 AND 10 AND ((hour(ts) >= 8 AND hour(ts) < 11)
      OR (hour(ts) >= 12 AND hour(ts) < 13) OR (hour(ts) >= 18 AND hour(ts) < 22)) THEN '중간부하'
 WHEN month(ts) NOT BETWEEN 3 AND 10 AND ((hour(ts) >= 8 AND hour(ts) < 9)
      OR (hour(ts) >= 12 AND hour(ts) < 16) OR (hour(ts) >= 19 AND hour(ts) < 22)) THEN '중간부하'
 ELSE '최대부하' END"""

ERA_SQL = "CASE WHEN ts < TIMESTAMP '2024-10-24 00:00:00' THEN 'before' ELSE 'after' END"

# Every rate, stated here once more, so that the comparison does not rest on the library's table.
RATES_SQL = """rates AS (SELECT * FROM (VALUES
  (0, '고압A_선택1', 'before', '여름', '경부하', CAST(99.5 AS DOUBLE)),
  (0, '고압A_선택1', 'before', '여름', '중간부하', CAST(152.4 AS DOUBLE)),
  (0, '고압A_선택1', 'before', '여름', '최대부하', CAST(234.5 AS DOUBLE)),
  (0, '고압A_선택1', 'before', '봄가을', '경부하', CAST(99.5 AS DOUBLE)),
  (0, '고압A_선택1', 'before', '봄가을', '중간부하', CAST(122.0 AS DOUBLE)),
  (0, '고압A_선택1', 'before', '봄가을', '최대부하', CAST(152.7 AS DOUBLE)),
  (0, '고압A_선택1', 'before', '겨울', '경부하', CAST(106.5 AS DOUBLE)),
  (0, '고압A_선택1', 'before', '겨울', '중간부하', CAST(152.6 AS DOUBLE)),
  (0, '고압A_선택1', 'before', '겨울', '최대부하', CAST(210.1 AS DOUBLE)),
  (1, '고압A_선택1', 'after', '여름', '경부하', CAST(116.4 AS DOUBLE)),
  (1, '고압A_선택1', 'after', '여름', '중간부하', CAST(169.3 AS DOUBLE)),
  (1, '고압A_선택1', 'after', '여름', '최대부하', CAST(251.4 AS DOUBLE)),
  (1, '고압A_선택1', 'after', '봄가을', '경부하', CAST(116.4 AS DOUBLE)),
  (1, '고압A_선택1', 'after', '봄가을', '중간부하', CAST(138.9 AS DOUBLE)),
  (1, '고압A_선택1', 'after', '봄가을', '최대부하', CAST(169.6 AS DOUBLE)),
  (1, '고압A_선택1', 'after', '겨울', '경부하', CAST(123.4 AS DOUBLE)),
  (1, '고압A_선택1', 'after', '겨울', '중간부하', CAST(169.5 AS DOUBLE)),
  (1, '고압A_선택1', 'after', '겨울', '최대부하', CAST(227.0 AS DOUBLE)),
  (2, '고압A_선택2', 'before', '여름', '경부하', CAST(94.0 AS DOUBLE)),
  (2, '고압A_선택2', 'before', '여름', '중간부하', CAST(146.9 AS DOUBLE)),
  (2, '고압A_선택2', 'before', '여름', '최대부하', CAST(229.0 AS DOUBLE)),
  (2, '고압A_선택2', 'before', '봄가을', '경부하', CAST(94.0 AS DOUBLE)),
  (2, '고압A_선택2', 'before', '봄가을', '중간부하', CAST(116.5 AS DOUBLE)),
  (2, '고압A_선택2', 'before', '봄가을', '최대부하', CAST(147.2 AS DOUBLE)),
  (2, '고압A_선택2', 'before', '겨울', '경부하', CAST(101.0 AS DOUBLE)),
  (2, '고압A_선택2', 'before', '겨울', '중간부하', CAST(147.1 AS DOUBLE)),
  (2, '고압A_선택2', 'before', '겨울', '최대부하', CAST(204.6 AS DOUBLE)),
  (3, '고압A_선택2', 'after', '여름', '경부하', CAST(110.9 AS DOUBLE)),
  (3, '고압A_선택2', 'after', '여름', '중간부하', CAST(163.8 AS DOUBLE)),
  (3, '고압A_선택2', 'after', '여름', '최대부하', CAST(245.9 AS DOUBLE)),
  (3, '고압A_선택2', 'after', '봄가을', '경부하', CAST(110.9 AS DOUBLE)),
  (3, '고압A_선택2', 'after', '봄가을', '중간부하', CAST(133.4 AS DOUBLE)),
  (3, '고압A_선택2', 'after', '봄가을', '최대부하', CAST(164.1 AS DOUBLE)),
  (3, '고압A_선택2', 'after', '겨울', '경부하', CAST(117.9 AS DOUBLE)),
  (3, '고압A_선택2', 'after', '겨울', '중간부하', CAST(164.0 AS DOUBLE)),
  (3, '고압A_선택2', 'after', '겨울', '최대부하', CAST(221.5 AS DOUBLE)),
  (4, '고압A_선택3', 'before', '여름', '경부하', CAST(93.1 AS DOUBLE)),
  (4, '고압A_선택3', 'before', '여름', '중간부하', CAST(146.3 AS DOUBLE)),
  (4, '고압A_선택3', 'before', '여름', '최대부하', CAST(216.6 AS DOUBLE)),
  (4, '고압A_선택3', 'before', '봄가을', '경부하', CAST(93.1 AS DOUBLE)),
  (4, '고압A_선택3', 'before', '봄가을', '중간부하', CAST(115.2 AS DOUBLE)),
  (4, '고압A_선택3', 'before', '봄가을', '최대부하', CAST(138.9 AS DOUBLE)),
  (4, '고압A_선택3', 'before', '겨울', '경부하', CAST(100.4 AS DOUBLE)),
  (4, '고압A_선택3', 'before', '겨울', '중간부하', CAST(146.5 AS DOUBLE)),
  (4, '고압A_선택3', 'before', '겨울', '최대부하', CAST(193.4 AS DOUBLE)),
  (5, '고압A_선택3', 'after', '여름', '경부하', CAST(110.0 AS DOUBLE)),
  (5, '고압A_선택3', 'after', '여름', '중간부하', CAST(163.2 AS DOUBLE)),
  (5, '고압A_선택3', 'after', '여름', '최대부하', CAST(233.5 AS DOUBLE)),
  (5, '고압A_선택3', 'after', '봄가을', '경부하', CAST(110.0 AS DOUBLE)),
  (5, '고압A_선택3', 'after', '봄가을', '중간부하', CAST(132.1 AS DOUBLE)),
  (5, '고압A_선택3', 'after', '봄가을', '최대부하', CAST(155.8 AS DOUBLE)),
  (5, '고압A_선택3', 'after', '겨울', '경부하', CAST(117.3 AS DOUBLE)),
  (5, '고압A_선택3', 'after', '겨울', '중간부하', CAST(163.4 AS DOUBLE)),
  (5, '고압A_선택3', 'after', '겨울', '최대부하', CAST(210.3 AS DOUBLE)),
  (6, '고압B_선택1', 'before', '여름', '경부하', CAST(109.4 AS DOUBLE)),
  (6, '고압B_선택1', 'before', '여름', '중간부하', CAST(161.7 AS DOUBLE)),
  (6, '고압B_선택1', 'before', '여름', '최대부하', CAST(242.9 AS DOUBLE)),
  (6, '고압B_선택1', 'before', '봄가을', '경부하', CAST(109.4 AS DOUBLE)),
  (6, '고압B_선택1', 'before', '봄가을', '중간부하', CAST(131.7 AS DOUBLE)),
  (6, '고압B_선택1', 'before', '봄가을', '최대부하', CAST(162.0 AS DOUBLE)),
  (6, '고압B_선택1', 'before', '겨울', '경부하', CAST(116.4 AS DOUBLE)),
  (6, '고압B_선택1', 'before', '겨울', '중간부하', CAST(161.7 AS DOUBLE)),
  (6, '고압B_선택1', 'before', '겨울', '최대부하', CAST(217.9 AS DOUBLE)),
  (7, '고압B_선택1', 'after', '여름', '경부하', CAST(126.3 AS DOUBLE)),
  (7, '고압B_선택1', 'after', '여름', '중간부하', CAST(178.6 AS DOUBLE)),
  (7, '고압B_선택1', 'after', '여름', '최대부하', CAST(259.8 AS DOUBLE)),
  (7, '고압B_선택1', 'after', '봄가을', '경부하', CAST(126.3 AS DOUBLE)),
  (7, '고압B_선택1', 'after', '봄가을', '중간부하', CAST(148.6 AS DOUBLE)),
  (7, '고압B_선택1', 'after', '봄가을', '최대부하', CAST(178.9 AS DOUBLE)),
  (7, '고압B_선택1', 'after', '겨울', '경부하', CAST(133.3 AS DOUBLE)),
  (7, '고압B_선택1', 'after', '겨울', '중간부하', CAST(178.6 AS DOUBLE)),
  (7, '고압B_선택1', 'after', '겨울', '최대부하', CAST(234.8 AS DOUBLE)),
  (8, '고압B_선택2', 'before', '여름', '경부하', CAST(105.6 AS DOUBLE)),
  (8, '고압B_선택2', 'before', '여름', '중간부하', CAST(157.9 AS DOUBLE)),
  (8, '고압B_선택2', 'before', '여름', '최대부하', CAST(239.1 AS DOUBLE)),
  (8, '고압B_선택2', 'before', '봄가을', '경부하', CAST(105.6 AS DOUBLE)),
  (8, '고압B_선택2', 'before', '봄가을', '중간부하', CAST(127.9 AS DOUBLE)),
  (8, '고압B_선택2', 'before', '봄가을', '최대부하', CAST(158.2 AS DOUBLE)),
  (8, '고압B_선택2', 'before', '겨울', '경부하', CAST(112.6 AS DOUBLE)),
  (8, '고압B_선택2', 'before', '겨울', '중간부하', CAST(157.9 AS DOUBLE)),
  (8, '고압B_선택2', 'before', '겨울', '최대부하', CAST(214.1 AS DOUBLE)),
  (9, '고압B_선택2', 'after', '여름', '경부하', CAST(122.5 AS DOUBLE)),
  (9, '고압B_선택2', 'after', '여름', '중간부하', CAST(174.8 AS DOUBLE)),
  (9, '고압B_선택2', 'after', '여름', '최대부하', CAST(256.0 AS DOUBLE)),
  (9, '고압B_선택2', 'after', '봄가을', '경부하', CAST(122.5 AS DOUBLE)),
  (9, '고압B_선택2', 'after', '봄가을', '중간부하', CAST(144.8 AS DOUBLE)),
  (9, '고압B_선택2', 'after', '봄가을', '최대부하', CAST(175.1 AS DOUBLE)),
  (9, '고압B_선택2', 'after', '겨울', '경부하', CAST(129.5 AS DOUBLE)),
  (9, '고압B_선택2', 'after', '겨울', '중간부하', CAST(174.8 AS DOUBLE)),
  (9, '고압B_선택2', 'after', '겨울', '최대부하', CAST(231.0 AS DOUBLE)),
  (10, '고압B_선택3', 'before', '여름', '경부하', CAST(103.9 AS DOUBLE)),
  (10, '고압B_선택3', 'before', '여름', '중간부하', CAST(156.2 AS DOUBLE)),
  (10, '고압B_선택3', 'before', '여름', '최대부하', CAST(237.5 AS DOUBLE)),
  (10, '고압B_선택3', 'before', '봄가을', '경부하', CAST(103.9 AS DOUBLE)),
  (10, '고압B_선택3', 'before', '봄가을', '중간부하', CAST(126.3 AS DOUBLE)),
  (10, '고압B_선택3', 'before', '봄가을', '최대부하', CAST(156.6 AS DOUBLE)),
  (10, '고압B_선택3', 'before', '겨울', '경부하', CAST(111.0 AS DOUBLE)),
  (10, '고압B_선택3', 'before', '겨울', '중간부하', CAST(156.2 AS DOUBLE)),
  (10, '고압B_선택3', 'before', '겨울', '최대부하', CAST(212.4 AS DOUBLE)),
  (11, '고압B_선택3', 'after', '여름', '경부하', CAST(120.8 AS DOUBLE)),
  (11, '고압B_선택3', 'after', '여름', '중간부하', CAST(173.1 AS DOUBLE)),
  (11, '고압B_선택3', 'after', '여름', '최대부하', CAST(254.4 AS DOUBLE)),
  (11, '고압B_선택3', 'after', '봄가을', '경부하', CAST(120.8 AS DOUBLE)),
  (11, '고압B_선택3', 'after', '봄가을', '중간부하', CAST(143.2 AS DOUBLE)),
  (11, '고압B_선택3', 'after', '봄가을', '최대부하', CAST(173.5 AS DOUBLE)),
  (11, '고압B_선택3', 'after', '겨울', '경부하', CAST(127.9 AS DOUBLE)),
  (11, '고압B_선택3', 'after', '겨울', '중간부하', CAST(173.1 AS DOUBLE)),
  (11, '고압B_선택3', 'after', '겨울', '최대부하', CAST(229.3 AS DOUBLE)),
  (12, '고압C_선택1', 'before', '여름', '경부하', CAST(108.9 AS DOUBLE)),
  (12, '고압C_선택1', 'before', '여름', '중간부하', CAST(161.8 AS DOUBLE)),
  (12, '고압C_선택1', 'before', '여름', '최대부하', CAST(242.7 AS DOUBLE)),
  (12, '고압C_선택1', 'before', '봄가을', '경부하', CAST(108.9 AS DOUBLE)),
  (12, '고압C_선택1', 'before', '봄가을', '중간부하', CAST(131.8 AS DOUBLE)),
  (12, '고압C_선택1', 'before', '봄가을', '최대부하', CAST(162.2 AS DOUBLE)),
  (12, '고압C_선택1', 'before', '겨울', '경부하', CAST(115.8 AS DOUBLE)),
  (12, '고압C_선택1', 'before', '겨울', '중간부하', CAST(161.4 AS DOUBLE)),
  (12, '고압C_선택1', 'before', '겨울', '최대부하', CAST(218.0 AS DOUBLE)),
  (13, '고압C_선택1', 'after', '여름', '경부하', CAST(125.8 AS DOUBLE)),
  (13, '고압C_선택1', 'after', '여름', '중간부하', CAST(178.7 AS DOUBLE)),
  (13, '고압C_선택1', 'after', '여름', '최대부하', CAST(259.6 AS DOUBLE)),
  (13, '고압C_선택1', 'after', '봄가을', '경부하', CAST(125.8 AS DOUBLE)),
  (13, '고압C_선택1', 'after', '봄가을', '중간부하', CAST(148.7 AS DOUBLE)),
  (13, '고압C_선택1', 'after', '봄가을', '최대부하', CAST(179.1 AS DOUBLE)),
  (13, '고압C_선택1', 'after', '겨울', '경부하', CAST(132.7 AS DOUBLE)),
  (13, '고압C_선택1', 'after', '겨울', '중간부하', CAST(178.3 AS DOUBLE)),
  (13, '고압C_선택1', 'after', '겨울', '최대부하', CAST(234.9 AS DOUBLE)),
  (14, '고압C_선택2', 'before', '여름', '경부하', CAST(104.2 AS DOUBLE)),
  (14, '고압C_선택2', 'before', '여름', '중간부하', CAST(157.1 AS DOUBLE)),
  (14, '고압C_선택2', 'before', '여름', '최대부하', CAST(238.0 AS DOUBLE)),
  (14, '고압C_선택2', 'before', '봄가을', '경부하', CAST(104.2 AS DOUBLE)),
  (14, '고압C_선택2', 'before', '봄가을', '중간부하', CAST(127.1 AS DOUBLE)),
  (14, '고압C_선택2', 'before', '봄가을', '최대부하', CAST(157.5 AS DOUBLE)),
  (14, '고압C_선택2', 'before', '겨울', '경부하', CAST(111.1 AS DOUBLE)),
  (14, '고압C_선택2', 'before', '겨울', '중간부하', CAST(156.7 AS DOUBLE)),
  (14, '고압C_선택2', 'before', '겨울', '최대부하', CAST(213.3 AS DOUBLE)),
  (15, '고압C_선택2', 'after', '여름', '경부하', CAST(121.1 AS DOUBLE)),
  (15, '고압C_선택2', 'after', '여름', '중간부하', CAST(174.0 AS DOUBLE)),
  (15, '고압C_선택2', 'after', '여름', '최대부하', CAST(254.9 AS DOUBLE)),
  (15, '고압C_선택2', 'after', '봄가을', '경부하', CAST(121.1 AS DOUBLE)),
  (15, '고압C_선택2', 'after', '봄가을', '중간부하', CAST(144.0 AS DOUBLE)),
  (15, '고압C_선택2', 'after', '봄가을', '최대부하', CAST(174.4 AS DOUBLE)),
  (15, '고압C_선택2', 'after', '겨울', '경부하', CAST(128.0 AS DOUBLE)),
  (15, '고압C_선택2', 'after', '겨울', '중간부하', CAST(173.6 AS DOUBLE)),
  (15, '고압C_선택2', 'after', '겨울', '최대부하', CAST(230.2 AS DOUBLE)),
  (16, '고압C_선택3', 'before', '여름', '경부하', CAST(103.1 AS DOUBLE)),
  (16, '고압C_선택3', 'before', '여름', '중간부하', CAST(156.0 AS DOUBLE)),
  (16, '고압C_선택3', 'before', '여름', '최대부하', CAST(236.9 AS DOUBLE)),
  (16, '고압C_선택3', 'before', '봄가을', '경부하', CAST(103.1 AS DOUBLE)),
  (16, '고압C_선택3', 'before', '봄가을', '중간부하', CAST(126.0 AS DOUBLE)),
  (16, '고압C_선택3', 'before', '봄가을', '최대부하', CAST(156.4 AS DOUBLE)),
  (16, '고압C_선택3', 'before', '겨울', '경부하', CAST(110.0 AS DOUBLE)),
  (16, '고압C_선택3', 'before', '겨울', '중간부하', CAST(155.6 AS DOUBLE)),
  (16, '고압C_선택3', 'before', '겨울', '최대부하', CAST(212.2 AS DOUBLE)),
  (17, '고압C_선택3', 'after', '여름', '경부하', CAST(120.0 AS DOUBLE)),
  (17, '고압C_선택3', 'after', '여름', '중간부하', CAST(172.9 AS DOUBLE)),
  (17, '고압C_선택3', 'after', '여름', '최대부하', CAST(253.8 AS DOUBLE)),
  (17, '고압C_선택3', 'after', '봄가을', '경부하', CAST(120.0 AS DOUBLE)),
  (17, '고압C_선택3', 'after', '봄가을', '중간부하', CAST(142.9 AS DOUBLE)),
  (17, '고압C_선택3', 'after', '봄가을', '최대부하', CAST(173.3 AS DOUBLE)),
  (17, '고압C_선택3', 'after', '겨울', '경부하', CAST(126.9 AS DOUBLE)),
  (17, '고압C_선택3', 'after', '겨울', '중간부하', CAST(172.5 AS DOUBLE)),
  (17, '고압C_선택3', 'after', '겨울', '최대부하', CAST(229.1 AS DOUBLE))
) AS t(rank, plan, era, season, band, price))"""


def with_readings(select: str, *ctes: str) -> str:
    """A statement that can read `readings`, `train`, `to_forecast`, `chosen` and more."""
    return "WITH " + ",\n".join([READINGS_SQL.strip(), *ctes]) + "\n" + select


def rd(expression: str, digits: int) -> str:
    """A rounded number, with 0 for minus 0."""
    value = f"round({expression}, {digits})"
    return f"(CASE WHEN {value} = 0 THEN CAST(0 AS DOUBLE) ELSE {value} END)"


def columns(names: Iterable[str], template: str = "{}") -> str:
    return ", ".join(template.format(n) for n in names)


def snapped(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    """Cut numbers at a place where no short decimal lies.

    Means and medians of short decimals often lie halfway between two roundings, where the last
    bit of a sum decides. Here both engines cut alike.
    """
    scale = float(10**digits)
    return df.withColumns({c: F.floor(F.col(c) * scale + 0.3137) / scale for c in cols})


def snap(expression: str, digits: int) -> str:
    """SQL of `snapped`."""
    scale = f"CAST({10**digits} AS DOUBLE)"
    return f"(floor(({expression}) * {scale} + 0.3137) / {scale})"
