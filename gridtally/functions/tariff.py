"""Season, load band and price era of a reading, and the tables of rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SUMMER, MID_SEASON, WINTER = "여름", "봄가을", "겨울"
OFF_PEAK, MID_LOAD, PEAK = "경부하", "중간부하", "최대부하"
BEFORE, AFTER = "before", "after"

# Fixed value: the instant new rates took effect.
RATE_CUTOFF = "2024-10-24 00:00:00"

# Won per kWh by plan, era and season, for the off-peak, mid and peak band; plans and eras
# in the order in which they are compared.
RATES = (
    ("고압A_선택1", BEFORE, SUMMER, 99.5, 152.4, 234.5),
    ("고압A_선택1", BEFORE, MID_SEASON, 99.5, 122.0, 152.7),
    ("고압A_선택1", BEFORE, WINTER, 106.5, 152.6, 210.1),
    ("고압A_선택1", AFTER, SUMMER, 116.4, 169.3, 251.4),
    ("고압A_선택1", AFTER, MID_SEASON, 116.4, 138.9, 169.6),
    ("고압A_선택1", AFTER, WINTER, 123.4, 169.5, 227.0),
    ("고압A_선택2", BEFORE, SUMMER, 94.0, 146.9, 229.0),
    ("고압A_선택2", BEFORE, MID_SEASON, 94.0, 116.5, 147.2),
    ("고압A_선택2", BEFORE, WINTER, 101.0, 147.1, 204.6),
    ("고압A_선택2", AFTER, SUMMER, 110.9, 163.8, 245.9),
    ("고압A_선택2", AFTER, MID_SEASON, 110.9, 133.4, 164.1),
    ("고압A_선택2", AFTER, WINTER, 117.9, 164.0, 221.5),
    ("고압A_선택3", BEFORE, SUMMER, 93.1, 146.3, 216.6),
    ("고압A_선택3", BEFORE, MID_SEASON, 93.1, 115.2, 138.9),
    ("고압A_선택3", BEFORE, WINTER, 100.4, 146.5, 193.4),
    ("고압A_선택3", AFTER, SUMMER, 110.0, 163.2, 233.5),
    ("고압A_선택3", AFTER, MID_SEASON, 110.0, 132.1, 155.8),
    ("고압A_선택3", AFTER, WINTER, 117.3, 163.4, 210.3),
    ("고압B_선택1", BEFORE, SUMMER, 109.4, 161.7, 242.9),
    ("고압B_선택1", BEFORE, MID_SEASON, 109.4, 131.7, 162.0),
    ("고압B_선택1", BEFORE, WINTER, 116.4, 161.7, 217.9),
    ("고압B_선택1", AFTER, SUMMER, 126.3, 178.6, 259.8),
    ("고압B_선택1", AFTER, MID_SEASON, 126.3, 148.6, 178.9),
    ("고압B_선택1", AFTER, WINTER, 133.3, 178.6, 234.8),
    ("고압B_선택2", BEFORE, SUMMER, 105.6, 157.9, 239.1),
    ("고압B_선택2", BEFORE, MID_SEASON, 105.6, 127.9, 158.2),
    ("고압B_선택2", BEFORE, WINTER, 112.6, 157.9, 214.1),
    ("고압B_선택2", AFTER, SUMMER, 122.5, 174.8, 256.0),
    ("고압B_선택2", AFTER, MID_SEASON, 122.5, 144.8, 175.1),
    ("고압B_선택2", AFTER, WINTER, 129.5, 174.8, 231.0),
    ("고압B_선택3", BEFORE, SUMMER, 103.9, 156.2, 237.5),
    ("고압B_선택3", BEFORE, MID_SEASON, 103.9, 126.3, 156.6),
    ("고압B_선택3", BEFORE, WINTER, 111.0, 156.2, 212.4),
    ("고압B_선택3", AFTER, SUMMER, 120.8, 173.1, 254.4),
    ("고압B_선택3", AFTER, MID_SEASON, 120.8, 143.2, 173.5),
    ("고압B_선택3", AFTER, WINTER, 127.9, 173.1, 229.3),
    ("고압C_선택1", BEFORE, SUMMER, 108.9, 161.8, 242.7),
    ("고압C_선택1", BEFORE, MID_SEASON, 108.9, 131.8, 162.2),
    ("고압C_선택1", BEFORE, WINTER, 115.8, 161.4, 218.0),
    ("고압C_선택1", AFTER, SUMMER, 125.8, 178.7, 259.6),
    ("고압C_선택1", AFTER, MID_SEASON, 125.8, 148.7, 179.1),
    ("고압C_선택1", AFTER, WINTER, 132.7, 178.3, 234.9),
    ("고압C_선택2", BEFORE, SUMMER, 104.2, 157.1, 238.0),
    ("고압C_선택2", BEFORE, MID_SEASON, 104.2, 127.1, 157.5),
    ("고압C_선택2", BEFORE, WINTER, 111.1, 156.7, 213.3),
    ("고압C_선택2", AFTER, SUMMER, 121.1, 174.0, 254.9),
    ("고압C_선택2", AFTER, MID_SEASON, 121.1, 144.0, 174.4),
    ("고압C_선택2", AFTER, WINTER, 128.0, 173.6, 230.2),
    ("고압C_선택3", BEFORE, SUMMER, 103.1, 156.0, 236.9),
    ("고압C_선택3", BEFORE, MID_SEASON, 103.1, 126.0, 156.4),
    ("고압C_선택3", BEFORE, WINTER, 110.0, 155.6, 212.2),
    ("고압C_선택3", AFTER, SUMMER, 120.0, 172.9, 253.8),
    ("고압C_선택3", AFTER, MID_SEASON, 120.0, 142.9, 173.3),
    ("고압C_선택3", AFTER, WINTER, 126.9, 172.5, 229.1),
)

# Lines of a tariff that are small enough to be sent to every task.
MOST_RATES = 10_000

PLAN_IN_USE = "고압A_선택3"


def season(ts: str = "ts") -> Column:
    month = F.month(ts)
    return (
        F.when(month.between(6, 8), SUMMER)
        .when(month.between(3, 5) | month.between(9, 10), MID_SEASON)
        .otherwise(WINTER)
    )


def load_band(ts: str = "ts", season_col: Column | None = None) -> Column:
    """Band of the tariff's day; winter has other mid-load hours than the rest of the year."""
    hour = F.hour(ts)
    of_season = season(ts) if season_col is None else season_col
    # The hours of each band; the rest of the day is peak.
    night = (hour >= 22) | (hour < 8)
    warm_mid = hour.between(8, 10) | (hour == 12) | hour.between(18, 21)
    winter_mid = (hour == 8) | hour.between(12, 15) | hour.between(19, 21)
    mid = F.when(of_season == WINTER, winter_mid).otherwise(warm_mid)
    return F.when(night, OFF_PEAK).when(mid, MID_LOAD).otherwise(PEAK)


def rate_era(ts: str = "ts", cutoff: str = RATE_CUTOFF) -> Column:
    return F.when(F.col(ts) < F.lit(cutoff).cast("timestamp_ntz"), BEFORE).otherwise(AFTER)


Rate = tuple[int, str, str, str, str, float]


def rate_rows(rates: Sequence[tuple] = RATES) -> list[Rate]:
    """(rank, plan, era, season, band, price); rank is the order in which plans and eras are compared."""
    tables = list(dict.fromkeys((plan, era) for plan, era, *_ in rates))
    return [
        (tables.index((plan, era)), plan, era, of_season, band, float(price))
        for plan, era, of_season, *prices in rates
        for band, price in zip((OFF_PEAK, MID_LOAD, PEAK), prices, strict=True)
    ]


def rate_table(spark: SparkSession, rates: Sequence[tuple] = RATES) -> DataFrame:
    """The rates as a table, one row for each plan, era, season and band; at most `MOST_RATES` lines."""
    if len(rates) > MOST_RATES:
        raise ValueError(f"a tariff has at most {MOST_RATES} lines, not {len(rates)}")
    return spark.createDataFrame(
        rate_rows(rates), "rank int, plan string, era string, season string, band string, price double"
    )
