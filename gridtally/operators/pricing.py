"""Prices from the rate tables, and which plan a bill fits best."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.functions.tariff import PLAN_IN_USE, RATES, load_band, rate_era, rate_rows, rate_table, season
from gridtally.operators.relational import pivot_counts
from gridtally.schema import COST, TS, USAGE


def with_bands(df: DataFrame, ts: str = TS) -> DataFrame:
    """Add season, load band and price era."""
    return df.withColumns({"season": season(ts), "band": load_band(ts), "era": rate_era(ts)})


def unit_price(
    df: DataFrame, plan: str = PLAN_IN_USE, ts: str = TS, tariff: Sequence[tuple] = RATES
) -> DataFrame:
    """Add season, band, era and the plan's price per kWh; `tariff` has lines like `RATES`."""
    rates = rate_table(df.sparkSession, tariff).filter(F.col("plan") == plan).drop("rank", "plan")
    keys = ["era", "season", "band"]
    return with_bands(df, ts).join(
        F.broadcast(rates.withColumnRenamed("price", "unit_price")), keys, "left"
    )


def _tables(tariff: Sequence[tuple]) -> list[tuple[str, str]]:
    """(plan, era) of each table, in the order in which tables are compared."""
    return list(dict.fromkeys((plan, era) for _, plan, era, *_ in sorted(rate_rows(tariff))))


def _with_prices(df: DataFrame, ts: str, tariff: Sequence[tuple]) -> DataFrame:
    """Add `_price_0` and so on, every table's price for the reading's season and band.

    The nine (season, band) rows hold the prices side by side, so pricing a reading under every
    table stays inside its row: no row per table and no shuffle.
    """
    prices = [
        F.max(F.when(F.col("rank") == i, F.col("price"))).alias(f"_price_{i}")
        for i in range(len(_tables(tariff)))
    ]
    rates = rate_table(df.sparkSession, tariff).groupBy("season", "band").agg(*prices)
    banded = df.withColumns({"season": season(ts), "band": load_band(ts)})
    return banded.join(F.broadcast(rates), ["season", "band"], "left")


def price_plans(
    df: DataFrame, usage: str = USAGE, cost: str = COST, ts: str = TS, tariff: Sequence[tuple] = RATES
) -> DataFrame:
    """Each reading priced under all tables of the tariff, one row per reading and table."""
    tables = [
        F.struct(
            F.lit(i).alias("rank"),
            F.lit(plan).alias("plan"),
            F.lit(era).alias("era"),
            F.col(f"_price_{i}").alias("price"),
        )
        for i, (plan, era) in enumerate(_tables(tariff))
    ]
    return (
        _with_prices(df, ts, tariff)
        .select(*df.columns, "season", "band", F.inline(F.array(*tables)))
        .withColumn("priced_krw", F.col(usage) * F.col("price"))
        .withColumn("difference_krw", F.abs(F.col(cost) - F.col("priced_krw")))
    )


def nearest_plan(
    df: DataFrame, usage: str = USAGE, cost: str = COST, ts: str = TS, tariff: Sequence[tuple] = RATES
) -> DataFrame:
    """Add the table whose price comes closest to the bill; the earlier table wins a tie."""
    gaps = {
        f"_gap_{i}": F.abs(F.col(cost) - F.col(usage) * F.col(f"_price_{i}"))
        for i in range(len(_tables(tariff)))
    }
    nearest = F.col("nearest_difference")
    first = F.coalesce(
        *[F.when(F.col(f"_gap_{i}") == nearest, f"{p}_{e}") for i, (p, e) in enumerate(_tables(tariff))]
    )
    return (
        _with_prices(df, ts, tariff)
        .withColumns(gaps)
        .withColumn("nearest_difference", F.least(*gaps))
        .select(*df.columns, first.alias("nearest_plan"), "nearest_difference")
    )


def plan_distribution(df: DataFrame, ts: str = TS, tariff: Sequence[tuple] = RATES) -> DataFrame:
    """How many readings fit each table best, by price era: one row per era."""
    fitted = nearest_plan(df, ts=ts, tariff=tariff).withColumn("applied", rate_era(ts))
    return pivot_counts(fitted, ["applied"], "nearest_plan", [f"{p}_{e}" for p, e in _tables(tariff)])


def cost_by_band(
    df: DataFrame, plan: str = PLAN_IN_USE, ts: str = TS, tariff: Sequence[tuple] = RATES
) -> DataFrame:
    """Monthly usage, billed cost and cost by the plan's prices in each load band."""
    return (
        unit_price(df, plan, ts, tariff)
        .groupBy(F.trunc(ts, "month").alias("month"), "season", "band")
        .agg(
            F.count("*").alias("readings"),
            F.sum(USAGE).alias("usage_kwh"),
            F.sum(COST).alias("cost_krw"),
            F.sum(F.col(USAGE) * F.col("unit_price")).alias("priced_krw"),
        )
    )
