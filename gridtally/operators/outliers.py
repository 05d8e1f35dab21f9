"""Dropping rows with extreme values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.operators.quantiles import exact_quantiles


def iqr_bounds(df: DataFrame, col: str, k: float = 1.5) -> tuple[float, float]:
    low, high = exact_quantiles(df, {col: (0.25, 0.75)})[col]
    if low is None:
        raise ValueError(f"{col} has no values")
    return low - k * (high - low), high + k * (high - low)


def within(df: DataFrame, col: str, bounds: tuple[float, float]) -> DataFrame:
    """Rows with a value between the bounds; as literals, they are tested in the file scan."""
    return df.filter(F.col(col).between(*bounds))


def iqr_filter(df: DataFrame, col: str, k: float = 1.5) -> DataFrame:
    return within(df, col, iqr_bounds(df, col, k))


def removed_by_iqr(df: DataFrame, col: str, k: float = 1.5) -> DataFrame:
    """How many rows the filter sees, keeps and removes."""
    low, high = iqr_bounds(df, col, k)
    kept = F.count_if(F.col(col).between(low, high))
    return df.agg(
        F.count("*").alias("before"),
        kept.alias("after"),
        (F.count("*") - kept).alias("removed"),
    )


def quantile_trim(df: DataFrame, col: str, low: float, high: float) -> DataFrame:
    """Rows between two quantiles, both included."""
    bounds = exact_quantiles(df, {col: (low, high)})[col]
    if bounds[0] is None:
        raise ValueError(f"{col} has no values")
    return within(df, col, tuple(bounds))
