"""Choosing rows by time and columns by name."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.schema import MONTH, TS


def instant(df: DataFrame, value: str, ts: str = TS) -> Column:
    """A literal of the time column's own type, so that the comparison reaches the file scan."""
    return F.lit(value).cast(df.schema[ts].dataType)


def has_month_folders(df: DataFrame, ts: str = TS) -> bool:
    """Whether the frame has the month column that `write_predictions` lays tables out by."""
    return ts == TS and MONTH in df.columns and dict(df.dtypes)[MONTH] == "date"


def time_range(
    df: DataFrame, start: Column | None = None, end: Column | None = None, ts: str = TS
) -> DataFrame:
    """Rows from `start` up to, but not including, `end`; skips month folders outside of them."""
    kind = df.schema[ts].dataType
    folders = has_month_folders(df, ts)
    if start is not None:
        df = df.filter(F.col(ts) >= start.cast(kind))
        if folders:
            df = df.filter(F.col(MONTH) >= F.trunc(start, "month"))
    if end is not None:
        df = df.filter(F.col(ts) < end.cast(kind))
        if folders:
            df = df.filter(F.col(MONTH).cast(kind) < end.cast(kind))
    return df


def newest(df: DataFrame, ts: str = TS) -> Column:
    """The newest time, as a scalar; reads only the newest month folder where there are folders."""
    if has_month_folders(df, ts):
        df = df.filter(F.col(MONTH) == df.agg(F.max(MONTH)).scalar())
    return df.agg(F.max(ts)).scalar()


def _month_start(month: str, shift: int = 0) -> Column:
    return F.add_months(F.lit(f"{month}-01").cast("date"), shift)


def in_month(df: DataFrame, month: str, ts: str = TS) -> DataFrame:
    """The whole month, `YYYY-MM`, last day included."""
    return time_range(df, _month_start(month), _month_start(month, 1), ts)


def previous_month(df: DataFrame, month: str, ts: str = TS) -> DataFrame:
    return time_range(df, _month_start(month, -1), _month_start(month), ts)


def in_dates(df: DataFrame, start: str, end: str, ts: str = TS) -> DataFrame:
    """From the start day to the end day, both included."""
    return time_range(df, F.lit(start).cast("date"), F.date_add(F.lit(end).cast("date"), 1), ts)


def between(df: DataFrame, start: str, end: str, ts: str = TS) -> DataFrame:
    """From one instant to another, both included."""
    return df.filter(F.col(ts).between(instant(df, start, ts), instant(df, end, ts)))


def trailing_year(df: DataFrame, ts: str = TS, by: Sequence[str] = ()) -> DataFrame:
    """Rows at most one year older than the newest row (of each `by` group)."""
    if by:
        latest = df.groupBy(*by).agg(F.max(ts).alias("_newest"))
        joined = df.join(latest, list(by))
        return joined.filter(F.col(ts) >= F.col("_newest") - F.expr("INTERVAL 1 YEAR")).drop("_newest")
    return time_range(df, newest(df, ts) - F.expr("INTERVAL 1 YEAR"), ts=ts)


def previous_days(df: DataFrame, chosen: DataFrame, days: int = 30, ts: str = TS) -> DataFrame:
    """Rows of `df` in the days before the first row of `chosen`."""
    first = chosen.agg(F.min(ts)).scalar()
    return time_range(df, first - F.expr(f"INTERVAL {days} DAY"), first, ts)


def select_metrics(df: DataFrame, metrics: Sequence[str], ts: str = TS) -> DataFrame:
    """The time and the chosen measures; a name that is not there is an error."""
    return df.select(ts, *metrics)


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop the columns that are there."""
    return df.drop(*cols)


LAG_MARKS = ("_lag_",)
ROLLING_MARKS = ("_rolling_", "_pct_change_")


def feature_columns(
    df: DataFrame,
    exclude: Iterable[str] = (),
    without_marks: Iterable[str] = (),
    numeric_only: bool = True,
) -> list[str]:
    """Names of the feature columns: all but the listed ones and the marked families."""
    left_out = set(exclude)
    marks = tuple(without_marks)
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    return [
        name
        for name, kind in df.dtypes
        if name not in left_out
        and not any(m in name for m in marks)
        and (not numeric_only or kind in numeric)
    ]


def feature_families(cols: Iterable[str], categorical: Iterable[str] = ()) -> dict[str, list[str]]:
    """Feature names by the way they are scaled."""
    codes = set(categorical)
    out: dict[str, list[str]] = {"numeric": [], "categorical": [], "lag": [], "rolling": []}
    for c in cols:
        if any(m in c for m in LAG_MARKS):
            out["lag"].append(c)
        elif any(m in c for m in ROLLING_MARKS):
            out["rolling"].append(c)
        elif c in codes:
            out["categorical"].append(c)
        else:
            out["numeric"].append(c)
    return out
