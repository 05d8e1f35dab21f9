"""Lag and rolling features of rows whose own past is not measured yet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.operators.ordered import (
    POSITION,
    RANK,
    READINGS,
    Ordered,
    Rolling,
    Series,
    over_blocks,
    sequences,
    tail,
    with_position,
)
from gridtally.operators.relational import union_history

_STATISTICS = {"mean": F.avg, "std": F.stddev_samp, "max": F.max, "min": F.min}


def _attach(future: DataFrame, per_series: DataFrame, series: Series) -> DataFrame:
    """Add a series' values to each of its rows."""
    if series.keys:
        return future.join(per_series, list(series.keys), "left")
    row = per_series.select(F.struct("*")).scalar()
    return future.withColumn("_row", row).select(*future.columns, "_row.*")


def _back(col: str, n: int) -> Column:
    """The value n rows before the end; 1 is the last one."""
    return F.max(F.when(F.col(RANK) == n, F.col(col)))


def future_last_lag(
    train: DataFrame,
    future: DataFrame,
    cols: Sequence[str],
    steps: Sequence[int],
    series: Series = READINGS,
) -> DataFrame:
    """Every future row gets the value n rows before the end of training."""
    ends = tail(train, max(steps), series).groupBy(*series.keys).agg(
        *[_back(c, n).alias(f"{c}_lag_{n}") for c in cols for n in steps]
    )
    return _attach(future, ends, series)


def _tail_statistics(
    train: DataFrame, cols: Sequence[str], windows: Sequence[int], series: Series, full: bool
) -> DataFrame:
    aggs = []
    for c in cols:
        for w in windows:
            value = F.when(F.col(RANK) <= w, F.col(c))
            for name, statistic in _STATISTICS.items():
                result = statistic(value)
                if full:
                    result = F.when(F.count(value) == w, result)
                aggs.append(result.alias(f"{c}_rolling_{name}_{w}"))
    return tail(train, max(windows), series).groupBy(*series.keys).agg(*aggs)


def future_last_rolling(
    train: DataFrame,
    future: DataFrame,
    cols: Sequence[str],
    windows: Sequence[int],
    series: Series = READINGS,
) -> DataFrame:
    """Every future row gets the last rolling statistics of training, null if it is too short."""
    return _attach(future, _tail_statistics(train, cols, windows, series, full=True), series)


def future_tail_stats(
    train: DataFrame,
    future: DataFrame,
    cols: Sequence[str],
    windows: Sequence[int],
    series: Series = READINGS,
) -> DataFrame:
    """Statistics of the last rows of training, or of all its rows if there are fewer."""
    return _attach(future, _tail_statistics(train, cols, windows, series, full=False), series)


def future_tail_change(
    train: DataFrame,
    future: DataFrame,
    cols: Sequence[str],
    steps: Sequence[int],
    series: Series = READINGS,
) -> DataFrame:
    """Difference and relative change between the last row of training and n rows before it."""
    aggs = []
    for c in cols:
        for n in steps:
            change = _back(c, 1) - _back(c, n + 1)
            aggs += [
                change.alias(f"{c}_diff_{n}"),
                F.try_divide(change, _back(c, n + 1)).alias(f"{c}_pct_change_{n}"),
            ]
    ends = tail(train, max(steps) + 1, series).groupBy(*series.keys).agg(*aggs)
    return _attach(future, ends, series)


def future_tiled_lag(
    train: DataFrame,
    future: DataFrame,
    cols: Sequence[str],
    steps: Sequence[int],
    series: Series = READINGS,
) -> DataFrame:
    """The last n values of training, repeated over the future rows in their order.

    `future` needs positions. A series shorter than n gives its mean.
    """
    ends = tail(train, max(steps), series).groupBy(*series.keys).agg(
        F.sort_array(F.collect_list(F.struct(-F.col(RANK), *cols))).alias("_tail"),
        *[F.avg(c).alias(f"_mean_{c}") for c in cols],
    )
    out = _attach(future, ends, series)
    have = F.size("_tail")
    values = {}
    for c in cols:
        for n in steps:
            place = (have - n + F.pmod(F.col(POSITION), F.lit(n)) + 1).cast("int")
            repeated = F.get(F.col("_tail"), place - 1)[c]
            values[f"{c}_lag_{n}"] = F.when(have >= n, repeated).otherwise(F.col(f"_mean_{c}"))
    return out.withColumns(values).drop("_tail", *[f"_mean_{c}" for c in cols])


def _reachable(
    train: DataFrame, future: DataFrame, rows: int, series: Series
) -> DataFrame:
    """The training rows that can be within `rows` rows before some future row of their series."""
    lead = series.order[0]
    starts = future.groupBy(*series.keys).agg(F.min(lead).alias("_start"))
    dated = (
        train.join(starts, list(series.keys))
        if series.keys
        else train.withColumn("_start", starts.scalar())
    )
    earlier = tail(dated.filter(F.col(lead) < F.col("_start")), rows, series).drop(RANK)
    return earlier.unionByName(dated.filter(F.col(lead) >= F.col("_start"))).drop("_start")


def lags_across(
    train: DataFrame,
    future: DataFrame,
    values: Mapping[str, Ordered | Rolling],
    series: Series = READINGS,
) -> DataFrame:
    """Ordered values of the future rows, computed over training and future rows together.

    A column the future rows lack, such as the target, is null there.
    """
    reach = max(v.reach for v in values.values())
    both = union_history(_reachable(train, future, reach, series), future, "_future")
    out = over_blocks(with_position(both, series), values, series)
    return out.filter(F.col("_future") == 1).drop("_future", POSITION)


def future_sequences(
    train: DataFrame,
    future: DataFrame,
    features: Sequence[str],
    steps: int,
    series: Series = READINGS,
) -> DataFrame:
    """The `steps` rows before each future row, the first ones taken from training."""
    cols = list(dict.fromkeys([*series.keys, *series.order, *features]))
    both = union_history(
        _reachable(train.select(*cols), future.select(*cols), steps, series),
        future.select(*cols),
        "_future",
    )
    out = sequences(with_position(both, series), features, steps, "_future", series=series)
    return out.filter(F.col("_future") == 1).drop("_future", POSITION)
