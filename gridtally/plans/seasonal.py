"""Seasonal regression on a differenced series, with moving-average terms, and forecasts many steps ahead.

A series is differenced by row and by season. Its change is regressed on earlier changes, on earlier
surprises and on known inputs. Surprises are not observed: a long regression on earlier changes and the
inputs comes first, and what it does not explain stands for them. Both fits are least squares over all series, one pass
each over rows that carry their lags; nothing is iterated.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.operators.future import tail
from gridtally.operators.ordered import RANK, READINGS, Ordered, Series, lag, over_blocks
from gridtally.plans.training import ridge
from gridtally.session import materialize


def seasonal_difference(col: str, season: int = 24, back: int = 0) -> Ordered:
    """Change from row to row of the change over one season, `back` rows ago."""

    def over(w) -> Column:
        def at(n: int) -> Column:
            return F.lag(col, n + back).over(w) if n + back else F.col(col)

        return (at(0) - at(1)) - (at(season) - at(season + 1))

    return Ordered(season + 1 + back, over)


def _before(col: str, season: int) -> Ordered:
    """What the forecast change is added to."""

    def over(w) -> Column:
        last, season_ago, older = (F.lag(col, n).over(w) for n in (1, season, season + 1))
        return last + season_ago - older

    return Ordered(season + 1, over)


def _least_squares(df: DataFrame, label: str, inputs: Sequence[str]) -> tuple[list[float], float]:
    """Weights and intercept; rows with a gap in any input are left out."""
    known = df.select(label, *inputs).dropna()
    if not inputs:
        return [], float(known.agg(F.avg(label)).first()[0] or 0.0)
    vectors = VectorAssembler(inputCols=list(inputs), outputCol="_inputs").transform(known)
    fitted = ridge(label, 0.0).setFeaturesCol("_inputs").fit(vectors)
    return [float(c) for c in fitted.coefficients], float(fitted.intercept)


def _weighted(weights: Sequence[float], inputs: Sequence[str], intercept: float) -> Column:
    out = F.lit(intercept)
    for weight, name in zip(weights, inputs):
        out = out + F.col(name) * weight
    return out


@dataclass(frozen=True)
class SeasonalModel:
    """Weights of earlier changes (`ar`), earlier surprises (`ma`) and inputs (`exog`); `long` explains the changes first."""

    col: str
    season: int
    ar: tuple[int, ...]
    ma: tuple[int, ...]
    exog: tuple[str, ...]
    long: tuple[int, ...]
    long_weights: tuple[float, ...]
    long_intercept: float
    weights: tuple[float, ...]
    intercept: float

    @property
    def history(self) -> int:
        """Rows of a series that its first forecast rests on."""
        surprise = max(self.ma) + max(self.long) if self.ma else 0
        return self.season + 1 + max(max(self.ar, default=0), surprise)


def _with_lags(
    df: DataFrame, col: str, season: int, ar: Sequence[int], ma: Sequence[int], long: Sequence[int], exog: Sequence[str],
    series: Series, train: Column | None, model: SeasonalModel | None = None,
) -> tuple[DataFrame, list[float], float]:
    """The rows with their change, what to add it to, and lags of changes and surprises; the long fit."""
    parts = {"_change": seasonal_difference(col, season), "_before": _before(col, season)}
    rows = materialize(over_blocks(df.withColumn("_train", F.lit(True) if train is None else train), parts, series), "changes")
    names = {f"_ar_{n}": lag("_change", n) for n in ar}
    weights: list[float] = []
    intercept = 0.0
    if ma:
        inputs = [*[f"_long_{n}" for n in long], *exog]
        explained = over_blocks(rows, {f"_long_{n}": lag("_change", n) for n in long}, series)
        if model is None:
            weights, intercept = _least_squares(explained.filter("_train"), "_change", inputs)
        else:
            weights, intercept = list(model.long_weights), model.long_intercept
        surprise = F.col("_change") - _weighted(weights, inputs, intercept)
        rows = materialize(explained.select(*rows.columns, surprise.alias("_surprise")), "surprises")
        names |= {f"_ma_{n}": lag("_surprise", n) for n in ma}
    return (over_blocks(rows, names, series) if names else rows), weights, intercept


def fit_seasonal(
    df: DataFrame,
    col: str,
    exog: Sequence[str] = (),
    season: int = 24,
    ar: Sequence[int] | None = None,
    ma: Sequence[int] | None = None,
    long: Sequence[int] | None = None,
    train: Column | None = None,
    series: Series = READINGS,
) -> SeasonalModel:
    """Fit on the rows that `train` tells, by default on all; `df` needs positions.

    `ar` and `ma` are how many rows back changes and surprises count, by default one row and one season;
    `long` those of the first regression, by default all up to a season and a row. Rows whose lags reach
    before the start of their series are not fitted on.
    """
    ar = (1, season) if ar is None else tuple(ar)
    ma = (1, season) if ma is None else tuple(ma)
    long = tuple(range(1, season + 2)) if long is None else tuple(long)
    rows, long_weights, long_intercept = _with_lags(df, col, season, ar, ma, long, exog, series, train)
    inputs = [*[f"_ar_{n}" for n in ar], *[f"_ma_{n}" for n in ma], *exog]
    weights, intercept = _least_squares(materialize(rows.filter("_train").select("_change", *inputs), "inputs"), "_change", inputs)
    return SeasonalModel(col, season, ar, ma, tuple(exog), long, tuple(long_weights), long_intercept, tuple(weights), intercept)


def one_step(df: DataFrame, model: SeasonalModel, series: Series = READINGS) -> DataFrame:
    """Add `prediction`: each row's value as expected from the rows before it; null where they do not reach."""
    rows, _, _ = _with_lags(df, model.col, model.season, model.ar, model.ma, model.long, model.exog, series, None, model)
    inputs = [*[f"_ar_{n}" for n in model.ar], *[f"_ma_{n}" for n in model.ma], *model.exog]
    expected = F.col("_before") + _weighted(model.weights, inputs, model.intercept)
    return rows.select(*df.columns, expected.alias("prediction"))


def _continued(model: SeasonalModel, past: np.ndarray, seen: np.ndarray, steps: int, inputs: np.ndarray | None) -> np.ndarray:
    """Forecasts after `past`, with the inputs `seen` there, each from the ones before it; the cost grows with the steps alone."""
    season, n = model.season, len(past)
    y = np.concatenate((past, np.empty(steps)))
    change = np.full(n + steps, np.nan)
    surprise = np.zeros(n + steps)
    change[season + 1 : n] = (past[season + 1 :] - past[season:-1]) - (past[1 : n - season] - past[: n - season - 1])
    if model.ma:
        for t in range(season + 1 + max(model.long), n):
            lags = np.concatenate((change[t - np.array(model.long)], seen[t]))
            surprise[t] = change[t] - model.long_intercept - np.array(model.long_weights) @ lags
    split = len(model.ar), len(model.ar) + len(model.ma)
    ar, ma, extra = (np.array(w) for w in (model.weights[: split[0]], model.weights[split[0] : split[1]], model.weights[split[1] :]))
    back, missed = np.array(model.ar, int), np.array(model.ma, int)
    for t in range(n, n + steps):
        change[t] = model.intercept + ar @ change[t - back] + ma @ surprise[t - missed]
        if inputs is not None:
            change[t] += extra @ inputs[t - n]
        y[t] = y[t - 1] + y[t - season] - y[t - season - 1] + change[t]
    return y[n:]


def ahead(
    df: DataFrame, model: SeasonalModel, steps: int, future: DataFrame | None = None, series: Series = READINGS
) -> DataFrame:
    """Forecasts beyond the end of every series: the keys, `step` from 1, `prediction`.

    With inputs (`exog`), `future` holds them row by row in the series' order, and a series goes as far as
    its future rows, at most `steps`. Only the last rows of a series that the model looks back to are read;
    a series that is shorter, or has gaps there, is left out.
    """
    need = model.history
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    order = list(series.order)
    inputs_seen = [F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(model.exog)]
    ends = tail(df.select(*series.keys, *order, F.col(model.col).cast("double").alias("_y"), *inputs_seen), need, series)
    schema = ", ".join([*[f"`{k}` {kinds[k]}" for k in series.keys], "step int", "prediction double"])
    keys = list(series.keys) or ["_all"]

    def run(end: pd.DataFrame, known: pd.DataFrame | None) -> pd.DataFrame:
        end = end.sort_values(RANK, ascending=False)
        past = end["_y"].to_numpy(dtype=float)
        seen = end[[f"_x{i}" for i in range(len(model.exog))]].to_numpy(dtype=float)
        inputs = None if known is None else known.sort_values(order)[list(model.exog)].to_numpy(dtype=float)[:steps]
        n = steps if inputs is None else len(inputs)
        if len(past) < need or np.isnan(past).any() or np.isnan(seen).any():
            n = 0
        out = pd.DataFrame({"step": np.arange(1, n + 1, dtype=np.int32), "prediction": _continued(model, past, seen, n, inputs) if n else np.zeros(0)})
        for k in reversed(series.keys):
            out.insert(0, k, end[k].iloc[0] if len(end) else None)
        return out

    # one short tail, and one horizon, per series
    grouped = (ends if series.keys else ends.withColumn("_all", F.lit(0))).groupBy(*keys)
    if not model.exog:
        return grouped.applyInPandas(lambda end: run(end, None), schema)
    if future is None:
        raise ValueError("the model needs future rows with its inputs")
    rows = future.select(*series.keys, *order, *[F.col(c).cast("double").alias(c) for c in model.exog])
    rows = rows if series.keys else rows.withColumn("_all", F.lit(0))
    # columns of their own, as both tables may come from one
    rows = rows.toDF(*rows.columns)
    return grouped.cogroup(rows.groupBy(*keys)).applyInPandas(lambda end, known: run(end, known), schema)


def seasonal_ar(
    df: DataFrame,
    col: str,
    exog: Sequence[str] = (),
    season: int = 24,
    train: Column | None = None,
    series: Series = READINGS,
) -> DataFrame:
    """One-step forecasts by regression of the change on itself one row and one season ago and on `exog`.

    `df` needs positions; `train` tells the rows to fit on. Rows without a forecast are left out.
    """
    model = fit_seasonal(df, col, exog, season, ma=(), train=train, series=series)
    return one_step(df, model, series).dropna(subset=["prediction"])


def seasonal_ar_ahead(
    df: DataFrame, col: str, steps: int, season: int = 24, series: Series = READINGS
) -> DataFrame:
    """Forecasts `steps` rows beyond the end of every series, without surprises and inputs; `df` needs positions."""
    return ahead(df, fit_seasonal(df, col, season=season, ma=(), series=series), steps, series=series)
