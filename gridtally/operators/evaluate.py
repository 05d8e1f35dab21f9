"""Scores of predictions, and combining them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _r2(y: Column, p: Column) -> Column:
    """1 - squared errors / squared deviations, over rows with both values."""
    both = y.isNotNull() & p.isNotNull()
    deviation = F.var_pop(F.when(both, y)) * F.count_if(both)
    return 1 - F.try_divide(F.sum((y - p) * (y - p)), deviation)


def metrics(
    df: DataFrame,
    y: str,
    models: Sequence[str],
    by: Sequence[str] = (),
    logged: bool = False,
) -> DataFrame:
    """MAE, MSE, RMSE and R² of each model's column; `logged` undoes a log1p target first."""

    def value(c: str) -> Column:
        return F.expm1(c) if logged else F.col(c)

    aggs = []
    for m in models:
        error = value(y) - value(m)
        aggs.append(
            F.struct(
                F.lit(m).alias("model"),
                F.avg(F.abs(error)).alias("mae"),
                F.avg(error * error).alias("mse"),
                F.sqrt(F.avg(error * error)).alias("rmse"),
                _r2(value(y), value(m)).alias("r2"),
            ).alias(m)
        )
    return df.groupBy(*by).agg(*aggs).select(*by, F.inline(F.array(*[F.col(m) for m in models])))


def cv_summary(fold_metrics: DataFrame) -> DataFrame:
    """Mean and population deviation of the folds' MAE per model."""
    return fold_metrics.groupBy("model").agg(
        F.avg("mae").alias("mean_mae"), F.stddev_pop("mae").alias("std_mae")
    )


def mean_ensemble(df: DataFrame, models: Sequence[str], name: str = "prediction") -> DataFrame:
    return df.withColumn(name, sum((F.col(m) for m in models), F.lit(0.0)) / len(models))


def ensemble_weights(df: DataFrame, y: str, models: Sequence[str]) -> DataFrame:
    """One row with a weight per model: its share of the positive R², or equal shares."""
    positive = [F.greatest(F.coalesce(F.col(m), F.lit(0.0)), F.lit(0.0)) for m in models]
    total = sum(positive, F.lit(0.0))
    return df.agg(*[_r2(F.col(y), F.col(m)).alias(m) for m in models]).select(
        *[
            F.when(total > 0, F.try_divide(p, total)).otherwise(F.lit(1 / len(models))).alias(m)
            for m, p in zip(models, positive)
        ]
    )


def weighted_ensemble(
    df: DataFrame, weights: DataFrame, models: Sequence[str], name: str = "prediction"
) -> DataFrame:
    """Weighted sum of the models' columns; the weights come from a validation frame."""
    w = weights.select(F.struct(*models)).scalar()
    return (
        df.withColumn("_w", w)
        .withColumn(name, sum((F.col(m) * F.col(f"_w.{m}") for m in models), F.lit(0.0)))
        .drop("_w")
    )


def prediction_summary(df: DataFrame, col: str = "prediction") -> DataFrame:
    return df.agg(F.min(col).alias("min"), F.max(col).alias("max"), F.avg(col).alias("mean"))
