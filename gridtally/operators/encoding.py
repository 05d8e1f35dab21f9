"""Category codes, target means, scaling and filling.

`fit_*` reads the training frame once and returns constants or a small mapping frame; applying them
is a projection or an equi-join, the same for training rows, future rows and streams.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtally.operators.ordered import Series, with_position
from gridtally.operators.quantiles import exact_quantiles


def fit_labels(df: DataFrame, col: str) -> DataFrame:
    """Each distinct value with its place in sorted order, from 0."""
    code = f"{col}_encoded"
    distinct = df.select(col).filter(F.col(col).isNotNull()).distinct()
    placed = with_position(distinct, Series(keys=(), order=(col,)), code)
    return placed.select(col, F.col(code).cast("int"))


def label_encode(df: DataFrame, labels: DataFrame, col: str) -> DataFrame:
    """Add the value's code; a value the labels do not know is an error."""
    code = f"{col}_encoded"
    message = F.concat(F.lit(f"{col} was not seen in training: "), F.col(col).cast("string"))
    return df.join(labels, col, "left").withColumn(
        code, F.when(F.col(code).isNull(), F.raise_error(message)).otherwise(F.col(code)).cast("int")
    )


def _smoothed(total: Column, count: Column, global_mean: Column, smoothing: float) -> Column:
    """Group mean pulled towards the global mean, by a logistic weight of the group's size."""
    weight = 1 / (1 + F.exp(F.lit(float(smoothing)) - count))
    return global_mean * (1 - weight) + total / count * weight


def _mean_of(sums: DataFrame) -> Column:
    """The overall mean from group sums; it shares their shuffle instead of reading the rows again."""
    return sums.agg(F.try_divide(F.sum("_sum"), F.sum("_n"))).scalar()


def fit_target_means(
    train: DataFrame, col: str, target: str, smoothing: float = 10
) -> DataFrame:
    """Each category with its smoothed target mean, as `<col>_te`."""
    sums = train.groupBy(col).agg(F.sum(target).alias("_sum"), F.count(target).alias("_n"))
    return sums.select(
        col,
        _smoothed(F.col("_sum"), F.col("_n"), _mean_of(sums), smoothing).alias(f"{col}_te"),
    )


def target_encode(
    df: DataFrame, means: DataFrame, col: str, default: Column | None = None
) -> DataFrame:
    """Add the category's mean; an unknown category gets null or the default."""
    out = df.join(means, col, "left")
    if default is not None:
        out = out.withColumn(f"{col}_te", F.coalesce(f"{col}_te", default))
    return out


def target_encode_oof(
    train: DataFrame,
    col: str,
    target: str,
    fold: Column,
    smoothing: float = 10,
) -> DataFrame:
    """Encode every training row from the rows of the other folds only.

    Rows without a category form one of their own. The sums of (category, fold) are small; the other folds' sums are the category's totals minus
    the fold's own, so the readings are aggregated once and not once per fold.
    """
    folded = train.withColumn("_fold", fold)
    own = folded.groupBy(col, "_fold").agg(
        F.sum(target).alias("_sum"), F.count(target).alias("_n")
    )
    global_mean = _mean_of(own)
    category = Window.partitionBy(col)
    others = own.select(
        col,
        "_fold",
        (F.sum("_sum").over(category) - F.col("_sum")).alias("_sum"),
        (F.sum("_n").over(category) - F.col("_n")).alias("_n"),
    )
    value = F.when(
        F.col("_n") > 0, _smoothed(F.col("_sum"), F.col("_n"), global_mean, smoothing)
    ).otherwise(global_mean)
    means = others.select(F.col(col).alias("_key"), F.col("_fold").alias("_of"), value.alias(f"{col}_te"))
    same = F.col(col).eqNullSafe(F.col("_key")) & (F.col("_fold") == F.col("_of"))
    return folded.join(means, same, "left").drop("_fold", "_key", "_of")


@dataclass(frozen=True)
class Scaling:
    """(x - center) / width per column; applied and undone by plain expressions."""

    center: Mapping[str, float]
    width: Mapping[str, float]

    def scaled(self, col: str) -> Column:
        return (F.col(col) - F.lit(self.center[col])) / F.lit(self.width[col])

    def unscaled(self, col: str, value: Column | None = None) -> Column:
        x = F.col(col) if value is None else value
        return x * F.lit(self.width[col]) + F.lit(self.center[col])

    def scale(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self.scaled(c) for c in self.center})

    def invert(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self.unscaled(c) for c in self.center})


def _scaling(center: dict[str, float | None], width: dict[str, float | None]) -> Scaling:
    """A column without spread, or without values, is only shifted."""
    return Scaling(
        {c: 0.0 if v is None else v for c, v in center.items()},
        {c: v if v else 1.0 for c, v in width.items()},
    )


def fit_robust(df: DataFrame, cols: Sequence[str]) -> Scaling:
    """Median and interquartile range, exact."""
    found = exact_quantiles(df, {c: (0.25, 0.5, 0.75) for c in cols})
    return _scaling(
        {c: q[1] for c, q in found.items()},
        {c: None if q[0] is None else q[2] - q[0] for c, q in found.items()},
    )


def _fit(df: DataFrame, **stats: Mapping[str, Column]) -> list[dict[str, float | None]]:
    """Several statistics of several columns in one pass over the data."""
    row = df.agg(
        *[value.cast("double").alias(f"{s}:{c}") for s, cols in stats.items() for c, value in cols.items()]
    ).first()
    return [{c: row[f"{s}:{c}"] for c in cols} for s, cols in stats.items()]


def fit_standard(df: DataFrame, cols: Sequence[str]) -> Scaling:
    """Mean and population standard deviation."""
    return _scaling(
        *_fit(df, mean={c: F.avg(c) for c in cols}, std={c: F.stddev_pop(c) for c in cols})
    )


def fit_minmax(df: DataFrame, cols: Sequence[str]) -> Scaling:
    low, span = _fit(
        df, low={c: F.min(c) for c in cols}, span={c: F.max(c) - F.min(c) for c in cols}
    )
    return _scaling(low, span)


def fit_families(df: DataFrame, families: Mapping[str, Sequence[str]]) -> Scaling:
    """Numeric and rolling columns by quartiles, codes by deviation, lags by range."""
    robust = [*families.get("numeric", ()), *families.get("rolling", ())]
    fits = [
        fit(df, cols)
        for fit, cols in (
            (fit_robust, robust),
            (fit_standard, list(families.get("categorical", ()))),
            (fit_minmax, list(families.get("lag", ()))),
        )
        if cols
    ]
    return Scaling(
        {c: v for f in fits for c, v in f.center.items()},
        {c: v for f in fits for c, v in f.width.items()},
    )


def assemble(df: DataFrame, cols: Sequence[str], name: str = "features") -> DataFrame:
    """Add the columns as one ML vector; nulls are an error, so fill them first."""
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(cols), outputCol=name).transform(df)


def replace_nonfinite(
    df: DataFrame, cols: Iterable[str], value: float = 0.0, cap: float | None = None
) -> DataFrame:
    """Null and NaN become `value`; infinities become `value`, or plus and minus `cap`."""
    out = {}
    for c in cols:
        x, high = F.col(c), float("inf")
        up, down = (value, value) if cap is None else (cap, -cap)
        out[c] = (
            F.when(x.isNull() | F.isnan(x), F.lit(value))
            .when(x == F.lit(high), F.lit(up))
            .when(x == F.lit(-high), F.lit(down))
            .otherwise(x)
        )
    return df.withColumns(out)


def fit_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    found = exact_quantiles(df, {c: (0.5,) for c in cols})
    return {c: q[0] for c, q in found.items() if q[0] is not None}


def fit_means(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    (means,) = _fit(df, mean={c: F.avg(c) for c in cols})
    return {c: m for c, m in means.items() if m is not None}


def impute(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    """Fill nulls and NaN of each column with its value; add the columns that are missing."""
    return df.withColumns(
        {
            c: F.when(F.col(c).isNull() | F.isnan(F.col(c)), F.lit(v)).otherwise(F.col(c))
            if c in df.columns
            else F.lit(v)
            for c, v in values.items()
        }
    )


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.fillna(0, subset=list(cols))


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=None if subset is None else list(subset))


def log_target(col: str) -> Column:
    return F.log1p(col)


def unlog(col: str) -> Column:
    return F.expm1(col)


def clip_floor(df: DataFrame, col: str, floor: float = 0.0) -> DataFrame:
    return df.withColumn(
        col, F.when(F.col(col).isNotNull(), F.greatest(F.col(col), F.lit(floor)))
    )


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Nulls of each column and of all of them, from one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    total = sum((F.col(c) for c in cols), F.lit(0))
    entry = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in cols]
    entry.append(F.struct(F.lit("(all)").alias("column_name"), total.alias("nulls")))
    return counts.select(F.inline(F.array(*entry)))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles, one row per column."""
    quartiles = exact_quantiles(df, {c: (0.25, 0.5, 0.75) for c in cols})
    aggs = []
    for c in cols:
        aggs.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("n"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("min"),
                *[F.lit(q).cast("double").alias(n) for q, n in zip(quartiles[c], ("q25", "q50", "q75"))],
                F.max(c).cast("double").alias("max"),
            ).alias(c)
        )
    return df.agg(*aggs).select(F.inline(F.array(*[F.col(c) for c in cols])))
