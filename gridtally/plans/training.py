"""Models: fitting, folds, stacking, tuning, saving. All fits are Spark ML jobs."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.operators.evaluate import metrics
from gridtally.operators.splits import Fold

FEATURES = "features"


def boosted_trees(
    label: str,
    rounds: int = 20,
    depth: int = 5,
    step: float = 0.1,
    subsample: float = 0.8,
    columns: str = "0.8",
    stop_on: str | None = None,
    seed: int = 42,
) -> GBTRegressor:
    """Gradient-boosted trees; `stop_on` names a boolean column whose rows stop the rounds early."""
    model = GBTRegressor(
        labelCol=label,
        featuresCol=FEATURES,
        maxIter=rounds,
        maxDepth=depth,
        stepSize=step,
        subsamplingRate=subsample,
        featureSubsetStrategy=columns,
        seed=seed,
    )
    return model.setValidationIndicatorCol(stop_on) if stop_on else model


def random_forest(
    label: str, trees: int = 20, depth: int = 8, leaf_rows: int = 1, seed: int = 42
) -> RandomForestRegressor:
    return RandomForestRegressor(
        labelCol=label,
        featuresCol=FEATURES,
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=leaf_rows,
        seed=seed,
    )


def ridge(label: str, strength: float = 1.0) -> LinearRegression:
    """Linear regression with a squared penalty; strength 0 is plain least squares."""
    return LinearRegression(
        labelCol=label, featuresCol=FEATURES, regParam=strength, elasticNetParam=0.0
    )


# Models that are fitted at the same time.
FITS_AT_ONCE = 3
_READ = ("featuresCol", "labelCol", "weightCol", "validationIndicatorCol")


@contextmanager
def _computed_once(train: DataFrame, models: Iterable[Estimator]) -> Iterator[DataFrame]:
    """The columns that the models read, on the executors' disks until all are fitted.

    Each model reads its rows several times, and would else compute them as often. Memory is left to the models, and
    rows keep their partitions and order, which what a model draws depends on.
    """
    read = {m.getOrDefault(p) for m in models for p in m.params if p.name in _READ and m.isDefined(p)}
    kept = train.select(*[F.col(f"`{c}`") for c in train.columns if c in read]).persist(StorageLevel.DISK_ONLY)
    try:
        kept.count()
        yield kept
    finally:
        kept.unpersist()


def fit_all(train: DataFrame, models: Mapping[str, Estimator]) -> dict[str, Model]:
    """Fit every model on rows computed once, some at a time; each writes its predictions to a column of its own name.

    A fit is a chain of short jobs, so the tasks of one fill the cores that those of another leave idle.
    """
    with _computed_once(train, models.values()) as rows, ThreadPoolExecutor(FITS_AT_ONCE) as pool:
        fit = inheritable_thread_target(train.sparkSession)(lambda name: models[name].copy().setPredictionCol(name).fit(rows))
        return dict(zip(models, pool.map(fit, models)))


def predict_all(df: DataFrame, fitted: Mapping[str, Model]) -> DataFrame:
    """All models' predictions next to each other, without a join."""
    return reduce(lambda out, model: model.transform(out), fitted.values(), df)


def oof_predictions(
    df: DataFrame,
    models: Mapping[str, Estimator],
    folds: Sequence[tuple[DataFrame, DataFrame]] | Sequence[Fold],
    keep: Sequence[str],
    future: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Predict each validation row by models that never saw it.

    `df` is read once per model and fold, so hand in a written table. Rows of `future` get the
    mean of the fold models' predictions.
    """
    parts, ahead = [], future
    for i, fold in enumerate(folds):
        train, held_out = (
            (fold.train(df), fold.validation(df)) if isinstance(fold, Fold) else fold
        )
        fitted = fit_all(train, models)
        parts.append(
            predict_all(held_out, fitted).select(*keep, F.lit(i).alias("fold"), *models)
        )
        if ahead is not None:
            ahead = predict_all(ahead, fitted).withColumnsRenamed(
                {name: f"_{name}_{i}" for name in models}
            )
    if ahead is not None:
        means = {
            name: sum((F.col(f"_{name}_{i}") for i in range(len(folds))), F.lit(0.0)) / len(folds)
            for name in models
        }
        ahead = ahead.select(*future.columns, *[v.alias(n) for n, v in means.items()])
    return reduce(DataFrame.unionByName, parts), ahead


def kfold_frames(df: DataFrame, fold: Column, folds: int) -> list[tuple[DataFrame, DataFrame]]:
    return [(df.filter(fold != i), df.filter(fold == i)) for i in range(folds)]


def stack(
    oof: DataFrame,
    label: str,
    models: Sequence[str],
    meta: Estimator | None = None,
    name: str = "prediction",
) -> PipelineModel:
    """A model over the base models' out-of-fold predictions."""
    assembler = VectorAssembler(inputCols=list(models), outputCol="base")
    meta = (meta or ridge(label, 0.0)).copy().setFeaturesCol("base").setPredictionCol(name)
    fitted = meta.fit(assembler.transform(oof.select(label, *models)))
    return PipelineModel([assembler, fitted])


def multi_target(
    train: DataFrame, future: DataFrame, targets: Sequence[str], model: Estimator
) -> DataFrame:
    """One model per measure on the same feature vectors, computed once; predictions take the measures' names."""
    models = {f"_predicted_{t}": model.copy().setLabelCol(t) for t in targets}
    fitted = fit_all(train, models)
    return (
        predict_all(future, fitted)
        .drop(*targets)
        .withColumnsRenamed({f"_predicted_{t}": t for t in targets})
    )


def feature_importance(spark: SparkSession, model: Model, names: Sequence[str]) -> DataFrame:
    weights = model.featureImportances.toArray().tolist()
    return spark.createDataFrame(
        list(zip(names, weights)), "feature string, importance double"
    )


def tune(
    df: DataFrame,
    model: Estimator,
    grid: Sequence[Mapping[Param, object]],
    folds: Sequence[Fold],
    label: str,
) -> tuple[Mapping[Param, object], DataFrame]:
    """The grid entry with the least mean error over the folds, and all entries' errors."""
    spark = df.sparkSession
    rows = []
    for i, entry in enumerate(grid):
        for fold in folds:
            fitted = model.copy(dict(entry)).setPredictionCol("candidate").fit(fold.train(df))
            scored = fitted.transform(fold.validation(df))
            mae = metrics(scored, label, ["candidate"]).first().mae
            rows.append((i, ", ".join(f"{p.name}={v}" for p, v in entry.items()), fold.number, mae))
    errors = spark.createDataFrame(rows, "entry int, settings string, fold int, mae double")
    totals = [sum(r[3] for r in rows if r[0] == i) for i in range(len(grid))]
    return grid[totals.index(min(totals))], errors


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
