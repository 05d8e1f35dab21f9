"""From readings to a forecast: features, outliers, encodings, scaling, models, combination."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.functions.calendar import (
    calendar_parts,
    cyclic_parts,
    day_period,
    is_weekend,
    quarter_index,
)
from gridtally.operators.encoding import (
    Scaling,
    assemble,
    clip_floor,
    fit_labels,
    fit_medians,
    fit_target_means,
    impute,
    label_encode,
    log_target,
    replace_nonfinite,
    target_encode,
    unlog,
)
from gridtally.operators.evaluate import ensemble_weights, mean_ensemble, metrics, weighted_ensemble
from gridtally.operators.filters import feature_families
from gridtally.operators.future import lags_across
from gridtally.operators.isolation import isolation_marks
from gridtally.operators.ordered import (
    POSITION,
    READINGS,
    Ordered,
    Rolling,
    Series,
    lags,
    over_blocks,
    pct_change_before,
    rolling_before,
    with_position,
)
from gridtally.operators.pricing import unit_price
from gridtally.operators.splits import Fold, time_folds
from gridtally.operators.timefolds import (
    even_edges,
    fold_bounds,
    fold_scalings,
    inside_bounds,
    target_encode_by_time,
)
from gridtally.plans.training import (
    boosted_trees,
    fit_all,
    multi_target,
    oof_predictions,
    predict_all,
    random_forest,
    ridge,
    stack,
)
from gridtally.schema import COST, MEASURES, READING_ID, TS, WORK_TYPE
from gridtally.session import materialize, passing_copies

CODED = (WORK_TYPE, "day_period")
TARGET_CODED = (WORK_TYPE, "hour", "weekday", "band")
CATEGORICAL = (
    f"{WORK_TYPE}_encoded",
    "day_period_encoded",
    "year",
    "month",
    "day",
    "hour",
    "minute",
    "weekday",
    "weekend",
    "quarter",
)


# How far a rank may be off when features are scaled, as a share of the rows.
SCALE_ERROR = 1e-4


@dataclass(frozen=True)
class Settings:
    """What a forecast is made of.

    `outliers`: rows that no model is fitted on, by the target's quartiles ("iqr"), by isolation
    ("isolation"), by both ("combined") or none. `blocks` per fold are the steps in which category means
    learn of the past. `held_out` is the last share of the training rows, which the scores are taken on;
    with `refit` the models that predict have seen it as well.
    """

    target: str = COST
    lags: tuple[int, ...] = (1, 24, 168)
    windows: tuple[int, ...] = (24, 168)
    medians: tuple[int, ...] = (24,)
    changes: tuple[int, ...] = (1, 24)
    folds: int = 5
    blocks: int = 4
    outliers: str = "combined"
    contamination: float = 0.1
    held_out: float = 0.2
    refit: bool = True
    combine: str = "stack"
    rounds: int = 10
    trees: int = 10
    depth: int = 5
    series: Series = READINGS


def row_features(df: DataFrame) -> DataFrame:
    """Everything a row's own time, work type and tariff tell."""
    return unit_price(
        df.withColumns(
            {
                **calendar_parts(TS),
                **cyclic_parts(TS),
                "weekend": is_weekend(TS),
                "quarter": quarter_index(TS),
                "day_period": day_period(TS),
            }
        )
    )


def past_features(settings: Settings) -> dict[str, Ordered | Rolling]:
    """Lags of the target, and statistics and changes of the rows strictly before: no row sees its own target."""
    target = settings.target
    statistics = {
        f"{target}_rolling_{s}_{w}": rolling_before(target, w, s)
        for w in settings.windows
        for s in ("mean", "std", "max", "min")
    }
    statistics |= {f"{target}_rolling_median_{w}": rolling_before(target, w, "median") for w in settings.medians}
    changes = {f"{target}_pct_change_{n}": pct_change_before(target, n) for n in settings.changes}
    return {**lags([target], settings.lags), **statistics, **changes}


@dataclass(frozen=True)
class Prepared:
    """Training rows in their order of time and future rows, with unscaled features.

    `fits` tells the training rows that models may be fitted on; the last of `folds` is the held-out share.
    """

    known: DataFrame
    ahead: DataFrame
    names: list[str]
    keep: list[str]
    measured: list[str]
    fits: Column
    folds: list[Fold]

    @property
    def families(self) -> dict[str, list[str]]:
        return feature_families(self.names, CATEGORICAL)

    def scaled(self, df: DataFrame, scaling: Scaling, *more: str) -> DataFrame:
        """The rows with one vector of scaled features."""
        values = [scaling.scaled(c).alias(c) for c in self.names]
        return assemble(df.select(*self.keep, *more, *values), self.names).drop(*self.names)

    def whole(self) -> tuple[DataFrame, DataFrame]:
        """All rows that may be fitted on, and the future rows, scaled alike."""
        everything = Fold(len(self.folds), self.folds[-1].end, self.folds[-1].end, self.folds[-1].end)
        (scaling,) = fold_scalings(self.known, self.families, [everything], self.fits, SCALE_ERROR)
        known = self.scaled(self.known.filter(self.fits), scaling, *self.measured, "label", POSITION)
        return known, self.scaled(self.ahead, scaling)

    def frames(self) -> list[tuple[DataFrame, DataFrame]]:
        """For each fold the rows to fit on and the rows to predict, scaled as the rows to fit on are."""
        scalings = fold_scalings(self.known, self.families, self.folds, self.fits, SCALE_ERROR)
        return [
            tuple(self.scaled(df, scaling, "label") for df in (fold.train(self.known).filter(self.fits), fold.validation(self.known)))
            for fold, scaling in zip(self.folds, scalings)
        ]


def prepare(train: DataFrame, future: DataFrame, settings: Settings = Settings()) -> Prepared:
    """Features, outliers and encodings, such that a row's values rest on earlier rows only.

    Rows without their lags, and those before the first step of the category means, are not trained on.
    The target's quartiles that judge a row are those of the rows before its fold. Isolation looks at
    the features of all training rows, never at the target, and only keeps rows out of the fits. Of the
    copies made on the way only the two of the result stay.
    """
    with passing_copies(train.sparkSession) as made:
        ready, kept = _prepared(train, future, settings)
        made[:] = [path for path in made if path not in kept]
    return ready


def _prepared(train: DataFrame, future: DataFrame, settings: Settings) -> tuple[Prepared, list[str]]:
    """What `prepare` returns, and the paths of the copies that it reads."""
    target, past = settings.target, past_features(settings)
    changes = [c for c in past if "_pct_change_" in c]
    known = over_blocks(with_position(train, settings.series), past, settings.series).drop(POSITION)
    known = known.dropna(subset=[target, *[c for c in past if c not in changes]])
    ahead = lags_across(train, future, past, settings.series)
    # written before they are sorted: a sort by range computes its rows twice, once to find the ranges
    known = materialize(replace_nonfinite(row_features(known), changes), "past")
    known = with_position(known, Series(keys=(), order=(TS, READING_ID)))
    ahead = materialize(row_features(ahead), "ahead-past")

    rows = known.count()
    cut = int(rows * (1 - settings.held_out))
    folds = [*time_folds(cut, settings.folds), Fold(settings.folds, cut, cut, rows)]
    if settings.outliers not in ("combined", "iqr", "isolation", "none"):
        raise ValueError(f"outliers must be combined, iqr, isolation or none, not {settings.outliers!r}")
    kept = F.lit(True)
    if settings.outliers in ("combined", "iqr"):
        kept = inside_bounds(target, folds, fold_bounds(known, target, folds))
    known = known.withColumn("_fits", kept)
    if settings.outliers in ("combined", "isolation"):
        inputs = [c for c in (*MEASURES, "hour", "unit_price") if c != target and c in known.columns]
        # the marks stand in the table that the scores are written to, so nothing is joined
        known, usual = isolation_marks(known, inputs, settings.contamination)
        known = known.withColumn("_fits", F.col("_fits") & usual).drop("isolation_score")
    for col in CODED:
        codes = fit_labels(known, col)
        known, ahead = label_encode(known, codes, col), label_encode(ahead, codes, col)
    # every fold and the held-out share begin at an edge
    edges = sorted({*even_edges(rows, settings.blocks * (settings.folds + 1)), *[f.start for f in folds]})
    fits = F.col("_fits")
    # means of a few categories, each from the written rows; their sizes on file decide how they are joined
    default = known.filter(fits).agg(F.avg(target)).first()[0]
    for col in TARGET_CODED:
        means = materialize(fit_target_means(known.filter(fits), col, target), "means")
        ahead = target_encode(ahead, means, col, F.lit(default))
    known = target_encode_by_time(known, TARGET_CODED, target, edges, use=fits)
    names = [
        *CATEGORICAL,
        *cyclic_parts(TS),
        "unit_price",
        *[f"{c}_te" for c in TARGET_CODED],
        *past,
    ]
    known = materialize(known.withColumn("label", log_target(target)), "known")
    kept = [known._scratch_path]
    known = known.withColumn("_fits", fits & reduce(lambda a, b: a & b, [F.col(f"{c}_te").isNotNull() for c in TARGET_CODED]))
    known = replace_nonfinite(known, [f"{c}_te" for c in TARGET_CODED])
    ahead = impute(ahead, fit_medians(known.filter(fits), list(past)))
    ahead = materialize(replace_nonfinite(ahead, list(past)), "ahead")
    kept.append(ahead._scratch_path)
    keep = list(dict.fromkeys([READING_ID, *settings.series.keys, TS, WORK_TYPE]))
    measured = [m for m in dict.fromkeys([target, *MEASURES]) if m in train.columns]
    return Prepared(known, ahead, names, keep, measured, fits, folds), kept


def feature_tables(
    train: DataFrame, future: DataFrame, settings: Settings = Settings()
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Training rows to fit on and future rows with one vector of scaled features each; the names in order."""
    ready = prepare(train, future, settings)
    return (*ready.whole(), ready.names)


def base_models(settings: Settings) -> dict:
    return {
        "boosted": boosted_trees("label", settings.rounds, settings.depth),
        "forest": random_forest("label", settings.trees, settings.depth),
        "linear": ridge("label", 0.01),
    }


def combine(
    oof: DataFrame, ahead: DataFrame, models: Sequence[str], label: str, how: str, name: str
) -> DataFrame:
    """Add one prediction from the models' columns: stacked, averaged, or weighted by their R²."""
    if how == "stack":
        return stack(oof, label, models, name=name).transform(ahead)
    if how == "mean":
        return mean_ensemble(ahead, models, name)
    if how == "weighted":
        return weighted_ensemble(ahead, ensemble_weights(oof, label, models), models, name)
    raise ValueError(f"how must be stack, mean or weighted, not {how!r}")


def forecast_with_scores(
    train: DataFrame, future: DataFrame, settings: Settings = Settings()
) -> tuple[DataFrame, DataFrame]:
    """Predicted target of every future row, and scores: `part` ("fold 0", ..., "held out"), `model`, errors, R².

    Base models predict growing time folds, each fitted on the rows before it, and at last the held-out
    share; what combines them is fitted on the folds, and scored, as `combined`, on the held-out share alone.
    """
    ready = prepare(train, future, settings)
    models = base_models(settings)
    names = list(models)
    *frames, last = ready.frames()
    oof, _ = oof_predictions(ready.known, models, frames, [READING_ID, "label"])
    oof = materialize(oof, "oof")
    fitted = fit_all(last[0], models)
    held_out = materialize(
        combine(oof, predict_all(last[1], fitted).select(READING_ID, "label", *names), names, "label", settings.combine, "combined"), "held-out"
    )
    scores = metrics(oof.withColumn("part", F.concat(F.lit("fold "), "fold")), "label", names, ["part"], logged=True)
    scores = scores.unionByName(
        metrics(held_out.withColumn("part", F.lit("held out")), "label", [*names, "combined"], ["part"], logged=True)
    )
    known, ahead = ready.whole()
    if settings.refit:
        fitted = fit_all(known, models)
        oof = oof.unionByName(held_out.select(READING_ID, "label", F.lit(settings.folds).alias("fold"), *names))
    else:
        # the future scaled as the rows that the models have seen
        scaling = fold_scalings(ready.known, ready.families, ready.folds[-1:], ready.fits, SCALE_ERROR)[0]
        ahead = ready.scaled(ready.ahead, scaling)
    out = combine(oof, predict_all(ahead, fitted), names, "label", settings.combine, "logged")
    out = out.withColumn("prediction", unlog("logged"))
    return clip_floor(out, "prediction").select(READING_ID, "prediction"), scores


def forecast(
    train: DataFrame, future: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Predicted target of every future row, by several models over growing time folds."""
    return forecast_with_scores(train, future, settings)[0]


def forecast_measures(
    train: DataFrame, future: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Future rows with every measure predicted, ready for `write_predictions` and the reports."""
    known, ahead, _ = feature_tables(train, future, settings)
    model = boosted_trees("label", settings.rounds, settings.depth)
    measures = [m for m in MEASURES if m in train.columns]
    return multi_target(known, ahead, measures, model).select(*future.columns, *measures)
