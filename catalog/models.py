"""Splits, scores, ensembles and models."""

from __future__ import annotations

from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from catalog.inputs import (
    ONE_SERIES,
    readings,
    rounded,
    rounded_all,
    snap,
    snapped,
    to_forecast,
    train,
    with_readings,
)
from catalog.registry import query
from gridtally.functions.calendar import calendar_parts
from gridtally.operators import evaluate, isolation, splits, timefolds
from gridtally.operators.encoding import assemble, fit_labels, fit_robust, label_encode
from gridtally.operators.ordered import with_position
from gridtally.operators.pricing import unit_price
from gridtally.operators.relational import top_k
from gridtally.plans import seasonal, training
from gridtally.plans.forecast import Settings, feature_tables, forecast, forecast_measures, forecast_with_scores
from gridtally.schema import MEASURES
from gridtally.session import materialize, scratch_path

_ORDERED = "placed AS (SELECT *, row_number() OVER (ORDER BY ts, reading_id) - 1 AS position FROM readings)"


def _placed(spark, sf_dir, *cols):
    df = readings(spark, sf_dir).select("reading_id", "ts", *cols)
    return with_position(df, ONE_SERIES)


@query(
    "random_split",
    with_readings(
        "SELECT reading_id, CASE WHEN CAST('0x' || substr(md5(CAST(reading_id AS VARCHAR)), 1, 8) AS BIGINT) "
        "< 0.3 * 4294967296 THEN 'validation' ELSE 'train' END AS role FROM readings"
    ),
)
def random_split(spark, sf_dir):
    known, held_out = splits.random_split(readings(spark, sf_dir).select("reading_id"), share=0.3)
    return known.withColumn("role", F.lit("train")).unionByName(
        held_out.withColumn("role", F.lit("validation"))
    )


@query(
    "time_split",
    with_readings(
        "SELECT reading_id, CASE WHEN position < CAST(floor((SELECT count(*) FROM readings) * 0.8) AS BIGINT) "
        "THEN 'train' ELSE 'validation' END AS role FROM placed",
        _ORDERED,
    ),
)
def time_split(spark, sf_dir):
    known, held_out = splits.time_split(_placed(spark, sf_dir))
    return (
        known.withColumn("role", F.lit("train"))
        .unionByName(held_out.withColumn("role", F.lit("validation")))
        .select("reading_id", "role")
    )


@query(
    "time_folds",
    with_readings(
        "SELECT reading_id, CAST(fold AS INTEGER) AS fold, CASE WHEN position < start - 24 THEN 'train' "
        "ELSE 'validation' END AS role FROM placed, bounds "
        "WHERE position < start - 24 OR (position >= start AND position < start + size)",
        _ORDERED,
        "sized AS (SELECT count(*) AS n, count(*) // 6 AS size FROM readings)",
        "bounds AS (SELECT f AS fold, size, n - (5 - f) * size AS start FROM sized, (SELECT unnest(range(5)) AS f))",
    ),
)
def time_folds(spark, sf_dir):
    placed = _placed(spark, sf_dir).select("reading_id", "position")
    folds = splits.time_folds(placed.count(), 5, gap=24)
    return splits.with_roles(placed, folds).drop("position")


@query(
    "kfold",
    with_readings("SELECT reading_id, CAST(reading_id % 5 AS INTEGER) AS fold FROM readings"),
)
def kfold(spark, sf_dir):
    return readings(spark, sf_dir).select("reading_id", splits.kfold(5).alias("fold"))


# Predictions without a model: simple functions of the readings

_GUESSES = {
    "low": "cost_krw * CAST(0.9 AS DOUBLE)",
    "shifted": "cost_krw + 500",
    "flat": "CAST(27000 AS DOUBLE)",
}


def _guessed(spark, sf_dir):
    guesses = [F.expr(e).alias(n) for n, e in _GUESSES.items()]
    return readings(spark, sf_dir).select("reading_id", "ts", "cost_krw", *guesses)


_GUESSED = (
    "guessed AS (SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in _GUESSES.items()) + " FROM readings)"
)


def _r2(model):
    mean = "(SELECT avg(cost_krw) FROM guessed)"
    return (
        f"(1 - sum((cost_krw - {model}) * (cost_krw - {model})) "
        f"/ sum((cost_krw - {mean}) * (cost_krw - {mean})))"
    )


@query(
    "metrics",
    with_readings(
        " UNION ALL ".join(
            f"SELECT '{m}' AS model, round(avg(abs(cost_krw - {m})), 4) AS mae, "
            f"round(avg((cost_krw - {m}) ** 2), 1) AS mse, round(sqrt(avg((cost_krw - {m}) ** 2)), 4) AS rmse, "
            f"round({_r2(m)}, 8) AS r2 FROM guessed"
            for m in _GUESSES
        ),
        _GUESSED,
    ),
)
def metrics(spark, sf_dir):
    scores = evaluate.metrics(_guessed(spark, sf_dir), "cost_krw", list(_GUESSES))
    return rounded(rounded(rounded(scores, 4, "mae", "rmse"), 1, "mse"), 8, "r2")


@query(
    "metrics_logged",
    with_readings(
        "SELECT 'p' AS model, round(avg(abs(e)), 4) AS mae, round(avg(e * e), 1) AS mse, "
        "round(sqrt(avg(e * e)), 4) AS rmse, round(1 - sum(e * e) / (var_pop(y) * count(*)), 8) AS r2 "
        "FROM (SELECT exp(ln(1 + cost_krw)) - 1 AS y, "
        "(exp(ln(1 + cost_krw)) - 1) - (exp(ln(1 + cost_krw) * 0.99) - 1) AS e FROM readings)"
    ),
)
def metrics_logged(spark, sf_dir):
    df = readings(spark, sf_dir).select(F.log1p("cost_krw").alias("y"))
    scores = evaluate.metrics(df.withColumn("p", F.col("y") * 0.99), "y", ["p"], logged=True)
    return rounded(rounded(rounded(scores, 4, "mae", "rmse"), 1, "mse"), 8, "r2")


@query(
    "cv_summary",
    with_readings(
        "SELECT model, round(avg(mae), 4) AS mean_mae, round(stddev_pop(mae), 4) AS std_mae FROM ("
        + " UNION ALL ".join(
            f"SELECT '{m}' AS model, reading_id % 5 AS fold, avg(abs(cost_krw - {m})) AS mae FROM guessed GROUP BY 2"
            for m in _GUESSES
        )
        + ") GROUP BY 1",
        _GUESSED,
    ),
)
def cv_summary(spark, sf_dir):
    folded = _guessed(spark, sf_dir).withColumn("fold", splits.kfold(5))
    scores = evaluate.metrics(folded, "cost_krw", list(_GUESSES), by=["fold"])
    return rounded_all(evaluate.cv_summary(scores), 4)


@query(
    "mean_ensemble",
    with_readings(
        f"SELECT reading_id, {snap('(low + shifted + flat) / 3', 4)} AS prediction FROM guessed", _GUESSED
    ),
)
def mean_ensemble(spark, sf_dir):
    out = evaluate.mean_ensemble(_guessed(spark, sf_dir), list(_GUESSES))
    return snapped(out.select("reading_id", "prediction"), 4, "prediction")


@query(
    "ensemble_weights",
    with_readings(
        "SELECT "
        + ", ".join(f"round({m} / (low + shifted + flat), 8) AS {m}" for m in _GUESSES)
        + " FROM (SELECT "
        + ", ".join(f"greatest({_r2(m)}, 0) AS {m}" for m in _GUESSES)
        + " FROM guessed)",
        _GUESSED,
    ),
)
def ensemble_weights(spark, sf_dir):
    return rounded_all(evaluate.ensemble_weights(_guessed(spark, sf_dir), "cost_krw", list(_GUESSES)), 8)


@query(
    "weighted_ensemble",
    with_readings(
        f"SELECT g.reading_id, {snap('(g.low * w.low + g.shifted * w.shifted + g.flat * w.flat) / (w.low + w.shifted + w.flat)', 4)} "
        "AS prediction FROM guessed g, (SELECT "
        + ", ".join(f"greatest({_r2(m)}, 0) AS {m}" for m in _GUESSES)
        + " FROM guessed) w",
        _GUESSED,
    ),
)
def weighted_ensemble(spark, sf_dir):
    df = _guessed(spark, sf_dir)
    weights = evaluate.ensemble_weights(df, "cost_krw", list(_GUESSES))
    out = evaluate.weighted_ensemble(df, weights, list(_GUESSES))
    return snapped(out.select("reading_id", "prediction"), 4, "prediction")


@query(
    "prediction_summary",
    with_readings("SELECT min(low) AS min, max(low) AS max, round(avg(low), 4) AS mean FROM guessed", _GUESSED),
)
def prediction_summary(spark, sf_dir):
    return rounded(evaluate.prediction_summary(_guessed(spark, sf_dir), "low"), 4, "mean")


# Models; their numbers have no SQL, so only rows are checked here and properties in the tests

_NAMES = ["month", "day", "hour", "weekday", "unit_price", "work_type_encoded"]


def _vectors(spark, sf_dir):
    """Readings with positions and a scaled feature vector, written once."""
    df = unit_price(readings(spark, sf_dir).withColumns(calendar_parts("ts")))
    df = label_encode(df, fit_labels(df, "work_type"), "work_type")
    df = materialize(df.select("reading_id", "meter_id", "ts", *MEASURES, *_NAMES), "inputs")
    scaling = fit_robust(df, _NAMES)
    scaled = df.select("*", *[scaling.scaled(c).alias(f"_{c}") for c in _NAMES])
    vectors = assemble(scaled, [f"_{c}" for c in _NAMES]).select(
        "reading_id", "meter_id", "ts", *MEASURES, "features"
    )
    return materialize(with_position(vectors, ONE_SERIES), "vectors")


def _models(label="cost_krw"):
    return {
        "boosted": training.boosted_trees(label, rounds=5, depth=4),
        "forest": training.random_forest(label, trees=5, depth=5),
        "linear": training.ridge(label),
    }


@query("boosted_trees")
def boosted_trees(spark, sf_dir):
    known, held_out = splits.time_split(_vectors(spark, sf_dir))
    model = training.boosted_trees("cost_krw", rounds=5, depth=4).setPredictionCol("boosted")
    return evaluate.metrics(model.fit(known).transform(held_out), "cost_krw", ["boosted"])


@query("boosted_trees_stopped_early")
def boosted_trees_stopped_early(spark, sf_dir):
    known, held_out = splits.time_split(_vectors(spark, sf_dir))
    model = training.boosted_trees("cost_krw", rounds=5, depth=4, stop_on="held_out")
    marked = known.withColumn("held_out", F.col("reading_id") % 5 == 0)
    scored = model.setPredictionCol("boosted").fit(marked).transform(held_out)
    return evaluate.metrics(scored, "cost_krw", ["boosted"])


@query("random_forest")
def random_forest(spark, sf_dir):
    known, held_out = splits.time_split(_vectors(spark, sf_dir))
    model = training.random_forest("cost_krw", trees=5, depth=5).setPredictionCol("forest")
    return evaluate.metrics(model.fit(known).transform(held_out), "cost_krw", ["forest"])


@query("ridge")
def ridge(spark, sf_dir):
    known, held_out = splits.time_split(_vectors(spark, sf_dir))
    model = training.ridge("cost_krw").setPredictionCol("linear")
    return evaluate.metrics(model.fit(known).transform(held_out), "cost_krw", ["linear"])


@query(
    "ridge_one_feature",
    with_readings(
        "SELECT reading_id, round(regr_intercept(cost_krw, usage_kwh) OVER () "
        "+ regr_slope(cost_krw, usage_kwh) OVER () * usage_kwh, 1) AS prediction FROM readings"
    ),
)
def ridge_one_feature(spark, sf_dir):
    """Least squares on one feature, which SQL can also do."""
    df = assemble(readings(spark, sf_dir).select("reading_id", "cost_krw", "usage_kwh"), ["usage_kwh"])
    out = training.ridge("cost_krw", 0.0).fit(df).transform(df)
    return rounded(out.select("reading_id", "prediction"), 1, "prediction")


@query("oof_predictions")
def oof_predictions(spark, sf_dir):
    df = _vectors(spark, sf_dir)
    folds = splits.time_folds(df.count(), 3, gap=24)
    return training.oof_predictions(df, _models(), folds, ["reading_id", "cost_krw"])[0]


@query("fold_averaged_forecast")
def fold_averaged_forecast(spark, sf_dir):
    df = _vectors(spark, sf_dir)
    known, ahead = splits.time_split(df, 0.1)
    folds = training.kfold_frames(known, splits.kfold(3), 3)
    _, out = training.oof_predictions(known, _models(), folds, ["reading_id"], ahead)
    return out.select("reading_id", *_models())


@query("stack")
def stack(spark, sf_dir):
    df = _vectors(spark, sf_dir)
    known, held_out = splits.time_split(df)
    folds = splits.time_folds(known.count(), 3)
    oof, _ = training.oof_predictions(known, _models(), folds, ["reading_id", "cost_krw"])
    meta = training.stack(materialize(oof, "oof"), "cost_krw", list(_models()))
    predicted = meta.transform(training.predict_all(held_out, training.fit_all(known, _models())))
    return evaluate.metrics(predicted, "cost_krw", ["prediction", *_models()])


@query("stack_boosted")
def stack_boosted(spark, sf_dir):
    df = _vectors(spark, sf_dir)
    folds = training.kfold_frames(df, splits.kfold(3), 3)
    oof, _ = training.oof_predictions(df, _models(), folds, ["reading_id", "cost_krw"])
    oof = materialize(oof, "oof")
    meta = training.stack(oof, "cost_krw", list(_models()), training.boosted_trees("cost_krw", 3, 3, columns="all"))
    return evaluate.metrics(meta.transform(oof), "cost_krw", ["prediction"])


@query("multi_target")
def multi_target(spark, sf_dir):
    known, ahead = splits.time_split(_vectors(spark, sf_dir), 0.1)
    model = training.boosted_trees("cost_krw", rounds=2, depth=3)
    return training.multi_target(known, ahead, MEASURES, model).select("reading_id", "ts", *MEASURES)


@query("feature_importance")
def feature_importance(spark, sf_dir):
    model = training.random_forest("cost_krw", trees=5, depth=5).fit(_vectors(spark, sf_dir))
    return top_k(training.feature_importance(spark, model, _NAMES), "importance", 10, ["feature"])


@query("tune")
def tune(spark, sf_dir):
    df = _vectors(spark, sf_dir)
    model = training.boosted_trees("cost_krw", rounds=3)
    grid = ParamGridBuilder().addGrid(model.maxDepth, [2, 4]).addGrid(model.stepSize, [0.1, 0.3]).build()
    _, errors = training.tune(df, model, grid, splits.time_folds(df.count(), 2), "cost_krw")
    return errors


# Least squares on one feature has a SQL answer, so the machinery around a model can be compared

_FOLDS = 3


def _one_feature(spark, sf_dir):
    df = readings(spark, sf_dir).select("reading_id", "ts", *MEASURES)
    return materialize(assemble(df, ["usage_kwh"]), "vectors")


def _coefficients(source, y="cost_krw"):
    return (
        f"SELECT f AS fold, regr_slope({y}, usage_kwh) AS b, regr_intercept({y}, usage_kwh) AS a "
        f"FROM {source}, (SELECT unnest(range({_FOLDS})) AS f) WHERE reading_id % {_FOLDS} <> f GROUP BY f"
    )


_OOF = (
    "oof AS (SELECT reading_id, cost_krw, usage_kwh, CAST(fold AS INTEGER) AS fold, a + b * usage_kwh AS linear "
    f"FROM readings JOIN ({_coefficients('readings')}) c ON reading_id % {_FOLDS} = fold)"
)


def _linear_oof(spark, sf_dir):
    df = _one_feature(spark, sf_dir)
    folds = training.kfold_frames(df, splits.kfold(_FOLDS), _FOLDS)
    models = {"linear": training.ridge("cost_krw", 0.0)}
    return df, training.oof_predictions(df, models, folds, ["reading_id", "cost_krw"])[0]


@query(
    "oof_predictions_linear",
    with_readings("SELECT reading_id, fold, round(linear, 1) AS linear FROM oof", _OOF),
)
def oof_predictions_linear(spark, sf_dir):
    _, oof = _linear_oof(spark, sf_dir)
    return rounded(oof.select("reading_id", "fold", "linear"), 1, "linear")


@query(
    "stack_linear",
    with_readings(
        "SELECT reading_id, round(m.a + m.b * (s.a + s.b * usage_kwh), 1) AS prediction FROM readings, "
        "(SELECT regr_slope(cost_krw, linear) AS b, regr_intercept(cost_krw, linear) AS a FROM oof) m, "
        "(SELECT regr_slope(cost_krw, usage_kwh) AS b, regr_intercept(cost_krw, usage_kwh) AS a FROM readings) s",
        _OOF,
    ),
)
def stack_linear(spark, sf_dir):
    df, oof = _linear_oof(spark, sf_dir)
    meta = training.stack(oof, "cost_krw", ["linear"])
    fitted = training.fit_all(df, {"linear": training.ridge("cost_krw", 0.0)})
    out = meta.transform(training.predict_all(df, fitted))
    return rounded(out.select("reading_id", "prediction"), 1, "prediction")


@query(
    "fold_averaged_forecast_linear",
    with_readings(
        "SELECT reading_id, round(avg(a + b * usage_kwh), 1) AS linear FROM (SELECT * FROM readings "
        f"WHERE ts >= TIMESTAMP '2024-12-01 00:00:00'), ({_coefficients('train')}) GROUP BY 1"
    ),
)
def fold_averaged_forecast_linear(spark, sf_dir):
    df = _one_feature(spark, sf_dir)
    past = F.col("ts") < F.lit("2024-12-01").cast("timestamp_ntz")
    folds = training.kfold_frames(df.filter(past), splits.kfold(_FOLDS), _FOLDS)
    models = {"linear": training.ridge("cost_krw", 0.0)}
    _, out = training.oof_predictions(df, models, folds, ["reading_id"], df.filter(~past))
    return rounded(out.select("reading_id", "linear"), 1, "linear")


_TARGETS = ("cost_krw", "reactive_lag_kvarh", "pf_lag_pct")


@query(
    "multi_target_linear",
    with_readings(
        "SELECT reading_id, "
        + ", ".join(
            f"round((SELECT regr_intercept({t}, usage_kwh) FROM train) "
            f"+ (SELECT regr_slope({t}, usage_kwh) FROM train) * usage_kwh, 1) AS {t}"
            for t in _TARGETS
        )
        + " FROM readings WHERE ts >= TIMESTAMP '2024-12-01 00:00:00'"
    ),
)
def multi_target_linear(spark, sf_dir):
    df = _one_feature(spark, sf_dir)
    past = F.col("ts") < F.lit("2024-12-01").cast("timestamp_ntz")
    model = training.ridge("cost_krw", 0.0)
    out = training.multi_target(df.filter(past), df.filter(~past), _TARGETS, model)
    return rounded_all(out.select("reading_id", *_TARGETS), 1)


@query(
    "saved_model",
    with_readings(
        "SELECT reading_id, round(regr_intercept(cost_krw, usage_kwh) OVER () "
        "+ regr_slope(cost_krw, usage_kwh) OVER () * usage_kwh, 1) AS prediction FROM readings"
    ),
)
def saved_model(spark, sf_dir):
    from pyspark.ml import PipelineModel

    df = _one_feature(spark, sf_dir)
    path = scratch_path(spark, "model")
    training.save_model(PipelineModel([training.ridge("cost_krw", 0.0).fit(df)]), path)
    out = training.load_model(path).transform(df)
    return rounded(out.select("reading_id", "prediction"), 1, "prediction")


_CHANGES = (
    "lagged AS (SELECT *, lag(cost_krw) OVER s + lag(cost_krw, 24) OVER s - lag(cost_krw, 25) OVER s AS base FROM readings "
    "WINDOW s AS (PARTITION BY meter_id ORDER BY ts, reading_id)),\n"
    "changes AS (SELECT *, cost_krw - base AS w, lag(cost_krw - base) OVER s AS w1 FROM lagged "
    "WINDOW s AS (PARTITION BY meter_id ORDER BY ts, reading_id)),\n"
    "long AS (SELECT regr_slope(w, w1) AS b, regr_intercept(w, w1) AS a FROM changes WHERE ts < TIMESTAMP '2024-12-01 00:00:00'),\n"
    "surprises AS (SELECT *, lag(w - a - b * w1) OVER s AS e1 FROM changes, long "
    "WINDOW s AS (PARTITION BY meter_id ORDER BY ts, reading_id)),\n"
    "fitted AS (SELECT regr_slope(w, e1) AS d, regr_intercept(w, e1) AS c FROM surprises WHERE ts < TIMESTAMP '2024-12-01 00:00:00')"
)


@query(
    "seasonal_surprises_one_lag",
    with_readings(
        f"SELECT reading_id, {snap('base + c + d * e1', 2)} AS prediction FROM surprises, fitted",
        _CHANGES,
    ),
)
def seasonal_surprises_one_lag(spark, sf_dir):
    """One lag in either fit, so that plain regressions say the same."""
    placed = with_position(readings(spark, sf_dir).select("reading_id", "meter_id", "ts", "cost_krw"))
    known = F.col("ts") < F.lit("2024-12-01").cast("timestamp_ntz")
    model = seasonal.fit_seasonal(placed, "cost_krw", ar=(), ma=(1,), long=(1,), train=known)
    out = seasonal.one_step(placed, model)
    return snapped(out.select("reading_id", "prediction"), 2, "prediction")


def _seasonal(spark, sf_dir):
    """A model with surprises and an input, fitted on the readings before the forecast."""
    rows = readings(spark, sf_dir).select("reading_id", "meter_id", "ts", "cost_krw", "usage_kwh")
    known = F.col("ts") < F.lit("2024-12-01").cast("timestamp_ntz")
    placed = materialize(with_position(rows), "placed")
    return placed, known, seasonal.fit_seasonal(placed, "cost_krw", ["usage_kwh"], train=known)


@query("seasonal_arma")
def seasonal_arma(spark, sf_dir):
    placed, known, model = _seasonal(spark, sf_dir)
    return evaluate.metrics(seasonal.one_step(placed, model).filter(~known), "cost_krw", ["prediction"])


@query("seasonal_arma_ahead")
def seasonal_arma_ahead(spark, sf_dir):
    """A month of quarter hours, as far as the input is known."""
    placed, known, model = _seasonal(spark, sf_dir)
    return seasonal.ahead(placed.filter(known), model, 2976, placed.filter(~known))


@query("seasonal_ar")
def seasonal_ar(spark, sf_dir):
    placed = with_position(
        readings(spark, sf_dir).select("reading_id", "meter_id", "ts", "cost_krw", "usage_kwh")
    )
    known = F.col("ts") < F.lit("2024-12-01").cast("timestamp_ntz")
    out = seasonal.seasonal_ar(placed, "cost_krw", ["usage_kwh"], train=known)
    return evaluate.metrics(out.filter(~known), "cost_krw", ["prediction"])


@query("seasonal_ar_ahead")
def seasonal_ar_ahead(spark, sf_dir):
    known = train(spark, sf_dir).select("reading_id", "meter_id", "ts", "cost_krw")
    return seasonal.seasonal_ar_ahead(with_position(known), "cost_krw", steps=2976)


_BLOCKS = 24
_BLOCKED = (
    "blocked AS (SELECT *, len(list_filter(range(1, "
    f"{_BLOCKS}), lambda i: position >= n * i // {_BLOCKS})) AS block FROM placed, (SELECT count(*) AS n FROM readings)),\n"
    "own AS (SELECT work_type, block, sum(cost_krw) AS s, count(*) AS c FROM blocked GROUP BY 1, 2),\n"
    "overall AS (SELECT block, sum(sum(s)) OVER w / sum(sum(c)) OVER w AS mean FROM own GROUP BY block "
    "WINDOW w AS (ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),\n"
    "run AS (SELECT work_type, block, sum(s) OVER w AS s, coalesce(sum(c) OVER w, 0) AS c FROM own "
    "WINDOW w AS (PARTITION BY work_type ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"
)


@query(
    "target_encode_by_time",
    with_readings(
        "SELECT reading_id, "
        + snap(
            "CASE WHEN c > 0 THEN mean * (1 - 1 / (1 + exp(10 - c))) + s / c * (1 / (1 + exp(10 - c))) ELSE mean END", 3
        )
        + " AS work_type_te FROM blocked JOIN run USING (work_type, block) JOIN overall USING (block)",
        _ORDERED,
        _BLOCKED,
    ),
)
def target_encode_by_time(spark, sf_dir):
    df = _placed(spark, sf_dir, "work_type", "cost_krw")
    edges = timefolds.even_edges(df.count(), _BLOCKS)
    out = timefolds.target_encode_by_time(df, "work_type", "cost_krw", edges)
    return snapped(out.select("reading_id", "work_type_te"), 3, "work_type_te")


_TIME_FOLDS = (
    "folds AS (SELECT CAST(i AS INTEGER) AS fold, n - 5 * (n // 6) + i * (n // 6) AS train_end "
    "FROM (SELECT count(*) AS n FROM readings), (SELECT unnest(range(5)) AS i)),\n"
    "trained AS (SELECT fold, placed.* FROM placed JOIN folds ON position < train_end),\n"
    "quartiles AS (SELECT fold, quantile_cont(cost_krw, 0.25) AS q1, quantile_cont(cost_krw, 0.75) AS q3 FROM trained GROUP BY 1)"
)


def _folded(spark, sf_dir, *cols):
    df = materialize(_placed(spark, sf_dir, *cols), "placed")
    return df, splits.time_folds(df.count(), 5)


@query(
    "fold_statistics",
    with_readings(
        f"SELECT fold, {snap('q1 - 1.5 * (q3 - q1)', 3)} AS low, {snap('q3 + 1.5 * (q3 - q1)', 3)} AS high, "
        f"{snap('quantile_cont(usage_kwh, 0.5)', 4)} AS usage_median, "
        f"{snap('quantile_cont(usage_kwh, 0.75) - quantile_cont(usage_kwh, 0.25)', 4)} AS usage_width, "
        f"{snap('avg(pf_lag_pct)', 6)} AS pf_mean, {snap('stddev_pop(pf_lag_pct)', 6)} AS pf_std, "
        f"{snap('min(reactive_lag_kvarh)', 4)} AS reactive_low, "
        f"{snap('max(reactive_lag_kvarh) - min(reactive_lag_kvarh)', 4)} AS reactive_span "
        "FROM trained JOIN quartiles USING (fold) GROUP BY fold, q1, q3",
        _ORDERED,
        _TIME_FOLDS,
    ),
)
def fold_statistics(spark, sf_dir):
    """Outlier bounds, medians and scalings of every growing training set."""
    df, folds = _folded(spark, sf_dir, *MEASURES)
    bounds = timefolds.fold_bounds(df, "cost_krw", folds)
    medians = timefolds.fold_medians(df, ["usage_kwh"], folds)
    families = {"numeric": ["usage_kwh"], "categorical": ["pf_lag_pct"], "lag": ["reactive_lag_kvarh"]}
    scalings = timefolds.fold_scalings(df, families, folds)
    names = ["low", "high", "usage_median", "usage_width", "pf_mean", "pf_std", "reactive_low", "reactive_span"]
    rows = [
        (
            f.number, *b, m["usage_kwh"], s.width["usage_kwh"], s.center["pf_lag_pct"], s.width["pf_lag_pct"],
            s.center["reactive_lag_kvarh"], s.width["reactive_lag_kvarh"],
        )
        for f, b, m, s in zip(folds, bounds, medians, scalings)
    ]
    out = spark.createDataFrame(rows, "fold int, " + ", ".join(f"{n} double" for n in names))
    out = snapped(snapped(out, 3, "low", "high"), 6, "pf_mean", "pf_std")
    return snapped(out, 4, "usage_median", "usage_width", "reactive_low", "reactive_span")


@query(
    "fold_outliers",
    with_readings(
        "SELECT reading_id, cost_krw BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS usual FROM placed JOIN quartiles "
        "ON fold = greatest(0, (SELECT count(*) FROM folds WHERE train_end <= position) - 1)",
        _ORDERED,
        _TIME_FOLDS,
    ),
)
def fold_outliers(spark, sf_dir):
    """Each reading judged by the quartiles of the readings before its fold."""
    df, folds = _folded(spark, sf_dir, "cost_krw")
    usual = timefolds.inside_bounds("cost_krw", folds, timefolds.fold_bounds(df, "cost_krw", folds))
    return df.select("reading_id", usual.alias("usual"))


@query("forecast")
def forecast_query(spark, sf_dir):
    return forecast(train(spark, sf_dir), to_forecast(spark, sf_dir))


@query("forecast_scores")
def forecast_scores(spark, sf_dir):
    settings = Settings(refit=False, outliers="iqr", combine="weighted")
    return forecast_with_scores(train(spark, sf_dir), to_forecast(spark, sf_dir), settings)[1]


@query("forecast_measures")
def forecast_measures_query(spark, sf_dir):
    return forecast_measures(train(spark, sf_dir), to_forecast(spark, sf_dir))


@query("forecast_features")
def forecast_features(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    _, ahead, names = feature_tables(train(spark, sf_dir), to_forecast(spark, sf_dir))
    return ahead.select("reading_id", F.size(vector_to_array("features")).alias("features"))


_ISOLATION_INPUTS = ["usage_kwh", "reactive_lag_kvarh", "hour"]
_TREES, _SAMPLED, _SEED = 100, 256, 42


def _isolation_sql(select, features, key="reading_id"):
    """The trees grown and walked level by level; `judged` holds every reading with its score.

    Each tree takes the 256 readings with the least draws of all, whose digest is that of the key and
    of the number 0, as no reading is repeated.
    """
    sample = f"(SELECT least({_SAMPLED}, count(*)) FROM readings)"
    mean = "CASE WHEN {0} < 2 THEN 0 WHEN {0} = 2 THEN 1 ELSE 2 * (ln({0} - 1) + 0.5772156649015329) - 2 * ({0} - 1) / {0} END"
    values = "[" + ", ".join(f"CAST({f} AS DOUBLE)" for f in features) + "]"
    lows, highs = (
        "[" + ", ".join(f"{extreme}(x[{i + 1}])" for i in range(len(features))) + "]" for extreme in ("min", "max")
    )
    depth = 8
    ctes = [
        f"inputs AS (SELECT *, {values} AS x, md5(md5(CAST({key} AS VARCHAR)) || '#0') AS digest FROM readings)",
        f"trees AS (SELECT unnest(range({_TREES})) AS tree)",
        "points_0 AS MATERIALIZED (SELECT tree, 1 AS node, x FROM inputs, trees QUALIFY row_number() OVER (PARTITION BY tree ORDER BY "
        "(CAST('0x' || substr(digest, 1, 8) AS BIGINT) + tree * CAST('0x' || substr(digest, 9, 8) AS BIGINT)) % 4294967291, "
        f"md5(CAST({key} AS VARCHAR))) <= {_SAMPLED})",
    ]
    for d in range(depth + 1):
        ctes += [
            f"sizes_{d} AS (SELECT tree, node, count(*) AS n, {lows} AS low, {highs} AS high, md5('{_SEED}|' || tree || '|' || node) AS digest "
            f"FROM points_{d} GROUP BY 1, 2)",
            f"open_{d} AS (SELECT *, CASE WHEN {d} < ceil(log2(greatest({sample}, 2))) "
            f"THEN list_filter(range({len(features)}), lambda i: high[i + 1] > low[i + 1]) ELSE [] END AS able FROM sizes_{d})",
            f"chosen_{d} AS (SELECT *, CASE WHEN len(able) > 0 THEN able[CAST('0x' || substr(digest, 1, 8) AS BIGINT) % len(able) + 1] ELSE -1 END AS feature, "
            f"low[feature + 1] + CAST('0x' || substr(digest, 9, 13) AS BIGINT) / 4503599627370496.0::DOUBLE * (high[feature + 1] - low[feature + 1]) AS cut FROM open_{d})",
            f"nodes_{d} AS MATERIALIZED (SELECT tree, node, feature, CASE WHEN cut >= high[feature + 1] THEN low[feature + 1] ELSE cut END AS threshold, "
            f"CAST(round(({d} + {mean.format('n')}) * 1000000) AS BIGINT) AS path FROM chosen_{d})",
            f"points_{d + 1} AS MATERIALIZED (SELECT tree, 2 * node + CAST(x[feature + 1] > threshold AS INTEGER) AS node, x "
            f"FROM points_{d} JOIN nodes_{d} USING (tree, node) WHERE feature >= 0)",
        ]
    ctes.append("walk_0 AS (SELECT row_key, tree, 1 AS node, x FROM (SELECT {0} AS row_key, x FROM inputs), trees)".format(key))
    for d in range(depth):
        ctes.append(
            f"walk_{d + 1} AS (SELECT row_key, tree, CASE WHEN feature >= 0 THEN 2 * node + CAST(x[feature + 1] > threshold AS INTEGER) ELSE node END AS node, x "
            f"FROM walk_{d} JOIN nodes USING (tree, node))"
        )
    every = " UNION ALL ".join(f"SELECT * FROM nodes_{d}" for d in range(depth + 1))
    ctes.insert(-depth - 1, f"nodes AS MATERIALIZED ({every})")
    ctes += [
        f"lengths AS (SELECT row_key, sum(path) AS path FROM walk_{depth} JOIN nodes USING (tree, node) GROUP BY 1)",
        f"judged AS MATERIALIZED (SELECT inputs.*, pow(2.0, -(path / 1000000.0::DOUBLE / {_TREES} / ({mean.format(sample)}))) AS isolation_score "
        f"FROM inputs JOIN lengths ON {key} = row_key)",
    ]
    return with_readings(select, *ctes)


def _with_hour(spark, sf_dir):
    return readings(spark, sf_dir).select(
        "reading_id", "usage_kwh", "reactive_lag_kvarh", "cost_krw", F.hour("ts").alias("hour")
    )


_KEPT = "isolation_score <= (SELECT quantile_cont(isolation_score, 0.9) FROM judged)"
_SQL_INPUTS = ["usage_kwh", "reactive_lag_kvarh", "hour(ts)"]


@query(
    "isolation_filter_repeated_ids",
    _isolation_sql(f"SELECT reading_id AS row_key, meter_id, round(isolation_score, 9) AS score FROM judged WHERE {_KEPT}", _SQL_INPUTS[:2]),
)
def isolation_filter_repeated_ids(spark, sf_dir):
    """Every id stands for all rows; each row is judged by itself and none is multiplied."""
    df = readings(spark, sf_dir).select(
        F.col("reading_id").alias("row_key"), "meter_id", F.lit(7).cast("long").alias("reading_id"), "usage_kwh", "reactive_lag_kvarh"
    )
    kept = isolation.isolation_filter(df, _ISOLATION_INPUTS[:2], by=["row_key"])
    return kept.select("row_key", "meter_id", F.round("isolation_score", 9).alias("score"))


@query(
    "isolation_filter",
    _isolation_sql(f"SELECT reading_id, round(isolation_score, 9) AS score FROM judged WHERE {_KEPT}", _SQL_INPUTS),
)
def isolation_filter(spark, sf_dir):
    kept = isolation.isolation_filter(_with_hour(spark, sf_dir), _ISOLATION_INPUTS, by=["reading_id"])
    return kept.select("reading_id", F.round("isolation_score", 9).alias("score"))


@query(
    "combined_filter",
    _isolation_sql(
        f"SELECT reading_id, round(isolation_score, 9) AS score FROM judged, (SELECT quantile_cont(cost_krw, 0.25) AS q1, "
        f"quantile_cont(cost_krw, 0.75) AS q3 FROM readings) WHERE {_KEPT} AND cost_krw BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)",
        _SQL_INPUTS,
    ),
)
def combined_filter(spark, sf_dir):
    kept = isolation.combined_filter(_with_hour(spark, sf_dir), "cost_krw", _ISOLATION_INPUTS, by=["reading_id"])
    return kept.select("reading_id", F.round("isolation_score", 9).alias("score"))
