"""Properties of models, outlier trees and streams."""

import datetime as dt
import hashlib

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from gridtally.operators import isolation, splits
from gridtally.operators.ordered import Series, with_position
from gridtally.operators.report import baseline
from gridtally.plans import seasonal, training
from gridtally.plans.forecast import combine
from gridtally.session import scratch_path
from gridtally.streaming import live


@pytest.fixture(scope="module")
def vectors(spark):
    df = spark.range(600).select(
        F.col("id").alias("reading_id"),
        (F.col("id") % 24).cast("double").alias("hour"),
        (F.pmod(F.xxhash64("id"), F.lit(100)) / 10).alias("noise"),
    )
    df = df.withColumn("y", F.col("hour") * 3 + F.col("noise") * 0.1)
    df = VectorAssembler(inputCols=["hour", "noise"], outputCol="features").transform(df)
    return with_position(df, Series((), ("reading_id",)))


def models():
    return {
        "boosted": training.boosted_trees("y", rounds=5, columns="all"),
        "linear": training.ridge("y", 0.0),
    }


def counted(vectors):
    """The same rows, and how often one of them was computed."""
    seen = vectors.sparkSession.sparkContext.accumulator(0)

    @F.udf("double")
    def label(y):
        seen.add(1)
        return y

    return vectors.withColumn("y", label.asNondeterministic()("y")), seen


def test_rows_of_a_fit_are_computed_once(spark, vectors):
    rows, seen = counted(vectors)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    fitted = training.fit_all(rows, models())
    assert seen.value == 600
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before
    alone = {name: m.copy().setPredictionCol(name).fit(vectors) for name, m in models().items()}
    got, want = (training.predict_all(vectors, f).orderBy("reading_id").select("boosted", "linear").collect() for f in (fitted, alone))
    assert list(fitted) == list(alone) and np.allclose(got, want, rtol=1e-9)


def test_rows_of_several_targets_are_computed_once(vectors):
    rows, seen = counted(vectors)
    out = training.multi_target(rows, vectors, ["y", "noise"], training.ridge("y", 0.0))
    assert seen.value == 600
    assert all(abs(r.noise - n) < 1e-6 for r, (n,) in zip(out.orderBy("reading_id").collect(), vectors.orderBy("reading_id").select("noise").collect()))


def test_prepared_rows_leave_two_copies(spark, sf_dir):
    from catalog.inputs import to_forecast, train
    from gridtally import session
    from gridtally.plans.forecast import Settings, prepare

    def copies():
        return set(session.folders(spark, f"{session.scratch_root(spark)}/*"))

    before = copies()
    ready = prepare(train(spark, sf_dir), to_forecast(spark, sf_dir), Settings(outliers="iqr", folds=2))
    assert sorted(p.rpartition("/")[2].rpartition("-")[0] for p in copies() - before) == ["ahead", "known"]
    assert ready.known.count() > 0 and ready.ahead.count() > 0


def test_oof_covers_each_validation_row_once(vectors):
    folds = splits.time_folds(600, 3)
    oof, _ = training.oof_predictions(vectors, models(), folds, ["reading_id", "y"])
    rows = oof.toPandas()
    assert sorted(rows["reading_id"]) == list(range(150, 600))
    assert np.abs(rows["linear"] - rows["y"]).max() < 1e-6


def test_fold_models_are_averaged(vectors):
    folds = training.kfold_frames(vectors, splits.kfold(3), 3)
    ahead = vectors.limit(10)
    _, out = training.oof_predictions(vectors, models(), folds, ["reading_id"], ahead)
    singles = [training.fit_all(train, models())["linear"].transform(ahead) for train, _ in folds]
    mean = np.mean([[r.linear for r in s.orderBy("reading_id").collect()] for s in singles], axis=0)
    got = [r.linear for r in out.orderBy("reading_id").collect()]
    np.testing.assert_allclose(got, mean)


def test_stack_prefers_the_exact_model(vectors):
    folds = splits.time_folds(600, 3)
    oof, _ = training.oof_predictions(vectors, models(), folds, ["reading_id", "y"])
    meta = training.stack(oof, "y", list(models()))
    weights = meta.stages[-1].coefficients
    assert weights[1] == pytest.approx(1.0, abs=1e-3)


def test_models_are_combined_as_asked(spark):
    past = spark.createDataFrame(
        [(float(i), float(i), float(-i)) for i in range(10)], "y double, good double, bad double"
    )
    ahead = spark.createDataFrame([(4.0, 2.0)], "good double, bad double")

    def result(how):
        return combine(past, ahead, ["good", "bad"], "y", how, "p").first().p

    assert result("mean") == 3.0
    assert result("weighted") == 4.0
    with pytest.raises(ValueError):
        result("best")


def test_multi_target_and_importance(spark, vectors):
    two = vectors.withColumn("z", -F.col("y"))
    out = training.multi_target(two, two, ["y", "z"], training.ridge("y", 0.0)).toPandas()
    np.testing.assert_allclose(out["y"], -out["z"], atol=1e-6)
    forest = training.random_forest("y", trees=3).fit(vectors)
    weights = training.feature_importance(spark, forest, ["hour", "noise"]).toPandas()
    assert weights.set_index("feature")["importance"]["hour"] > 0.9


def test_tune_finds_the_better_depth(vectors):
    model = training.boosted_trees("y", rounds=2, columns="all", subsample=1.0, step=1.0)
    grid = [{model.maxDepth: 1}, {model.maxDepth: 5}]
    best, errors = training.tune(vectors, model, grid, splits.time_folds(600, 2), "y")
    assert best == grid[1] and errors.count() == 4


def test_saved_model_predicts_the_same(spark, vectors):
    model = training.stack(vectors.withColumn("a", F.col("y") * 2), "y", ["a"])
    path = scratch_path(spark, "model")
    training.save_model(model, path)
    one = vectors.withColumn("a", F.lit(4.0)).limit(1)
    assert training.load_model(path).transform(one).first().prediction == pytest.approx(2.0)


def test_seasonal_ar_follows_a_regular_series(spark):
    df = spark.range(400).select(
        F.col("id").alias("reading_id"),
        F.lit(1).alias("meter_id"),
        F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("ts"),
        (F.col("id") % 24 * 5 + F.col("id") * 0.5 + F.pmod(F.xxhash64("id"), F.lit(7))).alias("y"),
    )
    df = df.withColumn("ts", F.col("ts") + F.make_dt_interval(mins=(F.col("reading_id") * 15).cast("int")))
    out = seasonal.seasonal_ar(with_position(df), "y").toPandas()
    assert len(out) == 400 - 49
    assert np.abs(out["prediction"] - out["y"]).mean() < 6


def test_seasonal_ar_continues_a_regular_series(spark):
    df = spark.range(400).select(
        (F.col("id") % 2).alias("meter_id"),
        F.floor(F.col("id") / 2).alias("t"),
    )
    df = df.withColumn("y", F.col("t") % 24 * 5 + F.col("t") * 0.5 + F.col("meter_id") * 100)
    line = Series(("meter_id",), ("t",))
    out = seasonal.seasonal_ar_ahead(with_position(df, line), "y", 60, series=line).toPandas()
    t = out["step"] + 199
    assert len(out) == 120
    np.testing.assert_allclose(out["prediction"], t % 24 * 5 + t * 0.5 + out["meter_id"] * 100, rtol=1e-6)


def test_isolation_finds_the_far_points(spark):
    df = spark.range(3000).select(
        F.col("id").alias("reading_id"),
        F.when(F.col("id") % 100 == 0, 50 + F.col("id") / 100)
        .otherwise(F.pmod(F.xxhash64("id"), F.lit(100)) / 10)
        .alias("a"),
        (F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(100)) / 10).alias("b"),
    )
    kept = isolation.isolation_filter(df, ["a", "b"], contamination=0.01).toPandas()
    assert len(kept) == 2970 and (kept["reading_id"] % 100 != 0).all()
    nodes = isolation.fit_isolation(df, ["a", "b"])
    again = isolation.fit_isolation(df, ["a", "b"])
    order = ["tree", "node"]
    assert nodes.sort_values(order).reset_index(drop=True).equals(
        again.sort_values(order).reset_index(drop=True)
    )
    assert nodes["tree"].nunique() == isolation.TREES


def test_isolation_draws_repeated_rows_one_by_one(spark, monkeypatch):
    """A third of the rows are equal; every tree has the 256 rows of the least draws, copies told apart."""
    monkeypatch.setattr(isolation, "COPY_ROWS", 64)
    ids = [*range(600), *[7] * 300]
    df = spark.createDataFrame([(i, float(i % 50), None if i == 3 else i / 7) for i in ids], "reading_id int, a double, b double")
    nodes = isolation.fit_isolation(df, ["a", "b"], trees=5, by=["reading_id"])
    draws, seen = [], {}
    for i in ids:
        seen[i] = seen.get(i, -1) + 1
        name = hashlib.md5(str(i).encode()).hexdigest()
        digest = hashlib.md5(f"{name}#{seen[i]}".encode()).hexdigest()
        draws.append((int(digest[:8], 16), int(digest[8:16], 16), name, seen[i], i))
    for tree in range(5):
        least = sorted(draws, key=lambda d: ((d[0] + tree * d[1]) % isolation.DRAWS, *d[2:4]))[:256]
        points = np.array([[d[4] % 50, 0 if d[4] == 3 else d[4] / 7] for d in least], float)
        want = sorted(isolation._grow(points, 42, tree))
        assert sorted(nodes[nodes["tree"] == tree].itertuples(index=False, name=None)) == want
    assert set(nodes[nodes["node"] == 1]["rows"]) == {256}


def test_isolation_of_few_odd_and_no_rows(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 1.0), (2, None), (3, float("nan")), (4, float("inf"))], "reading_id int, a double")
    assert isolation.isolation_filter(df, ["a"], contamination=0.0).count() == 5
    assert set(isolation.fit_isolation(df, ["a"], trees=3).query("node == 1")["rows"]) == {5}
    assert isolation.isolation_scores(df.limit(0), isolation.fit_isolation(df.limit(0), ["a"]), ["a"]).count() == 0


def readings(spark, path, files):
    """One reading an hour; every file is one micro-batch."""
    start = dt.datetime(2024, 11, 1)
    for i, hours in enumerate(files):
        rows = [
            (h, h % 2, start + dt.timedelta(hours=h), "a" if h % 3 else "b", *[float(h)] * 7)
            for h in hours
        ]
        schema = live.READINGS_SCHEMA
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_running_figures_follow_late_files(spark):
    path, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    state = scratch_path(spark, "state")
    readings(spark, path, [range(48, 96)])
    for hours in (None, range(0, 48)):
        if hours:
            readings(spark, path, [hours])
        stream = live.stream_readings(spark, path)
        live.publish(live.daily_totals(stream), out, state).awaitTermination()
    days = live.current(spark, out, ["day"]).orderBy("day").collect()
    assert [d.usage for d in days] == [float(sum(range(24 * i, 24 * i + 24))) for i in range(4)]
    goal = baseline(spark.read.parquet(path), "2024-11")
    rows = live.progress_vs_baseline(live.current(spark, out, ["day"]), goal).collect()
    percent = {(r.measure, r.period): r.percent for r in rows}
    assert percent["usage", "daily"] == 100.0 and percent["cost", "monthly"] == 100.0


def test_latest_card_is_the_newest_reading(spark):
    path, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    readings(spark, path, [range(10, 20), range(0, 10)])
    running = live.latest_cards(live.stream_readings(spark, path))
    live.publish(running, out, scratch_path(spark, "state")).awaitTermination()
    cards = live.current(spark, out, ["meter_id"]).orderBy("meter_id").collect()
    assert [(c.meter_id, c.usage_kwh) for c in cards] == [(0, 18.0), (1, 19.0)]


def test_batches_are_folded_into_a_snapshot(spark):
    """Many batches, late files among them: figures stay right, old batches go, expired days end."""
    path, out, state = (scratch_path(spark, name) for name in ("in", "out", "state"))
    hours = [range(24 * i, 24 * i + 24) for i in (0, 1, 3, 2, 4, 1, 5, 6, 7)]
    for i in range(0, len(hours), 3):
        readings(spark, path, hours[i : i + 3])
        days = live.daily_totals(live.stream_readings(spark, path))
        ended = F.col("day") < F.lit("2024-11-02").cast("date")
        live.publish(days, out, state, ["day"], fold_every=2, expired=ended).awaitTermination()
        found = {r.day.day: r.usage for r in live.current(spark, out, ["day"]).collect()}
        seen = [h for part in hours[: i + 3] for h in part]
        want = {d + 1: float(sum(h for h in seen if h // 24 == d)) for d in range(1, 8) if d in {h // 24 for h in seen}}
        assert found == want
    assert live._finished(spark, out, live.SNAPSHOT) == [5, 7]
    assert live._finished(spark, out, live.BATCH) == [6, 7, 8]
    assert live.current(spark, out, ["day"], before=7).count() == 7
