"""Seasonal regressions against plain numpy, and time folds against plain loops."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridtally.operators import isolation, timefolds
from gridtally.operators.ordered import POSITION, Series, with_position
from gridtally.operators.splits import time_folds
from gridtally.plans import seasonal
from gridtally.plans.forecast import Settings, prepare

LINES = Series(("k",), ("t",))
SEASON = 4


def surprised(n, k, seed):
    """A series whose change follows its last surprise and an input."""
    draw = np.random.default_rng(seed)
    e, x = draw.normal(size=n), draw.normal(size=n)
    y = np.zeros(n)
    for t in range(SEASON + 1, n):
        w = 0.2 + e[t] + 0.6 * e[t - 1] + 2.0 * x[t]
        y[t] = y[t - 1] + y[t - SEASON] - y[t - SEASON - 1] + w
    return [(k, t, float(y[t]), float(x[t])) for t in range(n)]


@pytest.fixture(scope="module")
def lines(spark):
    rows = surprised(900, 1, 5) + surprised(700, 2, 6)
    df = with_position(spark.createDataFrame(rows, "k int, t long, y double, x double").repartition(5), LINES)
    model = seasonal.fit_seasonal(df, "y", ["x"], SEASON, ar=(), ma=(1,), long=range(1, 9), series=LINES)
    return rows, df, model


def test_surprises_are_found(lines):
    _, df, model = lines
    assert abs(model.weights[-1] - 2.0) < 0.1 and 0.3 < model.weights[0] < 0.8 and abs(model.intercept - 0.2) < 0.15
    plain = seasonal.fit_seasonal(df, "y", ["x"], SEASON, ar=(), ma=(), series=LINES)
    error = {
        name: seasonal.one_step(df, m, LINES).agg(F.avg(F.abs(F.col("prediction") - F.col("y")))).first()[0]
        for name, m in (("with", model), ("without", plain))
    }
    assert error["with"] < 0.95 * error["without"]


def test_steps_ahead_begin_with_the_one_step_forecast(spark, lines):
    rows, df, model = lines
    one = {(r.k, r.t): r.prediction for r in seasonal.one_step(df, model, LINES).collect()}
    past, later = df.filter("t < 650"), df.filter("t >= 650")
    got = seasonal.ahead(past, model, 30, later, LINES).collect()
    assert len(got) == 60 and {r.step for r in got} == set(range(1, 31))
    for r in got:
        if r.step == 1:
            assert abs(r.prediction - one[r.k, 650]) < 1e-6
    # from the second step on nothing surprises, and forecasts take the place of values
    for k in (1, 2):
        y = [r[2] for r in rows if r[0] == k][:650]
        x = [r[3] for r in rows if r[0] == k]
        for r in sorted((r for r in got if r.k == k), key=lambda r: r.step):
            t = 649 + r.step
            w = model.intercept + model.weights[-1] * x[t]
            if r.step > 1:
                assert abs(r.prediction - (y[t - 1] + y[t - SEASON] - y[t - SEASON - 1] + w)) < 1e-6
            y.append(r.prediction)


def test_many_steps_take_linear_time(lines):
    model = lines[2]
    past = np.array([r[2] for r in lines[0][:200]])
    took = []
    for steps in (10_000, 40_000):
        start = time.process_time()
        assert len(seasonal._continued(model, past, np.zeros((200, 1)), steps, np.zeros((steps, 1)))) == steps
        took.append(time.process_time() - start)
    assert took[1] < 9 * took[0]


def test_series_that_are_short_or_have_gaps(spark, lines):
    _, df, model = lines
    some = df.filter("k = 1 or t < 5").withColumn("y", F.when((F.col("k") == 1) & (F.col("t") == 899), None).otherwise(F.col("y")))
    future = df.filter("t < 3").withColumn("t", F.col("t") + 1000)
    assert seasonal.ahead(some, model, 5, future, LINES).count() == 0
    with pytest.raises(ValueError):
        seasonal.ahead(df, model, 5, series=LINES)


def test_encodings_by_time_never_look_ahead(spark):
    df = spark.range(600).select(
        "id",
        F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 5))).alias("c"),
        F.pmod(F.xxhash64("id"), F.lit(100)).cast("double").alias("y"),
    )
    line = Series((), ("id",))
    edges = timefolds.even_edges(600, 6)
    use = F.col("id") % 11 != 0

    def encoded(frame):
        out = timefolds.target_encode_by_time(with_position(frame, line), "c", "y", edges, use=use)
        return {r.id: (r.c, r.y, r.c_te) for r in out.collect()}

    got = encoded(df)
    assert len(got) == 600
    for i, (c, _, te) in got.items():
        start = i // 100 * 100
        before = [v for j, v in got.items() if j < start and j % 11]
        if not before:
            assert te is None
            continue
        mean = np.mean([y for _, y, _ in before])
        mine = [y for k, y, _ in before if k == c]
        weight = 1 / (1 + np.exp(10 - len(mine)))
        want = mean * (1 - weight) + np.mean(mine) * weight if mine else mean
        assert abs(te - want) < 1e-9
    changed = encoded(df.withColumn("y", F.when(F.col("id") >= 300, 1e6).otherwise(F.col("y"))))
    assert all(changed[i][2] == got[i][2] for i in range(400))


def test_fold_statistics_of_growing_sets(spark):
    df = with_position(spark.range(500).select("id", F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double").alias("a")), Series((), ("id",)))
    values = {r.id: r.a for r in df.collect()}
    folds = time_folds(500, 4, gap=7)
    families = {"numeric": [], "rolling": ["a"], "categorical": [], "lag": []}
    exact = timefolds.fold_scalings(df, families, folds)
    near = timefolds.fold_scalings(df, families, folds, error=1e-3)
    codes = timefolds.fold_scalings(df, {"categorical": ["a"]}, folds, use=F.col("id") % 2 == 0)
    bounds = timefolds.fold_bounds(df, "a", folds)
    for f, e, n, c, (low, high) in zip(folds, exact, near, codes, bounds):
        seen = np.array([values[i] for i in range(f.train_end)])
        q1, q2, q3 = np.percentile(seen, (25, 50, 75))
        assert abs(e.center["a"] - q2) < 1e-9 and abs(e.width["a"] - (q3 - q1)) < 1e-9
        assert abs(n.center["a"] - q2) < 30 and abs(n.width["a"] - (q3 - q1)) < 60
        even = np.array([values[i] for i in range(0, f.train_end, 2)])
        assert abs(c.center["a"] - even.mean()) < 1e-9 and abs(c.width["a"] - even.std()) < 1e-9
        assert abs(low - (q1 - 1.5 * (q3 - q1))) < 1e-9 and abs(high - (q3 + 1.5 * (q3 - q1))) < 1e-9
    assert timefolds.fold_bounds(df.filter("id > 400"), "a", folds[:1]) == [None]


def test_prepared_rows_rest_on_the_past(spark, sf_dir):
    """Later targets change neither the features nor the fits of earlier rows."""
    from catalog.inputs import to_forecast, train

    settings = Settings(lags=(1, 4), windows=(12,), medians=(12,), changes=(1,), folds=2, outliers="iqr")
    known = train(spark, sf_dir)
    cut = "2023-01-01"
    other = known.withColumn("cost_krw", F.when(F.col("ts") >= cut, F.col("cost_krw") * 3 + 1).otherwise(F.col("cost_krw")))
    names = None
    seen = []
    for rows in (known, other):
        ready = prepare(rows, to_forecast(spark, sf_dir), settings)
        names = [*ready.names, POSITION]
        last_edge = [f.start for f in ready.folds if ready.known.filter(F.col(POSITION) == f.start).filter(F.col("ts") < cut).count()]
        early = ready.known.filter((F.col("ts") < cut) & (F.col(POSITION) < max(last_edge)))
        seen.append({r.reading_id: tuple(r[n] for n in names) + (r._fits,) for r in early.collect()})
    assert seen[0] and seen[0] == seen[1]
    assert [f.number for f in ready.folds] == [0, 1, 2] and ready.folds[-1].end == ready.known.count()


def test_several_categories_are_encoded_from_the_rows_themselves(spark):
    """As one by one, nulls among the categories; no column's means read the joins of another's."""
    value = F.pmod(F.xxhash64("id"), F.lit(100)).cast("double")
    third = F.when(F.col("id") % 3 > 0, F.col("id") % 3)
    df = with_position(spark.range(300).select("id", third.alias("c"), (F.col("id") % 7).alias("d"), value.alias("y")), Series((), ("id",)))
    edges = timefolds.even_edges(300, 5)
    both = timefolds.target_encode_by_time(df, ["c", "d"], "y", edges)
    chain = timefolds.target_encode_by_time(timefolds.target_encode_by_time(df, "c", "y", edges), "d", "y", edges)
    got, want = ({r.id: (r.c, r.d, r.c_te, r.d_te) for r in x.collect()} for x in (both, chain))
    assert got == want and len(got) == 300 and got[299][2] is not None
    # the means are read from where they were written: nothing is added up again when the rows are
    assert "Aggregate" not in both._jdf.queryExecution().optimizedPlan().toString()


def test_isolation_marks_every_row(spark):
    df = spark.range(400).select(F.col("id").alias("reading_id"), F.when(F.col("id") % 50 == 7, 1e6).otherwise(F.col("id") % 9).alias("x"))
    scored, usual = isolation.isolation_marks(df, ["x"], 0.02)
    kept = {r.reading_id for r in isolation.isolation_filter(df, ["x"], 0.02).collect()}
    rows = scored.withColumn("usual", usual).collect()
    assert len(rows) == 400 and {r.reading_id for r in rows if r.usual} == kept and 392 <= len(kept) < 400
