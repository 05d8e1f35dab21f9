"""Positions, blocks and quantiles against plain computation."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridtally.operators import future, ordered, quantiles, splits
from gridtally.operators.ordered import Series, over_blocks, with_position

LINE = Series(keys=(), order=("id",))


def series(spark, rows, keys=1):
    return spark.range(rows).select(
        "id",
        (F.col("id") % keys).cast("int").alias("meter_id"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) / 10).alias("x"),
    )


def as_pandas(df, *order):
    return df.toPandas().sort_values(list(order)).reset_index(drop=True)


def test_positions_of_uneven_series(spark):
    hot = F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 7 + 1).cast("int")
    df = spark.range(5000).select("id", hot.alias("meter_id"))
    out = as_pandas(with_position(df, Series(("meter_id",), ("id",))), "meter_id", "id")
    expected = out.groupby("meter_id").cumcount()
    assert (out["position"] == expected).all() and len(out) == 5000


def test_positions_with_a_null_key(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 5)], "id long, meter_id int")
    out = with_position(df, Series(("meter_id",), ("id",)))
    assert sorted(map(tuple, out.select("id", "position").collect())) == [(1, 0), (2, 1), (3, 0)]


@pytest.mark.parametrize("rows", [1, 31, 32, 33, 64, 200])
def test_blocks_equal_one_window(spark, rows):
    df = with_position(series(spark, rows), LINE)
    values = {
        "lag": ordered.lag("x", 8),
        "mean": ordered.rolling("x", 8, "mean"),
        "std": ordered.rolling("x", 8, "std"),
        "median": ordered.rolling("x", 5, "median"),
        "before": ordered.rolling_before("x", 8, "max", need=2),
        "pct": ordered.pct_change("x", 3),
        "diff": ordered.diff("x", 3),
    }
    out = as_pandas(over_blocks(df, values, LINE, block_rows=32), "id")
    x = out["x"]
    assert len(out) == rows
    expected = {
        "lag": x.shift(8),
        "mean": x.rolling(8).mean(),
        "std": x.rolling(8).std(),
        "median": x.rolling(5).median(),
        "before": x.shift(1).rolling(8, min_periods=2).max(),
        "pct": (x / x.shift(3) - 1).replace([np.inf, -np.inf], np.nan),
        "diff": x.diff(3),
    }
    for name, wanted in expected.items():
        np.testing.assert_allclose(out[name].astype(float), wanted, rtol=1e-9, atol=1e-9)


def test_blocks_must_hold_the_reach(spark):
    with pytest.raises(ValueError):
        over_blocks(series(spark, 1), {"x": ordered.lag("x", 9)}, LINE, block_rows=8)


def test_rolling_needs_values_not_rows(spark):
    df = series(spark, 12).withColumn("x", F.when(F.col("id") != 5, F.col("x")))
    out = as_pandas(over_blocks(with_position(df, LINE), {"m": ordered.rolling("x", 3, "mean")}, LINE), "id")
    wanted = out["x"].rolling(3).mean()
    np.testing.assert_allclose(out["m"].astype(float), wanted)


@pytest.mark.parametrize("width", [1, 2, 7, 31, 100])
def test_rolling_spans_of_two_columns_with_gaps(spark, width):
    df = series(spark, 700).withColumn("y", F.when(F.col("id") % 10 != 3, F.col("x") * 1e6 + 1e9))
    values = {
        f"{c}_{s}": ordered.rolling_before(c, width, s, need=min(width, 2))
        for c in ("x", "y")
        for s in ("mean", "std", "max", "min")
    }
    out = as_pandas(over_blocks(with_position(df, LINE), values, LINE, block_rows=128), "id")
    for c in ("x", "y"):
        frames = out[c].shift(1).rolling(width, min_periods=min(width, 2))
        for s in ("mean", "std", "max", "min"):
            wanted = getattr(frames, s)()
            np.testing.assert_allclose(out[f"{c}_{s}"].astype(float), wanted, rtol=1e-7, err_msg=f"{c} {s}")


def test_rolling_of_a_constant_has_no_deviation(spark):
    df = spark.range(300).select("id", F.lit(0.1).alias("x"))
    out = over_blocks(with_position(df, LINE), {"s": ordered.rolling("x", 24, "std")}, LINE, 64)
    assert out.agg(F.max("s")).first()[0] < 1e-12


def test_sequences_hold_the_rows_before(spark):
    df = with_position(series(spark, 40), LINE).withColumn("y", F.col("x") * 2)
    past = as_pandas(ordered.sequences(df, ["x"], 5, "y", series=LINE, block_rows=16), "id")
    here = as_pandas(
        ordered.sequences(df, ["x"], 5, "y", include_current=True, series=LINE, block_rows=16), "id"
    )
    x = as_pandas(df, "id")["x"].tolist()
    assert past["id"].tolist() == list(range(5, 40)) and here["id"].tolist() == list(range(4, 40))
    for i, seq in zip(past["id"], past["sequence"]):
        assert [s["x"] for s in seq] == x[i - 5 : i]
    for i, seq in zip(here["id"], here["sequence"]):
        assert [s["x"] for s in seq] == x[i - 4 : i + 1]


def test_noisy_copies_are_repeatable(spark):
    df = series(spark, 30).withColumnRenamed("id", "reading_id")
    line = Series((), ("reading_id",))
    seqs = ordered.sequences(with_position(df, line), ["x"], 4, series=line)
    first, again = (
        as_pandas(ordered.augment_sequences(seqs, 2, 0.5), "reading_id", "copy") for _ in range(2)
    )
    assert len(first) == 3 * 26

    def flat(frame):
        return np.array([[v[0] for v in s] for s in frame["sequence"]])

    assert (flat(first) == flat(again)).all()
    noise = flat(first[first["copy"] == 1]) - flat(first[first["copy"] == 0])
    assert 0.3 < noise.std() < 0.7 and abs(noise.mean()) < 0.2


def test_tiled_lag_repeats_and_falls_back_to_the_mean(spark):
    past = spark.createDataFrame([(i, float(i)) for i in range(1, 6)], "id long, x double")
    ahead = with_position(spark.createDataFrame([(i,) for i in range(10, 15)], "id long"), LINE)
    out = as_pandas(future.future_tiled_lag(past, ahead, ["x"], (3, 8), LINE), "id")
    assert out["x_lag_3"].tolist() == [3.0, 4.0, 5.0, 3.0, 4.0]
    assert out["x_lag_8"].tolist() == [3.0] * 5


def test_short_history(spark):
    past = spark.createDataFrame([(1, 4.0), (2, 6.0)], "id long, x double")
    ahead = spark.createDataFrame([(10,)], "id long")
    last = future.future_last_rolling(past, ahead, ["x"], (3,), LINE).first()
    stats = future.future_tail_stats(past, ahead, ["x"], (3,), LINE).first()
    change = future.future_tail_change(past, ahead, ["x"], (1, 3), LINE).first()
    assert last["x_rolling_mean_3"] is None and stats["x_rolling_mean_3"] == 5.0
    assert change["x_diff_1"] == 2.0 and change["x_pct_change_1"] == 0.5 and change["x_diff_3"] is None


def test_lags_across_with_interleaved_rows(spark):
    """Future rows may start before the training rows end."""
    past = series(spark, 300).filter("id % 2 = 0 OR id < 200")
    ahead = series(spark, 300).filter("id % 2 = 1 AND id >= 200").drop("x")
    values = {"lag": ordered.lag("x", 6), "mean": ordered.rolling_before("x", 6, "mean", need=3)}
    out = as_pandas(future.lags_across(past, ahead, values, LINE), "id")
    whole = as_pandas(series(spark, 300), "id")
    whole.loc[(whole["id"] % 2 == 1) & (whole["id"] >= 200), "x"] = np.nan
    whole["lag"], whole["mean"] = whole["x"].shift(6), whole["x"].shift(1).rolling(6, min_periods=3).mean()
    wanted = whole[whole["id"].isin(out["id"])].reset_index(drop=True)
    assert len(out) == 50
    np.testing.assert_allclose(out["lag"].astype(float), wanted["lag"])
    np.testing.assert_allclose(out["mean"].astype(float), wanted["mean"])


@pytest.fixture
def small_parts(monkeypatch):
    monkeypatch.setattr(quantiles, "PART_ROWS", 20)


@pytest.mark.parametrize("shape", ["even", "hot", "outliers", "two values"])
def test_quantiles_of_large_columns(spark, small_parts, shape):
    x = {
        "even": F.pmod(F.xxhash64("id"), F.lit(100003)) / 7,
        "hot": F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.col("id") / 11),
        "outliers": F.when(F.col("id") % 1000 == 0, F.lit(1e300)).otherwise(F.col("id") / 11),
        "two values": (F.col("id") % 2).cast("double"),
    }[shape]
    df = spark.range(0, 8000, 1, 8).select(x.alias("x"), F.lit(None).cast("double").alias("none"))
    wanted = [0.0, 0.01, 0.25, 0.5, 0.75, 0.975, 1.0]
    found = quantiles.exact_quantiles(df, {"x": wanted, "none": [0.5]})
    assert found["none"] == [None]
    values = df.select("x").toPandas()["x"]
    np.testing.assert_allclose(found["x"], np.quantile(values, wanted), rtol=1e-12)


def test_quantiles_leave_out_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "x double")
    assert quantiles.exact_quantiles(df, {"x": [0.5]}) == {"x": [2.0]}


def test_folds_grow_and_keep_their_gap():
    folds = splits.time_folds(103, 5, gap=4)
    assert [(f.start, f.end) for f in folds] == [(18, 35), (35, 52), (52, 69), (69, 86), (86, 103)]
    assert all(f.train_end == f.start - 4 for f in folds)


def test_roles_are_disjoint(spark):
    placed = with_position(series(spark, 60), LINE)
    roles = splits.with_roles(placed, splits.time_folds(60, 3, gap=2)).toPandas()
    for _, fold in roles.groupby("fold"):
        train = fold[fold["role"] == "train"]["position"]
        held_out = fold[fold["role"] == "validation"]["position"]
        assert train.max() + 2 < held_out.min() and len(held_out) == 15


def test_id_is_added_only_when_missing(spark):
    df = spark.createDataFrame([(3.0,), (1.0,)], "x double")
    out = as_pandas(ordered.ensure_id(df, ["x"]), "id")
    assert out["x"].tolist() == [1.0, 3.0] and out["id"].tolist() == [0, 1]
    assert ordered.ensure_id(out_df := df.withColumn("id", F.lit(7)), ["x"]) is out_df
    assert isinstance(out, pd.DataFrame)


def test_sequences_cut_out_of_blocks_are_the_same(spark):
    rows = [(i, None if i % 5 == 4 else i % 3, float(i), -float(i)) for i in range(120)]
    df = spark.createDataFrame(rows, "t long, k int, x double, y double")
    series = ordered.Series(("k",), ("t",))
    placed = ordered.with_position(df, series)
    blocks = ordered.sequence_blocks(placed, ["x", "y"], "x", series, block_rows=8)
    assert blocks.agg(F.sum(F.size("rows"))).first()[0] == 120
    for steps, current in ((8, False), (8, True), (5, False), (1, True)):
        plain = ordered.sequences(placed, ["x", "y"], steps, "x", current, series).collect()
        cut = ordered.cut_sequences(blocks, ["x", "y"], steps, "x", current, series).collect()
        shown = [{(r.k, r.t, r.position, r.x, tuple(map(tuple, r.sequence))) for r in found} for found in (plain, cut)]
        assert len(plain) == len(cut) and shown[0] == shown[1] and plain


@pytest.mark.parametrize("shift, need", [(0, 5), (1, 2)])
def test_medians_equal_plain_windows(spark, shift, need):
    """Nulls, ties, NaN, an all-null series and windows across block borders."""
    rng = np.random.default_rng(3)
    rows = []
    for key in (1, 2, 3):
        for i in range(90):
            x = None if key == 3 or rng.random() < 0.2 else float(rng.integers(0, 9))
            rows.append((key, i, float("nan") if x == 8 else x, f"é{i}", dt.datetime(2024, 1, 1)))
    df = spark.createDataFrame(rows, "key int, position long, x double, name string, at timestamp")
    values = {f"m{w}": ordered.Median("x", w, shift, need) for w in (1, 5, 24)}
    values["back"] = ordered.lag("x", 1)
    out = ordered.over_blocks(df, values, ordered.Series(("key",), ("position",)), block_rows=25)
    assert out.columns == ["key", "position", "x", "name", "at", *values]
    found = {(r.key, r.position): r for r in out.collect()}
    assert len(found) == len(rows)
    for key, i, x, name, at in rows:
        assert (found[key, i].name, found[key, i].at) == (name, at)
        for w in (1, 5, 24):
            end = i + 1 - shift
            part = [r[2] for r in rows if r[0] == key and end - w <= r[1] < end and r[2] is not None]
            part.sort(key=lambda v: (v != v, v))
            want = None
            if part and len(part) >= need:
                want = 0.5 * part[(len(part) - 1) // 2] + 0.5 * part[len(part) // 2]
            assert repr(found[key, i][f"m{w}"]) == repr(want)


def test_cut_sequences_choose_fields_once_for_a_block(spark):
    """The stored steps are cut as they are; other fields, or another order, are chosen before they are cut."""
    df = spark.createDataFrame([(i, i // 30, float(i), -float(i)) for i in range(60)], "t long, k int, x double, y double")
    series = ordered.Series(("k",), ("t",))
    placed = ordered.with_position(df, series)
    blocks = ordered.materialize(ordered.sequence_blocks(placed, ["x", "y"], "x", series, block_rows=8), "blocks")
    assert "steps" in blocks.columns
    cut = ordered.cut_sequences(blocks, ["x", "y"], 5, "x", False, series)
    assert "transform(" not in cut._jdf.queryExecution().analyzed().toString()
    for features in (["y"], ["y", "x"]):
        plain = ordered.sequences(placed, features, 5, "x", False, series).collect()
        other = ordered.cut_sequences(blocks, features, 5, "x", False, series)
        assert other.schema["sequence"].dataType.elementType.fieldNames() == features
        assert sorted((r.k, r.t, tuple(map(tuple, r.sequence))) for r in plain) == sorted(
            (r.k, r.t, tuple(map(tuple, r.sequence))) for r in other.collect()
        )


def test_ranks_of_a_column_share_a_sketch(spark, monkeypatch):
    """Three quartiles are six ranks of one range: one sketch proposes their cuts."""
    sketches = []
    sketch = F.percentile_approx

    def counted(*args):
        sketches.append(args)
        return sketch(*args)

    monkeypatch.setattr(F, "percentile_approx", counted)
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"), (-F.col("id")).alias("y"))
    found = quantiles.exact_quantiles(df, {"x": (0.25, 0.5, 0.75), "y": (0.1, 0.25)})
    assert found == {"x": [250.0, 500.0, 750.0], "y": [-900.0, -750.0]} and len(sketches) == 2
