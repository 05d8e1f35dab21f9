import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridtally.llm.whitening import bidiagonal, by_component, directions, dqds, reduced, whiten, whole_entries


def whole(rows):
    """{position: whole entries} of the vectors that take part."""
    kept = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max((len(v) for _, v in kept), default=0)
    return [(i, [math.floor(1024 * x) + 100_000 for x in v] + [100_000] * (width - len(v))) for i, v in kept]


def hold(df, rows, most=8):
    """The operator's rows against plain numpy and whole numbers of Python."""
    kept = whole(rows)
    n, x = len(kept), np.array([v for _, v in kept], object)
    sums = x.sum(axis=0)
    off = (x * n - sums)
    centred = (off / n).astype(float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    found = df.orderBy("vec_id", "component").collect()
    count = max((r.component for r in found), default=0)
    assert len(found) == n * count and count == min(most, int((values > values[0] * 1e-12).sum()))
    want = dict(zip([i for i, _ in kept], (off**2).sum(axis=1)))
    assert all(r.n == n and r.deviation == want[r.vec_id] for r in found)
    w = np.array([r.whitened for r in found]).reshape(n, count)
    ids = [r.vec_id for r in found[::count]]
    plain = centred[[[i for i, _ in kept].index(i) for i in ids]] @ vectors[:, :count] / np.sqrt(values[:count])
    signs = np.sign((w * plain).sum(axis=0))
    assert np.abs(w - plain * signs).max() < 1e-8
    assert np.allclose([r.explained for r in found[:count]], values[:count] / values.sum(), rtol=1e-9)
    error = np.abs((w - w.mean(axis=0)).T @ (w - w.mean(axis=0)) / n - np.eye(count)).max()
    assert {r.identity_error for r in found} == {found[0].identity_error}
    assert found[0].identity_error < 1e-9 and abs(found[0].identity_error - error) < 1e-12


def test_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    hold(by_component(whiten(whole_entries(table))), rows)
    hold(by_component(whiten(whole_entries(table.repartition(40)))), rows)


def test_odd_rows(spark):
    draw = np.random.default_rng(3)
    rows = [(i, [float(x) for x in draw.normal(size=5) * [9, 3, 1, 0.3, 0]]) for i in range(200)]
    rows += [(200, None), (201, [1.0, None, 2.0, 0.0, 0.0]), (202, [float("nan")] * 5), (203, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (204, [4.0, 2.0]), (205, [])]
    df = spark.createDataFrame([(*r, "x", 1.5) for r in rows], "vec_id long, embedding array<double>, whitened string, n double").repartition(6)
    out = by_component(whiten(whole_entries(df)))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    hold(out, rows)


def test_large_numbers_stay_exact(spark):
    rows = [(i, [2.0**29 * (i % 7), -(2.0**29) * (i % 5), 0.25 * i]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = whiten(whole_entries(df)).orderBy("vec_id").collect()
    x = np.array([v for _, v in whole(rows)], object)
    assert [int(r.deviation) for r in found] == [int(v) for v in ((x * 50 - x.sum(axis=0)) ** 2).sum(axis=1)]
    with pytest.raises(Exception, match="beyond the range|overflow"):
        whiten(whole_entries(df.withColumn("embedding", F.transform("embedding", lambda v: v * 1e9)))).collect()


def test_few_or_equal_rows(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, [0.5, 1.0])], [(1, [0.5, 1.0])] * 4, [(None, []), (2, [])]):
        found = whiten(whole_entries(spark.createDataFrame(rows, schema)))
        assert [(r.n, int(r.deviation), r.whitened, r.identity_error) for r in found.collect()] == [(len(rows), 0, [], 0.0)] * len(rows)
        assert by_component(found).count() == 0
    copies = [(i, [0.5, 1.0]) for i in range(300)] + [(300, [1.5, 0.0]), (None, [0.25, 0.0])]
    hold_ids = [(i if i is not None else -1, v) for i, v in copies]
    df = spark.createDataFrame(copies, schema).repartition(3)
    hold(by_component(whiten(whole_entries(df.fillna(-1, ["vec_id"])))), hold_ids)
    assert by_component(whiten(whole_entries(df))).filter("vec_id is null").count() == 2


def test_blocks_reduce_like_the_whole():
    x = np.random.default_rng(1).normal(size=(1000, 12))
    r = reduced((x[i : i + 37] for i in range(0, 1000, 37)), 12)
    assert np.allclose(r.T @ r, x.T @ x)
    a, b, w = bidiagonal(r)
    full = np.diag(a) + np.diag(b, 1)
    assert np.allclose(w.T @ w, np.eye(12)) and np.allclose(w @ full.T @ full @ w.T, x.T @ x)


def test_singular_values_are_accurate_at_every_size():
    a = 10.0 ** -np.arange(30.0)
    b = 0.3 * a[:-1]
    # of a bidiagonal matrix the product of the values is that of the diagonal, to the last digits
    found = dqds(a, b)
    assert abs(np.log(found).sum() - 2 * np.log(a).sum()) < 1e-10
    assert np.allclose(dqds(np.ones(40), np.ones(39)), 4 * np.cos(np.arange(1, 41) * np.pi / 81) ** 2, rtol=1e-12)


def test_clustered_and_missing_directions():
    draw = np.random.default_rng(0)
    q, _ = np.linalg.qr(draw.normal(size=(64, 64)))
    wilkinson = np.diag(np.abs(np.arange(21) - 10.0) + 20) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
    cases = [
        np.diag([3.0, 3, 3, 3, 2, 2, 1, 0, 0]),
        np.linalg.qr(q * np.array([5.0] * 10 + [1.0] * 54) @ q.T, mode="r"),
        np.linalg.qr((q * (1 + 1e-9 * np.arange(64))) @ q.T, mode="r"),
        np.linalg.qr(draw.normal(size=(5, 64)), mode="r"),
        np.linalg.cholesky(wilkinson).T,
    ]
    for r in cases:
        values, z = directions(r, 20)
        plain = np.linalg.svd(r, compute_uv=False)[: len(values)] ** 2
        square = r.T @ r
        assert np.allclose(values, plain, rtol=1e-12)
        assert np.abs(square @ z - z * values).max() < 1e-12 * plain[0]
        assert np.abs(z.T @ z - np.eye(len(values))).max() < 1e-9
