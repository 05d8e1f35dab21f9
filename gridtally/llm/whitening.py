"""Whitening of embeddings by a bidiagonal qd solver.

Tasks reduce their centred rows block by block to the triangle of a QR factorisation, and triangles are
merged in groups until few are left. Householder reflections turn the last triangle into a bidiagonal
matrix; the differential qd algorithm with shifts finds its singular values to high relative accuracy, and
a twisted factorisation at each of them its direction. Only squares of size (width x width) leave the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.session import materialize, release

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
# Rows that are reduced at a time, and triangles that one task merges.
BLOCK = 4096
MERGED = 32
# Larger entries would not be whole numbers in double precision.
LARGEST = float(1 << 42)
EPS = np.finfo(np.float64).eps


def whole_entries(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(vec_id, x): floor(scale * entry) + shift. Rows whose vector is null or holds null, NaN or infinite entries go."""
    x = F.col(embedding).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return df.filter(F.col(embedding).isNotNull() & finite).select(
        F.col(vec_id).alias("vec_id"), F.transform(x, lambda v: F.floor(v * float(scale)) + F.lit(shift)).alias("x")
    )


def _matrix(column: pa.Array, width: int, fill: int) -> np.ndarray:
    sizes = column.value_lengths().to_numpy()
    out = np.full((len(column), width), fill, np.int64)
    values = column.flatten().to_numpy()
    if len(values) and max(-int(values.min()), int(values.max())) > LARGEST:
        raise ValueError("an entry is beyond the range of whole numbers that are kept exactly")
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _sums(vectors: DataFrame, width: int, fill: int) -> tuple[int, np.ndarray]:
    """Rows and exact sums of each dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, np.int64)
        for batch in batches:
            x = _matrix(batch.column("x"), width, fill)
            n, total = n + len(x), total + x.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width + 1)), pa.array(np.append(total, n))], names=["i", "total"])

    found = vectors.select("x").mapInArrow(add, "i long, total long").groupBy("i").agg(F.sum("total").alias("total")).toArrow()
    out = np.zeros(width + 1, np.int64)
    out[found["i"].to_numpy()] = found["total"].to_numpy()
    return int(out[width]), out[:width]


def _exact(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums as whole numbers, of Python where 64 bits may not do."""
    if n * max(-int(x.min(initial=0)), int(x.max(initial=0))) + int(np.abs(sums).max(initial=0)) >= 1 << 62:
        return x.astype(object) * n - sums.astype(object)
    return x * n - sums


def reduced(blocks: Iterator[np.ndarray], width: int) -> np.ndarray:
    """The triangle R with R'R = the sum of the blocks' squares, taking in one block after another."""
    r = np.zeros((0, width))
    for block in blocks:
        r = np.linalg.qr(np.concatenate((r, block)), mode="r")
    return r


def _triangle(vectors: DataFrame, width: int, n: int, sums: np.ndarray, fill: int) -> np.ndarray:
    """The triangle of all centred rows, merged in groups of tasks."""

    def packed(r: np.ndarray, number: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([r.tobytes()], pa.binary())], names=["part", "r"])

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for raw in batch.column("r").to_pylist():
                yield np.frombuffer(raw, np.float64).reshape(-1, width)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def centred() -> Iterator[np.ndarray]:
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK):
                    yield (_exact(_matrix(batch.column("x").slice(at, BLOCK), width, fill), n, sums) / n).astype(np.float64)

        yield packed(reduced(centred(), width), TaskContext.get().partitionId())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield packed(reduced(unpacked(batches), width), TaskContext.get().partitionId())

    left = materialize(vectors.select("x").mapInArrow(first, "part long, r binary"), "triangles")
    while (count := left.count()) > MERGED:
        parts = -(-count // MERGED)
        grouped = left.repartitionByRange(parts, "part").sortWithinPartitions("part")
        merged = materialize(grouped.mapInArrow(merge, "part long, r binary"), "triangles")
        release(left)
        left = merged
    rows = sorted(zip(*(left.toArrow()[c].to_pylist() for c in ("part", "r"))))
    release(left)
    return reduced((np.frombuffer(raw, np.float64).reshape(-1, width) for _, raw in rows), width)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, upper diagonal and W of r = U B W', by Householder reflections from both sides."""
    width = r.shape[1]
    a = np.zeros((width, width))
    a[: len(r)] = r
    w = np.eye(width)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        size = np.linalg.norm(x)
        if size == 0 or not np.any(x[1:]):
            return None
        v = x / size
        v[0] += 1.0 if v[0] >= 0 else -1.0
        return v / np.linalg.norm(v)

    for i in range(width):
        if (v := reflector(a[i:, i].copy())) is not None:
            a[i:, i:] -= 2 * np.outer(v, v @ a[i:, i:])
        if i + 2 < width and (v := reflector(a[i, i + 1 :].copy())) is not None:
            a[i:, i + 1 :] -= 2 * np.outer(a[i:, i + 1 :] @ v, v)
            w[:, i + 1 :] -= 2 * np.outer(w[:, i + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), w


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], int, float]:
    """One differential qd step of q, e less a shift: the new q and e, the first place where it fell below 0 or -1, and the value there."""
    q2, e2, d = [], [], q[0] - shift
    for i in range(len(e)):
        if d < 0:
            return q2, e2, i, d
        top = d + e[i]
        if top == 0:
            # the matrix falls apart here
            q2.append(0.0)
            e2.append(0.0)
            d = q[i + 1] - shift
            continue
        ratio = q[i + 1] / top
        q2.append(top)
        e2.append(e[i] * ratio)
        d = d * ratio - shift
    q2.append(d)
    return q2, e2, (len(e) if d < 0 else -1), d


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the bidiagonal matrix (a, b), largest first.

    Values leave at the lower end, where the shifted steps drive the last e to 0. A shift that is too large
    is taken back and made smaller; without a shift a step cannot fail.
    """
    q, e = [float(v) ** 2 for v in a], [float(v) ** 2 for v in b]
    found: list[float] = []
    sigma, shift = 0.0, 0.0
    while q:
        if len(q) == 1:
            found.append(sigma + q[0])
            break
        # the larger end goes up, so that the small values leave first
        if 1.5 * q[0] < q[-1]:
            q.reverse()
            e.reverse()
        tiny = (100 * EPS) ** 2
        if e[-1] <= tiny * (sigma + q[-1]):
            found.append(sigma + q.pop())
            e.pop()
            shift = min(shift, 0.25 * q[-1])
            continue
        if len(q) == 2 or e[-2] <= tiny * (sigma + q[-2]):
            # the last two stand alone: the smaller root of their quadratic, by its stable form
            x, y, z = q[-2], q[-1], e[-1]
            half = 0.5 * ((x - y) + z)
            larger = 0.5 * ((x + y) + z) + np.sqrt(half * half + y * z)
            found += [sigma + larger, sigma + (x * (y / larger) if larger else 0.0)]
            del q[-2:], e[-2:]
            shift = 0.0
            continue
        while True:
            q2, e2, failed, d = _transform(q, e, shift)
            if failed < 0:
                break
            # a failure in the last place leaves an excellent shift
            shift = (shift + d) * (1 - 2 * EPS) if failed == len(e) and shift + d > 0 and d > -0.5 * shift else 0.25 * shift
            if shift <= EPS * EPS * max(q):
                shift = 0.0
        q, e, sigma = q2, e2, sigma + shift
        # what is left below the last value bounds the next shift
        last = q[-1] - e[-1] * (q[-1] / (q[-1] + e[-1])) if q[-1] > 0 else 0.0
        shift = max(0.0, min(last, 0.75 * min(q)))
    return np.sort(np.array(found))[::-1]


def twisted(a: np.ndarray, b: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray]:
    """Columns z with (B'B - value) z = gamma e_r for each twist r, of unit length, and the sizes of gamma over |z|.

    The stationary qd factorisation from above and the progressive one from below meet at r; the column of
    the least residual is the singular direction.
    """
    n = len(a)
    d, low = a * a, np.append(b / a[:-1], 0.0)
    tiny = EPS * EPS * (value + d.max())
    up, s = np.empty(n), np.empty(n)
    lp = np.empty(n)
    s[0] = -value
    for i in range(n):
        up[i] = s[i] + d[i]
        if abs(up[i]) < tiny:
            up[i] = -tiny
        lp[i] = d[i] * low[i] / up[i]
        if i + 1 < n:
            s[i + 1] = lp[i] * low[i] * s[i] - value
    down, p = np.empty(n), np.empty(n)
    um = np.zeros(n)
    p[n - 1] = d[n - 1] - value
    for i in range(n - 2, -1, -1):
        down[i + 1] = d[i] * low[i] ** 2 + p[i + 1]
        if abs(down[i + 1]) < tiny:
            down[i + 1] = -tiny
        um[i] = low[i] * d[i] / down[i + 1]
        p[i] = p[i + 1] * d[i] / down[i + 1] - value
    gamma = s + p + value
    z = np.zeros((n, n))
    for r in range(n):
        z[r, r] = 1.0
        for i in range(r - 1, -1, -1):
            z[i, r] = -lp[i] * z[i + 1, r]
        for i in range(r, n - 1):
            z[i + 1, r] = -um[i] * z[i, r]
    size = np.linalg.norm(z, axis=0)
    return z / size, np.abs(gamma) / size


def directions(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The `most` largest squares of r's singular values, above rounding, and their right directions as columns.

    Values that agree to five digits share a space; there each takes, of the twisted columns, the first that
    is not yet spanned, made orthogonal to those before.
    """
    a, b, w = bidiagonal(r)
    norm = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if norm == 0:
        return np.zeros(0), np.zeros((len(w), 0))
    a, b = a / norm, b / norm
    # backward stable: smaller than the rounding of the reflections
    a = np.where(np.abs(a) < EPS, np.where(a < 0, -EPS, EPS), a)
    cuts = [0, *(np.flatnonzero(np.abs(b) <= len(a) * EPS) + 1).tolist(), len(a)]
    pairs: list[tuple[float, int, int]] = []
    for lo, hi in zip(cuts, cuts[1:]):
        pairs += [(v, lo, hi) for v in dqds(a[lo:hi], b[lo : hi - 1]).tolist()]
    pairs.sort(key=lambda x: (-x[0], x[1]))
    floor = pairs[0][0] * len(a) * EPS * 16
    values, columns = [], []
    for value, lo, hi in pairs[:most]:
        if value <= floor:
            break
        z, size = twisted(a[lo:hi], b[lo : hi - 1], value)
        near = [c[lo:hi] for c, v, at in columns if at == lo and abs(v - value) <= 1e-5 * value]
        best = None
        order = np.argsort(size, kind="stable")
        # only columns that solve the equation lie in the space
        for i in order[size[order] <= max(1e-12 * value, 2 * size[order[0]])]:
            x = z[:, i]
            for _ in range(2):
                for y in near:
                    x = x - (x @ y) * y
            left = np.linalg.norm(x)
            if best is None or left > best[0]:
                best = (left, x / max(left, 1e-300))
            if left > 0.5:
                break
        column = np.zeros(len(a))
        column[lo:hi] = best[1]
        columns.append((column, value, lo))
        values.append(value * norm * norm)
    found = np.stack([w @ c for c, _, _ in columns], axis=1)
    return np.array(values), found / np.linalg.norm(found, axis=0)


def whiten(vectors: DataFrame, most: int = COMPONENTS, fill: int = SHIFT) -> DataFrame:
    """For each row of (vec_id, x), x whole numbers: its whitened coordinates and how they fit.

    `vec_id`, `n` rows, `deviation` decimal (sum over dimensions of (n x - S)^2, exact), `whitened` and
    `explained` arrays, `identity_error`. Component c is the unit eigenvector of x's covariance (divisor n)
    with the c-th largest eigenvalue e, `whitened` the centred row projected on it over sqrt(e), `explained`
    e over the trace. `identity_error` is the largest entry of whitened's covariance less the identity.

    There are at most `most` components, and only those whose eigenvalue is more than rounding: one row,
    equal rows and constant dimensions give fewer, down to none, then the arrays are empty and the error
    0. Equal eigenvalues have an orthonormal set of directions, any of which are right. Rows count as often
    as they come; null ids are kept. Shorter vectors are filled up with `fill`, empty ones too. An empty
    table gives no rows. Numbers beyond 2^42 raise an error.
    """
    spark = vectors.sparkSession
    width = vectors.agg(F.max(F.size("x"))).first()[0] or 0
    n, sums = _sums(vectors, width, fill) if width else (vectors.count(), np.zeros(0, np.int64))
    values, basis = np.zeros(0), np.zeros((width, 0))
    explained: list[float] = []
    if width and n:
        r = _triangle(vectors, width, n, sums, fill)
        values, basis = directions(r, most)
        explained = (values / max((r * r).sum(), 1e-300)).tolist()
    shared = spark.sparkContext.broadcast((basis / np.sqrt(values / n) if len(values) else basis, sums))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        onto, sums = shared.value
        for batch in batches:
            off = _exact(_matrix(batch.column("x"), width, fill), n, sums)
            small = off.dtype != object and int(np.abs(off).max(initial=0)) ** 2 * max(width, 1) < 1 << 62
            if small:
                deviation = pa.array((off * off).sum(axis=1), pa.int64()).cast(pa.decimal128(38, 0))
            else:
                deviation = pa.array([Decimal(sum(v * v for v in row)) for row in off.astype(object).tolist()], pa.decimal128(38, 0))
            whitened = (off / n).astype(np.float64) @ onto
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), deviation, pa.array(list(whitened), pa.list_(pa.float64()))], names=["vec_id", "deviation", "whitened"]
            )

    kind = vectors.schema["vec_id"].dataType.simpleString()
    found = materialize(vectors.mapInArrow(project, f"vec_id {kind}, deviation decimal(38,0), whitened array<double>"), "whitened")
    return found.select(
        "vec_id",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.array(*[F.lit(v) for v in explained]).cast("array<double>").alias("explained"),
        F.lit(_identity_error(found, len(values), n)).alias("identity_error"),
    )


def _identity_error(found: DataFrame, count: int, n: int) -> float:
    """The largest entry, by size, of the covariance of the whitened columns less the identity."""
    if not count:
        return 0.0
    at = [F.col("whitened")[i] for i in range(count)]
    means = [s / n for s in found.agg(*[F.sum(c) for c in at]).first()]
    cells = [(i, j) for i in range(count) for j in range(i, count)]
    sums = found.agg(*[F.sum((at[i] - means[i]) * (at[j] - means[j])) for i, j in cells]).first()
    return max(abs(s / n - (i == j)) for (i, j), s in zip(cells, sums))


def by_component(found: DataFrame) -> DataFrame:
    """One row per row and component, from 1: `vec_id`, `component`, `n`, `deviation` long, `whitened`, `explained`, `identity_error`.

    A deviation beyond 64 bits is an error. Without components there are no rows.
    """
    return found.select(
        "vec_id", "n", F.col("deviation").cast("long").alias("deviation"), "identity_error", "explained", F.posexplode("whitened").alias("at", "value")
    ).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        F.col("value").alias("whitened"),
        F.col("explained")[F.col("at")].alias("explained"),
        "identity_error",
    )
