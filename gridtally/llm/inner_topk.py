"""Exact top-k inner products by norm-sorted blocks, SVD-rotated partial sums and Cauchy-Schwarz bounds.

Vectors are whole numbers, so scores are exact. Candidates are sorted by descending length and packed
into blocks of fixed size. All vectors are rotated into the principal directions of the candidates, so the
first few coordinates carry most of a product; the rest is at most the product of the residual lengths.
The block of the longest vectors gives every query a first k-th best score; a block of queries meets only
the blocks whose longest vector can still reach one of these, and there only pairs whose bound does are
multiplied out. Blocks of like length are held together, so that a block of queries travels once for all of
them and its k-th best scores rise from one to the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtally.session import materialize

SCALE = 1024
BLOCK = 4096
QUERY_BLOCK = 128
# Rotated coordinates summed before the bound is tested.
LEADING = 24
# Blocks of vectors, and their bytes, that a task holds at most; smaller inputs are dealt out to this many groups.
GROUP = 16
GROUP_BYTES = 64 << 20
GROUPS = 64


def whole_vectors(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, x): floor(scale * component), as whole numbers.

    Left out are rows without an id and vectors that are null, or hold null, NaN or infinite components. A
    number from 2^53 on, which doubles do not tell from its neighbours, is an error.
    """
    x = F.col(embedding).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return df.filter(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & finite).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.transform(x, lambda v: _whole(v * float(scale))).alias("x")
    )


def _whole(v: Column) -> Column:
    return F.when(F.abs(v) < float(1 << 53), F.floor(v)).otherwise(F.raise_error(F.lit("a component is beyond the whole numbers of doubles")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a matrix; shorter vectors are filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = column.value_lengths().to_numpy()
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy()
    return out


def _gram(vectors: DataFrame, width: int) -> np.ndarray:
    """Sum of the outer products of all vectors, added up in tasks and then in Spark, cell by cell."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = _matrix(batch.column("x"), width).astype(np.float64)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width)), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "cells"]
        )

    summed = (
        vectors.mapInArrow(partial, "i long, cells array<double>")
        .select("i", F.posexplode("cells").alias("j", "cell"))
        .groupBy("i", "j")
        .agg(F.sum("cell").alias("cell"))
        .toArrow()
    )
    out = np.zeros((width, width))
    out[summed["i"].to_numpy(), summed["j"].to_numpy()] = summed["cell"].to_numpy()
    return out


def _packed(x: np.ndarray) -> bytes:
    """The numbers in as few bytes each as the largest needs."""
    least, most = x.min(initial=0), x.max(initial=0)
    kind = next(t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= least and most <= np.iinfo(t).max)
    return x.astype(kind).tobytes()


def _blocks(vectors: DataFrame, width: int, rows: int) -> DataFrame:
    """Packed blocks (block, most, ids, x) of the vectors as they come in each partition."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        ids, xs, held, n = [], [], 0, 0

        def flush(ids: np.ndarray, x: np.ndarray, n: int) -> pa.RecordBatch:
            most = float(np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)).max())
            return pa.RecordBatch.from_arrays(
                [pa.array([base + n]), pa.array([most]), pa.array([ids.tobytes()], pa.binary()), pa.array([_packed(x)], pa.binary())],
                names=["block", "most", "ids", "x"],
            )

        for batch in batches:
            ids.append(batch.column("vec_id").to_numpy())
            xs.append(_matrix(batch.column("x"), width))
            held += batch.num_rows
            while held >= rows:
                i, x = np.concatenate(ids), np.concatenate(xs)
                yield flush(i[:rows], x[:rows], n)
                ids, xs, held, n = [i[rows:]], [x[rows:]], held - rows, n + 1
        if held:
            yield flush(np.concatenate(ids), np.concatenate(xs), n)

    return vectors.mapInArrow(pack, "block long, most double, ids binary, x binary")


def _unpacked(ids: bytes, x: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(x, f"i{len(x) // (len(ids) * width)}").reshape(len(ids), width).astype(np.int64)


def _longest(rotated: np.ndarray) -> float:
    """The largest length of any row."""
    return float(np.sqrt((rotated**2).sum(axis=1)).max(initial=0.0))


def _best(
    q_ids: np.ndarray, q: np.ndarray, rq: np.ndarray, ids: np.ndarray, x: np.ndarray, rx: np.ndarray, least: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query rows, candidate rows and scores of the best k candidates of each query that may reach `least`; `rq`, `rx` are rotated."""
    leading = min(LEADING, rq.shape[1])
    partial = rq[:, :leading] @ rx[:, :leading].T
    left_q = np.sqrt((rq[:, leading:] ** 2).sum(axis=1))
    left_x = np.sqrt((rx[:, leading:] ** 2).sum(axis=1))
    bound = partial + left_q[:, None] * left_x[None, :]
    # rounding of the rotation must never cost a candidate
    slack = 1.0 + 1e-9 * np.sqrt((rq**2).sum(axis=1))[:, None] * np.sqrt((rx**2).sum(axis=1))[None, :]
    may = (bound + slack >= least[:, None]) & (ids[None, :] != q_ids[:, None])
    i, j = np.nonzero(may)
    largest = _longest(rq) * _longest(rx)
    if largest < float(1 << 52) and len(i) * 64 > may.size:
        # doubles hold every sum on the way, so many pairs are multiplied out at once and still exact
        score = (q.astype(np.float64) @ x.T.astype(np.float64))[i, j].astype(np.int64)
    else:
        if largest >= float(1 << 62):
            # sums may not fit 64 bits: whole numbers of Python, of which only the best have to fit
            q, x = q.astype(object), x.astype(object)
        score = np.empty(len(i), q.dtype)
        for a in range(0, len(i), 1 << 16):
            score[a : a + (1 << 16)] = (q[i[a : a + (1 << 16)]] * x[j[a : a + (1 << 16)]]).sum(axis=1)
    reach = score >= least[i]
    i, j, score = i[reach], j[reach], score[reach]
    order = np.lexsort((ids[j], -score, i)) if score.dtype != object else np.array(sorted(range(len(i)), key=lambda n: (i[n], -score[n], ids[j[n]])), int)
    i, j, score = i[order], j[order], score[order]
    top = _first(i, k)
    best = score[top]
    if len(best) and score.dtype == object and max(abs(s) for s in best.tolist()) >= 1 << 63:
        raise OverflowError("a score is beyond 64 bits")
    return i[top], j[top], best.astype(np.int64)


def _first(i: np.ndarray, k: int) -> np.ndarray:
    """Which entries are among the first k of their row; rows ascend."""
    return np.arange(len(i)) - np.searchsorted(i, i, "left") < k


def _raised(least: np.ndarray, i: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """`least`, or the worst of a row's scores where there are k of them and it is higher."""
    full = np.bincount(i, minlength=len(least)) == k
    worst = np.full(len(least), np.inf)
    np.minimum.at(worst, i, score)
    return np.where(full, np.maximum(worst, least), least)


def _needed(q: np.ndarray, least: np.ndarray) -> float:
    """The length of the shortest candidate that any query may still need."""
    size = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
    need = np.where(least > 0, least / np.maximum(size, 1e-300), 0.0)
    return float(need.min()) * (1 - 1e-9)


def _best_of_group(
    q_ids: np.ndarray, q: np.ndarray, least: np.ndarray, held: list[tuple[float, np.ndarray, np.ndarray, np.ndarray]], basis: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query rows, ids and scores of the best k candidates in blocks (most, ids, x, rotated x) of descending length."""
    rq = q @ basis
    rows, found, scores = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    for most, ids, x, rx in held:
        if most < _needed(q, least):
            break
        i, j, score = _best(q_ids, q, rq, ids, x, rx, least, k)
        rows, found, scores = np.concatenate((rows, i)), np.concatenate((found, ids[j])), np.concatenate((scores, score))
        order = np.lexsort((found, -scores, rows))
        order = order[_first(rows[order], k)]
        rows, found, scores = rows[order], found[order], scores[order]
        least = _raised(least, rows, scores, k)
    return rows, found, scores


def inner_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """Each query's k best candidates: `query_id`, `rank` from 1, `vec_id`, `score`; both inputs (vec_id, x).

    A query is not its own candidate: rows of its id do not count. Ties go to the smaller id. With fewer
    than k candidates all come back; without any, or without queries, none. Repeated rows of an id are
    candidates each; as queries they count once. Missing components count as zero. A score among the best of
    any two blocks that does not fit 64 bits is an error, unless a longer block had k better ones already.
    """
    spark = vectors.sparkSession
    queries = queries.dropDuplicates(["vec_id"])
    shape = vectors.agg(F.max(F.size("x")).alias("width"), F.count("*").alias("n")).first()
    width = max(shape.width or 0, queries.agg(F.max(F.size("x"))).first()[0] or 0, 1)
    values, directions = np.linalg.eigh(_gram(vectors, width))
    basis = np.ascontiguousarray(directions[:, np.argsort(-values)])
    norm = F.aggregate(F.col("x"), F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double"))
    parts = max(1, -(-(shape.n or 0) // (4 * block)))
    by_length = vectors.withColumn("norm", norm).repartitionByRange(parts, F.col("norm").desc(), F.col("vec_id"))
    by_length = by_length.sortWithinPartitions(F.col("norm").desc(), F.col("vec_id")).select("vec_id", "x")
    blocks = materialize(_blocks(by_length, width, block), "vectors")
    asked = materialize(
        _blocks(queries.select("vec_id", "x").repartition(max(1, -(-(shape.n or 0) // (400 * query_block)))), width, query_block), "queries"
    )
    # 16 bytes per block of vectors; of the blocks themselves only one comes to the driver
    directory = blocks.select("block", "most").toArrow()
    numbers, most = directory["block"].to_numpy(), directory["most"].to_numpy()
    order = np.lexsort((numbers, -most))
    numbers, most = numbers[order], most[order]
    together = max(1, min(GROUP, GROUP_BYTES // (8 * block * width), len(numbers) // GROUPS))
    longest = blocks.filter(F.col("block") == int(numbers[0])).collect() if len(numbers) else []
    shared = spark.sparkContext.broadcast((basis, [(r.ids, r.x) for r in longest], most))

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        basis, seeds, most = shared.value
        seeds = [(i, x, x @ basis) for i, x in (_unpacked(*seed, width) for seed in seeds)]
        for batch in batches:
            least, meets = [], []
            for ids, x in zip(batch.column("ids").to_pylist(), batch.column("x").to_pylist()):
                q_ids, q = _unpacked(ids, x, width)
                bottom = np.full(len(q_ids), -np.inf)
                for seed in seeds:
                    i, _, score = _best(q_ids, q, q @ basis, *seed, bottom, k)
                    bottom = _raised(bottom, i, score, k)
                least.append(bottom.tobytes())
                # blocks descend by length, so those that any query of the block still needs come first
                meets.append(np.arange(-(-int((most >= _needed(q, bottom)).sum()) // together), dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(least, pa.binary()), pa.array(meets, pa.list_(pa.int32()))],
                names=[*batch.schema.names, "least", "meets"],
            )

    places = spark.createDataFrame(
        pa.table({"block": numbers, "place": np.arange(len(numbers))}), "block long, place long"
    )
    held = blocks.join(F.broadcast(places), "block").select(
        F.floor(F.col("place") / together).cast("int").alias("group"), "place", "ids", "x", F.lit(None).cast("binary").alias("least")
    )
    asking = asked.mapInArrow(start, "block long, most double, ids binary, x binary, least binary, meets array<int>").select(
        F.explode("meets").alias("group"), F.lit(len(numbers)).cast("long").alias("place"), "ids", "x", "least"
    )
    # no join of the two, which Spark might broadcast: neither side's size is known beforehand
    groups = max(1, -(-len(numbers) // together))
    met = held.unionByName(asking).repartitionById(groups, F.col("group")).sortWithinPartitions("group", "place")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        basis, _, most = shared.value
        at, held = None, []
        for batch in batches:
            for group, place, ids, x, least in zip(*(batch.column(c) for c in ("group", "place", "ids", "x", "least"))):
                if group.as_py() != at:
                    at, held = group.as_py(), []
                ids, x = _unpacked(ids.as_py(), x.as_py(), width)
                if not least.is_valid:
                    held.append((most[place.as_py()], ids, x, x @ basis))
                    continue
                i, found, best = _best_of_group(ids, x, np.frombuffer(least.as_py(), np.float64), held, basis, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[i]), pa.array(found), pa.array(best)], names=["query_id", "vec_id", "score"]
                )

    found = met.mapInArrow(score, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
