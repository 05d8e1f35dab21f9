"""Packing of tokenised documents into sequences of bounded length by vector best-fit.

A sequence has three capacities: tokens, documents, and attention cost (the sum of squared piece lengths,
what attention within pieces costs). Pieces come longest first; a piece goes to the open sequence that has
room in every capacity and scores best, by the least weighted norm of what room is left or by the largest
weighted dot product of its demand with the room; without one it opens a sequence. Tasks pack their own
documents in blocks, so nothing is shuffled and a block leaves at most a few sequences half empty.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.hashing import pieces
from gridtally.llm.tokens import encoder, tokenizer_path
from gridtally.session import text_batches

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
LENGTH = 1024
# Pieces that are packed together.
BLOCK = 8192
# Bytes of text that are encoded at a time.
PART_BYTES = 1 << 20

_PIECE = (
    "piece int, start long, length long, ids_crc32 long, sequence_id long, `offset` long"
)


@dataclass
class Capacity:
    """What a sequence may hold; a limit of None is as much as its tokens allow."""

    tokens: int = LENGTH
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3)
    rule: str = "norm"

    def limits(self) -> np.ndarray:
        return np.array(
            [self.tokens, self.documents or self.tokens, self.attention or self.tokens**2], np.float64
        )


@dataclass
class _Open:
    """Room left in sequences that still may take a piece."""

    limits: np.ndarray
    weights: np.ndarray
    rule: str
    room: np.ndarray = field(init=False)
    ids: np.ndarray = field(init=False)
    n: int = 0
    made: int = 0

    def __post_init__(self) -> None:
        self.room = np.empty((1024, 3))
        self.ids = np.empty(1024, np.int64)

    def place(self, demand: np.ndarray, least: float) -> tuple[int, int]:
        """Put a piece into the best sequence; returns the sequence and the tokens before the piece."""
        room = self.room[: self.n]
        fits = np.flatnonzero((room >= demand).all(axis=1))
        if len(fits):
            if self.rule == "norm":
                score = -((((room[fits] - demand) / self.limits) ** 2) @ self.weights)
            else:
                score = (room[fits] / self.limits) @ (self.weights * demand / self.limits)
            at = int(fits[score.argmax()])
        else:
            at = self._add()
        before = int(self.limits[0] - self.room[at, 0])
        self.room[at] -= demand
        sequence = int(self.ids[at])
        if (self.room[at] < (least, 1, 1)).any():
            self.n -= 1
            self.room[at], self.ids[at] = self.room[self.n], self.ids[self.n]
        return sequence, before

    def _add(self) -> int:
        if self.n == len(self.ids):
            self.room, self.ids = np.concatenate((self.room, self.room)), np.concatenate((self.ids, self.ids))
        self.room[self.n], self.ids[self.n] = self.limits, self.made
        self.n += 1
        self.made += 1
        return self.n - 1


def best_fit(lengths: Sequence[int], capacity: Capacity) -> tuple[np.ndarray, np.ndarray, int]:
    """For every piece its sequence, from 0, and its place there; and the number of sequences."""
    lengths = np.asarray(lengths, np.int64)
    limits = capacity.limits()
    demands = np.stack((lengths, np.ones_like(lengths), lengths**2), axis=1).astype(np.float64)
    if (demands > limits).any():
        raise ValueError("a piece is beyond a sequence's capacity")
    bins = _Open(limits, np.array(capacity.weights), capacity.rule)
    sequence, before = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    least = float(lengths.min()) if len(lengths) else 0.0
    # a piece that fills a sequence is alone in it
    full = np.flatnonzero(lengths == capacity.tokens)
    sequence[full], before[full] = np.arange(len(full)), 0
    bins.made = len(full)
    rest = np.flatnonzero(lengths != capacity.tokens)
    for i in rest[np.argsort(-lengths[rest], kind="stable")].tolist():
        sequence[i], before[i] = bins.place(demands[i], least)
    return sequence, before, bins.made


def _cut(n: int, length: int) -> list[tuple[int, int]]:
    """Starts and lengths of a document's pieces; only the first may be shorter than the rest."""
    if n <= length:
        return [(0, n)]
    first = n % length or length
    return [(0, first)] + [(s, length) for s in range(first, n, length)]


def pack_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: Capacity | None = None,
    path: str | None = None,
    keeps_space: bool = True,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: the id, `piece`, `start`, `length`, `ids_crc32`, `sequence_id`, `offset`; with
    `with_ids` also `ids`, the piece's ids as unsigned 32-bit integers.

    A document's ids are those of its whole text (null is empty) and `end_id`. Only a document longer than
    a sequence is cut. Pieces of a sequence lie one after another from offset 0. Every row is packed, also
    rows without an id or with one that others have; an empty table gives no pieces. Other columns are
    ignored. A tighter attention capacity must still admit a full piece.
    """
    text_batches(docs.sparkSession)
    capacity = capacity or Capacity()
    path = path or tokenizer_path(TOKENIZER)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path, keeps_space)
        base = TaskContext.get().partitionId() << 36
        waiting: list[tuple] = []

        def flush() -> pa.RecordBatch:
            nonlocal base
            sequence, before, made = best_fit([w[3] for w in waiting], capacity)
            columns = list(zip(*waiting))
            arrays = [
                pa.array(columns[0], pa.int64()),
                pa.array(columns[1], pa.int32()),
                pa.array(columns[2], pa.int64()),
                pa.array(columns[3], pa.int64()),
                pa.array(columns[4], pa.int64()),
                pa.array(sequence + base),
                pa.array(before),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            if with_ids:
                arrays.append(pa.array(columns[5], pa.binary()))
                names.append("ids")
            base += made
            waiting.clear()
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            for part in pieces(batch, "text", PART_BYTES):
                ids, offsets = words.arrays(part.column("text"))
                raw = np.insert(ids, offsets[1:], end_id).astype("<u4").tobytes()
                ends = (offsets + np.arange(len(offsets))).tolist()
                for owner, a, b in zip(part.column("doc_id").to_pylist(), ends[:-1], ends[1:]):
                    for i, (start, n) in enumerate(_cut(b - a, capacity.tokens)):
                        mine = raw[4 * (a + start) : 4 * (a + start + n)]
                        waiting.append((owner, i, start, n, zlib.crc32(mine), mine if with_ids else None))
                    if len(waiting) >= BLOCK:
                        yield flush()
        if waiting:
            yield flush()

    schema = f"doc_id long, {_PIECE}" + (", ids binary" if with_ids else "")
    out = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(pack, schema)
    return out.withColumnRenamed("doc_id", doc_id)
