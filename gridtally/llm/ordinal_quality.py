"""Graded quality of texts by cumulative-link (proportional odds) regression on hashed words.

All grades share one weight vector over hashed words; ordered thresholds say how likely a text is of a
grade or a better one: P(grade >= j) = 1 / (1 + exp(threshold_j - weights . text)). Only words whose
presence goes along with the grade beyond chance have a weight, so the rare words of single texts have none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.hashing import LOWER_CODE, pieces, prefix_sums, substring_hashes, text_bytes

CELL_BITS = 18
# Rated texts that the model is fitted on, drawn by a hash of the text.
RATED_TEXTS = 8000
# Twice the log likelihood ratio from which a word's presence counts as related to the grade.
RELATED = 25.0
STEPS = 300
RATE = 0.05
MOMENTUM = 0.9
SHRINK = 1e-3

# Bytes of letters (all beyond ASCII too), digits, marks and white space.
_KIND = np.full(256, 2, np.uint8)
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 0
_KIND[0x30:0x3A] = 1
_KIND[[0x20, *range(0x09, 0x0E)]] = 3


@dataclass
class GradeModel:
    """Weights by hash cell and ordered thresholds, one less than the grades."""

    grades: list[float]
    weights: np.ndarray
    thresholds: np.ndarray


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash cell of every text's distinct tokens: runs of letters, digits or marks, A-Z in lower case."""
    data, offsets = text_bytes(texts)
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _KIND[data]
    opens = np.concatenate(([True], kind[1:] != kind[:-1]))
    opens[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(opens)
    ends = np.append(starts[1:], len(data))
    solid = kind[starts] != 3
    starts, ends = starts[solid], ends[solid]
    hashes = substring_hashes(prefix_sums(data, LOWER_CODE), starts, ends)
    row = np.searchsorted(offsets, starts, "right") - 1
    both = np.unique((row << CELL_BITS) | (hashes >> np.uint64(64 - CELL_BITS)).astype(np.int64))
    return both >> CELL_BITS, both & ((1 << CELL_BITS) - 1)


def _upper(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def _related(rows: np.ndarray, cells: np.ndarray, grade: np.ndarray, n_grades: int) -> np.ndarray:
    """Cells whose presence is related to some split of the grades, by the log likelihood ratio."""
    used, column = np.unique(cells, return_inverse=True)
    total = np.bincount(column, minlength=len(used)).astype(np.float64)
    share = total / len(grade)
    best = np.zeros(len(used))

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0.0)

    for j in range(1, n_grades):
        above = grade >= j
        high = np.bincount(column, above[rows], len(used))
        low, n_high = total - high, above.sum()
        n_low = len(grade) - n_high
        ratio = part(high, n_high * share) + part(low, n_low * share)
        ratio += part(n_high - high, n_high * (1 - share)) + part(n_low - low, n_low * (1 - share))
        best = np.maximum(best, 2 * ratio)
    return used[best >= RELATED]


def _fit(rows: np.ndarray, cells: np.ndarray, grade: np.ndarray, n_grades: int) -> tuple[np.ndarray, np.ndarray]:
    """Likelihood ascent with momentum; thresholds stay ordered as sums of positive gaps."""
    n = len(grade)
    used = _related(rows, cells, grade, n_grades)
    mine = np.isin(cells, used)
    rows, column = rows[mine], np.searchsorted(used, cells[mine])
    # a cell's unit is the root of its frequency, so that rare and common words learn alike
    unit = np.maximum(np.sqrt(np.bincount(column, minlength=len(used)) / n), 0.02)
    value = 1 / unit[column]
    weights, speed = np.zeros(len(used)), np.zeros(len(used))
    shares = np.array([(grade >= j).mean() for j in range(1, n_grades)]).clip(1e-3, 1 - 1e-3)
    thresholds = -np.log(shares / (1 - shares))
    shape = np.concatenate((thresholds[:1], np.log(np.maximum(np.diff(thresholds), 1e-2))))
    shape_speed = np.zeros(len(shape))
    # rare grades count more than their share
    importance = (1 / np.maximum(np.bincount(grade, minlength=n_grades), 1))[grade] ** 0.5
    importance /= importance.sum()
    for _ in range(STEPS):
        edges = np.concatenate(([-np.inf], np.cumsum(np.concatenate((shape[:1], np.exp(shape[1:])))), [np.inf]))
        score = np.bincount(rows, value * weights[column], n)
        upto, below = _upper(edges[grade + 1] - score), _upper(edges[grade] - score)
        likely = np.maximum(upto - below, 1e-9)
        d_upto, d_below = importance * upto * (1 - upto) / likely, importance * below * (1 - below) / likely
        gradient = np.bincount(column, value * (d_upto - d_below)[rows], len(used)) + SHRINK * weights
        to_edge = np.bincount(grade, d_below, n_grades)[1:] - np.bincount(grade, d_upto, n_grades)[:-1]
        to_shape = np.cumsum(to_edge[::-1])[::-1]
        to_shape[1:] *= np.exp(shape[1:])
        speed = MOMENTUM * speed - RATE * gradient
        weights = weights + speed
        shape_speed = MOMENTUM * shape_speed - 0.5 * to_shape
        shape = shape + shape_speed
    whole = np.zeros(1 << CELL_BITS)
    whole[used] = weights / unit
    return whole, np.cumsum(np.concatenate((shape[:1], np.exp(shape[1:]))))


def drawn_ratings(ratings: DataFrame, texts: int = RATED_TEXTS) -> DataFrame:
    """About `texts` of the distinct ratings, drawn by a hash of the row, so few that they may be broadcast."""
    ratings = ratings.distinct()
    share = min(1.0, texts / max(ratings.count(), 1))
    return ratings.filter(F.pmod(F.xxhash64(*ratings.columns), F.lit(1 << 30)) < int(share * (1 << 30)))


def fit_grades(rated: DataFrame, text: str = "text", grade: str = "grade") -> GradeModel:
    """Fit on texts with a rating, as many as `drawn_ratings` leaves; they are gathered in one place.

    Rows without a rating are not learned from; a null text is empty. Grades may be any numbers; their
    order counts. With fewer than two grades there is nothing to tell apart, and every text gets it.
    """
    rated = rated.filter(F.col(grade).isNotNull() & ~F.isnan(F.col(grade).cast("double"))).select(
        F.col(text).alias("text"), F.col(grade).cast("double").alias("grade")
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                row, cell = features(part.column("text"))
                cuts = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
                cells = pa.ListArray.from_arrays(pa.array(cuts), pa.array(cell.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("grade"), cells], names=["grade", "cells"])

    found = rated.mapInArrow(extract, "grade double, cells array<int>").toArrow()
    given = found["grade"].to_numpy()
    grades, place = np.unique(given, return_inverse=True)
    if len(grades) < 2:
        return GradeModel(grades.tolist(), np.zeros(1 << CELL_BITS), np.zeros(0))
    cells = found["cells"].combine_chunks()
    rows = np.repeat(np.arange(len(given)), cells.value_lengths().to_numpy())
    weights, thresholds = _fit(rows, cells.flatten().to_numpy().astype(np.int64), place, len(grades))
    return GradeModel(grades.tolist(), weights, thresholds)


def grade_texts(docs: DataFrame, model: GradeModel, text: str = "text") -> DataFrame:
    """`docs` with `expected_grade` and `tail`, the probabilities of the second-lowest grade or better, and so on.

    A null or empty text has no words and is graded by the thresholds alone. Without grades both are null.
    Columns of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("expected_grade", "tail")])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        grades = np.array(fitted.grades)
        for batch in batches:
            for part in pieces(batch, text):
                row, cell = features(part.column(text))
                score = np.bincount(row, fitted.weights[cell], part.num_rows)
                tail = _upper(score[:, None] - fitted.thresholds[None, :])
                if len(grades):
                    expected = pa.array(grades[0] + tail @ np.diff(grades))
                    tails = pa.array(list(tail), pa.list_(pa.float64()))
                else:
                    expected, tails = pa.nulls(part.num_rows, pa.float64()), pa.nulls(part.num_rows, pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*part.columns, expected, tails], names=[*part.schema.names, "expected_grade", "tail"])

    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes) + ", expected_grade double, tail array<double>"
    return docs.mapInArrow(predict, schema)
