"""Exact quantiles without gathering a column.

`percentile` keeps every distinct value in one task's memory, and `percentile_approx` is not exact.
An approximate sketch only proposes cut points; exact counts on both sides of them
tell which part holds the wanted value. Rounds go on until that part is small, and it alone is then
sorted. However good or bad the sketch, the answer is exact, and all that travels are counts and cuts.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A part with at most this many values is sorted in one task.
PART_ROWS = 100_000
CUTS = 200
# Pieces that a round cuts a part into.
PIECES = 5


@dataclass
class _Part:
    """The closed value range [low, high] of a column that holds the row of one rank."""

    column: str
    rank: int
    below: int
    rows: int
    low: float | None = None
    high: float | None = None

    @property
    def settled(self) -> bool:
        return self.rows <= PART_ROWS or (self.low is not None and self.low == self.high)

    @property
    def range(self) -> tuple[str, float | None, float | None]:
        return self.column, self.low, self.high

    def member(self) -> Column:
        """The column's value inside the range, else null."""
        value = _number(self.column)
        return value if self.low is None else F.when(value.between(self.low, self.high), value)


def _number(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def _narrow(df: DataFrame, parts: list[_Part]) -> None:
    """Cut each part at three of its values near the wanted rank and keep the piece that holds it.

    The middle cut is a piece of its own, so every round leaves a smaller part or a single value. Parts of
    the same range, such as all ranks of a column at first, share one sketch.
    """
    grid = F.array(*[F.lit(i / CUTS) for i in range(CUTS + 1)])
    ranges = {p.range: p for p in parts}
    sketch = df.agg(*[F.percentile_approx(p.member(), grid, 10_000).alias(f"p{i}") for i, p in enumerate(ranges.values())]).first()
    proposed = dict(zip(ranges, sketch))
    # ranks that lie close together share their cuts, and so their pieces
    place: dict[tuple, int] = {}
    cells: list[Column] = []
    mine = []
    for p in parts:
        near = round((p.rank - p.below) / p.rows * CUTS)
        low, mid, high = (proposed[p.range][min(max(near + step, 0), CUTS)] for step in (-2, 0, 2))
        at = place.setdefault((p.range, low, mid, high), len(place))
        mine.append(at)
        if at < len(cells) // PIECES:
            continue
        x = p.member()
        cells += [
            F.when(x < low, x),
            F.when((x >= low) & (x < mid), x),
            F.when(x == mid, x),
            F.when((x > mid) & (x <= high), x),
            F.when((x > mid) & (x > high), x),
        ]
    found = df.agg(
        *[F.struct(F.count(x).alias("n"), F.min(x).alias("low"), F.max(x).alias("high")).alias(f"c{i}") for i, x in enumerate(cells)]
    ).first()
    for p, at in zip(parts, mine):
        for piece in found[at * PIECES : (at + 1) * PIECES]:
            if p.rank - p.below < piece.n:
                p.low, p.high, p.rows = piece.low, piece.high, piece.n
                break
            p.below += piece.n


def _pick(df: DataFrame, parts: list[_Part]) -> dict[tuple[str, int], float]:
    """Values at the parts' ranks; each part's distinct values are counted, then run up in order."""
    by_range: dict[tuple, list[_Part]] = {}
    for p in parts:
        by_range.setdefault(p.range, []).append(p)
    groups = list(by_range.values())
    members = F.array(
        *[F.struct(F.lit(i).alias("part"), g[0].member().alias("value")) for i, g in enumerate(groups)]
    )
    wanted = F.element_at(
        F.array(*[F.array(*[F.lit(p.rank - p.below) for p in g]) for g in groups]),
        F.col("part") + 1,
    )
    upto = F.sum("n").over(Window.partitionBy("part").orderBy("value"))
    inside = F.coalesce(*[g[0].member() for g in groups]).isNotNull()
    rows = (
        df.filter(inside)
        .select(F.inline(members))
        .filter(F.col("value").isNotNull())
        .groupBy("part", "value")
        .agg(F.count("*").alias("n"))
        .withColumn("upto", upto)
        .withColumn(
            "hits", F.filter(wanted, lambda r: (r >= F.col("upto") - F.col("n")) & (r < F.col("upto")))
        )
        .filter(F.size("hits") > 0)
        .collect()
    )
    out = {}
    for row in rows:
        group = groups[row.part]
        for hit in row.hits:
            for p in group:
                if p.rank - p.below == hit:
                    out[p.column, p.rank] = row.value
    return out


def exact_quantiles(
    df: DataFrame, wanted: Mapping[str, Sequence[float]]
) -> dict[str, list[float | None]]:
    """Quantiles of several columns, interpolated linearly; nulls and NaN are left out.

    Runs jobs, the same at every size: one count; a narrowing round or, for very many rows, a few; one
    sort of what is left.
    """
    df = df.select(*wanted)
    counts = df.agg(*[F.count(_number(c)).alias(c) for c in wanted]).first()
    filled = {c: list(p) for c, p in wanted.items() if counts[c]}
    found = {c: [None] * len(p) for c, p in wanted.items()}
    return found | (_at_ranks(df, filled, counts.asDict()) if filled else {})


def _at_ranks(
    df: DataFrame, wanted: Mapping[str, list[float]], counts: Mapping[str, int]
) -> dict[str, list[float]]:
    parts: dict[tuple[str, int], _Part] = {}
    for column, probabilities in wanted.items():
        for p in probabilities:
            place = p * (counts[column] - 1)
            for rank in {math.floor(place), math.ceil(place)}:
                parts[column, rank] = _Part(column, rank, 0, counts[column])
    open_parts = list(parts.values())
    while open_parts:
        _narrow(df, open_parts)
        open_parts = [p for p in parts.values() if not p.settled]
    values = {key: p.low for key, p in parts.items() if p.low == p.high}
    rest = [p for key, p in parts.items() if key not in values]
    if rest:
        values |= _pick(df, rest)
    out: dict[str, list[float]] = {}
    for column, probabilities in wanted.items():
        out[column] = []
        for p in probabilities:
            place = p * (counts[column] - 1)
            low, high = values[column, math.floor(place)], values[column, math.ceil(place)]
            out[column].append(low + (high - low) * (place - math.floor(place)))
    return out
