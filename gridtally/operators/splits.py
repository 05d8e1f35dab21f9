"""Training, validation and folds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.operators.ordered import POSITION
from gridtally.schema import READING_ID


def kfold(folds: int = 5, key: str = READING_ID) -> Column:
    """Fold of a row by its id: the same on every run, cluster and engine."""
    return F.pmod(F.col(key), F.lit(folds)).cast("int")


def random_split(
    df: DataFrame, share: float = 0.2, key: str = READING_ID
) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows: an id validates if its md5, as a number from 0 to 1, is below `share`.

    A row without an id trains.
    """
    drawn = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long")
    held_out = F.coalesce(drawn < F.lit(share * 2**32), F.lit(False))
    return df.filter(~held_out), df.filter(held_out)


def time_split(
    df: DataFrame, share: float = 0.2, rows: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """The first rows by position train, the last `share` of them validate."""
    n = df.count() if rows is None else rows
    cut = int(n * (1 - share))
    return df.filter(F.col(POSITION) < cut), df.filter(F.col(POSITION) >= cut)


@dataclass(frozen=True)
class Fold:
    """Positions before `train_end` train; [start, end) validates."""

    number: int
    train_end: int
    start: int
    end: int

    def train(self, df: DataFrame) -> DataFrame:
        return df.filter(F.col(POSITION) < self.train_end)

    def validation(self, df: DataFrame) -> DataFrame:
        return df.filter((F.col(POSITION) >= self.start) & (F.col(POSITION) < self.end))


def time_folds(rows: int, folds: int = 5, gap: int = 0) -> list[Fold]:
    """Growing training sets, each followed by a gap and a validation set of equal size."""
    size = rows // (folds + 1)
    first = rows - folds * size
    return [
        Fold(i, first + i * size - gap, first + i * size, first + (i + 1) * size)
        for i in range(folds)
    ]


def with_roles(df: DataFrame, folds: list[Fold]) -> DataFrame:
    """One row per reading and fold it takes part in, as `train` or `validation`."""
    place = F.col(POSITION)
    parts = [
        F.struct(
            F.lit(f.number).alias("fold"),
            F.when(place < f.train_end, "train")
            .when((place >= f.start) & (place < f.end), "validation")
            .alias("role"),
        )
        for f in folds
    ]
    return df.select("*", F.inline(F.array(*parts))).filter(F.col("role").isNotNull())
