"""Stacking, looking up, counting into columns, first and last rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.operators.ordered import RANK, Series, tail
from gridtally.schema import READING_ID, TS

def union_history(past: DataFrame, future: DataFrame, origin: str | None = None) -> DataFrame:
    """Stack two frames by column name; a column missing on one side is null there.

    `origin` names a flag column: 0 for rows of `past`, 1 for rows of `future`.
    """
    if origin:
        past, future = past.withColumn(origin, F.lit(0)), future.withColumn(origin, F.lit(1))
    return past.unionByName(future, allowMissingColumns=True)


def lookup(
    df: DataFrame,
    mapping: DataFrame,
    key: str | Sequence[str],
    value: str,
    default: Column | None = None,
) -> DataFrame:
    """Add the mapped value; a key that is not mapped gives null or the default.

    No broadcast hint: the planner broadcasts the mapping when its size allows and otherwise
    joins by shuffle, splitting skewed keys.
    """
    out = df.join(mapping, [key] if isinstance(key, str) else list(key), "left")
    return out if default is None else out.withColumn(value, F.coalesce(F.col(value), default))


def keep_ids(df: DataFrame, ids: DataFrame, key: str = READING_ID) -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def latest_n(
    df: DataFrame, n: int, order: Sequence[str] = (TS, READING_ID), by: Sequence[str] = ()
) -> DataFrame:
    """The last n rows, of the whole frame or of each `by` group.

    Groups are cut by position, so a group with most of the table is never sorted in one task.
    """
    if not by:
        return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)
    return tail(df, n, Series(keys=tuple(by), order=tuple(order))).drop(RANK)


def top_k(df: DataFrame, col: str, k: int, tie: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.col(col).desc(), *tie).limit(k)


def pivot_counts(
    df: DataFrame, rows: Sequence[str | Column], col: str, values: Sequence[str], rest: str | None = None
) -> DataFrame:
    """Count rows into one column per value, 0 where there are none.

    Rows with another value are counted in the column `rest`; without one they are an error. Nulls are
    not counted.
    """
    counts = [F.count_if(F.col(col) == v).alias(str(v)) for v in values]
    other = F.col(col).isNotNull() & ~F.col(col).isin(*values)
    if rest is not None:
        return df.groupBy(*rows).agg(*counts, F.count_if(other).alias(rest))
    message = F.concat(F.lit(f"{col} has a value that is not listed: "), F.max(F.when(other, F.col(col).cast("string"))))
    first = F.when(F.count_if(other) > 0, F.raise_error(message).cast("long")).otherwise(F.count_if(F.col(col) == values[0]))
    return df.groupBy(*rows).agg(first.alias(str(values[0])), *counts[1:])


def argmin_column(df: DataFrame, cols: Sequence[str], name: str = "argmin") -> DataFrame:
    """Add the name of the smallest column; the first one wins a tie, nulls never win."""
    entries = F.array(
        *[
            F.when(
                F.col(c).isNotNull(),
                F.struct(F.col(c).alias("value"), F.lit(i).alias("place"), F.lit(c).alias("name")),
            )
            for i, c in enumerate(cols)
        ]
    )
    return df.withColumn(name, F.array_min(entries)["name"])


def align_predictions(frames: dict[str, DataFrame], key: str = READING_ID) -> DataFrame:
    """Predictions of several models side by side, one column per model, matched by id.

    An id that a model lacks has null there.
    """
    named = [df.select(key, F.col("prediction").alias(name)) for name, df in frames.items()]
    return reduce(lambda left, right: left.join(right, key, "full"), named)
