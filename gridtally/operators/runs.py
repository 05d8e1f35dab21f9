"""Positions of a growing table: sorted runs that are written once, and a directory of their offsets.

Every append sorts its own rows and writes them as one run, each row with its place among the run's rows of
its series. The directory has one row per run and series: how many rows, the first and the last. A row's
position is its place plus the rows of the series' earlier runs, so rows that are already stored are
neither sorted nor written again.

Runs of a series must not reach into one another. Parts may come in any order of time, but where a part
reaches into stored runs, these runs are sorted together with it and replaced.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridtally.operators.ordered import POSITION, READINGS, Series, _same, with_position
from gridtally.session import folders, materialize, passing_copies, remove

# Rows that one task sorts and one file of a run holds.
PARTITION_ROWS = 2_000_000
PLACE, RUN, ROWS, FIRST, LAST = "_place", "_run", "_rows", "_first", "_last"


class SortedRuns:
    """A table below `path` to which parts are appended, and the positions of its rows.

    Null keys are a series of their own and null order values come first. Rows that tie in the whole order
    keep the order that their run was written in. One writer at a time; readers see the last
    complete append, also if a later one fails.
    """

    def __init__(self, spark: SparkSession, path: str, series: Series = READINGS, partition_rows: int = PARTITION_ROWS):
        self.spark, self.path, self.series, self.partition_rows = spark, path.rstrip("/"), series, partition_rows

    def _version(self) -> int:
        """The newest complete directory; 0 before the first append."""
        return max((int(p.split("/")[-2]) for p in folders(self.spark, f"{self.path}/directory/*/_SUCCESS")), default=0)

    def directory(self) -> DataFrame | None:
        """One row per live run and series, or None before the first append."""
        version = self._version()
        return self.spark.read.parquet(f"{self.path}/directory/{version}") if version else None

    def _run(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/runs/{name}")

    def _live(self, directory: DataFrame) -> list[str]:
        return sorted(r[0] for r in directory.select(RUN).distinct().collect())

    def _together(self, bounds: DataFrame) -> DataFrame:
        return bounds.groupBy(*self.series.keys).agg(
            F.sum(ROWS).alias(ROWS), F.min(FIRST).alias(FIRST), F.max(LAST).alias(LAST)
        )

    def append(self, part: DataFrame) -> list[str]:
        """Store the rows of `part`; gives the names of the runs that had to be sorted again with it.

        Only the part is read, unless it reaches into stored runs. A part without rows changes nothing.
        """
        if taken := {PLACE, RUN} & set(part.columns):
            raise ValueError(f"columns {sorted(taken)} have names that the runs need")
        order = F.struct(*self.series.order)
        with passing_copies(self.spark):
            own = part.groupBy(*self.series.keys).agg(F.count("*").alias(ROWS), F.min(order).alias(FIRST), F.max(order).alias(LAST))
            own = materialize(own.filter(F.col(ROWS) > 0), "bounds")
            if own.isEmpty():
                return []
            known, version = self.directory(), self._version()
            again: list[str] = []
            bounds = own
            while known is not None:
                stored = known.filter(~F.col(RUN).isin(again)) if again else known
                reach = bounds.select(*[F.col(c).alias(f"_{c}") for c in (*self.series.keys, FIRST, LAST)])
                meets = (F.col(FIRST) <= F.col(f"_{LAST}")) & (F.col(LAST) >= F.col(f"_{FIRST}"))
                if self.series.keys:
                    meets = meets & _same(self.series.keys)
                met = [r[0] for r in stored.join(reach, meets).select(RUN).distinct().collect()]
                if not met:
                    break
                again += met
                bounds = self._together(known.filter(F.col(RUN).isin(again)).drop(RUN).unionByName(own))
            name = uuid.uuid4().hex
            rows = reduce(DataFrame.unionByName, [self._run(r).drop(PLACE) for r in again], part)
            placed = with_position(rows, self.series, PLACE, self.partition_rows)
            placed.write.parquet(f"{self.path}/runs/{name}")
            directory = bounds.withColumn(RUN, F.lit(name))
            if known is not None:
                kept = known.filter(~F.col(RUN).isin(again)) if again else known
                directory = directory.unionByName(kept)
            directory.write.mode("overwrite").parquet(f"{self.path}/directory/{version + 1}")
        return sorted(again)

    def positions(self, name: str = POSITION) -> DataFrame:
        """All rows with their place in their series, from 0."""
        directory = self.directory()
        if directory is None:
            raise ValueError(f"nothing has been appended to {self.path}")
        keys = self.series.keys
        earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(FIRST).rowsBetween(Window.unboundedPreceding, -1)
        starts = directory.select(
            F.col(RUN).alias("_of_run"), *[F.col(k).alias(f"_{k}") for k in keys], F.coalesce(F.sum(ROWS).over(earlier), F.lit(0)).alias("_before")
        )
        rows = reduce(DataFrame.unionByName, [self._run(r).withColumn(RUN, F.lit(r)) for r in self._live(directory)])
        here = F.col(RUN) == F.col("_of_run")
        if keys:
            here = here & _same(keys)
        columns = [c for c in rows.columns if c not in (PLACE, RUN, name)]
        return rows.join(starts, here).select(*columns, (F.col(PLACE) + F.col("_before")).alias(name))

    def vacuum(self) -> int:
        """Remove runs and directories that the newest directory no longer names; gives how many. No reader may be at work."""
        directory, version = self.directory(), self._version()
        live = set(self._live(directory)) if directory is not None else set()
        old = [p for p in folders(self.spark, f"{self.path}/runs/*") if p.split("/")[-1] not in live]
        old += [p for p in folders(self.spark, f"{self.path}/directory/*") if p.split("/")[-1] != str(version)]
        for path in old:
            remove(self.spark, path)
        return len(old)
