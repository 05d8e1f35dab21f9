"""Live figures from a stream of readings.

Running figures are kept by update-mode aggregations: every micro-batch publishes only the groups
it changed, under its own batch folder, so a repeated batch overwrites itself. Every so many batches
are folded into a snapshot. `current` merges what was published into one row per group, and the last step of a figure (a share, the progress
against a baseline) is an ordinary query over that small table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridtally.operators.filters import between, select_metrics
from gridtally.operators.report import share_of_hour
from gridtally.schema import (
    CARBON,
    COST,
    METER,
    READING_ID,
    READINGS_SCHEMA,
    TS,
    USAGE,
    WORK_TYPE,
)
from gridtally.session import folders, remove

BATCH = "batch"
SNAPSHOT = "snapshot"


def stream_readings(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """Readings as their files arrive. Event time becomes TIMESTAMP, which watermarks require."""
    return (
        spark.readStream.schema(READINGS_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
        .withColumn(TS, F.col(TS).cast("timestamp"))
    )


def accumulate(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append every row seen to a parquet table."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )


def publish(
    running: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str] = (),
    fold_every: int = 16,
    expired: Column | None = None,
    **trigger,
) -> StreamingQuery:
    """Publish the groups each micro-batch changes.

    With the `keys` of the groups, every `fold_every`-th batch also writes a snapshot, the newest row of every
    group. Rows for which `expired` is true are left out of it (a null keeps them), so groups may end.
    Batches and snapshots before the last snapshot but one are removed: what a reader has just listed stays for
    another `fold_every` batches, and the folder never holds more than two snapshots and twice that many
    batches. A batch that is run again writes the same folders again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
        if not keys or (batch_id + 1) % fold_every:
            return
        newest = current(spark, path, keys, before=batch_id)
        if expired is not None:
            newest = newest.filter(~F.coalesce(expired, F.lit(False)))
        newest.write.mode("overwrite").parquet(f"{path}/{SNAPSHOT}={batch_id}")
        kept = batch_id - fold_every
        for kind, last in ((BATCH, kept), (SNAPSHOT, kept - 1)):
            for number in _finished(spark, path, kind):
                if number <= last:
                    remove(spark, f"{path}/{kind}={number}")

    return (
        running.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(write)
        .start()
    )


def _finished(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the batches or snapshots that have been written to their end."""
    found = folders(spark, f"{path}/{kind}=*/_SUCCESS")
    return sorted(int(f.rsplit("/", 2)[1].partition("=")[2]) for f in found)


def current(spark: SparkSession, path: str, keys: Sequence[str], before: int | None = None) -> DataFrame:
    """The newest published row of every group: the last snapshot and the batches after it.

    `before` leaves out snapshots of this batch or later ones. Groups with null keys are groups, too.
    """
    base = max((n for n in _finished(spark, path, SNAPSHOT) if before is None or n < before), default=-1)
    parts = [f"{path}/{BATCH}={n}" for n in _finished(spark, path, BATCH) if n > base]
    tables = []
    if parts:
        tables.append(spark.read.option("basePath", path).parquet(*parts))
    if base >= 0:
        snapshot = spark.read.parquet(f"{path}/{SNAPSHOT}={base}")
        tables.append(snapshot.withColumn(BATCH, F.lit(base)))
    if not tables:
        raise ValueError(f"nothing is published in {path}")
    log = reduce(DataFrame.unionByName, tables)
    values = [c for c in log.columns if c not in (*keys, BATCH)]
    newest = F.max_by(F.struct(*values), F.col(BATCH)).alias("_newest")
    return log.groupBy(*keys).agg(newest).select(*keys, "_newest.*")


def latest_cards(stream: DataFrame) -> DataFrame:
    """Newest usage, cost and carbon magnitude of every meter."""
    newest = F.max_by(
        F.struct(TS, USAGE, COST, F.abs(CARBON).alias(CARBON)), F.struct(TS, READING_ID)
    )
    return stream.groupBy(METER).agg(newest.alias("_card")).select(METER, "_card.*")


def daily_totals(
    stream: DataFrame, by: Sequence[str] = (), lateness: str | None = None
) -> DataFrame:
    """Running usage and cost of each day.

    `lateness` sets a watermark: state of older days is freed, and readings that come later than
    that are ignored. Without it nothing is ever ignored, and one row of state is kept per day.
    """
    totals = [F.sum(USAGE).alias("usage"), F.sum(COST).alias("cost")]
    if not lateness:
        return stream.groupBy(*by, F.to_date(TS).alias("day")).agg(*totals)
    days = stream.withWatermark(TS, lateness).groupBy(*by, F.window(TS, "1 day").alias("_day"))
    return days.agg(*totals).select(
        *by, F.col("_day.start").cast("date").alias("day"), "usage", "cost"
    )


def progress_vs_baseline(days: DataFrame, base: DataFrame) -> DataFrame:
    """Totals of the newest day, its week and its month against a baseline, at most 100 %."""
    today = days.agg(F.max("day")).scalar()
    day = F.col("day")
    periods = {
        "daily": day == today,
        "weekly": day >= F.trunc(today, "week"),
        "monthly": day >= F.trunc(today, "month"),
    }
    sums = days.filter(
        day >= F.least(F.trunc(today, "week"), F.trunc(today, "month"))
    ).agg(
        *[
            F.coalesce(F.sum(F.when(inside, F.col(m))), F.lit(0.0)).alias(f"{m}_{period}")
            for m in ("usage", "cost")
            for period, inside in periods.items()
        ]
    )
    goals = base.select(F.struct("*")).scalar()
    rows = [
        F.struct(
            F.lit(m).alias("measure"),
            F.lit(period).alias("period"),
            F.col(f"{m}_{period}").alias("total"),
            F.col(f"_goals.{m}_{period}").alias("baseline"),
        )
        for m in ("usage", "cost")
        for period in periods
    ]
    percent = F.try_divide(F.col("total"), F.col("baseline")) * 100
    return (
        sums.withColumn("_goals", goals)
        .select(F.inline(F.array(*rows)))
        .withColumn("percent", F.least(F.lit(100.0), F.coalesce(percent, F.lit(0.0))))
    )


def running_work_types(stream: DataFrame) -> DataFrame:
    return stream.groupBy(WORK_TYPE).agg(F.count("*").alias("readings"))


def main_of_counts(counts: DataFrame) -> DataFrame:
    """The most frequent work type; the first by name wins a tie."""
    best = F.min(F.struct(-F.col("readings"), WORK_TYPE))
    return counts.agg(best.alias("_best")).select(
        F.col(f"_best.{WORK_TYPE}").alias("main_work_type"),
        (-F.col("_best").getField("col1")).alias("readings"),
    )


def running_hourly_counts(stream: DataFrame) -> DataFrame:
    return stream.groupBy(F.hour(TS).alias("hour"), WORK_TYPE).agg(F.count("*").alias("readings"))


def running_hourly_share(counts: DataFrame) -> DataFrame:
    return share_of_hour(counts)


def running_series(
    stream: DataFrame, start: str, end: str, metrics: Sequence[str]
) -> DataFrame:
    """The chosen measures between two instants; keeps no state."""
    return select_metrics(between(stream, start, end), metrics)
