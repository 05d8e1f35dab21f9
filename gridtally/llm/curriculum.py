"""Mixing sources to target weights along a curriculum, in DataFrame functions only.

Every source has a weight and a schedule of how its share runs over training time from 0 to 1. The
integral of the schedule says which part of the source's target is due by a time; its inverse gives each
document, by the words that its source has delivered before it, the time at which it is trained on.
Documents sorted by that time are the training order.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtally.session import materialize, passing_shuffles

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (5, 2, 1)
# No source is taken more often than this.
MOST_TIMES = 3
# How a source's share runs: (time, rate) from 0 to 1, straight between, only the shape counts. Heavy
# sources fade, the middle ones stay level, light ones rise.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 0.75), (1.0, 2.0)))
# Rows of a source that are summed up in one task, about.
BUCKET_ROWS = 4096

Schedule = Sequence[tuple[float, float]]


def word_count(text: Column) -> Column:
    """Words between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """Words that each source shall give: (source, source_size) with `target` and its `rank` by name.

    Sources in order of their code points, null last, take the weights in turn and share all words by
    them. A target stops at `most` times its source; the excess is shared again by weight. Sorted by limit
    per weight, the stopped sources come first, so one running sum finds the level at which the rest fill.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")).cast("long")
    )
    limit = F.col("source_size") * most
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy()
    levels = ranked.withColumn("limit", limit).select(
        "*",
        F.sum("source_size").over(everywhere).alias("all_words"),
        F.sum("weight").over(everywhere).alias("all_weight"),
        F.coalesce(F.sum("limit").over(before), F.lit(0)).alias("limit_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("weight_before"),
    )
    level = (F.col("all_words") - F.col("limit_before")) / (F.col("all_weight") - F.col("weight_before"))
    levels = levels.withColumn("level", level)
    stops = F.col("level") * F.col("weight") > F.col("limit")
    filled = F.min(F.when(~stops, F.struct(F.col("limit") / F.col("weight"), "rank", "level"))).over(everywhere)["level"]
    target = F.when(stops, F.col("limit").cast("double")).otherwise(filled * F.col("weight"))
    return levels.select("source", "rank", "source_size", target.alias("target"))


def _pieces(schedule: Schedule) -> list[tuple[float, float, float, float]]:
    """Straight pieces of a schedule: start, rate there, slope, and the part of the integral before."""
    knots = sorted(schedule)
    area = [(t1 - t0) * (a + b) / 2 for (t0, a), (t1, b) in zip(knots, knots[1:])]
    whole = math.fsum(area)
    if knots[0][0] != 0 or knots[-1][0] != 1 or whole <= 0 or min(rate for _, rate in knots) < 0:
        raise ValueError("a schedule runs from time 0 to 1 with rates that are not all 0 and none below")
    out, before = [], 0.0
    for ((t0, a), (t1, b)), part in zip(zip(knots, knots[1:]), area):
        if t1 > t0:
            out.append((t0, a / whole, (b - a) / (t1 - t0) / whole, before / whole))
            before += part
    return out


def time_due(share: Column, schedule: Schedule) -> Column:
    """The time by which that share of a source's target is due: the inverse of the schedule's integral."""
    found = F.lit(0.0)
    for start, rate, slope, before in _pieces(schedule):
        rest = share - before
        if abs(slope) < 1e-12:
            at = F.lit(start) + (rest / rate if rate else F.lit(0.0))
        else:
            root = F.sqrt(F.greatest(F.lit(rate * rate) + 2 * slope * rest, F.lit(0.0)))
            at = F.lit(start) + F.coalesce(2 * rest / F.nullif(F.lit(rate) + root, F.lit(0.0)), F.lit(0.0))
        found = F.when(share >= before, at).otherwise(found)
    return F.least(F.greatest(found, F.lit(0.0)), F.lit(1.0))


def assign_positions(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    schedules: Sequence[Schedule] = SCHEDULES,
    most: int = MOST_TIMES,
) -> DataFrame:
    """One row per document: id, `source`, `row_key`, `size`, `source_size`, `target`, `taken`, `positions`.

    A source delivers its documents in order of md5 of the id, then id, and again from the start, up to
    `most` times; a copy is taken if the middle of its words lies before the source's target. `positions`
    are the times of the copies taken, `taken` their words. `row_key` is a hash of id, source and text.

    Sizes are words of the whole text; null and empty texts have none and are delivered at most once. Rows
    without a source form the last source, rows without an id come first in theirs. Equal rows are
    delivered together and get the same positions. Other columns are ignored; an empty table gives none.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        F.xxhash64(doc_id, source, text).alias("row_key"),
    )
    rows = materialize(rows, "sizes")
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    units = rows.groupBy("source", "doc_id", "row_key", "size").agg(F.count("*").alias("copies"))
    most_rows = rows.groupBy("source").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    digits = max(1, math.ceil(math.log(max(most_rows / BUCKET_ROWS, 1), 16)))
    order = F.coalesce(F.md5(F.col("doc_id").cast("string")), F.lit("0" * 32))
    units = units.select(
        "*",
        order.alias("order"),
        F.substring(order, 1, digits).alias("bucket"),
        (F.col("size") * F.col("copies")).alias("words"),
    )
    sums = units.groupBy("source", "bucket").agg(F.sum("words").alias("words"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("source").alias("of"), F.col("bucket").alias("part"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("bucket_start")
    )
    sums = sums.join(
        targets.select(F.col("source").alias("named"), "rank", "source_size", "target"), F.col("of").eqNullSafe(F.col("named"))
    ).drop("named")
    inner = Window.partitionBy("source", "bucket").orderBy("order", "doc_id", "row_key")
    run = F.coalesce(F.sum("words").over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = units.withColumn("run", run).join(
        sums, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("part"))
    )
    start = F.col("bucket_start") + F.col("run")
    middles = F.array(*[start + F.lit(r) * F.col("source_size") + F.col("words") / 2 for r in range(most)])
    taken = F.filter(middles, lambda m: m < F.col("target"))
    taken = F.when(F.col("words") == 0, F.slice(taken, 1, 1)).otherwise(taken)

    def due(share: Column) -> Column:
        out = time_due(share, schedules[0])
        for i in range(1, len(schedules)):
            out = F.when(F.col("rank") % len(schedules) == i, time_due(share, schedules[i])).otherwise(out)
        return out

    times = F.transform(taken, lambda m: due(m / F.col("target")))
    decided = placed.select(
        F.col("doc_id").alias("d"), F.col("source").alias("s"), F.col("row_key").alias("k"), "source_size", "target", times.alias("positions")
    )
    out = rows.join(
        decided,
        F.col("doc_id").eqNullSafe(F.col("d")) & F.col("source").eqNullSafe(F.col("s")) & (F.col("row_key") == F.col("k")),
    )
    return out.select(
        F.col("doc_id").alias(doc_id),
        F.col("source").alias(source),
        "row_key",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.size("positions")).alias("taken"),
        "positions",
    )


def _ordered_copies(docs: DataFrame, assigned: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """(row, _own, _key, _position) for every copy taken, sorted by position across partitions.

    The sort is by range of position, so no source, however large, lands in one task.
    """
    key = F.xxhash64(doc_id, source, text)
    times = assigned.select("row_key", F.col(doc_id).alias("_id"), "positions").dropDuplicates(["row_key", "_id"])
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(doc_id).alias("_own"), key.alias("_key"))
    joined = keyed.join(times, (F.col("_key") == F.col("row_key")) & F.col("_own").eqNullSafe(F.col("_id")))
    copies = joined.select("row", "_own", "_key", F.explode("positions").alias("_position"))
    return copies.repartitionByRange("_position", "_own", "_key").sortWithinPartitions("_position", "_own", "_key")


def training_order(
    docs: DataFrame, assigned: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """The documents taken, one row per copy, sorted by position across partitions; columns of `docs`."""
    return _ordered_copies(docs, assigned, doc_id, text, source).select("row.*")


def write_training_order(
    docs: DataFrame, assigned: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", source: str = "source"
) -> None:
    """Write the training order as Parquet, file by file: `position`, `row_key` and the document as `row`."""
    copies = _ordered_copies(docs, assigned, doc_id, text, source)
    with passing_shuffles(docs.sparkSession):
        copies.select(F.col("_position").alias("position"), F.col("_key").alias("row_key"), "row").write.option(
            "compression", "zstd"
        ).parquet(folder)


def delivered(assigned: DataFrame, order: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The assigned rows with `taken` as the words of their copies in a written training order.

    Equal rows share their copies; rows that the order does not hold have none.
    """
    asked = assigned.select("row_key", F.col(doc_id).alias("_id"), F.lit(1).alias("rows"), F.lit(0).alias("copies"))
    found = order.select("row_key", F.col("row")[doc_id].alias("_id"), F.lit(0).alias("rows"), F.lit(1).alias("copies"))
    counts = asked.unionByName(found).groupBy(F.col("row_key").alias("_key"), "_id").agg(F.sum("rows").alias("rows"), F.sum("copies").alias("copies"))
    joined = assigned.drop("taken").join(counts, (F.col("row_key") == F.col("_key")) & F.col(doc_id).eqNullSafe(F.col("_id")))
    return joined.withColumn("taken", F.expr("size * (copies div rows)")).select(*assigned.columns)
