"""Preference examples from pairs of conversations: a common prompt and two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Turns of one side that are rendered into one row, and the role that is trained on.
CHUNK_TURNS = 64
TRAINED = "assistant"


def _rendered(role: str, text: str) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("\n"))


def _spans(turns: Column) -> Column:
    """Character spans of the trained turns in the joined text, end exclusive."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, turn: Column) -> Column:
        end = acc["at"] + F.length(turn["rendered"])
        span = F.array(F.struct(acc["at"].alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(turn["trained"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def format_preferences(
    turns: DataFrame,
    pair: str = "pair_id",
    chosen: str = "chosen",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    trained: str = TRAINED,
    chunk_turns: int = CHUNK_TURNS,
) -> DataFrame:
    """Rows (pair, `chunk`, `prompt_turns`, `prompt`, `chosen_text`, `rejected_text`, `chosen_mask`, `rejected_mask`).

    The prompt is the longest common prefix of both conversations' turns, equal in role and text, and is
    rendered once. Completions hold what follows on either side; their masks are the character spans of the
    turns of role `trained`, the only ones with a loss. A conversation longer than `chunk_turns` goes on in
    further chunks of its pair, by turn number, so that no conversation, however long, is one row.

    Nulls: a null role or text is rendered empty and equals only a null; a null turn number comes last; rows
    of a null pair or side are left out, as they belong to no example. Repeated turns stay, ordered by role
    and text, and are common if both sides have the same ones. A pair with one side has an empty prompt and
    that side's completion; equal sides have only a prompt. Empty tables give none; other columns are ignored.
    """
    rows = turns.select(
        F.col(pair).alias("pair"),
        F.col(chosen).cast("boolean").alias("side"),
        F.coalesce(F.col(turn).cast("long"), F.lit((1 << 62) + 1)).alias("turn"),
        F.col(role).alias("role"),
        F.col(text).alias("text"),
    ).filter(F.col("pair").isNotNull() & F.col("side").isNotNull())
    code = F.xxhash64("role", "text", F.col("role").isNull(), F.col("text").isNull()).cast("decimal(38,0)")
    sides = [
        (F.sum(F.when(which, code)).alias(f"code_{name}"), F.count(F.when(which, 1)).alias(f"n_{name}"))
        for name, which in (("yes", F.col("side")), ("no", ~F.col("side")))
    ]
    per_turn = rows.groupBy("pair", "turn").agg(*sides[0], *sides[1])
    differs = (F.col("n_yes") != F.col("n_no")) | ~F.col("code_yes").eqNullSafe(F.col("code_no"))
    parted = per_turn.groupBy("pair").agg(
        F.min(F.when(differs, F.col("turn"))).alias("parted"),
    )
    common = F.col("parted").isNull() | (F.col("turn") < F.col("parted"))
    placed = rows.join(parted.select("pair", "parted"), "pair").filter(F.col("side") | ~common)
    part = F.when(common, F.lit("prompt")).when(F.col("side"), F.lit("chosen")).otherwise(F.lit("rejected"))
    item = F.struct(
        "turn", F.col("role"), F.col("text"), _rendered("role", "text").alias("rendered"), F.col("role").eqNullSafe(F.lit(trained)).alias("trained")
    )
    placed = placed.select(
        "pair", F.floor(F.col("turn") / chunk_turns).cast("long").alias("chunk"), part.alias("part"), item.alias("item")
    )
    lists = [F.array_sort(F.collect_list(F.when(F.col("part") == p, F.col("item")))).alias(p) for p in ("prompt", "chosen", "rejected")]
    grouped = placed.groupBy("pair", "chunk").agg(*lists)

    def joined(name: str) -> Column:
        return F.array_join(F.transform(name, lambda t: t["rendered"]), "")

    return grouped.select(
        F.col("pair").alias(pair),
        "chunk",
        F.size("prompt").cast("long").alias("prompt_turns"),
        joined("prompt").alias("prompt"),
        joined("chosen").alias("chosen_text"),
        joined("rejected").alias("rejected_text"),
        _spans(F.col("chosen")).alias("chosen_mask"),
        _spans(F.col("rejected")).alias("rejected_mask"),
    )
