"""Row order at scale: positions, lags, rolling statistics and sequences.

A window over one meter would put all of the meter's rows into one task, and one meter may own a
third of the table. So rows first get their position in the series from a range-partitioned sort,
then windows run over blocks of consecutive positions. Each block also carries the last rows of
the block before it, as many as the longest lag or window reaches back, and those extra rows are
dropped afterwards. Blocks have the same number of rows however uneven the meters are.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally.schema import METER, READING_ID, TS
from gridtally.session import materialize

POSITION = "position"
WINDOW_BUFFER_ROWS = 4096


@dataclass(frozen=True)
class Series:
    """What tells one series from another, and a total order within it."""

    keys: tuple[str, ...] = (METER,)
    order: tuple[str, ...] = (TS, READING_ID)


READINGS = Series()


def with_position(
    df: DataFrame, series: Series = READINGS, name: str = POSITION, partition_rows: int | None = None
) -> DataFrame:
    """Add every row's place in its series, from 0.

    One range-partitioned sort, whose result is written to the shared folder: row numbers within
    its partitions then stay fixed. The partitions' row counts, at most one row per partition and
    series, are summed up to the number of rows before each partition. With `partition_rows`, rows are
    counted first and a task sorts about that many; otherwise the session's shuffle partitions hold.
    """
    cols = [*series.keys, *series.order]
    parts = [max(1, -(-df.count() // partition_rows))] if partition_rows else []
    laid = materialize(
        df.repartitionByRange(*parts, *cols)
        .sortWithinPartitions(*cols)
        .withColumn("_slot", F.monotonically_increasing_id()),
        "sorted",
    ).withColumn("_run", F.shiftright("_slot", 33))
    runs = laid.groupBy(*series.keys, "_run").agg(
        F.min("_slot").alias("_first"), F.count("*").alias("_rows")
    )
    earlier = (
        Window.partitionBy(*(series.keys or [F.lit(0)]))
        .orderBy("_run")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # Written out, so that its size on file decides between a broadcast and a shuffled join.
    starts = materialize(
        runs.select(
            *[F.col(k).alias(f"_{k}") for k in series.keys],
            F.col("_run").alias("_start_run"),
            (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        ),
        "starts",
    )
    same = F.col("_run") == F.col("_start_run")
    for k in series.keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return (
        laid.join(starts, same)
        .withColumn(name, F.col("_slot") + F.col("_shift"))
        .select(*[c for c in df.columns if c != name], name)
    )


@dataclass(frozen=True)
class Ordered:
    """A value computed from a row and at most `reach` rows before it."""

    reach: int
    over: Callable[[WindowSpec], Column]


@dataclass(frozen=True)
class Rolling:
    """Statistic of `rows` rows that end `shift` rows back; null until `need` of them have values."""

    col: str
    rows: int
    statistic: str
    shift: int
    need: int

    @property
    def reach(self) -> int:
        return self.rows - 1 + self.shift

    @property
    def span(self) -> tuple[str, int, int]:
        return self.col, self.rows, self.shift

    def pieces(self) -> list[tuple[int, int]]:
        """(length, rows back) of runs whose lengths are powers of two and which make up the span."""
        out, back = [], self.shift
        for bit in reversed(range(self.rows.bit_length())):
            if self.rows >> bit & 1:
                out.append((1 << bit, back))
                back += 1 << bit
        return out


@dataclass(frozen=True)
class Median:
    """Median of the values in `rows` rows that end `shift` rows back; null until `need` of them have values."""

    col: str
    rows: int
    shift: int
    need: int

    @property
    def reach(self) -> int:
        return self.rows - 1 + self.shift


# What a run must carry for each statistic; every run also carries its count of values.
_CARRIED = {"mean": ("sum",), "std": ("sum", "dev"), "max": ("max",), "min": ("min",)}


RANK = "_rank"


# Calendar units from coarse to fine, as whole numbers that grow with time.
_UNITS: dict[str, Callable[[Column], Column]] = {
    "month": lambda ts: F.year(ts) * 12 + F.month(ts),
    "day": lambda ts: F.unix_date(ts.cast("date")),
    "hour": lambda ts: F.unix_date(ts.cast("date")) * 24 + F.hour(ts),
}
# Rows of one series and calendar unit that one task may sort.
UNIT_ROWS = 1 << 20


def _same(keys: Sequence[str]) -> Column:
    """Equal keys, with nulls equal too; the other side's have an underscore before their names."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])


def calendar_index(df: DataFrame, series: Series = READINGS, unit: str = "month") -> DataFrame:
    """For every series and calendar unit: `unit`, its `rows`, its first instant `start`, and how many rows come `after`.

    Only keys and times are read, and rows are counted before they are shuffled. A null time is the
    oldest, in a unit of its own.
    """
    lead = F.col(series.order[0])
    counts = df.groupBy(*series.keys, _UNITS[unit](lead).alias("unit")).agg(F.count("*").alias("rows"), F.min(lead).alias("start"))
    later = Window.partitionBy(*(series.keys or [F.lit(0)])).orderBy(F.col("unit").desc()).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("after", F.coalesce(F.sum("rows").over(later), F.lit(0)))


def tail(df: DataFrame, rows: int, series: Series = READINGS) -> DataFrame:
    """The last rows of every series, numbered in `_rank` from the newest, 1.

    A calendar index tells from which month on each series is needed. The earliest of these instants goes
    to the file scan as a filter, and only the months needed are numbered, each from the count of the rows
    after it. If one series has more than `UNIT_ROWS` rows in a month, days of these months are looked
    at, then hours. Only the indexes are written. Series that are not ordered by time, and hours that hold
    more, are numbered by their positions: no task ever holds more than a range of sorted rows.
    """
    order = series.order
    if not isinstance(df.schema[order[0]].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return _tail_by_position(df, rows, series)
    lead = F.col(order[0])
    for unit, number in _UNITS.items():
        index = calendar_index(df, series, unit).filter(F.col("after") < rows)
        index = materialize(
            index.select(*[F.col(k).alias(f"_{k}") for k in series.keys], *[F.col(c).alias(f"_of_{c}") for c in ("unit", "rows", "start", "after")]),
            "calendar",
        )
        found = index.agg(F.max("_of_rows").alias("most"), F.min("_of_start").cast("string").alias("start"), F.count_if(F.col("_of_start").isNull()).alias("undated")).first()
        # a literal of the column's own type is tested in the scan
        if found.start is not None and not found.undated:
            df = df.filter(lead >= F.lit(found.start).cast(df.schema[order[0]].dataType))
        here = number(lead).eqNullSafe(F.col("_of_unit"))
        needed = df.join(index, _same(series.keys) & here if series.keys else here)
        if (found.most or 0) <= UNIT_ROWS:
            newest = Window.partitionBy(*series.keys, "_of_unit").orderBy(*[F.col(c).desc() for c in order])
            ranked = needed.select(*df.columns, (F.row_number().over(newest) + F.col("_of_after")).alias(RANK))
            return ranked.filter(F.col(RANK) <= rows)
        df = needed.select(*df.columns)
    return _tail_by_position(df, rows, series)


def _tail_by_position(df: DataFrame, rows: int, series: Series) -> DataFrame:
    place, last = "_place", "_last"
    placed = with_position(df, series, place)
    ends = placed.groupBy(*series.keys).agg(F.max(place).alias(last))
    if series.keys:
        ends = materialize(ends.select(*[F.col(k).alias(f"_{k}") for k in series.keys], last), "ends")
        placed = placed.join(ends, _same(series.keys)).drop(*[f"_{k}" for k in series.keys])
    else:
        placed = placed.withColumn(last, ends.scalar())
    return placed.withColumn(RANK, F.col(last) - F.col(place) + 1).filter(F.col(RANK) <= rows).drop(place, last)


def _struct(values: Mapping[str, str], fields: Sequence[str]) -> Column:
    return F.expr(f"struct({', '.join(f'{values[f]} AS {f}' for f in fields)})")


def _one_row(col: str, fields: Sequence[str]) -> Column:
    """The run of a single row: count, sum, squared deviations, extremes."""
    x = f"CAST(`{col}` AS DOUBLE)"
    return _struct(
        {"n": f"IF({x} IS NULL, 0D, 1D)", "sum": f"coalesce({x}, 0D)", "dev": "0D", "max": x, "min": x},
        fields,
    )


def _merge(a: str, b: str, fields: Sequence[str]) -> Column:
    """Two neighbouring runs as one; the older one, `b`, is null where the series has not begun."""
    apart = f"({a}.n * {b}.sum - {b}.n * {a}.sum)"
    between = f"try_divide({apart} * {apart}, {a}.n * {b}.n * ({a}.n + {b}.n))"
    return _struct(
        {
            "n": f"{a}.n + coalesce({b}.n, 0D)",
            "sum": f"{a}.sum + coalesce({b}.sum, 0D)",
            "dev": f"{a}.dev + coalesce({b}.dev, 0D) + coalesce({between}, 0D)",
            "max": f"greatest({a}.max, {b}.max)",
            "min": f"least({a}.min, {b}.min)",
        },
        fields,
    )


def _statistic(run: str, name: str, need: int) -> Column:
    value = {
        "mean": f"try_divide({run}.sum, {run}.n)",
        "std": f"IF({run}.n > 1, sqrt(try_divide({run}.dev, {run}.n - 1)), NULL)",
    }.get(name, f"{run}.{name}")
    return F.expr(f"IF({run}.n >= {need}, {value}, NULL)")


def _add_rolling(df: DataFrame, values: Mapping[str, Rolling], window: WindowSpec) -> DataFrame:
    """Rolling statistics from runs of 1, 2, 4, ... rows.

    A sliding frame adds up all its rows again for every row. Here a run of 2k rows is a run of k
    rows merged with the one k rows back, and a span is merged from a few runs, so a row costs the
    logarithm of the longest span. All windows share the one sort.
    """
    start = list(df.columns)
    longest: dict[str, int] = {}
    carried: dict[str, list[str]] = {}
    for v in values.values():
        longest[v.col] = max(longest.get(v.col, 0), v.rows)
        known = carried.setdefault(v.col, ["n"])
        known += [f for f in _CARRIED[v.statistic] if f not in known]
    place = {c: i for i, c in enumerate(longest)}

    def run(col: str, length: int) -> str:
        return f"_run_{place[col]}_{length}"

    df = df.withColumns({run(c, 1): _one_row(c, carried[c]) for c in longest})
    length = 1
    while grow := [c for c, rows in longest.items() if rows >= 2 * length]:
        before = {c: f"_before_{place[c]}" for c in grow}
        df = df.withColumns(
            {b: F.lag(run(c, length), length).over(window) for c, b in before.items()}
        ).withColumns(
            {run(c, 2 * length): _merge(run(c, length), b, carried[c]) for c, b in before.items()}
        )
        length *= 2
    spans = {v.span: v.pieces() for v in values.values()}
    whole = {span: f"_span_{i}" for i, span in enumerate(spans)}
    pieces = {
        (col, k, back): f"_piece_{place[col]}_{k}_{back}"
        for (col, _, _), parts in spans.items()
        for k, back in parts
    }
    df = df.withColumns(
        {name: F.lag(run(col, k), back).over(window) for (col, k, back), name in pieces.items()}
    ).withColumns({whole[s]: F.col(pieces[s[0], *parts[0]]) for s, parts in spans.items()})
    for step in range(1, max(len(parts) for parts in spans.values())):
        df = df.withColumns(
            {
                whole[s]: _merge(whole[s], pieces[s[0], *parts[step]], carried[s[0]])
                for s, parts in spans.items()
                if len(parts) > step
            }
        )
    return df.select(
        *start,
        *[_statistic(whole[v.span], v.statistic, v.need).alias(n) for n, v in values.items()],
    )


class _Ranks:
    """Order statistics of any stretch of a block's values, in as many steps as their number has bits.

    A wavelet matrix: from the highest bit of the ranks to the lowest, values with a 0 go before those with
    a 1, and counts of zeros lead a stretch from one level to the next. All stretches move together.
    """

    def __init__(self, values: np.ndarray) -> None:
        self.values = np.sort(values)
        ranks = np.empty(len(values), np.int64)
        ranks[np.argsort(values, kind="stable")] = np.arange(len(values))
        self.levels = []
        for bit in reversed(range(len(values).bit_length())):
            ones = ranks >> bit & 1 == 1
            self.levels.append((bit, np.concatenate([[0], np.cumsum(~ones)])))
            ranks = np.concatenate([ranks[~ones], ranks[ones]])

    def smallest(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value, from 0, of each stretch from `low` to before `high`."""
        rank = np.zeros(len(k), np.int64)
        for bit, zeros in self.levels:
            first, last = zeros[low], zeros[high]
            up = k >= last - first
            k = np.where(up, k - (last - first), k)
            low = np.where(up, zeros[-1] + low - first, first)
            high = np.where(up, zeros[-1] + high - last, last)
            rank += up.astype(np.int64) << bit
        return self.values[rank]


def _medians(values: pa.ChunkedArray, wanted: Mapping[str, Median]) -> dict[str, pa.Array]:
    """Medians at every row of a block whose rows are in order; NaN is the largest value."""
    values = values.combine_chunks().cast(pa.float64())
    known = values.is_valid().to_numpy(zero_copy_only=False)
    ranks = _Ranks(values.drop_null().to_numpy(zero_copy_only=False))
    before = np.concatenate([[0], np.cumsum(known)])
    out = {}
    for name, v in wanted.items():
        end = np.maximum(np.arange(len(known)) + 1 - v.shift, 0)
        low, high = before[np.maximum(end - v.rows, 0)], before[end]
        enough = high - low >= max(v.need, 1)
        low, high = low[enough], high[enough]
        a = ranks.smallest(low, high, (high - low - 1) // 2)
        b = ranks.smallest(low, high, (high - low) // 2)
        result = np.zeros(len(known))
        result[enough] = np.where(a == b, a, 0.5 * a + 0.5 * b)
        out[name] = pa.array(result, mask=~enough)
    return out


def _add_medians(df: DataFrame, values: Mapping[str, Median], keys: Sequence[str]) -> DataFrame:
    """Rolling medians of one block at a time; what is grouped are the rows of a block and no more.

    A sliding frame sorts its rows again for every row. Here a row costs the logarithm of the block, whatever
    the window.
    """

    def add(block: pa.Table) -> pa.Table:
        block = block.sort_by(POSITION)
        for col in dict.fromkeys(v.col for v in values.values()):
            wanted = {n: v for n, v in values.items() if v.col == col}
            for name, result in _medians(block[col], wanted).items():
                block = block.append_column(name, result)
        return block

    by_col = [n for col in dict.fromkeys(v.col for v in values.values()) for n, v in values.items() if v.col == col]
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, T.DoubleType()) for n in by_col]])
    return df.groupBy(*keys, "_block").applyInArrow(add, schema)


def over_blocks(
    df: DataFrame,
    values: Mapping[str, Ordered | Rolling | Median],
    series: Series = READINGS,
    block_rows: int | None = None,
) -> DataFrame:
    """Add ordered values to a frame that has positions; all of them share one shuffle."""
    reach = max(v.reach for v in values.values())
    # with the carried rows, a block fills the row buffer of a Spark window and no more
    size = block_rows or max(WINDOW_BUFFER_ROWS - reach, 4 * reach)
    if reach > size:
        raise ValueError(f"blocks of {size} rows cannot look back {reach} rows")
    own = F.floor(F.col(POSITION) / size)
    carried = F.pmod(F.col(POSITION), F.lit(size)) >= size - reach
    blocks = F.when(carried, F.array(own, own + 1)).otherwise(F.array(own))
    window = Window.partitionBy(*series.keys, "_block").orderBy(POSITION)
    spread = df.withColumn("_block", F.explode(blocks))
    rolled = {n: v for n, v in values.items() if isinstance(v, Rolling)}
    if rolled:
        spread = _add_rolling(spread, rolled, window)
    direct = [v.over(window).alias(n) for n, v in values.items() if isinstance(v, Ordered)]
    spread = spread.select("*", *direct)
    medians = {n: v for n, v in values.items() if isinstance(v, Median)}
    if medians:
        spread = _add_medians(spread, medians, series.keys)
    return spread.filter(F.col("_block") == own).select(*df.columns, *values)


def lag(col: str, n: int) -> Ordered:
    return Ordered(n, lambda w: F.lag(col, n).over(w))


def lags(cols: Sequence[str], steps: Sequence[int]) -> dict[str, Ordered]:
    return {f"{c}_lag_{n}": lag(c, n) for c in cols for n in steps}


STATISTICS = ("mean", "std", "max", "min", "median")


def _rolling(col: str, rows: int, statistic: str, shift: int, need: int) -> Rolling | Median:
    if statistic not in STATISTICS:
        raise ValueError(f"statistic must be one of {STATISTICS}, not {statistic!r}")
    if statistic == "median":
        return Median(col, rows, shift, need)
    return Rolling(col, rows, statistic, shift, need)


def rolling(col: str, rows: int, statistic: str) -> Rolling | Median:
    """Statistic of the row and the ones before it; null until there are `rows` values."""
    return _rolling(col, rows, statistic, 0, rows)


def rollings(
    col: str, windows: Sequence[int], statistics: Sequence[str] = STATISTICS
) -> dict[str, Rolling | Median]:
    return {f"{col}_rolling_{s}_{w}": rolling(col, w, s) for w in windows for s in statistics}


def rolling_before(
    col: str, rows: int, statistic: str, need: int | None = None
) -> Rolling | Median:
    """Statistic of the rows before the current one, from a quarter of them (at least 10) on."""
    return _rolling(col, rows, statistic, 1, max(rows // 4, 10) if need is None else need)


def pct_change(col: str, n: int) -> Ordered:
    """Relative change against n rows ago; null where that value is 0."""
    return Ordered(n, lambda w: F.try_divide(F.col(col), F.lag(col, n).over(w)) - 1)


def pct_change_before(col: str, n: int) -> Ordered:
    """Relative change of the row before against n rows before it; null where that value is 0."""
    return Ordered(n + 1, lambda w: F.try_divide(F.lag(col, 1).over(w), F.lag(col, n + 1).over(w)) - 1)


def diff(col: str, n: int) -> Ordered:
    return Ordered(n, lambda w: F.col(col) - F.lag(col, n).over(w))


def sequences(
    df: DataFrame,
    features: Sequence[str],
    steps: int,
    target: str | None = None,
    include_current: bool = False,
    series: Series = READINGS,
    block_rows: int | None = None,
) -> DataFrame:
    """Each row with the feature rows before it as an array, oldest first, and its target.

    `include_current` ends the array with the row itself. Rows with fewer than `steps` are dropped.
    """
    first, last = (-(steps - 1), 0) if include_current else (-steps, -1)
    history = Ordered(
        steps, lambda w: F.collect_list(F.struct(*features)).over(w.rowsBetween(first, last))
    )
    keep = [*series.keys, *series.order, POSITION]
    keep += [c for c in (target,) if c and c not in keep]
    carried = [*keep, *[f for f in features if f not in keep]]
    out = over_blocks(df.select(*carried), {"sequence": history}, series, block_rows)
    return out.filter(F.size("sequence") == steps).select(*keep, "sequence")


def sequence_blocks(
    df: DataFrame, features: Sequence[str], target: str | None = None, series: Series = READINGS, block_rows: int = 1024
) -> DataFrame:
    """Every row once, `block_rows` consecutive ones of a series to an array `rows`; the form to store long sequences in.

    Beside it, in the same order, stands the array `steps` of the rows' features alone, which sequences are cut out of.
    `cut_sequences` makes the sequences from it. A stored sequence would repeat all its steps in every row.
    """
    fields = dict.fromkeys([POSITION, *series.order, *([target] if target else [])])
    row = F.struct(*[F.col(c) for c in fields], F.struct(*features).alias("_step"))
    block = F.floor(F.col(POSITION) / block_rows).alias("block")
    gathered = df.groupBy(*series.keys, block).agg(F.sort_array(F.collect_list(row)).alias("_all"))
    own = F.transform("_all", lambda r: F.struct(*[r[c].alias(c) for c in fields]))
    return gathered.select(*series.keys, "block", own.alias("rows"), F.col("_all._step").alias("steps"))


def cut_sequences(
    blocks: DataFrame,
    features: Sequence[str],
    steps: int,
    target: str | None = None,
    include_current: bool = False,
    series: Series = READINGS,
) -> DataFrame:
    """The sequences of `sequences`, cut out of `sequence_blocks` as they are read.

    A block gets the last `steps` rows of the block before it; blocks must have at least that many rows,
    otherwise an error is raised where one is met. Rows with fewer than `steps` rows before them are dropped.
    """
    stored = blocks.schema["steps"].dataType.elementType.fieldNames()
    if list(features) != stored:
        # chosen once for a block, not for every sequence
        chosen = F.transform("steps", lambda r: F.struct(*[r[f].alias(f) for f in features]))
        blocks = blocks.withColumn("steps", chosen)
    before = blocks.select(
        *[F.col(k).alias(f"_{k}") for k in series.keys],
        (F.col("block") + 1).alias("_block"),
        F.slice("steps", F.greatest(F.size("steps") - steps, F.lit(0)) + 1, steps).alias("_carried"),
    )
    same = F.col("block") == F.col("_block")
    if series.keys:
        same = same & _same(series.keys)
    short = F.raise_error(F.lit(f"blocks must hold {steps} rows or more"))
    # every block but the first has a full one before it
    carried = F.when(F.col("block") == 0, F.slice("steps", 1, 0)).when(F.size("_carried") < steps, short).otherwise(F.col("_carried"))
    both = blocks.join(before, same, "left").select(*series.keys, "rows", F.concat(carried, "steps").alias("_all"), F.size(carried).alias("_at"))
    # a row's number in its block; the rows alone are exploded, the steps of each are cut out of its block
    spread = both.select(*series.keys, "_all", "_at", F.posexplode("rows").alias("_place", "_own"))
    last = F.col("_at") + F.col("_place") + int(include_current)
    spread = spread.filter(last >= steps)
    keep = [c for c in dict.fromkeys([*series.order, POSITION, *([target] if target else [])]) if c not in series.keys]
    return spread.select(
        *series.keys, *[F.col("_own")[c].alias(c) for c in keep], F.slice("_all", last - steps + 1, steps).alias("sequence")
    )


def augment_sequences(df: DataFrame, copies: int, noise: float, seed: int = 42) -> DataFrame:
    """The sequences and noisy copies of them, as arrays of values; copy 0 is the original.

    Noise is drawn per value from the row's id, so a retried task draws the same numbers: two
    uniform hashes give one normal deviate (Box-Muller).
    """
    from math import pi

    fields = df.schema["sequence"].dataType.elementType.fieldNames()
    flat = F.transform("sequence", lambda s: F.array(*[s[f].cast("double") for f in fields]))

    def uniform(step: Column, place: Column, salt: int) -> Column:
        bits = F.xxhash64(F.lit(seed + salt), F.col(READING_ID), F.col("copy"), step, place)
        return (F.pmod(bits, F.lit(2**52)) + 1) / F.lit(float(2**52 + 1))

    def normal(step: Column, place: Column) -> Column:
        return F.sqrt(F.log(uniform(step, place, 0)) * -2) * F.cos(
            uniform(step, place, 1) * (2 * pi)
        )

    def noisy(values: Column, step: Column) -> Column:
        return F.transform(
            values,
            lambda x, place: F.when(F.col("copy") == 0, x).otherwise(x + normal(step, place) * noise),
        )

    return df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies)))).withColumn(
        "sequence", F.transform(flat, noisy)
    )


def ensure_id(df: DataFrame, order: Sequence[str], name: str = "id") -> DataFrame:
    """Number the rows in the given order if they have no id yet."""
    if name in df.columns:
        return df
    return with_position(df, Series(keys=(), order=tuple(order)), name).select(name, *df.columns)
