"""Ordered features, future rows, encodings, scaling, filling and outliers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog.inputs import (
    EVENT_SERIES,
    columns,
    rd,
    readings,
    rounded,
    rounded_all,
    snap,
    snapped,
    table,
    to_forecast,
    train,
    with_readings,
)
from catalog.registry import query
from gridtally.operators import encoding, future, ordered, outliers
from gridtally.operators.ordered import over_blocks, with_position
from gridtally.operators.runs import SortedRuns
from gridtally.operators.splits import kfold
from gridtally.plans.seasonal import seasonal_difference
from gridtally.session import materialize, scratch_path

_ORDER = "PARTITION BY meter_id ORDER BY ts, reading_id"


def _placed(spark, sf_dir, *cols):
    df = readings(spark, sf_dir).select("reading_id", "meter_id", "ts", *(cols or ("cost_krw",)))
    return with_position(df)


def _added(spark, sf_dir, values, digits=4):
    """The ids with the added values, cut alike in both engines."""
    out = over_blocks(_placed(spark, sf_dir), values).select("reading_id", *values)
    return snapped(out, digits, *values)


@query(
    "position",
    with_readings(
        f"SELECT reading_id, row_number() OVER ({_ORDER}) - 1 AS position FROM readings"
    ),
)
def position(spark, sf_dir):
    return _placed(spark, sf_dir).select("reading_id", "position")


@query(
    "position_appended",
    with_readings(
        f"SELECT reading_id, row_number() OVER ({_ORDER}) - 1 AS position FROM readings"
    ),
)
def position_appended(spark, sf_dir):
    """All readings in four appends: two spans of time, the one between them, and late rows of all of them."""
    df = readings(spark, sf_dir).select("reading_id", "meter_id", "ts", "cost_krw")
    late = F.col("reading_id") % 50 == 0
    months = df.select(F.trunc("ts", "month").alias("month")).distinct()
    span = months.select("month", F.ntile(3).over(Window.orderBy("month")).alias("span"))
    parted = df.withColumn("month", F.trunc("ts", "month")).join(span, "month").drop("month")
    runs = SortedRuns(spark, scratch_path(spark, "runs"))
    for number in (1, 3, 2):
        runs.append(parted.filter((F.col("span") == number) & ~late).drop("span"))
    runs.append(df.filter(late))
    return runs.positions().select("reading_id", "position")


LAGS = (1, 2, 6, 12, 24, 48, 96, 168, 336)


@query(
    "lags",
    with_readings(
        "SELECT reading_id, "
        + columns(LAGS, "lag(cost_krw, {0}) OVER w AS cost_krw_lag_{0}")
        + f" FROM readings WINDOW w AS ({_ORDER})"
    ),
)
def lags(spark, sf_dir):
    values = ordered.lags(["cost_krw"], LAGS)
    return over_blocks(_placed(spark, sf_dir), values).select("reading_id", *values)


_EVENT_VALUES = {
    "value_lag_24": ordered.lag("value", 24),
    "value_diff_3": ordered.diff("value", 3),
    "value_rolling_mean_12": ordered.rolling("value", 12, "mean"),
    "value_rolling_std_12": ordered.rolling("value", 12, "std"),
}


@query(
    "event_series_blocks",
    "SELECT event_id, lag(value, 24) OVER w AS value_lag_24, "
    + rd("value - lag(value, 3) OVER w", 5)
    + " AS value_diff_3, "
    "CASE WHEN count(value) OVER r = 12 THEN round(avg(value) OVER r, 5) END AS value_rolling_mean_12, "
    "CASE WHEN count(value) OVER r = 12 THEN round(stddev_samp(value) OVER r, 5) END AS value_rolling_std_12 "
    "FROM events WINDOW w AS (ORDER BY ts, event_id), "
    "r AS (ORDER BY ts, event_id ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)",
)
def event_series_blocks(spark, sf_dir):
    """One series without any key: the blocks alone spread the work."""
    df = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    placed = with_position(df, EVENT_SERIES)
    out = over_blocks(placed, _EVENT_VALUES, EVENT_SERIES, block_rows=128)
    out = out.select("event_id", *_EVENT_VALUES)
    return rounded(out, 5, *[c for c in _EVENT_VALUES if c != "value_lag_24"])


WINDOWS = (6, 12, 24, 48, 96, 168)
_SQL_STATISTICS = {"mean": "avg", "std": "stddev_samp", "max": "max", "min": "min", "median": "median"}


def _rolling_sql(statistics, windows):
    cols = [
        f"CASE WHEN count(cost_krw) OVER w{w} = {w} "
        f"THEN {snap(f'{_SQL_STATISTICS[s]}(cost_krw) OVER w{w}', 4)} END AS cost_krw_rolling_{s}_{w}"
        for w in windows
        for s in statistics
    ]
    frames = [f"w{w} AS ({_ORDER} ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)" for w in windows]
    return with_readings(
        f"SELECT reading_id, {', '.join(cols)} FROM readings WINDOW {', '.join(frames)}"
    )


@query("rolling", _rolling_sql(("mean", "std", "max", "min"), WINDOWS))
def rolling(spark, sf_dir):
    values = ordered.rollings("cost_krw", WINDOWS, ("mean", "std", "max", "min"))
    return _added(spark, sf_dir, values)


@query("rolling_median", _rolling_sql(("median",), WINDOWS))
def rolling_median(spark, sf_dir):
    return _added(spark, sf_dir, ordered.rollings("cost_krw", WINDOWS, ("median",)))


@query(
    "pct_change",
    with_readings(
        "SELECT reading_id, "
        + columns((1, 3, 24), "round(reactive_lag_kvarh / nullif(lag(reactive_lag_kvarh, {0}) OVER w, 0) - 1, 7) AS change_{0}")
        + f" FROM readings WINDOW w AS ({_ORDER})"
    ),
)
def pct_change(spark, sf_dir):
    """The reactive energy is 0 for every 37th reading, which makes the next change null."""
    values = {f"change_{n}": ordered.pct_change("reactive_lag_kvarh", n) for n in (1, 3, 24)}
    out = over_blocks(_placed(spark, sf_dir, "reactive_lag_kvarh"), values)
    return rounded_all(out.select("reading_id", *values), 7)


@query(
    "diff",
    with_readings(
        "SELECT reading_id, "
        + ", ".join(f"{snap(f'cost_krw - lag(cost_krw, {n}) OVER w', 4)} AS diff_{n}" for n in (1, 3))
        + f" FROM readings WINDOW w AS ({_ORDER})"
    ),
)
def diff(spark, sf_dir):
    return _added(spark, sf_dir, {f"diff_{n}": ordered.diff("cost_krw", n) for n in (1, 3)})


_BEFORE_VALUES = {
    f"before_{s}_{w}": ordered.rolling_before("cost_krw", w, s)
    for w in (24, 168)
    for s in ("mean", "std", "max", "min")
}


def _before_sql(source):
    cols = [
        f"CASE WHEN count(cost_krw) OVER w{w} >= {max(w // 4, 10)} "
        f"THEN {snap(f'{_SQL_STATISTICS[s]}(cost_krw) OVER w{w}', 4)} END AS before_{s}_{w}"
        for w in (24, 168)
        for s in ("mean", "std", "max", "min")
    ]
    frames = [f"w{w} AS ({_ORDER} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)" for w in (24, 168)]
    return f"SELECT reading_id, {', '.join(cols)} FROM {source} WINDOW {', '.join(frames)}"


@query("rolling_before", with_readings(_before_sql("readings")))
def rolling_before(spark, sf_dir):
    return _added(spark, sf_dir, _BEFORE_VALUES)


_JOINED = (
    "joined AS (SELECT * FROM train UNION ALL BY NAME SELECT * FROM to_forecast)"
)


@query(
    "lags_across",
    with_readings(
        "SELECT a.reading_id, a.cost_krw_lag_1, a.cost_krw_lag_24, a.cost_krw_lag_168, "
        "b.* EXCLUDE (reading_id) FROM (SELECT reading_id, "
        + columns((1, 24, 168), "lag(cost_krw, {0}) OVER w AS cost_krw_lag_{0}")
        + f" FROM joined WINDOW w AS ({_ORDER})) a JOIN ({_before_sql('joined')}) b USING (reading_id) "
        "WHERE reading_id IN (SELECT reading_id FROM to_forecast)",
        _JOINED,
    ),
)
def lags_across(spark, sf_dir):
    values = {**ordered.lags(["cost_krw"], (1, 24, 168)), **_BEFORE_VALUES}
    out = future.lags_across(train(spark, sf_dir), to_forecast(spark, sf_dir), values)
    return snapped(out.select("reading_id", *values), 4, *_BEFORE_VALUES)


# Rows whose own past is not measured yet

_TAIL = (
    "tail AS (SELECT *, row_number() OVER (PARTITION BY meter_id ORDER BY ts DESC, reading_id DESC) AS rank "
    "FROM train)"
)
_AHEAD = "FROM to_forecast f LEFT JOIN ends USING (meter_id)"


@query(
    "future_last_lag",
    with_readings(
        f"SELECT reading_id, ends.* EXCLUDE (meter_id) {_AHEAD}",
        _TAIL,
        "ends AS (SELECT meter_id, "
        + columns((1, 2, 3, 6, 12, 24), "max(cost_krw) FILTER (rank = {0}) AS cost_krw_lag_{0}")
        + " FROM tail GROUP BY 1)",
    ),
)
def future_last_lag(spark, sf_dir):
    out = future.future_last_lag(
        train(spark, sf_dir), to_forecast(spark, sf_dir), ["cost_krw"], (1, 2, 3, 6, 12, 24)
    )
    return out.drop("meter_id", "ts", "work_type")


@query(
    "future_last_lag_long",
    with_readings(
        f"SELECT reading_id, ends.* EXCLUDE (meter_id) {_AHEAD}",
        "tail AS (SELECT *, row_number() OVER (PARTITION BY meter_id ORDER BY ts DESC, reading_id DESC) AS rank FROM train)",
        "ends AS (SELECT meter_id, "
        + columns((1, 672, 1344), "max(cost_krw) FILTER (rank = {0}) AS cost_krw_lag_{0}")
        + " FROM tail GROUP BY 1)",
    ),
)
def future_last_lag_long(spark, sf_dir):
    """Two weeks of quarter hours back."""
    out = future.future_last_lag(train(spark, sf_dir), to_forecast(spark, sf_dir), ["cost_krw"], (1, 672, 1344))
    return out.drop("meter_id", "ts", "work_type")


def _tail_sql(full):
    cols = []
    for w in (3, 6, 12, 24):
        for s in ("mean", "std", "max", "min"):
            value = snap(f"{_SQL_STATISTICS[s]}(cost_krw) FILTER (rank <= {w})", 4)
            if full:
                value = f"CASE WHEN max(rank) >= {w} THEN {value} END"
            cols.append(f"{value} AS cost_krw_rolling_{s}_{w}")
    return with_readings(
        f"SELECT reading_id, ends.* EXCLUDE (meter_id) {_AHEAD}",
        _TAIL,
        f"ends AS (SELECT meter_id, {', '.join(cols)} FROM tail GROUP BY 1)",
    )


def _snapped_values(out):
    out = out.drop("meter_id", "ts", "work_type")
    return snapped(out, 4, *[c for c in out.columns if c != "reading_id"])


@query("future_last_rolling", _tail_sql(full=True))
def future_last_rolling(spark, sf_dir):
    out = future.future_last_rolling(
        train(spark, sf_dir), to_forecast(spark, sf_dir), ["cost_krw"], (3, 6, 12, 24)
    )
    return _snapped_values(out)


@query("future_tail_stats", _tail_sql(full=False))
def future_tail_stats(spark, sf_dir):
    out = future.future_tail_stats(
        train(spark, sf_dir), to_forecast(spark, sf_dir), ["cost_krw"], (3, 6, 12, 24)
    )
    return _snapped_values(out)


@query(
    "future_tail_change",
    with_readings(
        "SELECT reading_id, "
        + ", ".join(
            f"{rd(f'v1 - v{n + 1}', 5)} AS cost_krw_diff_{n}, "
            f"round((v1 - v{n + 1}) / v{n + 1}, 8) AS cost_krw_pct_change_{n}"
            for n in (1, 3)
        )
        + f" {_AHEAD}",
        _TAIL,
        "ends AS (SELECT meter_id, "
        + columns((1, 2, 4), "max(cost_krw) FILTER (rank = {0}) AS v{0}")
        + " FROM tail GROUP BY 1)",
    ),
)
def future_tail_change(spark, sf_dir):
    out = future.future_tail_change(
        train(spark, sf_dir), to_forecast(spark, sf_dir), ["cost_krw"], (1, 3)
    ).drop("meter_id", "ts", "work_type")
    changes = [c for c in out.columns if "_pct_" in c]
    return rounded(rounded(out, 8, *changes), 5, "cost_krw_diff_1", "cost_krw_diff_3")


@query(
    "future_tiled_lag",
    with_readings(
        "SELECT f.reading_id, "
        + columns((1, 3, 6, 12, 24), "t{0}.cost_krw AS cost_krw_lag_{0}")
        + " FROM placed f "
        + " ".join(
            f"LEFT JOIN tail t{n} ON t{n}.meter_id = f.meter_id AND t{n}.rank = {n} - f.place % {n}"
            for n in (1, 3, 6, 12, 24)
        ),
        _TAIL,
        f"placed AS (SELECT *, row_number() OVER ({_ORDER}) - 1 AS place FROM to_forecast)",
    ),
)
def future_tiled_lag(spark, sf_dir):
    ahead = with_position(to_forecast(spark, sf_dir))
    out = future.future_tiled_lag(train(spark, sf_dir), ahead, ["cost_krw"], (1, 3, 6, 12, 24))
    return out.drop("meter_id", "ts", "work_type", "position")


# Sequences

_STEPS = 10


def _sequence_sql(source, first, last, target, extra=""):
    return (
        f"SELECT reading_id, {target}, {_STEPS} AS steps, "
        "round(list_sum(u), 5) AS usage_sum, u[1] AS usage_first, u[10] AS usage_last, "
        "p[1] AS pf_first, p[10] AS pf_last FROM (SELECT *, list(usage_kwh) OVER w AS u, "
        f"list(pf_lag_pct) OVER w AS p FROM {source} WINDOW w AS ({_ORDER} ROWS BETWEEN {first} AND {last})) "
        f"WHERE len(u) = {_STEPS} {extra}"
    )


def _shown(df, *cols):
    """A sequence as plain columns."""
    seq = F.col("sequence")
    return df.select(
        "reading_id",
        *cols,
        F.size(seq).alias("steps"),
        F.round(F.aggregate(seq["usage_kwh"], F.lit(0.0), lambda a, x: a + x), 5).alias("usage_sum"),
        seq[0]["usage_kwh"].alias("usage_first"),
        seq[_STEPS - 1]["usage_kwh"].alias("usage_last"),
        seq[0]["pf_lag_pct"].alias("pf_first"),
        seq[_STEPS - 1]["pf_lag_pct"].alias("pf_last"),
    )


_INPUTS = ("usage_kwh", "pf_lag_pct")


@query(
    "sequences",
    with_readings(_sequence_sql("readings", "10 PRECEDING", "1 PRECEDING", "cost_krw")),
)
def sequences(spark, sf_dir):
    placed = _placed(spark, sf_dir, *_INPUTS, "cost_krw")
    return _shown(ordered.sequences(placed, _INPUTS, _STEPS, "cost_krw"), "cost_krw")


@query(
    "sequences_with_current",
    with_readings(_sequence_sql("readings", "9 PRECEDING", "CURRENT ROW", "cost_krw")),
)
def sequences_with_current(spark, sf_dir):
    placed = _placed(spark, sf_dir, *_INPUTS, "cost_krw")
    out = ordered.sequences(placed, _INPUTS, _STEPS, "cost_krw", include_current=True)
    return _shown(out, "cost_krw")


_LONG = 672


@query(
    "sequences_672",
    with_readings(
        f"SELECT reading_id, cost_krw, {_LONG} AS steps, first_value(usage_kwh) OVER s AS usage_first, last_value(usage_kwh) OVER s AS usage_last, "
        "max(usage_kwh) OVER s AS usage_max, min(usage_kwh) OVER s AS usage_min, first_value(pf_lag_pct) OVER s AS pf_first, "
        "last_value(pf_lag_pct) OVER s AS pf_last FROM readings "
        f"WINDOW s AS ({_ORDER} ROWS BETWEEN {_LONG} PRECEDING AND 1 PRECEDING) QUALIFY count(*) OVER s = {_LONG}"
    ),
)
def sequences_672(spark, sf_dir):
    """A week of quarter hours before each reading, cut out of stored blocks."""
    placed = _placed(spark, sf_dir, *_INPUTS, "cost_krw")
    blocks = materialize(ordered.sequence_blocks(placed, _INPUTS, "cost_krw"), "blocks")
    seq = F.col("sequence")
    usage = seq["usage_kwh"]
    return ordered.cut_sequences(blocks, _INPUTS, _LONG, "cost_krw").select(
        "reading_id",
        "cost_krw",
        F.size(seq).alias("steps"),
        usage[0].alias("usage_first"),
        F.element_at(usage, -1).alias("usage_last"),
        F.array_max(usage).alias("usage_max"),
        F.array_min(usage).alias("usage_min"),
        seq[0]["pf_lag_pct"].alias("pf_first"),
        F.element_at(seq, -1)["pf_lag_pct"].alias("pf_last"),
    )


_FUTURE_INPUTS = (
    "both_rows AS (SELECT meter_id, reading_id, ts, usage_kwh, pf_lag_pct FROM readings)"
)


@query(
    "future_sequences",
    with_readings(
        _sequence_sql(
            "both_rows",
            "10 PRECEDING",
            "1 PRECEDING",
            "ts",
            "AND reading_id IN (SELECT reading_id FROM to_forecast)",
        ),
        _FUTURE_INPUTS,
    ),
)
def future_sequences(spark, sf_dir):
    """The sequence inputs are known ahead here, as calendar inputs are in a forecast."""
    rows = readings(spark, sf_dir)
    ahead = rows.join(to_forecast(spark, sf_dir).select("reading_id"), "reading_id", "left_semi")
    return _shown(future.future_sequences(train(spark, sf_dir), ahead, _INPUTS, _STEPS), "ts")


@query(
    "augment_sequences",
    with_readings(
        "SELECT reading_id, CAST(c AS INTEGER) AS copy, cost_krw, steps, "
        "CASE WHEN c = 0 THEN usage_first END AS usage_first, c > 0 AS noisy FROM ("
        + _sequence_sql("readings", "10 PRECEDING", "1 PRECEDING", "cost_krw")
        + "), (SELECT unnest(range(3)) AS c)"
    ),
)
def augment_sequences(spark, sf_dir):
    """The original and two noisy copies; SQL can tell which values must have changed."""
    placed = _placed(spark, sf_dir, *_INPUTS, "cost_krw")
    plain = ordered.sequences(placed, _INPUTS, _STEPS, "cost_krw")
    plain = plain.withColumn("usage_first", F.col("sequence")[0]["usage_kwh"])
    out = ordered.augment_sequences(plain, copies=2, noise=0.01)
    first = F.col("sequence")[0][0]
    return out.select(
        "reading_id",
        "copy",
        "cost_krw",
        F.size("sequence").alias("steps"),
        F.when(F.col("copy") == 0, first).alias("usage_first"),
        (first != F.col("usage_first")).alias("noisy"),
    )


@query(
    "seasonal_difference",
    with_readings(
        "SELECT reading_id, "
        + snap(
            "(cost_krw - lag(cost_krw, 1) OVER w) - (lag(cost_krw, 24) OVER w - lag(cost_krw, 25) OVER w)", 4
        )
        + f" AS change FROM readings WINDOW w AS ({_ORDER})"
    ),
)
def seasonal_difference_query(spark, sf_dir):
    return _added(spark, sf_dir, {"change": seasonal_difference("cost_krw", 24)})


# Encodings


@query(
    "label_encode",
    with_readings(
        "SELECT f.reading_id, f.work_type, CAST(c.code AS INTEGER) AS work_type_encoded FROM to_forecast f "
        "JOIN (SELECT work_type, row_number() OVER (ORDER BY work_type) - 1 AS code "
        "FROM (SELECT DISTINCT work_type FROM train)) c USING (work_type)"
    ),
)
def label_encode(spark, sf_dir):
    labels = encoding.fit_labels(train(spark, sf_dir), "work_type")
    out = encoding.label_encode(to_forecast(spark, sf_dir), labels, "work_type")
    return out.select("reading_id", "work_type", "work_type_encoded")


def _smooth(mean, n):
    weight = f"(1 / (1 + exp(-({n} - 10))))"
    return f"(SELECT avg(cost_krw) FROM train) * (1 - {weight}) + {mean} * {weight}"


_MEANS = (
    "means AS (SELECT pf_lag_pct, "
    + _smooth("avg(cost_krw)", "count(cost_krw)")
    + " AS te FROM train GROUP BY 1)"
)


@query(
    "target_encode",
    with_readings(
        "SELECT reading_id, round(te, 5) AS pf_lag_pct_te FROM readings LEFT JOIN means USING (pf_lag_pct) "
        "WHERE ts >= TIMESTAMP '2024-12-01 00:00:00'",
        _MEANS,
    ),
)
def target_encode(spark, sf_dir):
    known = train(spark, sf_dir)
    means = encoding.fit_target_means(known, "pf_lag_pct", "cost_krw")
    rows = readings(spark, sf_dir).filter(F.col("ts") >= F.lit("2024-12-01").cast("timestamp_ntz"))
    out = encoding.target_encode(rows, means, "pf_lag_pct")
    return rounded(out.select("reading_id", "pf_lag_pct_te"), 5, "pf_lag_pct_te")


@query(
    "target_encode_default",
    with_readings(
        "SELECT reading_id, round(coalesce(te, (SELECT avg(cost_krw) FROM train)), 5) AS pf_lag_pct_te "
        "FROM to_forecast JOIN readings USING (reading_id) LEFT JOIN (SELECT pf_lag_pct, "
        + _smooth("avg(cost_krw)", "count(cost_krw)")
        + " AS te FROM train GROUP BY 1) USING (pf_lag_pct)"
    ),
)
def target_encode_default(spark, sf_dir):
    known = train(spark, sf_dir)
    means = encoding.fit_target_means(known, "pf_lag_pct", "cost_krw")
    rows = readings(spark, sf_dir).join(
        to_forecast(spark, sf_dir).select("reading_id"), "reading_id", "left_semi"
    )
    default = known.agg(F.avg("cost_krw")).scalar()
    out = encoding.target_encode(rows, means, "pf_lag_pct", default)
    return rounded(out.select("reading_id", "pf_lag_pct_te"), 5, "pf_lag_pct_te")


@query(
    "target_encode_oof",
    with_readings(
        "SELECT t.reading_id, round(coalesce("
        + _smooth("m.mean", "m.n")
        + ", (SELECT avg(cost_krw) FROM train)), 5) AS pf_lag_pct_te FROM train t LEFT JOIN ("
        "SELECT f.fold, t.pf_lag_pct, avg(t.cost_krw) AS mean, count(*) AS n FROM train t "
        "JOIN (SELECT unnest(range(5)) AS fold) f ON t.reading_id % 5 <> f.fold GROUP BY ALL) m "
        "ON m.fold = t.reading_id % 5 AND m.pf_lag_pct = t.pf_lag_pct"
    ),
)
def target_encode_oof(spark, sf_dir):
    out = encoding.target_encode_oof(train(spark, sf_dir), "pf_lag_pct", "cost_krw", kfold(5))
    return rounded(out.select("reading_id", "pf_lag_pct_te"), 5, "pf_lag_pct_te")


@query(
    "target_encode_oof_null_category",
    with_readings(
        "SELECT t.reading_id, round(coalesce("
        + _smooth("m.mean", "m.n")
        + ", (SELECT avg(cost_krw) FROM train)), 5) AS kind_te FROM (SELECT *, nullif(pf_lag_pct, 61) AS kind FROM train) t "
        "LEFT JOIN (SELECT f.fold, nullif(t.pf_lag_pct, 61) AS kind, avg(t.cost_krw) AS mean, count(*) AS n FROM train t "
        "JOIN (SELECT unnest(range(5)) AS fold) f ON t.reading_id % 5 <> f.fold GROUP BY ALL) m "
        "ON m.fold = t.reading_id % 5 AND m.kind IS NOT DISTINCT FROM t.kind"
    ),
)
def target_encode_oof_null_category(spark, sf_dir):
    known = train(spark, sf_dir).withColumn("kind", F.nullif(F.col("pf_lag_pct"), F.lit(61.0)))
    out = encoding.target_encode_oof(known, "kind", "cost_krw", kfold(5))
    return rounded(out.select("reading_id", "kind_te"), 5, "kind_te")


# Scaling and filling; the last column has no spread

_SCALED = ("usage_kwh", "cost_krw", "carbon_tco2")


def _with_constant(df):
    return df.select("reading_id", *_SCALED, F.lit(3.0).alias("constant"))


def _scale_sql(center, width, digits=6):
    """Scale December by the statistics of the training rows."""
    cols = [
        rd(f"({c} - (SELECT {center.format(c)} FROM train)) / (SELECT {width.format(c)} FROM train)", digits)
        + f" AS {c}"
        for c in _SCALED
    ]
    return with_readings(
        f"SELECT reading_id, {', '.join(cols)}, CAST(0 AS DOUBLE) AS constant FROM readings "
        "WHERE ts >= TIMESTAMP '2024-12-01 00:00:00'"
    )


def _scaled(spark, sf_dir, fit):
    known = _with_constant(train(spark, sf_dir))
    rows = readings(spark, sf_dir).filter(F.col("ts") >= F.lit("2024-12-01").cast("timestamp_ntz"))
    scaling = fit(known, [*_SCALED, "constant"])
    return rounded_all(scaling.scale(_with_constant(rows)), 6)


@query(
    "robust_scale",
    _scale_sql("median({0})", "quantile_cont({0}, 0.75) - quantile_cont({0}, 0.25)"),
)
def robust_scale(spark, sf_dir):
    return _scaled(spark, sf_dir, encoding.fit_robust)


@query("standard_scale", _scale_sql("avg({0})", "stddev_pop({0})"))
def standard_scale(spark, sf_dir):
    return _scaled(spark, sf_dir, encoding.fit_standard)


@query("minmax_scale", _scale_sql("min({0})", "max({0}) - min({0})"))
def minmax_scale(spark, sf_dir):
    return _scaled(spark, sf_dir, encoding.fit_minmax)


@query(
    "scale_and_invert",
    with_readings("SELECT reading_id, round(usage_kwh, 6) AS usage_kwh, round(cost_krw, 5) AS cost_krw FROM readings"),
)
def scale_and_invert(spark, sf_dir):
    df = readings(spark, sf_dir).select("reading_id", "usage_kwh", "cost_krw")
    standard = encoding.fit_standard(df, ["usage_kwh"])
    ranged = encoding.fit_minmax(df, ["cost_krw"])
    back = ranged.invert(standard.invert(ranged.scale(standard.scale(df))))
    return rounded(rounded(back, 6, "usage_kwh"), 5, "cost_krw")


_FAMILIES = {
    "numeric": ["usage_kwh"],
    "categorical": ["pf_lag_pct"],
    "lag": ["cost_krw_lag_1"],
    "rolling": ["cost_krw_rolling_mean_6"],
}


@query(
    "scale_families",
    with_readings(
        "SELECT reading_id, "
        + rd("(usage_kwh - (SELECT median(usage_kwh) FROM f)) / (SELECT quantile_cont(usage_kwh, 0.75) - quantile_cont(usage_kwh, 0.25) FROM f)", 6)
        + " AS usage_kwh, "
        + rd("(pf_lag_pct - (SELECT avg(pf_lag_pct) FROM f)) / (SELECT stddev_pop(pf_lag_pct) FROM f)", 6)
        + " AS pf_lag_pct, "
        + rd("(lag1 - (SELECT min(lag1) FROM f)) / (SELECT max(lag1) - min(lag1) FROM f)", 6)
        + " AS cost_krw_lag_1, "
        + rd("(roll - (SELECT median(roll) FROM f)) / (SELECT quantile_cont(roll, 0.75) - quantile_cont(roll, 0.25) FROM f)", 6)
        + " AS cost_krw_rolling_mean_6 FROM f",
        "f AS (SELECT * FROM (SELECT reading_id, usage_kwh, pf_lag_pct, lag(cost_krw) OVER w AS lag1, "
        "CASE WHEN count(cost_krw) OVER r = 6 THEN avg(cost_krw) OVER r END AS roll FROM readings "
        f"WINDOW w AS ({_ORDER}), r AS ({_ORDER} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)) WHERE roll IS NOT NULL)",
    ),
)
def scale_families(spark, sf_dir):
    """Scaled, assembled into one vector, and shown as columns again."""
    from pyspark.ml.functions import vector_to_array

    placed = _placed(spark, sf_dir, "usage_kwh", "pf_lag_pct", "cost_krw")
    values = {
        "cost_krw_lag_1": ordered.lag("cost_krw", 1),
        "cost_krw_rolling_mean_6": ordered.rolling("cost_krw", 6, "mean"),
    }
    names = [c for cols in _FAMILIES.values() for c in cols]
    df = over_blocks(placed, values).select("reading_id", *names).dropna()
    vectors = encoding.assemble(encoding.fit_families(df, _FAMILIES).scale(df), names)
    parts = vectors.select("reading_id", vector_to_array("features").alias("v"))
    return rounded_all(parts.select("reading_id", *[F.col("v")[i].alias(n) for i, n in enumerate(names)]), 6)


_ODD = (
    "CASE reading_id % 11 WHEN 0 THEN NULL WHEN 1 THEN CAST('NaN' AS DOUBLE) "
    "WHEN 2 THEN CAST('Infinity' AS DOUBLE) WHEN 3 THEN CAST('-Infinity' AS DOUBLE) ELSE usage_kwh END"
)


def _odd(spark, sf_dir):
    return readings(spark, sf_dir).select(
        "reading_id",
        F.expr(_ODD.replace("reading_id % 11", "CAST(reading_id % 11 AS INT)")).alias("usage_kwh"),
    )


@query(
    "replace_nonfinite",
    with_readings(
        "SELECT reading_id, CASE WHEN reading_id % 11 < 4 THEN 0 ELSE usage_kwh END AS usage_kwh FROM readings"
    ),
)
def replace_nonfinite(spark, sf_dir):
    return encoding.replace_nonfinite(_odd(spark, sf_dir), ["usage_kwh"])


@query(
    "cap_nonfinite",
    with_readings(
        "SELECT reading_id, CASE reading_id % 11 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN 1e10 "
        "WHEN 3 THEN -1e10 ELSE usage_kwh END AS usage_kwh FROM readings"
    ),
)
def cap_nonfinite(spark, sf_dir):
    return encoding.replace_nonfinite(_odd(spark, sf_dir), ["usage_kwh"], 0.0, cap=1e10)


def _gappy(df):
    return df.select(
        "reading_id",
        F.when(F.col("reading_id") % 4 != 0, F.col("usage_kwh")).alias("usage_kwh"),
        F.when(F.col("reading_id") % 9 != 0, F.col("carbon_tco2")).alias("carbon_tco2"),
    )


_GAPPY = (
    "gappy AS (SELECT reading_id, ts, CASE WHEN reading_id % 4 <> 0 THEN usage_kwh END AS usage_kwh, "
    "CASE WHEN reading_id % 9 <> 0 THEN carbon_tco2 END AS carbon_tco2 FROM readings)"
)


@query(
    "impute_median",
    with_readings(
        f"SELECT reading_id, {snap('coalesce(usage_kwh, (SELECT median(usage_kwh) FROM gappy))', 6)} AS usage_kwh, "
        f"{snap('coalesce(carbon_tco2, (SELECT median(carbon_tco2) FROM gappy))', 9)} AS carbon_tco2 FROM gappy",
        _GAPPY,
    ),
)
def impute_median(spark, sf_dir):
    df = _gappy(readings(spark, sf_dir))
    filled = encoding.impute(df, encoding.fit_medians(df, ["usage_kwh", "carbon_tco2"]))
    return snapped(snapped(filled, 6, "usage_kwh"), 9, "carbon_tco2")


@query(
    "fill_mean",
    with_readings(
        "SELECT reading_id, round((SELECT avg(usage_kwh) FROM train), 6) AS usage_kwh, "
        "round((SELECT avg(carbon_tco2) FROM train), 9) AS carbon_tco2 FROM to_forecast"
    ),
)
def fill_mean(spark, sf_dir):
    means = encoding.fit_means(train(spark, sf_dir), ["usage_kwh", "carbon_tco2"])
    filled = encoding.impute(to_forecast(spark, sf_dir).select("reading_id"), means)
    return rounded(rounded(filled, 6, "usage_kwh"), 9, "carbon_tco2")


@query(
    "fill_zero",
    with_readings(
        "SELECT reading_id, coalesce(usage_kwh, 0) AS usage_kwh, coalesce(carbon_tco2, 0) AS carbon_tco2 FROM gappy",
        _GAPPY,
    ),
)
def fill_zero(spark, sf_dir):
    return encoding.fill_zero(_gappy(readings(spark, sf_dir)), ["usage_kwh", "carbon_tco2"])


@query(
    "drop_nulls",
    with_readings(
        "SELECT reading_id, usage_kwh, carbon_tco2 FROM gappy WHERE carbon_tco2 IS NOT NULL", _GAPPY
    ),
)
def drop_nulls(spark, sf_dir):
    return encoding.drop_nulls(_gappy(readings(spark, sf_dir)), ["carbon_tco2"])


@query(
    "null_counts",
    with_readings(
        "SELECT 'usage_kwh' AS column_name, count(*) - count(usage_kwh) AS nulls FROM gappy "
        "UNION ALL SELECT 'carbon_tco2', count(*) - count(carbon_tco2) FROM gappy "
        "UNION ALL SELECT '(all)', 2 * count(*) - count(usage_kwh) - count(carbon_tco2) FROM gappy",
        _GAPPY,
    ),
)
def null_counts(spark, sf_dir):
    return encoding.null_counts(_gappy(readings(spark, sf_dir)), ["usage_kwh", "carbon_tco2"])


@query(
    "log_target",
    with_readings(
        "SELECT reading_id, round(ln(1 + cost_krw), 9) AS logged, round(exp(ln(1 + cost_krw)) - 1, 5) AS back "
        "FROM readings"
    ),
)
def log_target(spark, sf_dir):
    df = readings(spark, sf_dir).select("reading_id", encoding.log_target("cost_krw").alias("logged"))
    return df.select("reading_id", F.round("logged", 9).alias("logged"), F.round(encoding.unlog("logged"), 5).alias("back"))


@query(
    "clip_floor",
    with_readings(
        "SELECT reading_id, greatest(usage_kwh - 100, 0) AS surplus FROM readings"
    ),
)
def clip_floor(spark, sf_dir):
    df = readings(spark, sf_dir).select("reading_id", (F.col("usage_kwh") - 100).alias("surplus"))
    return encoding.clip_floor(df, "surplus")


# Outliers

_QUARTILES = (
    "q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 "
    "FROM lineitem)"
)


def _sales(spark, sf_dir):
    cols = ("l_orderkey", "l_linenumber", "l_extendedprice")
    df = table(spark, sf_dir, "lineitem")
    return df.select(*[c for c in cols if c in df.columns])


def _iqr(k):
    return f"BETWEEN q1 - {k} * (q3 - q1) AND q3 + {k} * (q3 - q1)"


@query(
    "iqr_filter",
    f"WITH {_QUARTILES} SELECT l_orderkey, l_extendedprice FROM lineitem, q WHERE l_extendedprice {_iqr(0.5)}",
)
def iqr_filter(spark, sf_dir):
    df = _sales(spark, sf_dir).select("l_orderkey", "l_extendedprice")
    return outliers.iqr_filter(df, "l_extendedprice", 0.5)


@query(
    "removed_by_iqr",
    f"WITH {_QUARTILES} SELECT count(*) AS before, count(*) FILTER (l_extendedprice {_iqr(0.5)}) AS after, "
    f"count(*) FILTER (NOT l_extendedprice {_iqr(0.5)}) AS removed FROM lineitem, q",
)
def removed_by_iqr(spark, sf_dir):
    return outliers.removed_by_iqr(_sales(spark, sf_dir), "l_extendedprice", 0.5)


@query(
    "iqr_filter_cost",
    with_readings(
        f"SELECT reading_id, cost_krw FROM readings, q WHERE cost_krw {_iqr(1.5)}",
        "q AS (SELECT quantile_cont(cost_krw, 0.25) AS q1, quantile_cont(cost_krw, 0.75) AS q3 FROM readings)",
    ),
)
def iqr_filter_cost(spark, sf_dir):
    return outliers.iqr_filter(readings(spark, sf_dir).select("reading_id", "cost_krw"), "cost_krw")


@query(
    "quantile_trim",
    with_readings(
        "SELECT reading_id, cost_krw FROM readings, q WHERE cost_krw BETWEEN lo AND hi",
        "q AS (SELECT quantile_cont(cost_krw, 0.025) AS lo, quantile_cont(cost_krw, 0.975) AS hi FROM readings)",
    ),
)
def quantile_trim(spark, sf_dir):
    df = readings(spark, sf_dir).select("reading_id", "cost_krw")
    return outliers.quantile_trim(df, "cost_krw", 0.025, 0.975)
