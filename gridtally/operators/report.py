"""The monthly report: totals, trends, comparisons, peaks, shares and flags.

Every function returns a small DataFrame. Where one row depends on another aggregate of the same
data, that aggregate is a scalar subquery, so nothing is collected and nothing is cross-joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtally.functions.calendar import (
    month_of,
    night_share_flag,
    time_label,
    week_of,
)
from gridtally.operators.filters import (
    in_month,
    newest,
    previous_days,
    previous_month,
    time_range,
    trailing_year,
)
from gridtally.schema import (
    CARBON,
    COST,
    MONTH,
    POWER_FACTOR_FEE,
    READING_ID,
    TS,
    USAGE,
    WORK_TYPE,
)


def _first_of(month: str, shift: int = 0) -> Column:
    return F.add_months(F.lit(f"{month}-01").cast("date"), shift)


def _total(value: Column) -> Column:
    """A sum that is 0 when there is nothing to add."""
    return F.coalesce(F.sum(value), F.lit(0.0))


def change_pct(current: Column, previous: Column) -> Column:
    """Change in percent; 0 when there is nothing to compare with."""
    return F.coalesce(F.try_divide((current - previous), previous) * 100, F.lit(0.0))


def _two_months(df: DataFrame, month: str, ts: str = TS) -> DataFrame:
    """The month and the one before, cut out by a range of time that file scans can use."""
    return time_range(df, _first_of(month, -1), _first_of(month, 1), ts)


def side_by_side(*rows: DataFrame) -> DataFrame:
    """One row with the columns of several one-row frames."""
    names = [f"_row{i}" for i in range(len(rows))]
    scalars = [
        row.select(F.struct("*")).scalar().alias(name) for row, name in zip(rows, names)
    ]
    return rows[0].sparkSession.range(1).select(*scalars).select(*[f"{n}.*" for n in names])


def baseline(df: DataFrame, month: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean daily total, mean weekly total (cut weeks count as weeks) and total of a month."""
    days = (
        in_month(df, month)
        .groupBy(*by, F.to_date(TS).alias("_day"))
        .agg(F.sum(USAGE).alias("_usage"), F.sum(COST).alias("_cost"))
    )
    weeks = F.count_distinct(week_of("_day"))
    out = []
    for name in ("usage", "cost"):
        value = F.col(f"_{name}")
        out += [
            F.avg(value).alias(f"{name}_daily"),
            F.try_divide(F.sum(value), weeks).alias(f"{name}_weekly"),
            F.sum(value).alias(f"{name}_monthly"),
        ]
    return days.groupBy(*by).agg(*out)


def work_type_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, WORK_TYPE).agg(F.count("*").alias("readings"))


def hourly_work_type_share(df: DataFrame, ts: str = TS) -> DataFrame:
    """Share of each work type among the readings of each hour of the day."""
    counts = df.groupBy(F.hour(ts).alias("hour"), WORK_TYPE).agg(F.count("*").alias("readings"))
    return share_of_hour(counts)


def share_of_hour(counts: DataFrame) -> DataFrame:
    """Counts by hour and work type as shares; the window sees at most 24 rows per work type."""
    total = F.sum("readings").over(Window.partitionBy("hour"))
    return counts.withColumn("share", F.col("readings") / total)


def cost_trend(df: DataFrame, unit: str, ts: str = TS, cost: str = COST) -> DataFrame:
    """Total and mean cost per hour, day or weekday label. Labels carry no year: choose a month first."""
    keys = [time_label(unit, ts).alias("label")]
    if unit == "weekday":
        keys.insert(0, F.weekday(ts).alias("weekday"))
    return (
        df.dropna(subset=[ts, cost])
        .groupBy(*keys)
        .agg(
            F.sum(cost).alias("total"),
            F.avg(cost).alias("average"),
            F.count("*").alias("readings"),
        )
    )


def in_label_order(trend: DataFrame) -> DataFrame:
    return trend.orderBy("weekday" if "weekday" in trend.columns else "label")


def trend_stats(trend: DataFrame) -> DataFrame:
    """Grand total, mean of the group means, largest group total and number of readings."""
    return trend.agg(
        F.sum("total").alias("total"),
        F.avg("average").alias("average"),
        F.max("total").alias("largest"),
        F.sum("readings").alias("readings"),
    )


def monthly_usage_cost(df: DataFrame, ts: str = TS) -> DataFrame:
    """Usage total and mean cost of each month of the last year."""
    return (
        trailing_year(df, ts)
        .groupBy(month_of(ts).alias(MONTH))
        .agg(F.sum(USAGE).alias("usage_kwh"), F.avg(COST).alias("mean_cost_krw"))
    )


def mark_selected(monthly: DataFrame, month: str) -> DataFrame:
    return monthly.withColumn("selected", F.col(MONTH) == _first_of(month))


def compare_months(df: DataFrame, month: str, metric: str = USAGE, ts: str = TS) -> DataFrame:
    """Previous and selected month's total, the last year's mean monthly total, and the change.

    A month of the last year without readings counts as a month with total 0.
    """
    since = newest(df, ts) - F.expr("INTERVAL 1 YEAR")
    value, in_year = F.col(metric), F.col(ts) >= since
    first, last = (f(F.when(in_year, month_of(ts))) for f in (F.min, F.max))
    months = F.months_between(last, first) + 1
    this = month_of(ts)
    # nothing older than both periods is needed
    start = F.least(since, _first_of(month, -1).cast(df.schema[ts].dataType))
    return (
        time_range(df, start, ts=ts)
        .agg(
            _total(F.when(this == _first_of(month, -1), value)).alias("previous"),
            _total(F.when(this == _first_of(month), value)).alias("selected"),
            F.coalesce(F.sum(F.when(in_year, value)) / months, F.lit(0.0)).alias("yearly_mean"),
        )
        .withColumn("change_pct", change_pct(F.col("selected"), F.col("previous")))
    )


def monthly_rollup(df: DataFrame, by: Sequence[str] = (), ts: str = TS) -> DataFrame:
    """Usage, cost and carbon of each month."""
    return df.groupBy(*by, month_of(ts).alias(MONTH)).agg(
        F.sum(USAGE).alias(USAGE), F.sum(COST).alias(COST), F.sum(CARBON).alias(CARBON)
    )


CARD_MEASURES = (USAGE, COST, CARBON, POWER_FACTOR_FEE)


def month_cards(
    summary: DataFrame, month: str, measures: Sequence[str] = CARD_MEASURES
) -> DataFrame:
    """Each measure's value in the month and its change; a month that is missing counts as 0."""
    both = summary.filter(F.col(MONTH).isin([_first_of(month), _first_of(month, -1)]))
    now, before = F.col(MONTH) == _first_of(month), F.col(MONTH) == _first_of(month, -1)
    sums = both.agg(
        *[_total(F.when(now, F.col(m))).alias(f"{m}_now") for m in measures],
        *[_total(F.when(before, F.col(m))).alias(f"{m}_before") for m in measures],
    )
    cards = [
        F.struct(
            F.lit(m).alias("measure"),
            F.col(f"{m}_now").alias("value"),
            F.col(f"{m}_before").alias("previous"),
        )
        for m in measures
    ]
    return sums.select(F.inline(F.array(*cards))).withColumn(
        "change_pct", change_pct(F.col("value"), F.col("previous"))
    )


def monthly_change(df: DataFrame, month: str, ts: str = TS) -> DataFrame:
    """Usage and cost change against the previous month; 0 when that month has no readings."""
    now, before = month_of(ts) == _first_of(month), month_of(ts) == _first_of(month, -1)
    cols = []
    for name, value in (("usage", F.col(USAGE)), ("cost", F.col(COST))):
        current = _total(F.when(now, value))
        previous = F.when(F.count_if(before) > 0, _total(F.when(before, value))).otherwise(current)
        cols.append(change_pct(current, previous).alias(f"{name}_change_pct"))
    return _two_months(df, month, ts).agg(*cols)


def change_vs_30d(df: DataFrame, month: str, ts: str = TS, days: int = 30) -> DataFrame:
    """Cost of the month against the days before its first reading."""
    chosen = in_month(df, month, ts)
    return (
        side_by_side(
            chosen.agg(_total(F.col(COST)).alias("current")),
            previous_days(df, chosen, days, ts).agg(_total(F.col(COST)).alias("previous")),
        )
        .withColumn("change_pct", change_pct(F.col("current"), F.col("previous")))
    )


def peak_reading(df: DataFrame, ts: str = TS) -> DataFrame:
    """Largest cost, when it fell and on which weekday; the earliest reading wins a tie."""
    first = F.min(F.when(F.col(COST).isNotNull(), F.struct(-F.col(COST), ts, READING_ID)))
    return (
        df.agg(first.alias("_peak"))
        .select(
            (-F.col("_peak").getField("col1")).alias("peak_cost_krw"),
            F.col(f"_peak.{ts}").alias("peak_ts"),
            F.col(f"_peak.{READING_ID}").alias("peak_reading_id"),
        )
        .withColumn("peak_weekday", F.date_format("peak_ts", "EEEE"))
    )


def carbon_stats(df: DataFrame) -> DataFrame:
    return df.agg(F.avg(CARBON).alias("mean_tco2"), F.sum(CARBON).alias("total_tco2"))


def main_work_type(df: DataFrame) -> DataFrame:
    """The most frequent work type, its share and count; the first by name wins a tie."""
    counts = work_type_counts(df.filter(F.col(WORK_TYPE).isNotNull()))
    best = F.min(F.struct(-F.col("readings"), WORK_TYPE))
    return counts.agg(best.alias("_best"), F.sum("readings").alias("_all")).select(
        F.col(f"_best.{WORK_TYPE}").alias("main_work_type"),
        (-F.col("_best").getField("col1") / F.col("_all") * 100).alias("share_pct"),
        (-F.col("_best").getField("col1")).alias("readings"),
    )


def night_share(df: DataFrame, ts: str = TS) -> DataFrame:
    return df.agg(F.avg(night_share_flag(ts)).alias("night_share"))


def anomaly_flag(df: DataFrame, month: str, summary: DataFrame | None = None) -> DataFrame:
    """Whether the month stands out: large changes, an odd night share or an odd peak hour."""
    chosen = in_month(df, month)
    totals = monthly_rollup(_two_months(df, month)) if summary is None else summary
    cards = month_cards(totals, month, (USAGE, COST))
    changes = cards.agg(
        F.max(F.when(F.col("measure") == USAGE, F.col("change_pct"))).alias("usage_change_pct"),
        F.max(F.when(F.col("measure") == COST, F.col("change_pct"))).alias("cost_change_pct"),
    )
    facts = side_by_side(changes, night_share(chosen), peak_reading(chosen).select("peak_ts"))
    share, hour = F.col("night_share"), F.hour("peak_ts")
    return facts.withColumn(
        "is_anomaly",
        (F.abs("usage_change_pct") > 15)
        | (F.abs("cost_change_pct") > 20)
        | (share > 0.6)
        | (share < 0.2)
        | ~(hour.between(8, 10) | hour.between(18, 21)),
    )


def group_mean(df: DataFrame, key: str | Sequence[str], target: str, name: str) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.avg(target).alias(name))


def period_bounds(df: DataFrame, ts: str = TS, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def report_row(df: DataFrame, month: str) -> DataFrame:
    """All figures of the monthly report in one row."""
    chosen = in_month(df, month)
    facts = chosen.agg(
        F.sum(COST).alias("total_cost_krw"),
        F.sum(USAGE).alias("current_usage_kwh"),
        F.to_date(F.min(TS)).alias("period_start"),
        F.to_date(F.max(TS)).alias("period_end"),
        F.avg(CARBON).alias("mean_carbon_tco2"),
    ).withColumn("billing_month", F.date_format(_first_of(month), "MM"))
    before = previous_month(df, month).agg(
        _total(F.col(USAGE)).alias("previous_usage_kwh"),
        _total(F.col(COST)).alias("previous_cost_krw"),
    ).withColumn("previous_month", F.date_format(_first_of(month, -1), "MM"))
    return side_by_side(
        facts,
        before,
        main_work_type(chosen).select("main_work_type"),
        peak_reading(chosen).select("peak_cost_krw", "peak_ts"),
        change_vs_30d(df, month).select(F.col("change_pct").alias("cost_change_30d_pct")),
    )


def report_texts(row: DataFrame) -> DataFrame:
    """The row of `report_row` as the texts a printed report shows."""
    won, kwh = "%,.0f 원", "%,.1f kWh"
    day = "yyyy-MM-dd"
    return row.select(
        "billing_month",
        F.format_string(won, "total_cost_krw").alias("total_cost"),
        F.concat(F.date_format("period_start", day), F.lit(" ~ "), F.date_format("period_end", day)).alias(
            "usage_period"
        ),
        "main_work_type",
        "previous_month",
        F.format_string(kwh, "current_usage_kwh").alias("current_usage"),
        F.format_string(kwh, "previous_usage_kwh").alias("previous_usage"),
        F.format_string("₩%,.0f", "previous_cost_krw").alias("previous_total_cost"),
        F.format_string(
            "₩%,.0f (발생일시: %s)", "peak_cost_krw", F.date_format("peak_ts", "yyyy-MM-dd HH:mm")
        ).alias("peak_cost_info"),
        F.format_string("%.3f tCO₂", "mean_carbon_tco2").alias("avg_carbon_info"),
        F.format_string("%+.1f%%", "cost_change_30d_pct").alias("monthly_change_info"),
    )
