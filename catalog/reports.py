"""The monthly report."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import MONTH, rd, readings, rounded, rounded_all, snap, snapped, table, with_readings
from catalog.pricing import _WEEKDAY_SQL
from catalog.registry import query
from gridtally.operators import report
from gridtally.operators.encoding import describe
from gridtally.operators.filters import in_month

THIS, BEFORE = "DATE '2024-05-01'", "DATE '2024-04-01'"
_MONTH = "CAST(date_trunc('month', ts) AS DATE)"


def _chosen(spark, sf_dir):
    return in_month(readings(spark, sf_dir), MONTH)


_BASELINE = ", ".join(
    f"{rd(f'(SELECT avg(v) FROM (SELECT sum({c}) AS v FROM nov GROUP BY CAST(ts AS DATE)))', 5)} AS {n}_daily, "
    f"{rd(f'''(SELECT avg(v) FROM (SELECT sum({c}) AS v FROM nov GROUP BY date_trunc('week', ts)))''', 5)} AS {n}_weekly, "
    f"{rd(f'(SELECT sum({c}) FROM nov)', 5)} AS {n}_monthly"
    for n, c in (("usage", "usage_kwh"), ("cost", "cost_krw"))
)
NOVEMBER = "nov AS (SELECT * FROM readings WHERE date_trunc('month', ts) = DATE '2024-11-01')"


@query("baseline", with_readings(f"SELECT {_BASELINE}", NOVEMBER))
def baseline(spark, sf_dir):
    return rounded_all(report.baseline(readings(spark, sf_dir), "2024-11"), 5)


@query(
    "baseline_per_meter",
    with_readings(
        "SELECT meter_id, "
        + ", ".join(
            f"round(avg(day_{n}), 5) AS {n}_daily, round(sum(day_{n}) / count(DISTINCT week), 5) AS {n}_weekly, "
            f"round(sum(day_{n}), 5) AS {n}_monthly"
            for n in ("usage", "cost")
        )
        + " FROM (SELECT meter_id, date_trunc('week', ts) AS week, CAST(ts AS DATE) AS d, "
        "sum(usage_kwh) AS day_usage, sum(cost_krw) AS day_cost FROM nov GROUP BY ALL) GROUP BY 1",
        NOVEMBER,
    ),
)
def baseline_per_meter(spark, sf_dir):
    return rounded_all(report.baseline(readings(spark, sf_dir), "2024-11", by=["meter_id"]), 5)


@query(
    "work_type_counts",
    with_readings("SELECT work_type, count(*) AS readings FROM readings GROUP BY 1"),
)
def work_type_counts(spark, sf_dir):
    return report.work_type_counts(readings(spark, sf_dir))


HOURLY_SHARE_SQL = (
    "SELECT CAST(hour(ts) AS INTEGER) AS hour, work_type, count(*) AS readings, "
    "round(count(*) / sum(count(*)) OVER (PARTITION BY hour(ts)), 8) AS share FROM readings "
    "GROUP BY hour(ts), work_type"
)


@query("hourly_work_type_share", with_readings(HOURLY_SHARE_SQL))
def hourly_work_type_share(spark, sf_dir):
    return rounded(report.hourly_work_type_share(readings(spark, sf_dir)), 8, "share")


_TREND = {
    "hour": "strftime(ts, '%m/%d %H:00') AS label",
    "day": "strftime(ts, '%m/%d') AS label",
    "weekday": f"CAST(isodow(ts) - 1 AS INTEGER) AS weekday, {_WEEKDAY_SQL} AS label",
}


def _trend_sql(unit):
    return (
        f"SELECT {_TREND[unit]}, round(sum(cost_krw), 5) AS total, {snap('avg(cost_krw)', 6)} AS average, "
        "count(*) AS readings FROM chosen GROUP BY ALL"
    )


def _trend(unit):
    def run(spark, sf_dir):
        trend = report.cost_trend(_chosen(spark, sf_dir), unit)
        return snapped(rounded(report.in_label_order(trend), 5, "total"), 6, "average")

    return run


for _unit in _TREND:
    query(f"cost_trend_{_unit}", with_readings(_trend_sql(_unit)))(_trend(_unit))


@query(
    "trend_stats",
    with_readings(
        "SELECT round(sum(total), 5) AS total, round(avg(average), 6) AS average, "
        "round(max(total), 5) AS largest, CAST(sum(n) AS BIGINT) AS readings FROM "
        "(SELECT sum(cost_krw) AS total, avg(cost_krw) AS average, count(*) AS n FROM chosen "
        "GROUP BY CAST(ts AS DATE))"
    ),
)
def trend_stats(spark, sf_dir):
    stats = report.trend_stats(report.cost_trend(_chosen(spark, sf_dir), "day"))
    return rounded(rounded(stats, 5, "total", "largest"), 6, "average")


@query(
    "daily_sales_trend",
    "SELECT strftime(l_shipdate, '%m/%d') AS label, round(sum(l_extendedprice), 2) AS total, "
    f"{snap('avg(l_extendedprice)', 6)} AS average, count(*) AS readings FROM lineitem GROUP BY 1",
)
def daily_sales_trend(spark, sf_dir):
    trend = report.cost_trend(
        table(spark, sf_dir, "lineitem"), "day", ts="l_shipdate", cost="l_extendedprice"
    )
    return snapped(rounded(trend, 2, "total"), 6, "average")


_YEAR = "year AS (SELECT * FROM readings WHERE ts >= (SELECT max(ts) FROM readings) - INTERVAL 1 YEAR)"


@query(
    "monthly_usage_cost",
    with_readings(
        f"SELECT {_MONTH} AS month, round(sum(usage_kwh), 5) AS usage_kwh, "
        f"{snap('avg(cost_krw)', 6)} AS mean_cost_krw, {_MONTH} = DATE '2025-03-01' AS selected "
        "FROM year GROUP BY 1, 4",
        _YEAR,
    ),
)
def monthly_usage_cost(spark, sf_dir):
    monthly = report.monthly_usage_cost(readings(spark, sf_dir))
    marked = report.mark_selected(monthly, "2025-03")
    return snapped(rounded(marked, 5, "usage_kwh"), 6, "mean_cost_krw")


def _compare_sql(col):
    total = f"coalesce((SELECT sum({col}) FROM readings WHERE {_MONTH} = {{}}), 0)"
    spine = (
        "SELECT unnest(generate_series((SELECT date_trunc('month', min(ts)) FROM year), "
        "(SELECT date_trunc('month', max(ts)) FROM year), INTERVAL 1 MONTH)) AS m"
    )
    mean = (
        f"(SELECT avg(coalesce(v, 0)) FROM ({spine}) LEFT JOIN "
        f"(SELECT date_trunc('month', ts) AS m, sum({col}) AS v FROM year GROUP BY 1) USING (m))"
    )
    return with_readings(
        f"SELECT round(previous, 5) AS previous, round(selected, 5) AS selected, "
        f"round(yearly_mean, 5) AS yearly_mean, round((selected - previous) / previous * 100, 6) AS change_pct "
        f"FROM (SELECT {total.format(BEFORE)} AS previous, {total.format(THIS)} AS selected, "
        f"{mean} AS yearly_mean)",
        _YEAR,
    )


@query("compare_months_usage", _compare_sql("usage_kwh"))
def compare_months_usage(spark, sf_dir):
    df = report.compare_months(readings(spark, sf_dir), MONTH, "usage_kwh")
    return rounded(rounded(df, 5, "previous", "selected", "yearly_mean"), 6, "change_pct")


@query("compare_months_cost", _compare_sql("cost_krw"))
def compare_months_cost(spark, sf_dir):
    df = report.compare_months(readings(spark, sf_dir), MONTH, "cost_krw")
    return rounded(rounded(df, 5, "previous", "selected", "yearly_mean"), 6, "change_pct")


@query(
    "monthly_rollup",
    with_readings(
        f"SELECT meter_id, {_MONTH} AS month, round(sum(usage_kwh), 5) AS usage_kwh, "
        "round(sum(cost_krw), 5) AS cost_krw, round(sum(carbon_tco2), 6) AS carbon_tco2 "
        "FROM readings GROUP BY ALL"
    ),
)
def monthly_rollup(spark, sf_dir):
    df = report.monthly_rollup(readings(spark, sf_dir), by=["meter_id"])
    return rounded(rounded(df, 5, "usage_kwh", "cost_krw"), 6, "carbon_tco2")


def _summary(spark, sf_dir):
    """Monthly totals with a fee column, as the shipped summary has one."""
    return report.monthly_rollup(readings(spark, sf_dir)).withColumn(
        "power_factor_fee", F.col("cost_krw") * 0.01
    )


_SUMMARY = (
    f"summary AS (SELECT {_MONTH} AS month, sum(usage_kwh) AS usage_kwh, sum(cost_krw) AS cost_krw, "
    "sum(carbon_tco2) AS carbon_tco2, sum(cost_krw) * CAST(0.01 AS DOUBLE) AS power_factor_fee "
    "FROM readings GROUP BY 1)"
)


@query(
    "month_cards",
    with_readings(
        " UNION ALL ".join(
            f"SELECT '{m}' AS measure, round(value, 5) AS value, round(previous, 5) AS previous, "
            "round((value - previous) / previous * 100, 6) AS change_pct FROM "
            f"(SELECT (SELECT {m} FROM summary WHERE month = {THIS}) AS value, "
            f"(SELECT {m} FROM summary WHERE month = {BEFORE}) AS previous)"
            for m in report.CARD_MEASURES
        ),
        _SUMMARY,
    ),
)
def month_cards(spark, sf_dir):
    cards = report.month_cards(_summary(spark, sf_dir), MONTH)
    return rounded(rounded(cards, 5, "value", "previous"), 6, "change_pct")


@query(
    "month_cards_first_month",
    with_readings(
        " UNION ALL ".join(
            f"SELECT '{m}' AS measure, round({m}, 5) AS value, CAST(0 AS DOUBLE) AS previous, "
            "CAST(0 AS DOUBLE) AS change_pct FROM summary WHERE month = (SELECT min(month) FROM summary)"
            for m in report.CARD_MEASURES
        ),
        _SUMMARY,
    ),
)
def month_cards_first_month(spark, sf_dir):
    cards = report.month_cards(_summary(spark, sf_dir), "2019-01")
    return rounded(rounded(cards, 5, "value", "previous"), 6, "change_pct")


def _sum(col, month):
    return f"(SELECT sum({col}) FROM readings WHERE {_MONTH} = {month})"


def _rate(col):
    return f"({_sum(col, THIS)} - {_sum(col, BEFORE)}) / {_sum(col, BEFORE)} * 100"


@query(
    "monthly_change",
    with_readings(
        f"SELECT round({_rate('usage_kwh')}, 6) AS usage_change_pct, "
        f"round({_rate('cost_krw')}, 6) AS cost_change_pct"
    ),
)
def monthly_change(spark, sf_dir):
    return rounded_all(report.monthly_change(readings(spark, sf_dir), MONTH), 6)


_30D = (
    "thirty AS (SELECT (SELECT sum(cost_krw) FROM chosen) AS current, "
    "(SELECT sum(cost_krw) FROM readings WHERE ts < (SELECT min(ts) FROM chosen) "
    "AND ts >= (SELECT min(ts) FROM chosen) - INTERVAL 30 DAY) AS previous)"
)


@query(
    "change_vs_30d",
    with_readings(
        "SELECT round(current, 5) AS current, round(previous, 5) AS previous, "
        "round((current - previous) / previous * 100, 6) AS change_pct FROM thirty",
        _30D,
    ),
)
def change_vs_30d(spark, sf_dir):
    df = report.change_vs_30d(readings(spark, sf_dir), MONTH)
    return rounded(rounded(df, 5, "current", "previous"), 6, "change_pct")


_PEAK = (
    "peak AS (SELECT cost_krw AS peak_cost_krw, ts AS peak_ts, reading_id AS peak_reading_id, "
    "strftime(ts, '%A') AS peak_weekday FROM chosen ORDER BY cost_krw DESC, ts, reading_id LIMIT 1)"
)


@query("peak_reading", with_readings("SELECT * FROM peak", _PEAK))
def peak_reading(spark, sf_dir):
    return report.peak_reading(_chosen(spark, sf_dir))


@query(
    "carbon_stats",
    with_readings(
        "SELECT round(avg(carbon_tco2), 9) AS mean_tco2, round(sum(carbon_tco2), 7) AS total_tco2 FROM chosen"
    ),
)
def carbon_stats(spark, sf_dir):
    stats = report.carbon_stats(_chosen(spark, sf_dir))
    return rounded(rounded(stats, 9, "mean_tco2"), 7, "total_tco2")


_MAIN = (
    "main AS (SELECT work_type AS main_work_type, count(*) AS readings, "
    "count(*) / (SELECT count(*) FROM chosen) * 100 AS share_pct FROM chosen GROUP BY 1 "
    "ORDER BY readings DESC, main_work_type LIMIT 1)"
)


@query(
    "main_work_type",
    with_readings("SELECT main_work_type, readings, round(share_pct, 6) AS share_pct FROM main", _MAIN),
)
def main_work_type(spark, sf_dir):
    return rounded(report.main_work_type(_chosen(spark, sf_dir)), 6, "share_pct")


_NIGHT = "(SELECT avg(CASE WHEN hour(ts) >= 20 OR hour(ts) < 6 THEN 1 ELSE 0 END) FROM chosen)"


@query("night_share", with_readings(f"SELECT round({_NIGHT}, 9) AS night_share"))
def night_share(spark, sf_dir):
    return rounded(report.night_share(_chosen(spark, sf_dir)), 9, "night_share")


_ANOMALY = with_readings(
    "SELECT round(u, 6) AS usage_change_pct, round(c, 6) AS cost_change_pct, "
    "round(n, 9) AS night_share, peak_ts, (abs(u) > 15 OR abs(c) > 20 OR n > 0.6 OR n < 0.2 "
    "OR NOT (hour(peak_ts) BETWEEN 8 AND 10 OR hour(peak_ts) BETWEEN 18 AND 21)) AS is_anomaly "
    f"FROM (SELECT {_rate('usage_kwh')} AS u, {_rate('cost_krw')} AS c, {_NIGHT} AS n, "
    "(SELECT peak_ts FROM peak) AS peak_ts)",
    _PEAK,
)


@query("anomaly_flag", _ANOMALY)
def anomaly_flag(spark, sf_dir):
    df = report.anomaly_flag(readings(spark, sf_dir), MONTH)
    return rounded(rounded(df, 6, "usage_change_pct", "cost_change_pct"), 9, "night_share")


@query("anomaly_flag_from_summary", _ANOMALY)
def anomaly_flag_from_summary(spark, sf_dir):
    df = report.anomaly_flag(readings(spark, sf_dir), MONTH, _summary(spark, sf_dir))
    return rounded(rounded(df, 6, "usage_change_pct", "cost_change_pct"), 9, "night_share")


_DESCRIBED = ("usage_kwh", "carbon_tco2", "cost_krw")


@query(
    "describe",
    with_readings(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean, "
            f"round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, "
            f"round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, "
            f"round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max FROM readings"
            for c in _DESCRIBED
        )
    ),
)
def describe_query(spark, sf_dir):
    return rounded_all(describe(readings(spark, sf_dir), _DESCRIBED), 6)


def _one_decimal(value):
    tenths = f"CAST(round({value} * 10) AS BIGINT)"
    return f"format('{{:,}}', {tenths} // 10) || '.' || ({tenths} % 10)"


@query(
    "report_row",
    with_readings(
        "SELECT '05' AS billing_month, round((SELECT sum(cost_krw) FROM chosen), 5) AS total_cost_krw, "
        "round((SELECT sum(usage_kwh) FROM chosen), 5) AS current_usage_kwh, "
        "(SELECT CAST(min(ts) AS DATE) FROM chosen) AS period_start, "
        "(SELECT CAST(max(ts) AS DATE) FROM chosen) AS period_end, "
        "round((SELECT avg(carbon_tco2) FROM chosen), 9) AS mean_carbon_tco2, '04' AS previous_month, "
        f"round({_sum('usage_kwh', BEFORE)}, 5) AS previous_usage_kwh, "
        f"round({_sum('cost_krw', BEFORE)}, 5) AS previous_cost_krw, "
        "(SELECT main_work_type FROM main) AS main_work_type, "
        "round((SELECT peak_cost_krw FROM peak), 5) AS peak_cost_krw, (SELECT peak_ts FROM peak) AS peak_ts, "
        "round((SELECT (current - previous) / previous * 100 FROM thirty), 6) AS cost_change_30d_pct",
        _30D,
        _PEAK,
        _MAIN,
    ),
)
def report_row(spark, sf_dir):
    df = report.report_row(readings(spark, sf_dir), MONTH)
    sums = [c for c in df.columns if c.endswith(("cost_krw", "usage_kwh"))]
    return rounded(rounded(rounded(df, 5, *sums), 9, "mean_carbon_tco2"), 6, "cost_change_30d_pct")


@query(
    "report_texts",
    with_readings(
        "SELECT '05' AS billing_month, format('{:,}', CAST(round(sum(cost_krw)) AS BIGINT)) || ' 원' AS total_cost, "
        "strftime(min(ts), '%Y-%m-%d') || ' ~ ' || strftime(max(ts), '%Y-%m-%d') AS usage_period, "
        "(SELECT main_work_type FROM main) AS main_work_type, '04' AS previous_month, "
        f"{_one_decimal('sum(usage_kwh)')} || ' kWh' AS current_usage, "
        f"{_one_decimal(_sum('usage_kwh', BEFORE))} || ' kWh' AS previous_usage, "
        f"'₩' || format('{{:,}}', CAST(round({_sum('cost_krw', BEFORE)}) AS BIGINT)) AS previous_total_cost, "
        "(SELECT '₩' || format('{:,}', CAST(round(peak_cost_krw) AS BIGINT)) || ' (발생일시: ' || "
        "strftime(peak_ts, '%Y-%m-%d %H:%M') || ')' FROM peak) AS peak_cost_info, "
        "printf('%.3f', avg(carbon_tco2)) || ' tCO₂' AS avg_carbon_info, "
        "(SELECT printf('%+.1f', (current - previous) / previous * 100) || '%' FROM thirty) AS monthly_change_info "
        "FROM chosen",
        _30D,
        _PEAK,
        _MAIN,
    ),
)
def report_texts(spark, sf_dir):
    return report.report_texts(report.report_row(readings(spark, sf_dir), MONTH))


@query(
    "group_mean",
    with_readings(
        "SELECT work_type, round(avg(cost_krw), 5) AS mean_cost_krw FROM readings GROUP BY 1"
    ),
)
def group_mean(spark, sf_dir):
    means = report.group_mean(readings(spark, sf_dir), "work_type", "cost_krw", "mean_cost_krw")
    return rounded(means, 5, "mean_cost_krw")


@query(
    "period_bounds",
    with_readings(
        "SELECT meter_id, min(ts) AS first_ts, max(ts) AS last_ts FROM readings GROUP BY 1"
    ),
)
def period_bounds(spark, sf_dir):
    return report.period_bounds(readings(spark, sf_dir), by=["meter_id"])
