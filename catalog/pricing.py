"""Calendar columns, tariff columns and prices."""

from __future__ import annotations

from catalog.inputs import (
    BAND_SQL,
    ERA_SQL,
    MONTH,
    RATES_SQL,
    SEASON_SQL,
    rd,
    readings,
    rounded,
    rounded_all,
    with_readings,
)
from catalog.registry import query
from gridtally.functions import calendar, tariff
from gridtally.operators import pricing
from gridtally.operators.filters import in_month


def _of_rows(spark, sf_dir, cols):
    return readings(spark, sf_dir).select("reading_id", *[v.alias(n) for n, v in cols.items()])


def _int(**named):
    return ", ".join(f"CAST({v} AS INTEGER) AS {n}" for n, v in named.items())


_PARTS = {
    "year": "year(ts)",
    "month": "month(ts)",
    "day": "day(ts)",
    "hour": "hour(ts)",
    "minute": "minute(ts)",
    "weekday": "isodow(ts) - 1",
}


@query(
    "calendar_parts",
    with_readings(
        f"SELECT reading_id, {_int(**_PARTS, weekend='isodow(ts) > 5')} FROM readings"
    ),
)
def calendar_parts(spark, sf_dir):
    return _of_rows(spark, sf_dir, {**calendar.calendar_parts(), "weekend": calendar.is_weekend()})


def _cycle(part, period):
    angle = f"2 * pi() * ({_PARTS[part]}) / {period}"
    return f"{rd(f'sin({angle})', 6)} AS sin_{part}, {rd(f'cos({angle})', 6)} AS cos_{part}"


@query(
    "cyclic_parts",
    with_readings(
        "SELECT reading_id, "
        + ", ".join(_cycle(p, n) for p, n in (("hour", 24), ("minute", 60), ("month", 12), ("day", 31), ("weekday", 7)))
        + " FROM readings"
    ),
)
def cyclic_parts(spark, sf_dir):
    return rounded_all(_of_rows(spark, sf_dir, calendar.cyclic_parts()), 6)


_STEP = "(hour(ts) * 4 + minute(ts) // 15)"


@query(
    "quarter_hour_step",
    with_readings(
        f"SELECT reading_id, CAST({_STEP} AS INTEGER) AS time_step, "
        f"{rd(f'sin(2 * pi() * {_STEP} / 96)', 6)} AS sin_time_step, "
        f"{rd(f'cos(2 * pi() * {_STEP} / 96)', 6)} AS cos_time_step FROM readings"
    ),
)
def quarter_hour_step(spark, sf_dir):
    sin, cos = calendar.quarter_hour_cycle()
    step = calendar.quarter_hour_step()
    cols = {"time_step": step, "sin_time_step": sin, "cos_time_step": cos}
    return rounded_all(_of_rows(spark, sf_dir, cols), 6)


@query(
    "calendar_flags",
    with_readings(
        "SELECT reading_id, "
        + _int(
            month_start="day(ts) <= 5",
            month_end="day(ts) >= 25",
            peak_time="hour(ts) >= 8 AND hour(ts) <= 22",
            night_time="hour(ts) >= 22 OR hour(ts) <= 6",
            report_night="hour(ts) >= 20 OR hour(ts) < 6",
            quarter="(month(ts) - 1) // 3",
        )
        + " FROM readings"
    ),
)
def calendar_flags(spark, sf_dir):
    cols = {
        **calendar.month_edges(),
        **calendar.peak_night_flags(),
        "report_night": calendar.night_share_flag(),
        "quarter": calendar.quarter_index(),
    }
    return _of_rows(spark, sf_dir, cols)


@query(
    "day_period",
    with_readings(
        "SELECT reading_id, CASE WHEN hour(ts) BETWEEN 6 AND 8 THEN '출근시간' "
        "WHEN hour(ts) BETWEEN 9 AND 11 THEN '오전업무' WHEN hour(ts) BETWEEN 12 AND 13 THEN '점심시간' "
        "WHEN hour(ts) BETWEEN 14 AND 17 THEN '오후업무' WHEN hour(ts) BETWEEN 18 AND 20 THEN '퇴근시간' "
        "WHEN hour(ts) BETWEEN 21 AND 23 THEN '저녁시간' ELSE '야간시간' END AS day_period FROM readings"
    ),
)
def day_period(spark, sf_dir):
    return _of_rows(spark, sf_dir, {"day_period": calendar.day_period()})


_WEEKDAY_SQL = (
    "['월요일', '화요일', '수요일', '목요일', '금요일', '토요일', '일요일'][isodow(ts)]"
)


@query(
    "time_labels",
    with_readings(
        "SELECT reading_id, strftime(ts, '%m/%d %H:00') AS hour_label, strftime(ts, '%m/%d') AS day_label, "
        f"{_WEEKDAY_SQL} AS weekday_label FROM readings"
    ),
)
def time_labels(spark, sf_dir):
    units = ("hour", "day", "weekday")
    return _of_rows(spark, sf_dir, {f"{u}_label": calendar.time_label(u) for u in units})


_BANDED = f"banded AS (SELECT *, {SEASON_SQL} AS season, {BAND_SQL} AS band, {ERA_SQL} AS era FROM readings)"
_PRICED = (
    "priced AS (SELECT b.*, r.price AS unit_price FROM banded b LEFT JOIN rates r "
    "ON r.plan = '고압A_선택3' AND r.era = b.era AND r.season = b.season AND r.band = b.band)"
)


@query(
    "tariff_columns",
    with_readings("SELECT reading_id, season, band, era FROM banded", _BANDED),
)
def tariff_columns(spark, sf_dir):
    cols = {"season": tariff.season(), "band": tariff.load_band(), "era": tariff.rate_era()}
    return _of_rows(spark, sf_dir, cols)


@query(
    "unit_price",
    with_readings(
        "SELECT reading_id, season, band, era, unit_price FROM priced", RATES_SQL, _BANDED, _PRICED
    ),
)
def unit_price(spark, sf_dir):
    return pricing.unit_price(readings(spark, sf_dir)).select(
        "reading_id", "season", "band", "era", "unit_price"
    )


@query(
    "cost_by_band",
    with_readings(
        "SELECT CAST(date_trunc('month', ts) AS DATE) AS month, season, band, count(*) AS readings, "
        "round(sum(usage_kwh), 5) AS usage_kwh, round(sum(cost_krw), 5) AS cost_krw, "
        "round(sum(usage_kwh * unit_price), 6) AS priced_krw FROM priced GROUP BY ALL",
        RATES_SQL,
        _BANDED,
        _PRICED,
    ),
)
def cost_by_band(spark, sf_dir):
    df = rounded(pricing.cost_by_band(readings(spark, sf_dir)), 5, "usage_kwh", "cost_krw")
    return rounded(df, 6, "priced_krw")


_ALL_PLANS = (
    "compared AS (SELECT b.reading_id, b.ts, b.era AS applied, r.rank, r.plan, r.era, r.season, r.band, "
    "r.price, b.usage_kwh * r.price AS priced_krw, abs(b.cost_krw - b.usage_kwh * r.price) AS difference_krw "
    "FROM banded b JOIN rates r ON r.season = b.season AND r.band = b.band)"
)
_NEAREST = (
    "nearest AS (SELECT reading_id, applied, plan || '_' || era AS nearest_plan, "
    "difference_krw AS nearest_difference FROM compared "
    "QUALIFY row_number() OVER (PARTITION BY reading_id ORDER BY difference_krw, rank) = 1)"
)


@query(
    "price_plans",
    with_readings(
        "SELECT reading_id, CAST(rank AS INTEGER) AS rank, plan, era, priced_krw, difference_krw FROM compared",
        RATES_SQL,
        _BANDED,
        _ALL_PLANS,
    ),
)
def price_plans(spark, sf_dir):
    return pricing.price_plans(readings(spark, sf_dir)).select(
        "reading_id", "rank", "plan", "era", "priced_krw", "difference_krw"
    )


@query(
    "nearest_plan",
    with_readings(
        "SELECT reading_id, nearest_plan, nearest_difference FROM nearest",
        RATES_SQL,
        _BANDED,
        _ALL_PLANS,
        _NEAREST,
    ),
)
def nearest_plan(spark, sf_dir):
    return pricing.nearest_plan(readings(spark, sf_dir)).select(
        "reading_id", "nearest_plan", "nearest_difference"
    )


_PLANS = (
    "고압A_선택1", "고압A_선택2", "고압A_선택3", "고압B_선택1", "고압B_선택2", "고압B_선택3",
    "고압C_선택1", "고압C_선택2", "고압C_선택3",
)
_LABELS = [f"{plan}_{era}" for plan in _PLANS for era in ("before", "after")]


@query(
    "unit_price_of_another_tariff",
    with_readings(
        f"SELECT reading_id, CASE WHEN ({BAND_SQL}) = '최대부하' THEN CAST(30 AS DOUBLE) "
        f"WHEN ({BAND_SQL}) = '중간부하' THEN CAST(20 AS DOUBLE) ELSE CAST(10 AS DOUBLE) END "
        f"+ CASE WHEN ({ERA_SQL}) = 'after' THEN 1 ELSE 0 END AS unit_price FROM readings"
    ),
)
def unit_price_of_another_tariff(spark, sf_dir):
    seasons = (tariff.SUMMER, tariff.MID_SEASON, tariff.WINTER)
    flat = [("flat", tariff.BEFORE, s, 10.0, 20.0, 30.0) for s in seasons]
    flat += [("flat", tariff.AFTER, s, 11.0, 21.0, 31.0) for s in seasons]
    return pricing.unit_price(readings(spark, sf_dir), "flat", tariff=flat).select("reading_id", "unit_price")


@query(
    "plan_distribution",
    with_readings(
        "SELECT applied, "
        + ", ".join(f"count(*) FILTER (nearest_plan = '{p}') AS \"{p}\"" for p in _LABELS)
        + " FROM nearest GROUP BY 1",
        RATES_SQL,
        _BANDED,
        _ALL_PLANS,
        _NEAREST,
    ),
)
def plan_distribution(spark, sf_dir):
    return pricing.plan_distribution(readings(spark, sf_dir))


@query(
    "month_cost_by_band",
    with_readings(
        "SELECT CAST(date_trunc('month', ts) AS DATE) AS month, season, band, count(*) AS readings, "
        "round(sum(usage_kwh), 5) AS usage_kwh, round(sum(cost_krw), 5) AS cost_krw, "
        "round(sum(usage_kwh * unit_price), 6) AS priced_krw FROM priced "
        "WHERE date_trunc('month', ts) = DATE '2024-05-01' GROUP BY ALL",
        RATES_SQL,
        _BANDED,
        _PRICED,
    ),
)
def month_cost_by_band(spark, sf_dir):
    df = pricing.cost_by_band(in_month(readings(spark, sf_dir), MONTH))
    return rounded(rounded(df, 5, "usage_kwh", "cost_krw"), 6, "priced_krw")
