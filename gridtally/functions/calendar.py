"""Calendar columns of a reading time."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels of the seven parts of a day, in clock order from 06:00.
DAY_PERIODS = ("출근시간", "오전업무", "점심시간", "오후업무", "퇴근시간", "저녁시간", "야간시간")
# Weekday names, Monday first.
WEEKDAYS = ("월요일", "화요일", "수요일", "목요일", "금요일", "토요일", "일요일")

# Length of each cycle.
CYCLES = {"hour": 24, "minute": 60, "month": 12, "day": 31, "weekday": 7}


def flag(condition: Column) -> Column:
    return condition.cast("int")


def calendar_parts(ts: str = "ts") -> dict[str, Column]:
    """Year, month, day, hour, minute and weekday (Monday is 0)."""
    c = F.col(ts)
    return {
        "year": F.year(c),
        "month": F.month(c),
        "day": F.dayofmonth(c),
        "hour": F.hour(c),
        "minute": F.minute(c),
        "weekday": F.weekday(c),
    }


def is_weekend(ts: str = "ts") -> Column:
    return flag(F.weekday(ts) >= 5)


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a value that repeats every `period`."""
    angle = F.lit(2 * math.pi) * value / F.lit(period)
    return F.sin(angle), F.cos(angle)


def cyclic_parts(ts: str = "ts", parts: tuple[str, ...] = tuple(CYCLES)) -> dict[str, Column]:
    values = calendar_parts(ts)
    out = {}
    for part in parts:
        out[f"sin_{part}"], out[f"cos_{part}"] = cyclic(values[part], CYCLES[part])
    return out


def quarter_hour_step(ts: str = "ts") -> Column:
    """Number of the 15-minute slot in the day, 0 to 95."""
    return F.hour(ts) * 4 + F.floor(F.minute(ts) / 15).cast("int")


def quarter_hour_cycle(ts: str = "ts") -> tuple[Column, Column]:
    return cyclic(quarter_hour_step(ts), 96)


def month_edges(ts: str = "ts") -> dict[str, Column]:
    day = F.dayofmonth(ts)
    return {"month_start": flag(day <= 5), "month_end": flag(day >= 25)}


def peak_night_flags(ts: str = "ts") -> dict[str, Column]:
    """Feature flags; this night (22 to 6, both included) is not the night of `night_share_flag`."""
    hour = F.hour(ts)
    return {
        "peak_time": flag(hour.between(8, 22)),
        "night_time": flag((hour >= 22) | (hour <= 6)),
    }


def night_share_flag(ts: str = "ts") -> Column:
    """The report's night: 20:00 up to, but not including, 06:00."""
    hour = F.hour(ts)
    return flag((hour >= 20) | (hour < 6))


def day_period(ts: str = "ts") -> Column:
    morning, forenoon, lunch, afternoon, evening, late, night = DAY_PERIODS
    hour = F.hour(ts)
    return (
        F.when(hour < 6, night)
        .when(hour < 9, morning)
        .when(hour < 12, forenoon)
        .when(hour < 14, lunch)
        .when(hour < 18, afternoon)
        .when(hour < 21, evening)
        .otherwise(late)
    )


def quarter_index(ts: str = "ts") -> Column:
    return F.quarter(ts) - 1


def month_of(ts: str = "ts") -> Column:
    """First day of the month."""
    return F.trunc(ts, "month")


def week_of(ts: str = "ts") -> Column:
    """Monday of the week."""
    return F.trunc(ts, "week")


def weekday_name(ts: str = "ts") -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), F.weekday(ts) + 1)


def time_label(unit: str, ts: str = "ts") -> Column:
    """Chart label of a reading: its hour, its day or the name of its weekday."""
    if unit == "hour":
        return F.date_format(ts, "MM/dd HH:00")
    if unit == "day":
        return F.date_format(ts, "MM/dd")
    if unit == "weekday":
        return weekday_name(ts)
    raise ValueError(f"unit must be hour, day or weekday, not {unit!r}")
