"""Calendar and duration expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gritmill.functions.columns import col

# Sunday and Saturday in Spark's day-of-week numbering, and the rush-hour windows.
WEEKEND_DAYS = (1, 7)
RUSH_HOURS = ((7, 9), (17, 19))


def parse_timestamp(name: str, pattern: str) -> Column:
    """Null instead of an error for text that does not follow the pattern."""
    return F.try_to_timestamp(col(name), F.lit(pattern))


def calendar_parts(name: str) -> dict[str, Column]:
    moment = col(name)
    weekday = F.dayofweek(moment)
    return {
        f"{name}_Year": F.year(moment),
        f"{name}_Month": F.month(moment),
        f"{name}_Day_of_Week": weekday,
        f"{name}_Hour": F.hour(moment),
        f"{name}_is_Weekend": F.coalesce(weekday.isin(*WEEKEND_DAYS), F.lit(False)).cast("int"),
    }


def seconds_between(start: str, end: str) -> Column:
    return F.unix_timestamp(col(end)) - F.unix_timestamp(col(start))


def durations(start: str, end: str, prefix: str = "Duration") -> dict[str, Column]:
    seconds = seconds_between(start, end)
    return {
        f"{prefix}_Seconds": seconds,
        f"{prefix}_Minutes": seconds / F.lit(60),
        f"{prefix}_Hours": seconds / F.lit(3600),
    }


def rush_hour(name: str) -> Column:
    hour = F.hour(col(name))
    (a, b), (c, d) = RUSH_HOURS
    return F.coalesce(hour.between(a, b) | hour.between(c, d), F.lit(False)).cast("int")
