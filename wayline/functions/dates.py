"""Clock and calendar helpers. Month and year differences count calendar boundaries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Valid four-digit clock times, and the season of each month (northern half).
CLOCK = r"^([01]\d|2[0-3])[0-5]\d$"
SEASONS = {"winter": [12, 1, 2], "spring": [3, 4, 5], "summer": [6, 7, 8]}


def fn_lpad_clock(c: Column) -> Column:
    """ "659" -> minutes since midnight; "2400" is 00:00 of the same day; bad text gives NULL. """
    digits = F.lpad(F.when(c == "2400", "0000").otherwise(c), 4, "0")
    minutes = F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int")
    return F.when(digits.rlike(CLOCK), minutes)


def fn_date_trunc(c: Column, unit: str) -> Column:
    return F.trunc(c, {"month": "MM", "week": "WEEK", "year": "YEAR", "quarter": "QUARTER"}[unit])


def iso_weekday(c: Column) -> Column:
    return F.weekday(c) + 1


def fn_date_parts(c: Column) -> Column:
    return F.struct(
        F.year(c).alias("year"), F.quarter(c).alias("quarter"), F.month(c).alias("month"),
        F.hour(c).alias("hour"), iso_weekday(c).alias("day_of_week_iso"),
        F.dayname(c).alias("day_name"), F.monthname(c).alias("month_name"),
        F.date_format(c, "yyyy-MM").alias("year_month"),
        iso_weekday(c).isin(6, 7).alias("is_weekend"))


def season_of(c: Column) -> Column:
    cases = F
    for name, months in SEASONS.items():
        cases = cases.when(F.month(c).isin(months), name)
    return cases.otherwise("autumn")


def fn_date_diff(unit: str, start: Column, end: Column) -> Column:
    if unit == "day":
        return F.datediff(end, start)
    years = F.year(end) - F.year(start)
    if unit == "year":
        return years
    if unit == "month":
        return years * 12 + F.month(end) - F.month(start)
    raise ValueError(f"unknown unit {unit}")


def fn_date_add(c: Column, unit: str, n) -> Column:
    amount = n if isinstance(n, Column) else F.lit(n)
    if unit == "day":
        return F.date_add(c, amount.cast("int"))
    return F.timestamp_add(unit.upper(), amount.cast("int"), c.cast("timestamp_ntz"))


def fn_timestamp_from_parts(day: Column, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes, day.cast("timestamp_ntz"))
