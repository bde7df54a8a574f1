"""Timestamps: parsing and arithmetic in exact integers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A full calendar date must lead; a bare year or a time of day is not a reading time. Zones are offsets, not names.
_TIME = r"([T ]\d{2}(:?\d{2}(:?\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
_CALENDAR = r"^\d{4}-\d{2}-\d{2}" + _TIME
_BASIC = r"^(\d{4})(\d{2})(\d{2})" + _TIME
_WEEK = r"^(\d{4})-?W(\d{2})(-?([1-7]))?" + _TIME
_BASIC_TIME = r"([T ]\d{2})(\d{2})(\d{2})"


def _extended(text: Column) -> Column:
    """Basic and week forms as the calendar form with colons; NULL for anything that is none of the three."""
    part = lambda pattern, group: F.regexp_extract(text, pattern, group)
    number = lambda pattern, group: F.when(part(pattern, group) != "", part(pattern, group)).cast("int")
    year, week, day = number(_WEEK, 1), number(_WEEK, 2), F.coalesce(number(_WEEK, 4), F.lit(1))
    first = F.trunc(F.make_date(F.greatest(year, F.lit(1)), F.lit(1), F.lit(4)), "week")
    monday = F.date_add(first, (week - 1) * 7)
    known = week.between(1, 53) & (F.weekofyear(monday) == week)
    calendar = F.when(text.rlike(_CALENDAR), text).when(
        text.rlike(_BASIC), F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})", "$1-$2-$3")).when(
        text.rlike(_WEEK) & known, F.concat(F.date_add(monday, day - 1).cast("string"), F.regexp_replace(text, r"^\d{4}-?W\d{2}(-?[1-7])?", "")))
    return F.regexp_replace(F.regexp_replace(calendar, _BASIC_TIME, "$1:$2:$3"), r"(:\d{2}),(\d)", "$1.$2")


def parse_instant(text: Column) -> Column:
    """ISO-8601 text to a UTC instant at millisecond precision; NULL when it is not one."""
    return F.timestamp_millis(F.unix_millis(F.try_to_timestamp(_extended(text))))


def micros_between(later: Column, earlier: Column) -> Column:
    return F.unix_micros(later) - F.unix_micros(earlier)
