"""Dates in any of the accepted spellings, to ISO text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordermill.constants import (
    ARABIC_DIGITS,
    FIRST_PLAUSIBLE_YEAR,
    ISO_DATE_TIME_PATTERN,
    LAST_PLAUSIBLE_YEAR,
)

# Shapes are checked before parsing, because the parser alone accepts odd digit counts.
_YEAR = r"(?!0000)\d{4}"
_YEAR_FIRST = rf"^{_YEAR}([-/.])\d{{1,2}}\1\d{{1,2}}$"
_YEAR_LAST = rf"^\d{{1,2}}([-/.])\d{{1,2}}\1{_YEAR}$"
_HOUR, _SIXTY = r"(?:[01]\d|2[0-3])", r"[0-5]\d"
_TIME = (
    rf"{_HOUR}(?::{_SIXTY}(?::{_SIXTY})?(?:[.,]\d+)?|{_SIXTY}(?:{_SIXTY}(?:[.,]\d+)?)?)?"
)
# One character of any kind, a time of day and perhaps its offset.
_CLOCK = rf"(?:.{_TIME}(?:[+-]{_TIME})?)?$"
_DASHED_DAY = rf"(?s)^{_YEAR}-\d{{2}}-\d{{2}}" + _CLOCK
_COMPACT_DAY = rf"(?s)^{_YEAR}\d{{4}}" + _CLOCK
# Groups: the year; week and weekday with dashes; week and weekday without. A dash before two digits
# starts a time.
_WEEK_DAY = rf"(?s)^({_YEAR})(?:-W(\d{{2}})(?:-(\d)(?!\d))?|W(\d{{2}})(\d)?)" + _CLOCK


def has_arabic_digits(text: Column) -> Column:
    return text.rlike(f"[{ARABIC_DIGITS}]")


def is_iso_shaped(digits: Column) -> Column:
    return digits.rlike(ISO_DATE_TIME_PATTERN)


def _day_of_week_date(text: Column) -> Column:
    """The day that an ISO week date names, the Monday if it names none; null if there is no such day."""

    def part(*groups: int) -> Column:
        return F.concat(*[F.regexp_extract(text, _WEEK_DAY, g) for g in groups])

    # The fourth of January lies in the first week, and a week belongs to the year of its Thursday.
    fourth = F.try_to_date(F.concat(part(1), F.lit("-01-04")), "yyyy-MM-dd")
    week, weekday = part(2, 4).try_cast("int"), part(3, 5)
    weekday = F.when(weekday == "", F.lit(1)).otherwise(weekday.try_cast("int"))
    monday = F.date_add(F.date_sub(fourth, F.weekday(fourth)), (week - 1) * 7)
    day = F.date_add(monday, weekday - 1)
    exists = (
        (F.year(F.date_add(monday, 3)) == F.year(fourth))
        & weekday.between(1, 7)
        & (F.year(day) <= 9999)
    )
    return F.when(exists, day)


def fix_date(digits: Column) -> Column:
    """ISO text of a stripped date whose digits are already Latin; null if unreadable.

    Text in ISO shape is cut to its date part without a calendar check. Of the other spellings,
    day-first wins over month-first, and dotted dates are never month-first; then come the remaining
    ISO ones: times with offsets or without colons, days without dashes, weeks with or without weekday.
    """
    dashed = F.regexp_replace(digits, r"[/.]", "-")
    no_z = F.replace(digits, F.lit("Z"), F.lit(""))
    year_last = digits.rlike(_YEAR_LAST)
    parsed = F.coalesce(
        F.when(digits.rlike(_YEAR_FIRST), F.try_to_date(dashed, "yyyy-M-d")),
        F.when(year_last, F.try_to_date(dashed, "d-M-yyyy")),
        F.when(year_last & ~digits.contains("."), F.try_to_date(dashed, "M-d-yyyy")),
        F.when(no_z.rlike(_DASHED_DAY), F.try_to_date(F.substring(no_z, 1, 10), "yyyy-MM-dd")),
        F.when(no_z.rlike(_COMPACT_DAY), F.try_to_date(F.substring(no_z, 1, 8), "yyyyMMdd")),
        F.when(no_z.rlike(_WEEK_DAY), _day_of_week_date(no_z)),
    )
    return F.when(is_iso_shaped(digits), F.substring(digits, 1, 10)).otherwise(
        F.date_format(parsed, "yyyy-MM-dd")
    )


def date_changed(text: Column, digits: Column, fixed: Column) -> Column:
    """A reformatted date is a correction; dropping the time of an ISO one is not."""
    return fixed.isNotNull() & (~is_iso_shaped(digits) | has_arabic_digits(text))


def is_impossible(iso: Column) -> Column:
    day = F.try_to_date(iso, "yyyy-MM-dd")
    return day.isNull() | ~F.year(day).between(FIRST_PLAUSIBLE_YEAR, LAST_PLAUSIBLE_YEAR)
