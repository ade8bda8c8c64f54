"""The single-field rules as (cleaned value, corrected?) column pairs over a raw text column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordermill.functions import dates, money, text

Pair = tuple[Column, Column]


def arabic_numerals(raw: Column) -> Pair:
    stripped = text.clean(raw)
    value = text.latin_digits(stripped)
    return value, value != stripped


def currency(raw: Column) -> Pair:
    stripped = text.clean(raw)
    value = text.fix_currency(stripped)
    return value, F.coalesce(value != stripped, F.lit(False))


def thousands_separator(raw: Column) -> Pair:
    """Anything that is no number with commas is returned as received."""
    stripped = text.clean(raw)
    value = money.drop_thousands(stripped)
    return F.when(value != stripped, value).otherwise(raw), value != stripped


def price_in_words(raw: Column) -> Pair:
    stripped = text.clean(raw)
    value = money.price_words(stripped)
    return F.when(value != stripped, value).otherwise(raw), value != stripped


def phone(raw: Column) -> Pair:
    stripped = text.clean(raw)
    value = text.fix_phone(stripped)
    blank = stripped == ""
    return F.when(blank, raw).otherwise(value), ~blank & (value != stripped)


def email(raw: Column) -> tuple[Column, Column, Column]:
    """Also tells whether the fixed address is valid."""
    stripped = text.clean(raw)
    value = text.fix_email(stripped)
    blank = stripped == ""
    return (
        F.when(blank, raw).otherwise(value),
        ~blank & (value != stripped),
        ~blank & text.email_valid(value),
    )


def date(raw: Column) -> Pair:
    stripped = text.clean(raw)
    digits = text.latin_digits(stripped)
    value = dates.fix_date(digits)
    return value, dates.date_changed(stripped, digits, value)


def status(raw: Column) -> Pair:
    stripped = text.clean(raw)
    value = text.fix_status(stripped)
    blank = stripped == ""
    return F.when(blank, raw).otherwise(value), ~blank & (value != text.raw_text(raw))
