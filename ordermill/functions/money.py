"""Numbers and prices written as text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.constants import CURRENCY_TOKEN_PATTERN, NUMBER_PATTERN, PRICE_WORDS, WHITESPACE
from ordermill.functions.layers import Layer, add_layers
from ordermill.functions.text import clean, latin_digits, text_map
from ordermill.schema import MONEY

# Codes of the price steps in the order they are reported (fixed values).
PRICE_STEP_CODES = [
    "ARABIC_NUMERALS", "PRICE_IN_WORDS", "CURRENCY_TEXT_STRIPPED", "THOUSANDS_SEPARATOR",
]


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def is_number(text: Column) -> Column:
    return strip(text).rlike(NUMBER_PATTERN)


def to_double(text: Column) -> Column:
    """A number or null; never raises."""
    return F.when(is_number(text), strip(text).try_cast("double"))


def to_money(number: Column) -> Column:
    """Two decimals; null for what no money value can hold, infinity included."""
    return number.try_cast(MONEY.simpleString())


def price_words(text: Column) -> Column:
    """A price written in one of the known word forms, as digits; other text unchanged."""
    return F.coalesce(F.try_element_at(text_map(PRICE_WORDS), text), text)


def strip_currency(text: Column) -> Column:
    return strip(F.regexp_replace(text, "(?iu)" + CURRENCY_TOKEN_PATTERN, ""))


def drop_thousands(text: Column) -> Column:
    """Without commas if that leaves a number; otherwise unchanged."""
    bare = F.replace(text, F.lit(","), F.lit(""))
    return F.when(text.contains(",") & is_number(bare), bare).otherwise(text)


def price_layers(source: Column, prefix: str) -> list[Layer]:
    """Columns that end in ``<prefix>`` (money) and ``<prefix>_codes`` (joined by +).

    A step's column is referenced several times by the next, so every step is a layer of its own.
    """
    names = [f"_{prefix}_{i}" for i in range(5)]
    s = [F.col(n) for n in names]
    codes = [
        F.when(after != before, F.lit(code))
        for before, after, code in zip(s, s[1:], PRICE_STEP_CODES)
    ]
    return [
        {names[0]: clean(source)},
        {names[1]: latin_digits(s[0])},
        {names[2]: price_words(s[1])},
        {names[3]: strip_currency(s[2])},
        {names[4]: drop_thousands(s[3])},
        {prefix: to_money(to_double(s[4])), f"{prefix}_codes": F.concat_ws("+", *codes)},
    ]


def with_price(source: str, prefix: str = "price") -> Callable[[DataFrame], DataFrame]:
    """Add ``<prefix>``, ``<prefix>_codes`` and ``<prefix>_corrected`` to a frame."""

    def add(df: DataFrame) -> DataFrame:
        layers = price_layers(F.col(source), prefix)
        added = add_layers(df, layers)
        return added.select(
            *df.columns, prefix, f"{prefix}_codes",
            (F.col(f"{prefix}_codes") != "").alias(f"{prefix}_corrected"),
        )

    return add
