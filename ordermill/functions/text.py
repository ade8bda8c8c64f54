"""Rules for text fields: whitespace, digits, currency, phone, email, status.

Each ``fix_*`` function returns the cleaned value; the matching ``*_changed`` function tells
whether that counts as a correction.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordermill.constants import (
    ARABIC_DIGITS,
    CURRENCY_SYNONYMS,
    EMAIL_PATTERN,
    ISO_CURRENCIES,
    LATIN_DIGITS,
    STATUS_SYNONYMS,
    WHITESPACE,
)


def text_map(table: dict[str, object]) -> Column:
    """A small constant table as a map column of strings."""
    cells = [F.lit(str(cell)) for pair in table.items() for cell in pair]
    return F.create_map(*cells) if cells else F.expr("cast(map() as map<string,string>)")


def raw_text(value: Column) -> Column:
    """Missing text is empty text."""
    return F.coalesce(value, F.lit(""))


def clean(value: Column) -> Column:
    """Empty instead of null, outer Unicode whitespace gone."""
    return F.btrim(raw_text(value), F.lit(WHITESPACE))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def latin_digits(text: Column) -> Column:
    """Arabic-Indic digits to 0-9."""
    return F.translate(text, ARABIC_DIGITS, LATIN_DIGITS)


def fix_currency(text: Column) -> Column:
    """ISO code of a known currency name, other text unchanged, blank to null.

    The table's names are lower-case, so text that is one of them need not be lowered, which is slow for
    other letters than Latin ones.
    """
    upper, names = F.upper(text), text_map(CURRENCY_SYNONYMS)
    return (
        F.when(text == "", F.lit(None).cast("string"))
        .otherwise(
            F.coalesce(
                F.try_element_at(names, text),
                F.try_element_at(names, F.lower(text)),
                F.when(upper.isin(ISO_CURRENCIES), upper),
                text,
            )
        )
    )


def fix_phone(text: Column) -> Column:
    """Digits with at most one plus sign, and that in front."""
    kept = F.regexp_replace(latin_digits(text), r"[^0-9+]", "")
    pluses = F.length(kept) - F.length(F.replace(kept, F.lit("+"), F.lit("")))
    misplaced = (pluses > 1) | ((pluses == 1) & ~kept.startswith("+"))
    return F.when(
        misplaced, F.concat(F.lit("+"), F.replace(kept, F.lit("+"), F.lit("")))
    ).otherwise(kept)


def fix_email(text: Column) -> Column:
    """No blanks, no doubled at-signs or dots."""
    no_blanks = F.replace(text, F.lit(" "), F.lit(""))
    return F.regexp_replace(F.regexp_replace(no_blanks, r"@{2,}", "@"), r"\.{2,}", ".")


def email_valid(fixed: Column) -> Column:
    return fixed.rlike("(?U)" + EMAIL_PATTERN)


def fix_status(text: Column) -> Column:
    """Stripped status, spelling variants unified where the table lists any."""
    if not STATUS_SYNONYMS:
        return text
    table = text_map(STATUS_SYNONYMS)
    return F.coalesce(
        F.try_element_at(table, F.lower(text)), F.try_element_at(table, text), text
    )


def listed(entries: list[tuple[Column, Column]]) -> Column:
    """Array of the values whose condition holds, in the given order."""
    none = F.slice(F.array(*[value for _, value in entries[:1]]), F.lit(1), F.lit(0))
    return F.flatten(
        F.array(*[F.when(holds, F.array(value)).otherwise(none) for holds, value in entries])
    )
