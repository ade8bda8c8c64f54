"""The items field: JSON array text to typed lines, and the total they imply."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordermill.constants import (
    ITEM_PRODUCT_KEYS,
    ITEM_QUANTITY_KEYS,
    ITEM_UNIT_PRICE_KEYS,
    NUMBER_PATTERN,
    TOTAL_TOLERANCE,
    UNKNOWN_PRODUCT,
)
from ordermill.functions.layers import Layer
from ordermill.functions.money import strip, to_money
from ordermill.functions.text import latin_digits
from ordermill.schema import LINE_NUMBER


def parse_wrapped(text: Column) -> Column:
    """The text as the only element of a JSON array, or null.

    With the extra pair of brackets trailing garbage, which the parser would ignore after a
    complete value, is an error, and a second value shows as a second element.
    """
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))


def item_arrays(wrapped: Column) -> Column:
    """Every element of the wrapped text as an array of items, each item a map of texts."""
    return wrapped.try_cast("array<array<map<string,string>>>")


def item_fields(arrays: Column) -> Column:
    """The items of :func:`item_arrays`; null unless the text is exactly one JSON array.

    An item that is no object is a null entry.
    """
    return F.when(F.size(arrays) == 1, F.get(arrays, F.lit(0)))


def canonical_items(wrapped: Column) -> Column:
    """The array as JSON text with sorted keys and plain numbers: equal lists, equal texts."""
    return F.try_variant_get(wrapped, "$[0]", "string")


def items_error(fields: Column) -> Column:
    return F.when(fields.isNull(), F.lit("JSON_ITEMS_CORRUPTED")).when(
        F.size(fields) == 0, F.lit("ITEMS_EMPTY")
    )


def item_number(text: Column) -> Column:
    """A number as found in item fields and fees; JSON booleans count as 1 and 0."""
    latin = latin_digits(strip(text))
    return (
        F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))
        .when(latin.rlike(NUMBER_PATTERN), latin.try_cast("double"))
        .when(latin == "true", F.lit(1.0))
        .when(latin == "false", F.lit(0.0))
    )


def item_lines(fields: Column) -> Column:
    """Typed lines: product or UNKNOWN, quantity or 1, unit price or null if none is stated.

    An empty quantity or price counts as absent; one that is no number becomes null.
    """

    def line(f: Column) -> Column:
        quantity = F.coalesce(*[F.nullif(f[k], F.lit("")) for k in ITEM_QUANTITY_KEYS])
        price = F.coalesce(*[F.nullif(f[k], F.lit("")) for k in ITEM_UNIT_PRICE_KEYS])
        return F.struct(
            F.coalesce(*[f[k] for k in ITEM_PRODUCT_KEYS], F.lit(UNKNOWN_PRODUCT)).alias("product"),
            quantity.alias("quantity"),
            price.alias("price"),
        )

    return F.transform(
        F.transform(fields, line),
        lambda x: F.struct(
            x["product"].alias("product"),
            F.when(x["quantity"].isNull(), F.lit(1.0))
            .otherwise(item_number(x["quantity"]))
            .alias("qty"),
            item_number(x["price"]).alias("unit_price"),
        ),
    )


def computed_total(lines: Column, fee: Column) -> Column:
    """Sum of quantity times unit price plus fee as money; null where it must not be used.

    One line without a usable price, or with anything negative, makes the whole sum unusable;
    so does a sum that is not finite, which no money value can hold.
    """
    total = F.aggregate(
        lines,
        F.lit(0.0),
        lambda sum_, x: sum_
        + F.when((x["qty"] >= 0) & (x["unit_price"] >= 0), x["qty"] * x["unit_price"]),
    )
    fee_text = F.coalesce(fee, F.lit(""))
    fee_value = F.when(fee_text == "", F.lit(0.0)).otherwise(item_number(fee_text))
    return to_money(F.when(fee_value >= 0, total + fee_value))


def total_replaced(stated: Column, computed: Column) -> Column:
    """The stated total gives way when the computed one differs by more than the tolerance."""
    return F.coalesce(
        F.abs(stated - computed) > F.lit(TOTAL_TOLERANCE).cast("decimal(3,2)"), F.lit(False)
    )


def line_units(line: Column) -> Column:
    return line["qty"].try_cast(LINE_NUMBER.simpleString())


def line_price(line: Column) -> Column:
    """Reports take a missing unit price as zero."""
    return F.coalesce(line["unit_price"], F.lit(0.0))


def line_revenue(line: Column) -> Column:
    return (line["qty"] * line_price(line)).try_cast(LINE_NUMBER.simpleString())


def item_layers(text: Column, fee: Column) -> list[Layer]:
    """Columns from items text to ``c_items``, ``e_items``, ``items_norm`` and ``computed``."""
    json, fields = F.col("item_json"), F.col("item_fields")
    return [
        {"item_json": parse_wrapped(text)},
        {"item_arrays": item_arrays(json), "c_items": canonical_items(json)},
        {"item_fields": item_fields(F.col("item_arrays"))},
        {"e_items": items_error(fields), "items_norm": item_lines(fields)},
        {"computed": computed_total(F.col("items_norm"), fee)},
    ]
