"""Rules, corrections, errors and the verdict of every raw record.

``apply_rules`` works row by row. The one rule that looks at other rows, the conflicting
duplicate, is in :mod:`ordermill.operators.duplicates`; ``add_verdict`` combines both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.constants import (
    DUPLICATE_ERROR,
    MULTIPLE_ERRORS,
    MULTIPLE_ERRORS_PREFIX,
    QUARANTINE_REASONS,
)
from ordermill.functions import dates, items, money, text
from ordermill.functions.layers import add_layers
from ordermill.operators.duplicates import conflicting_rows
from ordermill.schema import CLEANED_FIELDS, CORRECTION
from ordermill.sources.order_csv import ROW_ORDER

LINEAGE = ["id_run", *ROW_ORDER]

_NULL_IF_BLANK = [
    "customer_name", "delivery_type", "payment_method", "payment_status", "city", "district",
]
_STRIPPED = [
    "order_id", "customer_id", "order_date", "currency", "customer_phone", "customer_email",
    "status", *_NULL_IF_BLANK,
]


def _correction(
    condition: Column, field: str, original: Column, corrected: Column, rule: str | Column
) -> tuple[Column, Column]:
    rule_code = F.lit(rule) if isinstance(rule, str) else rule
    values = [F.lit(field), original.cast("string"), corrected.cast("string"), rule_code]
    return condition, F.struct(*[v.alias(n) for v, n in zip(values, CORRECTION.names)])


def apply_rules(raw: DataFrame) -> DataFrame:
    """Raw envelope to cleaned fields, ``corrections`` and row-level ``errors``.

    Input: ``record_raw`` and the lineage columns. ``items`` leaves as canonical JSON text (sorted
    keys, plain numbers), which makes equal item lists equal texts.
    """
    raw = raw.select(*LINEAGE, "record_raw")
    stripped = {f"t_{f}": text.clean(F.col(f"record_raw.{f}")) for f in _STRIPPED}
    digits = text.latin_digits(F.col("t_order_date"))
    fields = [
        stripped,
        {
            "date_digits": digits,
            "c_currency": text.fix_currency(F.col("t_currency")),
            "c_phone": text.fix_phone(F.col("t_customer_phone")),
            "c_email": text.fix_email(F.col("t_customer_email")),
            "c_status": text.fix_status(F.col("t_status")),
        },
        {"c_date": dates.fix_date(F.col("date_digits"))},
        {"bad_date": dates.is_impossible(F.col("c_date"))},
    ]
    price = money.price_layers(F.col("record_raw.total_amount"), "stated")
    total = items.item_layers(
        text.clean(F.col("record_raw.items")), F.col("record_raw.delivery_fee")
    )
    df = add_layers(raw, fields, price, total).withColumn(
        "recomputed",
        F.col("e_items").isNull() & items.total_replaced(F.col("stated"), F.col("computed")),
    )
    return df.select(
        *LINEAGE,
        "record_raw",
        *_cleaned_columns(),
        text.listed(_corrections()).cast(T.ArrayType(CORRECTION)).alias("corrections"),
        text.listed(_errors()).alias("errors"),
        "items_norm",
    )


def without_accepted_records(ruled: DataFrame) -> DataFrame:
    """Rule results with ``record_raw`` only in rows that have errors."""
    return ruled.withColumn("record_raw", F.when(F.size("errors") > 0, F.col("record_raw")))


def _errors() -> list[tuple[Column, Column]]:
    """Row-level error codes in reporting order."""
    no_items = F.col("e_items").isNotNull()
    # A readable amount that no money value can hold must not be stored as if none had been stated.
    written = F.abs(money.to_double(F.col("_stated_4")))
    too_large = F.col("stated").isNull() & (written < float("inf"))
    price_error = F.when((F.col("stated").isNull() & no_items) | too_large, F.lit("PRICE_UNKNOWN")).when(
        F.col("stated") < 0, F.lit("VALUE_NEGATIVE_AMBIGUOUS")
    )
    return [
        (F.col("t_order_id") == "", F.lit("ID_ORDER_MISSING")),
        (F.col("t_customer_id") == "", F.lit("ID_CUSTOMER_MISSING")),
        (F.col("bad_date"), F.lit("DATE_IMPOSSIBLE_INVALID")),
        (no_items, F.col("e_items")),
        (price_error.isNotNull(), price_error),
    ]


def _corrections() -> list[tuple[Column, Column]]:
    """Audit entries in reporting order; the total may have two."""
    stated, stripped = F.col("stated"), F.col
    date_fixed = ~F.col("bad_date") & dates.date_changed(
        stripped("t_order_date"), F.col("date_digits"), F.col("c_date")
    )
    phone, email = stripped("t_customer_phone"), stripped("t_customer_email")
    return [
        _correction(
            date_fixed, "order_date", stripped("t_order_date"), F.col("c_date"), "DATE_NORMALIZED"
        ),
        _correction(
            (F.col("stated_codes") != "") & stated.isNotNull(),
            "total_amount", F.col("_stated_0"), stated,
            F.col("stated_codes"),
        ),
        _correction(
            F.col("c_currency") != stripped("t_currency"),
            "currency", stripped("t_currency"), F.col("c_currency"), "CURRENCY_NORMALIZED",
        ),
        _correction(
            (phone != "") & (F.col("c_phone") != phone),
            "customer_phone", phone, F.col("c_phone"), "PHONE_NORMALIZED",
        ),
        _correction(
            (email != "") & (F.col("c_email") != email),
            "customer_email", email, F.col("c_email"), "EMAIL_REPEATED_SYMBOLS",
        ),
        _correction(
            (stripped("t_status") != "")
            & (F.col("c_status") != text.raw_text(F.col("record_raw.status"))),
            "status", stripped("t_status"), F.col("c_status"), "STATUS_NORMALIZED",
        ),
        _correction(
            F.col("recomputed"), "total_amount", stated, F.col("computed"),
            "TOTAL_RECOMPUTED_FROM_ITEMS",
        ),
    ]


def _cleaned_columns() -> list[Column]:
    values = {
        "order_id": text.blank_to_null(F.col("t_order_id")),
        "customer_id": text.blank_to_null(F.col("t_customer_id")),
        "customer_email": F.when(
            text.email_valid(F.col("c_email")), F.col("c_email")
        ).otherwise(F.col("t_customer_email")),
        "customer_phone": F.when(
            F.col("t_customer_phone") == "", text.raw_text(F.col("record_raw.customer_phone"))
        ).otherwise(F.col("c_phone")),
        "order_date": F.col("c_date"),
        "items": F.when(F.col("item_fields").isNotNull(), F.col("c_items")),
        "currency": F.col("c_currency"),
        "delivery_fee": text.raw_text(F.col("record_raw.delivery_fee")),
        "total_amount": F.when(F.col("recomputed"), F.col("computed")).otherwise(F.col("stated")),
        "status": F.when(
            F.col("t_status") == "", text.raw_text(F.col("record_raw.status"))
        ).otherwise(F.col("c_status")),
    }
    values |= {f: text.blank_to_null(F.col(f"t_{f}")) for f in _NULL_IF_BLANK}
    return [values[name].alias(name) for name in CLEANED_FIELDS]


def add_verdict(ruled: DataFrame, conflicts: DataFrame | None = None) -> DataFrame:
    """Final ``codes_error``, ``quality_status``, ``quarantine_code`` and ``details_error``.

    ``conflicts`` holds the rows flagged as conflicting duplicates; it is small in all but
    pathological runs, and the adaptive planner broadcasts it only when its real size allows.
    """
    conflicts = conflicting_rows(ruled) if conflicts is None else conflicts
    marked = conflicts.select(*ROW_ORDER, F.lit(True).alias("is_conflict"))
    df = ruled.join(marked, ROW_ORDER, "left")
    df = df.withColumn(
        "codes_error",
        F.when(F.col("is_conflict"), F.array_append("errors", F.lit(DUPLICATE_ERROR))).otherwise(
            F.col("errors")
        ),
    ).drop("errors", "is_conflict")
    n = F.size("codes_error")
    df = df.withColumn(
        "quarantine_code",
        F.when(n >= 2, F.lit(MULTIPLE_ERRORS)).when(n == 1, F.get("codes_error", F.lit(0))),
    )
    return df.withColumns(
        {
            "quality_status": F.when(n > 0, F.lit("quarantined"))
            .when(F.size("corrections") > 0, F.lit("corrected"))
            .otherwise(F.lit("valid")),
            "details_error": error_reason(F.col("quarantine_code"), F.col("codes_error")),
        }
    )


def error_reason(code: Column, codes: Column) -> Column:
    reason = F.try_element_at(text.text_map(QUARANTINE_REASONS), code)
    return F.when(
        code == MULTIPLE_ERRORS,
        F.concat(F.lit(MULTIPLE_ERRORS_PREFIX), F.array_join(codes, ", "), F.lit(". "), reason),
    ).otherwise(reason)


def classify(raw: DataFrame) -> DataFrame:
    """Raw envelope rows of one run, classified."""
    return add_verdict(apply_rules(raw))


def accepted(classified: DataFrame) -> DataFrame:
    """Cleaned projection of the valid and corrected rows."""
    return classified.where(F.col("quality_status") != "quarantined").select(
        *LINEAGE, *CLEANED_FIELDS, "quality_status", "corrections", "items_norm"
    )


def quarantined(classified: DataFrame) -> DataFrame:
    """Quarantine-layer records, without the ingestion time."""
    return classified.where(F.col("quality_status") == "quarantined").select(
        "id_run",
        F.col("record_raw.order_id").alias("order_id_raw"),
        "codes_error",
        "details_error",
        "quarantine_code",
        "record_raw",
        F.col("corrections").alias("corrections_attempted"),
    )


def classified_sample(
    classified: DataFrame, status: str | None = None, n: int = 10
) -> DataFrame:
    """The first ``n`` rows, in file order, of one verdict or of all."""
    if n < 1:
        raise ValueError("n must be at least 1")
    df = classified if status is None else classified.where(F.col("quality_status") == status)
    return df.orderBy(*ROW_ORDER).limit(n)
