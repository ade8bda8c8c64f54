"""Table schemas and field lists."""

from __future__ import annotations

from pyspark.sql import types as T

from ordermill.constants import COLUMN_MAP

# As wide as decimals are: exact sums in any order, and room for every amount below 10^36.
MONEY = T.DecimalType(38, 2)
# One item line's quantity or revenue.
LINE_NUMBER = T.DecimalType(38, 6)

LOGICAL_FIELDS = list(COLUMN_MAP)
PHYSICAL_FIELDS = list(COLUMN_MAP.values())


def all_string(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


RECORD_RAW = all_string(LOGICAL_FIELDS)

ITEM = T.StructType(
    [
        T.StructField("product", T.StringType()),
        T.StructField("qty", T.DoubleType()),
        T.StructField("unit_price", T.DoubleType()),
    ]
)

CORRECTION = all_string(["field", "original_value", "corrected_value", "rule_code"])

# The 16 cleaned fields of an accepted order, in output order.
CLEANED_FIELDS = [
    "order_id", "customer_id", "customer_name", "customer_email", "customer_phone",
    "order_date", "items", "currency", "delivery_fee", "delivery_type",
    "payment_method", "payment_status", "total_amount", "status", "city", "district",
]

# Fields whose change makes an upsert an update.
BUSINESS_FIELDS = CLEANED_FIELDS + ["quality_status", "corrections"]

# Set by the upsert; never compared.
TRACKING_FIELDS = ["last_run_id", "last_updated_at", "first_seen_run_id", "created_at"]

_VALIDATED_TYPES = {
    "total_amount": MONEY,
    "corrections": T.ArrayType(CORRECTION),
    "last_updated_at": T.TimestampType(),
    "created_at": T.TimestampType(),
}

# ``items_norm`` is the typed form of ``items``: reports read it instead of parsing JSON again.
VALIDATED = T.StructType(
    [
        T.StructField(name, _VALIDATED_TYPES.get(name, T.StringType()))
        for name in BUSINESS_FIELDS + TRACKING_FIELDS
    ]
    + [T.StructField("items_norm", T.ArrayType(ITEM))]
)

JOB_RUNS = T.StructType(
    [
        T.StructField("job_name", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("result", T.StringType()),
    ]
)
