"""The set of tables one order pipeline owns, under one root folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ordermill.schema import CORRECTION, JOB_RUNS, RECORD_RAW
from ordermill.session import configure
from ordermill.sinks.files import read_parquet
from ordermill.sinks.order_upsert import validated_table


def _with_run(*fields: T.StructField) -> T.StructType:
    return T.StructType([*fields, T.StructField("id_run", T.StringType())])


RAW = _with_run(
    T.StructField("file_source", T.StringType()),
    T.StructField("number_row_source", T.LongType()),
    T.StructField("at_ingested", T.TimestampType()),
    T.StructField("engine_used", T.StringType()),
    T.StructField("record_raw", RECORD_RAW),
    T.StructField("record_extra", T.MapType(T.StringType(), T.StringType())),
)

QUARANTINE = _with_run(
    T.StructField("order_id_raw", T.StringType()),
    T.StructField("codes_error", T.ArrayType(T.StringType())),
    T.StructField("details_error", T.StringType()),
    T.StructField("quarantine_code", T.StringType()),
    T.StructField("record_raw", RECORD_RAW),
    T.StructField("corrections_attempted", T.ArrayType(CORRECTION)),
    T.StructField("quarantined_at", T.TimestampType()),
)

_COUNTS = T.MapType(T.StringType(), T.LongType())

RUN_METRICS = _with_run(
    T.StructField("file_name", T.StringType()),
    T.StructField("used_engine", T.StringType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("finished_at", T.TimestampType()),
    T.StructField("read_rows", T.LongType()),
    T.StructField("loaded_raw", T.LongType()),
    T.StructField("count_valid", T.LongType()),
    T.StructField("count_corrected", T.LongType()),
    T.StructField("count_quarantine", T.LongType()),
    T.StructField("consistency_check_passed", T.BooleanType()),
    T.StructField("consistency_expected_total", T.LongType()),
    T.StructField("seconds_elapsed", T.DoubleType()),
    T.StructField("throughput_rows_per_sec", T.DoubleType()),
    T.StructField("partitions", T.LongType()),
    T.StructField("counts_case_error", _COUNTS),
    T.StructField("counts_correction_rule", _COUNTS),
    T.StructField("count_inserted", T.LongType()),
    T.StructField("count_updated", T.LongType()),
    T.StructField("count_unchanged", T.LongType()),
    T.StructField("distinct_accepted", T.LongType()),
    T.StructField("upsert_applied", T.BooleanType()),
    T.StructField("upsert_matches_rows", T.BooleanType()),
    T.StructField("idempotent_run", T.BooleanType()),
)

# What became of files that could not be ingested; the latest row of a path is its state.
FILE_LEDGER = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modified_at", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("id_run", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("recorded_at", T.TimestampType()),
    ]
)

PERIODIC_REPORTS = T.StructType(
    [
        T.StructField("generated_at", T.TimestampType()),
        T.StructField("section", T.StringType()),
        T.StructField("place", T.LongType()),
        T.StructField("entry", T.StringType()),
    ]
)


class OrderStore:
    """Locations and readers; every method returns a lazy frame."""

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark = configure(spark)
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.validated_table = validated_table(spark, f"{self.root}/orders_validated", buckets)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        return read_parquet(self.spark, [self.path(name)], schema)

    def raw(self) -> DataFrame:
        return self._read("orders_raw", RAW)

    def validated(self) -> DataFrame:
        return self.validated_table.read()

    def quarantine(self) -> DataFrame:
        return self._read("orders_quarantine", QUARANTINE)

    def run_metrics(self) -> DataFrame:
        return self._read("run_metrics", RUN_METRICS)

    def job_runs(self) -> DataFrame:
        return self._read("job_runs", JOB_RUNS)

    def file_ledger(self) -> DataFrame:
        return self._read("file_ledger", FILE_LEDGER)

    def periodic_reports(self) -> DataFrame:
        return self._read("periodic_reports", PERIODIC_REPORTS)
