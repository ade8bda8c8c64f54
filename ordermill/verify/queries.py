"""Every operator as a named query over a data folder.

Rule and classification queries run on the derived order files; lookups, reports, views and run
bookkeeping run on tables that the ingest pipeline built from those files. All of them cover
every derived order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.functions import items as item_rules
from ordermill.functions import rules
from ordermill.functions.layers import add_layers
from ordermill.functions.money import price_layers, with_price
from ordermill.functions.text import clean
from ordermill.operators import classify as C
from ordermill.operators import run_accounting as A
from ordermill.operators.duplicates import conflicting_rows, last_wins
from ordermill.operators.explain import explain_layouts
from ordermill.operators.lookups import run_lookup
from ordermill.operators.reports import items_normalized, run_report
from ordermill.operators.sampling import prefix_sample, size_sample, widening_sample
from ordermill.plans.ingest import ingest_files
from ordermill.plans.jobs import latest_job_runs, periodic_report
from ordermill.plans.views import read_view, refresh_view
from ordermill.schema import CLEANED_FIELDS, JOB_RUNS, PHYSICAL_FIELDS
from ordermill.session import configure, fresh_dir
from ordermill.sinks.layers import split_rows
from ordermill.sinks.layouts import StaleLayout, layout_lookup, write_layouts
from ordermill.sources import order_csv as S
from ordermill.verify import inputs
from ordermill.verify.inputs import once

Query = Callable[[SparkSession, str], DataFrame]

CUSTOMER, CITY = "CUST7", "NATION_5"
LOOKUP_PARAMS = {
    "orders_by_status": {},
    "orders_by_customer": {"customer_id": CUSTOMER},
    "high_value_orders_by_city": {"city": CITY, "min_amount": 1000},
    "orders_by_payment": {"payment_method": "1-URGENT", "payment_status": "F"},
    "orders_needing_review": {},
}
SPLIT, SAMPLE, SAMPLE_MB = 500, 1000, 0.25


# --- shared inputs ------------------------------------------------------------------------

def _scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.scan_orders(spark, inputs.order_files(spark, sf_dir))


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.raw_envelope(S.with_lineage(_scan(spark, sf_dir)), "run-1")


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logical fields of every record."""
    return S.map_columns(_scan(spark, sf_dir))


def _ruled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule results of every record, written once and read back as the ingest plan does."""
    def build():
        path = fresh_dir(spark, "ruled")
        C.apply_rules(_raw(spark, sf_dir)).write.parquet(path)
        return path

    return spark.read.parquet(once(spark, sf_dir, "ruled", build))


def _conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conflicting rows of all records, written once as the ingest plan does: their number is known to a join."""
    def build():
        path = fresh_dir(spark, "conflicts")
        conflicting_rows(_ruled(spark, sf_dir)).write.parquet(path)
        return path

    return spark.read.parquet(once(spark, sf_dir, "conflicts", build))


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.add_verdict(_ruled(spark, sf_dir), _conflicts(spark, sf_dir))


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.store(spark, sf_dir).validated()


# --- rendering of nested values -----------------------------------------------------------

def corrections_text(column: str = "corrections") -> Column:
    return F.array_join(
        F.transform(
            column,
            lambda c: F.concat_ws(
                "|", c["field"], c["original_value"], c["corrected_value"], c["rule_code"]
            ),
        ),
        ";",
    )


def flat(df: DataFrame, *more: str) -> DataFrame:
    """Cleaned orders with plain columns only."""
    return df.select(
        *[F.col(c).cast("double").alias(c) if c == "total_amount" else F.col(c) for c in CLEANED_FIELDS],
        "quality_status",
        corrections_text().alias("corrections"),
        *more,
    )


# --- sources ------------------------------------------------------------------------------

def csv_scan(spark, sf_dir):
    return _scan(spark, sf_dir)


def csv_scan_mixed_headers(spark, sf_dir):
    """Files with different column orders and an extra column in one folder."""
    return S.scan_orders(spark, inputs.mixed_header_files(spark, sf_dir)).select(*PHYSICAL_FIELDS, "coupon")


def raw_extra_columns(spark, sf_dir):
    raw = S.raw_records(spark, inputs.mixed_header_files(spark, sf_dir), "run-1")
    return raw.select("record_raw.*", F.try_element_at("record_extra", F.lit("coupon")).alias("coupon"))


def run_id_reuse(spark, sf_dir):
    """Another delivery under a used run id is refused and leaves the raw layer as it was."""
    made = inputs.store(spark, sf_dir)
    try:
        ingest_files(made, inputs.order_files(spark, sf_dir, 1), "run-1")
        refused = False
    except ValueError:
        refused = True
    return made.raw().agg(F.count("*").alias("raw_rows")).withColumn("refused", F.lit(refused))


def csv_scan_cp1256(spark, sf_dir):
    path = inputs.windows_1256_files(spark, sf_dir)
    return S.scan_orders(spark, path, encoding="windows-1256")


def column_map(spark, sf_dir):
    return _records(spark, sf_dir)


def raw_envelope(spark, sf_dir):
    placed = F.col("file_source").isNotNull() & F.col("number_row_source").isNotNull()
    return _raw(spark, sf_dir).select(
        "id_run", "engine_used", (placed & F.col("at_ingested").isNotNull()).alias("has_lineage"),
        "record_raw.*",
    )


def preview(spark, sf_dir):
    return S.preview(spark, inputs.order_files(spark, sf_dir))


def stream_dir_ingest(spark, sf_dir):
    made = inputs.streamed_store(spark, sf_dir)
    return flat(made.validated(), "last_run_id", "first_seen_run_id")


def stream_bad_file(spark, sf_dir):
    """Orders stored from a directory whose second file cannot be read, and the recorded failures."""
    made = inputs.store_beside_bad_file(spark, sf_dir)
    failures = made.file_ledger().agg(F.count_if(F.col("status") == "failed").alias("n")).scalar()
    return flat(made.validated(), "last_run_id").withColumn("failures", failures)


# --- sinks --------------------------------------------------------------------------------

def quarantine(spark, sf_dir):
    return inputs.store(spark, sf_dir).quarantine().select(
        "id_run", "order_id_raw", F.array_join("codes_error", ",").alias("codes_error"),
        "details_error", "quarantine_code",
        corrections_text("corrections_attempted").alias("corrections_attempted"),
        F.col("record_raw.customer_id").alias("customer_id_raw"),
        F.col("record_raw.order_date").alias("order_date_raw"),
        F.col("record_raw.total_amount").alias("total_amount_raw"),
        F.col("record_raw.items").alias("items_raw"),
    )


def _version(spark, sf_dir, version):
    table = inputs.two_delivery_store(spark, sf_dir).validated_table
    return table.read(table.snapshot(version))


def upsert_merge(spark, sf_dir):
    return flat(_version(spark, sf_dir, 2), "last_run_id", "first_seen_run_id")


def upsert_actions(spark, sf_dir):
    table = inputs.two_delivery_store(spark, sf_dir).validated_table
    return table.actions(table.snapshot(2).change_set)


def split_files(spark, sf_dir):
    """Re-read of the split files: all records, each with the number of its file, one file a number."""
    def build():
        path = fresh_dir(spark, "split")
        split_rows(S.numbered(S.with_lineage(_scan(spark, sf_dir))), path, SPLIT)
        return path

    lines = S.with_lineage(S.scan_orders(spark, once(spark, sf_dir, "split", build)))
    files = lines.groupBy("chunk").agg(F.count_distinct("file_source").alias("n")).agg(F.max("n").alias("n"))
    return lines.select(
        *PHYSICAL_FIELDS, F.col("chunk").cast("bigint").alias("chunk"), (files.scalar() == 1).alias("one_file")
    )


# --- rules --------------------------------------------------------------------------------

def _pair_query(field: str, rule) -> Query:
    names = ["value", "corrected", "is_valid"]

    def run(spark, sf_dir):
        outputs = rule(F.col(field))
        return _records(spark, sf_dir).select(
            F.col(field).alias("raw"), *[c.alias(n) for c, n in zip(outputs, names)]
        )

    return run


def rule_parse_price(spark, sf_dir):
    return _records(spark, sf_dir).transform(with_price("total_amount")).select(
        F.col("total_amount").alias("raw"),
        F.col("price").cast("double").alias("price"),
        F.col("price_corrected").alias("corrected"),
        F.col("price_codes").alias("codes"),
    )


def rule_date(spark, sf_dir):
    value, corrected = rules.date(F.col("order_date"))
    return _records(spark, sf_dir).select(
        F.col("order_date").alias("raw"),
        value.alias("value"),
        corrected.alias("corrected"),
        rules.dates.is_impossible(value).alias("is_impossible"),
    )


def _with_items(spark, sf_dir, *more) -> DataFrame:
    layers = item_rules.item_layers(clean(F.col("items")), F.col("delivery_fee"))
    return add_layers(_records(spark, sf_dir), layers, *more)


def rule_items_json(spark, sf_dir):
    known = F.col("item_fields").isNotNull()
    return _with_items(spark, sf_dir).select(
        F.col("items").alias("raw"),
        F.when(known, F.col("c_items")).alias("items"),
        F.col("e_items").alias("error_code"),
    )


def rule_recompute_total(spark, sf_dir):
    df = _with_items(spark, sf_dir, price_layers(F.col("total_amount"), "stated"))
    replaced = item_rules.total_replaced(F.col("stated"), F.col("computed"))
    return df.where(F.col("e_items").isNull()).select(
        "order_id",
        F.col("stated").cast("double").alias("stated"),
        F.col("computed").cast("double").alias("computed"),
        replaced.alias("corrected"),
    )


# --- classification -----------------------------------------------------------------------

def error_codes(spark, sf_dir):
    return _classified(spark, sf_dir).select(
        F.col("record_raw.order_id").alias("order_id_raw"),
        F.col("record_raw.customer_id").alias("customer_id_raw"),
        F.array_join("codes_error", ",").alias("codes_error"),
    )


def corrections_audit(spark, sf_dir):
    return (
        C.apply_rules(_raw(spark, sf_dir))
        .select(F.col("record_raw.order_id").alias("order_id_raw"),
                F.posexplode("corrections").alias("place", "c"))
        .select("order_id_raw", F.col("place").cast("bigint").alias("place"), "c.*")
    )


def classify(spark, sf_dir):
    """From CSV text to verdicts in one lazy plan."""
    return C.classify(_raw(spark, sf_dir)).select(
        F.col("record_raw.order_id").alias("order_id_raw"),
        F.col("record_raw.customer_id").alias("customer_id_raw"),
        "quality_status", "quarantine_code", "details_error",
    )


def dup_conflicts(spark, sf_dir):
    ruled = _ruled(spark, sf_dir)
    return ruled.join(_conflicts(spark, sf_dir), S.ROW_ORDER, "left_semi").select(
        "order_id", "customer_id", F.col("total_amount").cast("double").alias("total_amount")
    )


def last_rows(spark, sf_dir):
    rows = last_wins(C.accepted(_classified(spark, sf_dir)))
    return rows.select(
        "order_id", "customer_id", F.col("total_amount").cast("double").alias("total_amount"),
        "quality_status",
    )


def cleaned(spark, sf_dir):
    return flat(C.accepted(_classified(spark, sf_dir)))


def classified_sample(spark, sf_dir):
    return C.classified_sample(_classified(spark, sf_dir), "quarantined", 10).select(
        F.col("record_raw.order_id").alias("order_id_raw"), "quarantine_code"
    )


# --- lookups ------------------------------------------------------------------------------

def _lookup_query(name: str) -> Query:
    return lambda spark, sf_dir: flat(
        run_lookup(_validated(spark, sf_dir), name, LOOKUP_PARAMS[name])
    )


def _layouts(spark, sf_dir):
    """Layouts of the stored orders, with as many files as the table has."""

    def build():
        made = inputs.store(spark, sf_dir).validated_table
        return write_layouts(made, fresh_dir(spark, "layouts"), len(made.pieces(made.snapshot())))

    return once(spark, sf_dir, "layouts", build)


def _layout_answers(table, made, **how) -> DataFrame:
    parts = [
        layout_lookup(table, made, name, LOOKUP_PARAMS[name], **how).select(
            F.lit(name).alias("lookup"), "order_id", "order_date",
            F.col("total_amount").cast("double").alias("total_amount"),
        )
        for name in made
    ]
    df = parts[0]
    for part in parts[1:]:
        df = df.unionByName(part)
    return df


def clustered_lookup(spark, sf_dir):
    """The lookups that have a layout, answered from it."""
    return _layout_answers(inputs.store(spark, sf_dir).validated_table, _layouts(spark, sf_dir))


def layout_top_up(spark, sf_dir):
    """Layouts built after the first run, topped up after the second and again after its rollback."""

    def build():
        table = inputs.two_delivery_store(spark, sf_dir).validated_table
        made = write_layouts(table, fresh_dir(spark, "layouts-two"), source=table.snapshot(1))
        for layout in made.values():
            layout.top_up(table.snapshot(2))
        return table, made

    table, made = once(spark, sf_dir, "layouts-two", build)
    try:
        layout_lookup(table, made, "orders_by_status")
        refused = False
    except StaleLayout:
        refused = True
    answers = _layout_answers(table, made, top_up=True)
    return answers if refused else answers.where("false")


def explain_layout(spark, sf_dir):
    """Matches and returned rows of each compared lookup, and whether its layout has them in no more files.

    A range of sorted rows may lie across one border between files, hence the one more.
    """
    validated, made = _validated(spark, sf_dir), _layouts(spark, sf_dir)
    found = explain_layouts(spark, validated, lambda name: made[name].rows(), LOOKUP_PARAMS)
    table = found.where("layout = 'none'").select("query", F.col("files_matching").alias("before"))
    return found.join(table, "query").select(
        "query", "layout", "rows_matching", "rows_returned",
        (F.col("files_matching") <= F.col("before") + 1).alias("in_no_more_files"),
    )


# --- reports ------------------------------------------------------------------------------

def _report_query(name: str, **params) -> Query:
    return lambda spark, sf_dir: run_report(_validated(spark, sf_dir), name, params)


def item_rows(spark, sf_dir):
    return items_normalized(_validated(spark, sf_dir))


def table_counts(spark, sf_dir):
    made = inputs.store(spark, sf_dir)
    return A.table_counts(made.raw(), made.validated(), made.quarantine())


# --- views --------------------------------------------------------------------------------

def _view_query(name: str, store_of: Callable, refresh: bool) -> Query:
    def run(spark, sf_dir):
        made = store_of(spark, sf_dir)
        if refresh:
            refresh_view(made, name, force_full=True)
        return read_view(made, name).drop("updated_at")

    return run


# --- jobs and run bookkeeping ---------------------------------------------------------------

def periodic_report_rows(spark, sf_dir):
    """The entries of the periodic report, and the rank of those of its limited sections."""
    report = periodic_report(_validated(spark, sf_dir))
    kept = F.from_json(
        "entry", "city string, total_sales double, product string, revenue double, status string, percentage double"
    )
    limited = report.where("section <> 'orders_status_distribution'")
    order = Window.partitionBy("section").orderBy("place")
    ranked = limited.withColumn("rank", F.row_number().over(order).cast("bigint"))
    rest = report.where("section = 'orders_status_distribution'").withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.union(rest).withColumn("e", kept).select(
        "section", "rank", F.coalesce("e.city", "e.product", "e.status").alias("key"),
        F.coalesce("e.total_sales", "e.revenue", "e.percentage").alias("value"),
    )


def latest_runs(spark, sf_dir):
    """Latest run per job over a job history taken from the events table.

    A job starts at the full hour of its event, so that several start together and the one that ended
    last has to be found.
    """
    configure(spark)
    ended = F.col("ts").cast("timestamp")
    started = F.date_trunc("hour", ended)
    failed = F.col("value") > 50
    history = inputs.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("job_name"),
        started.alias("started_at"),
        ended.alias("finished_at"),
        (F.unix_micros(ended) - F.unix_micros(started)).cast("double").alias("duration_seconds"),
        F.when(failed, "failure").otherwise("success").alias("status"),
        F.when(failed, F.concat(F.lit("value "), F.col("value").cast("long").cast("string"))).alias("error"),
        F.col("event_id").cast("string").alias("result"),
    )
    assert history.columns == JOB_RUNS.names
    return latest_job_runs(history).select(
        "job_name", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("started_at", "finished_at")],
        "duration_seconds", "status", "error", "result",
    )


def run_metrics(spark, sf_dir):
    return inputs.store(spark, sf_dir).run_metrics().select(
        "read_rows", "loaded_raw", "count_valid", "count_corrected", "count_quarantine",
        "count_inserted", "count_updated", "count_unchanged", "distinct_accepted",
    )


def run_checks(spark, sf_dir):
    """The checks recomputed from the counts of the run."""
    return A.run_checks(run_metrics(spark, sf_dir)).select(
        "consistency_expected_total", "consistency_check_passed", "upsert_applied",
        "upsert_matches_rows", "idempotent_run",
    )


def error_code_counts(spark, sf_dir):
    return A.error_code_counts(A.tally(_classified(spark, sf_dir)))


def correction_rule_counts(spark, sf_dir):
    return A.correction_rule_counts(A.tally(_classified(spark, sf_dir)))


def reconcile_counts(spark, sf_dir):
    return A.reconcile(_scan(spark, sf_dir), inputs.store(spark, sf_dir).raw(), "run-1")


def rollback_run(spark, sf_dir):
    return flat(_version(spark, sf_dir, 3), "last_run_id", "first_seen_run_id")


def rollback_restore(spark, sf_dir):
    return flat(inputs.restored_store(spark, sf_dir).validated(), "last_run_id", "first_seen_run_id")


def _placed_scan(spark, sf_dir):
    return S.numbered(S.with_lineage(_scan(spark, sf_dir))).drop("file_block_start")


def prefix_rows(spark, sf_dir):
    return prefix_sample(_placed_scan(spark, sf_dir), SAMPLE).select(*PHYSICAL_FIELDS)


def small_sample(spark, sf_dir):
    """The same rows as the prefix sample, from some of the split files, with the number of files opened."""
    path = fresh_dir(spark, "sample-files")
    split_rows(S.numbered(S.with_lineage(_scan(spark, sf_dir))), path, 100)
    files = spark.read.format("binaryFile").load(path).count()

    def scan(found: list[str]) -> DataFrame:
        return S.numbered(S.with_lineage(S.scan_orders(spark, found)))

    sample, opened = widening_sample(spark, path, 200, scan, 10_000)
    return sample.select(*PHYSICAL_FIELDS, F.lit(opened < files).alias("few_files"))


def size_rows(spark, sf_dir):
    return size_sample(_placed_scan(spark, sf_dir), PHYSICAL_FIELDS, SAMPLE_MB).select(
        *PHYSICAL_FIELDS
    )


def queries() -> dict[str, Query]:
    return {
        "csv_scan": csv_scan,
        "csv_scan_mixed_headers": csv_scan_mixed_headers,
        "raw_extra_columns": raw_extra_columns,
        "run_id_reuse": run_id_reuse,
        "csv_scan_cp1256": csv_scan_cp1256,
        "column_map": column_map,
        "raw_envelope": raw_envelope,
        "preview": preview,
        "stream_dir_ingest": stream_dir_ingest,
        "stream_bad_file": stream_bad_file,
        "quarantine": quarantine,
        "upsert_merge": upsert_merge,
        "upsert_actions": upsert_actions,
        "split_rows": split_files,
        "rule_arabic_digits": _pair_query("total_amount", rules.arabic_numerals),
        "rule_currency": _pair_query("currency", rules.currency),
        "rule_thousands": _pair_query("total_amount", rules.thousands_separator),
        "rule_price_words": _pair_query("total_amount", rules.price_in_words),
        "rule_parse_price": rule_parse_price,
        "rule_phone": _pair_query("customer_phone", rules.phone),
        "rule_email": _pair_query("customer_email", rules.email),
        "rule_date": rule_date,
        "rule_status": _pair_query("status", rules.status),
        "rule_items_json": rule_items_json,
        "rule_recompute_total": rule_recompute_total,
        "error_codes": error_codes,
        "corrections_audit": corrections_audit,
        "classify": classify,
        "dup_conflicts": dup_conflicts,
        "last_wins": last_rows,
        "cleaned": cleaned,
        "classified_sample": classified_sample,
        **{name: _lookup_query(name) for name in LOOKUP_PARAMS},
        "explain_layout": explain_layout,
        "clustered_lookup": clustered_lookup,
        "layout_top_up": layout_top_up,
        "sales_by_city": _report_query("sales_by_city"),
        "top_products": _report_query("top_products"),
        "top_customers": _report_query("top_customers"),
        "sales_by_month": _report_query("sales_by_period", granularity="month"),
        "sales_by_day": _report_query("sales_by_period", granularity="day"),
        "status_distribution": _report_query("orders_status_distribution"),
        "items_normalized": item_rows,
        "table_counts": table_counts,
        "mv_daily_sales_full": _view_query("daily_sales_summary", inputs.store, True),
        "mv_daily_sales_incremental": _view_query(
            "daily_sales_summary", inputs.two_delivery_store, False
        ),
        "mv_daily_sales_restored": _view_query("daily_sales_summary", inputs.restored_store, False),
        "mv_top_products_full": _view_query("top_products_summary", inputs.store, True),
        "mv_top_products_incremental": _view_query(
            "top_products_summary", inputs.two_delivery_store, False
        ),
        "stream_mv_refresh": _view_query("daily_sales_summary", inputs.streamed_store, False),
        "periodic_report": periodic_report_rows,
        "latest_job_runs": latest_runs,
        "run_metrics": run_metrics,
        "run_checks": run_checks,
        "error_code_counts": error_code_counts,
        "correction_rule_counts": correction_rule_counts,
        "reconcile_counts": reconcile_counts,
        "rollback_run": rollback_run,
        "rollback_restore": rollback_restore,
        "prefix_sample": prefix_rows,
        "small_sample": small_sample,
        "size_sample": size_rows,
    }
