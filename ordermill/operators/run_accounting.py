"""Counts, checks and reconciliation of runs."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.sinks.keyed_table import INSERTED, UNCHANGED, UPDATED

def is_accepted() -> Column:
    return F.col("quality_status") != "quarantined"


def tally(classified: DataFrame) -> DataFrame:
    """Every count of a run in one pass: (kind, code, n).

    Kinds: ``verdict``; ``quarantine`` (the code a record was quarantined under); ``mention``
    (every code of such a record); ``rule`` (corrections of accepted records). Codes come from
    the fixed rule set, so the result has a few dozen rows however large the run is.
    """

    def entry(kind: str, code: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), code.alias("code"))

    rules = F.when(is_accepted(), F.col("corrections.rule_code")).otherwise(F.array())
    entries = F.concat(
        F.array(
            entry("verdict", F.col("quality_status")),
            entry("quarantine", F.col("quarantine_code")),
        ),
        F.transform("codes_error", lambda c: entry("mention", c)),
        F.transform(rules, lambda c: entry("rule", c)),
    )
    return (
        classified.select(F.explode(entries).alias("e"))
        .where(F.col("e.code").isNotNull())
        .groupBy("e.kind", "e.code")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _n_of(kind: str, code: str | None = None) -> Column:
    hit = F.col("kind") == kind
    return F.coalesce(F.sum(F.when(hit & (F.col("code") == code) if code else hit, F.col("n"))), F.lit(0))


def error_code_counts(tallied: DataFrame) -> DataFrame:
    """Per code: records quarantined under it, and records that mention it at all."""
    return (
        tallied.where(F.col("kind").isin("quarantine", "mention"))
        .groupBy("code")
        .agg(_n_of("quarantine").alias("orders_count"), _n_of("mention").alias("mentions_count"))
    )


def correction_rule_counts(tallied: DataFrame) -> DataFrame:
    """Per rule: corrections on accepted records and their share of corrected records, in percent.

    The window covers the few dozen rows of the tally.
    """
    corrected = F.sum(
        F.when((F.col("kind") == "verdict") & (F.col("code") == "corrected"), F.col("n"))
    ).over(Window.partitionBy())
    return (
        tallied.withColumn("corrected", corrected)
        .where(F.col("kind") == "rule")
        .select(
            F.col("code").alias("rule_code"),
            F.col("n").alias("corrections_count"),
            percent(F.col("n"), F.col("corrected"), 1).alias("share_of_corrected"),
        )
        .orderBy(F.desc("corrections_count"), "rule_code")
    )


def percent(part: Column, total: Column, digits: int) -> Column:
    """Share in percent, half up at ``digits`` decimals, through exact integers."""
    scale = 10**digits
    a = part.cast("decimal(38,0)") * (2 * 100 * scale)
    b = total.cast("decimal(38,0)")
    return rounded_quotient(a, b).cast("double") / F.lit(float(scale))


def rounded_quotient(doubled: Column, divisor: Column) -> Column:
    """``round(doubled / 2 / divisor)`` half up for non-negative integers; null for divisor 0."""
    a, b = doubled.cast("decimal(38,0)"), divisor.cast("decimal(38,0)")
    return F.when(b > 0, F.call_function("div", a + b, b * 2))


def _as_map(kind: str) -> Column:
    """The counts of one kind as a map."""
    pairs = F.collect_list(F.when(F.col("kind") == kind, F.struct("code", "n")))
    return F.map_from_entries(F.array_sort(pairs))


def run_counts(
    read_rows: int, raw: DataFrame, classified: DataFrame, actions: DataFrame
) -> DataFrame:
    """One row with every count of a run; all heavy work is partial aggregation.

    ``read_rows`` was counted at the source while the raw layer was written; what arrived there is
    counted in the layer itself, so a lost row shows.
    """
    verdicts = tally(classified).agg(
        _n_of("verdict", "valid").alias("count_valid"),
        _n_of("verdict", "corrected").alias("count_corrected"),
        _n_of("verdict", "quarantined").alias("count_quarantine"),
        _as_map("quarantine").alias("counts_case_error"),
        _as_map("rule").alias("counts_correction_rule"),
    )
    upserted = actions.agg(
        F.struct(
            F.count_if(F.col("action") == INSERTED).alias("inserted"),
            F.count_if(F.col("action") == UPDATED).alias("updated"),
            F.count_if(F.col("action") == UNCHANGED).alias("unchanged"),
        ).alias("u")
    ).scalar()
    keys = (
        classified.where(is_accepted()).select("order_id").distinct()
        .agg(F.count(F.lit(1)).alias("n")).scalar()
    )
    loaded = raw.agg(F.count(F.lit(1)).alias("n")).scalar()
    return verdicts.select(
        F.lit(read_rows).cast("bigint").alias("read_rows"), loaded.alias("loaded_raw"), "*", upserted.alias("u"),
        keys.alias("distinct_accepted"),
    ).select(
        "*",
        F.col("u.inserted").alias("count_inserted"),
        F.col("u.updated").alias("count_updated"),
        F.col("u.unchanged").alias("count_unchanged"),
    ).drop("u")


def run_checks(counts: DataFrame) -> DataFrame:
    """The acceptance checks of a run: all rows that were read are in the raw layer and have a verdict.

    An order that arrives several times in one run is written once, so the exact upsert check
    compares with distinct accepted ids; the comparison with accepted rows is reported too.
    """
    rows = F.col("count_valid") + F.col("count_corrected")
    applied = F.col("count_inserted") + F.col("count_updated") + F.col("count_unchanged")
    return counts.withColumns(
        {
            "consistency_expected_total": rows + F.col("count_quarantine"),
            "consistency_check_passed": (F.col("loaded_raw") == rows + F.col("count_quarantine"))
            & (F.col("read_rows") == F.col("loaded_raw")),
            "upsert_applied": applied == F.col("distinct_accepted"),
            "upsert_matches_rows": applied == rows,
            "idempotent_run": F.col("count_inserted") == 0,
        }
    )


def metrics_row(
    read_rows: int,
    raw: DataFrame,
    classified: DataFrame,
    actions: DataFrame,
    id_run: str,
    file_name: str,
    started: datetime,
    partitions: int,
) -> DataFrame:
    """The run-history record."""
    checked = run_checks(run_counts(read_rows, raw, classified, actions))
    finished = datetime.now(timezone.utc)
    elapsed = round((finished - started).total_seconds(), 3)
    return checked.select(
        F.lit(id_run).alias("id_run"),
        F.lit(file_name).alias("file_name"),
        F.lit("spark").alias("used_engine"),
        F.lit(started).cast("timestamp").alias("started_at"),
        F.lit(finished).cast("timestamp").alias("finished_at"),
        F.lit(elapsed).alias("seconds_elapsed"),
        F.round(F.col("read_rows") / F.lit(max(elapsed, 0.001)), 2)
        .alias("throughput_rows_per_sec"),
        F.lit(partitions).cast("bigint").alias("partitions"),
        "*",
    )


def table_counts(raw: DataFrame, validated: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Row counts per layer and the duplicate alarm of the validated table."""

    def counted(df: DataFrame, name: str, distinct: Column) -> DataFrame:
        return df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("rows_count"),
            distinct.alias("distinct_order_ids"),
        )

    none = F.max(F.lit(None).cast("bigint"))
    df = (
        counted(raw, "orders_raw", none)
        .unionByName(counted(validated, "orders_validated", F.count_distinct("order_id")))
        .unionByName(counted(quarantine, "orders_quarantine", none))
    )
    return df.withColumn(
        "has_duplicates",
        F.coalesce(F.col("rows_count") != F.col("distinct_order_ids"), F.lit(False)),
    )


def reconcile(source: DataFrame, raw: DataFrame, id_run: str) -> DataFrame:
    """Did every source record reach the raw layer of the run?"""
    arrived = raw.where(F.col("id_run") == id_run)
    return source.agg(F.count(F.lit(1)).alias("csv_rows")).select(
        F.lit(id_run).alias("id_run"),
        "csv_rows",
        arrived.agg(F.count(F.lit(1)).alias("n")).scalar().alias("raw_rows"),
    ).withColumns(
        {
            "difference": F.col("csv_rows") - F.col("raw_rows"),
            "all_arrived": F.col("csv_rows") == F.col("raw_rows"),
        }
    )
