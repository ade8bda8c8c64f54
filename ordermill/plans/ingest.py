"""One ingest run: raw layer, rules, quarantine, upsert, run metrics.

The rule results are written once to a staging folder of the run and read back, column-pruned,
by every later step, so the expensive part (JSON, regular expressions) is computed once and a
lost executor costs a re-read, not a re-computation. Raw records are in there only where an error
sends them to quarantine; the raw layer has them all.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.operators.classify import (
    LINEAGE, accepted, add_verdict, apply_rules, quarantined, without_accepted_records,
)
from ordermill.operators.duplicates import conflicting_rows
from ordermill.operators.run_accounting import metrics_row
from ordermill.plans.store import OrderStore
from ordermill.sinks.files import COMPRESSION, delete_path, read_parquet
from ordermill.sinks.layers import append_run
from ordermill.sinks.order_upsert import remove_run, restore_run, upsert_orders
from ordermill.sources.order_csv import ROW_ORDER, raw_records

_CONFLICTS = T.StructType(
    [T.StructField("file_source", T.StringType()), T.StructField("number_row_source", T.LongType())]
)


@dataclass(frozen=True)
class RunResult:
    id_run: str
    version: int
    change_set: str


def ingest_files(
    store: OrderStore,
    path: str | list[str],
    id_run: str,
    encoding: str = "UTF-8",
    multi_line: bool = False,
    partitions: int = 0,
    column_map: dict[str, str] | None = None,
) -> RunResult:
    """Run the whole pipeline on CSV files."""
    envelope = raw_records(store.spark, path, id_run, encoding, multi_line, column_map)
    if partitions > 0:
        envelope = envelope.repartition(partitions)
    return ingest(store, envelope, id_run, str(path))


def _quarantined(raw: DataFrame, ruled: DataFrame, conflicts: DataFrame, path: str) -> DataFrame:
    """Quarantine records of a run whose rule results lack the raw records of rows without errors.

    Those of rows that conflict, few in all but pathological runs, are copied from the raw layer to ``path``.
    Should their lineage not tell them apart, they go through the rules again.
    """
    raw.join(conflicts, ROW_ORDER, "left_semi").select(*LINEAGE, "record_raw").write.mode("overwrite").option(
        "compression", COMPRESSION
    ).parquet(path)
    records = raw.sparkSession.read.schema(raw.select(*LINEAGE, "record_raw").schema).parquet(path)
    has_errors = F.size("errors") > 0
    if records.groupBy(*ROW_ORDER).count().where("count > 1").isEmpty():
        conflicting = ruled.where(~has_errors).join(conflicts, ROW_ORDER, "left_semi").drop("record_raw")
        conflicting = conflicting.join(records.select(*ROW_ORDER, "record_raw"), ROW_ORDER)
    else:
        conflicting = apply_rules(records).where(~has_errors)
    return quarantined(add_verdict(ruled.where(has_errors).unionByName(conflicting), conflicts))


def _files(records: DataFrame) -> DataFrame:
    return records.select("file_source").distinct()


def prepare_run(store: OrderStore, envelope: DataFrame, id_run: str) -> None:
    """Make way for a repeated run; refuse a run id that other files have used.

    Only the files of the earlier attempt, all of them and no others, make a repetition. What it
    left in quarantine goes, because the new attempt may quarantine nothing.
    """
    before = store.raw().where(F.col("id_run") == id_run)
    if before.isEmpty():
        return
    old, new = _files(before), _files(envelope)
    if not old.exceptAll(new).isEmpty() or not new.exceptAll(old).isEmpty():
        raise ValueError(f"run id {id_run} was used for other files; every run needs an id of its own")
    delete_path(store.spark, f"{store.path('orders_quarantine')}/id_run={id_run}")


def ingest(
    store: OrderStore, envelope: DataFrame, id_run: str, file_name: str = ""
) -> RunResult:
    """Run the whole pipeline on raw records; repeating a run changes nothing further."""
    started = datetime.now(timezone.utc)
    prepare_run(store, envelope, id_run)
    read = Observation("read")
    append_run(envelope.observe(read, F.count(F.lit(1)).alias("rows")), store.path("orders_raw"))
    raw = store.raw().where(F.col("id_run") == id_run)

    staging = store.path(f"staging/{id_run}")
    ruled = apply_rules(raw)
    without_accepted_records(ruled).write.mode("overwrite").option("compression", COMPRESSION).parquet(f"{staging}/ruled")
    ruled = store.spark.read.schema(ruled.schema).parquet(f"{staging}/ruled")
    conflicting_rows(ruled).select(*ROW_ORDER).write.mode("overwrite").parquet(
        f"{staging}/conflicts"
    )
    conflicts = read_parquet(store.spark, [f"{staging}/conflicts"], _CONFLICTS)
    classified = add_verdict(ruled, conflicts)

    now = datetime.now(timezone.utc)
    append_run(
        _quarantined(raw, ruled, conflicts, f"{staging}/conflicting").withColumn("quarantined_at", F.lit(now).cast("timestamp")),
        store.path("orders_quarantine"),
    )
    snapshot, change_set = upsert_orders(
        store.validated_table, accepted(classified), id_run, now
    )
    metrics = metrics_row(
        read.get["rows"],
        raw,
        classified,
        store.validated_table.actions(_effective(store, id_run, change_set)),
        id_run=id_run,
        file_name=file_name,
        started=started,
        partitions=ruled.rdd.getNumPartitions(),
    )
    append_run(metrics, store.path("run_metrics"))
    delete_path(store.spark, staging)
    return RunResult(id_run, snapshot.version, change_set)


def _effective(store: OrderStore, id_run: str, change_set: str) -> str:
    """The change set whose actions count for a run.

    A run that died after its commit, before its metrics, finds all its rows unchanged when it is run
    again; what it did is in the change set it committed.
    """
    if store.run_metrics().where(F.col("id_run") == id_run).isEmpty():
        committed = store.validated_table.tagged(id_run)
        if committed is not None:
            return committed.change_set
    return change_set


def discard(store: OrderStore, id_run: str) -> None:
    """Forget a run that failed before its commit: its raw and quarantine records and its staging."""
    for layer in ("orders_raw", "orders_quarantine"):
        delete_path(store.spark, f"{store.path(layer)}/id_run={id_run}")
    delete_path(store.spark, store.path(f"staging/{id_run}"))


def rollback(store: OrderStore, id_run: str, restore: bool = False) -> None:
    """Remove a failed run: the orders it wrote last and its quarantine records.

    With ``restore``, orders that it updated get the rows back that they had before.
    """
    (restore_run if restore else remove_run)(store.validated_table, id_run)
    delete_path(store.spark, f"{store.path('orders_quarantine')}/id_run={id_run}")
