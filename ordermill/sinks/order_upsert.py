"""Keyed upsert of accepted orders into the validated table."""

from __future__ import annotations

import uuid
from datetime import datetime
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.operators.duplicates import last_wins, repeated_last
from ordermill.schema import BUSINESS_FIELDS, ITEM, MONEY, VALIDATED
from ordermill.sinks.files import delete_path
from ordermill.sinks.keyed_table import (
    BROADCAST_KEYS,
    DELETED,
    INSERTED,
    UNCHANGED,
    UPDATED,
    KeyedTable,
    Snapshot,
    retried,
)
from ordermill.sources.order_csv import ROW_ORDER

# What a changed order contributed before: enough to correct every view without a rescan.
BEFORE = T.StructType(
    [
        T.StructField("old_order_date", T.StringType()),
        T.StructField("old_total_amount", MONEY),
        T.StructField("old_items_norm", T.ArrayType(ITEM)),
    ]
)
_BEFORE_OF = {f"old_{name}": name for name in ("order_date", "total_amount", "items_norm")}


def validated_table(spark: SparkSession, root: str, buckets: int | None = None) -> KeyedTable:
    return KeyedTable(spark, root, "order_id", VALIDATED, BEFORE, buckets)


def order_changes(
    current: DataFrame | None, incoming: DataFrame, id_run: str, now: datetime
) -> DataFrame:
    """Compare incoming rows, one for each order, with the stored ones: inserted, updated or unchanged.

    ``current`` is None for an empty table.
    """
    incoming = incoming.select(*BUSINESS_FIELDS, "items_norm")
    stamp = F.lit(now).cast("timestamp")
    if current is None:
        return incoming.select(
            *BUSINESS_FIELDS,
            F.lit(id_run).alias("last_run_id"),
            stamp.alias("last_updated_at"),
            F.lit(id_run).alias("first_seen_run_id"),
            stamp.alias("created_at"),
            "items_norm",
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in BEFORE],
            F.lit(INSERTED).alias("action"),
        )
    stored, incoming = current.alias("stored"), incoming.alias("incoming")
    joined = incoming.join(
        stored, F.col("incoming.order_id") == F.col("stored.order_id"), "left"
    )
    same = reduce(
        lambda a, b: a & b,
        [F.col(f"incoming.{f}").eqNullSafe(F.col(f"stored.{f}")) for f in BUSINESS_FIELDS],
    )
    action = (
        F.when(F.col("stored.order_id").isNull(), F.lit(INSERTED))
        .when(same, F.lit(UNCHANGED))
        .otherwise(F.lit(UPDATED))
    )
    updated = F.col("action") == UPDATED
    return joined.withColumn("action", action).select(
        *[F.col(f"incoming.{f}").alias(f) for f in BUSINESS_FIELDS],
        F.lit(id_run).alias("last_run_id"),
        stamp.alias("last_updated_at"),
        F.coalesce("stored.first_seen_run_id", F.lit(id_run)).alias("first_seen_run_id"),
        F.coalesce("stored.created_at", stamp).alias("created_at"),
        F.col("incoming.items_norm").alias("items_norm"),
        *[
            F.when(updated, F.col(f"stored.{name}")).alias(old)
            for old, name in _BEFORE_OF.items()
        ],
        "action",
    )


def upsert_orders(
    table: KeyedTable, accepted: DataFrame, id_run: str, now: datetime
) -> tuple[Snapshot, str]:
    """Apply accepted rows; returns the resulting state and the name of the staged change set.

    The last row of each order and the stored rows are shuffled once, by key, to where the change set is
    written; of the stored table only the buckets that these rows fall into are read. The ids of a small
    delivery are broadcast first, so that only their stored rows are shuffled. If another run commits the
    same orders meanwhile, the rows are compared anew.
    """
    path = f"{table.root}/incoming/{uuid.uuid4().hex}"
    lasts = _lasts(accepted, path)

    def attempt() -> tuple[Snapshot, str]:
        base, current = table.snapshot(), None
        bucket = table.bucket(F.col("order_id"), base.buckets)
        counts = dict(accepted.groupBy(bucket).count().collect())
        n = sum(counts.values())
        tasks = table.tasks(base, n)
        incoming = _dealt_last_rows(accepted, lasts, tasks)
        if base.version:
            current = table.read(base, set(counts))
            if n <= BROADCAST_KEYS:
                current = current.join(F.broadcast(accepted.select("order_id")), "order_id", "left_semi")
            current = current.repartition(tasks, "order_id")
        change_set = table.stage(order_changes(current, incoming, id_run, now), base, tasks)
        return table.commit(base, change_set, tag=id_run), change_set

    try:
        return retried(attempt)
    finally:
        delete_path(table.spark, path)


def _dealt_last_rows(accepted: DataFrame, lasts: _Lasts | None, tasks: int) -> DataFrame:
    """The last row of every order, dealt by id; found before that shuffle if ``lasts`` can be broadcast, else after it."""
    wanted = [*BUSINESS_FIELDS, "items_norm"]
    if lasts is not None and lasts.n <= BROADCAST_KEYS:
        return last_wins(accepted, F.broadcast(lasts.rows)).select(*wanted).repartition(tasks, "order_id")
    rows = accepted.select(*wanted, *ROW_ORDER).repartition(tasks, "order_id")
    if lasts is None or lasts.null_ids:
        return last_wins(rows).select(*wanted)
    return last_wins(rows, lasts.rows.hint("shuffle_hash"), null_ids=False).select(*wanted)


class _Lasts(NamedTuple):
    rows: DataFrame
    n: int
    null_ids: bool


def _lasts(accepted: DataFrame, path: str) -> _Lasts | None:
    """The last rows of repeated ids, written so that their number is known; None if lineage does not tell rows apart."""
    lasts = repeated_last(accepted)
    lasts.write.parquet(path)
    lasts = accepted.sparkSession.read.schema(lasts.schema).parquet(path)
    known = lasts.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.max("n"), F.lit(1)).alias("same"),
        (F.count_if(F.col("order_id").isNull()) > 0).alias("null_ids"),
    ).first()
    return None if known["same"] > 1 else _Lasts(lasts, known["n"], known["null_ids"])


def remove_run(table: KeyedTable, id_run: str) -> Snapshot:
    """Delete the orders a run wrote last, whether it inserted or updated them."""

    def attempt() -> Snapshot:
        base = table.snapshot()
        gone = table.read(base).where(F.col("last_run_id") == id_run)
        changes = gone.withColumns(
            {old: F.col(name) for old, name in _BEFORE_OF.items()}
            | {"action": F.lit(DELETED)}
        )
        return table.commit(base, table.stage(changes, base))

    return retried(attempt)


def restore_run(table: KeyedTable, id_run: str) -> Snapshot:
    """Undo what a run wrote: its updates get the rows back that they replaced, its inserts go.

    Orders that a later run changed keep what that run wrote. The earlier rows are read from the version
    before the run's commit, and only the buckets that the run changed. A run that was repeated has
    several commits; the one that wrote the stored row, told by its time, is undone. The row that comes back
    is what was replaced, whichever run had written it. The result is an ordinary change set, so views
    and layouts follow it like any other.
    """

    def attempt() -> Snapshot:
        base = table.snapshot()
        commits = table.versions(id_run)
        if not commits:
            return base
        changed, earlier = [], []
        for commit in commits:
            before = table.before(commit)
            written = table.changes(before.version, commit.version)
            bucket = table.bucket(F.col("order_id"), before.buckets)
            touched = {row[0] for row in written.select(bucket).distinct().collect()}
            version = F.lit(commit.version).alias("undone")
            changed.append(written.select("order_id", "last_updated_at", version))
            earlier.append(table.read(before, touched).select("order_id", version, F.struct("*").alias("earlier")))
        changed, earlier = (reduce(DataFrame.unionByName, parts) for parts in (changed, earlier))
        now = table.read(base).where(F.col("last_run_id") == id_run)
        now = now.select("order_id", "last_updated_at", F.struct("*").alias("now"))
        undone = now.join(changed, ["order_id", "last_updated_at"]).join(earlier, ["order_id", "undone"], "left")
        known = F.col("earlier").isNotNull()
        changes = undone.select(
            "order_id",
            *[F.col(f"earlier.{f}").alias(f) for f in VALIDATED.names if f != "order_id"],
            *[F.col(f"now.{name}").alias(old) for old, name in _BEFORE_OF.items()],
            F.when(known, F.lit(UPDATED)).otherwise(F.lit(DELETED)).alias("action"),
        )
        return table.commit(base, table.stage(changes, base))

    return retried(attempt)
