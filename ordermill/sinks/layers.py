"""Append-only layers and split CSV output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.constants import SPLIT_ROWS
from ordermill.operators.sampling import with_position
from ordermill.sinks.files import COMPRESSION
from ordermill.sources.order_csv import ROW_ORDER


def append_run(df: DataFrame, path: str) -> None:
    """Write one run's rows as that run's partition.

    Other runs are untouched. A run that is executed again after a failure replaces its own
    partition, so a retry does not double the history. The caller refuses a run id that other files
    have used (see ``prepare_run``).
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("id_run")
        .option("compression", COMPRESSION)
        .parquet(path)
    )


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def split_rows(df: DataFrame, path: str, rows: int = SPLIT_ROWS) -> None:
    """CSV files of exactly ``rows`` records in source order, each with the header; the last may have fewer.

    The input is a numbered scan; its lineage is not written. Folder ``chunk=n`` holds file n. Every
    row's place in the whole source is exact, so the rows of a file, and of no more than some files,
    meet in one task.
    """
    if rows < 1:
        raise ValueError("rows must be at least 1")
    columns = [c for c in df.columns if c not in (*ROW_ORDER, "file_block_start")]
    numbered = with_position(df).withColumn("chunk", F.expr(f"position div {rows}"))
    (
        numbered.repartition("chunk")
        .sortWithinPartitions("chunk", "position")
        .select(*columns, "chunk")
        .write.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .partitionBy("chunk")
        .mode("errorifexists")
        .csv(path)
    )
