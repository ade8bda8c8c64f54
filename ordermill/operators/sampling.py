"""Prefix samples in file order, by rows or by bytes, and exact row numbers.

The position of a row in the whole source is found from one subtotal per input split, summed up
within each file and over the files, so no task ever sorts or scans more than one split's rows, one
file's subtotals or one number a file.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.constants import SAMPLE_ROWS
from ordermill.sources.order_csv import ROW_BLOCK, ROW_ORDER


# A small sample of many files first looks at this much of them.
WIDENING_BYTES = 64 << 20


def csv_line_bytes(columns: list[str]) -> Column:
    """Bytes of a record as an unquoted line: fields, commas and the line break."""
    return sum(
        (F.octet_length(F.coalesce(F.col(f"`{c}`"), F.lit(""))) for c in columns),
        F.lit(len(columns)),
    ).cast("bigint")


def header_bytes(columns: list[str]) -> int:
    return len((",".join(columns) + "\n").encode())


def prefix_while(
    df: DataFrame, weight: Column, target: int, block_rows: int = ROW_BLOCK
) -> DataFrame:
    """Rows, in file order, before which less than ``target`` weight has accumulated.

    Blocks that begin past the target are dropped and blocks that end before it are kept whole;
    only the one block in which the target falls needs a running sum over its rows.
    """
    block = ["file_source", "block"]
    rows = df.withColumn("weight", weight).withColumn(
        "block", F.expr(f"number_row_source div {block_rows}")
    )
    totals = rows.groupBy(*block).agg(F.sum("weight").alias("block_weight"))
    placed = rows.join(block_starts(totals).where(F.col("start") < target), block)
    whole = placed.where(F.col("start") + F.col("block_weight") <= target)
    before_row = (
        Window.partitionBy(*block)
        .orderBy("number_row_source")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    crossed = (
        placed.where(F.col("start") + F.col("block_weight") > target)
        .withColumn("seen", F.coalesce(F.sum("weight").over(before_row), F.lit(0)))
        .where(F.col("start") + F.col("seen") < target)
    )
    return whole.select(*df.columns).unionByName(crossed.select(*df.columns))


def block_starts(totals: DataFrame) -> DataFrame:
    """``totals`` (file_source, block, block_weight) with ``start``, the weight of all blocks before.

    Two levels: blocks within their file, in parallel, and whole files, one number each.
    """
    in_file = Window.partitionBy("file_source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole_files = totals.groupBy("file_source").agg(F.sum("block_weight").alias("file_weight"))
    files_before = Window.orderBy("file_source").rowsBetween(Window.unboundedPreceding, -1)
    files = whole_files.select(
        "file_source", F.coalesce(F.sum("file_weight").over(files_before), F.lit(0)).alias("file_start")
    )
    return totals.withColumn("in_file", F.coalesce(F.sum("block_weight").over(in_file), F.lit(0))).join(
        files, "file_source"
    ).select("file_source", "block", "block_weight", (F.col("file_start") + F.col("in_file")).alias("start"))


def with_position(df: DataFrame) -> DataFrame:
    """``df`` with ``position``, the exact number of its rows that come before in file order.

    The input is a numbered scan (see ``numbered``). Numbers of one split have no gaps, so the least
    one and the count of each split place all its rows.
    """
    block = ["file_source", "block"]
    rows = df.withColumn("block", F.col("file_block_start"))
    totals = rows.groupBy(*block).agg(
        F.count(F.lit(1)).alias("block_weight"), F.min("number_row_source").alias("least")
    )
    starts = block_starts(totals.select(*block, "block_weight")).join(totals.select(*block, "least"), block)
    return rows.join(starts.select(*block, "start", "least"), block).select(
        *df.columns, (F.col("start") + F.col("number_row_source") - F.col("least")).alias("position")
    )


def widening_sample(
    spark: SparkSession, path: str | list[str], rows: int, scan: Callable[[list[str]], DataFrame],
    first_bytes: int = WIDENING_BYTES,
) -> tuple[DataFrame, int]:
    """The first ``rows`` records of many files, and how many of the files were opened.

    Starts with the leading files of the first bytes, known from the listing, and takes four times as
    many bytes until they hold enough rows or are all. ``scan`` reads files with the row order columns.
    """
    listed = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    before = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    seen = listed.withColumn("before", F.coalesce(F.sum("length").over(before), F.lit(0)))
    total, wanted = listed.count(), first_bytes
    while True:
        files = [r["path"] for r in seen.where(F.col("before") < wanted).orderBy("path").collect()]
        lines = scan(files)
        if len(files) == total or lines.limit(rows).count() == rows:
            return prefix_sample(lines, rows), len(files)
        wanted *= 4


def prefix_sample(df: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The first ``rows`` records; the input carries the row order columns."""
    assert set(ROW_ORDER) <= set(df.columns)
    return prefix_while(df, F.lit(1), rows)


def size_sample(df: DataFrame, columns: list[str], target_mb: float) -> DataFrame:
    """Records until their CSV size, header included, reaches the target.

    The record that crosses the target is part of the sample, and so is the first record.
    """
    budget = max(int(target_mb * 1024 * 1024) - header_bytes(columns), 1)
    return prefix_while(df, csv_line_bytes(columns), budget)
