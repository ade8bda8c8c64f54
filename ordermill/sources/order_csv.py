"""All-string CSV scan with lineage."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.constants import COLUMN_MAP
from ordermill.schema import all_string

# Row order inside a run: the file, then the row number within it.
ROW_ORDER = ["file_source", "number_row_source"]

# Rows of one input split have numbers inside one block of this many.
ROW_BLOCK = 1 << 27

# Header lines read at the same time.
HEADER_READERS = 16

_INDEX_IN_PARTITION = (1 << 33) - 1


def _names(line: str) -> list[str]:
    """Column names of a header line; blank and repeated ones get their position, as Spark names them."""
    names = next(csv.reader([line.removeprefix("\ufeff")]), [])
    seen = [n.lower() for n in names]
    return [
        f"_c{i}" if not n else f"{n}{i}" if seen.count(n.lower()) > 1 else n for i, n in enumerate(names)
    ]


def _header_line(spark: SparkSession, file: str, encoding: str) -> str | None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI.create(file))
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    stream = path.getFileSystem(conf).open(path)
    stream = codec.createInputStream(stream) if codec else stream
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, encoding))
    try:
        return reader.readLine()
    finally:
        reader.close()


def files_by_header(
    spark: SparkSession, path: str | list[str], encoding: str = "UTF-8"
) -> list[tuple[list[str], list[str]]]:
    """Column names and the files whose header line states them, in order of the first such file.

    Reads the first line of every file; a file without any line has no records and is left out.
    """
    files = sorted(spark.read.format("binaryFile").load(path).inputFiles())
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        lines = list(pool.map(lambda f: _header_line(spark, f, encoding), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines):
        if line is not None:
            groups.setdefault(tuple(_names(line)), []).append(unquote(file))
    return [(list(columns), found) for columns, found in groups.items()]


def _scan(
    spark: SparkSession, path: str | list[str], columns: list[str], encoding: str, multi_line: bool
) -> DataFrame:
    return (
        spark.read.schema(all_string(columns))
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", encoding)
        .option("multiLine", multi_line)
        .csv(path)
    )


def scan_orders(
    spark: SparkSession,
    path: str | list[str],
    encoding: str = "UTF-8",
    multi_line: bool = False,
) -> DataFrame:
    """Every field as text, named by each file's own header, nothing inferred.

    Columns that some files lack are null in their rows. Quoted fields use doubled quotes. Embedded
    line breaks need ``multi_line``, which makes a file unsplittable, so it is off by default.
    """
    groups = files_by_header(spark, path, encoding)
    if len(groups) == 1:
        return _scan(spark, path, groups[0][0], encoding, multi_line)
    scans = [_scan(spark, files, columns, encoding, multi_line) for columns, files in groups]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def row_number_source(block_start: Column) -> Column:
    """An increasing, gap-tolerant row number within its file, without any shuffle.

    It is the byte offset of the row's input split plus the row's index in the task. A record
    of this format takes more bytes than its index counts, so numbers of one split end before
    those of the next one begin.
    """
    return block_start + F.monotonically_increasing_id().bitwiseAND(F.lit(_INDEX_IN_PARTITION))


def map_columns(df: DataFrame, column_map: dict[str, str] | None = None) -> DataFrame:
    """Logical field names; a field whose column is absent becomes null."""
    column_map = column_map or COLUMN_MAP
    return df.select(
        *[
            (F.col(f"`{physical}`") if physical in df.columns else F.lit(None).cast("string"))
            .alias(logical)
            for logical, physical in column_map.items()
        ]
    )


def record_raw(df: DataFrame, column_map: dict[str, str] | None = None) -> Column:
    """The untouched record as one struct of logical fields."""
    column_map = column_map or COLUMN_MAP
    return F.struct(
        *[
            (F.col(f"`{physical}`") if physical in df.columns else F.lit(None).cast("string"))
            .alias(logical)
            for logical, physical in column_map.items()
        ]
    )


def record_extra(df: DataFrame, column_map: dict[str, str] | None = None) -> Column:
    """What the record states in columns outside the map, by column name; null if there are none."""
    known = {*(column_map or COLUMN_MAP).values(), "file_source", "file_block_start"}
    pairs = [x for c in df.columns if c not in known for x in (F.lit(c), F.col(f"`{c}`"))]
    if not pairs:
        return F.lit(None).cast("map<string,string>")
    return F.map_filter(F.create_map(*pairs), lambda _, value: value.isNotNull())


def with_lineage(scan: DataFrame) -> DataFrame:
    """Add the file and the split of every record; works on batch and streaming scans."""
    return scan.select(
        "*",
        F.col("_metadata.file_path").alias("file_source"),
        F.col("_metadata.file_block_start").alias("file_block_start"),
    )


def numbered(lines: DataFrame) -> DataFrame:
    """A scan with lineage and the row order columns; must directly follow the scan."""
    return lines.withColumn("number_row_source", row_number_source(F.col("file_block_start")))


def raw_envelope(
    df: DataFrame, id_run: str, column_map: dict[str, str] | None = None
) -> DataFrame:
    """Wrap a scan with lineage into raw-layer records; must directly follow the scan."""
    return df.select(
        F.lit(id_run).alias("id_run"),
        "file_source",
        row_number_source(F.col("file_block_start")).alias("number_row_source"),
        F.current_timestamp().alias("at_ingested"),
        F.lit("spark").alias("engine_used"),
        record_raw(df, column_map).alias("record_raw"),
        record_extra(df, column_map).alias("record_extra"),
    )


def raw_records(
    spark: SparkSession,
    path: str | list[str],
    id_run: str,
    encoding: str = "UTF-8",
    multi_line: bool = False,
    column_map: dict[str, str] | None = None,
) -> DataFrame:
    """Raw-layer records of all files, each read by its own header."""
    envelopes = [
        raw_envelope(with_lineage(_scan(spark, files, columns, encoding, multi_line)), id_run, column_map)
        for columns, files in files_by_header(spark, path, encoding)
    ]
    if not envelopes:
        raise ValueError(f"no header line in {path}")
    return reduce(DataFrame.union, envelopes)


def preview(spark: SparkSession, path: str, rows: int = 5, encoding: str = "UTF-8") -> DataFrame:
    """The first rows of the first file, read from its beginning only, and the column count."""
    columns, files = files_by_header(spark, path, encoding)[0]
    first = _scan(spark, files[0], columns, encoding, False)
    return first.limit(rows).withColumn("column_count", F.lit(len(columns)).cast("bigint"))
