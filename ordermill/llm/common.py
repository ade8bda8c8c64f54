"""Small helpers shared by the operators: tables, written intermediates, batches, columns."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ordermill.session import fresh_dir

#: ``[\x20\x09-\x0D]``, the blanks of all contracts; ``bytes.split()`` and ``bytes.strip()`` use the same set.
BLANKS = " \t\n\x0b\x0c\r"

#: Rows with very long texts must not pile up in one Arrow batch.
BATCH_BYTES = "4m"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Limit Arrow batches to Python by bytes, besides Spark's limit by rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: cut lineage that outlives any executor."""
    path = fresh_dir(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Shared:
    """A broadcast object of any class; each task opens it once."""

    def __init__(self, spark: SparkSession, value: object):
        self.data = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self) -> object:
        if "opened" not in self.__dict__:
            self.opened = pickle.loads(self.data.value)
        return self.opened


def text_bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a text column; null is empty."""
    values = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
    return [v or b"" for v in values.to_pylist()]


def id_bucket(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text (bucket 0)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def row_key(*columns: str) -> Column:
    """128 bits over the given columns, nulls told from empty: equal for repeated rows, which then get equal results."""
    parts = [F.struct(F.col(c).isNull(), F.col(c)) for c in columns]
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(1), *parts).alias("b"))


def in_blocks(texts: list[bytes], lead: bytes, size: int = 1 << 18) -> Iterator[tuple[list[int], list[bytes]]]:
    """Owners and parts of texts, about ``size`` bytes at once; a longer text comes in several parts.

    Every part starts with ``len(lead)`` bytes of context: ``lead`` itself or the text's bytes before the part.
    """
    owners, parts, held = [], [], 0
    for owner, text in enumerate(texts):
        text = lead + text
        for low in range(0, len(text) - len(lead), size):
            owners.append(owner)
            parts.append(text[low : low + len(lead) + size])
            held += len(parts[-1])
            if held >= size:
                yield owners, parts
                owners, parts, held = [], [], 0
    if parts:
        yield owners, parts


def gram_codes(parts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """For every byte after each part's first ``order``: it and the ``order`` bytes before it as one number, and the part."""
    buffer = np.frombuffer(b"".join(parts), dtype=np.uint8).astype(np.uint64)
    code = buffer.copy()
    for k in range(1, order + 1):
        code[k:] |= buffer[:-k] << np.uint64(8 * k)
    sizes = np.array([len(p) - order for p in parts])
    part = np.repeat(np.arange(len(parts)), sizes)
    return code[np.arange(len(part)) + order * (part + 1)], part
