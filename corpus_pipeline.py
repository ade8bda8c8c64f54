"""A training corpus from raw documents: five stages, each written as Parquet and read again by the next.

``documents`` has doc_id, text, lang, source and n_chars (the text's length in code points, kept
current). Rows are never sampled; every stage sees all rows that its predecessor kept.

* language_id: rows whose language stays undetermined go (see ``ordermill.llm.language_id``).
* line_dedup: lines found in at least ten documents go; a document that loses all lines stays, empty.
* near_dedup: of each SimHash component, the row with the smallest doc_id stays, null last; rows that
  repeat it go too.
* decontamination: contaminated documents go, hit spans in the others are cut out.
* packing: one row per piece of a document, placed in sequences of at most 2048 ids, with its ids.

Extra columns are carried through all stages but the last with their values, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ordermill.llm import decontamination, language_id, line_dedup, packing, simhash
from ordermill.llm.common import read_table, written


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text where the table has it."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


#: What stages read and write; other columns of a table are its own.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _beside_extras(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``stage`` applied to rows whose extra columns have names that no stage uses; then they get theirs back."""
    passing = {c: c if c in COLUMNS else f"extra_{i}" for i, c in enumerate(docs.columns)}
    result = stage(docs.select([F.col(f"`{c}`").alias(name) for c, name in passing.items()]))
    return result.select([F.col(name).alias(c) for c, name in passing.items()])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _beside_extras(docs, language_id.keep_identified)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _beside_extras(docs, lambda rows: _measured(line_dedup.dedup_lines(rows)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _beside_extras(docs, simhash.keep_representatives)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = read_table(spark, sf_dir, "benchmark")
    return _beside_extras(docs, lambda rows: _measured(decontamination.decontaminate(rows, benchmark)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("packing", pack_sequences),
]

#: Tokenizer ids and fingerprints are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
