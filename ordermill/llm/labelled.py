"""Training rows with labels, for the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ordermill.llm.common import id_bucket, written

FOLDS = 5


def held_out():
    """Rows that no classifier may learn from; a null doc_id counts as the empty text and is held out."""
    return id_bucket("doc_id", FOLDS) == 0


def sample(docs: DataFrame, labels: DataFrame, column: str, most: int) -> DataFrame:
    """(text, label) of training rows whose doc_id is among at most ``most`` labelled ones, smallest hashes first.

    Ids with a null label or with different labels take no part. The chosen ids are broadcast, being
    at most ``most``. Of the rows with one id the text of the smallest hash is taken, so rows are bounded as well.
    """
    known = labels.where(~held_out()).select(F.col("doc_id").cast("long").alias("labelled_id"), F.col(column).cast("int").alias("label"))
    known = known.groupBy("labelled_id").agg(
        F.min("label").alias("label"), F.max("label").alias("other"), F.count_if(F.col("label").isNull()).alias("unknown")
    )
    known = known.where("label = other and unknown = 0 and label in (0, 1)")
    known = known.orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(most).select("labelled_id", "label")
    rows = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("labelled_id"))
    rows = rows.groupBy("labelled_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return written(rows.select("text", "label"), "labelled-sample")
