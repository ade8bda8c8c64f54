"""The registered queries of this subpackage and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from ordermill.llm import (
    ann, centroids, decontamination, language_id, lexical, line_dedup, lm_scoring, packing, quality, quality_rules, simhash, toxicity, warc,
)
from ordermill.llm.common import read_table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), with_ids=False).drop("ids")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_lines", "n_dropped", digest)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive(spark, read_table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(read_table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.contamination(documents, read_table(spark, sf_dir, "benchmark"))
    items = F.concat_ws(",", F.array_sort("found.items"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(items, 256).alias("items_sha256"), "contaminated"
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    found = language_id.identify_documents(documents)
    return found.select(F.col("carried.doc_id"), "language", "probability", "accepted")


def page_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = language_id.identify(pages, **language_id.page_columns(pages), carry=("page_id",))
    return found.select(F.col("carried.page_id"), "language", "probability", "accepted")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents")).drop("lang", "source")


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(read_table(spark, sf_dir, "embeddings")).drop("compared")


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_packing": op1_packing,
        "op2_line_dedup": op2_line_dedup,
        "op3_warc": op3_warc,
        "op4_lm_scoring": op4_lm_scoring,
        "op5_quality": op5_quality,
        "op6_decontamination": op6_decontamination,
        "op7_toxicity": op7_toxicity,
        "op8_nearest": op8_nearest,
        "op9_language_id": op9_language_id,
        "page_language": page_language,
        "op10_simhash": op10_simhash,
        "op11_quality_rules": op11_quality_rules,
        "op12_centroids": op12_centroids,
        "op13_lexical": op13_lexical,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return sql | {
        "op2_line_dedup": line_dedup.ORACLE,
        "op3_warc": warc.ORACLE,
        "op6_decontamination": decontamination.ORACLE,
        "op11_quality_rules": quality_rules.ORACLE,
        "op12_centroids": centroids.ORACLE,
        "op13_lexical": lexical.ORACLE,
    }
