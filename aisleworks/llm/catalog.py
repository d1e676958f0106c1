"""One registered query per operator, over whole tables with production settings, and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aisleworks.llm import (
    fill_middle, hard_negatives, html_extract, imatch, license_scan, line_dedup, minhash, mixing, packing, quality, topk,
    toxicity, warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(_table(spark, sf_dir, "pages"))


def op2_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return quality.score(documents, quality.fit(documents, _table(spark, sf_dir, "labels")))


def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprint_edits(_table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.mixed(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = _table(spark, sf_dir, "embeddings")
    return topk.exact_top_k(embeddings, embeddings.filter("vec_id % 50 = 0"), k=5)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.remove_spread_lines(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return cleaned.select("doc_id", "text", "n_lines", "n_removed")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), words=2, percent=80)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", moved))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_digest(_table(spark, sf_dir, "documents"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_html_extraction, op2_warc_normaliser, op3_toxicity, op4_quality, op5_imatch, op6_mixing, op7_packing,
    op8_exact_topk, op9_line_dedup, op10_minhash, op11_hard_negatives, op12_license_scan, op13_fill_middle,
)}

#: DuckDB SQL where SQL can express the operator.
ORACLE: dict[str, str] = {
    "op9_line_dedup": line_dedup.ORACLE_SQL,
    "op11_hard_negatives": hard_negatives.ORACLE_SQL,
    "op13_fill_middle": fill_middle.ORACLE_SQL,
}
