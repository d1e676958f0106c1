"""From raw documents to packed training sequences, in five stages.

Each stage gets the documents that its predecessor kept, written as Parquet and read again, so a lost executor or a
failed stage costs one stage at most.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aisleworks.llm import line_dedup, minhash, mixing, packing, quality
from aisleworks.llm.shared import stored


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neighbours in the latent space vote good; the rest go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def remove_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many sources share; n_chars follows the text.

    Only a document that has no other line, a copy, stays whole for the next stage.
    """
    cleaned = line_dedup.remove_spread_lines(docs).select(*docs.columns)
    return cleaned.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8."""
    return minhash.without_near_duplicates(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight takes it."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids with their sequence and offset."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", keep_good_quality),
    ("line dedup", remove_boilerplate_lines),
    ("minhash near-dedup", remove_near_duplicates),
    ("source mixing", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: SQL cannot express the classifier, near duplicates, the mix and packing; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents`` after all stages."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
