"""The corpus pipeline: quality classifier, line dedup, SimHash near-dedup, substring dedup, packing.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read again as the next stage's docs.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklode.llm import lines, packing, quality, simhash, substrings, tokens
from tracklode.llm.queries import vocabulary_path
from tracklode.sources.scratch import Scratch, delete, scratch_path

#: The vocabulary whose tokens are packed.
VOCABULARY = "byte_bpe_50k.json"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go; ``n_chars`` follows where a text got shorter.

    Copies count as one page: else a large group of them would lose all its lines, in the one that stays too.
    """
    cleaned = lines.drop_boilerplate(docs, Scratch(spark), copies_once=True)
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", n_chars).select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest id."""
    return simhash.keep_one(docs, Scratch(spark))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 20 words that also start earlier are cut from the texts."""
    return substrings.cut(docs, Scratch(spark))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces, buckets and batches of what is left, by exact token counts."""
    return packing.pack(tokens.count_tokens(docs, vocabulary_path(VOCABULARY)), Scratch(spark), length=F.col("n_tokens"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("substring dedup", substring_dedup),
    ("packing", pack),
]

#: No SQL expresses the classifier; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, "stage-" + name.replace(" ", "-").lower())
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        delete(spark, before)
        before = path
    return docs
