"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each result as Parquet to the
shared folder and reads it again as the next stage's docs. Stages but the last keep the columns of docs,
whatever their names; null ids and texts, repeated rows and empty tables are treated as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebar.llm import common, exact_dedup, mixing, near_dedup, packing, quality


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.3 or more; null and empty texts are scored as an empty line."""
    field = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(quality.quality_score(docs, field) >= 0.3)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one of the smallest id."""
    return exact_dedup.keep_first(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8 or more), the document of the smallest id."""
    return near_dedup.keep_first(docs, words=5, percent=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes; a document without words is taken once."""
    return mixing.mixed_copies(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens. The word store is small, as workers share memory with the stages before."""
    return packing.pack(docs, packing.tokenizer_file(), [F.col("doc_id")], store=16 << 20)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL expresses neither the classifier nor the signatures nor the dynamic programme; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
