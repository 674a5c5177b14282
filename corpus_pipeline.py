"""From raw documents to packed training sequences.

``STAGES`` are applied one after the other: what a stage returns is written as
Parquet and read again as the next one's documents. All but the last return the
columns of ``documents``. Every stage is one operator of ``earshot.llm`` with its
production parameters. Nulls in any column, empty and very long texts, repeated rows and extra
columns pass through the stages as they are; of an empty table every stage makes an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from earshot.llm import decontamination, exact_dedup, jaccard_join, packing, toxicity
from earshot.session import scratch_path, scratch_removed


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; texts that are null or empty have no feature and stay."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays (null last; of rows that share it the one read first); null counts as empty."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of similar shingle sets connect the smallest doc_id stays; texts without words all stay."""
    return jaccard_join.one_per_class(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item stands go; null and empty texts hold none, an empty benchmark takes none."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of what is left, with their places in sequences; a null or empty text is its end id."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).withColumnRenamed("payload", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# The classifier and the differencing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last one. What a stage wrote on the way is deleted behind it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        with scratch_removed(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
