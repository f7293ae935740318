"""The training-data pipeline: from documents to packed sequences, one operator a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadloom.llm import decontaminate, jaccard_join, packing, secrets, toxicity
from loadloom.llm.graphs import written


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labelled ones that are not held out."""
    return toxicity.drop_toxic(docs, toxicity.train_on_rest(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by similarity, the document with the smallest id stays."""
    return jaccard_join.one_of_each(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced; every document stays."""
    return secrets.redacted(docs, secrets.scan(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_leaks),
    ("secrets", secret_scan),
    ("packing", packed),
]
#: SQL can express neither a trained model nor the edit distance search.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each works on all that the one before kept, written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
