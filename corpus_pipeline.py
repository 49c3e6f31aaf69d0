"""The corpus pipeline: rules, near-duplicates, benchmark passages, secrets, packing.

Each stage is a function of (spark, docs, sf_dir). All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terravane.llm import decontaminate, packing, quality_rules, secrets, simhash
from terravane.llm.common import shared_folder, table
from terravane.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality_rules.keep_good(docs, "v1")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return simhash.one_of_each(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced by a mark."""
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality),
    ("simhash_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_passages),
    ("secret_scan", secret_scan),
    ("best_fit_packing", packed),
]

#: Fingerprints and token ids are beyond SQL; tests/llm/test_pipeline.py holds every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over documents, each written and read again."""
    import uuid

    docs = table(spark, sf_dir, "documents")
    at = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{k}-{name}")
        docs = spark.read.parquet(f"{at}/{k}-{name}")
    return docs
