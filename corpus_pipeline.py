"""A corpus from raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a frame that is stored as Parquet and read
again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from estrato.llm import decontaminate, jaccard, packing, quality, secrets
from estrato.llm.common import table
from estrato.llm.queries import tokenizer_path
from estrato.workspace import freeze


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.keep_good(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, 0.8) one row of the least doc_id stays."""
    return jaccard.keep_first(docs, once=True)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark, or an edited copy of one, go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; all documents stay."""
    return secrets.redact(docs)


def vector_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 4096 ids, one row per piece of a document."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("benchmark_leaks", benchmark_leaks),
    ("secret_scan", secret_scan),
    ("vector_packing", vector_packing),
]

# Word hashes, alignment and tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = freeze(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
