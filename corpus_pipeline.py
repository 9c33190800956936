"""From raw documents to token ids: quality, near-duplicates, benchmark passages, secrets, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last return the columns
of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sheafmill.llm import bpe, decontaminate, near_copies, quality, secrets
from sheafmill.llm.common import documents, keep


def keep_good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, quality.quality_labels(spark, sf_dir))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (Jaccard similarity of five-word shingles 0.8 or more) stays, the one with the smallest doc_id."""
    return near_copies.drop_near_copies(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark."""
    return secrets.redact_secrets(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, exact): token ids, and whether decoding them gives the text again."""
    return bpe.token_ids(docs)


STAGES = [
    ("quality classifier", keep_good_documents),
    ("near-dedup", keep_one_of_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("secret scans", redact_secrets),
    ("byte-level BPE", encode),
]

#: SQL can't express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = keep(docs, f"stage-{number + 1}")
    return docs
