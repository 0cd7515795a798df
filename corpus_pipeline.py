"""Corpus pipeline: quality rules, n-gram Jaccard join, benchmark decontamination, PII, SentencePiece encoding.

Each stage takes the documents that its predecessor kept and returns the same columns, but the last,
which returns doc_id, ids, n_tokens and the digests of ids and decoded text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarnwork.llm import decontaminate, ngram_join, pii, piece_bpe, quality_rules
from tarnwork.llm.common import fresh_dir, remove_dir


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the rules reject go."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar documents stays, the one with the smallest id."""
    return ngram_join.keep_one(docs)


def _decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaky(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind in brackets."""
    return pii.redact(docs)


def _encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text, their number, and digests of ids and of the decoded text."""
    import public_tokenizers

    return piece_bpe.encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id"], outputs=("n_tokens", "ids", "ids_sha256", "decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", _quality),
    ("ngram_join", _one_of_each),
    ("decontaminate", _decontaminated),
    ("pii", _redacted),
    ("piece_bpe", _encoded),
]
ORACLE_SQL = None  # tested against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's rows are written to the shared folder as Parquet and read again by the next, then removed; the last input stays for the result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    top = fresh_dir(spark, "pipeline")
    before = None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{top}/{name}")
        docs = spark.read.parquet(f"{top}/{name}")
        if before:
            remove_dir(spark, before)
        before = f"{top}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
