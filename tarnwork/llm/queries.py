"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import conversation_repair, decontaminate, near_dedup, ngram_join, pii, prefix_trie, quality_model, quality_rules, token_counts, token_store, url_filter, warc


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_read(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"), keep=["doc_id"])


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(_read(spark, sf_dir, "documents"))


def op3_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import piece_bpe

    return piece_bpe.encode_texts(_read(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"), keep=["doc_id"], outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_classes(_read(spark, sf_dir, "documents"))


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store_tokens(_read(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score_quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_read(spark, sf_dir, "pages"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(_read(spark, sf_dir, "pages")).drop("url")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(_read(spark, sf_dir, "conversations"))


def op12_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_copies(_read(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.damage_and_repair(_read(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_pii": op2_pii,
    "op3_piece_bpe": op3_piece_bpe,
    "op4_ngram_join": op4_ngram_join,
    "op5_token_store": op5_token_store,
    "op6_quality_model": op6_quality_model,
    "op7_quality_rules": op7_quality_rules,
    "op8_url_filter": op8_url_filter,
    "op9_decontaminate": op9_decontaminate,
    "op10_warc": op10_warc,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_near_dedup": op12_near_dedup,
    "op13_conversation_repair": op13_conversation_repair,
}


def oracle_sql() -> dict[str, str]:
    return {
        "op8_url_filter": url_filter.oracle(),
        "op11_prefix_trie": prefix_trie.ORACLE_SQL,
        "op12_near_dedup": near_dedup.ORACLE_SQL,
        "op10_warc": """
SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, d AS payload_digest,
  CASE WHEN octet_length(encode(h)) >= 100 AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN octet_length(encode(h)) >= 100 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM (SELECT page_id, h, d, min(page_id) OVER (PARTITION BY d) AS first
  FROM (SELECT page_id, coalesce(html, '') AS h, sha256(coalesce(html, '')) AS d FROM pages))""",
    }
