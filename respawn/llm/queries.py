"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from respawn.llm import (embed_dedup, hash_tree, html_extract, lang_id, line_dedup, mixing, periodic_runs, prefix_trie, secret_scan,
                         sentencepiece_codec, simhash, simhash_dedup, warc_zip)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lang_id.language_id(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "lang_spans")


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sentencepiece_codec.encode_and_check(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.drop("text")


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.embedding_dedup(_table(spark, sf_dir, "embeddings"))


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op6_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zip.archive_round_trip(_table(spark, sf_dir, "pages"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(_table(spark, sf_dir, "documents"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.document_fingerprints(_table(spark, sf_dir, "documents"))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.simhash_dedup(_table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(_table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_report(_table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(_table(spark, sf_dir, "conversations"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.shard_documents(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_language_id, op2_html_extract, op3_sentencepiece, op4_embedding_dedup, op5_mix, op6_warc_zip, op7_secret_scan,
           op8_fingerprints, op9_simhash_dedup, op10_line_dedup, op11_periodic_runs, op12_prefix_trie,
           op13_sharding)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    """The others are tested against brute force, round trips or held-out rows."""
    return {"op5_mix": mixing.ORACLE_SQL, "op6_warc_zip": warc_zip.ORACLE_SQL, "op12_prefix_trie": prefix_trie.ORACLE_SQL,
            "op13_sharding": hash_tree.ORACLE_SQL}
