"""Queries of the training-data operators over the given tables, with DuckDB SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

from quillstat.llm import (
    credential_links, decontaminate, exact_dedup, license_scan, main_text, order_minhash, piece_codec, prefix_trie, quality_model, sharding,
    token_files, toxic_crf, whitening,
)
from quillstat.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
WORD_VOCABULARY = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_summary(table(spark, sf_dir, "documents", "doc_id", "text"),
                                     public_tokenizers.path(WORD_VOCABULARY))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract_main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op3_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score_quality(table(spark, sf_dir, "documents", "doc_id", "text"),
                                       table(spark, sf_dir, "labels", "doc_id", "quality"), quality_model.held_out_rows())


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents", "doc_id", "text"),
                                      table(spark, sf_dir, "benchmark", "item_id", "text"))


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_crf.score_toxicity(table(spark, sf_dir, "documents", "doc_id", "text"),
                                    table(spark, sf_dir, "labels", "doc_id", "toxic"), toxic_crf.held_out_rows())


def op9_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.round_trips(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path(PIECE_MODEL))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_notices(table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_rows(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")).drop("turn_md5")


def op13_credential_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credential_links.secret_report(table(spark, sf_dir, "documents", "doc_id", "text"))


def queries() -> dict[str, Query]:
    runs = (op1_token_files, op2_main_text, op3_quality_model, op4_decontamination, op5_order_minhash, op6_sharding, op7_exact_dedup,
            op8_toxicity, op9_piece_codec, op10_license_scan, op11_whitening, op12_prefix_trie, op13_credential_links)
    return {run.__name__: run for run in runs}


def oracle_sql() -> dict[str, str]:
    return {"op4_decontamination": decontaminate.SQL, "op6_sharding": sharding.SQL, "op7_exact_dedup": exact_dedup.SQL,
            "op12_prefix_trie": prefix_trie.SQL}
