"""One query per operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tierline.llm import brown_lm
from tierline.llm.common import id_bucket
from tierline.llm.conversation_repair import damaged, repair
from tierline.llm.credential_scan import find_secrets
from tierline.llm.exact_dedup import exact_duplicates
from tierline.llm.fingerprint import fingerprint_pairs
from tierline.llm.language_id import identify, labelled, learn
from tierline.llm.merkle import audited, tampered_text
from tierline.llm.near_dedup import near_duplicates
from tierline.llm.oracle import ORACLE
from tierline.llm.packing import pack
from tierline.llm.sentence_pieces import encode_pieces
from tierline.llm.token_count import token_counts
from tierline.llm.token_store import token_store
from tierline.llm.url_filter import judge

__all__ = ["ORACLE", "QUERIES"]

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir))


def op2_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(documents(spark, sf_dir), PIECES)


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store(documents(spark, sf_dir), BYTE_BPE)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), WORD_BPE)


def op5_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.learn_and_score(documents(spark, sf_dir), id_bucket(7) == 2)


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = documents(spark, sf_dir), id_bucket(3) == 1
    return identify(docs, learn(labelled(docs).where(~held_out)), held_out)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(documents(spark, sf_dir))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_pairs(documents(spark, sf_dir))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), PIECES)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(documents(spark, sf_dir), tampered_text())


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair(conversations, damaged(conversations))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_exact_dedup, op2_sentence_pieces, op3_token_store, op4_best_fit_packing, op5_class_lm, op6_near_dedup, op7_language_id,
        op8_secret_scan, op9_fingerprints, op10_token_counts, op11_merkle_manifest, op12_conversation_repair, op13_url_filter,
    )
}
