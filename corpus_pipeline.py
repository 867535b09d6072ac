"""Documents to packed sequences: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierline.llm.common import id_bucket
from tierline.llm.credential_scan import redact
from tierline.llm.exact_dedup import drop_exact_duplicates
from tierline.llm.language_id import keep_identified, labelled, learn
from tierline.llm.near_dedup import drop_near_duplicates
from tierline.llm.packing import pack
from tierline.llm.queries import WORD_BPE
from tierline.session import materialise

#: Its first stage learns character models, which SQL can't express.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter and texts that no learned language explains go."""
    return keep_identified(docs, learn(labelled(docs).where(id_bucket(3) != 1)))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest id stays."""
    return drop_near_duplicates(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows stay; secrets are replaced by a mark."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokens with their sequence and place."""
    return pack(docs, WORD_BPE)


STAGES = [
    ("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
    ("secret_scan", secret_scan), ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents below ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
