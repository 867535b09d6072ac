"""Exact deduplication by content hash, with the bytes compared inside each hash group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import texts
from tierline.session import materialise


def content_hash(text: Column) -> Column:
    """128 bits of the text."""
    return F.unhex(F.md5(text.cast("binary")))


def text_classes(docs: DataFrame, hashed: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per different text: its hash, its sha256, the largest id that has it, and how many rows do.

    Rows meet by (hash, text): a row joins a class only if its bytes equal the key's, so texts whose hashes collide
    stay apart. Copies are combined in the map tasks; a text that a third of all rows share sends one row per task.
    """
    return (
        texts(docs)
        .groupBy(hashed(F.col("text")).alias("hash"), "text")
        .agg(F.count(F.lit(1)).alias("group_size"), F.max("doc_id").alias("keep_id"))
        .select("hash", F.unhex(F.sha2("text", 256)).alias("sha"), "keep_id", "group_size")
    )


def exact_duplicates(docs: DataFrame, hashed: Callable[[Column], Column] = content_hash) -> DataFrame:
    """Every row with the id that stays for its text (the largest), the size of its group and whether it stays.

    Null text counts as empty, so null and empty texts are one group. Rows that repeat the id that stays all stay;
    where all ids of a text are null they all stay, with a null ``keep_id``. Columns besides id and text are ignored.
    The classes are written once; their rows are small, and a hot class on the other side of the join can be split.
    """
    classes = materialise(text_classes(docs, hashed), "text-classes")
    rows = texts(docs).select("doc_id", hashed(F.col("text")).alias("hash"), F.unhex(F.sha2("text", 256)).alias("sha"))
    return rows.join(classes, ["hash", "sha"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_ids(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose id occurs in ``kept`` (one column, any name; null matches null)."""
    ids = kept.toDF("kept__id").distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["kept__id"]), "left_semi")


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that have an equal text under a larger id; of a text without any id all rows stay."""
    classes = text_classes(docs).select(F.col("sha").alias("kept__sha"), F.col("keep_id").alias("kept__id"))
    keyed = docs.withColumn("text__sha", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)))
    same = (keyed["text__sha"] == classes["kept__sha"]) & keyed["doc_id"].eqNullSafe(classes["kept__id"])
    return keyed.join(classes, same, "left_semi").drop("text__sha")
