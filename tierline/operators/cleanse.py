"""Filters, defaults, derived columns and the newest copy per snapshot key."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline import functions as fn
from tierline.plans.contracts import COUNTERS, LANDED_AT, SNAPSHOT_KEY, SOURCE_FILE, STATISTICS_COLUMNS

WATCHED = ("video_id", "title", "channel_title", "views")


def drop_null_key(df: DataFrame) -> DataFrame:
    return df.where(F.col("video_id").isNotNull())


def normalise_region(df: DataFrame) -> DataFrame:
    return df.withColumn("region", fn.clean_region(F.col("region")))


def parse_trending_date(df: DataFrame) -> DataFrame:
    return df.withColumn("trending_date_parsed", fn.trending_day(F.col("trending_date")))


def zero_fill(df: DataFrame) -> DataFrame:
    return df.fillna(0, subset=list(COUNTERS))


def add_ratios(df: DataFrame) -> DataFrame:
    views, likes, dislikes, comments = (F.col(c) for c in COUNTERS)
    return df.withColumns(
        {
            "like_ratio": fn.like_ratio(views, likes),
            "engagement_rate": fn.engagement_rate(views, likes, dislikes, comments),
        }
    )


def audit_columns(df: DataFrame, job_name: str, as_of: datetime | None = None) -> DataFrame:
    stamp = F.current_timestamp() if as_of is None else F.lit(as_of)
    return df.withColumns({"_processed_at": stamp, "_job_name": F.lit(job_name)})


def _newest_first(df: DataFrame, latest: Sequence[str], key: Sequence[str]) -> list[Column]:
    """Newest first; equal stamps are settled by the row's own values, so the survivor is fixed."""
    values = [c for c in (LANDED_AT, SOURCE_FILE, *STATISTICS_COLUMNS) if c not in (*latest, *key)]
    return [F.col(c).desc_nulls_last() for c in (*latest, *values) if c in df.columns]


def dedup_latest(
    df: DataFrame, latest: Sequence[str] = (LANDED_AT, SOURCE_FILE), key: Sequence[str] = SNAPSHOT_KEY
) -> DataFrame:
    """One row per key, the newest.

    The rank filter right above the window lets Spark keep one row per key in
    every map task before the shuffle, so a key with very many copies sends at
    most one row per task to its reducer.
    """
    newest = Window.partitionBy(*key).orderBy(*_newest_first(df, latest, key))
    return df.withColumn("_nth", F.row_number().over(newest)).where("_nth = 1").drop("_nth")


def kept_counts() -> list[Column]:
    """Aggregates over Silver rows: how many, nulls in watched columns, negative views."""
    return [
        F.count(F.lit(1)).alias("rows_kept"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in WATCHED],
        F.count_if(F.col("views") < 0).alias("negative_views"),
    ]
