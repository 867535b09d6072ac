"""Category names on statistics rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = "Unknown"


def unknown_fill(df: DataFrame) -> DataFrame:
    """Every row gets a category name: its own, or the word for none."""
    if "category_name" not in df.columns:
        return df.withColumn("category_name", F.lit(UNKNOWN))
    return df.fillna(UNKNOWN, subset=["category_name"])


def enrich_category(statistics: DataFrame, lookup: DataFrame | None) -> DataFrame:
    """Left join on the category id; without a lookup all names are unknown.

    There is no hint: adaptive execution measures the lookup and broadcasts it within
    ``spark.sql.autoBroadcastJoinThreshold``; beyond that it joins by shuffle and splits a frequent category.
    """
    if lookup is None:
        return unknown_fill(statistics)
    keyed = statistics.withColumn("category_id", F.col("category_id").cast("bigint"))
    return unknown_fill(keyed.join(lookup, "category_id", "left"))
