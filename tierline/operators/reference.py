"""Category documents: validation, flattening, newest entry per id, lineage, lookup."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.functions import region_from_path, to_long
from tierline.operators.shape import flatten_struct
from tierline.plans.contracts import CATEGORY_ITEM, SOURCE_FILE
from tierline.sources.readers import CORRUPT, WRITTEN_AT


def _entries() -> Column:
    """The items of a document; a document without items is its own single item."""
    itself = F.struct(*[F.col(f.name) for f in CATEGORY_ITEM.fields])
    return F.coalesce(F.col("items"), F.array(itself))


def _is_corrupt(documents: DataFrame) -> Column:
    return F.col(CORRUPT).isNotNull() if CORRUPT in documents.columns else F.lit(False)


def readable(documents: DataFrame) -> DataFrame:
    """Documents that parsed and hold at least one item."""
    good = documents.where(~_is_corrupt(documents) & (F.size(_entries()) > 0))
    return good.drop(CORRUPT)


def reference_errors(documents: DataFrame) -> DataFrame:
    """One row per file that cannot be used, with the reason; the others go on."""
    reason = F.when(_is_corrupt(documents), "not valid JSON").when(
        F.size(_entries()) == 0, "no category items"
    )
    return documents.select(SOURCE_FILE, reason.alias("error")).where("error is not null")


def validate_reference(documents: DataFrame) -> DataFrame:
    """Per readable or empty file: item count and the expected columns no item has.

    Missing columns are a warning only; no items at all is an error.
    """
    entries = _entries()
    missing = F.array_compact(
        F.array(
            F.when(~F.exists(entries, lambda e: e["id"].isNotNull()), F.lit("id")),
            F.when(~F.exists(entries, lambda e: e["snippet"]["title"].isNotNull()), F.lit("snippet_title")),
        )
    )
    return (
        documents.where(~_is_corrupt(documents))
        .select(SOURCE_FILE, F.size(entries).alias("items"), missing.alias("missing_columns"))
        .withColumn(
            "severity",
            F.when(F.col("items") == 0, "error")
            .when(F.size("missing_columns") > 0, "warning")
            .otherwise("ok"),
        )
    )


def newest_documents(documents: DataFrame) -> DataFrame:
    """The newest document of each region that can be read, by its day and then by when it was written.

    Regions stand in the path. A newer document replaces the older one whole; one that can't be read replaces nothing.
    """
    region = region_from_path(F.col(SOURCE_FILE))
    newest = Window.partitionBy("_of_region").orderBy(
        *[F.col(c).desc_nulls_last() for c in ("date", WRITTEN_AT, SOURCE_FILE) if c in documents.columns]
    )
    ranked = readable(documents).withColumn("_of_region", region).withColumn("_nth", F.row_number().over(newest))
    return ranked.where("_nth = 1").drop("_nth", "_of_region")


def flatten_reference(documents: DataFrame) -> DataFrame:
    """One row per item with snake-case leaves, plus ``position`` in the file."""
    rows = documents.select(SOURCE_FILE, F.posexplode(_entries()).alias("position", "item"))
    return flatten_struct(rows, "item")


def dedup_last(rows: DataFrame) -> DataFrame:
    """The last entry per id within one file."""
    last = Window.partitionBy(SOURCE_FILE, "id").orderBy(F.col("position").desc())
    return rows.withColumn("_nth", F.row_number().over(last)).where("_nth = 1").drop("_nth", "position")


def lineage(rows: DataFrame, as_of: datetime | None = None) -> DataFrame:
    stamp = F.current_timestamp() if as_of is None else F.lit(as_of)
    return rows.withColumns(
        {"_ingestion_timestamp": stamp, "region": region_from_path(F.col(SOURCE_FILE))}
    )


def category_lookup(rows: DataFrame) -> DataFrame | None:
    """One title per category id; where regions differ the smallest region decides.

    None when the rows have no id or title column.
    """
    title = next((c for c in ("snippet.title", "snippet_title", "snippet__title") if c in rows.columns), None)
    if "id" not in rows.columns or title is None:
        return None
    region = F.col("region") if "region" in rows.columns else F.lit(None).cast("string")
    entries = rows.select(
        to_long(F.col("id")).alias("category_id"),
        F.struct(region.alias("region"), F.col(f"`{title}`").alias("title")).alias("entry"),
    ).where("category_id is not null")
    return (
        entries.groupBy("category_id")
        .agg(F.min("entry").alias("entry"))
        .select("category_id", F.col("entry.title").alias("category_name"))
    )
