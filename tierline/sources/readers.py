"""Scans. Every reader has an explicit schema, so nothing is inferred and leaves may be missing."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from tierline.functions import clean_region
from tierline.operators.drift import captured
from tierline.plans.contracts import (
    CATEGORY_DOCUMENT,
    CORRUPT,
    ENVELOPE,
    HISTORY,
    LANDED_AT,
    LANDING_PARTITIONS,
    SOURCE_FILE,
    STATISTICS,
)

WRITTEN_AT = "_written_at"


def with_origin(envelopes: DataFrame) -> DataFrame:
    """Adds the landing time and the file a row came from."""
    return envelopes.withColumns(
        {
            LANDED_AT: F.try_to_timestamp(F.col("_pipeline_metadata.ingestion_timestamp")),
            SOURCE_FILE: F.col("_metadata.file_path"),
        }
    )


def envelope_schema() -> T.StructType:
    return T.StructType([*ENVELOPE.fields, T.StructField(CORRUPT, T.StringType()), *LANDING_PARTITIONS.fields])


def envelope_options(one_per_file: bool) -> dict[str, object]:
    """``one_per_file`` reads pretty-printed responses, one document a file; else one envelope a line, which splits."""
    return {"multiLine": one_per_file, "columnNameOfCorruptRecord": CORRUPT}


def read_envelopes(spark: SparkSession, root: str, one_per_file: bool = False) -> DataFrame:
    """Raw API responses below ``root``, partitioned by region, date and hour.

    ``land`` writes one envelope per line. Set ``one_per_file`` for responses as the API delivers them, indented. What
    is not JSON stays as a row with its text in ``_corrupt_record``; see ``envelope_errors``.
    """
    reader = spark.read.schema(envelope_schema()).options(**envelope_options(one_per_file))
    return with_origin(reader.json(root))


def read_landed_text(reader: DataFrameReader | DataStreamReader, root: str, one_per_file: bool = False) -> DataFrame:
    """What lies below ``root`` as text in ``value``, one envelope a line or a file, with the landing partitions."""
    schema = T.StructType([T.StructField("value", T.StringType()), *LANDING_PARTITIONS.fields])
    lines = reader.schema(schema).option("wholetext", one_per_file).text(root)
    return lines.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def capture_envelopes(reader: DataFrameReader | DataStreamReader, root: str, one_per_file: bool = False) -> DataFrame:
    """As ``read_envelopes``, from a batch or a streaming reader; what the contract doesn't name is kept in ``_extra``."""
    return captured(read_landed_text(reader, root, one_per_file)).withColumn(
        LANDED_AT, F.try_to_timestamp(F.col("_pipeline_metadata.ingestion_timestamp"))
    )


def is_unusable() -> Column:
    """Does nothing of an envelope reach the items?"""
    return F.col(CORRUPT).isNotNull() | F.col("items").isNull()


def envelope_errors(envelopes: DataFrame) -> DataFrame:
    """One row per envelope that can't be used, with its file, the reason and its text as far as it was kept."""
    reason = F.when(F.col(CORRUPT).isNotNull(), "not valid JSON").when(F.col("items").isNull(), "no items")
    return envelopes.select(SOURCE_FILE, reason.alias("error"), F.col(CORRUPT).alias("text")).where("error is not null")


#: Headers read at the same time; a header is the first line of a file.
HEADERS_AT_ONCE = 16


def _by_header(spark: SparkSession, root: str, layout: dict[str, object]) -> dict[tuple[str, ...], list[str]]:
    """The files below ``root`` by the names in their first line. Of the files only that line is read, of empty ones nothing."""
    # this source reads no content unless it is asked for
    listed = spark.read.format("binaryFile").load(root).where("length > 0").select("path").collect()
    files = sorted(r.path for r in listed)
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        headers = list(pool.map(lambda file: tuple(spark.read.options(**layout).csv(file).columns), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for header, file in zip(headers, files):
        groups.setdefault(header, []).append(file)
    return groups


def read_history_csv(spark: SparkSession, root: str, multi_line: bool = True) -> DataFrame:
    """Historical snapshots; all values are text, the region comes from the path.

    Each file's columns are bound by its own header, whatever their order. Optional columns that a file lacks take their
    defaults, others that only some files have are null for the rest. A row that doesn't fit its header stays with its
    text in ``_corrupt_record``, as do all rows of a file whose header lacks a column that snapshots can't do without; see
    ``history_errors``. The file and the time it was last written are the row's origin.

    Descriptions may hold line breaks, hence ``multi_line``; it keeps a file in one task, so switch it off where the
    files are known to be free of them.
    """
    layout = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line}
    known = {f.name.lower(): f.name for f in HISTORY.fields}
    needed = {f.name for f in STATISTICS if not f.optional} - {"region"}
    parts = []
    for header, files in _by_header(spark, root, layout).items():
        names = [known.get(c.strip().lower(), c.strip()) for c in header]
        names = ["_region_in_file" if n.lower() == "region" else n for n in names]
        fits = needed <= set(names) and len(set(names)) == len(names)
        if not fits:
            names = [f"_c{i}" for i in range(len(names))]
        fields = [T.StructField(n, T.StringType()) for n in (*names, CORRUPT, "region")]
        # these files have these names in this order, so places are enough
        rows = spark.read.schema(T.StructType(fields)).options(**layout, columnNameOfCorruptRecord=CORRUPT, basePath=root).csv(files)
        if not fits:
            whole = F.coalesce(F.col(CORRUPT), F.concat_ws(",", *[F.coalesce(n, F.lit("")) for n in names]))
            rows = rows.select(whole.alias(CORRUPT), "region", "_metadata")
        else:
            absent = {f.name: f.default for f in STATISTICS if f.name not in (*names, "region")}
            rows = rows.withColumns({n: F.lit(None if v is None else str(v)).cast("string") for n, v in absent.items()})
        origin = {LANDED_AT: F.col("_metadata.file_modification_time"), SOURCE_FILE: F.col("_metadata.file_path")}
        parts.append(rows.withColumns(origin).drop("_metadata", "_region_in_file"))
    if not any(HISTORY.names[0] in p.columns for p in parts):  # the columns are there without a file that fits
        texts = T.StructType([*HISTORY.fields, T.StructField(CORRUPT, T.StringType()), T.StructField("region", T.StringType())])
        parts.append(spark.createDataFrame([], texts.add(LANDED_AT, "timestamp").add(SOURCE_FILE, "string")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def history_errors(rows: DataFrame) -> DataFrame:
    """One row per history row that doesn't fit the header, with its file, text and first cell."""
    broken = rows.where(F.col(CORRUPT).isNotNull())
    reason = F.lit("row does not fit the header").alias("error")
    return broken.select(SOURCE_FILE, reason, F.col(CORRUPT).alias("text"), HISTORY.fields[0].name)


def read_reference(spark: SparkSession, root: str, one_per_file: bool = True) -> DataFrame:
    """Category documents with their file path and partition values.

    A file that is not JSON yields a row with its text in ``_corrupt_record``.
    """
    schema = T.StructType(
        [
            *CATEGORY_DOCUMENT.fields,
            T.StructField(CORRUPT, T.StringType()),
            T.StructField("region", T.StringType()),
            T.StructField("date", T.DateType()),
        ]
    )
    return (
        spark.read.schema(schema)
        .option("multiLine", one_per_file)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(root)
        .withColumns(
            {SOURCE_FILE: F.col("_metadata.file_path"), WRITTEN_AT: F.col("_metadata.file_modification_time")}
        )
    )


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A table from the catalog."""
    return spark.table(name)


def restrict_regions(df: DataFrame, regions: Iterable[str]) -> DataFrame:
    """Keeps the named regions, whatever their case; prunes partitions when region is one."""
    return df.where(clean_region(F.col("region")).isin([r.strip().lower() for r in regions]))


def reference_for_day(reference: DataFrame, day: date, regions: Iterable[str] | None = None) -> DataFrame:
    """The documents that landed on ``day``, for all or for the configured regions."""
    of_day = reference.where(F.col("date") == F.lit(day))
    return of_day if regions is None else restrict_regions(of_day, regions)
