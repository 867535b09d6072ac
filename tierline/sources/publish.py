"""Tables whose partitions are folders of the run that wrote them: a run writes beside what is read, then switches."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.sources.writers import declare_table, in_batches, laid_out, partition_spec, sql_literal


def _unescaped(text: Column) -> Column:
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def written_folders(spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str], root: str | None = None) -> DataFrame:
    """The partitions below ``path`` and the folder of each. No column of the files is read. ``root`` is above several runs."""
    # the path comes as a URI, in which a blank of a folder's name is escaped and a plus is not
    folder = _unescaped(F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")).alias("folder")
    return spark.read.schema(schema).option("basePath", root or path).parquet(path).select(*by, folder).distinct()


def switch(spark: SparkSession, name: str, path: str, schema: T.StructType, by: Sequence[str]) -> int:
    """Points the partitions that a run wrote below ``path`` at its folders; how many these are.

    Each partition is switched as a whole, and a query lists its partitions once, so it reads the old rows of one or the
    new ones. A query that has listed them goes on with the old folders, which stay where they are. After a run that
    died between two partitions, the same call completes it.
    """
    folders = written_folders(spark, path, schema, by).collect()
    known = {tuple(r[c] for c in by) for r in _partitions(spark, name, schema, by).collect()}
    fresh = [r for r in folders if tuple(r[c] for c in by) not in known]
    for rows in in_batches(fresh):
        told = " ".join(f"{partition_spec(r, by)} LOCATION {sql_literal(r.folder)}" for r in rows)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {told}")
    for r in folders:
        if r not in fresh:
            spark.sql(f"ALTER TABLE {name} {partition_spec(r, by)} SET LOCATION {sql_literal(r.folder)}")
    spark.catalog.refreshTable(name)
    return len(folders)


def _partitions(spark: SparkSession, name: str, schema: T.StructType, by: Sequence[str]) -> DataFrame:
    """The partitions that the catalog knows, as values."""
    parts = spark.sql(f"SHOW PARTITIONS {name}").select(F.split("partition", "/").alias("parts"))
    value = lambda i: _unescaped(F.regexp_replace(F.get("parts", F.lit(i)), "^[^=]*=", ""))
    plain = lambda i: F.when(value(i) != "__HIVE_DEFAULT_PARTITION__", value(i))
    return parts.select(*[plain(i).cast(schema[c].dataType).alias(c) for i, c in enumerate(by)])


def publish(df: DataFrame, name: str, root: str, by: Sequence[str] = ("region",)) -> str:
    """Replaces the partitions of ``name`` that occur in ``df``, which may read from it; the folder that was written.

    Folders that no partition points at any more are left to the retention rule of ``root``; see ``superseded``.
    """
    spark, path = df.sparkSession, f"{root}/run={uuid.uuid4().hex}"
    laid_out(df, by).write.partitionBy(*by).parquet(path)
    declare_table(spark, name, f"{root}/none", df.schema, by)
    switch(spark, name, path, df.schema, by)
    return path


def superseded(spark: SparkSession, name: str, root: str, schema: T.StructType, by: Sequence[str] = ("region",)) -> list[str]:
    """Folders of earlier runs below ``root`` that no partition of ``name`` points at. Nothing is removed."""
    every = {r.folder for r in written_folders(spark, f"{root}/run=*", schema, by, root).collect()}
    used = set()
    for r in _partitions(spark, name, schema, by).collect():
        details = spark.sql(f"DESCRIBE TABLE EXTENDED {name} {partition_spec(r, by)}").collect()
        used.add(next(d.data_type for d in details if d.col_name == "Location").rstrip("/"))
    return sorted(every - used)
