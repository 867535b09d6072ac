"""Partitioned Parquet sinks and catalog registration."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T

from tierline.plans.lattice import merged_schema

#: How tables and staged copies are compressed: about four fifths of what snappy leaves for Silver.
CODEC = "zstd"
#: Partitions named in one statement.
AT_ONCE = 200


def laid_out(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Few files per partition value: rows meet by value, and AQE splits values that are too big."""
    return df.hint("rebalance", *by)


def append_partitions(df: DataFrame, path: str, by: Sequence[str] = ("region",)) -> None:
    """Adds files; running it twice doubles the rows."""
    laid_out(df, by).write.mode("append").partitionBy(*by).option("compression", CODEC).parquet(path)


def replace_partitions(df: DataFrame, path: str, by: Sequence[str] = ("region",)) -> None:
    """Replaces exactly the partitions that occur in ``df``; no rows, no change.

    ``df`` must not read from ``path``.
    """
    replace_laid_out(laid_out(df, by), path, by)


def replace_laid_out(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """As ``replace_partitions``, for rows of which few tasks hold the same partition already; they are not moved."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .option("compression", CODEC)
        .parquet(path)
    )


def column_list(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def sql_literal(value: object) -> str:
    return "NULL" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def partition_spec(row: Row, by: Sequence[str]) -> str:
    return f"PARTITION ({', '.join(f'`{c}` = {sql_literal(row[c])}' for c in by)})"


def in_batches(rows: list[Row]) -> Iterator[list[Row]]:
    for i in range(0, len(rows), AT_ONCE):
        yield rows[i : i + AT_ONCE]


def declare_table(spark: SparkSession, name: str, path: str, schema: T.StructType, by: Sequence[str]) -> None:
    """A table over Parquet folders, as yet without partitions; nothing happens where ``name`` is known."""
    partitions = ", ".join(f"`{c}`" for c in by)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({column_list(schema)}) USING parquet PARTITIONED BY ({partitions}) LOCATION '{path}'"
    )


def add_partitions(spark: SparkSession, name: str, touched: DataFrame, by: Sequence[str]) -> None:
    """Makes the folders of ``touched``, one row for each partition, part of the table; those that are already stay.

    Statements grow with the partitions a run touched, not with those of the table.
    """
    for rows in in_batches(touched.select(*by).distinct().collect()):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(partition_spec(r, by) for r in rows)}")
    spark.catalog.refreshTable(name)


def register_table(
    spark: SparkSession, name: str, path: str, schema: T.StructType, by: Sequence[str] = ("region",), touched: DataFrame | None = None
) -> None:
    """Makes the Parquet folder queryable under ``name`` and picks up its partitions: those in ``touched``, else all."""
    declare_table(spark, name, path, schema, by)
    if touched is None:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    else:
        add_partitions(spark, name, touched, by)


def grow_table(spark: SparkSession, name: str, schema: T.StructType) -> list[str]:
    """Gives ``name`` the columns it does not have yet, and wider types where ``schema`` has them; the names of both.

    Rows written before read null in new columns. A type that can't be widened without loss raises ``SchemaConflict``.
    A catalog of Parquet folders can't change a column's type in place, so the table is then declared anew over its folder.
    """
    table = spark.table(name).schema
    stored = {f.name.lower(): f for f in table.fields}
    alike = T.StructType([T.StructField(stored.get(f.name.lower(), f).name, f.dataType) for f in schema.fields])
    merged = merged_schema(table, alike)
    added = [f for f in schema.fields if f.name.lower() not in stored]
    changed = [f.name for f in table.fields if merged[f.name].dataType != f.dataType]
    if changed:
        details = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
        path = next(r.data_type for r in details if r.col_name == "Location")
        by = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
        spark.sql(f"DROP TABLE {name}")
        register_table(spark, name, path, merged, by)
    elif added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({column_list(T.StructType(added))})")
    return [f.name for f in added] + changed
