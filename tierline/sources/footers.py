"""Counts and extremes of stored tables from the footers of their Parquet files: no column is read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Types whose extremes a footer tells exactly; those of text may be cut off there.
ORDERED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType)
#: Settings of a session of its own, in which Parquet is read by the reader that takes aggregates.
READER = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def _footer_session(spark: SparkSession) -> SparkSession:
    session = spark.newSession()
    for key, value in READER.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return session


def footer_profile(spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``rows``, and for each of ``columns`` its ``count_``, ``min_`` and ``max_`` (text has counts only).

    One row, or one for each value of the partition columns ``by``. Files without statistics can't answer from their
    footers; see ``profile``, which then reads the columns.
    """
    wanted = T.StructType([f for f in schema.fields if f.name in {*columns, *by}])
    table = _footer_session(spark).read.schema(wanted).parquet(path)
    return _profiled(table, columns, by)


def _profiled(table: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    told = [F.count(F.lit(1)).alias("rows")]
    for c in columns:
        told.append(F.count(c).alias(f"count_{c}"))
        if isinstance(table.schema[c].dataType, ORDERED):
            told += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return table.groupBy(*by).agg(*told) if by else table.agg(*told)


def is_from_footers(profile: DataFrame) -> bool:
    """Did the reader take all aggregates, so that files are asked for nothing else?"""
    plan = profile._jdf.queryExecution().executedPlan().toString()
    return "PushedAggregation: []" not in plan and "PushedAggregation: [" in plan


def profile(spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``footer_profile`` where all is answered by footers, else the same from the columns.

    The footers are asked here, once: a table has as many rows of answers as partitions, so they are kept as a result.
    """
    quick = footer_profile(spark, path, schema, columns, by)
    if is_from_footers(quick):
        try:
            # files without rows give no count at all, and a footer's least zero is a negative one
            counts = [c == "rows" or c.startswith("count_") for c in quick.columns]
            plain = lambda v, counted: 0 if v is None and counted else v + 0.0 if isinstance(v, float) else v
            rows = [tuple(map(plain, r, counts)) for r in quick.collect()]
            return spark.createDataFrame(rows, quick.schema)
        except Exception as error:  # a file without extremes ends the job; the reader then names the setting to change
            if "aggregatepushdown" not in str(error).lower():
                raise
    return _profiled(spark.read.schema(schema).parquet(path), columns, by)
