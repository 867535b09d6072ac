"""Raw payloads to the landing zone."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.functions import clean_region

PARTITIONS = ("region", "date", "hour")


def stamp_provenance(payloads: DataFrame, run_at: datetime, source: str) -> DataFrame:
    """Adds ``_pipeline_metadata`` and the partition columns to payloads with ``region`` and ``items``.

    ``run_at`` is the one instant of the run, in UTC unless it says otherwise.
    A payload without items counts 0 videos.
    """
    run_at = run_at.replace(tzinfo=UTC) if run_at.tzinfo is None else run_at.astimezone(UTC)
    region = clean_region(F.col("region"))
    metadata = F.struct(
        F.lit(run_at.strftime("%Y%m%d_%H%M%S")).alias("ingestion_id"),
        region.alias("region"),
        F.lit(run_at.isoformat()).alias("ingestion_timestamp"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("video_count"),
        F.lit(source).alias("source"),
    )
    return payloads.withColumns(
        {
            "_pipeline_metadata": metadata,
            "region": region,
            "date": F.lit(run_at.date()),
            "hour": F.lit(run_at.hour),
        }
    )


def land(stamped: DataFrame, root: str, placed: bool = False) -> None:
    """Appends stamped payloads as compressed JSON lines below region/date/hour folders.

    Envelopes repeat their keys, so gzip makes them about a tenth. It does not split, but the rebalance bounds a file.
    ``placed`` payloads are in few tasks for each folder already, as those fetched by region are, and are not shuffled.
    """
    rows = stamped if placed else stamped.hint("rebalance", *PARTITIONS)
    rows.write.mode("append").partitionBy(*PARTITIONS).option("compression", "gzip").json(root)


def landing_gaps(expected: Iterable[str], landed: DataFrame) -> DataFrame:
    """One row per expected region: did anything land for it, and how many payloads."""
    spark = landed.sparkSession
    codes = sorted({r.strip().lower() for r in expected})
    wanted = spark.createDataFrame([(c,) for c in codes], "region string")
    arrived = landed.groupBy(clean_region(F.col("region")).alias("region")).agg(
        F.count(F.lit(1)).alias("payloads")
    )
    return wanted.join(arrived, "region", "left").select(
        "region",
        F.when(F.col("payloads") > 0, "success").otherwise("failed").alias("status"),
        F.coalesce("payloads", F.lit(0)).alias("payloads"),
    )


def landing_gap_spans(expected: Iterable[str], landed: DataFrame, first: datetime, last: datetime, every_hours: int = 1) -> DataFrame:
    """One row per run of scheduled landings that a region missed: the first and last of them, and how many there are.

    The schedule has a slot every ``every_hours`` from ``first`` to ``last``; a payload counts for the slot that its
    ``landed`` time lies in. Payloads become one row per region and slot before they meet the schedule, which has a row
    for each region and slot whatever has landed. Missed slots that follow each other differ from their rank by the same
    number. ``open`` runs have not ended with the schedule; a region that never landed has one run.
    """
    spark = landed.sparkSession
    codes = sorted({r.strip().lower() for r in expected})
    if every_hours < 1 or last < first:
        raise ValueError("the schedule has no slot")
    step = every_hours * 3600
    begin, end = (int(t.replace(tzinfo=UTC).timestamp()) for t in (first, last))
    slots = (end - begin) // step + 1
    # one region's slots are made in its own row, so the schedule is dealt out by region and never collected
    wanted = spark.range(1).select(F.explode(F.array(*[F.lit(c) for c in codes])).alias("region"))
    wanted = wanted.select("region", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"))
    at = F.unix_timestamp("landed") - F.lit(begin)
    arrived = landed.select(clean_region(F.col("region")).alias("region"), F.floor(at / step).cast("int").alias("slot"))
    arrived = arrived.where(F.col("slot").between(0, slots - 1)).distinct()
    missed = wanted.join(arrived, ["region", "slot"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("region").orderBy("slot"))
    runs = missed.withColumn("_run", F.col("slot") - rank).groupBy("region", "_run").agg(
        F.min("slot").alias("from"), F.max("slot").alias("to"), F.count(F.lit(1)).alias("missed")
    )
    time = lambda slot: F.timestamp_seconds(F.lit(begin) + F.col(slot) * step).cast("timestamp_ntz")
    return runs.select(
        "region", time("from").alias("first_missed"), time("to").alias("last_missed"), "missed",
        (F.col("to") == slots - 1).alias("open"),
    )
