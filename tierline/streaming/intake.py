"""Only new landing files are read; their rows are merged into the Silver table.

State lives in the table, not in the stream: a late copy of a snapshot meets the stored one in its own region-day
partition and the newest survives.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators.cleanse import dedup_latest
from tierline.plans.contracts import CORRUPT, EXTRA
from tierline.plans.lattice import merged_schema
from tierline.plans.silver import SilverCount
from tierline.session import fresh_path
from tierline.sources.readers import (
    capture_envelopes,
    envelope_errors,
    envelope_options,
    envelope_schema,
    is_unusable,
    with_origin,
)
from tierline.sources.writers import CODEC, laid_out
from tierline.sources.writers import replace_laid_out as replace_partitions

SILVER_PARTITIONS = ("region", "trending_date_parsed")
#: Rows of a region-day that one task merges.
PORTION = 500_000
#: A folder below a table, unseen by readers, with the union of all schemas that were merged into it.
SCHEMA_NOTE = "_schema"
#: What a finished merge notes: its key and which of its staged folders holds the result.
FINISHED = "key bigint, result string"


def _exists(read: Callable[[], DataFrame]) -> DataFrame | None:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """All columns of the table at ``path``: as noted by the last merge, else from the footers of its files."""
    note = _exists(lambda: spark.read.text(f"{path}/{SCHEMA_NOTE}"))
    if note is not None:
        return T.StructType.fromJson(json.loads(note.first().value))
    table = _exists(lambda: spark.read.option("mergeSchema", True).parquet(path))
    return None if table is None else table.schema


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` with all columns that were ever merged into it."""
    return spark.read.schema(stored_schema(spark, path)).parquet(path)


def note_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Remembers the columns of the table at ``path`` for later merges."""
    spark.createDataFrame([(schema.json(),)], "value string").write.mode("overwrite").text(f"{path}/{SCHEMA_NOTE}")


def in_partitions(stored: DataFrame, touched: DataFrame) -> DataFrame:
    """The stored rows of the ``touched`` region-days.

    All touched days and all touched regions are written into the scan's partition filter, however many there are:
    both sets are bounded by the calendar and by the codes in use, not by rows. That leaves some pairs too many, which
    the semi join takes out. The table's files are still listed; files of other days are not opened.
    """
    region, day = SILVER_PARTITIONS
    named = touched.agg(
        F.collect_set(region).alias("regions"), F.collect_set(day).alias("days"),
        F.bool_or(F.col(region).isNull()).alias("no_region"), F.bool_or(F.col(day).isNull()).alias("no_day"),
    ).first()
    stored = stored.where(one_of(region, named.regions, named.no_region) & one_of(day, named.days, named.no_day))
    wanted = touched.select(F.col(region).alias("_region"), F.col(day).alias("_day"))
    return stored.join(
        wanted, F.col(region).eqNullSafe(F.col("_region")) & F.col(day).eqNullSafe(F.col("_day")), "left_semi"
    )


def one_of(column: str, values: list, with_null: bool | None) -> Column:
    """A condition that a scan can prune partitions with."""
    listed = F.col(column).isin(sorted(values))
    return listed | F.col(column).isNull() if with_null else listed


def newest_by_day(rows: DataFrame) -> DataFrame:
    """The newest copy of each snapshot, where the copies of a snapshot are few, with the rows of a region-day in few tasks.

    Copies meet and partitions are laid out in one shuffle of the rows. A region-day is one portion of it, and one with
    more than ``PORTION`` rows is dealt by video into several; only these few are looked up.
    """
    region, day = SILVER_PARTITIONS
    crowded = rows.groupBy(F.col(region).alias("_region"), F.col(day).alias("_day")).agg(F.count(F.lit(1)).alias("_rows"))
    crowded = crowded.where(F.col("_rows") > PORTION).withColumn("_portions", F.ceil(F.col("_rows") / PORTION))
    there = F.col(region).eqNullSafe(F.col("_region")) & F.col(day).eqNullSafe(F.col("_day"))
    portion = F.pmod(F.hash("video_id"), F.coalesce(F.col("_portions"), F.lit(1)))
    dealt = rows.join(F.broadcast(crowded), there, "left").withColumn("_portion", portion)
    dealt = dealt.select(*rows.columns, "_portion").repartition(*SILVER_PARTITIONS, "_portion")
    return dedup_latest(dealt, key=(*SILVER_PARTITIONS, "_portion", "video_id")).drop("_portion")


def is_merged(spark: SparkSession, staging: str, key: int) -> bool:
    """Is the merge of the batch ``key`` finished in ``staging``?"""
    done = _exists(lambda: spark.read.schema("key bigint").parquet(f"{staging}/{key % 2}-finished"))
    return done is not None and not done.where(F.col("key") == key).isEmpty()


def merge_snapshots(batch: DataFrame, path: str, staging: str | None = None, key: int = 0) -> DataFrame:
    """Merges clean rows into the table at ``path``, replacing only the partitions they touch; returns these.

    The batch and its merge are written to ``staging`` first, as a partition can't be overwritten while it is read. With
    the same ``staging`` and ``key``, a run that died while replacing partitions is repaired by repeating the batch: the
    finished merge is applied again instead of being rebuilt from a half-replaced table. Staging keeps the last two
    keys, in turn. The first batch of a table is its own merge and is staged once. Stored and new rows are read with the columns of both, in types that hold the values of both; a column
    whose types have none ends the merge with a ``SchemaConflict`` before anything is changed.
    """
    spark = batch.sparkSession
    staging = staging or fresh_path(spark, "merged")
    slot = f"{staging}/{key % 2}"
    if not is_merged(spark, staging, key):
        # neighbours that share region and day are stored, and shuffled later, in fewer bytes
        sorted_batch = batch.sortWithinPartitions(*SILVER_PARTITIONS, "video_id")
        sorted_batch.write.mode("overwrite").option("compression", CODEC).parquet(f"{slot}-batch")
        fresh = spark.read.schema(batch.schema).parquet(f"{slot}-batch")
        fresh.select(*SILVER_PARTITIONS).distinct().write.mode("overwrite").parquet(f"{slot}-touched")
        touched, known = spark.read.parquet(f"{slot}-touched"), stored_schema(spark, path)
        schema = batch.schema if known is None else merged_schema(known, batch.schema)
        fresh = fresh.select(*[F.col(f.name).cast(schema[f.name].dataType) for f in batch.schema.fields])
        if known is not None:
            stored = in_partitions(spark.read.schema(schema).parquet(path), touched)
            rows = newest_by_day(stored.unionByName(fresh, allowMissingColumns=True))
            merged = rows.write.mode("overwrite").partitionBy(*SILVER_PARTITIONS).option("compression", CODEC)
            merged.parquet(f"{slot}-merged")
        if known != schema:
            note_schema(spark, path, schema)
        done = [(key, "batch" if known is None else "merged")]
        spark.createDataFrame(done, FINISHED).write.mode("overwrite").parquet(f"{slot}-finished")
    schema = stored_schema(spark, path) or batch.schema
    result = spark.read.schema(FINISHED).parquet(f"{slot}-finished").first().result or "merged"
    staged = spark.read.schema(schema).parquet(f"{slot}-{result}")
    # a merge is staged in the folders of its region-days and only copied; a batch still has to be laid out
    replace_partitions(staged if result == "merged" else laid_out(staged, SILVER_PARTITIONS), path, SILVER_PARTITIONS)
    return spark.read.parquet(f"{slot}-touched")


def add_pending(touched: DataFrame, path: str, source: str) -> None:
    """Notes region-days whose marts are out of date."""
    touched.write.mode("overwrite").parquet(f"{path}/source={source}")


def pending_partitions(spark: SparkSession, path: str) -> DataFrame | None:
    """All region-days noted since they were last cleared; None when there are none."""
    schema = "region string, trending_date_parsed date, source string"
    noted = _exists(lambda: spark.read.schema(schema).parquet(path))
    if noted is None or noted.isEmpty():
        return None
    return noted.select(*SILVER_PARTITIONS).distinct()


def clear_pending(spark: SparkSession, path: str) -> None:
    spark.createDataFrame([], "region string, trending_date_parsed date").write.mode("overwrite").parquet(path)


def intake_errors(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The unusable envelopes of all batches of a stream, with the number of their batch."""
    schema = "_source_file string, error string, text string, batch bigint"
    found = _exists(lambda: spark.read.schema(schema).parquet(f"{checkpoint}/errors"))
    return spark.createDataFrame([], schema) if found is None else found


def without_redeliveries(envelopes: DataFrame, within: str) -> DataFrame:
    """A stream without envelopes that it already had ``within`` a time before, whatever files they come in.

    An envelope is known by the digest of its items and stamp, and remembered from when it was taken in. That time only
    grows, so no envelope is ever too late and dropped for it. What was not JSON is known by its text. The memory holds
    a digest for each envelope of that time, dealt over the tasks of the state.
    """
    told = F.to_json(F.struct("region", "date", "hour", "items", "_pipeline_metadata", *[c for c in (CORRUPT, EXTRA) if c in envelopes.columns]))
    known = envelopes.withColumns({"_told": F.sha2(told, 256), "_taken_in": F.current_timestamp()})
    return known.withWatermark("_taken_in", within).dropDuplicatesWithinWatermark(["_told"]).drop("_told", "_taken_in")


def take_in(
    spark: SparkSession,
    landing_root: str,
    silver_path: str,
    checkpoint: str,
    as_of: datetime | None = None,
    files_per_batch: int | None = None,
    one_per_file: bool = False,
    touched_path: str | None = None,
    capture: bool = False,
    clean: Callable[[DataFrame, int], DataFrame] | None = None,
    redelivered_within: str | None = None,
) -> list[dict[str, int]]:
    """Takes in what landed since the last run and gives the counts of each batch. No new files, no batch, no write.

    ``files_per_batch`` bounds a batch when a backlog is taken in. All that belongs to the stream lies below
    ``checkpoint``: its progress, ``merged`` with the staging of the last two batches, ``errors`` with the unusable
    envelopes of each batch that has some. So a reset of the stream resets them too. The region-days that a batch touched are added
    below ``touched_path`` before the batch counts as done; see ``pending_partitions``. With ``capture``, what payloads
    hold outside the contract is kept in ``_extra``; else only what the contract names is read. ``clean`` makes Silver
    rows of the conformed rows of a batch, given its number, where that is not the usual way. Envelopes
    that come again in other files ``redelivered_within`` a time (such as ``7 days``) are left out before anything is
    merged, so they touch no region-day; without it they are merged, which changes no row.
    """
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    done: list[dict[str, int]] = []
    run = uuid.uuid4().hex

    def merge(batch: DataFrame, batch_id: int) -> None:
        staging = f"{checkpoint}/merged"
        repeated = is_merged(spark, staging, batch_id)  # then it is applied without being counted again
        bad = Observation()
        seen = batch.observe(bad, F.count_if(is_unusable()).alias("envelopes"))
        count = SilverCount(seen, as_of, None if clean is None else lambda rows: clean(rows, batch_id))
        touched = merge_snapshots(count.silver, silver_path, staging, batch_id)
        # a batch is read again for its errors only when it has some
        if repeated or bad.get["envelopes"]:
            envelope_errors(batch).write.mode("overwrite").parquet(f"{checkpoint}/errors/batch={batch_id}")
        if touched_path is not None:
            add_pending(touched, touched_path, f"{run}-{batch_id}")
        done.append({} if repeated else count.counts())

    if capture:
        envelopes = capture_envelopes(reader, landing_root, one_per_file)
    else:
        typed = reader.schema(envelope_schema()).options(**envelope_options(one_per_file))
        envelopes = with_origin(typed.json(landing_root))
    if redelivered_within is not None:
        envelopes = without_redeliveries(envelopes, redelivered_within)
    query = (
        envelopes
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return done


def run_increment(
    spark: SparkSession,
    landing_root: str,
    silver_path: str,
    checkpoint: str,
    as_of: datetime | None = None,
    files_per_batch: int | None = None,
    one_per_file: bool = False,
    capture: bool = False,
) -> int:
    """``take_in``, for the number of batches alone."""
    return len(take_in(spark, landing_root, silver_path, checkpoint, as_of, files_per_batch, one_per_file, capture=capture))
