"""Rows that a rule keeps out of Silver, beside it, until a rule changes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators import cleanse
from tierline.operators.flags import FLAGS, STATISTICS_RULES, RowRule, flagged, is_quarantined
from tierline.plans.silver import JOB_NAME, newest
from tierline.sources.writers import replace_partitions
from tierline.streaming.intake import merge_snapshots, note_schema, stored_schema

HELD, BATCH, READMITTED = "quarantined", "batch", "_readmitted_at"


def judged(conformed: DataFrame, rules: Sequence[RowRule] = STATISTICS_RULES) -> DataFrame:
    """Conformed rows with region and day settled and all faults in ``_flags``; none is dropped or filled yet."""
    return flagged(cleanse.parse_trending_date(cleanse.normalise_region(conformed)), rules)


def finished(rows: DataFrame, as_of: datetime | None = None, job_name: str = JOB_NAME) -> DataFrame:
    """Judged rows as Silver has them: counters filled, ratios and audit columns added, the newest copy of each."""
    return newest(cleanse.zero_fill(rows), as_of, job_name=job_name)


class Quarantine:
    """The rows kept out of one Silver table, below ``path``: as they were judged, by batch, with the time they were let in."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame | None:
        """All rows ever kept out; those let in later have ``_readmitted_at``. None before the first batch."""
        schema = stored_schema(self.spark, f"{self.path}/held") if self._exists() else None
        return None if schema is None else self.spark.read.schema(schema).parquet(f"{self.path}/held")

    def _exists(self) -> bool:
        try:
            self.spark.read.text(f"{self.path}/held/_schema")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return False
        return True

    def route(self, conformed: DataFrame, batch: str, rules: Sequence[RowRule] = STATISTICS_RULES) -> DataFrame:
        """Judges the rows of a batch and gives those that may pass.

        Both kinds are written in one go, to folders of their own, so rows are read and judged once. Those kept out
        then go to their table under ``batch``; the same batch again replaces them.
        """
        routed = f"{self.path}/routed"
        rows = judged(conformed, rules).withColumn(HELD, is_quarantined(rules))
        rows.write.mode("overwrite").partitionBy(HELD).parquet(routed)
        both = self.spark.read.schema(T.StructType([*rows.drop(HELD).schema.fields, T.StructField(HELD, T.BooleanType())])).parquet(routed)
        self._hold(both.where(HELD).drop(HELD).select("*", F.lit(None).cast("timestamp").alias(READMITTED), F.lit(batch).alias(BATCH)))
        return both.where(~F.col(HELD)).drop(HELD)

    def _hold(self, rows: DataFrame) -> None:
        replace_partitions(rows, f"{self.path}/held", (BATCH,))
        note_schema(self.spark, f"{self.path}/held", rows.schema)

    def readmit(self, silver_path: str, rules: Sequence[RowRule], at: datetime) -> DataFrame | None:
        """Judges the rows kept out by other ``rules`` and merges those that may now pass; the region-days they touch.

        They meet the stored copies like rows of a batch: the newest stays. They are marked after the merge, and the
        merge of the same rows changes nothing, so a run that died in between is repaired by another. Only batches with a
        row that was let in are written again.
        """
        held = self.rows()
        if held is None:
            return None
        again = flagged(held.where(F.col(READMITTED).isNull()).drop(FLAGS, READMITTED), rules).where(~is_quarantined(rules))
        passing = f"{self.path}/passing"
        again.write.mode("overwrite").parquet(passing)
        again = self.spark.read.schema(again.schema).parquet(passing)
        if again.isEmpty():
            return None
        touched = merge_snapshots(finished(again.drop(BATCH), at), silver_path)
        batches = again.select(F.col(BATCH).alias("_of")).distinct()
        rejudged = flagged(held.withColumnRenamed(FLAGS, "_before"), rules)
        let_in = F.col(READMITTED).isNull() & ~is_quarantined(rules)
        marked = rejudged.withColumns({
            READMITTED: F.when(let_in, F.lit(at)).otherwise(F.col(READMITTED)),
            FLAGS: F.when(let_in, F.col(FLAGS)).otherwise(F.col("_before")),
        })
        staged = f"{self.path}/marked"
        of_batches = marked.join(batches, F.col(BATCH) == F.col("_of"), "left_semi").select(*held.columns)
        of_batches.write.mode("overwrite").parquet(staged)
        replace_partitions(self.spark.read.schema(held.schema).parquet(staged), f"{self.path}/held", (BATCH,))
        return touched
