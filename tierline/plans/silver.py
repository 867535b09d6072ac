"""Raw snapshots to the clean statistics table, and category documents to clean reference rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tierline.operators import cleanse, reference, shape
from tierline.plans.contracts import LANDED_AT, SOURCE_FILE

JOB_NAME = "silver_statistics"


def filled(conformed: DataFrame) -> DataFrame:
    """The row-level steps up to filled counters; what is worked out from these comes with ``completed``."""
    df = cleanse.drop_null_key(conformed)
    df = cleanse.normalise_region(df)
    df = cleanse.parse_trending_date(df)
    return cleanse.zero_fill(df)


def completed(rows: DataFrame, as_of: datetime | None = None, job_name: str = JOB_NAME) -> DataFrame:
    """Adds ratios and audit columns."""
    return cleanse.audit_columns(cleanse.add_ratios(rows), job_name, as_of)


def cleansed(conformed: DataFrame, as_of: datetime | None = None, job_name: str = JOB_NAME) -> DataFrame:
    """All row-level steps; narrow, so one codegen stage."""
    return completed(filled(conformed), as_of, job_name)


def newest(
    rows: DataFrame,
    as_of: datetime | None = None,
    latest: Sequence[str] = (LANDED_AT, SOURCE_FILE),
    job_name: str = JOB_NAME,
) -> DataFrame:
    """The newest copy of each of the filled ``rows``, completed.

    Ratios and audit columns follow from the row and its run, so only the copies that stay get them and none is shuffled,
    unless ``latest`` asks for one.
    """
    if set(latest) <= {*rows.columns, LANDED_AT, SOURCE_FILE}:
        return completed(cleanse.dedup_latest(rows, latest), as_of, job_name)
    return cleanse.dedup_latest(completed(rows, as_of, job_name), latest)


def silver_statistics(
    raw: DataFrame,
    as_of: datetime | None = None,
    trending_day: date | None = None,
    latest: Sequence[str] = (LANDED_AT, SOURCE_FILE),
    job_name: str = JOB_NAME,
) -> DataFrame:
    """Conform, cleanse, keep the newest copy. One shuffle, on the snapshot key."""
    return newest(filled(shape.conform(raw, trending_day)), as_of, latest, job_name)


class SilverCount:
    """Counts rows on their way to Silver while it is written: rows in, rows kept, and what is odd about those kept.

    ``silver`` is the observed frame. Its first action, a write, takes the counts; no other scan is made. ``clean``
    makes Silver rows of conformed ones, where that is not the usual way.
    """

    def __init__(self, raw: DataFrame, as_of: datetime | None = None, clean: Callable[[DataFrame], DataFrame] | None = None):
        self.read, self.kept = Observation(), Observation()
        conformed = shape.conform(raw).observe(self.read, F.count(F.lit(1)).alias("rows_read"))
        silver = newest(filled(conformed), as_of) if clean is None else clean(conformed)
        self.silver = silver.observe(self.kept, *cleanse.kept_counts())

    def counts(self) -> dict[str, int]:
        """Waits for the write, then gives all counts."""
        found = {**self.read.get, **self.kept.get}
        return {**found, "rows_removed": found["rows_read"] - found["rows_kept"]}


def silver_reference(documents: DataFrame, as_of: datetime | None = None, newest_only: bool = False) -> DataFrame:
    """Readable documents flattened, newest position per id and file, with lineage and region.

    ``newest_only`` takes the newest document of each region, as a table that each document overwrites would hold.
    """
    taken = reference.newest_documents(documents) if newest_only else reference.readable(documents)
    rows = reference.flatten_reference(taken)
    return reference.lineage(reference.dedup_last(rows), as_of)
