"""Row numbers inside groups of any size: no task ever holds a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.session import materialise

#: Spark's row positions hold the number of the partition above this many bits.
RANGE_BITS = 33


def ranked(df: DataFrame, group: str, order: Sequence[str], label: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``rank`` (bigint, from 0 inside ``group`` by ``order``, nulls first), and its groups with their ``size``.

    ``df`` is written in ranges of (group, order), so a group that holds most rows is cut into most of the ranges. A
    row's position in its range is written with it. What turns positions into ranks is one row for each group and
    range it lies in. ``df`` must give the same rows whenever it is read; ties in ``order`` come out in any order.
    """
    keys = [F.col(group), *[F.col(c) for c in order]]
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    stored = materialise(placed.withColumn("_at", F.monotonically_increasing_id()), label)
    in_range = F.shiftright("_at", RANGE_BITS)
    runs = stored.groupBy(F.col(group).alias("_group"), in_range.alias("_range")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    runs = materialise(runs, f"{label}-runs")
    before = F.sum("_rows").over(Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    shifts = runs.select("_group", "_range", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    same = F.col(group).eqNullSafe(F.col("_group")) & (in_range == F.col("_range"))
    rows = stored.join(shifts, same).withColumn("rank", F.col("_at") + F.col("_shift"))
    return rows.drop("_at", "_group", "_range", "_shift"), runs.groupBy(F.col("_group").alias(group)).agg(F.sum("_rows").alias("size"))
