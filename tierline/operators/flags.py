"""Faults of single rows as bits of one number, from declared rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FLAG, QUARANTINE = "flag", "quarantine"
FLAGS = "_flags"
MOST_BITS = 63


@dataclass(frozen=True)
class RowRule:
    """``fault`` is a SQL condition that faulty rows meet; where it is null, a row is not faulty.

    ``bit`` is part of what is stored: give a new rule a new one, and leave the bit of a rule that goes unused.
    """

    bit: int
    name: str
    fault: str
    action: str = FLAG

    @property
    def mask(self) -> int:
        return 1 << self.bit


#: The rules of the statistics table, judged before missing counters become zero.
STATISTICS_RULES: tuple[RowRule, ...] = (
    RowRule(0, "no_video_id", "video_id is null", QUARANTINE),
    RowRule(1, "no_title", "title is null or trim(title) = ''"),
    RowRule(2, "no_channel", "channel_title is null"),
    RowRule(3, "no_views", "views is null"),
    RowRule(4, "negative_views", "views < 0", QUARANTINE),
    RowRule(5, "no_trending_date", "trending_date_parsed is null"),
    RowRule(6, "more_likes_than_views", "likes > views"),
)


def _checked(rules: Sequence[RowRule]) -> Sequence[RowRule]:
    bits = [r.bit for r in rules]
    if len(set(bits)) < len(bits) or any(not 0 <= b < MOST_BITS for b in bits):
        raise ValueError(f"rules need bits of their own from 0 to {MOST_BITS - 1}: {sorted(bits)}")
    if any(r.action not in (FLAG, QUARANTINE) for r in rules):
        raise ValueError("a rule flags or quarantines")
    return rules


def flag_mask(rules: Sequence[RowRule]) -> Column:
    """The bits of all rules that a row breaks. One expression over the row, however many rules there are."""
    bits = [F.when(F.expr(r.fault), F.lit(r.mask)).otherwise(0).cast("bigint") for r in _checked(rules)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(0).cast("bigint"))


def flagged(df: DataFrame, rules: Sequence[RowRule] = STATISTICS_RULES) -> DataFrame:
    return df.withColumn(FLAGS, flag_mask(rules))


def is_quarantined(rules: Sequence[RowRule], mask: str = FLAGS) -> Column:
    held = reduce(lambda a, r: a | r.mask, (r for r in rules if r.action == QUARANTINE), 0)
    return F.col(mask).bitwiseAND(F.lit(held).cast("bigint")) != 0


def flag_names(rules: Sequence[RowRule], mask: str = FLAGS) -> Column:
    """The names of a row's faults, in the order of the rules."""
    named = [F.when(F.col(mask).bitwiseAND(F.lit(r.mask).cast("bigint")) != 0, r.name) for r in rules]
    return F.array_compact(F.array(*named))


def flag_counts(df: DataFrame, rules: Sequence[RowRule] = STATISTICS_RULES, mask: str = FLAGS) -> DataFrame:
    """One row per rule: how many rows break it, and how many of these break no other. One aggregate over the masks."""
    masks = df.groupBy(F.col(mask).alias("mask")).agg(F.count(F.lit(1)).alias("n"))  # as many as faults occur together
    has = {r.name: F.col("mask").bitwiseAND(F.lit(r.mask).cast("bigint")) != 0 for r in rules}
    sums = [F.coalesce(F.sum(F.when(has[r.name], F.col("n"))), F.lit(0)).alias(f"all_{r.bit}") for r in rules]
    alone = [F.coalesce(F.sum(F.when(F.col("mask") == r.mask, F.col("n"))), F.lit(0)).alias(f"alone_{r.bit}") for r in rules]
    told = [
        F.struct(
            F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"), F.col(f"all_{r.bit}").alias("rows"), F.col(f"alone_{r.bit}").alias("alone")
        )
        for r in rules
    ]
    return masks.agg(*sums, *alone).select(F.inline(F.array(*told)))
