"""Ratios per row and averages that do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RATIO_DIGITS = 4
SHARE_DIGITS = 2


def _per_hundred_views(numerator: Column, views: Column) -> Column:
    rate = F.round(numerator / views * 100, RATIO_DIGITS)
    return F.when(views > 0, rate).otherwise(F.lit(0.0))


def like_ratio(views: Column, likes: Column) -> Column:
    """Likes per hundred views; 0 without views."""
    return _per_hundred_views(likes, views)


def engagement_rate(views: Column, likes: Column, dislikes: Column, comments: Column) -> Column:
    """Reactions per hundred views; 0 without views.

    The sum is taken in double so that absurd counters cannot overflow a bigint.
    """
    reactions = likes.cast("double") + dislikes.cast("double") + comments.cast("double")
    return _per_hundred_views(reactions, views)


def exact_mean(ratio: Column) -> Column:
    """Mean of a column rounded to four digits, independent of the order of summation.

    Scaled by 10^4 the values are whole numbers, and doubles add whole numbers
    exactly below 2^53, so partial sums may be merged in any order.
    """
    scaled = F.sum(F.rint(ratio * F.lit(10.0**RATIO_DIGITS)))
    return F.try_divide(scaled, F.count(ratio) * F.lit(10.0**RATIO_DIGITS))


def share_pct(part: Column, total: Column) -> Column:
    """``part`` of ``total`` in percent; null when the total is zero or null."""
    return F.round(F.try_divide(part, total) * 100, SHARE_DIGITS)
