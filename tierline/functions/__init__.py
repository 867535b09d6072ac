"""Column functions: text normalisation, tolerant casts, metrics."""

from tierline.functions.metrics import engagement_rate, exact_mean, like_ratio, share_pct
from tierline.functions.text import (
    clean_region,
    region_from_path,
    tags_text,
    to_bool,
    to_long,
    trending_day,
)

__all__ = [
    "clean_region",
    "engagement_rate",
    "exact_mean",
    "like_ratio",
    "region_from_path",
    "share_pct",
    "tags_text",
    "to_bool",
    "to_long",
    "trending_day",
]
