"""What each table must look like, stated once and read by every operator."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """One target column of the statistics table.

    ``api`` is the path inside one API item. A field that the source may leave
    out is ``optional`` and then takes ``default``.
    """

    name: str
    type: str
    api: str | None = None
    optional: bool = False
    default: object = None


# fixed values: target columns, their types and where the API delivers them
STATISTICS: tuple[Field, ...] = (
    Field("video_id", "string", "id"),
    Field("trending_date", "string"),
    Field("title", "string", "snippet.title"),
    Field("channel_title", "string", "snippet.channelTitle"),
    Field("category_id", "bigint", "snippet.categoryId"),
    Field("publish_time", "string", "snippet.publishedAt"),
    Field("tags", "string", "snippet.tags", optional=True),
    Field("views", "bigint", "statistics.viewCount"),
    Field("likes", "bigint", "statistics.likeCount"),
    Field("dislikes", "bigint", "statistics.dislikeCount", optional=True, default=0),
    Field("comment_count", "bigint", "statistics.commentCount"),
    Field("thumbnail_link", "string", "snippet.thumbnails.default.url", optional=True),
    Field("comments_disabled", "boolean", optional=True, default=False),
    Field("ratings_disabled", "boolean", optional=True, default=False),
    Field("video_error_or_removed", "boolean", optional=True, default=False),
    Field("description", "string", "snippet.description"),
    Field("region", "string"),
)
STATISTICS_COLUMNS: tuple[str, ...] = tuple(f.name for f in STATISTICS)
COUNTERS: tuple[str, ...] = ("views", "likes", "dislikes", "comment_count")
SNAPSHOT_KEY: tuple[str, ...] = ("video_id", "region", "trending_date_parsed")

# where a row came from; carried next to the contract so the newest copy can be kept
LANDED_AT = "_landed_at"
SOURCE_FILE = "_source_file"
# the text of a record that could not be read
CORRUPT = "_corrupt_record"
# what a payload holds outside the contract
EXTRA = "_extra"

ITEM = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField(
            "snippet",
            T.StructType(
                [
                    T.StructField("title", T.StringType()),
                    T.StructField("channelTitle", T.StringType()),
                    T.StructField("categoryId", T.StringType()),
                    T.StructField("publishedAt", T.StringType()),
                    T.StructField("description", T.StringType()),
                    T.StructField("tags", T.ArrayType(T.StringType())),
                    T.StructField(
                        "thumbnails",
                        T.StructType(
                            [T.StructField("default", T.StructType([T.StructField("url", T.StringType())]))]
                        ),
                    ),
                ]
            ),
        ),
        T.StructField(
            "statistics",
            T.StructType(
                [
                    T.StructField("viewCount", T.StringType()),
                    T.StructField("likeCount", T.StringType()),
                    T.StructField("dislikeCount", T.StringType()),
                    T.StructField("commentCount", T.StringType()),
                ]
            ),
        ),
    ]
)

PROVENANCE = T.StructType(
    [
        T.StructField("ingestion_id", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("ingestion_timestamp", T.StringType()),
        T.StructField("video_count", T.LongType()),
        T.StructField("source", T.StringType()),
    ]
)

LANDING_PARTITIONS = T.StructType(
    [
        T.StructField("region", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("hour", T.IntegerType()),
    ]
)

ENVELOPE = T.StructType(
    [
        T.StructField("items", T.ArrayType(ITEM)),
        T.StructField("_pipeline_metadata", PROVENANCE),
    ]
)

HISTORY = T.StructType(
    [T.StructField(f.name, T.StringType()) for f in STATISTICS if f.name != "region"]
)

CATEGORY_ITEM = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("etag", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField(
            "snippet",
            T.StructType(
                [
                    T.StructField("channelId", T.StringType()),
                    T.StructField("title", T.StringType()),
                    T.StructField("assignable", T.BooleanType()),
                ]
            ),
        ),
    ]
)

# the document around the items; a file without "items" is read as one item itself
CATEGORY_DOCUMENT = T.StructType(
    [T.StructField("items", T.ArrayType(CATEGORY_ITEM)), *CATEGORY_ITEM.fields]
)


@dataclass(frozen=True)
class QualityRules:
    """Thresholds of the gate and the columns each table cannot do without."""

    critical: tuple[str, ...]
    min_rows: int = 10
    max_null_pct: float = 5.0
    ranged_column: str | None = None
    max_value: int = 50_000_000_000
    fresh_hours: int = 48
    stamps: tuple[str, ...] = ("_processed_at", "_ingestion_timestamp")


# fixed values: the columns each clean table cannot do without
QUALITY_RULES: dict[str, QualityRules] = {
    "clean_statistics": QualityRules(
        critical=("video_id", "title", "channel_title", "views", "region"), ranged_column="views"
    ),
    "clean_reference_data": QualityRules(critical=("id", "region")),
}

# fixed values: region codes the statistics job keeps when it is told to restrict itself
CORE_REGIONS: tuple[str, ...] = ("ca", "gb", "in", "us")

# fixed values: the columns of the marts
MARTS: dict[str, str] = {
    "trending_analytics": "region string, trending_date_parsed date, total_videos bigint, total_views bigint, "
    "total_likes bigint, total_dislikes bigint, total_comments bigint, avg_views_per_video double, "
    "avg_like_ratio double, avg_engagement_rate double, max_views bigint, unique_channels bigint, "
    "unique_categories bigint",
    "channel_analytics": "channel_title string, region string, total_videos bigint, total_views bigint, "
    "total_likes bigint, total_comments bigint, avg_views_per_video double, avg_engagement_rate double, "
    "peak_views bigint, times_trending bigint, first_trending date, last_trending date, categories array<string>, "
    "rank_in_region bigint",
    "category_analytics": "category_name string, category_id bigint, region string, trending_date_parsed date, "
    "video_count bigint, total_views bigint, total_likes bigint, total_comments bigint, avg_engagement_rate double, "
    "unique_channels bigint, view_share_pct double",
}
