"""Values that a history row takes where a test names none."""

STATISTICS_DEFAULTS = {
    "video_id": "v1",
    "trending_date": "20.31.01",
    "title": "t",
    "channel_title": "c",
    "category_id": "1",
    "publish_time": "2020-01-01",
    "tags": "a|b",
    "views": "100",
    "likes": "10",
    "dislikes": "1",
    "comment_count": "4",
    "thumbnail_link": "x",
    "comments_disabled": "False",
    "ratings_disabled": "False",
    "video_error_or_removed": "False",
    "description": "d",
    "region": "US",
}
