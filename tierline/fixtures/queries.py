"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline import functions as fn
from tierline.fixtures import derive as d
from tierline.operators import cleanse, drift, enrich, flags, landing, marts, quality, reference, serving, shape
from tierline.plans import contracts, quarantine
from tierline.plans.contracts import COUNTERS, SNAPSHOT_KEY
from tierline.plans.flow import run_flow
from tierline.plans.gold import lookup_or_none
from tierline.plans.silver import SilverCount, cleansed, silver_reference, silver_statistics
from tierline.plans.states import QualityStates
from tierline.session import fresh_path, materialise
from tierline.sources import (
    append_partitions,
    envelope_errors,
    grow_table,
    publish,
    read_envelopes,
    read_history_csv,
    read_landed_text,
    read_reference,
    read_table,
    reference_for_day,
    register_table,
    replace_partitions,
    restrict_regions,
)
from tierline.sources import footers
from tierline.sources.writers import CODEC
from tierline.streaming import merge_snapshots, read_stored, run_increment, take_in
from tierline.streaming.intake import clear_pending, pending_partitions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
STATS, REFS = "clean_statistics", "clean_reference_data"


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# inputs ---------------------------------------------------------------------


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_statistics(d.snapshots(spark, sf_dir), d.AS_OF)


def _lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference.category_lookup(d.category_rows(spark, sf_dir))


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich_category(_silver(spark, sf_dir), _lookup(spark, sf_dir))


def _stored_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of enriched Silver that marts read, worked out once for all of them; sorted, so marts shuffle fewer bytes."""
    def write(path: str) -> None:
        columns = (*SNAPSHOT_KEY, "channel_title", "category_id", "category_name", *COUNTERS, "like_ratio", "engagement_rate")
        rows = _enriched(spark, sf_dir).select(*columns).sortWithinPartitions("region", "trending_date_parsed", "video_id")
        rows.write.option("compression", CODEC).parquet(path)

    return spark.read.parquet(d.once(spark, "enriched", sf_dir, write))


def _mart(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A stored mart, as serving queries find it."""
    path = d.once(spark, name, sf_dir, lambda p: build(_stored_enriched(spark, sf_dir)).write.parquet(p))
    return spark.read.parquet(path)


def _trending_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mart(spark, sf_dir, "trending-mart", marts.trending_analytics)


def _category_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mart(spark, sf_dir, "category-mart", marts.category_analytics)


def _channel_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = fresh_path(spark, "ranges")
    return _mart(spark, sf_dir, "channel-mart", lambda enriched: marts.channel_analytics(enriched, ranges))


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.explode_items(d.stamped(spark, sf_dir))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_reference(spark, d.reference_zone(spark, sf_dir))


def _file_region(path: str = contracts.SOURCE_FILE):
    return fn.region_from_path(F.col(path)).alias("region")


def _table_name(path: str) -> str:
    return "t_" + path.rsplit("-", 1)[-1]


# sources --------------------------------------------------------------------


@query
def scan_envelopes(spark, sf_dir):
    envelopes = read_envelopes(spark, d.landing_zone(spark, sf_dir))
    return envelopes.groupBy("region", "date", "hour").agg(
        F.count(F.lit(1)).alias("envelopes"),
        F.sum(F.size("items").cast("bigint")).alias("items"),
        F.sum("_pipeline_metadata.video_count").alias("videos"),
    )


@query
def drift_capture(spark, sf_dir):
    """Silver from landings whose leaves and types changed: contract columns, and leaves of the extras made columns."""
    silver = fresh_path(spark, "drift-silver")
    run_increment(spark, d.drifted_zone(spark, sf_dir), silver, fresh_path(spark, "drift-checkpoint"), d.AS_OF, capture=True)
    leaves = {
        "live": ("snippet.liveBroadcastContent", "string"), "favorites": ("statistics.favoriteCount", "bigint"),
        "duration": ("contentDetails.duration", "string"), "captioned": ("contentDetails.caption", "boolean"),
        "kept_title": ("snippet.title.text", "string"), "unfit": ("contentDetails.duration", "bigint"),
    }
    rows = drift.promoted(read_stored(spark, silver), leaves)
    return rows.select("video_id", "region", "trending_date_parsed", "title", "views", "likes", *leaves)


@query
def drift_report(spark, sf_dir):
    """Which types came at which paths of the items, how often, and what becomes of them."""
    return drift.drift(drift.item_variants(read_landed_text(spark.read, d.drifted_zone(spark, sf_dir))))


@query
def scan_history_csv(spark, sf_dir):
    rows = read_history_csv(spark, d.history_zone(spark, sf_dir))
    return rows.select("video_id", "trending_date", "title", "category_id", "views", "description", "region")


@query
def scan_envelopes_pretty(spark, sf_dir):
    envelopes = read_envelopes(spark, d.pretty_zone(spark, sf_dir), one_per_file=True)
    return envelopes.where("items is not null").groupBy("region", "date", "hour").agg(
        F.count(F.lit(1)).alias("envelopes"), F.sum(F.size("items").cast("bigint")).alias("items")
    )


@query
def envelope_error_rows(spark, sf_dir):
    envelopes = read_envelopes(spark, d.pretty_zone(spark, sf_dir), one_per_file=True)
    errors = envelope_errors(envelopes).select(_file_region(), "error", F.length("text").alias("length"))
    return errors.groupBy("region", "error", "length").agg(F.count(F.lit(1)).alias("files"))


QUERIES["envelope_errors"] = QUERIES.pop("envelope_error_rows")


@query
def scan_reference(spark, sf_dir):
    documents = _documents(spark, sf_dir)
    return documents.select(
        _file_region(),
        "date",
        F.coalesce(F.size("items"), F.lit(-1)).alias("items"),
        F.col("_corrupt_record").isNotNull().alias("corrupt"),
    )


@query
def scan_table(spark, sf_dir):
    path = fresh_path(spark, "scan")
    rows = _items(spark, sf_dir).select(
        F.col("item.id").alias("video_id"), F.col("item.statistics.likeCount").alias("likes"), "region"
    )
    append_partitions(rows, path)
    register_table(spark, _table_name(path), path, rows.schema)
    return read_table(spark, _table_name(path)).select("video_id", "likes", "region")


@query
def region_pruned_scan(spark, sf_dir):
    envelopes = read_envelopes(spark, d.landing_zone(spark, sf_dir))
    core = restrict_regions(envelopes, contracts.CORE_REGIONS)
    return shape.explode_items(core).groupBy("region").agg(
        F.count(F.lit(1)).alias("items"), F.countDistinct("item.id").alias("videos")
    )


@query
def incremental_ingest(spark, sf_dir):
    root, silver, checkpoint = (fresh_path(spark, x) for x in ("intake", "intake-silver", "intake-checkpoint"))
    for portion in ("l_linenumber <= 3", "l_linenumber > 3", None):
        if portion is not None:
            landing.land(d.stamped(spark, sf_dir).where(portion).drop("l_linenumber"), root, placed=True)
        run_increment(spark, root, silver, checkpoint, d.AS_OF)
    return spark.read.parquet(silver).select(
        *contracts.STATISTICS_COLUMNS, "trending_date_parsed", "like_ratio", "engagement_rate"
    )


@query
def redelivered_intake(spark, sf_dir):
    """What each of two runs took in and touched, where the second finds half of the payloads again and some new ones."""
    root, silver, checkpoint, touched = (fresh_path(spark, x) for x in ("again", "again-silver", "again-checkpoint", "again-touched"))
    told = []
    for run, portion in ((1, "l_linenumber <= 4"), (2, "l_linenumber in (1, 2, 5) and region <> 'us' or l_linenumber <= 2")):
        landing.land(d.stamped(spark, sf_dir).where(portion).drop("l_linenumber"), root, placed=True)
        done = take_in(spark, root, silver, checkpoint, d.AS_OF, touched_path=touched, redelivered_within="30 days")
        days = pending_partitions(spark, touched)
        regions = 0 if days is None else days.select("region").distinct().count()
        told.append((run, sum(c.get("rows_read", 0) for c in done), regions))
        clear_pending(spark, touched)
    return spark.createDataFrame(told, "run int, items bigint, regions bigint")


@query
def footer_profile(spark, sf_dir):
    """Rows, counts and extremes of stored Silver by region, from footers alone."""
    columns, by = ("video_id", "views", "likes", "comment_count", "engagement_rate"), ("region",)
    rows = _silver(spark, sf_dir).select(*columns, *by)
    path = d.once(spark, "footers", sf_dir, lambda p: replace_partitions(rows, p))
    return footers.profile(spark, path, rows.schema, columns, by)


SILVER_COLUMNS = (*contracts.STATISTICS_COLUMNS, "trending_date_parsed", "like_ratio", "engagement_rate")


# which of several snapshots with one key stays where files can't tell which is newer
LARGEST = ("views", "likes", "title", "tags", "channel_title", "category_id")


@query
def incremental_after_reset(spark, sf_dir):
    """Half of the files, then all of them with a stream that starts anew over the same table."""
    root, silver = fresh_path(spark, "reset"), fresh_path(spark, "reset-silver")
    for portion in ("l_linenumber <= 3", "l_linenumber > 3"):
        landing.land(d.stamped(spark, sf_dir).where(portion).drop("l_linenumber"), root, placed=True)
        run_increment(spark, root, silver, fresh_path(spark, "reset-checkpoint"), d.AS_OF)
    return spark.read.parquet(silver).select(*SILVER_COLUMNS)


@query
def incremental_schema_growth(spark, sf_dir):
    """Rows with a column more, then rows of the same region-days without it."""
    path = fresh_path(spark, "growing-silver")
    rows = materialise(_silver(spark, sf_dir), "growing-rows")
    merge_snapshots(rows.where("views % 2 = 0").withColumn("note", F.concat(F.lit("n-"), "title")), path)
    merge_snapshots(rows.where("views % 2 <> 0"), path)
    return spark.read.option("mergeSchema", True).parquet(path).select("video_id", "region", "views", "note")


@query
def history_to_silver(spark, sf_dir):
    """History with copies in other files and columns in another order."""
    rows = read_history_csv(spark, d.history_copies(spark, sf_dir))
    return silver_statistics(rows, d.AS_OF, latest=LARGEST).select(*SILVER_COLUMNS)


@query
def mixed_silver(spark, sf_dir):
    """API files and history in one table."""
    silver = fresh_path(spark, "mixed-silver")
    take_in(spark, d.landing_zone(spark, sf_dir), silver, fresh_path(spark, "mixed-checkpoint"), d.AS_OF)
    history = read_history_csv(spark, d.history_zone(spark, sf_dir))
    merge_snapshots(silver_statistics(history, d.AS_OF, latest=LARGEST), silver)
    return spark.read.parquet(silver).select(*SILVER_COLUMNS)


def _faulty(spark, sf_dir):
    """Conformed history rows, some with negative views or without a channel."""
    rows = shape.conform(d.snapshots(spark, sf_dir))
    return rows.withColumn("views", F.expr("if(likes % 13 = 0, -views, views)")).withColumn(
        "channel_title", F.expr("if(category_id % 9 = 0, null, channel_title)")
    )


@query
def row_flags(spark, sf_dir):
    """How many rows break each rule, and how many of these no other."""
    return flags.flag_counts(quarantine.judged(_faulty(spark, sf_dir)))


#: Rules that let rows with up to 20,000 views below zero in.
RELAXED = tuple(replace(r, fault="views < -20000") if r.name == "negative_views" else r for r in flags.STATISTICS_RULES)


def _readmitted(spark, sf_dir):
    """Silver from two batches with rows kept out, some of which are let in when a rule changes; and what was kept out."""
    silver, held = fresh_path(spark, "flagged-silver"), quarantine.Quarantine(spark, fresh_path(spark, "quarantine"))
    rows = materialise(_faulty(spark, sf_dir), "faulty-rows")
    for batch, portion in (("a", "dislikes <= 3"), ("b", "dislikes > 3")):
        merge_snapshots(quarantine.finished(held.route(rows.where(portion), batch), d.AS_OF), silver)
    held.readmit(silver, RELAXED, d.AS_OF)
    return read_stored(spark, silver), held.rows()


@query
def quarantine_readmission(spark, sf_dir):
    """Silver after rows that were kept out were let in, with the faults that they were let in with."""
    silver, _ = _readmitted(spark, sf_dir)
    return silver.select("video_id", "region", "trending_date_parsed", "views", "channel_title", "engagement_rate", F.col(flags.FLAGS).alias("flags"))


@query
def quarantine_rows(spark, sf_dir):
    """What was kept out of each batch, by its faults, and how much of it was let in later."""
    _, held = _readmitted(spark, sf_dir)
    names = F.array_join(flags.flag_names(flags.STATISTICS_RULES), "|").alias("faults")
    return held.groupBy("batch", names).agg(F.count(F.lit(1)).alias("rows"), F.count(quarantine.READMITTED).alias("readmitted"))


@query
def empty_input_noop(spark, sf_dir):
    path = fresh_path(spark, "noop")
    rows = _silver(spark, sf_dir).select("video_id", "views", "region")
    replace_partitions(rows, path)
    replace_partitions(spark.createDataFrame([], rows.schema), path)
    return spark.read.parquet(path).groupBy("region").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("views").alias("views")
    )


@query
def reference_for_day_rows(spark, sf_dir):
    of_day = reference_for_day(_documents(spark, sf_dir), date(2021, 5, 31))
    rows = reference.flatten_reference(reference.readable(of_day))
    return rows.select(_file_region(), "id", "snippet_title", "position")


QUERIES["reference_for_day"] = QUERIES.pop("reference_for_day_rows")


# landing --------------------------------------------------------------------


@query
def landing_stamp(spark, sf_dir):
    stamped = landing.stamp_provenance(d.payloads(spark, sf_dir), d.RUN_AT, d.SOURCE)
    return stamped.select("l_orderkey", "l_linenumber", "_pipeline_metadata.*", "date", "hour")


@query
def landing_partitions(spark, sf_dir):
    path = fresh_path(spark, "land")
    landing.land(d.stamped(spark, sf_dir).drop("l_linenumber"), path)
    landed = read_envelopes(spark, path)
    return landed.groupBy("region", "date", "hour").agg(F.count(F.lit(1)).alias("payloads"))


@query
def landing_gaps(spark, sf_dir):
    expected = ["US", "GB", "CA", "DE", "FR", "IN", "JP", "KR", "MX", "RU"]
    return landing.landing_gaps(expected, d.payloads(spark, sf_dir))


# projection and shape -------------------------------------------------------


@query
def landing_gap_spans(spark, sf_dir):
    """Runs of missed hourly landings of six regions, one of which never landed, over seven years."""
    landed = d.payloads(spark, sf_dir).select("region", F.try_to_timestamp("landed").alias("landed"))
    regions = ("us", "in", "gb", "ca", "de", "JP ")
    return landing.landing_gap_spans(regions, landed, datetime(1995, 1, 1), datetime(2001, 12, 31, 23), 1)


@query
def explode_items(spark, sf_dir):
    return shape.explode_items(d.payloads(spark, sf_dir)).select(
        "l_orderkey", "l_linenumber", "region", F.col("item.id").alias("id")
    )


@query
def nested_projection(spark, sf_dir):
    rows = shape.nested_projection(_items(spark, sf_dir))
    return rows.select(
        "region",
        "id",
        "snippet__title",
        "snippet__channelTitle",
        "snippet__categoryId",
        "snippet__publishedAt",
        F.array_join("snippet__tags", "|").alias("snippet__tags"),
        "snippet__description",
        F.col("snippet__thumbnails__default__url").alias("thumbnail_url"),
        "statistics__viewCount",
        "statistics__likeCount",
        "statistics__dislikeCount",
        "statistics__commentCount",
    )


@query
def dialect_dunder(spark, sf_dir):
    flat = shape.nested_projection(_items(spark, sf_dir))
    dotted = flat.select(*[F.col(c).alias(c.replace("__", ".")) for c in flat.columns])
    conformed = None
    for raw in (flat, dotted):
        rows = shape.conform(raw).withColumn("dialect", F.lit(shape.detect_dialect(raw.schema)))
        conformed = rows if conformed is None else conformed.unionByName(rows)
    return conformed.select("dialect", *contracts.STATISTICS_COLUMNS)


@query
def conform_api(spark, sf_dir):
    return shape.conform_api(_items(spark, sf_dir))


@query
def conform_csv(spark, sf_dir):
    return shape.conform_csv(d.snapshots(spark, sf_dir)).select(*contracts.STATISTICS_COLUMNS)


@query
def cast_long(spark, sf_dir):
    li = d.line_items(spark, sf_dir)
    text = F.expr(
        "case l_linenumber when 1 then concat(' ', l_quantity, ' ') when 2 then concat('-', l_extendedprice) "
        "when 3 then 'none' when 4 then concat('+', l_partkey) when 5 then concat(l_partkey, 'e3') "
        "when 6 then concat('.', l_partkey) else '99999999999999999999' end"
    )
    return li.select("l_orderkey", "l_linenumber", text.alias("text")).withColumn(
        "number", fn.to_long(F.col("text"))
    )


@query
def cast_bool(spark, sf_dir):
    rows = d.line_items(spark, sf_dir).select(
        "l_orderkey",
        F.expr(
            "case l_linenumber when 1 then 'True' when 2 then ' FALSE ' when 3 then 'maybe' when 4 then 'f' "
            "when 5 then '1' when 6 then null else 'no' end"
        ).alias("text"),
    )
    return rows.withColumn("flag", fn.to_bool(F.col("text")))


@query
def field_defaults(spark, sf_dir):
    flat = shape.nested_projection(_items(spark, sf_dir)).drop(
        "statistics__dislikeCount", "snippet__tags", "snippet__thumbnails__default__url"
    )
    return shape.conform_api(flat, as_of=date(2020, 2, 29)).select(
        "video_id",
        "trending_date",
        "dislikes",
        "tags",
        "thumbnail_link",
        "comments_disabled",
        "ratings_disabled",
        "video_error_or_removed",
    )


@query
def tags_text(spark, sf_dir):
    rows = shape.conform_api(_items(spark, sf_dir)).select("tags")
    from_csv = shape.conform_csv(d.snapshots(spark, sf_dir)).select("tags")
    return rows.unionByName(from_csv).groupBy("tags").agg(F.count(F.lit(1)).alias("rows"))


@query
def flatten_reference(spark, sf_dir):
    rows = reference.flatten_reference(reference.readable(_documents(spark, sf_dir)))
    return rows.withColumn("region", _file_region()).drop(contracts.SOURCE_FILE)


# filters and cleansing ------------------------------------------------------


@query
def drop_null_key(spark, sf_dir):
    rows = cleanse.drop_null_key(d.lines(spark, sf_dir))
    return rows.select("video_id", "views", "likes", "dislikes", "comment_count")


@query
def normalise_region(spark, sf_dir):
    regions = cleanse.normalise_region(d.payloads(spark, sf_dir))
    return regions.select("l_orderkey", "l_linenumber", "region")


@query
def parse_trending_date(spark, sf_dir):
    dated = cleanse.parse_trending_date(d.with_dates(spark, sf_dir, d.lines(spark, sf_dir)))
    return dated.select("l_orderkey", "l_linenumber", "trending_date", "trending_date_parsed")


def _counters(spark, sf_dir):
    rows = d.lines(spark, sf_dir)
    return rows.select(
        "l_orderkey", "l_partkey", "l_linenumber", *[fn.to_long(F.col(c)).alias(c) for c in contracts.COUNTERS]
    )


@query
def zero_fill(spark, sf_dir):
    return cleanse.zero_fill(_counters(spark, sf_dir))


@query
def like_ratio(spark, sf_dir):
    rows = cleanse.add_ratios(cleanse.zero_fill(_counters(spark, sf_dir)))
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", "like_ratio")


@query
def engagement_rate(spark, sf_dir):
    rows = cleanse.add_ratios(cleanse.zero_fill(_counters(spark, sf_dir)))
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", "engagement_rate")


@query
def audit_columns(spark, sf_dir):
    rows = cleanse.audit_columns(d.lines(spark, sf_dir), "nightly", d.AS_OF)
    stamp = F.date_format("_processed_at", "yyyy-MM-dd HH:mm:ss").alias("_processed_at")
    return rows.select("video_id", stamp, "_job_name")


@query
def dedup_latest(spark, sf_dir):
    rows = cleansed(shape.conform_csv(d.snapshots(spark, sf_dir)), d.AS_OF)
    return cleanse.dedup_latest(rows).select(
        "video_id", "region", "trending_date_parsed", "views", contracts.SOURCE_FILE
    )


@query
def silver_counters(spark, sf_dir):
    raw = d.snapshots(spark, sf_dir)
    count = SilverCount(raw, d.AS_OF)
    count.silver.write.parquet(fresh_path(spark, "counted"))
    return spark.createDataFrame([count.counts()], ", ".join(f"{n} bigint" for n in sorted(count.counts())))


@query
def silver_statistics_rows(spark, sf_dir):
    rows = _silver(spark, sf_dir)
    return rows.drop("_processed_at", contracts.LANDED_AT, contracts.SOURCE_FILE)


QUERIES["silver_statistics"] = QUERIES.pop("silver_statistics_rows")


# reference ------------------------------------------------------------------


@query
def reference_validate(spark, sf_dir):
    checked = reference.validate_reference(_documents(spark, sf_dir))
    return checked.select(
        _file_region(), "items", F.array_join("missing_columns", ",").alias("missing_columns"), "severity"
    )


@query
def reference_dedup_last(spark, sf_dir):
    rows = reference.flatten_reference(reference.readable(_documents(spark, sf_dir)))
    return reference.dedup_last(rows).select(_file_region(), "id", "snippet_title", "etag")


@query
def reference_lineage(spark, sf_dir):
    rows = silver_reference(_documents(spark, sf_dir), d.AS_OF)
    return rows.select(
        "region",
        "id",
        "kind",
        "snippet_channel_id",
        "snippet_title",
        "snippet_assignable",
        F.date_format("_ingestion_timestamp", "yyyy-MM-dd HH:mm:ss").alias("_ingestion_timestamp"),
        F.col(contracts.SOURCE_FILE).contains("region=").alias("has_source"),
    )


@query
def reference_latest_day(spark, sf_dir):
    documents = read_reference(spark, d.reference_days_zone(spark, sf_dir))
    return silver_reference(documents, d.AS_OF, newest_only=True).select("region", "id", "snippet_title")


@query
def region_from_path(spark, sf_dir):
    paths = d.payloads(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        F.expr(
            "case l_linenumber when 1 then concat('raw/region=', trim(region), '/date=2021-05-31/', l_orderkey) "
            "when 2 then concat('raw/', l_orderkey, '.json') when 3 then concat('raw/xregion=us/', l_orderkey) "
            "when 4 then concat('region=', l_orderkey, '/region=us') "
            "else concat('raw/date=2021-05-31/region=', lower(trim(region))) end"
        ).alias("path"),
    )
    return paths.withColumn("region", fn.region_from_path(F.col("path")))


@query
def reference_errors(spark, sf_dir):
    return reference.reference_errors(_documents(spark, sf_dir)).select(_file_region(), "error")


# joins ----------------------------------------------------------------------


@query
def category_lookup(spark, sf_dir):
    return _lookup(spark, sf_dir)


@query
def enrich_category(spark, sf_dir):
    return _enriched(spark, sf_dir).select(
        "video_id", "region", "trending_date_parsed", "category_id", "category_name"
    )


@query
def unknown_fill(spark, sf_dir):
    names = _enriched(spark, sf_dir).groupBy("category_name", "category_id")
    return names.agg(F.count(F.lit(1)).alias("rows"), F.sum("views").alias("views"))


@query
def enrich_no_reference(spark, sf_dir):
    lookup = lookup_or_none(spark, "no_such_reference_table")
    rows = enrich.enrich_category(_silver(spark, sf_dir), lookup)
    return rows.groupBy("category_name").agg(F.count(F.lit(1)).alias("rows"), F.sum("views").alias("views"))


# aggregations and windows ---------------------------------------------------


@query
def trending_analytics(spark, sf_dir):
    return marts.trending_analytics(_enriched(spark, sf_dir))


@query
def channel_analytics(spark, sf_dir):
    return marts.channel_analytics(_enriched(spark, sf_dir), fresh_path(spark, "ranges"))


@query
def category_analytics(spark, sf_dir):
    return marts.category_analytics(_enriched(spark, sf_dir))


@query
def multi_distinct(spark, sf_dir):
    return marts.distinct_counts(_silver(spark, sf_dir))


@query
def rank_in_region(spark, sf_dir):
    rows = marts.channel_analytics(_enriched(spark, sf_dir), fresh_path(spark, "ranges"))
    return rows.select("region", "channel_title", "total_views", "rank_in_region")


@query
def view_share_pct(spark, sf_dir):
    rows = marts.category_analytics(_enriched(spark, sf_dir))
    return rows.select("category_name", "category_id", "region", "trending_date_parsed", "view_share_pct")


# serving --------------------------------------------------------------------


@query
def top_channels_region(spark, sf_dir):
    return serving.top_channels_region(_channel_mart(spark, sf_dir), "ASIA")


@query
def top_channels(spark, sf_dir):
    return serving.top_channels(_channel_mart(spark, sf_dir))


@query
def views_by_region(spark, sf_dir):
    return serving.views_by_region(_trending_mart(spark, sf_dir))


@query
def category_share_top8(spark, sf_dir):
    return serving.category_share_top(_category_mart(spark, sf_dir))


@query
def kpi_row(spark, sf_dir):
    return serving.kpi_row(_trending_mart(spark, sf_dir), _channel_mart(spark, sf_dir))


@query
def region_filter(spark, sf_dir):
    counted = None
    for name, mart in (
        ("trending", _trending_mart(spark, sf_dir)),
        ("channel", _channel_mart(spark, sf_dir)),
        ("category", _category_mart(spark, sf_dir)),
    ):
        for choice in ("All", "Europe"):
            one = serving.region_filter(mart, choice).agg(
                F.count(F.lit(1)).alias("rows"), F.sum("total_views").alias("views")
            )
            one = one.select(F.lit(name).alias("mart"), F.lit(choice).alias("choice"), "rows", "views")
            counted = one if counted is None else counted.unionByName(one)
    return counted


# quality --------------------------------------------------------------------


def _check(spark, sf_dir, check, df=None, rules=None, **options):
    df = _silver(spark, sf_dir) if df is None else df
    return quality.run_checks(df, STATS, d.AS_OF, rules, checks=[check], **options)


def _with_defects(spark, sf_dir):
    """Silver with nulls in channel_title, negative and absurd views, and no title column."""
    return _silver(spark, sf_dir).withColumns(
        {
            "channel_title": F.when(F.col("dislikes") != 3, F.col("channel_title")),
            "views": F.when(F.col("dislikes") == 1, -F.col("views"))
            .when(F.col("dislikes") == 2, F.col("views") * 100_000_000)
            .otherwise(F.col("views")),
        }
    ).drop("title")


@query
def dq_row_count(spark, sf_dir):
    rules = contracts.QUALITY_RULES[STATS]
    few = replace(rules, min_rows=1_000_000_000_000)
    good = _check(spark, sf_dir, "row_count")
    bad = _check(spark, sf_dir, "row_count", rules=few)
    return good.unionByName(bad).select("check", "table", "value", "threshold", "passed")


@query
def dq_null_pct(spark, sf_dir):
    good = _check(spark, sf_dir, "null_pct").withColumn("variant", F.lit("good"))
    bad = _check(spark, sf_dir, "null_pct", _with_defects(spark, sf_dir)).withColumn("variant", F.lit("bad"))
    return good.unionByName(bad).select("variant", "check", "table", "column", "value", "threshold", "passed")


@query
def dq_schema(spark, sf_dir):
    good = _check(spark, sf_dir, "schema")
    bad = _check(spark, sf_dir, "schema", _with_defects(spark, sf_dir))
    return good.unionByName(bad).select(
        "check", "table", "passed", F.array_join("missing_columns", ",").alias("missing_columns")
    )


@query
def dq_value_range(spark, sf_dir):
    good = _check(spark, sf_dir, "value_range")
    bad = _check(spark, sf_dir, "value_range", _with_defects(spark, sf_dir))
    return good.unionByName(bad).select(
        "check", "table", "column", "negative_count", "extreme_count", "passed"
    )


@query
def dq_freshness(spark, sf_dir):
    """Stamps are the rows' own landing days, checked as of the end of the tables' time."""
    landed = F.col(contracts.LANDED_AT).cast("timestamp")
    silver = _silver(spark, sf_dir).withColumn("_processed_at", landed)
    stale = silver.withColumn("_processed_at", landed - F.expr("interval 490 hours"))
    unreadable = silver.withColumn("_processed_at", F.lit("yesterday"))
    unstamped = silver.drop("_processed_at")
    empty = silver.where("views < 0")
    variants = {"fresh": silver, "stale": stale, "unreadable": unreadable, "unstamped": unstamped, "empty": empty}
    checked = None
    for name, df in variants.items():
        one = quality.run_checks(df, STATS, datetime(1998, 12, 2), checks=["freshness"]).select(
            F.lit(name).alias("variant"),
            "check",
            "passed",
            F.date_format("latest_record", "yyyy-MM-dd HH:mm:ss").alias("latest_record"),
            F.date_format("cutoff", "yyyy-MM-dd HH:mm:ss").alias("cutoff"),
        )
        checked = one if checked is None else checked.unionByName(one)
    return checked


def _gate(spark, sf_dir, silver):
    missing = quality.check_table(spark, "no_such_statistics_table")
    return quality.run_checks(silver, STATS, d.AS_OF).unionByName(missing)


@query
def dq_missing_table(spark, sf_dir):
    return _gate(spark, sf_dir, _silver(spark, sf_dir)).select("check", "table", "column", "value", "passed")


@query
def dq_summary(spark, sf_dir):
    good = quality.summary(quality.run_checks(_silver(spark, sf_dir), STATS, d.AS_OF))
    bad = quality.summary(_gate(spark, sf_dir, _with_defects(spark, sf_dir)))
    return good.unionByName(bad)


@query
def dq_failures(spark, sf_dir):
    failed = quality.failures(_gate(spark, sf_dir, _with_defects(spark, sf_dir)))
    return failed.select("check", "table", "column", "value", "negative_count", "extreme_count")


@query
def dq_from_states(spark, sf_dir):
    """All checks of a table with defects, merged in two batches, from the states that each batch brought up to date."""
    table, states_path = fresh_path(spark, "stated"), fresh_path(spark, "states")
    rows = materialise(_with_defects(spark, sf_dir), "defect-rows")
    for portion in ("video_id < '2'", "video_id >= '2'"):
        touched = merge_snapshots(rows.where(portion), table)
        stored = read_stored(spark, table)
        states = QualityStates(spark, states_path, STATS, stored.schema, contracts.QUALITY_RULES[STATS])
        states.update(stored, touched)
    return states.results(d.AS_OF).select("check", "table", "column", "value", "negative_count", "extreme_count", "passed")


# sinks ----------------------------------------------------------------------


def _region_counts(df):
    return df.groupBy("region").agg(F.count(F.lit(1)).alias("rows"), F.sum("views").alias("views"))


def _narrow_silver(spark, sf_dir):
    return _silver(spark, sf_dir).select("video_id", "views", "region")


@query
def sink_append(spark, sf_dir):
    path, rows = fresh_path(spark, "append"), materialise(_narrow_silver(spark, sf_dir), "append-rows")
    for _ in range(2):
        append_partitions(rows, path)
    return _region_counts(spark.read.parquet(path))


@query
def sink_dynamic_overwrite(spark, sf_dir):
    path = fresh_path(spark, "replace")
    rows = materialise(_narrow_silver(spark, sf_dir), "replace-rows")
    replace_partitions(rows, path)
    replace_partitions(rows.where("region = 'asia'").withColumn("views", F.col("views") + 1), path)
    return _region_counts(spark.read.parquet(path))


@query
def publish_switch(spark, sf_dir):
    """A table of which one region is replaced, seen by a reader that planned before the switch and by one after it."""
    root = fresh_path(spark, "published")
    name, rows = _table_name(root), _narrow_silver(spark, sf_dir)
    publish(rows, name, root)
    early = _region_counts(spark.table(name).where("region is not null")).withColumn("reader", F.lit("early"))
    early._jdf.queryExecution().executedPlan()  # a condition on partitions has them listed now
    publish(spark.table(name).where("region = 'asia'").withColumn("views", F.col("views") + 1), name, root)
    seen = spark.createDataFrame(early.collect(), early.schema)  # a row for each region; another plan would list anew
    return seen.unionByName(_region_counts(spark.table(name)).withColumn("reader", F.lit("late")))


@query
def sink_schema_growth(spark, sf_dir):
    path = fresh_path(spark, "grow")
    name = _table_name(path)
    rows = materialise(_silver(spark, sf_dir).select("video_id", "views", "likes", "region"), "grow-rows")
    old = rows.select("video_id", "views", "region")
    append_partitions(old.where("region <> 'asia'"), path)
    register_table(spark, name, path, old.schema)
    new = rows.where("region = 'asia'")
    append_partitions(new, path)
    grow_table(spark, name, new.schema)
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return read_table(spark, name).groupBy("region").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("views").alias("views"), F.sum("likes").alias("likes")
    )


# flow -----------------------------------------------------------------------


def _run(spark, sf_dir, rules=contracts.QUALITY_RULES, **options):
    payloads = d.stamped(spark, sf_dir).drop("l_linenumber")
    return run_flow(spark, payloads, _documents(spark, sf_dir), fresh_path(spark, "run"), d.AS_OF, rules, placed=True, **options)


@query
def gated_gold(spark, sf_dir):
    run = _run(spark, sf_dir)
    return run.table("channel_analytics").select(
        "channel_title",
        "region",
        "total_videos",
        "total_views",
        "times_trending",
        F.array_join("categories", "|").alias("categories"),
        F.col("rank_in_region").cast("bigint").alias("rank_in_region"),
    )


@query
def gold_incremental(spark, sf_dir):
    """The daily mart after two runs, of which the second rebuilt what its files touched."""
    root, documents = fresh_path(spark, "two-runs"), _documents(spark, sf_dir)
    for portion in ("l_linenumber <= 3", "l_linenumber > 3"):
        payloads = d.stamped(spark, sf_dir).where(portion).drop("l_linenumber")
        run = run_flow(spark, payloads, documents, root, d.AS_OF, placed=True)
    return run.table("trending_analytics").drop("_aggregated_at")


@query
def channel_incremental(spark, sf_dir):
    """The channel mart after three runs; videos change their channel, and the last run lands some payloads again."""
    root, documents = fresh_path(spark, "three-runs"), _documents(spark, sf_dir)
    for portion in ("l_linenumber <= 2", "l_linenumber between 3 and 4", "l_linenumber > 3"):
        payloads = d.stamped(spark, sf_dir).where(portion).drop("l_linenumber")
        run = run_flow(spark, payloads, documents, root, d.AS_OF, placed=True)
    return run.table("channel_analytics").drop("_aggregated_at")


@query
def gated_missing_table(spark, sf_dir):
    """All checks of a run, one of whose tables does not exist."""
    run = _run(spark, sf_dir, {**contracts.QUALITY_RULES, "clean_comments": contracts.QualityRules(critical=("id",))})
    return run.table("quality").select("check", "table", "column", "value", "passed")


@query
def run_report(spark, sf_dir):
    """An incremental run that passes the gate and a rebuild that cannot, as their report rows."""
    strict = {STATS: replace(contracts.QUALITY_RULES[STATS], max_value=0)}
    passed, stopped = _run(spark, sf_dir), _run(spark, sf_dir, strict, rebuild=True)
    rows = passed.table("runs").withColumn("run", F.lit("passed")).unionByName(
        stopped.table("runs").withColumn("run", F.lit("stopped"))
    )
    return rows.select("run", "position", "stage", "status", "message")
