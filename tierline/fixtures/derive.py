"""Snapshot inputs with defects, derived by rule from the star-schema tables.

Nothing here groups or collects rows: every payload comes from one line item,
so the inputs grow with the tables without a shuffle of their own.
"""

from __future__ import annotations

import os
from datetime import datetime
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators.landing import PARTITIONS as LANDING_FOLDERS
from tierline.operators.landing import land
from tierline.plans.contracts import LANDED_AT, SOURCE_FILE
from tierline.session import fresh_path, materialise
from tierline.sources.writers import laid_out

AS_OF = datetime(2021, 6, 1, 12, 0, 0)
RUN_AT = datetime(2021, 5, 31, 6, 30, 15)
SOURCE = "test_tables"

_paths: dict[tuple[str, ...], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table, dealt out over all tasks."""
    return table(spark, sf_dir, "lineitem").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


def once(spark: SparkSession, label: str, sf_dir: str, write) -> str:
    """A folder written by ``write(path)`` on first use in this application and shared afterwards."""
    key = (spark.sparkContext.applicationId, label, sf_dir)
    if key not in _paths:
        path = fresh_path(spark, label)
        write(path)
        _paths[key] = path
    return _paths[key]


def counters() -> list[Column]:
    """Raw counters of a line item."""
    return [
        F.expr("if(l_partkey % 97 = 0, null, concat(l_orderkey, '-', l_linenumber))").alias("video_id"),
        F.expr(
            "case when l_partkey % 83 = 0 then null when l_partkey % 79 = 0 then '0' "
            "else cast(cast(floor(l_extendedprice) as bigint) as string) end"
        ).alias("views"),
        F.expr("cast(cast(l_quantity as decimal(12,1)) as string)").alias("likes"),
        F.expr("cast(l_linenumber as string)").alias("dislikes"),
        F.expr("cast(3 * l_linenumber as string)").alias("comment_count"),
        F.expr("cast(l_shipdate as timestamp_ntz)").alias(LANDED_AT),
        F.expr("concat('part-', lpad(l_partkey, 12, '0'))").alias(SOURCE_FILE),
    ]


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as raw counters; no join."""
    return line_items(spark, sf_dir).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *counters())


def trending_date() -> Column:
    """The trending-date text in both layouts, from the month of the order, 20 years on."""
    month = "add_months(trunc(cast(o_orderdate as date), 'month'), 240)"
    return F.expr(
        f"case when l_partkey % 89 = 0 then 'n/a' "
        f"when l_linenumber % 2 = 1 then date_format({month}, 'yy.dd.MM') "
        f"else date_format({month}, 'yyyy-MM-dd') end"
    ).alias("trending_date")


def with_dates(spark: SparkSession, sf_dir: str, base: DataFrame) -> DataFrame:
    """Adds the trending-date text."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    return base.join(orders, "l_orderkey").withColumn("trending_date", trending_date())


def nation_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The region of each nation in upper case with a blank on either side."""
    regions = table(spark, sf_dir, "region")
    return table(spark, sf_dir, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), F.concat(F.lit(" "), F.upper("r_name"), F.lit(" ")).alias("region")
    )


def with_regions(spark: SparkSession, sf_dir: str, base: DataFrame) -> DataFrame:
    """Adds the region of the customer's nation."""
    customers = (
        table(spark, sf_dir, "customer")
        .join(nation_regions(spark, sf_dir), "c_nationkey")
        .select(F.col("c_custkey").alias("o_custkey"), "region")
    )
    return base.join(customers, "o_custkey")


def snapshots(spark: SparkSession, sf_dir: str, by_region: bool = False) -> DataFrame:
    """History rows with all contract columns as text, plus their origin.

    Keys and numbers are joined first; texts are made of them after the last join, so that no shuffle of a join carries
    these. Nations are found for orders, of which there are fewer than lines, and get their region's name at the end.
    ``by_region`` lays rows out by it, also before texts are made.
    """
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate").join(customers, "o_custkey")
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_shipdate"
    )
    dated = items.join(orders.drop("o_custkey").withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey")
    channels = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("channel_title")
    )
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.col("p_name").alias("title"),
        # ids that no document has, for every tenth size
        F.expr("cast(if(p_size % 10 = 0, p_size + 1000, p_size) as string)").alias("category_id"),
        F.concat_ws("|", "p_brand", "p_type").alias("tags"),
    )
    joined = dated.join(parts, "l_partkey").join(channels, "l_suppkey").join(nation_regions(spark, sf_dir), "c_nationkey")
    return (
        (laid_out(joined, ("region",)) if by_region else joined)
        .select("*", trending_date(), *counters())
        .select(
            "video_id",
            "trending_date",
            "title",
            "channel_title",
            "category_id",
            F.expr("date_format(o_orderdate, 'yyyy-MM-dd')").alias("publish_time"),
            "tags",
            "views",
            "likes",
            "dislikes",
            "comment_count",
            F.expr("if(l_linenumber = 4, null, concat('thumb/', l_partkey))").alias("thumbnail_link"),
            F.expr("case l_linenumber when 1 then 'True' when 2 then 'FALSE' when 3 then 'maybe' else 'f' end")
            .alias("comments_disabled"),
            F.lit("false").alias("ratings_disabled"),
            F.expr("if(l_partkey % 13 = 0, 'true', 'false')").alias("video_error_or_removed"),
            F.expr(
                "if(l_partkey % 7 = 0, concat('say \"', title, '\",', chr(10), 'line ', l_linenumber), title)"
            ).alias("description"),
            "region",
            LANDED_AT,
            SOURCE_FILE,
        )
    )


def items(of: str = "") -> str:
    """The items of a line's response; ``of`` stands before its fields."""
    item = f"""named_struct(
        'id', if({of}l_partkey % 97 = 0, null, concat({of}l_orderkey, '-', k)),
        'snippet', named_struct(
            'title', concat('title ', {of}l_partkey % 1000),
            'channelTitle', concat('Channel#', {of}l_suppkey),
            'categoryId', cast({of}l_partkey % 50 + 1 as string),
            'publishedAt', date_format({of}l_shipdate, 'yyyy-MM-dd'),
            'description', if({of}l_linenumber = 5, null, concat('order ', {of}l_orderkey)),
            'tags', if({of}l_linenumber = 4, null, array({of}l_returnflag, {of}l_linestatus)),
            'thumbnails', named_struct('default', named_struct('url', concat('thumb/', {of}l_partkey)))),
        'statistics', named_struct(
            'viewCount', case when {of}l_partkey % 83 = 0 then null when {of}l_partkey % 79 = 0 then '0'
                else cast(cast(floor({of}l_extendedprice) as bigint) + k as string) end,
            'likeCount', cast({of}l_quantity as string),
            'dislikeCount', if({of}l_linenumber = 2, null, cast({of}l_linenumber as string)),
            'commentCount', cast(3 * {of}l_linenumber as string)))"""
    return f"transform(slice(array(0, 1), 1, {of}l_linenumber % 3), k -> {item})"


def landed() -> Column:
    """The landing time of a line's response, as text."""
    second = "((l_partkey * 7 + l_linenumber) % 86400)"
    clock = (
        f"concat(lpad({second} div 3600, 2, '0'), ':', lpad({second} div 60 % 60, 2, '0'), ':', "
        f"lpad({second} % 60, 2, '0'))"
    )
    return F.expr(f"concat(date_format(l_shipdate, 'yyyy-MM-dd'), 'T', {clock}, '+00:00')").alias("landed")


def placed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the region, as it is spelled, date and hour that their responses land in."""
    place = {
        "region": F.expr(
            "case when l_returnflag = 'A' and l_linestatus = 'F' then ' US' when l_returnflag = 'A' then ' In ' "
            "when l_returnflag = 'N' then 'GB ' when l_linestatus = 'F' then 'ca' else 'DE' end"
        ),
        "date": F.expr("make_date(year(l_shipdate) + 20, 1, 1)"),
        "hour": F.expr("cast(12 * (l_linenumber % 2) as int)"),
    }
    return table(spark, sf_dir, "lineitem").withColumns(place)


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API responses with 0, 1 or 2 items, one per line item, with region and landing time.

    Item k of a line carries the order number, so lines of one order are copies of one video. Lines are laid out by the
    folders that they land in before payloads are made of them, so no shuffle carries payloads.
    """
    return laid_out(placed_lines(spark, sf_dir), LANDING_FOLDERS).select(
        F.expr(items()).alias("items"), *LANDING_FOLDERS, landed(), "l_orderkey", "l_linenumber"
    )


def stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamped_orders(spark, sf_dir).drop("l_orderkey")


def stamped_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads as they lie in the landing zone after many runs, each with its own landing time."""
    region = F.expr("lower(trim(region))")
    return payloads(spark, sf_dir).select(
        "items",
        F.struct(
            F.regexp_replace("landed", "[^0-9]", "").substr(1, 14).alias("ingestion_id"),
            region.alias("region"),
            F.col("landed").alias("ingestion_timestamp"),
            F.size("items").cast("bigint").alias("video_count"),
            F.lit(SOURCE).alias("source"),
        ).alias("_pipeline_metadata"),
        region.alias("region"),
        "date",
        "hour",
        "l_orderkey",
        "l_linenumber",
    )


def landing_zone(spark: SparkSession, sf_dir: str) -> str:
    return once(spark, "landing", sf_dir, lambda p: land(stamped(spark, sf_dir).drop("l_linenumber"), p, placed=True))


def drifted_zone(spark: SparkSession, sf_dir: str) -> str:
    """Two landings of the same payloads' shape: the first three lines of an order as ever, the others with leaves and types that
    no contract names. Their views and new counters are numbers, and every eleventh order's titles are objects."""
    changed = """transform(items, item -> named_struct('id', item.id,
        'snippet', named_struct('title', {title}, 'channelTitle', item.snippet.channelTitle, 'categoryId', item.snippet.categoryId,
            'publishedAt', item.snippet.publishedAt, 'tags', item.snippet.tags, 'thumbnails', item.snippet.thumbnails,
            'liveBroadcastContent', if(l_linenumber = 5, 'live', 'none')),
        'statistics', named_struct('viewCount', cast(item.statistics.viewCount as bigint), 'likeCount', item.statistics.likeCount,
            'commentCount', item.statistics.commentCount, 'favoriteCount', 2 * l_linenumber),
        'contentDetails', named_struct('duration', concat('PT', l_linenumber, 'M'), 'caption', l_linenumber = 7)))"""
    text = "to_json(named_struct('items', {items}, '_pipeline_metadata', _pipeline_metadata, 'etag', l_orderkey))"
    plain, titled = (changed.format(title=t) for t in ("item.snippet.title", "named_struct('text', item.snippet.title)"))

    def write(path: str) -> None:
        rows = stamped_orders(spark, sf_dir)
        for portion, value in (
            ("l_linenumber <= 3", text.format(items="items")),
            ("l_linenumber > 3", f"if(l_orderkey % 11 = 0, {text.format(items=titled)}, {text.format(items=plain)})"),
        ):
            lines = rows.where(portion).select("region", "date", "hour", F.expr(value).alias("value"))
            lines.write.mode("append").option("compression", "gzip").partitionBy(*LANDING_FOLDERS).text(path)

    return once(spark, "drifted", sf_dir, write)


def history_zone(spark: SparkSession, sf_dir: str) -> str:
    """The history rows as CSV below region folders, with quotes and line breaks in the text."""

    def write(path: str) -> None:
        rows = snapshots(spark, sf_dir, by_region=True).drop(LANDED_AT, SOURCE_FILE)
        rows.withColumn("region", F.expr("lower(trim(region))")).write.option("header", True).option("escape", '"').option(
            "compression", "gzip"
        ).partitionBy("region").csv(path)

    return once(spark, "history", sf_dir, write)


def history_copies(spark: SparkSession, sf_dir: str) -> str:
    """The history rows written twice, so that each has a copy in another file, with the columns in reverse order."""

    def write(path: str) -> None:
        rows = snapshots(spark, sf_dir, by_region=True).drop(LANDED_AT, SOURCE_FILE)
        # joined and laid out once for both copies
        rows = materialise(rows.withColumn("region", F.expr("lower(trim(region))")), "history-rows")
        for _ in range(2):
            rows.select(*reversed(rows.columns)).write.mode("append").option("header", True).option("escape", '"').option(
                "compression", "gzip"
            ).partitionBy("region").csv(path)

    return once(spark, "history-copies", sf_dir, write)


#: Orders in one indented response.
ORDERS_PER_RESPONSE = 6000
#: Level of gzip; indented text becomes less than a tenth at the first.
FASTEST = 1


def put_responses(responses: DataFrame, root: str) -> None:
    """Each text in ``value`` as a gzip file of its own below its folder of ``root``, named by ``part``.

    Hadoop's local file system starts a process for each file and checksum that it makes, to set its permissions, and a
    commit renames file by file on the driver. So where ``root`` is a folder that is mounted, each task puts its files
    there by itself, as API clients put objects; a task that runs again puts the same names again. Elsewhere Spark's
    writer is used.
    """
    responses.drop("part").limit(0).write.partitionBy(*LANDING_FOLDERS).text(root)  # a folder, also without any response
    mounted = urlsplit(root).path
    if not os.path.isdir(mounted):
        rows = responses.drop("part").write.mode("append").partitionBy(*LANDING_FOLDERS)
        rows.option("maxRecordsPerFile", 1).option("compression", "gzip").text(root)
        return
    names, level = LANDING_FOLDERS, FASTEST

    def put(rows):  # runs where this library need not be installed
        import gzip
        import os
        import uuid

        if not os.path.isdir(mounted):
            raise FileNotFoundError(f"{mounted} is not mounted here")
        for row in rows:
            values = ["__HIVE_DEFAULT_PARTITION__" if row[n] is None else row[n] for n in names]
            folder = os.path.join(mounted, *[f"{n}={v}" for n, v in zip(names, values)])
            os.makedirs(folder, exist_ok=True)
            unfinished = os.path.join(folder, f"_{uuid.uuid4().hex}")  # readers don't see names like this
            with open(unfinished, "wb") as file:
                file.write(gzip.compress(f"{row['value']}\n".encode(), level, mtime=0))
            os.replace(unfinished, os.path.join(folder, f"response-{row['part']}.json.gz"))

    responses.foreachPartition(put)


def pretty_zone(spark: SparkSession, sf_dir: str) -> str:
    """Indented responses as an API lands them, one file each, with the items of a range of orders for a region and
    hour; every seventh range is cut off. A range holds a fixed number of orders, so a response has a bounded size.

    Lines meet by response, and items and texts are made where they have met, so that no shuffle or sort carries these.
    """

    def write(path: str) -> None:
        place = LANDING_FOLDERS
        fields = (
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus",
            "l_shipdate",
        )
        part = F.expr(f"l_orderkey div {ORDERS_PER_RESPONSE}").alias("part")
        lines = placed_lines(spark, sf_dir).select(*fields, F.expr("lower(trim(region))").alias("region"), "date", "hour", part)
        met = lines.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *place, "part")
        n = F.col("l_linenumber") % 3
        responses = met.groupBy(*place, "part").agg(
            F.collect_list(F.when(n != 0, F.struct(*fields))).alias("lines"),
            F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("video_count"),
            F.max(landed()).alias("ingestion_timestamp"),
        )
        # in the order of folders, in which the writer wants them, before they grow; items are named once, so they become text
        # without being laid out as a column
        sent = responses.sortWithinPartitions(*place)
        listed = F.expr(f"flatten(sort_array(transform(lines, line -> {items('line.')})))").alias("items")
        stamp = F.struct("region", "ingestion_timestamp", "video_count").alias("_pipeline_metadata")
        text = F.to_json(F.struct(listed, stamp), {"pretty": "true"})
        sent = sent.select(*place, "part", text.alias("value"))
        cut = F.when(F.col("part") % 7 == 3, F.col("value").substr(1, 200)).otherwise(F.col("value"))
        put_responses(sent.withColumn("value", cut), path)

    return once(spark, "pretty", sf_dir, write)


def category_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category titles per brand, the brand standing for a region; some brands use other titles."""
    return (
        table(spark, sf_dir, "part")
        .select(
            F.expr("lower(replace(p_brand, '#', ''))").alias("region"),
            F.expr("cast(substr(p_brand, 7) as int)").alias("brand"),
            "p_size",
            F.expr("concat('cat-', p_size % 7, if(cast(substr(p_brand, 7) as int) % 4 = 0, '-alt', ''))").alias(
                "title"
            ),
        )
        .distinct()
    )


def category_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The titles as clean reference rows."""
    return category_titles(spark, sf_dir).select(
        F.col("p_size").cast("string").alias("id"), F.col("title").alias("snippet_title"), "region"
    )


def reference_zone(spark: SparkSession, sf_dir: str) -> str:
    """Category documents, one file per brand: good, empty, cut off, or without ``items``.

    A brand has at most 50 sizes, so a document holds at most 100 items.
    """
    item = (
        "named_struct('kind', 'category', 'etag', concat(region, '/', p_size, '/', pass), "
        "'id', cast(p_size as string), 'snippet', named_struct('channelId', concat('ch-', brand), "
        "'title', if(pass = 0, title, concat(title, '-new')), 'assignable', p_size % 2 = 0))"
    )
    entries = category_titles(spark, sf_dir).withColumn(
        "pass", F.explode(F.expr("if(p_size % 3 = 0, array(0, 1), array(0))"))
    )
    documents = entries.groupBy("region", "brand").agg(
        F.expr(f"transform(array_sort(collect_list(struct(pass, p_size, {item} as item))), e -> e.item)").alias("items")
    )
    text = (
        "case when brand % 7 = 0 then substr(to_json(named_struct('kind', 'list', 'items', items)), 1, 30) "
        "when brand % 5 = 0 then '{\"kind\": \"list\", \"items\": []}' "
        "when brand = 3 then to_json(items[0]) "
        "else to_json(named_struct('kind', 'list', 'items', items)) end"
    )
    day = "if(brand % 2 = 0, date'2021-05-30', date'2021-05-31')"

    def write(path: str) -> None:
        documents.select("region", F.expr(day).alias("date"), F.expr(text).alias("value")).write.partitionBy(
            "region", "date"
        ).text(path)

    return once(spark, "reference", sf_dir, write)


def reference_days_zone(spark: SparkSession, sf_dir: str) -> str:
    """Three days of documents for each brand, titles named by day; every fourth brand's last document is cut off."""

    def write(path: str) -> None:
        entries = category_titles(spark, sf_dir).withColumn("day", F.explode(F.array(*map(F.lit, range(3)))))
        item = "named_struct('id', cast(p_size as string), 'snippet', named_struct('title', concat(title, '-d', day)))"
        documents = entries.groupBy("region", "brand", "day").agg(
            F.expr(f"transform(array_sort(collect_list(struct(p_size, {item} as item))), e -> e.item)").alias("items")
        )
        text = "to_json(named_struct('items', items))"
        cut = f"if(day = 2 and brand % 4 = 1, substr({text}, 1, 25), {text})"
        documents.select(
            "region", F.expr("date_add(date'2021-05-29', day)").alias("date"), F.expr(cut).alias("value")
        ).write.partitionBy("region", "date").text(path)

    return once(spark, "reference-days", sf_dir, write)
