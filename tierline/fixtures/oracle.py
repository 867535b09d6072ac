"""The same results in plain SQL, for comparison on the same tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# shared steps -----------------------------------------------------------------

VIDEO_ID = "case when l_partkey % 97 = 0 then null else l_orderkey || '-' || l_linenumber end"
VIEWS = (
    "case when l_partkey % 83 = 0 then null when l_partkey % 79 = 0 then '0' "
    "else cast(cast(floor(l_extendedprice) as bigint) as varchar) end"
)
TO_LONG = r"try_cast(regexp_extract({0}, '^\s*([+-]?\d+)(\.\d*)?\s*$', 1) as bigint)"
COUNTERS = ("views", "likes", "dislikes", "comment_count")
STATISTICS = (
    "video_id, trending_date, title, channel_title, category_id, publish_time, tags, views, likes, dislikes, "
    "comment_count, thumbnail_link, comments_disabled, ratings_disabled, video_error_or_removed, description, region"
)


def to_long(column: str) -> str:
    return TO_LONG.format(column)


def to_bool(column: str) -> str:
    return (
        f"case when lower(trim({column})) in ('t', 'true', 'y', 'yes', '1') then true "
        f"when lower(trim({column})) in ('f', 'false', 'n', 'no', '0') then false end"
    )


def rate(numerator: str) -> str:
    return f"case when views > 0 then round(({numerator}) / views * 100, 4) else cast(0 as double) end"


def mean4(column: str) -> str:
    return f"sum(round({column} * 10000)) / (count({column}) * cast(10000 as double))"


def big(expression: str) -> str:
    return f"cast({expression} as bigint)"


LINES = f"""
lines as (
  select l_orderkey, l_partkey, l_suppkey, l_linenumber, {VIDEO_ID} as video_id, {VIEWS} as views,
    cast(l_quantity as varchar) as likes, cast(l_linenumber as varchar) as dislikes,
    cast(3 * l_linenumber as varchar) as comment_count, l_shipdate as landed_at
  from lineitem)"""

DATED = f"""{LINES},
dated as (
  select *, case when l_partkey % 89 = 0 then 'n/a' when l_linenumber % 2 = 1 then strftime(m, '%y.%d.%m')
      else strftime(m, '%Y-%m-%d') end as trending_date
  from (
    select lines.*, o_custkey, o_orderdate,
      cast(date_trunc('month', o_orderdate) + interval 20 year as date) as m
    from lines join orders on l_orderkey = o_orderkey))"""

RAW = f"""{DATED},
raw as (
  select video_id, trending_date, p_name as title, s_name as channel_title, cast(case when p_size % 10 = 0 then p_size + 1000 else p_size end as varchar) as category_id,
    strftime(o_orderdate, '%Y-%m-%d') as publish_time, p_brand || '|' || p_type as tags,
    views, likes, dislikes, comment_count,
    case when l_linenumber <> 4 then 'thumb/' || l_partkey end as thumbnail_link,
    case l_linenumber when 1 then 'True' when 2 then 'FALSE' when 3 then 'maybe' else 'f' end as comments_disabled,
    'false' as ratings_disabled,
    case when l_partkey % 13 = 0 then 'true' else 'false' end as video_error_or_removed,
    case when l_partkey % 7 = 0 then 'say "' || p_name || '",' || chr(10) || 'line ' || l_linenumber
      else p_name end as description,
    ' ' || upper(r_name) || ' ' as region, landed_at, l_partkey as tie_key
  from dated
    join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey join supplier on l_suppkey = s_suppkey join part on l_partkey = p_partkey)"""

CONFORMED = f"""{RAW},
conformed as (
  select * replace (
    {to_long("category_id")} as category_id,
    {", ".join(f"{to_long(c)} as {c}" for c in COUNTERS)},
    {to_bool("comments_disabled")} as comments_disabled, {to_bool("ratings_disabled")} as ratings_disabled,
    {to_bool("video_error_or_removed")} as video_error_or_removed)
  from raw)"""

CLEANSE = rf"""
  select *, {rate("likes")} as like_ratio, {rate("likes + dislikes + comment_count")} as engagement_rate
  from (
    select * replace (lower(trim(region)) as region, {", ".join(f"coalesce({c}, 0) as {c}" for c in COUNTERS)}),
      case when regexp_matches(trending_date, '^\d{{2}}\.\d{{2}}\.\d{{2}}$')
        then cast(try_strptime(trending_date, '%y.%d.%m') as date)
        else try_cast(trending_date as date) end as trending_date_parsed
    from conformed where video_id is not null)"""

SILVER = f"""{CONFORMED},
cleansed as ({CLEANSE}),
silver as (
  select * from cleansed
  qualify row_number() over (
    partition by video_id, region, trending_date_parsed order by landed_at desc, tie_key desc) = 1)"""

TITLES = """
titles as (
  select distinct lower(replace(p_brand, '#', '')) as region, cast(substr(p_brand, 7) as int) as brand, p_size,
    'cat-' || (p_size % 7) || case when cast(substr(p_brand, 7) as int) % 4 = 0 then '-alt' else '' end as title
  from part)"""

LOOKUP = f"""{TITLES},
lookup as (
  select cast(p_size as bigint) as category_id, arg_min(title, region) as category_name from titles group by 1)"""

ENRICHED = f"""{SILVER},{LOOKUP},
enriched as (
  select silver.*, coalesce(category_name, 'Unknown') as category_name
  from silver left join lookup using (category_id))"""

TRENDING_COLUMNS = f"""region, trending_date_parsed, count(video_id) as total_videos, {big("sum(views)")} as total_views,
    {big("sum(likes)")} as total_likes, {big("sum(dislikes)")} as total_dislikes,
    {big("sum(comment_count)")} as total_comments,
    cast(sum(views) as double) / count(views) as avg_views_per_video, {mean4("like_ratio")} as avg_like_ratio,
    {mean4("engagement_rate")} as avg_engagement_rate, max(views) as max_views,
    count(distinct channel_title) as unique_channels, count(distinct category_id) as unique_categories"""
TRENDING = f"""{ENRICHED},
trending as (select {TRENDING_COLUMNS} from enriched group by region, trending_date_parsed)"""

CHANNEL_COLUMNS = f"""channel_title, region, count(distinct video_id) as total_videos, {big("sum(views)")} as total_views,
    {big("sum(likes)")} as total_likes, {big("sum(comment_count)")} as total_comments,
    cast(sum(views) as double) / count(views) as avg_views_per_video,
    {mean4("engagement_rate")} as avg_engagement_rate, max(views) as peak_views,
    count(trending_date_parsed) as times_trending, min(trending_date_parsed) as first_trending,
    max(trending_date_parsed) as last_trending, list_sort(list(distinct category_name)) as categories"""
RANK = "cast(row_number() over (partition by region order by total_views desc, channel_title) as bigint)"
CHANNELS = f"""
channels as (
  select *, {RANK} as rank_in_region
  from (select {CHANNEL_COLUMNS} from enriched group by channel_title, region))"""
CHANNEL = f"{ENRICHED},{CHANNELS}"

CATEGORY = f"""{ENRICHED},
categories as (
  select *, round(total_views / nullif(sum(total_views) over (partition by region, trending_date_parsed), 0) * 100, 2)
      as view_share_pct
  from (
    select category_name, category_id, region, trending_date_parsed, count(video_id) as video_count,
      {big("sum(views)")} as total_views, {big("sum(likes)")} as total_likes,
      {big("sum(comment_count)")} as total_comments, {mean4("engagement_rate")} as avg_engagement_rate,
      count(distinct channel_title) as unique_channels
    from enriched group by category_name, category_id, region, trending_date_parsed))"""

REGION_CODE = (
    "case when l_returnflag = 'A' and l_linestatus = 'F' then ' US' when l_returnflag = 'A' then ' In ' "
    "when l_returnflag = 'N' then 'GB ' when l_linestatus = 'F' then 'ca' else 'DE' end"
)
SECOND = "((l_partkey * 7 + l_linenumber) % 86400)"
PAYLOADS = f"""
payloads as (
  select *, {REGION_CODE} as raw_region, lower(trim({REGION_CODE})) as region,
    make_date(year(l_shipdate) + 20, 1, 1) as date, cast(12 * (l_linenumber % 2) as int) as hour,
    l_shipdate + to_seconds({SECOND}) as landed_at
  from lineitem)"""

ITEMS = f"""{PAYLOADS},
items as (
  select region, raw_region, date, hour, landed_at, l_orderkey, l_linenumber,
    case when l_partkey % 97 <> 0 then l_orderkey || '-' || k end as id, 'title ' || (l_partkey % 1000) as title,
    'Channel#' || l_suppkey as channel_title, cast(l_partkey % 50 + 1 as varchar) as category,
    strftime(l_shipdate, '%Y-%m-%d') as publish_time,
    case when l_linenumber <> 5 then 'order ' || l_orderkey end as description,
    case when l_linenumber <> 4 then l_returnflag || '|' || l_linestatus end as tags,
    'thumb/' || l_partkey as thumbnail_link,
    case when l_partkey % 83 = 0 then null when l_partkey % 79 = 0 then '0'
      else cast(cast(floor(l_extendedprice) as bigint) + k as varchar) end as view_text,
    cast(l_quantity as varchar) as like_text,
    case when l_linenumber <> 2 then cast(l_linenumber as varchar) end as dislike_text,
    cast(3 * l_linenumber as varchar) as comment_text
  from (select *, unnest(range(l_linenumber % 3)) as k from payloads))"""

FROM_API = f"""{ITEMS},
conformed as (
  select id as video_id, strftime(date, '%y.%d.%m') as trending_date, title, channel_title,
    {to_long("category")} as category_id, publish_time, tags, {to_long("view_text")} as views,
    {to_long("like_text")} as likes, {to_long("dislike_text")} as dislikes,
    {to_long("comment_text")} as comment_count, thumbnail_link, false as comments_disabled,
    false as ratings_disabled, false as video_error_or_removed, description, region, landed_at
  from items)"""

API_SILVER = f"""{FROM_API},
silver as (
  select * from ({CLEANSE})
  qualify row_number() over (partition by video_id, region, trending_date_parsed order by landed_at desc) = 1)"""

DOCUMENTS = f"""{TITLES},
entries as (
  select *, row_number() over (partition by region order by pass, p_size) - 1 as position,
    case when pass = 0 then title else title || '-new' end as item_title
  from titles, lateral (select unnest(case when p_size % 3 = 0 then [0, 1] else [0] end) as pass)),
brands as (
  select region, brand, case when brand % 2 = 0 then date '2021-05-30' else date '2021-05-31' end as date,
    brand % 7 = 0 as corrupt, brand % 7 <> 0 and brand % 5 = 0 as is_empty, count(*) as n
  from entries group by region, brand),
good as (
  select entries.*, brands.date from entries join brands using (region)
  where not corrupt and not is_empty and (entries.brand <> 3 or position = 0)),
last_entries as (
  select * from good qualify row_number() over (partition by region, p_size order by position desc) = 1)"""


def sql(name: str, steps: str, select: str) -> None:
    ORACLE[name] = (f"with {steps.strip()}\n" if steps else "") + select


# sources ------------------------------------------------------------------------

sql(
    "scan_envelopes",
    PAYLOADS,
    f"select region, date, hour, count(*) as envelopes, {big('sum(l_linenumber % 3)')} as items, "
    f"{big('sum(l_linenumber % 3)')} as videos from payloads group by region, date, hour",
)
sql(
    "scan_history_csv",
    RAW,
    "select video_id, trending_date, title, category_id, views, description, lower(trim(region)) as region from raw",
)
sql(
    "scan_reference",
    DOCUMENTS,
    "select region, date, cast(case when corrupt or brand = 3 then -1 when is_empty then 0 else n end as int) "
    "as items, corrupt from brands",
)
sql("scan_table", ITEMS, "select id as video_id, like_text as likes, region from items")
sql(
    "region_pruned_scan",
    ITEMS,
    "select region, count(*) as items, count(distinct id) as videos from items "
    "where region in ('ca', 'gb', 'in', 'us') group by region",
)
sql(
    "incremental_ingest",
    API_SILVER,
    f"select {STATISTICS}, trending_date_parsed, like_ratio, engagement_rate from silver",
)
sql(
    "empty_input_noop",
    SILVER,
    f'select region, count(*) as "rows", {big("sum(views)")} as views from silver group by region',
)
sql(
    "reference_for_day",
    DOCUMENTS,
    "select region, cast(p_size as varchar) as id, item_title as snippet_title, cast(position as int) as position "
    "from good where date = date '2021-05-31'",
)

sql(
    "drift_capture",
    f"""{ITEMS},
conformed as (
  select id as video_id, strftime(date, '%y.%d.%m') as trending_date, {to_long("view_text")} as views, {to_long("like_text")} as likes,
    cast(null as bigint) as dislikes, cast(null as bigint) as comment_count, region, landed_at, title as given, l_linenumber as line,
    l_linenumber > 3 and l_orderkey % 11 = 0 as titled
  from items),
silver as (
  select * from ({CLEANSE})
  qualify row_number() over (partition by video_id, region, trending_date_parsed order by landed_at desc) = 1)""",
    """select video_id, region, trending_date_parsed, case when not titled then given end as title, views, likes,
      case when line > 3 then case when line = 5 then 'live' else 'none' end end as live,
      case when line > 3 then cast(2 * line as bigint) end as favorites, case when line > 3 then 'PT' || line || 'M' end as duration,
      case when line > 3 then line = 7 end as captioned, case when titled then given end as kept_title, cast(null as bigint) as unfit
    from silver""",
)
ITEM_LEAVES = (
    ("id", "STRING", "string", "same", "id is not null"), ("snippet.title", "STRING", "string", "same", "not titled"),
    ("snippet.title", "OBJECT", "string", "refuse", "titled"), ("snippet.channelTitle", "STRING", "string", "same", "true"),
    ("snippet.categoryId", "STRING", "string", "same", "true"), ("snippet.publishedAt", "STRING", "string", "same", "true"),
    ("snippet.description", "STRING", "string", "same", "not late and description is not null"),
    ("snippet.tags", "ARRAY<STRING>", "array<string>", "same", "tags is not null"),
    ("snippet.thumbnails.default.url", "STRING", "string", "same", "true"),
    ("snippet.liveBroadcastContent", "STRING", None, "keep apart", "late"),
    ("statistics.viewCount", "STRING", "string", "same", "not late and view_text is not null"),
    ("statistics.viewCount", "BIGINT", "string", "as text", "late and view_text is not null"),
    ("statistics.likeCount", "STRING", "string", "same", "true"),
    ("statistics.dislikeCount", "STRING", "string", "same", "not late and dislike_text is not null"),
    ("statistics.commentCount", "STRING", "string", "same", "true"),
    ("statistics.favoriteCount", "BIGINT", None, "keep apart", "late"),
    ("contentDetails.duration", "STRING", None, "keep apart", "late"), ("contentDetails.caption", "BOOLEAN", None, "keep apart", "late"),
)
sql(
    "drift_report",
    f"{ITEMS},\njudged as (select *, l_linenumber > 3 as late, l_linenumber > 3 and l_orderkey % 11 = 0 as titled from items)",
    "select * from ("
    + " union all ".join(
        f"select '{path}' as path, '{seen}' as seen, {'cast(null as varchar)' if kind is None else chr(39) + kind + chr(39)} as contract, "
        f"'{action}' as action, count(*) as items from judged where {condition}"
        for path, seen, kind, action, condition in ITEM_LEAVES
    )
    + ") where items > 0",
)

sql(
    "redelivered_intake",
    PAYLOADS,
    """select cast(1 as int) as run, cast(sum(l_linenumber % 3) as bigint) as items, count(distinct region) filter (l_linenumber % 3 > 0 and l_partkey % 97 <> 0) as regions
      from payloads where l_linenumber <= 4
    union all select 2, coalesce(cast(sum(l_linenumber % 3) as bigint), 0), count(distinct region) filter (l_partkey % 97 <> 0)
      from payloads where l_linenumber = 5 and region <> 'us'""",
)
sql(
    "footer_profile",
    SILVER,
    """select region, count(*) as "rows", """
    + ", ".join(f"count({c}) as count_{c}" + ("" if c == "video_id" else f", min({c}) as min_{c}, max({c}) as max_{c}")
                for c in ("video_id", "views", "likes", "comment_count", "engagement_rate"))
    + " from silver group by region",
)
sql(
    "landing_gap_spans",
    f"""{PAYLOADS},
slots as (
  select region, slot from (select unnest(['us', 'in', 'gb', 'ca', 'de', 'jp']) as region), (select unnest(range(61368)) as slot)),
missed as (
  select region, slot, slot - row_number() over (partition by region order by slot) as run from slots
  where not exists (select 1 from payloads p where p.region = slots.region and slot = floor((epoch(landed_at) - epoch(timestamp '1995-01-01')) / 3600)))""",
    """select region, timestamp '1995-01-01' + to_hours(cast(min(slot) as int)) as first_missed, timestamp '1995-01-01' + to_hours(cast(max(slot) as int)) as last_missed,
      count(*) as missed, max(slot) = 61367 as open from missed group by region, run""",
)
DAY = r"""case when regexp_matches(trending_date, '^\d{2}\.\d{2}\.\d{2}$') then cast(try_strptime(trending_date, '%y.%d.%m') as date)
  else try_cast(trending_date as date) end"""
FAULTS = (
    ("no_video_id", "quarantine", "video_id is null"), ("no_title", "flag", "title is null or trim(title) = ''"),
    ("no_channel", "flag", "channel_title is null"), ("no_views", "flag", "views is null"), ("negative_views", "quarantine", "views < 0"),
    ("no_trending_date", "flag", f"({DAY}) is null"), ("more_likes_than_views", "flag", "likes > views"),
)


def flag_bits(changed: str = "views < 0") -> str:
    faults = [changed if name == "negative_views" else fault for name, _, fault in FAULTS]
    return " + ".join(f"case when {fault} then {1 << i} else 0 end" for i, fault in enumerate(faults))


FAULTY = f"""{CONFORMED},
faulty as (
  select * replace (case when likes % 13 = 0 then -views else views end as views,
    case when category_id % 9 = 0 then null else channel_title end as channel_title) from conformed),
judged as (select *, cast({flag_bits()} as bigint) as mask, cast({flag_bits('views < -20000')} as bigint) as later from faulty)"""
sql(
    "row_flags",
    FAULTY,
    " union all ".join(
        f"select '{name}' as rule, '{action}' as action, {big(f'coalesce(sum((mask >> {i}) & 1), 0)')} as \"rows\", "
        f"count(*) filter (mask = {1 << i}) as alone from judged"
        for i, (name, action, _) in enumerate(FAULTS)
    ),
)
sql(
    "quarantine_readmission",
    f"{FAULTY},\nletin as (select * exclude (mask, later), case when mask & 17 = 0 then mask else later end as flags from judged where later & 17 = 0),\n"
    f"silver as (select * from ({CLEANSE.replace('from conformed where', 'from letin where')}) "
    "qualify row_number() over (partition by video_id, region, trending_date_parsed order by landed_at desc, tie_key desc) = 1)",
    "select video_id, region, trending_date_parsed, views, channel_title, engagement_rate, flags from silver",
)
sql(
    "quarantine_rows",
    f"{FAULTY},\nheld as (select case when dislikes <= 3 then 'a' else 'b' end as batch, later & 17 = 0 as let_in, "
    "case when later & 17 = 0 then later else mask end as kept from judged where mask & 17 <> 0)",
    "select batch, concat_ws('|', " + ", ".join(f"case when kept & {1 << i} <> 0 then '{name}' end" for i, (name, _, _) in enumerate(FAULTS))
    + ') as faults, count(*) as "rows", count(*) filter (let_in) as readmitted from held group by all',
)

# landing ------------------------------------------------------------------------

sql(
    "landing_stamp",
    PAYLOADS,
    "select l_orderkey, l_linenumber, '20210531_063015' as ingestion_id, region, "
    "'2021-05-31T06:30:15+00:00' as ingestion_timestamp, cast(l_linenumber % 3 as bigint) as video_count, "
    "'test_tables' as source, date '2021-05-31' as date, cast(6 as int) as hour from payloads",
)
sql(
    "landing_partitions",
    PAYLOADS,
    "select region, date, hour, count(*) as payloads from payloads group by region, date, hour",
)
sql(
    "landing_gaps",
    PAYLOADS,
    "select e.region, case when coalesce(n, 0) > 0 then 'success' else 'failed' end as status, "
    "coalesce(n, 0) as payloads from (select unnest(['us','gb','ca','de','fr','in','jp','kr','mx','ru']) as region) e "
    "left join (select region, count(*) as n from payloads group by region) p on e.region = p.region",
)

# projection and shape -----------------------------------------------------------

sql("explode_items", ITEMS, "select l_orderkey, l_linenumber, raw_region as region, id from items")
sql(
    "nested_projection",
    ITEMS,
    'select region, id, title as snippet__title, channel_title as "snippet__channelTitle", '
    'category as "snippet__categoryId", publish_time as "snippet__publishedAt", tags as snippet__tags, '
    'description as snippet__description, thumbnail_link as thumbnail_url, view_text as "statistics__viewCount", '
    'like_text as "statistics__likeCount", dislike_text as "statistics__dislikeCount", '
    'comment_text as "statistics__commentCount" from items',
)
sql(
    "dialect_dunder",
    FROM_API,
    f"select 'dunder' as dialect, {STATISTICS} from conformed union all "
    f"select 'dotted' as dialect, {STATISTICS} from conformed",
)
sql("conform_api", FROM_API, f"select {STATISTICS} from conformed")
sql("conform_csv", CONFORMED, f"select {STATISTICS} from conformed")
sql(
    "cast_long",
    """texts as (
  select l_orderkey, l_linenumber, case l_linenumber when 1 then ' ' || l_quantity || ' '
    when 2 then '-' || l_extendedprice when 3 then 'none' when 4 then '+' || l_partkey when 5 then l_partkey || 'e3'
    when 6 then '.' || l_partkey else '99999999999999999999' end as text from lineitem)""",
    r"select *, case when regexp_matches(text, '^\.\d+$') then 0 else " + to_long("text") + " end as number from texts",
)
sql(
    "cast_bool",
    """texts as (
  select l_orderkey, case l_linenumber when 1 then 'True' when 2 then ' FALSE ' when 3 then 'maybe' when 4 then 'f'
    when 5 then '1' when 6 then null else 'no' end as text from lineitem)""",
    f"select l_orderkey, text, {to_bool('text')} as flag from texts",
)
sql(
    "field_defaults",
    FROM_API,
    "select video_id, '20.29.02' as trending_date, cast(0 as bigint) as dislikes, cast(null as varchar) as tags, "
    "cast(null as varchar) as thumbnail_link, comments_disabled, ratings_disabled, video_error_or_removed "
    "from conformed",
)
sql(
    "tags_text",
    RAW + "," + ITEMS.lstrip(),
    'select tags, count(*) as "rows" from (select tags from items union all select tags from raw) group by tags',
)
sql(
    "flatten_reference",
    DOCUMENTS,
    "select region, 'category' as kind, region || '/' || p_size || '/' || pass as etag, cast(p_size as varchar) as id, "
    "'ch-' || brand as snippet_channel_id, item_title as snippet_title, p_size % 2 = 0 as snippet_assignable, "
    "cast(position as int) as position from good",
)

# filters and cleansing ----------------------------------------------------------

sql(
    "drop_null_key",
    LINES,
    "select video_id, views, likes, dislikes, comment_count from lines where video_id is not null",
)
sql("normalise_region", PAYLOADS, "select l_orderkey, l_linenumber, region from payloads")
sql(
    "parse_trending_date",
    DATED,
    "select l_orderkey, l_linenumber, trending_date, case when l_partkey % 89 <> 0 then m end "
    "as trending_date_parsed from dated",
)
FILLED = f"""{LINES},
filled as (select l_orderkey, l_partkey, l_linenumber,
  {", ".join(f"coalesce({to_long(c)}, 0) as {c}" for c in COUNTERS)} from lines)"""
sql("zero_fill", FILLED, "select * from filled")
sql("like_ratio", FILLED, f"select l_orderkey, l_partkey, l_linenumber, {rate('likes')} as like_ratio from filled")
sql(
    "engagement_rate",
    FILLED,
    f"select l_orderkey, l_partkey, l_linenumber, {rate('likes + dislikes + comment_count')} as engagement_rate "
    "from filled",
)
sql(
    "audit_columns",
    LINES,
    "select video_id, '2021-06-01 12:00:00' as _processed_at, 'nightly' as _job_name from lines",
)
sql(
    "dedup_latest",
    SILVER,
    "select video_id, region, trending_date_parsed, views, 'part-' || lpad(cast(tie_key as varchar), 12, '0') "
    "as _source_file from silver",
)
sql(
    "silver_counters",
    SILVER,
    "select count(*) as rows_kept, count(*) - count(video_id) as null_video_id, count(*) - count(title) as null_title, "
    "count(*) - count(channel_title) as null_channel_title, count(*) - count(views) as null_views, "
    "count(*) filter (views < 0) as negative_views, (select count(*) from raw) as rows_read, "
    "(select count(*) from raw) - count(*) as rows_removed from silver",
)
sql(
    "silver_statistics",
    SILVER,
    f"select {STATISTICS}, trending_date_parsed, like_ratio, engagement_rate, 'silver_statistics' as _job_name "
    "from silver",
)

# reference ----------------------------------------------------------------------

sql(
    "reference_validate",
    DOCUMENTS,
    "select region, cast(case when is_empty then 0 when brand = 3 then 1 else n end as int) as items, "
    "case when is_empty then 'id,snippet_title' else '' end as missing_columns, "
    "case when is_empty then 'error' else 'ok' end as severity from brands where not corrupt",
)
sql(
    "reference_dedup_last",
    DOCUMENTS,
    "select region, cast(p_size as varchar) as id, item_title as snippet_title, "
    "region || '/' || p_size || '/' || pass as etag from last_entries",
)
sql(
    "reference_lineage",
    DOCUMENTS,
    "select region, cast(p_size as varchar) as id, 'category' as kind, 'ch-' || brand as snippet_channel_id, "
    "item_title as snippet_title, p_size % 2 = 0 as snippet_assignable, '2021-06-01 12:00:00' as _ingestion_timestamp, "
    "true as has_source from last_entries",
)
sql(
    "region_from_path",
    PAYLOADS,
    """select l_orderkey, l_linenumber, case l_linenumber
    when 1 then 'raw/region=' || trim(raw_region) || '/date=2021-05-31/' || l_orderkey
    when 2 then 'raw/' || l_orderkey || '.json' when 3 then 'raw/xregion=us/' || l_orderkey
    when 4 then 'region=' || l_orderkey || '/region=us' else 'raw/date=2021-05-31/region=' || region end as path,
  case l_linenumber when 1 then trim(raw_region) when 2 then 'unknown' when 3 then 'unknown'
    when 4 then cast(l_orderkey as varchar) else region end as region from payloads""",
)
sql(
    "reference_errors",
    DOCUMENTS,
    "select region, case when corrupt then 'not valid JSON' else 'no category items' end as error "
    "from brands where corrupt or is_empty",
)

# joins --------------------------------------------------------------------------

sql("category_lookup", LOOKUP, "select * from lookup")
sql(
    "enrich_category",
    ENRICHED,
    "select video_id, region, trending_date_parsed, category_id, category_name from enriched",
)
sql(
    "unknown_fill",
    ENRICHED,
    f'select category_name, category_id, count(*) as "rows", {big("sum(views)")} as views '
    "from enriched group by category_name, category_id",
)
sql(
    "enrich_no_reference",
    SILVER,
    f"select 'Unknown' as category_name, count(*) as \"rows\", {big('sum(views)')} as views from silver",
)

# aggregations and windows -------------------------------------------------------

sql("trending_analytics", TRENDING, "select * from trending")
sql("channel_analytics", CHANNEL, "select * from channels")
sql("category_analytics", CATEGORY, "select * from categories")
sql(
    "multi_distinct",
    SILVER,
    "select region, trending_date_parsed, count(distinct channel_title) as unique_channels, "
    "count(distinct category_id) as unique_categories from silver group by region, trending_date_parsed",
)
sql("rank_in_region", CHANNEL, "select region, channel_title, total_views, rank_in_region from channels")
sql(
    "view_share_pct",
    CATEGORY,
    "select category_name, category_id, region, trending_date_parsed, view_share_pct from categories",
)

# serving ------------------------------------------------------------------------

sql(
    "top_channels_region",
    CHANNEL,
    "select channel_title, total_views, times_trending from channels where region = 'asia' "
    "order by total_views desc, channel_title limit 10",
)
sql(
    "top_channels",
    CHANNEL,
    "select channel_title, region, total_videos, total_views, avg_engagement_rate, rank_in_region from channels "
    "order by total_views desc, channel_title, region limit 10",
)
sql(
    "views_by_region",
    TRENDING,
    f"select region, {big('sum(total_views)')} as total_views from trending group by region",
)
sql(
    "category_share_top8",
    CATEGORY,
    "select category_name, sum(round(view_share_pct * 100)) / (count(view_share_pct) * cast(100 as double)) "
    "as view_share_pct from categories group by category_name order by 2 desc, 1 limit 8",
)
sql(
    "kpi_row",
    TRENDING + "," + CHANNELS.lstrip(),
    f"select {big('sum(total_videos)')} as total_videos, {big('sum(total_views)')} as total_views, "
    "cast(sum(floor(avg_engagement_rate * 10000 + 0.5)) as double) / (count(avg_engagement_rate) * cast(10000 as double)) "
    "as avg_engagement, "
    "(select count(distinct channel_title) from channels) as total_channels from trending",
)
sql(
    "region_filter",
    TRENDING + "," + CHANNELS.lstrip() + "," + CATEGORY[len(ENRICHED) + 1 :].lstrip(),
    " union all ".join(
        f"select '{mart}' as mart, '{choice}' as choice, count(*) as \"rows\", {big('sum(total_views)')} as views "
        f"from {relation} where {condition}"
        for mart, relation in (("trending", "trending"), ("channel", "channels"), ("category", "categories"))
        for choice, condition in (("All", "true"), ("Europe", "region = 'europe'"))
    ),
)

# quality ------------------------------------------------------------------------

CRITICAL = ("video_id", "title", "channel_title", "views", "region")
DEFECTS = f"""{SILVER},
defects as (
  select * exclude (title) replace (
    case when dislikes <> 3 then channel_title end as channel_title,
    case when dislikes = 1 then -views when dislikes = 2 then views * 100000000 else views end as views)
  from silver)"""


def null_checks(table: str, present: tuple[str, ...], extra: str = "") -> str:
    parts = []
    for column in CRITICAL:
        if column in present:
            share = f"coalesce(100.0 * (count(*) - count({column})) / nullif(count(*), 0), 0)"
            parts.append(
                f"select {extra}'null_pct' as \"check\", 'clean_statistics' as \"table\", '{column}' as \"column\", "
                f"round(cast({share} as double), 2) as value, cast(5 as double) as threshold, "
                f"{share} <= 5 as passed from {table}"
            )
        else:
            parts.append(
                f"select {extra}'null_pct', 'clean_statistics', '{column}', cast(null as double), "
                "cast(null as double), false"
            )
    return " union all ".join(parts)


WITHOUT_TITLE = tuple(c for c in CRITICAL if c != "title")
NEGATIVE = "count(*) filter (views < 0)"
EXTREME = "count(*) filter (views > 50000000000)"


def all_checks(table: str, present: tuple[str, ...]) -> str:
    """check, table, column, value, threshold, passed, negative_count, extreme_count of every check."""
    none, no_count = "cast(null as double)", "cast(null as bigint)"
    head = "'clean_statistics' as \"table\""
    return f"""
  select 'row_count' as "check", {head}, cast(null as varchar) as "column", cast(count(*) as double) as value,
    cast(10 as double) as threshold, count(*) >= 10 as passed, {no_count} as negative_count,
    {no_count} as extreme_count from {table}
  union all select *, {no_count}, {no_count} from ({null_checks(table, present)})
  union all select 'schema', 'clean_statistics', null, {none}, {none}, {str(present == CRITICAL).lower()},
    {no_count}, {no_count}
  union all select 'value_range', 'clean_statistics', 'views', {none}, {none}, {NEGATIVE} + {EXTREME} = 0,
    {NEGATIVE}, {EXTREME} from {table}
  union all select 'freshness', 'clean_statistics', null, {none}, {none}, count(*) > 0,
    {no_count}, {no_count} from {table}"""


MISSING = (
    " union all select 'read_table', 'no_such_statistics_table', null, cast(null as double), cast(null as double), "
    "false, cast(null as bigint), cast(null as bigint)"
)
GATE_GOOD = f"{SILVER},\nresults as ({all_checks('silver', CRITICAL)}{MISSING})"
GATE_BAD = f"{DEFECTS},\nresults as ({all_checks('defects', WITHOUT_TITLE)}{MISSING})"

sql(
    "dq_row_count",
    SILVER,
    "select 'row_count' as \"check\", 'clean_statistics' as \"table\", cast(count(*) as double) as value, "
    "cast(t as double) as threshold, count(*) >= t as passed "
    "from silver, (select unnest([10, 1000000000000]) as t) group by t",
)
sql(
    "dq_null_pct",
    DEFECTS,
    null_checks("silver", CRITICAL, "'good' as variant, ")
    + " union all "
    + null_checks("defects", WITHOUT_TITLE, "'bad' as variant, "),
)
sql(
    "dq_schema",
    "",
    "select 'schema' as \"check\", 'clean_statistics' as \"table\", true as passed, '' as missing_columns "
    "union all select 'schema', 'clean_statistics', false, 'title'",
)
sql(
    "dq_value_range",
    DEFECTS,
    " union all ".join(
        "select 'value_range' as \"check\", 'clean_statistics' as \"table\", 'views' as \"column\", "
        f"{NEGATIVE} as negative_count, {EXTREME} as extreme_count, {NEGATIVE} + {EXTREME} = 0 as passed from {t}"
        for t in ("silver", "defects")
    ),
)
LATEST = "max(cast(landed_at as timestamp))"
FRESH = {
    "fresh": (f"{LATEST} >= timestamp '1998-11-30'", LATEST),
    "stale": (f"{LATEST} - interval 490 hour >= timestamp '1998-11-30'", f"{LATEST} - interval 490 hour"),
    "unreadable": ("count(*) >= 0", None),
    "unstamped": ("count(*) >= 0", None),
    "empty": ("count(*) < 0", "cast(null as timestamp)"),
}
sql(
    "dq_freshness",
    SILVER,
    " union all ".join(
        f"select '{variant}' as variant, 'freshness' as \"check\", {passed} as passed, "
        + (
            f"strftime({latest}, '%Y-%m-%d %H:%M:%S') as latest_record, '1998-11-30 00:00:00' as cutoff from silver"
            if latest
            else "cast(null as varchar) as latest_record, cast(null as varchar) as cutoff from silver"
        )
        for variant, (passed, latest) in FRESH.items()
    ),
)
sql("dq_missing_table", GATE_GOOD, 'select "check", "table", "column", value, passed from results')
sql(
    "dq_summary",
    GATE_BAD,
    f"select bool_and(passed) as quality_passed, count(*) filter (passed) as checks_passed, count(*) as checks_total "
    f"from ({all_checks('silver', CRITICAL)}) union all "
    "select bool_and(passed), count(*) filter (passed), count(*) from results",
)
sql(
    "dq_failures",
    GATE_BAD,
    'select "check", "table", "column", value, negative_count, extreme_count from results where not passed',
)
sql(
    "dq_from_states",
    f"{DEFECTS},\nresults as ({all_checks('defects', WITHOUT_TITLE)})",
    'select "check", "table", "column", value, negative_count, extreme_count, passed from results',
)
# sinks --------------------------------------------------------------------------

sql(
    "sink_append",
    SILVER,
    f'select region, 2 * count(*) as "rows", {big("2 * sum(views)")} as views from silver group by region',
)
sql(
    "sink_dynamic_overwrite",
    SILVER,
    f"select region, count(*) as \"rows\", {big('sum(views + case when region = ' + chr(39) + 'asia' + chr(39) + ' then 1 else 0 end)')} "
    "as views from silver group by region",
)
sql(
    "publish_switch",
    SILVER,
    f"""select 'early' as reader, region, count(*) as "rows", {big("sum(views)")} as views from silver group by region
    union all select 'late', region, count(*), {big("sum(views + case when region = 'asia' then 1 else 0 end)")} from silver group by region""",
)
sql(
    "sink_schema_growth",
    SILVER,
    f'select region, count(*) as "rows", {big("sum(views)")} as views, '
    f"case when region = 'asia' then {big('sum(likes)')} end as likes from silver group by region",
)

# flow ---------------------------------------------------------------------------

FLOW = f"""{API_SILVER},{DOCUMENTS.lstrip()},
lookup as (
  select cast(p_size as bigint) as category_id, arg_min(item_title, region) as category_name
  from last_entries group by 1),
enriched as (
  select silver.*, coalesce(category_name, 'Unknown') as category_name
  from silver left join lookup using (category_id)),{CHANNELS}"""
sql(
    "gated_gold",
    FLOW,
    "select channel_title, region, total_videos, total_views, times_trending, "
    "array_to_string(categories, '|') as categories, rank_in_region from channels",
)
sql("channel_incremental", FLOW, "select * from channels")
sql(
    "gold_incremental",
    f"{API_SILVER},{DOCUMENTS.lstrip()},\nenriched as (select * from silver)",
    f"select {TRENDING_COLUMNS} from enriched group by region, trending_date_parsed",
)
REFERENCE_CHECKS = """
  select 'row_count' as "check", 'clean_reference_data' as "table", cast(null as varchar) as "column",
    cast(count(*) as double) as value, count(*) >= 10 as passed from last_entries
  union all select 'null_pct', 'clean_reference_data', unnest(['id', 'region']), cast(0 as double), true
  union all select 'schema', 'clean_reference_data', null, null, true
  union all select 'freshness', 'clean_reference_data', null, null, count(*) > 0 from last_entries
  union all select 'read_table', 'clean_comments', null, null, false"""
sql(
    "gated_missing_table",
    f"{API_SILVER},{DOCUMENTS.lstrip()},\nresults as ({all_checks('silver', CRITICAL)})",
    f'select "check", "table", "column", value, passed from results union all {REFERENCE_CHECKS}',
)
SILVER_COLUMNS = f"{STATISTICS}, trending_date_parsed, like_ratio, engagement_rate"
ORACLE["incremental_after_reset"] = ORACLE["incremental_ingest"]
sql(
    "history_to_silver",
    f"{CONFORMED},\ncleansed as ({CLEANSE})",
    f"select {SILVER_COLUMNS} from cleansed qualify row_number() over (partition by video_id, region, "
    "trending_date_parsed order by views desc, likes desc, title desc, tags desc, channel_title desc, category_id desc) = 1",
)
ORACLE["mixed_silver"] = f"({ORACLE['history_to_silver']}) union all ({ORACLE['incremental_ingest']})"
sql(
    "incremental_schema_growth",
    SILVER,
    "select video_id, region, views, case when views % 2 = 0 then 'n-' || title end as note from silver",
)
PRETTY = f"""{PAYLOADS},
responses as (
  select region, date, hour, l_orderkey // 6000 as part, sum(l_linenumber % 3) as items
  from payloads group by all)"""
sql(
    "scan_envelopes_pretty",
    PRETTY,
    f"select region, date, hour, count(*) as envelopes, {big('sum(items)')} as items from responses "
    "where part % 7 <> 3 group by region, date, hour",
)
sql(
    "envelope_errors",
    PRETTY,
    "select region, 'not valid JSON' as error, cast(200 as int) as length, count(*) as files from responses "
    "where part % 7 = 3 group by region",
)
sql(
    "reference_latest_day",
    TITLES,
    "select region, cast(p_size as varchar) as id, title || '-d' || case when brand % 4 = 1 then 1 else 2 end "
    "as snippet_title from titles",
)
READ = (
    "(select count(*) from conformed) || ' rows read, ' || (select count(*) from silver) || ' rows kept, ' "
    "|| (select (select count(*) from conformed) - count(*) from silver) || ' rows removed'"
)
sql(
    "run_report",
    API_SILVER,
    f"""select run, cast(position as int) as position, stage, status, message from (values
  ('passed', 1, 'landing', 'succeeded', 'payloads landed'),
  ('passed', 2, 'reference', 'succeeded', 'reference rows written'),
  ('passed', 3, 'statistics', 'succeeded', '1 new batches merged: ' || {READ}),
  ('passed', 4, 'quality_gate', 'succeeded', '14 of 14 checks passed'),
  ('passed', 5, 'gold', 'succeeded', 'marts written'),
  ('stopped', 1, 'landing', 'succeeded', 'payloads landed'),
  ('stopped', 2, 'reference', 'succeeded', 'reference rows written'),
  ('stopped', 3, 'statistics', 'succeeded', 'all statistics rows rewritten: ' || {READ}),
  ('stopped', 4, 'quality_gate', 'failed', '8 of 9 checks passed'),
  ('stopped', 5, 'gold', 'skipped', '')) t(run, position, stage, status, message)""",
)
