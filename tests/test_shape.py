from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F
from snapshot_rows import STATISTICS_DEFAULTS

from tierline.operators import shape
from tierline.operators.landing import land, landing_gaps, stamp_provenance
from tierline.plans.contracts import ENVELOPE, ITEM, STATISTICS_COLUMNS
from tierline.plans.silver import silver_statistics
from tierline.sources import envelope_errors, history_errors, read_envelopes, read_history_csv, restrict_regions

ITEMS = '{"id": "%s", "snippet": {"title": "t", "tags": ["a", "b"]}, "statistics": {"viewCount": "12.9"}}'


def envelopes(spark, *texts, region="US"):
    df = spark.createDataFrame([(t, region, date(2021, 5, 31), 6) for t in texts], "v string, region string, date date, hour int")
    return df.select(F.from_json("v", ENVELOPE).alias("e"), "region", "date", "hour").select("e.*", "region", "date", "hour")


def test_explode_drops_empty_and_missing_items(spark):
    df = envelopes(spark, f'{{"items": [{ITEMS % "a"}, {ITEMS % "b"}]}}', '{"items": []}', "{}")
    assert sorted(r.id for r in shape.explode_items(df).select("item.id").collect()) == ["a", "b"]


def test_leaves_a_file_lacks_are_null(spark):
    row = shape.conform(envelopes(spark, f'{{"items": [{ITEMS % "a"}]}}')).first()
    assert (row.video_id, row.views, row.dislikes, row.tags, row.trending_date) == ("a", 12, None, "a|b", "21.31.05")
    assert row.comments_disabled is False and tuple(row.asDict()) == STATISTICS_COLUMNS


def test_all_dialects_agree(spark):
    exploded = shape.explode_items(envelopes(spark, f'{{"items": [{ITEMS % "a"}]}}'))
    dunder = shape.nested_projection(exploded)
    dotted = dunder.toDF(*[c.replace("__", ".") for c in dunder.columns])
    kinds = [shape.detect_dialect(df.schema) for df in (exploded, dunder, dotted)]
    assert kinds == ["item", "dunder", "dotted"]
    first = shape.conform(exploded).collect()
    assert shape.conform(dunder).collect() == first and shape.conform(dotted).collect() == first


def test_absent_optional_fields_take_defaults(spark):
    exploded = shape.explode_items(envelopes(spark, f'{{"items": [{ITEMS % "a"}]}}'))
    less = shape.nested_projection(exploded).drop(
        "statistics__dislikeCount", "snippet__tags", "snippet__thumbnails__default__url", "date"
    )
    row = shape.conform_api(less, as_of=date(2020, 2, 29)).first()
    assert (row.dislikes, row.tags, row.thumbnail_link, row.trending_date) == (0, None, None, "20.29.02")
    with pytest.raises(ValueError, match="title"):
        shape.conform_api(less.drop("snippet__title"))


def test_history_rows_need_every_column(spark, history):
    assert shape.conform(history({})).first().views == 100
    with pytest.raises(ValueError, match="views"):
        shape.conform_csv(history({}).drop("views"))


def test_flatten_struct_to_snake_case(spark):
    df = spark.createDataFrame([(1,)], "x int").select(F.lit(None).cast(ITEM).alias("item"), "x")
    names = shape.flatten_struct(df, "item").columns
    assert names[:3] == ["id", "snippet_title", "snippet_channel_title"] and names[-1] == "x"
    assert "snippet_thumbnails_default_url" in names


def test_landing_round_trip(spark, folder):
    from datetime import datetime

    raw = envelopes(spark, f'{{"items": [{ITEMS % "a"}]}}', "{}", region=" US ").drop("_pipeline_metadata", "date", "hour")
    root = folder("land")
    land(stamp_provenance(raw, datetime(2021, 5, 31, 6, 1, 2), "src"), root)
    back = read_envelopes(spark, root)
    got = sorted(
        (r.region, r.hour, r["_pipeline_metadata"].ingestion_id, r["_pipeline_metadata"].video_count)
        for r in back.collect()
    )
    assert got == [("us", 6, "20210531_060102", 0), ("us", 6, "20210531_060102", 1)]
    gaps = {r.region: (r.status, r.payloads) for r in landing_gaps(["US", "gb"], back).collect()}
    assert gaps == {"us": ("success", 2), "gb": ("failed", 0)}


def test_region_filter_prunes_partitions(spark, folder):
    root = folder("prune")
    for code in ("us", "de"):
        land(envelopes(spark, "{}", region=code), root)
    kept = restrict_regions(read_envelopes(spark, root), ["US"])
    assert kept.count() == 1
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(region" in plan or "PartitionFilters: [(lower(trim(region" in plan


def test_one_document_per_file(spark, folder):
    root = folder("pretty")
    text = '{\n "items": [\n  {"id": "a"}\n ]\n}'
    spark.createDataFrame([(text, "us", "2021-05-31", 6)], "value string, region string, date string, hour int").write.partitionBy(
        "region", "date", "hour"
    ).option("lineSep", "\n\n").text(root)
    assert read_envelopes(spark, root, one_per_file=True).select(F.size("items")).first()[0] == 1


def test_history_csv_with_quotes_and_breaks(spark, folder, history):
    root = folder("csv")
    text = 'say "hi",\nthen go'
    history({"description": text}).write.option("header", True).option("escape", '"').partitionBy("region").csv(root)
    row = read_history_csv(spark, root).first()
    assert row.description == text and row.region == "US"


def test_history_columns_go_by_the_header(spark, folder, history):
    root = folder("swapped")
    rows = history({"views": "7", "likes": "1000"})
    rows.select(*reversed(rows.columns)).write.option("header", True).partitionBy("region").csv(root)
    row = read_history_csv(spark, root).first()
    assert (row.views, row.likes) == ("7", "1000") and row._source_file and row._landed_at


def test_every_file_goes_by_its_own_header(spark, folder, history):
    root = folder("headers")
    rows = history({"views": "7", "likes": "1000", "video_id": "a"}, {"views": "8", "likes": "2000", "video_id": "b", "region": "gb us"})
    orders = (rows.columns, list(reversed(rows.columns)), [c for c in rows.columns if c != "dislikes"], [*rows.columns, "video_id as note"])
    for columns in orders:
        rows.selectExpr(*columns).coalesce(1).write.mode("append").option("header", True).partitionBy("region").csv(root)
    read = read_history_csv(spark, root)
    assert sorted((r.video_id, r.views, r.likes, r.region) for r in read.collect()) == sorted([("a", "7", "1000", "US"), ("b", "8", "2000", "gb us")] * 4)
    assert sorted((r.dislikes or "", r.note or "") for r in read.collect()) == sorted([("1", "")] * 4 + [("0", "")] * 2 + [("1", "a"), ("1", "b")])
    assert history_errors(read).collect() == [] and len(shape.conform(read).collect()) == 8


def test_rows_of_a_file_that_lacks_a_column_are_errors(spark, folder, history):
    root = folder("lacking")
    history({"video_id": "a"}).write.option("header", True).partitionBy("region").csv(root)
    bad = history({"video_id": "b", "views": "5"}).select("video_id", "views", "region").coalesce(1)
    bad.write.mode("append").option("header", True).partitionBy("region").csv(root)
    read = read_history_csv(spark, root)
    assert [(r.text, r.error) for r in history_errors(read).collect()] == [("b,5", "row does not fit the header")]
    assert [r.video_id for r in shape.conform(read).collect()] == ["a"]


def test_history_rows_that_do_not_fit_are_told(spark, folder):
    root = folder("broken")
    names = [n for n in STATISTICS_DEFAULTS if n != "region"]
    text = ",".join(names) + "\n" + ",".join("x" for _ in names) + "\nonly,three,cells"
    spark.createDataFrame([(text, "us")], "value string, region string").write.partitionBy("region").text(root)
    rows = read_history_csv(spark, root)
    assert [r.text for r in history_errors(rows).collect()] == ["only,three,cells"]
    assert silver_statistics(rows).count() == 1


def test_broken_envelopes_are_told(spark, folder):
    root = folder("cut")
    for code, text in (("us", '{"items": [{"id": "a"}]}'), ("gb", '{"items": [{"id"'), ("in", '{"other": 1}')):
        spark.createDataFrame([(text, code, "2021-05-31", 6)], "value string, region string, date string, hour int").write.mode(
            "append"
        ).partitionBy("region", "date", "hour").text(root)
    for one_per_file in (False, True):
        envelopes = read_envelopes(spark, root, one_per_file)
        assert sorted(r.error for r in envelope_errors(envelopes).collect()) == ["no items", "not valid JSON"]
