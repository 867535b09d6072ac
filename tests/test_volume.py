"""What lands, is staged and is shuffled is no more than the work needs."""

from __future__ import annotations

import glob
import gzip
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tierline.fixtures import derive as d
from tierline.fixtures.queries import QUERIES
from tierline.operators.landing import land
from tierline.operators import cleanse, shape
from tierline.plans.silver import cleansed, newest, silver_statistics
from tierline.sources import read_envelopes, read_history_csv
from tierline.streaming import intake, merge_snapshots

SF = "/root/testdata/sf0.001"


def test_landed_envelopes_are_compressed_and_read_whole(spark, folder):
    root = folder("landed")
    payloads = d.stamped(spark, SF).drop("l_linenumber")
    land(payloads, root)
    files = glob.glob(f"{root}/region=*/date=*/hour=*/part-*")
    assert files and all(f.endswith(".json.gz") for f in files)
    told = lambda df: sorted(r.t for r in df.select(F.to_json(F.struct("items", "_pipeline_metadata", "region", "date", "hour")).alias("t")).collect())
    assert told(read_envelopes(spark, root)) == told(payloads)


def test_first_batch_of_a_table_is_staged_once_and_repaired(spark, history, folder, monkeypatch):
    path, staging = folder("once"), folder("once-staging")
    rows = lambda video, views: silver_statistics(history({"video_id": video, "views": views}), datetime(2021, 1, 1))
    replace = intake.replace_partitions

    def dies(*_):
        raise RuntimeError("gone")

    for key, (video, views) in enumerate((("a", "1"), ("b", "2"))):
        monkeypatch.setattr(intake, "replace_partitions", dies)
        with pytest.raises(RuntimeError):
            merge_snapshots(rows(video, views), path, staging, key)
        monkeypatch.setattr(intake, "replace_partitions", replace)
        merge_snapshots(rows("not read again", "3"), path, staging, key)
    assert sorted((r.video_id, r.views) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 2)]
    assert not glob.glob(f"{staging}/0-merged") and glob.glob(f"{staging}/1-merged")


def test_no_join_of_the_history_carries_texts_made_of_lines(spark):
    plan = d.snapshots(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join", 1)
    assert all(made in above and made not in below for made in ("thumb/", "part-", "yy.dd.MM"))
    assert "Repartition" not in plan


def test_history_is_laid_out_once_before_its_texts_are_made(spark, folder, monkeypatch):
    plan = d.snapshots(spark, SF, by_region=True)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("RebalancePartitions")
    assert all(made in above and made not in below for made in ("thumb/", "part-", "yy.dd.MM", "line "))
    stored, real = [], d.materialise
    monkeypatch.setattr(d, "materialise", lambda df, label: stored.append(df) or real(df, label))
    monkeypatch.setattr(d, "_paths", {})
    copies = read_history_csv(spark, d.history_copies(spark, SF))
    assert stored[0]._jdf.queryExecution().optimizedPlan().toString().count("RebalancePartitions") == 1
    columns = [c for c in copies.columns if not c.startswith("_")]
    # one of each row's copies is in another file than the other
    found = copies.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("_source_file").alias("files"))
    rows = read_history_csv(spark, d.history_zone(spark, SF)).groupBy(*columns).agg((2 * F.count(F.lit(1))).alias("n"))
    assert found.where("files < 2").isEmpty()
    assert rows.exceptAll(found.drop("files")).isEmpty() and found.drop("files").exceptAll(rows).isEmpty()


@pytest.mark.parametrize("name", ["sink_append", "sink_schema_growth", "kpi_row"])
def test_input_used_again_is_joined_once(spark, monkeypatch, name):
    joined, real = [], d.snapshots
    monkeypatch.setattr(d, "snapshots", lambda *a: joined.append(1) or real(*a))
    monkeypatch.setattr(d, "_paths", {})
    QUERIES[name](spark, SF)
    assert len(joined) == 1


def test_payloads_are_made_after_lines_are_laid_out(spark, folder):
    plan = d.stamped(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    made, laid = plan.split("RebalancePartitions")
    assert "channelTitle" in made and "channelTitle" not in laid
    roots = folder("placed"), folder("moved")
    for root, placed in zip(roots, (True, False)):
        land(d.stamped(spark, SF).drop("l_linenumber"), root, placed)
    told = lambda root: sorted(r.t for r in read_envelopes(spark, root).select(F.to_json(F.struct("items", "_pipeline_metadata", "region", "date", "hour")).alias("t")).collect())
    assert told(roots[0]) == told(roots[1])


def test_copies_that_go_are_not_completed(spark):
    raw = d.snapshots(spark, SF)
    plan = silver_statistics(raw, datetime(2021, 1, 1))._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Window ", 1)
    assert all(made in above and made not in below for made in ("like_ratio", "_job_name"))
    rows = cleanse.zero_fill(cleanse.parse_trending_date(cleanse.normalise_region(cleanse.drop_null_key(shape.conform(raw)))))
    at = datetime(2021, 1, 1)
    told = lambda df: sorted(r.t for r in df.select(F.to_json(F.struct(*sorted(df.columns))).alias("t")).collect())
    for latest in (("views", "likes"), ("engagement_rate", "views")):
        assert told(newest(rows, at, latest)) == told(cleanse.dedup_latest(cleansed(shape.conform(raw), at), latest))


def test_a_merge_moves_rows_once_and_splits_crowded_days(spark, history, folder, monkeypatch):
    monkeypatch.setattr(intake, "PORTION", 3)
    rows = lambda *of: silver_statistics(history(*of), datetime(2021, 1, 1))
    path, staging = folder("once-moved"), folder("once-moved-staging")
    old = [{"video_id": f"v{i}", "views": "1"} for i in range(20)] + [{"video_id": "n", "region": None, "views": "1"}, {"video_id": "d", "trending_date": "n/a", "views": "1"}]
    new = [{"video_id": f"v{i}", "views": "2"} for i in range(10, 30)] + [{"video_id": "n", "region": None, "views": "2"}, {"video_id": "d", "trending_date": "n/a", "views": "2"}]
    merge_snapshots(rows(*old), path, staging, 0)
    merge_snapshots(rows(*new), path, staging, 1)
    want = {**{f"v{i}": 1 for i in range(10)}, **{f"v{i}": 2 for i in range(10, 30)}, "n": 2, "d": 2}
    assert sorted((r.video_id, r.views) for r in spark.read.parquet(path).collect()) == sorted(want.items())
    assert glob.glob(f"{staging}/1-merged/region=us/trending_date_parsed=2*/part-*")
    plan = intake.newest_by_day(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(moved) == 2 and sum("_portion" in line and "REPARTITION_BY_COL" in line for line in moved) == 1  # the other is of counts


LINES = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)


def some_lines(spark, root):
    """Line items as a table: of three ranges of orders, one of them cut off, some twice, some with nulls."""
    day = datetime(1995, 3, 17)
    rows = [
        (order, 83 * order + n, 7, n, 2.0 * n, 10.5 * n, "ANR"[n % 3], "FO"[n % 2], day)
        for order in (1, 2, 97, 5999, 6000, 6001, 18000, 23999, 24000) for n in range(1, 8)
    ]
    rows += rows[5:20]
    rows += [(None, *rows[0][1:]), (*rows[0][:3], None, *rows[0][4:]), (*rows[0][:8], None), (1, None, None, 2, None, None, None, None, day)]
    spark.createDataFrame(rows, LINES).write.parquet(f"{root}/lineitem.parquet")
    return root


def test_responses_are_made_where_their_lines_have_met(spark, folder, monkeypatch):
    seen, real = [], d.put_responses
    monkeypatch.setattr(d, "put_responses", lambda responses, root: seen.append(responses) or real(responses, root))
    tables = some_lines(spark, folder("some-lines"))
    root = d.pretty_zone(spark, tables)
    above, below = seen[0]._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")
    assert all(made in above and made not in below for made in ("channelTitle", "named_struct", "yyyy-MM-dd"))
    plan = seen[0]._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange") == 1
    # the same from payloads that are made first
    place = ("region", "date", "hour")
    rows = d.stamped_orders(spark, tables).withColumn("part", F.expr("l_orderkey div 6000")).groupBy(*place, "part").agg(
        F.flatten(F.sort_array(F.collect_list("items"))).alias("items"), F.max("_pipeline_metadata.ingestion_timestamp").alias("landed")
    )
    stamp = F.struct("region", F.col("landed").alias("ingestion_timestamp"), F.size("items").cast("bigint").alias("video_count"))
    text = F.to_json(F.struct("items", stamp.alias("_pipeline_metadata")), {"pretty": "true"})
    want = rows.select(F.when(F.col("part") % 7 == 3, text.substr(1, 200)).otherwise(text).alias("t")).collect()
    texts = [gzip.open(f, "rt").read() for f in glob.glob(f"{root}/region=*/date=*/hour=*/*")]
    assert sorted(texts) == sorted(r.t + "\n" for r in want) and len(texts) > 20


@pytest.mark.parametrize("mounted", [True, False])
def test_each_response_is_a_gzip_file_of_its_own(spark, folder, monkeypatch, mounted):
    if not mounted:
        monkeypatch.setattr(d.os.path, "isdir", lambda path: False)
    root = folder("put")
    rows = [
        ("us", date(2021, 1, 1), 0, 1, '{\n "items" : [ {"id" : "\u00e9"} ]\n}'), ("us", date(2021, 1, 1), 0, 2, '{\n "items" : [ ]\n}'),
        ("us", date(2021, 1, 1), 0, None, '{\n "items" : [ {"id" : "n"}, {} ]\n}'), ("gb", None, None, 3, '{\n "items"'),
    ]
    schema = "region string, date date, hour int, part bigint, value string"
    d.put_responses(spark.createDataFrame(rows, schema), root)
    monkeypatch.undo()
    files = [f for f in glob.glob(f"{root}/region=*/date=*/hour=*/*") if os.path.isfile(f)]
    assert sorted(gzip.open(f, "rt", encoding="utf-8").read() for f in files) == sorted(f"{r[4]}\n" for r in rows)
    assert all(f.endswith(".gz") for f in files)
    hidden = [f for folders, _, names in os.walk(f"{root}/region=us") for f in names if f.startswith((".", "_"))]
    assert not hidden or not mounted
    read = read_envelopes(spark, root, one_per_file=True).select("region", "date", "hour", F.size("items").alias("n"), F.col("items.id").alias("ids"))
    assert sorted(map(tuple, read.collect()), key=repr) == sorted(
        [("us", date(2021, 1, 1), 0, 1, ["\u00e9"]), ("us", date(2021, 1, 1), 0, 0, []), ("us", date(2021, 1, 1), 0, 2, ["n", None]),
         ("gb", None, None, None, None)], key=repr)
    nothing = folder("put-nothing")
    d.put_responses(spark.createDataFrame([], schema), nothing)
    assert read_envelopes(spark, nothing, one_per_file=True).count() == 0
