"""Sinks, incremental intake and the gated flow."""

from __future__ import annotations

import os
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tierline.fixtures import derive as d
from tierline.plans import contracts
from tierline.plans.flow import Run, run_flow
from tierline.plans.silver import silver_statistics
from tierline.operators.landing import land
from tierline.sources import append_partitions, grow_table, read_envelopes, read_reference, register_table, replace_partitions
from tierline.streaming import intake_errors, merge_snapshots, run_increment
from tierline.streaming.intake import in_partitions

SF = "/root/testdata/sf0.001"
VALUES = [*contracts.STATISTICS_COLUMNS, "trending_date_parsed", "like_ratio", "engagement_rate"]


def rows(df):
    return sorted(map(str, df.select(*VALUES).collect()))


def counts(spark, path):
    return {r.region: r["count"] for r in spark.read.parquet(path).groupBy("region").count().collect()}


@pytest.fixture()
def small(spark):
    return spark.createDataFrame([(1, "us"), (2, "us"), (3, "gb")], "v bigint, region string")


def test_append_and_replace(spark, small, folder):
    path = folder("sink")
    append_partitions(small, path)
    append_partitions(small, path)
    assert counts(spark, path) == {"us": 4, "gb": 2}
    replace_partitions(small.where("region = 'us'"), path)
    replace_partitions(small.where("false"), path)
    assert counts(spark, path) == {"us": 2, "gb": 2}


def test_a_big_region_is_written_by_several_tasks(spark, folder):
    path = folder("skew")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        text = F.sha2(F.col("id").cast("string"), 256)
        big = spark.range(0, 40_000, 1, 8).select(text.alias("v"), F.expr("if(id % 10 < 9, 'us', 'gb')").alias("region"))
        append_partitions(big, path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    files = {r.f for r in spark.read.parquet(path).where("region = 'us'").select(F.input_file_name().alias("f")).distinct().collect()}
    assert len(files) > 1 and counts(spark, path) == {"us": 36_000, "gb": 4_000}


def test_register_and_grow(spark, small, folder):
    path = folder("grow")
    name = "grow_" + path[-8:]
    append_partitions(small.where("region = 'us'"), path)
    register_table(spark, name, path, small.schema)
    wider = small.where("region = 'gb'").select("v", F.lit("x").alias("note"), "region")
    append_partitions(wider, path)
    assert grow_table(spark, name, wider.schema) == ["note"]
    assert grow_table(spark, name, wider.schema) == []
    spark.sql(f"MSCK REPAIR TABLE {name}")
    assert {(r.v, r.note) for r in spark.table(name).collect()} == {(1, None), (2, None), (3, "x")}


def test_merge_touches_only_its_partitions(spark, history, folder):
    path = folder("merge")
    extra = "_landed_at timestamp, _source_file string"

    def clean(*values):
        return silver_statistics(history(*values, extra=extra), datetime(2021, 1, 1))

    old = {"_landed_at": datetime(2021, 1, 1), "_source_file": "a"}
    merge_snapshots(clean({**old, "video_id": "x"}, {**old, "video_id": "n", "trending_date": "n/a"}, {**old, "region": "gb"}), path)
    before = {f for f in map(lambda r: r.f, spark.read.parquet(path).where("region='gb'").select(F.input_file_name().alias("f")).collect())}
    late = {"_landed_at": datetime(2020, 1, 1), "_source_file": "z", "video_id": "x", "views": "1"}
    newer = {"_landed_at": datetime(2022, 1, 1), "_source_file": "0", "video_id": "n", "trending_date": "n/a", "views": "7"}
    for _ in range(2):
        merge_snapshots(clean(late, newer, {**old, "video_id": "y"}), path)
    table = spark.read.parquet(path)
    got = {(r.video_id, r.region): r.views for r in table.collect()}
    assert got == {("x", "us"): 100, ("n", "us"): 7, ("y", "us"): 100, ("v1", "gb"): 100}
    assert before == {r.f for r in table.where("region='gb'").select(F.input_file_name().alias("f")).collect()}


@pytest.mark.parametrize("files_per_batch", [None, 7])
def test_stream_equals_batch(spark, folder, files_per_batch):
    root, silver, checkpoint = folder("root"), folder("silver"), folder("ckpt")
    stamped = d.stamped(spark, SF)
    for portion in ("l_linenumber <= 2", "l_linenumber > 2"):
        land(stamped.where(portion).drop("l_linenumber"), root)
        assert run_increment(spark, root, silver, checkpoint, d.AS_OF, files_per_batch) >= 1
    assert run_increment(spark, root, silver, checkpoint, d.AS_OF, files_per_batch) == 0
    batch = silver_statistics(read_envelopes(spark, root), d.AS_OF)
    assert rows(spark.read.parquet(silver)) == rows(batch)


def test_a_run_that_died_while_replacing_partitions_is_repaired(spark, folder, monkeypatch):
    from tierline.streaming import intake

    root, silver, checkpoint = folder("root"), folder("silver"), folder("ckpt")
    stamped = d.stamped(spark, SF).where("l_orderkey % 4 = 0")
    land(stamped.where("l_linenumber <= 2").drop("l_linenumber"), root)
    run_increment(spark, root, silver, checkpoint, d.AS_OF)
    land(stamped.where("l_linenumber > 2").drop("l_linenumber"), root)
    replace_for_good = intake.replace_partitions

    def lose_rows_and_die(df, path, by):
        replace_for_good(df.where("views % 2 = 0"), path, by)
        raise RuntimeError("executor host went away")

    monkeypatch.setattr(intake, "replace_partitions", lose_rows_and_die)
    with pytest.raises(Exception, match="went away"):
        run_increment(spark, root, silver, checkpoint, d.AS_OF)
    monkeypatch.setattr(intake, "replace_partitions", replace_for_good)
    whole = silver_statistics(read_envelopes(spark, root), d.AS_OF)
    assert rows(spark.read.parquet(silver)) != rows(whole)
    assert run_increment(spark, root, silver, checkpoint, d.AS_OF) == 1
    assert rows(spark.read.parquet(silver)) == rows(whole)


def go(spark, root, rules=contracts.QUALITY_RULES, payloads=None, **options):
    payloads = d.stamped(spark, SF).drop("l_linenumber") if payloads is None else payloads
    documents = read_reference(spark, d.reference_zone(spark, SF))
    return run_flow(spark, payloads, documents, root, d.AS_OF, rules, **options)


def statuses(run):
    return [run.outcome.get(s, ("skipped",))[0] for s in ("landing", "reference", "statistics", "quality_gate", "gold")]


def test_gate_protects_gold_and_reruns_change_nothing(spark, folder):
    root = folder("flow")
    first = go(spark, root)
    assert first.succeeded, first.outcome
    marts = ("trending_analytics", "channel_analytics", "category_analytics")
    before = {m: sorted(map(str, first.table(m).collect())) for m in marts}
    assert all(before.values())

    nothing = d.stamped(spark, SF).drop("l_linenumber").where("false")
    for rebuild in (False, True):
        again = go(spark, root, payloads=nothing, rebuild=rebuild)
        assert again.succeeded, again.outcome
        assert before == {m: sorted(map(str, again.table(m).collect())) for m in marts}

    strict = {"clean_statistics": replace(contracts.QUALITY_RULES["clean_statistics"], max_value=0)}
    closed = go(spark, root, strict, payloads=nothing)
    assert statuses(closed) == ["succeeded", "succeeded", "succeeded", "failed", "skipped"]
    assert before == {m: sorted(map(str, again.table(m).collect())) for m in marts}
    assert closed.table("quality").where("not passed").count() == 1
    assert spark.read.parquet(closed.path("runs")).count() == 20


def test_a_failing_stage_is_reported_and_ends_the_run(spark, folder):
    run = go(spark, folder("broken"), payloads=spark.range(1))
    assert statuses(run) == ["failed", "skipped", "skipped", "skipped", "skipped"]
    assert run.outcome["landing"][1]


def test_a_whole_message_is_reported_and_an_empty_one_is_no_crash(spark, folder):
    run = Run(spark, folder("run"), d.AS_OF)

    def fail(error):
        raise error

    assert not run.attempt("landing", lambda: fail(TimeoutError()))
    assert not run.attempt("reference", lambda: fail(ValueError("first line\nsecond line")))
    assert run.outcome["landing"][1] == "TimeoutError"
    assert run.outcome["reference"][1] == "ValueError: first line\nsecond line"


def test_rows_after_a_reset_of_the_stream_are_taken_in(spark, folder):
    root, silver, checkpoint = folder("root"), folder("silver"), folder("ckpt")
    stamped = d.stamped(spark, SF).where("l_linenumber <= 2").drop("l_linenumber")
    later = F.col("region") == "us"
    land(stamped.where(~later), root)
    run_increment(spark, root, silver, checkpoint, d.AS_OF)
    os.rename(checkpoint, checkpoint + "-before-reset")
    land(stamped.where(later), root)
    run_increment(spark, root, silver, checkpoint, d.AS_OF)
    assert rows(spark.read.parquet(silver)) == rows(silver_statistics(read_envelopes(spark, root), d.AS_OF))


def test_many_touched_days_stay_in_the_partition_filter(spark, folder):
    path = folder("days")
    table = spark.range(1500).select(F.lit("us").alias("region"), F.expr("date_add(date'2000-01-01', cast(id as int))").alias("trending_date_parsed"), "id")
    table.coalesce(1).write.partitionBy("region", "trending_date_parsed").parquet(path)
    touched = table.where("id % 5 <> 0").select("region", "trending_date_parsed")
    kept = in_partitions(spark.read.parquet(path), touched)
    assert touched.count() == 1200 == kept.count()
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert any("PartitionFilters" in line and "trending_date_parsed" in line.split("PartitionFilters")[1] for line in plan.splitlines())


def test_a_merge_keeps_columns_that_the_batch_lacks(spark, history, folder):
    path = folder("grown")
    rows_of = lambda video, **more: silver_statistics(history({"video_id": video, **more}), datetime(2021, 1, 1))
    merge_snapshots(rows_of("a").withColumn("note", F.lit("n")), path)
    merge_snapshots(rows_of("b"), path)
    merge_snapshots(rows_of("c"), path)
    table = spark.read.option("mergeSchema", True).parquet(path)
    assert {(r.video_id, r.note) for r in table.collect()} == {("a", "n"), ("b", None), ("c", None)}


def test_indented_responses_stream_as_they_read(spark, folder):
    root, silver, checkpoint = d.pretty_zone(spark, SF), folder("silver"), folder("ckpt")
    run_increment(spark, root, silver, checkpoint, d.AS_OF, one_per_file=True)
    whole = read_envelopes(spark, root, one_per_file=True)
    assert rows(spark.read.parquet(silver)) == rows(silver_statistics(whole, d.AS_OF))
    assert intake_errors(spark, checkpoint).count() == len([r for r in whole.collect() if r["items"] is None])


def test_unusable_envelopes_of_a_batch_are_kept(spark, folder):
    root, silver, checkpoint = folder("root"), folder("silver"), folder("ckpt")
    land(d.stamped(spark, SF).where("l_orderkey % 50 = 0").drop("l_linenumber"), root)
    run_increment(spark, root, silver, checkpoint, d.AS_OF)
    assert intake_errors(spark, checkpoint).count() == 0
    texts = spark.createDataFrame([("not json", "us", 1), ('{"kind": "x"}', "us", 1)], "value string, region string, hour int")
    texts.withColumn("date", F.lit("2021-01-01")).coalesce(1).write.mode("append").partitionBy("region", "date", "hour").text(root)
    run_increment(spark, root, silver, checkpoint, d.AS_OF)
    assert sorted((r.batch, r.error) for r in intake_errors(spark, checkpoint).collect()) == [(1, "no items"), (1, "not valid JSON")]


def test_only_touched_days_of_gold_are_rebuilt(spark, folder):
    root = folder("days-of-gold")
    stamped = d.stamped(spark, SF).drop("l_linenumber")
    few = (F.col("region") == "us") & (F.year("date") == 2015)
    assert go(spark, root, payloads=stamped.where(~few), database="default").succeeded
    files = lambda run, mart: {r.f for r in run.table(mart).select(F.input_file_name().alias("f")).collect()}
    first = go(spark, root, payloads=stamped.where("false"))
    assert first.outcome["gold"] == ("succeeded", "marts are up to date")
    before = files(first, "trending_analytics")
    second = go(spark, root, payloads=stamped.where(few), database="default")
    assert second.succeeded, second.outcome
    after = files(second, "trending_analytics")
    assert before & after and after - before and all("region=us" in f for f in after - before)
    whole = go(spark, folder("whole"), payloads=stamped)
    for mart in ("trending_analytics", "channel_analytics", "category_analytics"):
        columns = [c for c in whole.table(mart).columns if c != "_aggregated_at"]
        assert sorted(map(str, second.table(mart).select(*columns).collect())) == sorted(map(str, whole.table(mart).select(*columns).collect()))
    assert spark.table("default.clean_statistics").count() == second.table("clean_statistics").count()
