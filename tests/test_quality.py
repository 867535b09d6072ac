from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tierline.operators import quality
from tierline.plans.contracts import QUALITY_RULES

TABLE = "clean_statistics"
AS_OF = datetime(2021, 6, 1)


@pytest.fixture()
def good(spark):
    return spark.range(20).select(
        F.col("id").cast("string").alias("video_id"),
        F.lit("t").alias("title"),
        F.lit("c").alias("channel_title"),
        (F.col("id") * 10).alias("views"),
        F.lit("us").alias("region"),
        F.lit(AS_OF).alias("_processed_at"),
    )


def outcome(df, **options):
    rows = quality.run_checks(df, options.pop("table", TABLE), AS_OF, **options).collect()
    return {(r.check, r.column if r.check == "null_pct" else None): r for r in rows}


def failed(df, **options):
    return sorted(k for k, r in outcome(df, **options).items() if not r.passed)


def test_good_table_passes_every_check(good):
    results = outcome(good)
    assert len(results) == 9 and all(r.passed for r in results.values())
    row = quality.summary(quality.run_checks(good, TABLE, AS_OF)).first()
    assert (row.quality_passed, row.checks_passed, row.checks_total) == (True, 9, 9)
    assert quality.failures(quality.run_checks(good, TABLE, AS_OF)).count() == 0


def test_one_pass_over_the_table(good):
    plan = quality.run_checks(good, TABLE, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 20") == 1


@pytest.mark.parametrize(
    ("spoil", "check"),
    [
        (lambda df: df.where("video_id < '9'").limit(9), [("row_count", None)]),
        (lambda df: df.withColumn("title", F.expr("if(views < 20, null, title)")), [("null_pct", "title")]),
        (lambda df: df.withColumn("views", F.expr("if(views = 10, -1, views)")), [("value_range", None)]),
        (lambda df: df.withColumn("views", F.expr("if(views = 10, 50000000001, views)")), [("value_range", None)]),
        (lambda df: df.withColumn("_processed_at", F.lit(AS_OF - timedelta(hours=49))), [("freshness", None)]),
        (lambda df: df.drop("title"), [("null_pct", "title"), ("schema", None)]),
    ],
    ids=["few_rows", "nulls", "negative", "extreme", "stale", "no_column"],
)
def test_each_defect_fails_its_check(good, spoil, check):
    assert failed(spoil(good)) == check


def test_null_share_at_the_limit_passes(good):
    results = outcome(good.withColumn("title", F.expr("if(views = 0, null, title)")))
    assert results["null_pct", "title"].value == 5.0 and results["null_pct", "title"].passed


def test_empty_table(good):
    results = outcome(good.where("false"))
    assert not results["row_count", None].passed and not results["freshness", None].passed
    assert results["null_pct", "title"].value == 0.0


def test_freshness_variants(good):
    assert outcome(good.drop("_processed_at"))["freshness", None].passed
    assert outcome(good.withColumn("_processed_at", F.lit("soon")))["freshness", None].passed
    iso = good.drop("_processed_at").withColumn("_ingestion_timestamp", F.lit("2021-05-31T00:00:00+00:00"))
    assert outcome(iso)["freshness", None].latest_record == datetime(2021, 5, 31)


def test_details(good):
    spoiled = good.drop("region", "title").withColumn("views", F.lit("-3"))
    results = outcome(spoiled)
    assert list(results["schema", None].missing_columns) == ["region", "title"]
    assert results["value_range", None].negative_count == 20
    assert results["row_count", None].threshold == 10.0


def test_other_tables_and_rules(spark, good):
    reference = spark.createDataFrame([("1", "us")] * 10, "id string, region string")
    assert len(outcome(reference, table="clean_reference_data")) == 5
    assert len(outcome(good, table="something_else")) == 3
    strict = replace(QUALITY_RULES[TABLE], min_rows=21)
    assert failed(good, rules=strict) == [("row_count", None)]


def test_missing_table_is_a_failed_check(spark, good):
    row = quality.check_table(spark, "nowhere.at_all").first()
    assert (row.check, row.table, row.passed) == ("read_table", "at_all", False)
    good.createOrReplaceTempView("clean_statistics")
    assert quality.summary(quality.check_table(spark, "clean_statistics", as_of=AS_OF)).first().quality_passed


def test_schema_alone_scans_nothing(spark, good, folder):
    path = folder("wide")
    good.write.parquet(path)
    checked = quality.run_checks(spark.read.parquet(path), TABLE, checks=["schema"])
    assert "Scan parquet" not in checked._jdf.queryExecution().executedPlan().toString()
    assert checked.first().passed


def test_unreadable_path_is_a_failed_check(spark, folder):
    row = quality.check_path(spark, folder("nowhere"), TABLE).first()
    assert (row.check, row.table, row.passed) == ("read_table", TABLE, False)
