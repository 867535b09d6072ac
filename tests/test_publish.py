"""Partitions that are switched to new folders, and partitions added without listing a table."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tierline.sources import publish, register_table, superseded, switch
from tierline.sources.publish import written_folders

SCHEMA = "v bigint, region string, day date"
BY = ("region", "day")
DAY = date(2021, 5, 31)


def rows(spark, *given):
    return spark.createDataFrame(list(given), SCHEMA)


def seen(df):
    return sorted(map(tuple, df.select("v", "region", "day").collect()), key=repr)


@pytest.fixture()
def table(folder):
    root = folder("published")
    return "p_" + root.rsplit("-", 1)[-1], root


ODD = ((1, "middle east", DAY), (2, "a+b", DAY), (3, "x/y:%z", DAY), (4, None, DAY), (5, "it's", None), (6, "us", DAY))


def test_odd_values_name_their_partitions(spark, table):
    name, root = table
    publish(rows(spark, *ODD), name, root, BY)
    assert seen(spark.table(name)) == sorted(ODD, key=repr)
    publish(rows(spark, *[(v + 10, r, d) for v, r, d in ODD[:5]]), name, root, BY)
    assert seen(spark.table(name)) == sorted([*[(v + 10, r, d) for v, r, d in ODD[:5]], ODD[5]], key=repr)


def test_a_reader_sees_old_partitions_or_new_ones(spark, table):
    name, root = table
    publish(rows(spark, (1, "us", DAY), (2, "us", DAY), (3, "gb", DAY)), name, root, BY)
    early = spark.table(name).where("region is not null")
    early._jdf.queryExecution().executedPlan()  # a condition on partitions has them listed now
    path = publish(spark.table(name).where("region = 'us'").withColumn("v", F.col("v") * 10), name, root, BY)
    # the frame's own plan; a frame made from it would be planned anew
    assert sorted(map(tuple, early.collect())) == [(1, "us", DAY), (2, "us", DAY), (3, "gb", DAY)]
    assert seen(spark.table(name)) == [(10, "us", DAY), (20, "us", DAY), (3, "gb", DAY)]
    old = superseded(spark, name, root, spark.table(name).schema, BY)
    assert len(old) == 1 and old[0].endswith("region=us/day=2021-05-31") and path not in old[0]


def test_a_switch_that_died_is_completed(spark, table, monkeypatch):
    name, root = table
    publish(rows(spark, (1, "us", DAY), (2, "gb", DAY)), name, root, BY)
    fresh = rows(spark, (3, "us", DAY), (4, "gb", DAY), (5, "ca", DAY))
    path = f"{root}/run=late"
    fresh.write.partitionBy(*BY).parquet(path)
    spark.sql(f"ALTER TABLE {name} PARTITION (region = 'us', day = '2021-05-31') SET LOCATION '{path}/region=us/day=2021-05-31'")
    spark.catalog.refreshTable(name)
    assert seen(spark.table(name)) == [(2, "gb", DAY), (3, "us", DAY)]
    for _ in range(2):
        assert switch(spark, name, path, fresh.schema, BY) == 3
        assert seen(spark.table(name)) == [(3, "us", DAY), (4, "gb", DAY), (5, "ca", DAY)]


def test_only_touched_partitions_are_added(spark, folder):
    path = folder("touched")
    name = "t_" + path.rsplit("-", 1)[-1]
    rows(spark, *ODD).write.partitionBy(*BY).parquet(path)
    touched = rows(spark, *ODD).where("v in (1, 4)")
    register_table(spark, name, path, touched.schema, BY, touched)
    assert seen(spark.table(name)) == [ODD[0], ODD[3]]
    register_table(spark, name, path, touched.schema, BY, rows(spark, *ODD))
    assert seen(spark.table(name)) == sorted(ODD, key=repr)


def test_folders_of_a_run(spark, folder):
    path = folder("run")
    rows(spark, *ODD).write.partitionBy(*BY).parquet(path)
    found = written_folders(spark, path, rows(spark).schema, BY).collect()
    assert len(found) == len(ODD) and any(r.folder.endswith("region=middle east/day=2021-05-31") for r in found)
