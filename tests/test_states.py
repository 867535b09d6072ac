"""Checks from stored states of region-days, against checks of all rows."""

from __future__ import annotations

import glob
from dataclasses import replace
from datetime import date, datetime, timedelta

from tierline.operators import quality
from tierline.plans.contracts import QUALITY_RULES
from tierline.plans.states import QualityStates
from tierline.sources import replace_partitions
from tierline.streaming.intake import SILVER_PARTITIONS

TABLE = "clean_statistics"
SCHEMA = "video_id string, title string, channel_title string, views bigint, _processed_at timestamp, region string, trending_date_parsed date"
AT, DAY = datetime(2021, 6, 1, 12), date(2021, 5, 31)


def part(region, day, n, bad=0):
    return [(f"{region}{day}{i}", None if i < bad else "t", "c", -1 if i < bad else i, AT - timedelta(hours=i), region, day) for i in range(n)]


def told(results):
    return sorted(map(str, results.collect()))


def merge(spark, path, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    replace_partitions(df, path, SILVER_PARTITIONS)
    return spark.read.schema(df.schema).parquet(path), df.select(*SILVER_PARTITIONS).distinct()


def test_states_give_the_results_of_all_rows(spark, folder):
    path, states_path, rules = folder("table"), folder("states"), QUALITY_RULES[TABLE]
    empty = QualityStates(spark, states_path, TABLE, spark.createDataFrame([], SCHEMA).schema, rules)
    assert told(empty.results(AT)) == told(quality.run_checks(spark.createDataFrame([], SCHEMA), TABLE, AT, rules))
    for rows in (part("us", DAY, 40, 3) + part(None, None, 5), part("gb", DAY, 7) + part("us", DAY, 30), part("gb", DAY, 9, 2)):
        table, touched = merge(spark, path, rows)
        states = QualityStates(spark, states_path, TABLE, table.schema, rules)
        states.update(table, touched)
        assert told(states.results(AT)) == told(quality.run_checks(table, TABLE, AT, rules))
    strict = replace(rules, max_value=10, min_rows=1000)
    other = QualityStates(spark, states_path, TABLE, table.schema, strict)
    other.update(table, None)  # these rules count the whole table
    assert told(other.results(AT)) == told(quality.run_checks(table, TABLE, AT, strict)) != told(states.results(AT))


def test_only_touched_days_are_read(spark, folder):
    path, states_path, rules = folder("table"), folder("states"), QUALITY_RULES[TABLE]
    days = [DAY + timedelta(n) for n in range(4)]
    rows = {day: part("us", day, 12, 1) for day in days}
    table, touched = merge(spark, path, sum(rows.values(), []))
    states = QualityStates(spark, states_path, TABLE, table.schema, rules)
    states.update(table, touched)
    rows[days[3]] = part("us", days[3], 50)
    table, touched = merge(spark, path, rows[days[3]])
    want = told(quality.run_checks(table, TABLE, AT, rules))
    for day in days[:3]:
        for file in glob.glob(f"{path}/region=us/trending_date_parsed={day}/*.parquet"):
            with open(file, "r+b") as damaged:
                damaged.truncate(3)
    states.update(table, touched)
    states.update(table, None)
    assert told(states.results(AT)) == want
