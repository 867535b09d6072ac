"""Counts of distinct videos that follow replaced region-days, against counting all rows."""

from __future__ import annotations

import datetime
import glob
import random

import pytest

from tierline.plans import membership
from tierline.plans.membership import Membership, day_pairs, video_counts
from tierline.sources import replace_partitions
from tierline.streaming.intake import SILVER_PARTITIONS

SCHEMA = "channel_title string, video_id string, region string, trending_date_parsed date"
DAY = datetime.date(2021, 1, 1)


def landed(rng, regions=("us", "gb", None), days=6):
    """All rows of one region-day, with videos that move between few channels."""
    region, day = rng.choice(regions), rng.choice([None, *(DAY + datetime.timedelta(n) for n in range(days))])
    videos = rng.sample(range(40), rng.randint(1, 25))
    return (region, day), [(rng.choice(["a", "b", "c", None]), f"v{v}", region, day) for v in videos]


def counted(df):
    return sorted((tuple(r) for r in df.select("channel_title", "region", "total_videos").collect()), key=repr)


def expected(table):
    videos = {}
    for channel, video, region, _ in (row for rows in table.values() for row in rows):
        videos.setdefault((channel, region), set()).add(video)
    return sorted(((*key, len(found)) for key, found in videos.items()), key=repr)


def merge(spark, path, given):
    rows = spark.createDataFrame([row for rows in given.values() for row in rows], SCHEMA)
    replace_partitions(rows, path, SILVER_PARTITIONS)
    table = spark.read.schema(SCHEMA).parquet(path)
    return table, rows.select(*SILVER_PARTITIONS).distinct()


def test_counts_follow_replaced_days(spark, folder):
    rng, table, path = random.Random(4), {}, folder("silver")
    members = Membership(spark, folder("members"))
    assert not members.started and counted(members.counts()) == []
    for _ in range(6):
        given = dict(landed(rng) for _ in range(4))
        table |= given
        members.update(*merge(spark, path, given))
        assert members.started and counted(members.counts()) == expected(table)
    stored = spark.read.schema(SCHEMA).parquet(path)
    assert counted(video_counts(day_pairs(stored))) == expected(table)


def test_a_video_that_leaves_a_channel_is_not_counted_there(spark, folder):
    path, members = folder("silver"), Membership(spark, folder("members"))
    members.update(*merge(spark, path, {1: [("a", "v", "us", DAY), ("a", "w", "us", DAY)]}))
    members.update(*merge(spark, path, {1: [("b", "v", "us", DAY), ("b", "w", "us", DAY)]}))
    assert counted(members.counts()) == [("b", "us", 2)]
    members.update(*merge(spark, path, {1: [("a", "v", "us", DAY), ("b", "w", "us", DAY)]}))
    assert counted(members.counts()) == [("a", "us", 1), ("b", "us", 1)]


@pytest.mark.parametrize("died_at", [0, 1, 2])
def test_an_update_that_died_half_way_is_completed(spark, folder, monkeypatch, died_at):
    rng, path = random.Random(died_at), folder("silver")
    table = dict(landed(rng) for _ in range(4))
    members = Membership(spark, folder("members"))
    members.update(*merge(spark, path, table))
    replaced, replace_for_good, write_for_good = [], membership.replace_partitions, Membership._write

    def step(work, *args):
        if len(replaced) == died_at:
            raise RuntimeError("driver went away")
        replaced.append(work)
        work(*args)

    def write(self, name, df):
        step(lambda: write_for_good(self, name, df)) if name == "counts" else write_for_good(self, name, df)

    given = dict(landed(rng) for _ in range(3))
    table |= given
    with monkeypatch.context() as patch:
        patch.setattr(membership, "replace_partitions", lambda *args: step(replace_for_good, *args))
        patch.setattr(Membership, "_write", write)
        with pytest.raises(RuntimeError, match="went away"):
            members.update(*merge(spark, path, given))
    more = dict(landed(rng) for _ in range(2))
    table |= more
    _, touched = merge(spark, path, more)
    # what the dead run had not confirmed is asked for again, with what came since
    again = spark.createDataFrame(list(given), "region string, trending_date_parsed date").union(touched).distinct()
    members.update(spark.read.schema(SCHEMA).parquet(path), again)
    assert counted(members.counts()) == expected(table)


def test_days_that_did_not_change_are_not_read(spark, folder):
    path, members = folder("silver"), Membership(spark, folder("members"))
    days = {("us", DAY + datetime.timedelta(n)): [("a", f"v{n}", "us", DAY + datetime.timedelta(n)), ("b", "x", "us", DAY + datetime.timedelta(n))] for n in range(5)}
    members.update(*merge(spark, path, days))
    last = DAY + datetime.timedelta(4)
    days[("us", last)] = [("a", "v0", "us", last), ("c", "y", "us", last)]
    table, touched = merge(spark, path, {1: days[("us", last)]})
    for n in range(4):
        for file in glob.glob(f"{path}/region=us/trending_date_parsed={DAY + datetime.timedelta(n)}/*.parquet"):
            with open(file, "r+b") as damaged:
                damaged.truncate(3)
    members.update(table, touched)
    assert counted(members.counts()) == expected(days)


def test_days_without_a_changed_pair_rewrite_no_bucket(spark, folder):
    path, root = folder("silver"), folder("members")
    rows = {1: [("a", f"v{n}", "us", DAY) for n in range(200)]}
    members = Membership(spark, root)
    members.update(*merge(spark, path, rows))
    before = sorted(glob.glob(f"{root}/members/**/*.parquet", recursive=True))
    members.update(*merge(spark, path, rows))
    assert sorted(glob.glob(f"{root}/members/**/*.parquet", recursive=True)) == before
    members.update(*merge(spark, path, {1: [*rows[1], ("a", "one more", "us", DAY)]}))
    after = sorted(glob.glob(f"{root}/members/**/*.parquet", recursive=True))
    assert len(set(after) - set(before)) == 1
