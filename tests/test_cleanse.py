from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tierline.operators import cleanse, shape
from tierline.plans.silver import SilverCount, cleansed, silver_statistics

AS_OF = datetime(2021, 6, 1)
ORIGIN = "_landed_at timestamp, _source_file string"


def stamped(**values):
    return {"_landed_at": datetime(2021, 1, 1), "_source_file": "a", **values}


def test_row_level_steps(history):
    raw = history(
        {"video_id": None},
        {"video_id": "pad", "region": " Us ", "views": None, "likes": "12.9"},
        {"video_id": "iso", "trending_date": "2020-01-31", "views": "0"},
        {"video_id": "bad", "trending_date": "n/a", "comment_count": "x"},
    )
    rows = {r.video_id: r for r in cleansed(shape.conform(raw), AS_OF, "job").collect()}
    assert set(rows) == {"pad", "iso", "bad"}
    assert (rows["pad"].region, rows["pad"].views, rows["pad"].likes) == ("us", 0, 12)
    assert rows["iso"].trending_date_parsed == date(2020, 1, 31) == rows["pad"].trending_date_parsed
    assert rows["iso"].like_ratio == 0.0
    assert rows["bad"].trending_date_parsed is None and rows["bad"].comment_count == 0
    assert rows["bad"]._processed_at == AS_OF and rows["bad"]._job_name == "job"


def test_newest_copy_survives_whatever_the_input_order(history):
    copies = [
        stamped(views="1"),
        stamped(views="2", _landed_at=datetime(2021, 1, 2)),
        stamped(views="3", _landed_at=datetime(2021, 1, 2), _source_file="b"),
        stamped(views="4", _landed_at=datetime(2021, 1, 2), _source_file="b", title="a"),
        stamped(views="9", _landed_at=None),
    ]
    for rows in (copies, copies[::-1]):
        out = silver_statistics(history(*rows, extra=ORIGIN).repartition(3), AS_OF).collect()
        assert [(r.views, r.title) for r in out] == [(3, "t")]


def test_dedup_is_idempotent_and_null_dates_stay_apart(history):
    rows = [stamped(trending_date=t, region=r) for t in ("n/a", "20.31.01") for r in ("us", "gb") for _ in range(2)]
    once = silver_statistics(history(*rows, extra=ORIGIN), AS_OF)
    assert once.count() == 4
    assert sorted(cleanse.dedup_latest(once).collect()) == sorted(once.collect())


def test_copies_are_reduced_before_the_shuffle(spark, history):
    """A key with a third of all rows must not travel as a whole."""
    raw = history(stamped(), extra=ORIGIN).crossJoin(spark.range(300).repartition(4))
    raw = raw.withColumn("video_id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")))
    silver = silver_statistics(raw.drop("id"), AS_OF)
    plan = silver._jdf.queryExecution().executedPlan().toString()
    limits = [i for i, line in enumerate(plan.splitlines()) if "WindowGroupLimit" in line]
    shuffle = next(i for i, line in enumerate(plan.splitlines()) if "Exchange hashpartitioning(video_id" in line)
    assert len(limits) == 2 and limits[0] < shuffle < limits[1]
    assert silver.where("video_id = 'hot'").count() == 1 and silver.count() == 201


def test_counters(history):
    raw = history({}, {}, {"video_id": None}, {"video_id": "n", "views": "-5", "title": None})
    count = SilverCount(raw, AS_OF)
    assert count.silver.count() == 2
    got = count.counts()
    assert (got["rows_read"], got["rows_kept"], got["rows_removed"]) == (4, 2, 2)
    assert (got["null_video_id"], got["null_title"], got["negative_views"]) == (0, 1, 1)
