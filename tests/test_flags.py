"""Flags of rows, and rows kept out of Silver until a rule changes."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tierline.operators import flags
from tierline.operators.flags import QUARANTINE, RowRule
from tierline.operators.landing import land
from tierline.operators.shape import conform
from tierline.fixtures import derive as d
from tierline.plans import quarantine
from tierline.plans.quarantine import Quarantine, finished, judged
from tierline.plans.silver import silver_statistics
from tierline.sources import read_envelopes
from tierline.streaming import merge_snapshots, read_stored, take_in

SF = "/root/testdata/sf0.001"
AT = datetime(2021, 6, 1)
ORIGIN = "_landed_at timestamp, _source_file string"


def test_a_row_carries_the_bits_of_all_its_faults(spark, history):
    rows = history({}, {"video_id": None, "views": "-5"}, {"views": None, "title": "  "}, {"likes": "101"}, {"trending_date": "x", "channel_title": None})
    found = judged(conform(rows)).select(flags.FLAGS, flags.flag_names(flags.STATISTICS_RULES).alias("names"), flags.is_quarantined(flags.STATISTICS_RULES).alias("out")).collect()
    assert sorted((r._flags, r.names, r.out) for r in found) == [
        (0, [], False), (10, ["no_title", "no_views"], False), (36, ["no_channel", "no_trending_date"], False),
        (64, ["more_likes_than_views"], False), (81, ["no_video_id", "negative_views", "more_likes_than_views"], True),
    ]
    counts = {r.rule: (r["rows"], r.alone) for r in flags.flag_counts(judged(conform(rows))).collect()}
    assert counts["more_likes_than_views"] == (2, 1) and counts["no_title"] == (1, 0) and counts["negative_views"] == (1, 0)


def test_rules_need_their_own_bits(spark):
    for bad in ((RowRule(1, "a", "true"), RowRule(1, "b", "true")), (RowRule(63, "a", "true"),), (RowRule(0, "a", "true", "drop"),)):
        with pytest.raises(ValueError):
            flags.flag_mask(bad)
    top = (RowRule(62, "top", "v > 1", QUARANTINE), RowRule(0, "null", "w = 1"))
    got = flags.flagged(spark.createDataFrame([(1, None), (2, 1)], "v int, w int"), top)
    assert [(r._flags, r.out) for r in got.withColumn("out", flags.is_quarantined(top)).orderBy("v").collect()] == [(0, False), (2**62 + 1, True)]
    assert flags.flag_counts(got.where("false"), top).collect()[0]["rows"] == 0


def let(spark, history, held, silver, batch, *values, rules=flags.STATISTICS_RULES):
    rows = conform(history(*[{"_landed_at": AT, "_source_file": "f", **v} for v in values], extra=ORIGIN))
    merge_snapshots(finished(held.route(rows, batch, rules), AT), silver)


def views(spark, silver):
    return {r.video_id: r.views for r in read_stored(spark, silver).collect()}


def test_rows_kept_out_are_let_in_when_a_rule_changes(spark, history, folder):
    held, silver = Quarantine(spark, folder("held")), folder("silver")
    assert held.rows() is None and held.readmit(silver, flags.STATISTICS_RULES, AT) is None
    let(spark, history, held, silver, "1", {"video_id": "a"}, {"video_id": "b", "views": "-3"}, {"video_id": None}, {"video_id": "n", "views": "-900"})
    newer = datetime(2021, 7, 1)
    let(spark, history, held, silver, "2", {"video_id": "a", "views": "-4", "_landed_at": newer}, {"video_id": "b", "views": "7", "_landed_at": newer})
    assert views(spark, silver) == {"a": 100, "b": 7}
    relaxed = tuple(replace(r, fault="views < -100") if r.name == "negative_views" else r for r in flags.STATISTICS_RULES)
    assert held.readmit(silver, relaxed, AT).count() == 1
    # the newer copy of a replaces the stored one, the older copy of b does not
    assert views(spark, silver) == {"a": -4, "b": 7}
    told = {(r.video_id, r.views): (r._flags, r._readmitted_at) for r in held.rows().collect()}
    assert told[("a", -4)] == (64, AT) and told[("b", -3)] == (64, AT)
    assert told[("n", -900)] == (16 + 64, None) and told[(None, 100)] == (1, None)
    assert held.readmit(silver, relaxed, AT) is None


def test_a_batch_that_is_repeated_holds_its_rows_once(spark, history, folder):
    held, silver = Quarantine(spark, folder("held")), folder("silver")
    for _ in range(2):
        let(spark, history, held, silver, "1", {"video_id": None}, {"video_id": "a", "views": "-1"})
        let(spark, history, held, silver, "2", {"video_id": "c"})
    assert held.rows().count() == 2 and views(spark, silver) == {"c": 100}


def test_letting_in_that_died_before_it_was_marked_is_repeated(spark, history, folder, monkeypatch):
    held, silver = Quarantine(spark, folder("held")), folder("silver")
    let(spark, history, held, silver, "1", {"video_id": "a"}, {"video_id": "b", "views": "-3"})
    fine = tuple(r for r in flags.STATISTICS_RULES if r.name != "negative_views")

    def die(*args):
        raise RuntimeError("driver went away")

    with monkeypatch.context() as patch:
        patch.setattr(quarantine, "replace_partitions", die)
        with pytest.raises(RuntimeError):
            held.readmit(silver, fine, AT)
    assert held.rows().where("_readmitted_at is not null").isEmpty()
    held.readmit(silver, fine, AT)
    assert views(spark, silver) == {"a": 100, "b": -3} and held.rows().where("_readmitted_at is null").isEmpty()


def test_the_stream_routes_what_it_takes_in(spark, folder):
    root, silver, checkpoint = folder("root"), folder("silver"), folder("ckpt")
    land(d.stamped(spark, SF).drop("l_linenumber"), root)
    held = Quarantine(spark, folder("held"))
    many = (RowRule(0, "no_video_id", "video_id is null", QUARANTINE), RowRule(1, "odd", "likes % 2 = 1", QUARANTINE))
    take_in(spark, root, silver, checkpoint, d.AS_OF, clean=lambda rows, batch: finished(held.route(rows, str(batch), many), d.AS_OF))
    raw = conform(read_envelopes(spark, root))
    kept = silver_statistics(raw.where("coalesce(likes % 2, 0) = 0"), d.AS_OF)
    assert sorted(map(str, read_stored(spark, silver).select(*kept.columns).collect())) == sorted(map(str, kept.collect()))
    assert held.rows().count() == raw.where("video_id is null or likes % 2 = 1").count()
    assert held.rows().where(F.col("batch") != "0").isEmpty()
