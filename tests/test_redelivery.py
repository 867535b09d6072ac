"""Envelopes that come again in other files."""

from __future__ import annotations

import glob

from pyspark.sql import functions as F

from tierline.fixtures import derive as d
from tierline.operators.landing import land
from tierline.plans.silver import silver_statistics
from tierline.sources import read_envelopes
from tierline.streaming import read_stored, take_in
from tierline.streaming.intake import pending_partitions

SF = "/root/testdata/sf0.001"


def test_redelivered_files_touch_nothing_and_new_ones_only_theirs(spark, folder):
    root, silver, checkpoint, touched = folder("root"), folder("silver"), folder("ckpt"), folder("touched")
    stamped = d.stamped(spark, SF).where("l_orderkey % 5 = 0")
    first = stamped.where("l_linenumber <= 3").drop("l_linenumber")
    go = lambda: take_in(spark, root, silver, checkpoint, d.AS_OF, touched_path=touched, redelivered_within="2 days")
    land(first, root)
    assert sum(c["rows_read"] for c in go()) == first.select(F.explode("items")).count()
    files = set(glob.glob(f"{silver}/region=*/*/*.parquet"))
    land(first, root)
    assert sum(c.get("rows_read", 0) for c in go()) == 0
    assert set(glob.glob(f"{silver}/region=*/*/*.parquet")) == files
    more = stamped.where("l_linenumber = 4 and region = 'us'").drop("l_linenumber")
    land(first.unionByName(more), root)
    assert sum(c.get("rows_read", 0) for c in go()) == more.select(F.explode("items")).count() > 0
    changed = set(glob.glob(f"{silver}/region=*/*/*.parquet")) ^ files
    assert changed and all("region=us" in f for f in changed)
    whole = silver_statistics(read_envelopes(spark, root), d.AS_OF)
    table = read_stored(spark, silver).select(*whole.columns)
    same = [c for c in whole.columns if c != "_source_file"]
    assert sorted(map(str, table.select(*same).collect())) == sorted(map(str, whole.select(*same).collect()))
    assert {r.region for r in pending_partitions(spark, touched).collect()} >= {"us"}
