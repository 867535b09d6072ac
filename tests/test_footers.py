"""Counts and extremes from footers."""

from __future__ import annotations

import glob
from datetime import date, timedelta

from pyspark.sql import functions as F

from tierline.sources import footers

COLUMNS, BY = ("v", "name", "day", "share"), ("region",)


def stored(spark, path, nulls=False):
    rows = spark.range(0, 5000, 1, 4).select(
        F.expr("if(id % 7 = 0, null, id - 100)").alias("v"), F.expr("concat('n', id)").alias("name"),
        F.expr("date_add(date'2020-01-01', cast(id % 400 as int))").alias("day"), F.expr("id / 8").alias("share"),
        F.expr("if(id % 3 = 0, 'us', null)").alias("region"),
    )
    if nulls:
        rows = rows.withColumn("v", F.expr("if(region = 'us', null, v)"))
    rows.write.partitionBy(*BY).parquet(path)
    return rows


def answers(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


def test_footers_equal_the_columns(spark, folder):
    path = folder("footers")
    rows = stored(spark, path)
    for by in (BY, ()):
        quick = footers.footer_profile(spark, path, rows.schema, COLUMNS, by)
        assert footers.is_from_footers(quick)
        assert answers(quick) == answers(footers._profiled(rows, COLUMNS, by)) == answers(footers.profile(spark, path, rows.schema, COLUMNS, by))
    whole = footers.profile(spark, path, rows.schema, COLUMNS).first()
    assert (whole.min_day, whole.max_day) == (date(2020, 1, 1), date(2020, 1, 1) + timedelta(399)) and "min_name" not in whole.asDict()


def test_no_column_is_read(spark, folder):
    path = folder("pages")
    rows = stored(spark, path)
    want = answers(footers._profiled(rows, COLUMNS, BY))
    for file in glob.glob(f"{path}/*/*.parquet"):
        with open(file, "r+b") as pages:
            size = pages.seek(0, 2)
            pages.seek(size - 8)
            footer = int.from_bytes(pages.read(4), "little")
            pages.seek(4)
            pages.write(bytes(size - footer - 12))
    for crc in glob.glob(f"{path}/*/.*.crc"):
        open(crc, "wb").close()
    spark.conf.set("spark.sql.files.ignoreCorruptFiles", "false")
    assert answers(footers.footer_profile(spark, path, rows.schema, COLUMNS, BY)) == want


def test_columns_are_read_where_a_footer_has_no_answer(spark, folder):
    path = folder("nulls")
    rows = stored(spark, path, nulls=True)
    assert answers(footers.profile(spark, path, rows.schema, COLUMNS, BY)) == answers(footers._profiled(rows, COLUMNS, BY))


def test_an_empty_table(spark, folder):
    path = folder("none")
    rows = stored(spark, folder("some")).where("false")
    rows.write.parquet(path)
    assert footers.profile(spark, path, rows.schema, ("v",)).first().asDict() == {"rows": 0, "count_v": 0, "min_v": None, "max_v": None}
