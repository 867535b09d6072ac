from __future__ import annotations

from datetime import date
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tierline import functions as fn

LONGS = [
    ("12", 12),
    (" 12 ", 12),
    ("+7", 7),
    ("-7", -7),
    ("12.9", 12),
    ("-12.9", -12),
    ("5.", 5),
    (".5", 0),
    ("-.5", 0),
    ("", None),
    ("  ", None),
    ("abc", None),
    ("1e3", None),
    ("1.2.3", None),
    ("1 2", None),
    ("+", None),
    ("9223372036854775807", 9223372036854775807),
    ("9223372036854775808", None),
    (None, None),
]
FLAGS = [
    ("True", True), (" true ", True), ("T", True), ("yes", True), ("1", True),
    ("FALSE", False), ("f", False), ("No", False), ("0", False),
    ("maybe", None), ("", None), (None, None),
]
DATES = [
    ("17.14.11", date(2017, 11, 14)),
    ("95.01.02", date(2095, 2, 1)),
    ("17.40.01", None),
    ("17.01.13", None),
    ("2017-11-14", date(2017, 11, 14)),
    ("2017-11-14 10:00:00", date(2017, 11, 14)),
    ("2017-02-30", None),
    ("2017-3-4", date(2017, 3, 4)),
    ("2017-03", date(2017, 3, 1)),
    ("17.14.11x", None),
    ("n/a", None),
    ("", None),
    (None, None),
]
PATHS = [
    ("raw/region=US/date=x/f.json", "US"),
    ("region=gb/region=us/f", "gb"),
    ("raw/xregion=us/f", "unknown"),
    ("raw/f.json", "unknown"),
    ("file:/a/region=in/f=1.json", "in"),
]


def evaluate(spark, values, kind, function):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


@pytest.mark.parametrize(
    ("function", "cases"),
    [(fn.to_long, LONGS), (fn.to_bool, FLAGS), (fn.trending_day, DATES), (fn.region_from_path, PATHS)],
    ids=["to_long", "to_bool", "trending_day", "region_from_path"],
)
def test_text_functions(spark, function, cases):
    assert evaluate(spark, [c[0] for c in cases], "string", function) == [c[1] for c in cases]


def test_tolerant_functions_match_a_lenient_cast(spark):
    """The same answers as Spark's own casts outside ANSI mode."""
    texts = [t for t, _ in LONGS + FLAGS + DATES]
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        longs = evaluate(spark, texts, "string", lambda c: c.cast("bigint"))
        flags = evaluate(spark, texts, "string", lambda c: c.cast("boolean"))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert evaluate(spark, texts, "string", fn.to_long) == longs
    assert evaluate(spark, texts, "string", fn.to_bool) == flags


def test_ratios(spark):
    rows = [(1000, 33, 1, 2), (0, 5, 5, 5), (None, 5, 5, 5), (3, 1, 1, 1), (-5, 1, 1, 1)]
    df = spark.createDataFrame(rows, "views bigint, likes bigint, dislikes bigint, comments bigint")
    v, li, di, co = (F.col(c) for c in df.columns)
    out = df.select(fn.like_ratio(v, li), fn.engagement_rate(v, li, di, co)).collect()
    assert [tuple(r) for r in out] == [(3.3, 3.6), (0.0, 0.0), (0.0, 0.0), (33.3333, 100.0), (0.0, 0.0)]


def test_huge_counters_do_not_overflow(spark):
    top = 9223372036854775807
    df = spark.createDataFrame([(1, top, top, top)], "v bigint, l bigint, d bigint, c bigint")
    assert df.select(fn.engagement_rate(*[F.col(c) for c in "vldc"])).first()[0] > 0


def test_exact_mean_does_not_depend_on_order(spark):
    values = [round(i * 0.0007, 4) for i in range(5000)] + [0.1, 0.2, 0.3] * 500
    exact = float(sum(Fraction(str(v)) for v in values) / len(values))
    for order in (values, values[::-1], sorted(values, key=lambda v: v * 7919 % 1)):
        df = spark.createDataFrame([(v,) for v in order], "r double").repartition(7)
        assert df.agg(fn.exact_mean(F.col("r"))).first()[0] == exact
    assert spark.createDataFrame([], "r double").agg(fn.exact_mean(F.col("r"))).first()[0] is None


def test_share_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (5, None)], "a bigint, b bigint")
    assert [r[0] for r in df.select(fn.share_pct(F.col("a"), F.col("b"))).collect()] == [33.33, None, None]
