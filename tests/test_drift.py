"""Payloads that leave the contract: nothing is lost, nothing is cast in silence."""

from __future__ import annotations

import json
import random
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators import drift
from tierline.plans.contracts import CORRUPT, EXTRA, ITEM
from tierline.plans.lattice import SchemaConflict, declared, decide, merged_schema, widest
from tierline.plans.silver import silver_statistics
from tierline.sources import envelope_errors, grow_table, register_table
from tierline.streaming import merge_snapshots, read_stored

D = T.DecimalType


@pytest.mark.parametrize(
    "one, other, result",
    [
        ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("int", "double", "double"), ("bigint", "double", None),
        ("bigint", "decimal(3,1)", "decimal(20,1)"), ("decimal(38,0)", "decimal(3,1)", None), ("float", "double", "double"),
        ("date", "timestamp_ntz", "timestamp_ntz"), ("date", "timestamp", None), ("string", "bigint", None), ("boolean", "int", None),
        ("array<int>", "array<bigint>", "array<bigint>"), ("array<int>", "array<string>", None), ("void", "date", "date"),
        ("struct<a:int,b:string>", "struct<b:string,a:bigint,c:date>", "struct<a:bigint,b:string,c:date>"),
        ("struct<a:int>", "int", None), ("map<string,int>", "map<string,bigint>", "map<string,bigint>"), ("decimal(5,2)", "int", "decimal(12,2)"),
    ],
)
def test_the_least_type_that_holds_both(spark, one, other, result):
    kinds = [T.DataType.fromDDL(k) for k in (one, other)]
    for a, b in (kinds, reversed(kinds)):
        found = widest(a, b)
        if result is None or "struct" not in result:
            assert (found and found.simpleString()) == result
        else:
            assert {f.name: f.dataType.simpleString() for f in found.fields} == {f.name: f.dataType.simpleString() for f in T.DataType.fromDDL(result).fields}


def test_decisions(spark):
    text, whole, inner = T.StringType(), T.LongType(), T.StructType([T.StructField("a", T.StringType())])
    told = [decide(s, c) for s, c in ((text, text), (whole, text), (text, whole), (T.IntegerType(), whole), (inner, text), (text, inner), (text, None), (inner, inner), (T.ArrayType(text), text))]
    assert told == ["same", "as text", "keep apart", "widen", "refuse", "refuse", "keep apart", "same", "keep apart"]
    assert declared("OBJECT<`x OBJECT<y`: ARRAY<OBJECT<a: BIGINT>>>").fields[0].name == "x OBJECT<y"


def test_columns_that_cannot_widen_are_named(spark):
    with pytest.raises(SchemaConflict, match="note.*bigint.*string"):
        merged_schema(T.StructType().add("note", "long"), T.StructType().add("note", "string"))
    assert merged_schema(T.StructType().add("a", "integer"), T.StructType().add("b", "date").add("a", "long")).simpleString() == "struct<a:bigint,b:date>"


def lines(spark, *texts):
    return spark.createDataFrame([(t, "us") for t in texts], "value string, region string")


def invented(rng, depth=0):
    """Any JSON value; names of the contract and others, right and wrong types."""
    roll = rng.random()
    if depth < 4 and roll < 0.5:
        names = ["id", "snippet", "title", "tags", "thumbnails", "default", "url", "statistics", "viewCount", "z z", "a.b", "new"]
        return {n: invented(rng, depth + 1) for n in rng.sample(names, rng.randint(0, 5))}
    if depth < 4 and roll < 0.6:
        return [invented(rng, depth + 2) for _ in range(rng.randint(0, 3))]
    return rng.choice(["text", "", 12, -7.25, True, False, None, "12", 10**15])


def without_nulls(value):
    return {k: without_nulls(v) for k, v in value.items() if v is not None} if isinstance(value, dict) else value


def as_read(value, kind):
    """The value as the contract's column has it and whether that is all of it."""
    if isinstance(kind, T.ArrayType):
        held = isinstance(value, list) and all(v is None or not isinstance(v, (dict, list)) for v in value)
        return [as_read(v, kind.elementType)[0] for v in value] if held else None, held
    if value is None or isinstance(value, (dict, list)):
        return None, value is None
    return (str(value).lower() if isinstance(value, bool) else str(value)), True


def parts(value, schema):
    """The contract's leaves and what is left, by the rules in words."""
    if not isinstance(value, dict):
        return {f.name: parts(None, f.dataType)[0] if isinstance(f.dataType, T.StructType) else None for f in schema.fields}, value
    read, left = {}, {k: v for k, v in value.items() if k not in schema.names}
    for f in schema.fields:
        child = value.get(f.name)
        if isinstance(f.dataType, T.StructType):
            read[f.name], rest = parts(child, f.dataType)
        else:
            read[f.name], whole = as_read(child, f.dataType)
            rest = None if whole else child
        if rest is not None:
            left[f.name] = rest
    return read, left or None


def test_nothing_of_an_item_is_lost(spark):
    rng = random.Random(11)
    items = [invented(rng, 0) for _ in range(600)]
    table = lines(spark, *[json.dumps({"items": [i]}) for i in items])
    got = drift.item_variants(table).select(
        F.to_json("item").alias("item"), drift.projected(F.col("item"), ITEM).alias("read"), F.to_json(drift.extra(F.col("item"), ITEM)).alias("extra")
    )
    compared = 0
    for r in got.collect():
        read, left = parts(json.loads(r.item), ITEM)
        assert r.read.asDict(recursive=True) == read, r.item
        assert (None if r.extra is None else json.loads(r.extra)) == left, r.item
        compared += left is not None
    assert compared > 100


def test_what_is_not_an_envelope_is_an_error_with_its_text(spark):
    good = '{"items": [{"id": "a"}], "page": 3, "_pipeline_metadata": {"region": "us", "run": 1}}'
    captured = drift.captured(lines(spark, good, "not json", '{"items": 5}', '{"a": 1, "a": 2}').withColumn("_source_file", F.lit("f")))
    errors = sorted((r.error, r.text or "") for r in envelope_errors(captured).collect())
    assert errors == [("no items", ""), ("not valid JSON", "not json"), ("not valid JSON", '{"a": 1, "a": 2}')]
    rest = [r.x for r in captured.select(F.to_json(EXTRA).alias("x")).collect()]
    assert [x and json.loads(x) for x in rest] == [{"page": 3, "_pipeline_metadata": {"run": 1}}, None, {"items": 5}, None]
    assert captured.where(F.col(CORRUPT).isNull()).count() == 2


def test_promoted_leaves_are_not_cast(spark):
    texts = [{"id": "a", "n": 12, "f": 1.5, "w": {"x": "7"}}, {"id": "b", "n": "12", "f": 2, "w": {"x": 7}}, {"id": "c"}]
    items = drift.captured(lines(spark, json.dumps({"items": texts}))).select(F.explode("items").alias("item")).select("item.*")
    leaves = {"whole": ("n", "bigint"), "exact": ("f", "decimal(4,1)"), "words": ("w.x", "string")}
    got = {r.id: (r.whole, r.exact and float(r.exact), r.words) for r in drift.promoted(items, leaves).collect()}
    assert got == {"a": (12, 1.5, "7"), "b": (None, None, "7"), "c": (None, None, None)}
    with pytest.raises(ValueError, match="id"):
        drift.promoted(items, {"id": ("n", "bigint")})


def test_report_of_nothing(spark):
    assert drift.drift(drift.item_variants(lines(spark, "{}", "x"))).count() == 0


def test_a_merge_widens_a_column_or_refuses_it(spark, history, folder):
    path = folder("widening")
    rows_of = lambda video, **more: silver_statistics(history({"video_id": video}), as_of=None).withColumn("note", F.lit(more["note"]).cast(more["kind"]))
    merge_snapshots(rows_of("a", note=1, kind="int"), path)
    merge_snapshots(rows_of("b", note=2**40, kind="bigint"), path)
    merge_snapshots(rows_of("c", note=3, kind="int"), path)
    table = read_stored(spark, path)
    assert table.schema["note"].dataType == T.LongType() and {(r.video_id, r.note) for r in table.collect()} == {("a", 1), ("b", 2**40), ("c", 3)}
    with pytest.raises(SchemaConflict, match="note"):
        merge_snapshots(rows_of("d", note="x", kind="string"), path)
    assert read_stored(spark, path).count() == 3


def test_a_table_grows_wider(spark, folder):
    path = folder("wider")
    name = "wider_" + path[-8:]
    table = lambda kind, value: spark.range(1).select(F.lit(value).cast(kind).alias("v"), F.lit("us").alias("region"))
    table("int", 1).write.partitionBy("region").parquet(path)
    register_table(spark, name, path, table("int", 1).schema)
    table("bigint", 2**40).write.mode("append").partitionBy("region").parquet(path)
    assert grow_table(spark, name, table("bigint", 1).withColumn("more", F.lit(date(2021, 1, 1))).schema) == ["more", "v"]
    assert {(r.v, r.more, r.region) for r in spark.table(name).collect()} == {(1, None, "us"), (2**40, None, "us")}
    with pytest.raises(SchemaConflict):
        grow_table(spark, name, table("string", "x").schema)


def test_extras_are_worked_out_once(spark):
    lines = spark.createDataFrame([("{}",)], "value string")
    plan = drift.captured(lines)._jdf.queryExecution().analyzed().toString().splitlines()[0]
    objects = ("payload", "_pipeline_metadata", "item", "snippet", "thumbnails", "default", "statistics")
    assert plan.count("to_variant_object(") == len(objects)
    told = lambda text: drift.captured(spark.createDataFrame([(text,)], "value string")).select(F.expr("to_json(named_struct('in', items._extra, 'out', _extra))")).first()[0]
    assert told('{"items": [{"id": "a", "snippet": {"thumbnails": {"default": {"url": {"x": 1}}}, "tags": ["t", 2]}}, {"statistics": 3}], "at": [1]}') == (
        '{"in":[{"snippet":{"thumbnails":{"default":{"url":{"x":1}}}}},{"statistics":3}],"out":{"at":[1]}}'
    )
    assert told('{"items": null, "etag": null}') == '{"out":{"etag":null,"items":null}}'
