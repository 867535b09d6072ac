from __future__ import annotations

import pytest

from tierline.operators import reference
from tierline.plans.silver import silver_reference
from tierline.sources import read_reference, reference_for_day

FILES = {
    ("US", "2021-05-31"): '{"kind": "list", "items": [\n{"id": "1", "snippet": {"title": "old"}},\n'
    '{"id": "2", "snippet": {"title": "two", "channelId": "c", "assignable": true}},\n{"id": "1", "snippet": {"title": "new"}}]}',
    ("gb", "2021-05-31"): '{"kind": "category", "id": "1", "snippet": {"title": "british"}}',
    ("in", "2021-05-30"): '{"items": []}',
    ("de", "2021-05-30"): '{"items": [{"id": "3"',
    ("fr", "2021-05-30"): '{"items": [{"etag": "e"}]}',
}


@pytest.fixture(scope="module")
def documents(spark):
    from tierline.session import fresh_path

    root = fresh_path(spark, "test-reference")
    rows = [(r, d, t) for (r, d), t in FILES.items()]
    spark.createDataFrame(rows, "region string, date string, value string").write.partitionBy("region", "date").text(root)
    return read_reference(spark, root)


def test_silver_reference(documents):
    rows = silver_reference(documents).orderBy("region", "id").collect()
    assert [(r.region, r.id, r.snippet_title) for r in rows] == [
        ("US", "1", "new"), ("US", "2", "two"), ("fr", None, None), ("gb", "1", "british"),
    ]
    assert "region=US" in rows[0]["_source_file"] and rows[0]["_ingestion_timestamp"] is not None
    assert "position" not in rows[0]


def test_bad_files_are_reported_and_the_rest_goes_on(documents):
    errors = {r["_source_file"].split("region=")[1][:2]: r.error for r in reference.reference_errors(documents).collect()}
    assert errors == {"in": "no category items", "de": "not valid JSON"}


def test_validation(documents):
    rows = reference.validate_reference(documents).collect()
    got = {r["_source_file"].split("region=")[1][:2]: (r.severity, list(r.missing_columns)) for r in rows}
    assert got["US"] == ("ok", []) and got["gb"] == ("ok", [])
    assert got["fr"] == ("warning", ["id", "snippet_title"]) and got["in"][0] == "error"


def test_day(documents):
    from datetime import date

    assert reference_for_day(documents, date(2021, 5, 31)).count() == 2
    assert reference_for_day(documents, date(2021, 5, 31), ["us"]).count() == 1


def test_lookup_is_one_title_per_id(spark):
    rows = spark.createDataFrame(
        [("1", "b", "gb"), ("1", "a", "us"), ("1", "z", "ca"), ("2.5", "x", "us"), (None, "y", "us"), ("3", None, "us")],
        ["id", "snippet_title", "region"],
    )
    got = {r.category_id: r.category_name for r in reference.category_lookup(rows).collect()}
    assert got == {1: "z", 2: "x", 3: None}
    dotted = rows.withColumnRenamed("snippet_title", "snippet.title").drop("region")
    assert {r.category_id for r in reference.category_lookup(dotted).collect()} == {1, 2, 3}
    assert reference.category_lookup(rows.drop("snippet_title")) is None
