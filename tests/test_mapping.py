"""Field types, conflicts, rules."""

import json

import pytest
from pyspark.sql import functions as F

from eventmill.operators import mapping


@pytest.fixture(scope="module")
def fields(spark):
    docs = [
        (1, "i", '{"A":10,"B":0,"o":{"p":{"q":"x"}},"l":[1,2],"n":null}'), (2, "i", '{"A":"string","B":true,"d":1.5}'),
        (3, "j", '{"A":"s"}'), (4, "j", "no json")]
    frame = spark.createDataFrame(docs, "event_id long, index string, body string")
    return mapping.field_values(frame, "body", ["event_id", "index"])


def test_inventory(fields):
    assert {tuple(r) for r in mapping.inventory(fields).collect()} == {
        ("A", "long", 1), ("A", "string", 2), ("B", "long", 1), ("B", "boolean", 1), ("o.p.q", "string", 1), ("l", "long", 2),
        ("d", "double", 1)}


def test_every_level_is_opened(spark):
    deep = '{"a":' * 11 + "1" + "}" * 11
    frame = spark.createDataFrame([('{"a":{"b":{"c":1}}}',), (deep,), ('{"e":{},"f":[]}',)], "body string")
    assert {tuple(r) for r in mapping.field_values(frame, "body", []).collect()} == {
        ("a.b.c", "long"), (".".join("a" * 11), "long"), ("e", "object"), ("f", "object")}


def test_second_document_is_rejected(fields):
    rows = mapping.conflicts(fields, ["event_id"]).collect()
    assert {(r.event_id, r.path, r.type, r.mapped_type) for r in rows} == {(2, "A", "string", "long"), (2, "B", "boolean", "long")}
    rejected = mapping.rejected_documents(mapping.conflicts(fields, ["event_id"])).collect()
    assert [(r.event_id, r.status) for r in rejected] == [(2, 400)]


@pytest.mark.parametrize("path, kind, rule, mapped", [
    ("fields.0", "long", "numerics_in_fields", "text"), ("fields.10", "long", None, "long"), ("fields.+", "string", "numerics_in_fields", "text"),
    ("fields.x", "string", "string_fields", "text"), ("fields.x", "boolean", None, "boolean")])
def test_rules(spark, path, kind, rule, mapped):
    row = spark.createDataFrame([(path, kind)], "p string, k string").select(
        mapping.dynamic_mapping(F.col("p"), F.col("k")).alias("m")).first().m
    assert (row.rule, row.type) == (rule, mapped) and (row.raw_limit == 256) == (rule == "string_fields")


@pytest.mark.parametrize("exceptions, fits", [
    ([{"Depth": 0, "HResult": -1, "ExceptionMethod": {"MemberType": 8}}], True), ([], True), (None, True),
    ([{"Depth": 0}, {"Depth": "x"}], False), ([{"HResult": None}], True), ([{"ExceptionMethod": {"MemberType": "y"}}], False)])
def test_explicit_types(spark, exceptions, fits):
    body = {"message": "m"} if exceptions is None else {"message": "m", "exceptions": exceptions}
    row = spark.createDataFrame([(json.dumps(body),)], "b string").select(mapping.explicit_mapping(F.col("b")).alias("m")).first().m
    assert row.message == "m" and row.fits == fits


def test_raw(spark):
    frame = spark.createDataFrame([("é" * 256,), ("x" * 257,)], "v string")
    assert [r[0] is None for r in frame.select(mapping.raw_keyword(F.col("v"))).collect()] == [False, True]


def test_field_counts(fields):
    assert {tuple(r) for r in mapping.field_counts(fields, 4).collect()} == {("i", 5, True), ("j", 1, False)}
