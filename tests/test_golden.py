"""Known values over the medium tables."""

import pytest
from conftest import MEDIUM
from pyspark.sql import functions as F

from eventmill.operators import bulk, mapping
from eventmill.plans.queries import QUERIES
from eventmill.sources import views


def run(spark, name):
    return QUERIES[name](spark, MEDIUM)


def test_levels(spark):
    rows = views.log_events(spark, MEDIUM).groupBy("level").count().collect()
    assert dict(map(tuple, rows)) == {
        "Verbose": 1982, "Debug": 2006, "Information": 1981, "Warning": 2017, "Error": 1598, "Fatal": 416}


def test_daily_counts(spark):
    rows = dict(map(tuple, run(spark, "count_by_index").collect()))
    assert len(rows) == 30 and sum(rows.values()) == 6012
    assert [rows[f"logstash-2024.01.0{day}"] for day in (1, 2, 3)] == [215, 197, 203]


@pytest.mark.parametrize("name, count", [
    ("filter_min_level", 6012), ("filter_level_switch_asof", 5865), ("bulk_batches", 215), ("flatten_exceptions", 25_017)])
def test_row_counts(spark, name, count):
    assert run(spark, name).count() == count


def test_oversized(spark):
    assert run(spark, "drop_oversized").filter("NOT kept").count() == 589


def test_tokens(spark):
    assert dict(map(tuple, run(spark, "template_token_usage").collect())) == {
        "{EventType}": 6667, "{UserId}": 6667, "{Value:0.00}": 3333, "{Missing}": 3333}


def test_times(spark):
    rows = run(spark, "document_envelope").filter("event_id < 4").orderBy("event_id").select("`@timestamp`").collect()
    assert [row[0] for row in rows] == [
        "2024-01-01T00:00:07.1795750+00:00", "2024-01-01T01:03:52.8244250+01:00",
        "2023-12-31T19:06:29.1652750-05:00", "2024-01-01T10:08:25.0025540+10:00"]


def test_exceptions(spark):
    assert run(spark, "flatten_exceptions").agg(F.max("depth")).first()[0] == 20


def test_mappings(spark):
    rows = run(spark, "mapping_conflicts").groupBy("mapped_type").agg(
        F.count_distinct("index"), F.count("*")).collect()
    assert {tuple(row) for row in rows} == {("long", 29, 567), ("string", 1, 342)}


def test_create_on_an_empty_store(spark):
    events = views.log_events(spark, MEDIUM).select(F.col("user_id").alias("doc_id"), "event_id", "ts")
    empty = events.select("doc_id", "event_id").limit(0)
    assert bulk.apply_create(empty, events, "doc_id", ["ts", "event_id"]).count() == 150
    assert bulk.create_conflicts(empty, events, "doc_id", "event_id", ["ts", "event_id"]).count() == 9850


def test_targets(spark):
    rows = run(spark, "resolve_type_name").collect()
    assert {(r.target, r.resolved_type, r.n) for r in rows} == {
        ("t0", None, 2024), ("t1", None, 1960), ("t2", "my", 2063), ("t3", "logevent", 1965), ("t4", None, 1988)}


def test_retries(spark):
    rows = run(spark, "retry_schedule")
    top = rows.agg(F.max("failures_in_a_row"), F.max("delay_seconds")).first()
    assert tuple(top) == (6, 160.0) and rows.filter("failures_in_a_row >= 2").count() == 417


def test_buffer(spark):
    files = run(spark, "buffer_file_catalog")
    assert tuple(files.agg(F.count("*"), F.sum("n_lines"), F.sum("size_bytes")).first()) == (60, 10_000, 91_319)
    assert run(spark, "retention_by_size").filter("NOT keep").count() == 28


def test_templates(spark):
    rows = run(spark, "match_index_template").groupBy("template").count().collect()
    assert dict(map(tuple, rows)) == {"a": 20, "b": 10}


def test_rejects_become_failures(spark):
    logs = views.log_events(spark, MEDIUM).select("event_id", "ts", F.lit("i").alias("index"), "props")
    fields = mapping.field_values(logs, "props", ["event_id", "ts", "index"], "fields")
    rejected = mapping.rejected_documents(mapping.conflicts(fields, ["ts", "event_id"]))
    row = rejected.first()
    assert row.status == 400 and row.error.reason.startswith("failed to parse field [fields.k]")


def test_finished_chains_are_not_joined(spark, monkeypatch):
    """Most exceptions have a missing outer one after a few rounds; none of them is sent to the task of the missing key."""
    from eventmill.operators import exceptions
    rounds, written = [], exceptions.written
    monkeypatch.setattr(exceptions, "written", lambda df, label: rounds.append(df) or written(df, label))
    rows = [(100 * e + d, 100 * e + d + 1 if d < e % 25 else None) for e in range(60) for d in range(e % 25 + 1)]
    links = spark.createDataFrame(rows, "exc_id long, inner_exc_id long")
    found = exceptions.depths_from_links(links).collect()
    assert sorted((r.exc_id, r.depth) for r in found) == sorted((n, n % 100) for n, _ in rows if n % 100 <= 20)
    assert len(rounds) == 5
    for df in rounds[1:]:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Union" in plan and "isnotnull(_up" in plan and "isnull(_up" in plan
