"""Index, pipeline and type choice; action lines, bodies, index and create semantics."""

import datetime

import pytest
from pyspark.sql import functions as F

from eventmill.functions import times
from eventmill.operators import bulk, filters, routing
from eventmill.options import BatchOptions, RouteOptions

WHEN = datetime.datetime(2013, 5, 28, 12, 10, 20, tzinfo=datetime.timezone.utc)


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(
        [(1, WHEN, "Information"), (2, WHEN.replace(year=2011), "Fatal")], "event_id long, ts timestamp, level string")


def values(frame, column):
    return [row[0] for row in frame.orderBy("event_id").select(column).collect()]


def test_index_names(events):
    assert values(events, routing.index_name(F.col("ts"), "Event-Index-{0:yyyy.MM.dd}")) == [
        "event-index-2013.05.28", "event-index-2011.05.28"]
    decider = F.concat(F.lit("Logstash-"), F.lower("level"))
    assert values(events, routing.decided_index(F.col("ts"), decider=decider)) == ["Logstash-information", "Logstash-fatal"]
    assert values(events, routing.index_name(F.col("ts"), "a-{0:yyyy}-{0:HH.mm}-b")) == ["a-2013-12.10-b", "a-2011-12.10-b"]


def test_level_smoke(spark):
    rows = spark.createDataFrame([("Information",), ("Debug",), ("Warning",), ("Error",), ("Fatal",)], "level string")
    assert filters.at_least(rows, "Information").count() == 4
    assert filters.at_least(rows, None).count() == 5


@pytest.mark.parametrize("version, configured, resolved", [
    ("8.0.0", "my", None), ("8.0.0", None, None), ("7.17.5", None, None), ("6.8.1", "my", "my"), ("6.8.1", None, "logevent"),
    ("6.8.1", " ", "logevent")])
def test_type_names(spark, version, configured, resolved):
    row = spark.createDataFrame([(version, configured)], "v string, t string")
    assert row.select(routing.type_name(F.col("v"), F.col("t"))).first()[0] == resolved


@pytest.mark.parametrize("default, decided, want", [
    ("main", None, "main"), ("main", "own", "own"), ("main", " ", None), (None, None, None), ("", None, None)])
def test_pipelines(spark, default, decided, want):
    row = spark.createDataFrame([(decided,)], "d string")
    assert row.select(routing.pipeline_name(default, F.col("d"))).first()[0] == want
    if decided is None:
        assert row.select(routing.pipeline_name(default)).first()[0] == want


@pytest.mark.parametrize("name, index", [
    ("buf-20240105.json", "logstash-2024.01.05"), ("a-b-20240105_001.JSON", "logstash-2024.01.05"),
    ("buf-20240105.txt", None), ("buf-2024.json", None)])
def test_file_dates(spark, name, index):
    row = spark.createDataFrame([(name,)], "f string")
    assert row.select(routing.buffered_index(F.col("f"))).first()[0] == index


def test_wildcards(spark):
    row = spark.createDataFrame([("logs-{0:yyyy.MM}-x",)], "f string")
    assert row.select(times.wildcard_of(F.col("f"))).first()[0] == "logs-*-x"
    templates = [routing.IndexTemplate("all", "*"), routing.IndexTemplate("dot", "a.b-*", 2), routing.IndexTemplate("end", "*-z", 1)]
    names = spark.createDataFrame([("a.b-c",), ("axb-c",), ("q-z",)], "i string")
    assert [r[0] for r in names.select(routing.best_template(F.col("i"), templates)).collect()] == ["dot", "all", "end"]
    assert names.select(routing.best_template(F.col("i"), [])).first()[0] is None


def test_dead_letters(spark, events):
    targets = spark.createDataFrame(
        [("a", False, "IndexToDeadletterIndex"), ("b", False, "FailSink"), ("c", True, "FailSink"), ("d", False, "IndexAnyway")],
        "target string, registration_ok boolean, recovery string")
    rows = events.filter("event_id = 1").crossJoin(spark.createDataFrame([(t,) for t in "abcdx"], "target string"))
    routed = routing.route_to_targets(rows, targets, RouteOptions(dead_letter_format="Dead-{0:yyyy}"))
    assert {r["target"]: r["index"] for r in routed.sent.collect()} == {
        "a": "Dead-2013", "c": "logstash-2013.05.28", "d": "logstash-2013.05.28", "x": "logstash-2013.05.28"}
    assert [r.target for r in routed.failed.collect()] == ["b"]


@pytest.mark.parametrize("op, kind, pipeline, doc_id, line", [
    ("index", None, None, None, '{"index":{"_index":"logs"}}'),
    ("create", None, " ", None, '{"create":{"_index":"logs"}}'),
    ("index", "_doc", "my-pipeline", None, '{"index":{"_type":"_doc","_index":"logs","pipeline":"my-pipeline"}}'),
    ("create", "_doc", "p", "0_a", '{"create":{"_type":"_doc","_index":"logs","pipeline":"p","_id":"0_a"}}')])
def test_action_lines(spark, op, kind, pipeline, doc_id, line):
    as_column = lambda value: F.lit(value).cast("string")
    row = spark.range(1).select(bulk.action_line(op, F.lit("logs"), as_column(kind), as_column(pipeline), as_column(doc_id)))
    assert row.first()[0] == line


def test_bodies(spark):
    rows = spark.createDataFrame([("b", 1, "two"), ("b", 0, "one"), ("c", 0, "x")], "batch_id string, pos int, lines string")
    assert {r.batch_id: (r.n_events, r.body) for r in bulk.request_bodies(rows).collect()} == {
        "b": (2, "one\ntwo\n"), "c": (1, "x\n")}


def test_replay_gives_the_same_id(spark):
    row = spark.range(2).select(bulk.durable_id(F.lit(3), F.lit("f"), F.lit(10))).collect()
    assert row[0] == row[1] and row[0][0].startswith("3_")


@pytest.fixture(scope="module")
def store(spark):
    return spark.createDataFrame([(1, "old"), (2, "kept")], "id int, v string")


@pytest.fixture(scope="module")
def writes(spark):
    return spark.createDataFrame(
        [(1, "a", 1, 10), (1, "b", 2, 11), (3, "c", 2, 12), (3, "d", 1, 13)], "id int, v string, at int, event_id long")


def test_index_replaces(store, writes):
    rows = bulk.apply_index(store, writes, "id", ["at", "event_id"]).collect()
    assert {tuple(r) for r in rows} == {(1, "b"), (2, "kept"), (3, "c")}


def test_create_keeps(store, writes):
    rows = bulk.apply_create(store, writes, "id", ["at", "event_id"]).collect()
    assert {tuple(r) for r in rows} == {(1, "old"), (2, "kept"), (3, "d")}
    lost = bulk.create_conflicts(store, writes, "id", "event_id", ["at", "event_id"]).collect()
    assert {r.event_id for r in lost} == {10, 11, 12}


@pytest.mark.parametrize("wrong", [{"op": "update"}, {"posting_limit": 0}, {"queue_limit": -1}])
def test_options(wrong):
    with pytest.raises(ValueError):
        BatchOptions(**wrong)


def test_level_switch_before_and_after(spark):
    control = spark.createDataFrame([(WHEN, 3), (WHEN.replace(hour=18), 1), (WHEN.replace(hour=20, day=30), 4)],
                                    "effective_from timestamp, min_rank int")
    rows = spark.createDataFrame([
        (1, WHEN.replace(hour=3), 0), (2, WHEN, 2), (3, WHEN, 3), (4, WHEN.replace(hour=18), 1), (5, WHEN.replace(day=29), 0),
        (6, WHEN.replace(day=29), 1), (7, WHEN.replace(month=9), 3), (8, WHEN.replace(month=9), 4)],
        "event_id long, ts timestamp, level_rank int")
    kept = filters.at_least_switched(rows, control)
    assert sorted(r.event_id for r in kept.collect()) == [1, 3, 4, 6, 8]
    assert filters.at_least_switched(rows, control.limit(0)).count() == 8
