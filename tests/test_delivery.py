"""Responses, correlation, failure routes, cleaning, dumps, retry delays, positions."""

import json

import pytest
from pyspark.sql import functions as F

from eventmill.operators import delivery


def answer(*items, errors=True):
    return json.dumps({"errors": errors, "items": list(items)})


OK = {"index": {"_index": "i", "_id": "0_a", "status": 201}}
BAD = {"index": {"_index": "i", "_id": "1_b", "status": 400, "error": {"type": "mapper", "reason": "no"}}}
BARE = {"index": {"_index": "i", "_id": "x_c", "status": 429, "error": {}}}
SILENT = {"index": {"_index": "i", "_id": "3_d"}}


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(
        [(b, p, 10 * i + p, "a", f"doc {p}") for i, b in enumerate(("one", "two", "three")) for p in range(4)],
        "batch_id string, pos int, event_id long, action string, doc string")


@pytest.fixture(scope="module")
def responses(spark):
    rows = [("one", 1, 200, True, answer(OK, BAD, BARE, SILENT)), ("two", 1, 200, True, answer(BAD, errors=False)),
            ("three", 1, 503, False, None)]
    return delivery.parsed(spark.createDataFrame(rows, delivery.RESPONSE))


def test_items_are_read_only_with_errors(responses):
    assert delivery.response_items(responses).count() == 4
    assert delivery.response_items(responses, op="create").filter("_id IS NOT NULL").count() == 0


def test_by_position(events, responses):
    rows = delivery.failures_by_position(events, responses).orderBy("pos").collect()
    assert [(r.batch_id, r.event_id, r.status) for r in rows] == [("one", 1, 400), ("one", 2, 429)]


def test_by_id(events, responses):
    rows = {r._id + r.batch_id: r for r in delivery.failures_by_id(events, responses).collect()}
    assert set(rows) == {"1_bone", "x_cone", "1_btwo"}
    assert rows["1_bone"].event_id == 1 and rows["1_bone"].error_text == "type: mapper, reason: no"
    assert rows["x_cone"].event_id is None and rows["x_cone"].error_text == "type: Unknown, reason: Unknown"


def test_whole_batches(events, responses):
    lost = delivery.whole_batch_failures(events, responses)
    assert sorted(r.event_id for r in lost.collect()) == [20, 21, 22, 23]


@pytest.mark.parametrize("flags, names", [(0, set()), (1, {"self_log"}), (2, {"failure_sink"}), (8, {"callback"}), (11, {"self_log", "failure_sink", "callback"})])
def test_flags(events, flags, names):
    assert set(delivery.failure_routes(events, flags)) == names
    frame = events.limit(1).select(F.lit(flags).alias("f"))
    assert frame.select(delivery.has_flag(F.col("f"), 8)).first()[0] == ("callback" in names)


def test_handlers(events, responses):
    items = delivery.failures_by_position(events, responses)
    batches = delivery.whole_batch_failures(events, responses)
    seen = {}

    def sink(rows):
        seen["sink"] = rows.count()

    def log(rows):
        seen["log"] = seen.get("log", 0) + rows.count()

    def broken(rows):
        raise ValueError("handler")

    handlers = {"failure_sink": sink, "callback": broken, "self_log": log}
    delivery.handle_failures(items, batches.limit(0), 2 | 4 | 8, handlers)
    assert seen == {"sink": 2, "log": 1}
    with pytest.raises(delivery.DeliveryFailed):
        delivery.handle_failures(items, batches, 2 | 4, handlers)
    assert seen["sink"] == 6


def test_cleaning_and_dumps(events, responses):
    failed = delivery.failures_by_id(events, responses)
    fixed = delivery.cleaned(failed, lambda row, status, error: F.concat_ws("/", row, status.cast("string"), error))
    assert {r.doc for r in fixed.collect()} == {"doc 1/400/type: mapper, reason: no"} and fixed.count() == 2
    dump = {r.batch_id: r for r in delivery.dump_rows(failed).collect()}
    assert dump["one"].payload == "a\ndoc 1" and dump["one"].n_rejected == 1
    assert dump["one"].file_name.startswith("invalid-200-") and dump["one"].item_status == 400


@pytest.mark.parametrize("failures, period, delay", [
    (0, 2, 2.0), (1, 2, 2.0), (2, 2, 10.0), (3, 2, 20.0), (9, 2, 600.0), (60, 2, 600.0), (3, 30, 120.0), (5, 900, 900.0)])
def test_delays(spark, failures, period, delay):
    row = spark.range(1).select(delivery.retry_delay(F.lit(failures), period))
    assert row.first()[0] == delay


def test_positions(spark):
    rows = spark.createDataFrame([
        ("a", 1, True, 10), ("a", 2, True, 25), ("a", 3, False, 40), ("a", 4, True, 50), ("b", 1, False, 9), ("c", 1, True, 7),
        ("d", 1, True, 100), ("d", 2, False, 200), ("d", 3, True, 200), ("d", 4, False, 300)],
        "file string, attempt_no long, success boolean, next_offset long")
    assert dict(map(tuple, delivery.committed_positions(rows).collect())) == {"a": 50, "b": 0, "c": 7, "d": 200}


def test_client_per_task(spark):
    class Echo:
        def send(self, body):
            return 200, not body.startswith("bad"), json.dumps({"errors": False, "items": []})

    requests = spark.createDataFrame([("1", "ok"), ("2", "bad one")], "batch_id string, body string")
    assert {(r.batch_id, r.success, r.attempt) for r in delivery.deliver(requests, Echo, 2).collect()} == {("1", True, 2), ("2", False, 2)}
    assert delivery.diagnostics(("x", requests, F.length("body")), ("y", requests, F.lit(1))).count() == 4


def test_few_bodies_at_once(spark, monkeypatch):
    """A body is as large as its batch, so what a task holds is bounded by the number of bodies, not by the session's rows."""
    import pandas as pd

    bodies = spark.range(0, 450, 1, 1).selectExpr("CAST(id AS string) AS batch_id", "'x' AS body")
    before, held = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"), []

    def counted(frames):
        for frame in frames:
            yield pd.DataFrame({"n": [len(frame)]})

    monkeypatch.setattr(delivery, "written", lambda df, label: held.extend(r.n for r in bodies.mapInPandas(counted, "n int").collect()))
    delivery.sent(bodies, lambda: None)
    assert sum(held) == 450 and max(held) <= 100
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_request_rows_are_made_once(spark):
    """Sending, looking for rejects and sending again read the rows that were made, not what they are made of."""
    from eventmill.plans import shipping

    class Rejecting:
        def send(self, body):
            return 200, True, json.dumps({"errors": True, "items": [{"index": {"_index": "i", "_id": "0_a", "status": 400, "error": {"type": "t", "reason": "r"}}}]})

    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def doc(n):
        made.add(1)
        return f"doc {n}"

    rows = spark.range(40).select(F.concat(F.lit("b"), F.col("id")).alias("batch_id"), F.lit(0).alias("pos"), F.col("id").alias("event_id"), F.lit("{}").alias("action"), doc("id").alias("doc"))
    outcome = shipping.ship_durable_rows(rows, Rejecting, cleaner=lambda row, status, error: F.concat(row, F.lit("!")))
    assert outcome.resent.count() == 40 and sorted(r.doc for r in outcome.item_failures.collect()) == sorted(f"doc {n}" for n in range(40))
    assert made.value == 40
