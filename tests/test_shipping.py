"""Whole ways: events to requests to answers, direct and durable."""

import datetime
import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from eventmill.model import EVENT_COLUMNS
from eventmill.operators import delivery, document
from eventmill.options import BatchOptions, DocumentOptions, RouteOptions
from eventmill.plans import indexing, shipping
from eventmill.plans.stub import RuleClient
from eventmill.sources import store

WHEN = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)


@pytest.fixture(scope="module")
def events(spark):
    """120 events of one day: every tenth has a text where numbers belong."""
    schema = ", ".join(f"{name} {kind}" for name, kind in EVENT_COLUMNS.items())
    rows = [(i, WHEN + datetime.timedelta(minutes=i), 0, "Error" if i % 2 else "Debug", "{k}",
             {"k": f'"s{i}"' if i % 10 == 0 else str(i), "UserId": str(i)}, None) for i in range(120)]
    return spark.createDataFrame(rows, schema)


def test_direct(spark, events):
    rows = indexing.direct_requests(events, routes=RouteOptions("logs-{0:yyyy.MM}", pipeline="p"), batches=BatchOptions(posting_limit=50))
    sizes = rows.groupBy("batch_id").count().collect()
    assert {r.batch_id: r["count"] for r in sizes} == {"logs-2024.01#0": 50, "logs-2024.01#1": 50, "logs-2024.01#2": 20}
    assert json.loads(rows.first().action) == {"index": {"_index": "logs-2024.01", "pipeline": "p"}}
    outcome = shipping.ship_direct_rows(rows, RuleClient)
    failed = {r.event_id: r.status for r in outcome.item_failures.collect()}
    assert failed == {i: 400 if i % 10 == 0 else 429 for i in range(120) if i % 10 == 0 or i % 89 == 0}
    assert outcome.batch_failures.count() == 0 and outcome.dumps.agg(F.sum("n_rejected")).first()[0] == len(failed)


def test_minimum_level_and_options(events):
    rows = indexing.direct_requests(events, "Information", documents=DocumentOptions(render_message=False),
                                    batches=BatchOptions(op="create"))
    assert rows.count() == 60 and "create" in json.loads(rows.first().action)


def test_nothing_arrives(events):
    class Down:
        def send(self, body):
            return 503, False, ""

    rows = indexing.direct_requests(events)
    outcome = shipping.ship_direct_rows(rows, Down)
    assert outcome.batch_failures.count() == 120 and outcome.item_failures.count() == 0


def test_durable_resends_once(events):
    rows = indexing.direct_requests(events)
    doc_id = F.concat_ws("_", F.col("pos").cast("string"), F.md5(F.col("event_id").cast("string")))
    rows = rows.withColumn("action", F.to_json(F.struct(F.struct("_index", doc_id.alias("_id")).alias("index"))))
    cleaner = lambda row, status, error: F.regexp_replace(row, '"k":"s', '"k":"still text')
    outcome = shipping.ship_durable_rows(rows, RuleClient, cleaner=cleaner)
    assert outcome.item_failures.count() == 13
    again = delivery.failed_items(outcome.resent)
    assert again.count() == 13 and outcome.resent.filter("attempt <> 2").count() == 0
    assert shipping.ship_durable_rows(rows, RuleClient).resent is None


def test_answers_are_sent_for_once(spark, events, tmp_path):
    log = str(tmp_path / "sent")

    class Counting:
        def send(self, body):
            with open(log, "a") as file:
                file.write("x")
            return 200, True, json.dumps({"errors": False, "items": []})

    responses = delivery.sent(shipping.bodies(indexing.direct_requests(events)), Counting)
    assert responses.count() == responses.filter("success").count() == 3
    assert open(log).read() == "xxx"


def test_documents_read_back(spark, events, tmp_path):
    docs = indexing.indexed_documents(events)
    store.write_documents(docs.select("event_id", "_index", "doc"), str(tmp_path / "d"))
    row = store.typed(store.read_documents(spark, str(tmp_path / "d"))).filter("event_id = 3").first()
    assert row["@timestamp"] == datetime.datetime(2024, 1, 1, 0, 3) and row.level == "Error" and row.message == "3"


def test_dump_files(spark, events, tmp_path):
    outcome = shipping.ship_direct_rows(indexing.direct_requests(events), RuleClient)
    dumps = outcome.dumps.withColumn("http_status", F.lit(200))
    store.write_dumps(dumps, str(tmp_path / "dumps"))
    lines = "".join(p.read_text() for p in (tmp_path / "dumps" / "http_status=200").glob("*.txt")).splitlines()
    assert len(lines) == 2 * 13


def test_custom_formatter(events):
    good, bad = document.custom_document(
        events, lambda rows: F.when(F.col("event_id") < 5, F.lit("{broken")).otherwise(F.to_json(F.struct("event_id"))))
    assert (good.count(), bad.count()) == (115, 5)


def test_observed(events):
    seen = Observation("events")
    delivery.observed(events, seen, errors=F.col("level") == "Error").write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 120, "errors": 60}
