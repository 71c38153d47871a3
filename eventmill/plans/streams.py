"""Registered queries of the durable and stateful streams, and of what is kept between runs."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.functions import template
from eventmill.operators import bulk, mapping, routing
from eventmill.operators.registry import Registry
from eventmill.options import BatchOptions
from eventmill.plans.queries import query
from eventmill.session import new_folder
from eventmill.sources import ordered, views
from eventmill.sources.indexed import IndexedStore
from eventmill.sources.ordered import store_of
from eventmill.sources.store import INDEX
from eventmill.streaming import admission, durable, jobs, retry, sink

#: Lines of a source in a step, and bytes up to which a line is sent.
LINES_PER_STEP, LINE_BYTES = 200, 13
#: Steps of a source that is behind in one batch: what its task holds at most, 200,000 lines.
STEPS_PER_BATCH = 1_000


def _buffered(spark: SparkSession, folder: str) -> str:
    """A folder of rolling files of three sources; each line tells its event."""
    logs = views.log_events(spark, folder)
    path = new_folder(spark, "buffer")
    lines = logs.select(
        F.concat(F.lit("s"), (F.col("user_id") % 3).cast("string")).alias("source"), views.buffer_file_name().alias("file_name"), "event_id",
        F.concat_ws("|", F.col("event_id").cast("string"), "props").alias("line"))
    ordered.store_lines(lines, path, ["event_id"])
    return path


def _lines(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    return ordered.ordered_lines(spark, path, "buf", lines=LINES_PER_STEP, bookmark=f"{checkpoint}.bookmark", steps=STEPS_PER_BATCH)


def _event_id(line: str):
    return F.get(F.split(line, r"\|"), F.lit(0)).cast("bigint")


@query
def stream_ship_ordered(spark, folder):
    """Steps of a bounded number of lines per source, in order of date and sequence, in payloads of one file and at most 50 lines."""
    def payloads(batch):
        placed = bulk.in_batches(batch, ["source", "file_name", "step"], ["start_offset"])
        return placed.select("source", "file_name", _event_id("line").alias("event_id"), "start_offset", "next_offset", F.col("batch_no").alias("payload"), "pos", "step")

    path, out, checkpoint = _buffered(spark, folder), new_folder(spark, "shipped"), new_folder(spark, "checkpoint")
    jobs.drained_steps(jobs.ship(_lines(spark, path, checkpoint), payloads, out, checkpoint, seconds=0))
    return spark.read.parquet(out).drop("batch")


class StoreGone(RuntimeError):
    """What a drill of a lost store raises."""


@query
def stream_durable_positions(spark, folder):
    """Request rows and committed positions, though the second batch of steps fails and the query starts anew."""
    failed = []

    def shipped(batch):
        if len(failed) < 2:
            failed.append(1)
            if len(failed) == 2:
                raise StoreGone("the second step of the first run")
        return batch.select("source", "payload", "pos", _event_id("doc").alias("event_id"), "start_offset", "next_offset", F.col("_index").alias("index"), "doc_id")

    path, out, checkpoint = _buffered(spark, folder), new_folder(spark, "shipped"), new_folder(spark, "checkpoint")
    for run in range(2):
        rows = durable.durable_stream(_lines(spark, path, checkpoint), batches=BatchOptions(event_bytes_limit=LINE_BYTES))
        try:
            with jobs.state_partitions(spark):
                started = jobs.ship(rows, shipped, out, checkpoint, seconds=0)
            jobs.drained_steps(started)
        except Exception as error:
            if run or "the second step of the first run" not in str(error):
                raise
    at = durable.positions(spark, checkpoint).select("source", F.col("file_name").alias("at_file"), F.col("next_offset").alias("at_offset"))
    return spark.read.parquet(out).drop("batch").join(F.broadcast(at), "source")  # a row for each of three sources


@query
def stream_retry_after_delay(spark, folder):
    """Each failed attempt, sent again when its delay is over, with delays a thousandth as long."""
    ledger = views.attempts(spark, folder)
    attempts = jobs.event_stream(spark, folder, "events").select(
        F.concat(F.lit("t"), (F.col("user_id") % 5).cast("string")).alias("target"), F.col("event_id").alias("attempt_no"), F.col("ts").cast("timestamp").alias("ts"),
        (F.col("event_type") != "error").alias("success"), F.col("props").alias("payload"))
    out, expected = new_folder(spark, "retries"), ledger.filter("NOT success").count()

    def sent() -> DataFrame:
        return spark.read.schema(retry.RETRY).option("recursiveFileLookup", True).parquet(out)

    store, place = store_of(out)
    store.create_dir(place, recursive=True)
    with jobs.state_partitions(spark):
        started = jobs.ship(retry.retries(attempts, 2, clock=0.001), lambda batch: batch, out, new_folder(spark, "checkpoint"), seconds=0)
    jobs.until(started, lambda: sent().count() >= expected)
    return sent().select("target", "attempt_no", "payload", "failures_in_a_row", "delay_seconds", (F.col("sent_ms") >= F.col("due_ms")).alias("waited"))


@query
def stream_commit_once(spark, folder):
    """Events through the committing writer, whose first commit is lost between write and manifest, and whose second run is the whole."""
    class Interrupted(sink.ManifestWriter):
        def commit(self, messages, batchId):
            store, place = self.place("interrupted")
            if store.get_file_info(place).type.name == "NotFound":
                store.create_dir(posixpath.dirname(place), recursive=True)
                store.open_output_stream(place).close()
                raise RuntimeError("the driver is lost before the commit")
            super().commit(messages, batchId)

        def abort(self, messages, batchId):
            """A lost driver cleans nothing up."""

    class Files(sink.CommittedFiles):
        @classmethod
        def name(cls):
            return "committed_files_interrupted"

        def streamWriter(self, schema, overwrite):
            return Interrupted(self.options["path"])

    rows = views.log_columns(jobs.event_stream(spark, folder, "events")).select("event_id", "level")
    out, checkpoint = new_folder(spark, "delivered"), new_folder(spark, "checkpoint")
    for run in range(2):
        try:
            jobs.drained(sink.ship_committed(rows, out, checkpoint, source=Files))
        except Exception as error:
            if run or "before the commit" not in str(error):
                raise
    delivered = sink.committed(spark, out, rows.schema)
    return delivered.groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("n_events"), F.sum("event_id").alias("id_sum"))


@query
def stream_admission(spark, folder):
    """The batch operator's admission, by keyed state."""
    logs = views.log_columns(jobs.event_stream(spark, folder, "events")).select("event_id", "ts", F.date_format("ts", "yyyy-MM-dd HH").alias("bucket"))
    total = views.table(spark, folder, "events").count()
    out = new_folder(spark, "admitted")
    with jobs.state_partitions(spark):
        started = jobs.ship(admission.admitted_stream(logs, "bucket", ["ts", "event_id"], BatchOptions(queue_limit=10)),
                            lambda batch: batch.select("event_id", "bucket"), out, new_folder(spark, "checkpoint"), seconds=0)
    jobs.until(started, lambda: sum({p["batchId"]: p["numInputRows"] for p in started.recentProgress}.values()) >= total)
    return spark.read.parquet(out).select("event_id", "bucket")


@query
def stream_without_replays(spark, folder):
    """Lines of all sources shipped twice, the second time an hour later; each adds one row."""
    path, twice = _buffered(spark, folder), new_folder(spark, "twice")
    once = _buffer_rows(spark, path)
    for hours in range(2):
        once.withColumn("shipped", F.timestamp_seconds(F.lit(1_700_000_000 + 3600 * hours))).write.parquet(f"{twice}/run={hours}")
    rows = spark.readStream.schema("doc_id string, event_id long, index string, shipped timestamp").option("recursiveFileLookup", True).parquet(twice)
    out = new_folder(spark, "shipped")
    with jobs.state_partitions(spark):
        started = jobs.ship(admission.without_replays(rows, "doc_id", "shipped", "2 hours"), lambda batch: batch, out, new_folder(spark, "checkpoint"))
    jobs.drained(started)
    return spark.read.parquet(out).select("event_id", "index")


def _buffer_rows(spark: SparkSession, path: str) -> DataFrame:
    """Durable ids, events and indices of all lines of a folder of rolling files."""
    text = spark.read.option("recursiveFileLookup", True).text(path).select("_metadata.file_path", F.regexp_replace("value", r"^﻿", "").alias("line"))
    name = F.element_at(F.split("file_path", "/"), -1)
    event = _event_id("line")
    return text.select(F.md5(F.concat_ws(":", "file_path", event.cast("string"))).alias("doc_id"), event.alias("event_id"),
                       F.concat(F.lit("logstash-"), F.date_format(F.to_date(F.regexp_extract(name, r"-(\d{8})", 1), "yyyyMMdd"), "yyyy.MM.dd")).alias("index"))


@query
def mapping_registry_updates(spark, folder):
    """Mappings kept between runs: two updates of half the documents each, and one that is repeated."""
    registry = Registry(spark, new_folder(spark, "registry"))
    logs = views.log_events(spark, folder).select("event_id", "ts", routing.index_name(F.col("ts")).alias("index"), "props")
    for number, half in ((0, 0), (1, 1), (1, 1)):
        fields = mapping.field_values(logs.filter(F.col("event_id") % 2 == half), "props", ["event_id", "ts", "index"], "fields")
        registry.update(fields, ["ts", "event_id"], number)
    known = registry.known()
    return known.join(mapping.mappings(known), ["index", "path"]).select("index", "path", "type", "n", "mapped_type", "mixed")


def _indexed(spark, folder, way: str) -> DataFrame:
    """Suppliers as a stored index, and the events of users as operations on it."""
    store = IndexedStore(spark, new_folder(spark, "store"), "doc_id")
    shard = F.concat(F.lit("i"), (F.col("doc_id") % 3).cast("string"))
    suppliers = views.table(spark, folder, "supplier").select(F.col("s_suppkey").alias("doc_id"), F.col("s_name").alias("payload"))
    store.write(suppliers.withColumn(INDEX, shard), "overwrite")
    writes = views.log_events(spark, folder).select(F.col("user_id").alias("doc_id"), F.col("props").alias("payload"), "ts", "event_id").withColumn(INDEX, shard)
    getattr(store, way)(writes, ["ts", "event_id"], ["doc_id", "payload", INDEX])
    return store.read().select("doc_id", "payload", F.col(INDEX).alias("index"))


@query
def indexed_store_create(spark, folder):
    return _indexed(spark, folder, "create")


@query
def indexed_store_replace(spark, folder):
    return _indexed(spark, folder, "replace")


@query
def match_many_templates(spark, folder):
    """The daily indices of all events against one template for each supplier and some for all."""
    own = views.table(spark, folder, "supplier").select(
        F.concat(F.lit("s"), F.col("s_suppkey")).alias("name"),
        F.concat(F.lit("logstash-2024.01."), F.lpad((F.col("s_suppkey") % 40).cast("string"), 2, "0"), F.when(F.col("s_suppkey") % 3 == 0, "*").otherwise("")).alias("pattern"),
        (F.col("s_suppkey") % 7).cast("int").alias("priority"))
    shared = spark.sql("SELECT * FROM VALUES ('a', 'logstash-*', 1), ('b', '*.01.1*', 6), ('c', 'dailyindex-*', 9) AS t(name, pattern, priority)")
    events = views.log_events(spark, folder).select("event_id", routing.index_name(F.col("ts")).alias("index"))
    return routing.best_templates(events, own.unionByName(shared))


@query
def render_number_formats(spark, folder):
    """Patterns, percent, exponent and hexadecimal formats of the values and users of all events."""
    cents = F.col("value").cast("decimal(18,2)").cast("string")
    shown = {"pattern": (cents, "#,##0.0#"), "bare": (cents, "#.#"), "percent": (cents, "P1"), "exponent": (cents, "E6"), "hexadecimal": (F.col("user_id").cast("string"), "X4")}
    return views.log_events(spark, folder).select("event_id", *(template.formatted(text, f).alias(name) for name, (text, f) in shown.items()))


@query
def unsupported_formats(spark, folder):
    """Formats that leave a number as it is, by template, told beforehand."""
    logs = views.log_events(spark, folder).withColumn("message_template", F.when(F.col("event_id") % 5 == 0, "{Value:C2} {UserId:0.0} {When:HH:mm}").otherwise(F.col("message_template")))
    return template.unsupported_formats(logs)
