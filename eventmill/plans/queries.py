"""The registered queries, by name. Each reads the given tables whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.functions import template, times
from eventmill.functions.jsontext import string_json, structured_fields
from eventmill.operators import bulk, delivery, document, exceptions, filters, mapping, retention, rolling, routing
from eventmill.operators.running import ROWS_PER_CHUNK, plan_chunks
from eventmill.options import DocumentOptions, RouteOptions
from eventmill.plans import indexing, shipping
from eventmill.plans.stub import RuleClient
from eventmill.session import new_folder, written
from eventmill.sources import buffer, store, views
from eventmill.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def daily_index():
    return routing.index_name(F.col("ts"))


# Rows to a range in the ``_ranged`` queries: so few that the small tables take the way of the large ones.
FEW_ROWS = 500


def batched_events(spark: SparkSession, folder: str, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """All events in batches per daily index, with durable ids."""
    logs = views.log_events(spark, folder).select("event_id", "ts", "status", "props", daily_index().alias("_index"))
    batched = bulk.in_batches(logs, ["_index"], ["ts", "event_id"], rows_per_chunk=rows_per_chunk)
    # Some ids do not start with a position: such rejects can only be reported.
    prefix = F.when((F.col("status") == 429) & (F.col("event_id") % 2 == 0), F.lit("x")).otherwise(F.col("pos").cast("string"))
    return batched.withColumns({
        "doc_id": F.concat(prefix, F.lit("_"), F.md5(F.col("event_id").cast("string"))),
        "doc": F.col("props"),
        "action": bulk.action_line("index", F.col("_index")),
    })


def documents_of(spark: SparkSession, folder: str, options: DocumentOptions = DocumentOptions()) -> DataFrame:
    events = views.with_payload(views.log_events(spark, folder, heavy=True))
    return document.with_document(events, options)


# Sources


def _catalog(spark: SparkSession, folder: str) -> DataFrame:
    return views.file_sizes(views.buffer_lines(views.log_events(spark, folder)))


@query
def buffer_file_catalog(spark, folder):
    files = buffer.listed(views.with_decoys(_catalog(spark, folder)), "buf")
    return buffer.ranked(files).select("file_name", "file_date", "seq", "size_bytes", "n_lines", "rank")


def _offsets(spark, folder, *extra, rows_per_chunk=ROWS_PER_CHUNK):
    lines = views.buffer_lines(views.log_events(spark, folder).select("event_id", "ts", "props", *extra))
    return buffer.with_offsets(lines, ["file_name"], ["event_id"], chunk=plan_chunks(lines, ["event_id"], rows_per_chunk))


@query
def buffer_line_offsets(spark, folder):
    return _offsets(spark, folder).select("file_name", "event_id", "start_offset", "next_offset")


@query
def buffer_line_offsets_ranged(spark, folder):
    return _offsets(spark, folder, rows_per_chunk=FEW_ROWS).select("file_name", "event_id", "start_offset", "next_offset")


@query
def stream_ship_counts(spark, folder):
    lines = views.buffer_lines(views.log_events(spark, folder))
    path = new_folder(spark, "buffer")
    lines.select("file_name", F.col("line").alias("value")).hint("rebalance", "file_name").write.partitionBy("file_name").text(path)
    out = new_folder(spark, "shipped")
    name = F.regexp_extract("file_path", r"file_name=([^/]+)/", 1)
    jobs.drained(jobs.ship(
        jobs.buffer_stream(spark, path, max_files=64),
        lambda batch: batch.groupBy(name.alias("file_name")).agg(
            F.count(F.lit(1)).alias("n_lines"), F.sum(F.octet_length("line")).alias("n_bytes")),
        out, new_folder(spark, "checkpoint")))
    shipped = spark.read.parquet(out)
    return shipped.groupBy("file_name").agg(F.sum("n_lines").alias("n_lines"), F.sum("n_bytes").alias("n_bytes"))


@query
def resume_from_bookmark(spark, folder):
    source = F.concat(F.lit("t"), (F.col("user_id") % 5).cast("string")).alias("source")
    logs = views.log_events(spark, folder)
    lines = logs.select(source, views.buffer_file_name().alias("file_name"), "event_id", F.col("props").alias("line"))
    catalog = buffer.listed(lines.groupBy("source", "file_name").agg(F.count(F.lit(1)).alias("n_lines")), "buf")
    placed = buffer.with_offsets(lines, ["source", "file_name"], ["event_id"], chunk=plan_chunks(lines, ["event_id"]))
    marks = spark.sql(
        "SELECT * FROM VALUES ('t0', '120:::buf-20240105.json'), ('t1', '7:::buf-19990101.json'),"
        " ('t2', 'no bookmark'), ('t3', '0:::buf-20240120_001.json') AS t(source, bookmark)")
    resumed = buffer.resumed(buffer.listed(placed, "buf"), catalog, marks)
    return resumed.select("source", "file_name", "event_id", "start_offset")


@query
def read_index_pattern(spark, folder):
    path = new_folder(spark, "documents")
    logs = views.log_events(spark, folder)
    store.write_documents(logs.select("event_id", "level", daily_index().alias("_index")), path)
    aliases = {"mid-month": ["logstash-2024.01.1*"]}
    found = store.read_documents(spark, path, "mid-month", aliases)
    return found.groupBy("_index", "level").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum"))


# Filters


@query
def filter_min_level(spark, folder):
    logs = views.log_events(spark, folder, "Information")
    return filters.at_least(logs, "Information").select("event_id", "level", "level_rank")


@query
def filter_level_switch_asof(spark, folder):
    logs = views.log_events(spark, folder).select("event_id", "ts", "level_rank")
    return filters.at_least_switched(logs, views.level_control(spark)).select("event_id", "level_rank")


@query
def drop_oversized(spark, folder):
    logs = views.log_events(spark, folder)
    return logs.select(
        "event_id", F.octet_length("props").alias("n_bytes"), filters.fits(F.col("props"), 9).alias("kept"))


@query
def admission_limit(spark, folder):
    logs = views.log_events(spark, folder).select("event_id", "ts", F.date_format("ts", "yyyy-MM-dd HH").alias("bucket"))
    return filters.admitted(logs, "bucket", ["ts", "event_id"], 10).select("event_id", "bucket")


@query
def admission_limit_ranged(spark, folder):
    logs = views.log_events(spark, folder).select("event_id", "ts", F.date_format("ts", "yyyy-MM-dd HH").alias("bucket"))
    return filters.admitted(logs, "bucket", ["ts", "event_id"], 10, FEW_ROWS).select("event_id", "bucket")


@query
def admission_counts(spark, folder):
    logs = views.log_events(spark, folder).select(F.date_format("ts", "yyyy-MM-dd HH").alias("bucket"))
    return filters.admission_counts(logs, "bucket", 10)


# Documents


@query
def document_envelope(spark, folder):
    events = views.with_payload(views.log_events(spark, folder, heavy=True))
    return document.with_message(events).select("event_id", *document.envelope(
        F.col("ts"), F.col("offset_minutes"), F.col("level"), F.col("message_template"), F.col("message")))


@query
def document_no_message(spark, folder):
    options = DocumentOptions(render_message=False, render_template=False)
    return documents_of(spark, folder, options).select("event_id", "doc")


@query
def document_inline_fields(spark, folder):
    return documents_of(spark, folder, DocumentOptions(inline_fields=True)).select("event_id", "doc")


@query
def document_delimited(spark, folder):
    events = views.with_payload(views.log_events(spark, folder, heavy=True))
    common = template.common_templates(events)
    bare = DocumentOptions(render_message=False, omit_enclosing_object=True)
    ended = DocumentOptions(render_message=False, closing_delimiter=";\n")
    return events.select(
        "event_id", document.event_document(bare, common).alias("members"),
        document.event_document(ended, common).alias("delimited"))


@query
def document_structured_fields(spark, folder):
    """Structures with their type tag first, sequences, and dictionaries with quoted keys, in the document's fields."""
    logs = views.with_structures(views.log_events(spark, folder))
    events = logs.withColumns({"message_template": F.lit("plain"), "properties": structured_fields(logs, ["User", "Steps", "Seats"]), "exceptions": views.exception_chain(F.lit(0))})
    options = DocumentOptions(render_message=False, render_template=False, omit_enclosing_object=True)
    return document.with_document(events, options).select("event_id", F.regexp_extract("doc", r'("fields":.*)$', 1).alias("fields"))


@query
def document_custom_formatter(spark, folder):
    """Documents of a caller's own formatter, and the events for which it gives no valid JSON."""
    logs = views.log_events(spark, folder).select("event_id", "level", "props")
    fields = F.when(F.col("event_id") % 10 == 3, F.lit("{broken")).otherwise(F.col("props"))
    made, broken = document.custom_document(
        logs, lambda rows: F.concat(F.lit('{"severity":"'), F.col("level"), F.lit('","body":'), fields, F.lit("}")))
    return made.select("event_id", "doc").unionAll(broken.select("event_id", F.lit(None).cast("string").alias("doc")))


@query
def build_document(spark, folder):
    return documents_of(spark, folder).select("event_id", "doc")


@query
def documents_read_back(spark, folder):
    path = new_folder(spark, "documents")
    docs = documents_of(spark, folder).select("event_id", daily_index().alias("_index"), "doc")
    store.write_documents(docs, path)
    found = store.typed(store.read_documents(spark, path, "logstash-*"))
    return found.select(
        "event_id", F.unix_micros("`@timestamp`").alias("micros"), "level", "message",
        F.coalesce(F.size("exceptions"), F.lit(0)).alias("n_exceptions"))


@query
def document_renderings(spark, folder):
    events = views.with_payload(views.log_events(spark, folder, heavy=True))
    return document.with_message(events).select("event_id", "renderings")


@query
def render_message(spark, folder):
    events = views.with_payload(views.log_events(spark, folder, heavy=True))
    return document.with_message(events).select("event_id", "message")


@query
def render_precise_numbers(spark, folder):
    """Numbers with more digits than their format shows are rounded once."""
    text = F.concat((F.col("value") / 7).cast("decimal(30,17)").cast("string"), F.lit("49"))
    formats = ("0.00", "000.000", "0.000000000000", "F4")
    return views.log_events(spark, folder).select(
        "event_id", *(template.formatted_number(text, F.lit(f)).alias(f"n{i}") for i, f in enumerate(formats)),
        template.formatted_number(F.lit("2.67499999999999"), F.lit("0.00")).alias("half"))


@query
def template_token_usage(spark, folder):
    per_template = views.log_events(spark, folder).groupBy("message_template").agg(F.count(F.lit(1)).alias("events"))
    used = per_template.select("events", F.explode(template.holes(F.col("message_template"))).alias("token"))
    return used.groupBy("token").agg(F.sum("events").alias("n"))


# Routing


@query
def route_index_daily(spark, folder):
    return views.log_events(spark, folder).select("event_id", routing.index_name(
        F.col("ts"), "DailyIndex-{0:yyyy.MM.dd}-MyCompany").alias("index"))


@query
def route_index_by_level(spark, folder):
    decider = F.concat(F.lit("logstash-"), F.col("level"), F.lit("-"), F.date_format("ts", "yyyy.MM.dd"))
    logs = views.log_events(spark, folder)
    return logs.select("event_id", routing.decided_index(F.col("ts"), decider=decider).alias("index"))


@query
def route_index_by_file_date(spark, folder):
    lines = views.buffer_lines(views.log_events(spark, folder))
    return lines.select("event_id", "file_name", routing.buffered_index(F.col("file_name")).alias("index"))


@query
def durable_rejects(spark, folder):
    """Lines of files without a date have no index: they are set aside with a reason, the others become requests."""
    logs = views.log_events(spark, folder).select(
        F.when(F.col("event_id") % 50 == 0, "junk.txt").when(F.col("event_id") % 50 == 1, "buf-2024x101.json")
        .otherwise(views.buffer_file_name()).alias("file_name"), "event_id", F.col("props").alias("line"))
    placed = buffer.with_offsets(logs, ["file_name"], ["event_id"])
    sent = indexing.durable_requests(placed).groupBy("_index").agg(F.count(F.lit(1)).alias("n"))
    rejected = indexing.undated_lines(placed).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return sent.select(F.lit("sent").alias("kind"), F.col("_index").alias("detail"), "n").unionAll(
        rejected.select(F.lit("rejected").alias("kind"), F.col("reason").alias("detail"), "n"))


def _targeted(spark, folder):
    return views.log_events(spark, folder).select(
        "event_id", "ts", F.concat(F.lit("t"), (F.col("user_id") % 5).cast("string")).alias("target"))


@query
def route_dead_letter(spark, folder):
    options = RouteOptions(dead_letter_format="DeadLetter-{0:yyyy.MM.dd}")
    routed = routing.route_to_targets(_targeted(spark, folder), views.targets(spark), options)
    return routed.sent.select("event_id", "target", "index")


@query
def direct_end_to_end(spark, folder):
    """Requests of several destinations: dead letters, document types, and the events of a failed sink."""
    logs = views.log_events(spark, folder).withColumn("target", F.concat(F.lit("t"), (F.col("user_id") % 5).cast("string")))
    options = RouteOptions(dead_letter_format="DeadLetter-{0:yyyy.MM.dd}")
    routed = indexing.requests_by_target(views.with_payload(logs), views.targets(spark), "Information", options)
    sent = routed.sent.groupBy("target", "_index", F.get_json_object("action", "$.index._type").alias("doc_type")).agg(
        F.count(F.lit(1)).alias("n"), F.max("pos").alias("last_pos"), F.count_distinct("batch_id").alias("batches"))
    unsent = routed.failed.groupBy("target").agg(F.count(F.lit(1)).alias("n"))
    return sent.select("target", F.col("_index").alias("index"), "doc_type", "n", "last_pos", "batches").unionByName(
        unsent, allowMissingColumns=True)


@query
def route_pipeline(spark, folder):
    decider = F.when(F.col("level") == "Fatal", "alerts").when(F.col("level") == "Verbose", " ")
    return views.log_events(spark, folder).select("event_id", routing.pipeline_name("main", decider).alias("pipeline"))


@query
def resolve_type_name(spark, folder):
    joined = _targeted(spark, folder).join(views.targets(spark), "target")
    return joined.groupBy("target", routing.type_name(F.col("version"), F.col("type_name")).alias("resolved_type")).agg(
        F.count(F.lit(1)).alias("n"))


TEMPLATES = (
    routing.IndexTemplate("a", "logstash-*", 1),
    routing.IndexTemplate("b", "logstash-2024.01.1*", 2),
    routing.IndexTemplate("c", "dailyindex-*-mycompany", 1),
)


@query
def match_index_template(spark, folder):
    indices = views.log_events(spark, folder).groupBy(daily_index().alias("index")).agg(F.count(F.lit(1)).alias("n"))
    wildcard = times.wildcard_of(F.lit("dailyindex-{0:yyyy.MM.dd}-mycompany"))
    return indices.select("index", "n", routing.best_template(F.col("index"), TEMPLATES).alias("template"),
                          wildcard.alias("daily_pattern"))


# Bulk requests


@query
def bulk_action_lines(spark, folder):
    joined = _targeted(spark, folder).join(views.targets(spark), "target")
    kind = routing.type_name(F.col("version"), F.col("type_name"))
    pipeline = F.when(F.col("target") == "t0", "my-pipeline").when(F.col("target") == "t1", " ")
    indexed = routing.index_name(F.col("ts"))
    return joined.select(
        "event_id",
        bulk.action_line("index", indexed, kind, pipeline).alias("index_action"),
        bulk.action_line("create", indexed, kind, pipeline, F.col("event_id").cast("string")).alias("create_action"))


@query
def bulk_payload_lines(spark, folder):
    logs = views.log_events(spark, folder)
    action = bulk.action_line("index", daily_index())
    return logs.select("event_id", F.posexplode(F.split(bulk.request_lines(action, F.col("props")), "\n")).alias("line_no", "line"))


@query
def bulk_batches(spark, folder):
    return batched_events(spark, folder).groupBy("batch_id", F.col("_index").alias("index")).agg(
        F.count(F.lit(1)).alias("n"), F.max("pos").alias("last_pos"), F.sum("event_id").alias("id_sum"))


@query
def bulk_batches_ranged(spark, folder):
    return batched_events(spark, folder, FEW_ROWS).groupBy("batch_id", F.col("_index").alias("index")).agg(
        F.count(F.lit(1)).alias("n"), F.max("pos").alias("last_pos"), F.sum("event_id").alias("id_sum"))


@query
def bulk_durable_ids(spark, folder):
    lines = _offsets(spark, folder)
    batched = bulk.in_batches(lines, ["file_name"], ["event_id"])
    return batched.select("event_id", bulk.durable_id(F.col("pos"), F.col("file_name"), F.col("start_offset")).alias("doc_id"))


@query
def bulk_request_bodies(spark, folder):
    rows = batched_events(spark, folder).withColumn("lines", bulk.request_lines(F.col("action"), F.col("doc")))
    return bulk.request_bodies(rows).select(
        "batch_id", "n_events", F.octet_length("body").alias("n_bytes"), F.md5("body").alias("digest"))


def _store(spark, folder):
    return views.table(spark, folder, "supplier").select(F.col("s_suppkey").alias("doc_id"), F.col("s_name").alias("payload"))


def _writes(spark, folder):
    return views.log_events(spark, folder).select(
        F.col("user_id").alias("doc_id"), F.col("props").alias("payload"), "ts", "event_id")


@query
def bulk_apply_index(spark, folder):
    return bulk.apply_index(_store(spark, folder), _writes(spark, folder), "doc_id", ["ts", "event_id"])


@query
def bulk_apply_create(spark, folder):
    return bulk.apply_create(_store(spark, folder), _writes(spark, folder), "doc_id", ["ts", "event_id"])


@query
def bulk_create_conflicts(spark, folder):
    return bulk.create_conflicts(
        _store(spark, folder), _writes(spark, folder), "doc_id", "event_id", ["ts", "event_id"]).select("event_id", "doc_id")


@query
def sink_round_trip(spark, folder):
    docs = documents_of(spark, folder, DocumentOptions(render_message=False)).select(
        "event_id", daily_index().alias("_index"), "doc")
    path = new_folder(spark, "documents")
    store.write_documents(docs, path)
    return store.read_documents(spark, path).groupBy(F.col("_index").alias("index")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum"), F.sum(F.length("doc")).alias("n_chars"))


# Delivery results


def _stub_requests(spark, folder):
    logs = views.with_payload(views.log_events(spark, folder, heavy=True)).withColumn("_index", daily_index())
    batched = bulk.in_batches(logs, ["_index"], ["ts", "event_id"])
    docs = document.with_document(
        batched, DocumentOptions(render_message=False, render_template=False), common=template.common_templates(logs))
    doc_id = F.concat(F.col("pos").cast("string"), F.lit("_"), F.md5(F.col("event_id").cast("string")))
    return docs.withColumn("action", bulk.action_line("index", F.col("_index"), doc_id=doc_id)).select(
        "batch_id", "pos", "event_id", "action", "doc")


@query
def deliver_with_stub(spark, folder):
    outcome = shipping.ship_direct_rows(_stub_requests(spark, folder), RuleClient)
    items = delivery.response_items(outcome.responses, only_errors=False)
    return items.select("batch_id", "pos", "status")


@query
def parse_bulk_response(spark, folder):
    answers = delivery.parsed(views.bulk_responses(batched_events(spark, folder)))
    bad = F.filter("items", lambda i: i["index"]["error"].isNotNull())
    return answers.select("batch_id", "errors", F.size("items").alias("n_items"), F.size(bad).alias("n_failed"))


@query
def correlate_by_position(spark, folder):
    events = batched_events(spark, folder)
    answers = delivery.parsed(views.bulk_responses(events))
    failed = delivery.failures_by_position(events.select("batch_id", "pos", "event_id"), answers)
    return failed.select("event_id", "batch_id", "pos", "status", F.col("error.type").alias("error_type"))


@query
def correlate_by_id_prefix(spark, folder):
    events = batched_events(spark, folder)
    answers = delivery.parsed(views.bulk_responses(events))
    failed = delivery.failures_by_id(events.select("batch_id", "pos", "event_id"), answers)
    return failed.select("batch_id", "_id", "event_id", "status", "error_text")


@query
def route_failures(spark, folder):
    events = batched_events(spark, folder)
    answers = delivery.parsed(views.bulk_responses(events))
    failed = delivery.failures_by_position(events.select("batch_id", "pos", "event_id"), answers)
    flags = delivery.WRITE_TO_SELF_LOG | delivery.WRITE_TO_FAILURE_SINK | delivery.THROW_EXCEPTION
    routes = [rows.select(F.lit(name).alias("route"), "event_id", "status")
              for name, rows in delivery.failure_routes(failed, flags).items()]
    return routes[0].unionByName(routes[1])


@query
def handle_failed_batches(spark, folder):
    """Handlers get the failed items and every event of a request that failed as a whole; one handler fails itself, and delivery is stopped last."""
    events = batched_events(spark, folder)
    lost = F.split("batch_id", "#")[1].cast("int") % 7 == 3
    answers = views.bulk_responses(events).withColumns({
        "success": ~lost, "http_status": F.when(lost, 503).otherwise(F.col("http_status")), "response": F.when(~lost, F.col("response"))})
    answers = written(delivery.parsed(answers), "answers")
    rows = events.select("batch_id", "pos", "event_id")
    items = delivery.failures_by_position(rows, answers).select("event_id", "status")
    batches = delivery.whole_batch_failures(rows, answers).select("event_id", F.col("http_status").alias("status"))
    folders = {name: new_folder(spark, name) for name in ("self_log", "failure_sink")}

    def refuses(failed):
        raise ValueError("no room")

    def logs(failed):
        if "message" in failed.columns:
            failed = failed.select(F.lit(-1).cast("bigint").alias("event_id"), F.lit(0).alias("status"))
        failed.select("event_id", F.col("status").cast("int").alias("status")).write.mode("append").parquet(folders["self_log"])

    flags = delivery.WRITE_TO_SELF_LOG | delivery.WRITE_TO_FAILURE_SINK | delivery.RAISE_CALLBACK | delivery.THROW_EXCEPTION
    stopped = False
    try:
        delivery.handle_failures(items, batches, flags, {
            "self_log": logs, "callback": refuses,
            "failure_sink": lambda failed: failed.select("event_id", F.col("status").cast("int").alias("status")).write.parquet(folders["failure_sink"])})
    except delivery.DeliveryFailed:
        stopped = True
    routes = [spark.read.parquet(path).select(F.lit(name).alias("route"), "event_id", "status", F.lit(stopped).alias("stopped"))
              for name, path in folders.items()]
    return routes[0].unionAll(routes[1])


@query
def clean_and_resend(spark, folder):
    outcome = shipping.ship_durable_rows(
        _stub_requests(spark, folder), RuleClient,
        cleaner=lambda row, status, error: F.regexp_replace(row, r'"k":"s(\d+)"', r'"k":$1'))
    still = delivery.failed_items(outcome.resent).select("batch_id", "pos", F.col("status").alias("second"))
    return outcome.item_failures.join(still, ["batch_id", "pos"], "left").select(
        "event_id", F.col("status").alias("first_status"), F.coalesce("second", F.lit(201)).alias("second_status"))


@query
def invalid_payload_dump(spark, folder):
    events = batched_events(spark, folder)
    answers = delivery.parsed(views.bulk_responses(events))
    failed = delivery.failures_by_id(events.select("batch_id", "pos", "event_id", "action", "doc"), answers)
    return delivery.dump_rows(failed)


@query
def retry_schedule(spark, folder):
    runs = delivery.failure_runs(views.attempts(spark, folder), "target", ["ts", "attempt_no"])
    return runs.select("target", "attempt_no", "failures_in_a_row",
                       delivery.retry_delay(F.col("failures_in_a_row"), 2).alias("delay_seconds"))


@query
def retry_schedule_ranged(spark, folder):
    runs = delivery.failure_runs(views.attempts(spark, folder), "target", ["ts", "attempt_no"], rows_per_chunk=FEW_ROWS)
    return runs.select("target", "attempt_no", "failures_in_a_row",
                       delivery.retry_delay(F.col("failures_in_a_row"), 2).alias("delay_seconds"))


@query
def committed_position(spark, folder):
    logs = views.log_events(spark, folder)
    lines = logs.select(views.buffer_file_name().alias("file_name"), "event_id", "status", F.col("props").alias("line"))
    placed = buffer.with_offsets(lines, ["file_name"], ["event_id"], chunk=plan_chunks(lines, ["event_id"]))
    # Every line is a batch. A busy store (429) takes it at the second try, but for odd events: there the shipper is stuck.
    stuck = (F.col("status") == 429) & (F.col("event_id") % 2 == 1)
    stops = placed.where(stuck).groupBy("file_name").agg(F.min("event_id").alias("stop"))
    sent = placed.join(stops, "file_name", "left").where(F.col("stop").isNull() | (F.col("event_id") <= F.col("stop")))
    first = F.struct((2 * F.col("event_id")).alias("attempt_no"), (F.col("status") != 429).alias("success"))
    second = F.struct((2 * F.col("event_id") + 1).alias("attempt_no"), (~stuck).alias("success"))
    tries = sent.select(F.col("file_name").alias("file"), "next_offset", F.inline(
        F.when(F.col("status") == 429, F.array(first, second)).otherwise(F.array(first))))
    return delivery.committed_positions(tries)


@query
def diagnostics_summary(spark, folder):
    logs = views.log_events(spark, folder)
    _, dropped = filters.split_by_size(logs, "props", 9)
    rejected = logs.filter(F.col("status") >= delivery.FIRST_FAILED_STATUS)
    unsent = routing.route_to_targets(_targeted(spark, folder), views.targets(spark)).failed
    rows = delivery.diagnostics(
        ("oversized", dropped, F.octet_length("props")), ("rejected", rejected, F.col("status")),
        ("not sent", unsent, F.col("target")))
    return rows.groupBy("kind", "detail").agg(F.count(F.lit(1)).alias("n"))


# Retention


def _daily_files(spark, folder):
    return buffer.listed(_catalog(spark, folder), "buf")


@query
def retention_by_size(spark, folder):
    kept = retention.keep_by_size(_daily_files(spark, folder), 50_000, "file_date", [F.col("seq").desc()])
    return kept.select("file_name", "rank", "running_bytes", "keep")


@query
def retention_invalid_payloads(spark, folder):
    logs = views.log_events(spark, folder).filter(F.col("status") >= delivery.FIRST_FAILED_STATUS)
    dumps = logs.groupBy(F.date_format("ts", "yyyyMMdd").alias("day"), "status").agg(
        F.sum(F.octet_length("props")).alias("size_bytes"), F.max("ts").alias("modified"))
    kept = retention.keep_dumps(dumps, 1_000, 200, "day", [F.col("modified").desc()])
    return kept.select("day", "status", "rank", "running_bytes", "keep")


@query
def retention_by_count(spark, folder):
    kept = retention.keep_by_count(_daily_files(spark, folder), "file_date", [F.col("seq").desc()])
    return kept.select("file_name", "rank", "keep")


@query
def evict_shipped_files(spark, folder):
    logs = views.log_events(spark, folder)
    lines = logs.select("event_id", "event_type", views.buffer_file_name().alias("file_name"), F.col("props").alias("line"))
    day = F.regexp_extract("file_name", r"-(\d{8})", 1)
    # One source per day with two files, and one per event type with many.
    rows = lines.select("file_name", "line", F.explode(F.array(day, "event_type")).alias("source"))
    files = rows.groupBy("source", "file_name").agg(F.sum(F.octet_length("line") + 1).alias("size_bytes")).select(
        "source", "file_name", "size_bytes", F.col("file_name").alias("file_rank"))
    ends = files.groupBy("source").agg(*(pick(F.struct("file_name", "size_bytes")).alias(name) for name, pick in (("first", F.min), ("last", F.max))))
    name = F.col("source")
    # Where each source stands: days at the start or the end of their first file, some types further on, or in a file that is gone.
    marks = ends.filter(~name.isin("view")).select(
        "source",
        F.when(name == "error", "gone.json").when(name == "signup", F.col("last.file_name")).otherwise(F.col("first.file_name")).alias("bookmark_file"),
        F.when(name.rlike("^2") & (name.try_cast("bigint") % 3 == 0), 0).when(name == "purchase", 5).when(name == "signup", F.col("last.size_bytes"))
        .otherwise(F.col("first.size_bytes")).alias("next_offset"))
    return retention.evictions(files, marks)


@query
def rolling_buckets(spark, folder):
    logs = views.log_events(spark, folder)
    kinds = [F.struct(F.lit(kind).alias("interval"), retention.rolling_bucket(F.col("ts"), kind).alias("bucket"))
             for kind in ("Day", "Hour", "Minute")]
    return logs.select(F.inline(F.array(*kinds))).groupBy("interval", "bucket").agg(F.count(F.lit(1)).alias("n"))


@query
def rolling_size_sequence(spark, folder):
    lines = views.log_events(spark, folder).select(
        retention.rolling_bucket(F.col("ts")).alias("bucket"), "event_id", F.octet_length("props").alias("n_bytes"))
    return rolling.rolling_sequences(lines, ["bucket"], ["event_id"], "n_bytes", 500).select("bucket", "event_id", "sequence")


# Mappings


def _fields(spark, folder):
    logs = views.log_events(spark, folder).select("event_id", "ts", daily_index().alias("index"), "props")
    return mapping.field_values(logs, "props", ["event_id", "ts", "index"], "fields")


@query
def infer_field_types(spark, folder):
    return mapping.inventory(_fields(spark, folder))


@query
def infer_deep_fields(spark, folder):
    """Properties three and ten levels deep, and one that changes its type at the bottom."""
    logs = views.log_events(spark, folder).select("event_id", views.deep_properties().alias("body"))
    return mapping.inventory(mapping.field_values(logs, "body", ["event_id"], "fields"))


@query
def first_mapping_wins(spark, folder):
    return mapping.first_mappings(_fields(spark, folder), ["ts", "event_id"])


@query
def mapping_conflicts(spark, folder):
    found = mapping.conflicts(_fields(spark, folder), ["ts", "event_id"])
    return found.select("event_id", "index", "path", "type", "mapped_type")


@query
def mapping_conflicts_ranged(spark, folder):
    """As without a broadcast: keys cut into slices."""
    found = mapping.conflicts(_fields(spark, folder), ["ts", "event_id"], max_broadcast_rows=0)
    return found.select("event_id", "index", "path", "type", "mapped_type")


@query
def filter_level_switch_asof_ranged(spark, folder):
    """As with many switches."""
    logs = views.log_events(spark, folder).select("event_id", "ts", "level_rank")
    return filters.at_least_switched(logs, views.level_control(spark), literal_switches=0, rows_per_chunk=FEW_ROWS).select("event_id", "level_rank")


@query
def resolve_dynamic_mapping(spark, folder):
    # Third-party events carry positional names: fields.0, fields.1, ...
    named = views.log_events(spark, folder).select(
        F.concat(F.lit("fields."), (F.col("user_id") % 15).cast("string")).alias("path"), F.lit("long").alias("type"))
    found = mapping.inventory(_fields(spark, folder).select("path", "type").unionByName(named))
    return found.withColumn("_m", mapping.dynamic_mapping(F.col("path"), F.col("type"))).select(
        "path", "type", "n", F.col("_m.rule").alias("rule"), F.col("_m.type").alias("mapped_type"),
        F.col("_m.raw_limit").alias("raw_limit"))


@query
def resolve_caller_mapping(spark, folder):
    """A caller's own rules, in their order, instead of the default ones."""
    rules = (mapping.DynamicRule("words", "keyword", value_type="string", raw_limit=10), mapping.DynamicRule("k", "double", path_regex=r"^fields\.k$"))
    found = mapping.inventory(_fields(spark, folder))
    return found.withColumn("_m", mapping.dynamic_mapping(F.col("path"), F.col("type"), rules)).select(
        "path", "type", "n", F.col("_m.rule").alias("rule"), F.col("_m.type").alias("mapped_type"), F.col("_m.raw_limit").alias("raw_limit"))


@query
def apply_explicit_mapping(spark, folder):
    logs = views.log_events(spark, folder)
    # Some documents carry a result code that is no number.
    code = F.when(F.col("event_id") % 7 == 0, F.lit('"x"')).otherwise((-F.col("event_id")).cast("string"))
    body = F.concat(
        F.lit('{"message":'), string_json(F.col("message_template")), F.lit(',"exceptions":[{"Depth":0,"HResult":'), code, F.lit("}]}"))
    mapped = logs.select("event_id", mapping.explicit_mapping(body).alias("m"))
    return mapped.select(
        "event_id", F.col("m.message").alias("message"), F.col("m.fits").alias("fits"),
        F.get("m.exceptions", F.lit(0))["HResult"].alias("hresult"))


@query
def raw_keyword_field(spark, folder):
    return views.table(spark, folder, "documents").select("doc_id", mapping.raw_keyword(F.col("text")).alias("raw"))


@query
def field_count_limit(spark, folder):
    logs = views.log_events(spark, folder).select(
        daily_index().alias("index"), F.concat(F.lit("fields.u"), F.col("user_id").cast("string")).alias("path"))
    return mapping.field_counts(logs, 120)


# Aggregations


@query
def count_by_index(spark, folder):
    return flagship(spark, folder)


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Events from Information up, counted per daily index."""
    logs = views.log_events(spark, folder, "Information").select(daily_index().alias("index"))
    return store.counts(logs, "index")


# Exceptions


def _chains(spark, folder):
    logs = views.log_events(spark, folder, heavy=True).filter("event_type = 'error'")
    return logs.select("event_id", views.exception_chain(F.col("chain_len")).alias("exceptions"))


@query
def flatten_exceptions(spark, folder):
    links = views.exception_links(views.log_events(spark, folder))
    return exceptions.depths_from_links(links).select("event_id", "exc_id", "depth", "class_name", "message")


@query
def nest_exceptions(spark, folder):
    return _chains(spark, folder).select("event_id", exceptions.nested_json(F.col("exceptions")).alias("exception"))


@query
def exception_fields(spark, folder):
    rows = _chains(spark, folder).select("event_id", F.explode(exceptions.flattened(F.col("exceptions"))).alias("e"))
    return rows.select("event_id", F.col("e.Depth").alias("depth"),
                       exceptions.exception_json(F.col("e"), F.col("e.Depth"), F.col("e.ExceptionMethod")).alias("json"))


@query
def stack_trace_lines(spark, folder):
    rows = exceptions.exceptions_table(_chains(spark, folder), ["event_id"])
    lines = exceptions.stack_lines(F.col("StackTraceString"))
    return rows.select("event_id", F.col("Depth").alias("depth"), F.to_json(lines).alias("stack_trace"))


@query
def exceptions_by_method(spark, folder):
    rows = exceptions.exceptions_table(_chains(spark, folder), ["event_id"]).filter("ExceptionMethod IS NOT NULL")
    return rows.groupBy(
        F.col("ExceptionMethod.AssemblyName").alias("assembly"), F.col("ExceptionMethod.AssemblyVersion").alias("version"),
        F.col("ExceptionMethod.Name").alias("method"), F.col("ExceptionMethod.MemberType").alias("member_type"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query
def exceptions_table(spark, folder):
    rows = exceptions.exceptions_table(_chains(spark, folder), ["event_id"])
    return rows.select("event_id", F.col("Depth").alias("depth"), F.col("ClassName").alias("class_name"),
                       F.col("Message").alias("message"), F.col("Source").alias("source"), F.col("HResult").alias("hresult"))


# Streams


def _per_index(rows):
    return rows.groupBy(daily_index().alias("index")).agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum"))


def _totals(shipped):
    return shipped.groupBy("index").agg(F.sum("n").alias("n"), F.sum("id_sum").alias("id_sum"))


@query
def stream_direct(spark, folder):
    out = new_folder(spark, "shipped")
    jobs.drained(jobs.ship(
        jobs.event_stream(spark, folder, "events"),
        lambda batch: _per_index(filters.at_least(views.log_columns(batch), "Information")),
        out, new_folder(spark, "checkpoint")))
    return _totals(spark.read.parquet(out))


@query
def stream_direct_requests(spark, folder):
    """Each micro-batch goes the whole way: documents, request batches, answers, and the events of failed items."""
    def shipped(batch):
        logs = views.with_payload(views.log_columns(views.spread(batch, "event_id")))
        rows = written(indexing.direct_requests(logs, "Information"), "requests")
        # The store answers with the status that each event carries.
        sent = rows.join(logs.select("event_id", "status"), "event_id").withColumn("doc_id", F.col("event_id").cast("string"))
        failed = delivery.failures_by_position(rows.select("batch_id", "pos"), delivery.parsed(views.bulk_responses(sent)))
        lost = failed.select("batch_id", "pos", F.lit(1).alias("failed"))
        return rows.join(lost, ["batch_id", "pos"], "left").select(
            F.col("_index").alias("index"), "event_id", F.coalesce("failed", F.lit(0)).alias("failed"),
            F.get_json_object("action", "$.index._index").alias("target"), F.get_json_object("doc", "$.level").alias("level"))

    out = new_folder(spark, "shipped")
    jobs.drained(jobs.ship(jobs.event_stream(spark, folder, "events"), shipped, out, new_folder(spark, "checkpoint")))
    return spark.read.parquet(out).where("index = target").groupBy("index", "level").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum"), F.sum("failed").alias("n_failed"))


@query
def stream_level_switch(spark, folder):
    """A threshold read anew for every micro-batch: a second stream over the same table meets another one."""
    out, current = new_folder(spark, "shipped"), {"minimum": "Error"}
    run = jobs.switched(lambda session: current["minimum"], lambda batch, minimum: filters.at_least(views.log_columns(batch), minimum).select(
        "event_id", "level", F.lit(minimum).alias("minimum")))
    for number, minimum in enumerate(("Error", "Debug")):
        current["minimum"] = minimum
        jobs.drained(jobs.ship(jobs.event_stream(spark, folder, "events"), run, f"{out}/run={number}", new_folder(spark, "checkpoint")))
    return spark.read.parquet(out).groupBy("minimum", "level").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum"))


@query
def stream_durable_restart(spark, folder):
    lines = views.buffer_lines(views.log_events(spark, folder)).select(
        "file_name", F.concat_ws("|", F.col("event_id").cast("string"), "line").alias("value"))
    path, out, checkpoint = new_folder(spark, "buffer"), new_folder(spark, "shipped"), new_folder(spark, "checkpoint")

    def shipped(batch):
        name = F.regexp_extract("file_path", r"file_name=([^/]+)/", 1)
        parts = F.split("line", r"\|", 2)
        return batch.select(F.get(parts, F.lit(0)).cast("bigint").alias("event_id"), routing.buffered_index(name).alias("index"))

    # The second run starts from the first one's checkpoint and sees only newer files.
    for late in (False, True):
        part = lines.filter(F.col("file_name").contains("_001") == F.lit(late))
        part.hint("rebalance", "file_name").write.mode("append").partitionBy("file_name").text(path)
        jobs.drained(jobs.ship(jobs.buffer_stream(spark, path, max_files=64), shipped, out, checkpoint))
    rows = spark.read.parquet(out)
    return rows.groupBy("index").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum"))


@query
def stream_late_events(spark, folder):
    out = new_folder(spark, "shipped")
    # Micro-batches hold events of any age; each goes to the index of its own time.
    jobs.drained(jobs.ship(
        jobs.event_stream(spark, folder, "events", max_files=1), lambda batch: _per_index(views.log_columns(batch)),
        out, new_folder(spark, "checkpoint")))
    return _totals(spark.read.parquet(out))
