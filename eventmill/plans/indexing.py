"""The whole way from events to requests, direct and durable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmill.functions.template import common_templates
from eventmill.operators.bulk import action_line, durable_id, in_batches, request_lines
from eventmill.operators.document import with_document
from eventmill.operators.filters import at_least, fits
from eventmill.operators.retention import check_shippable
from eventmill.operators.routing import Routed, buffered_index, decided_index, pipeline_name, route_to_targets, type_name
from eventmill.options import BatchOptions, DocumentOptions, RouteOptions, ShippingOptions
from eventmill.sources.buffer import stored_lines_with_offsets


def routed_events(
    events: DataFrame, minimum: str | None = None, routes: RouteOptions = RouteOptions(),
    index_decider: Column | None = None, pipeline_decider: Column | None = None,
) -> DataFrame:
    """Level filter, index and pipeline: narrow, so it stays with the scan."""
    return at_least(events, minimum).withColumns({
        "_index": decided_index(F.col("ts"), routes, index_decider),
        "pipeline": pipeline_name(routes.pipeline, pipeline_decider)})


def indexed_documents(
    events: DataFrame, minimum: str | None = None, routes: RouteOptions = RouteOptions(),
    documents: DocumentOptions = DocumentOptions(), index_decider: Column | None = None,
    pipeline_decider: Column | None = None,
) -> DataFrame:
    """Routed events with their documents: one pass over the scan, no shuffle."""
    return with_document(routed_events(events, minimum, routes, index_decider, pipeline_decider), documents)


def direct_requests(
    events: DataFrame, minimum: str | None = None, routes: RouteOptions = RouteOptions(),
    documents: DocumentOptions = DocumentOptions(), batches: BatchOptions = BatchOptions(),
    index_decider: Column | None = None, pipeline_decider: Column | None = None,
) -> DataFrame:
    """Batched request rows of direct mode: ``batch_id, pos, event_id, _index, action, doc``.

    Events are put into batches before their documents are built: the shuffle
    then carries the event, not the longer document.
    """
    routed = routed_events(events, minimum, routes, index_decider, pipeline_decider)
    common = common_templates(events)
    batched = in_batches(routed, ["_index"], ["ts", "event_id"], batches.posting_limit)
    return with_document(batched, documents, common=common).select(
        "batch_id", "pos", "event_id", "_index",
        action_line(batches.op, F.col("_index"), pipeline=F.col("pipeline")).alias("action"), "doc")


def requests_by_target(
    events: DataFrame, targets: DataFrame, minimum: str | None = None, routes: RouteOptions = RouteOptions(),
    documents: DocumentOptions = DocumentOptions(), batches: BatchOptions = BatchOptions(),
) -> Routed:
    """Request rows of direct mode for several destinations, with the index and the document type each of them takes.

    ``events`` have a ``target``; ``targets`` are few literal rows, see
    :func:`routing.route_to_targets`. ``failed`` holds the events that a failed
    sink does not send.
    """
    chosen = at_least(events, minimum)
    routed = route_to_targets(chosen, targets, routes)
    typed = routed.sent.withColumns({"_index": F.col("index"), "_type": type_name(F.col("version"), F.col("type_name"))})
    batched = in_batches(typed, ["target", "_index"], ["ts", "event_id"], batches.posting_limit)
    rows = with_document(batched, documents, common=common_templates(chosen)).select(
        "batch_id", "pos", "event_id", "target", "_index",
        action_line(batches.op, F.col("_index"), F.col("_type"), F.lit(routes.pipeline).cast("string")).alias("action"), "doc")
    return Routed(rows, routed.failed)


def stored_requests(
    spark: SparkSession, folder: str, base: str, routes: RouteOptions = RouteOptions(), batches: BatchOptions = BatchOptions(),
    shipping: ShippingOptions = ShippingOptions(),
) -> tuple[DataFrame, DataFrame]:
    """Durable mode over a folder of buffer files: request rows, and the lines that no index can be told for."""
    lines = stored_lines_with_offsets(spark, folder, base, shipping.assume_bom, shipping.newline)
    return durable_requests(lines, routes, batches, shipping), undated_lines(lines, routes, shipping)


def undated_lines(
    lines: DataFrame, routes: RouteOptions = RouteOptions(), shipping: ShippingOptions = ShippingOptions(), index_decider: Column | None = None,
) -> DataFrame:
    """Lines that no index can be told for, with a ``reason``: the rejects of :func:`durable_requests`."""
    index = _line_index(routes, shipping, index_decider)
    return lines.filter(index.isNull()).withColumn("reason", F.concat(F.lit("no date in file name "), F.col("file_name")))


def _line_index(routes: RouteOptions, shipping: ShippingOptions, index_decider: Column | None) -> Column:
    if index_decider is not None:
        return index_decider
    return buffered_index(F.col("file_name"), shipping.rolling_interval, routes.index_format)


def durable_requests(
    lines: DataFrame, routes: RouteOptions = RouteOptions(), batches: BatchOptions = BatchOptions(),
    shipping: ShippingOptions = ShippingOptions(), doc_type: Column | None = None, index_decider: Column | None = None,
) -> DataFrame:
    """Request rows of durable mode from ``lines(file_name, line, start_offset, next_offset)``.

    The index comes from the file's date, or from a decider over the file and
    the raw line; lines without one are left to :func:`undated_lines`. Lines
    over the size limit count for their batch but are not sent; positions are
    those among the lines sent.
    """
    check_shippable(shipping.rolling_interval)
    index = _line_index(routes, shipping, index_decider)
    batched = in_batches(lines.filter(index.isNotNull()), ["file_name"], ["start_offset"], batches.posting_limit)
    sized = batched
    if batches.event_bytes_limit is not None:
        in_batch = Window.partitionBy("file_name", "batch_no").orderBy("start_offset")
        sized = batched.filter(fits(F.col("line"), batches.event_bytes_limit)).withColumn(
            "pos", F.row_number().over(in_batch) - 1)
    doc_id = durable_id(F.col("pos"), F.col("file_name"), F.col("start_offset"))
    return sized.select(
        "batch_id", "pos", "file_name", "start_offset", "next_offset", index.alias("_index"), doc_id.alias("doc_id"),
        action_line(batches.op, index, doc_type, F.lit(routes.pipeline).cast("string"), doc_id).alias("action"),
        F.col("line").alias("doc"))


def requests(rows: DataFrame) -> DataFrame:
    """Request rows as text, ready for :func:`sources.store.write_requests`."""
    return rows.select("_index", request_lines(F.col("action"), F.col("doc")).alias("request"))
