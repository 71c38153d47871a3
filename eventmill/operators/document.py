"""Events to JSON documents."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.functions.jsontext import fields_json, fields_members, member, object_json, string_json
from eventmill.functions.template import common_templates, message_texts
from eventmill.functions.times import iso_time
from eventmill.operators.exceptions import flat_json, nested_json
from eventmill.options import DocumentOptions

# Member names of the envelope and the properties' parent.
TIMESTAMP = "@timestamp"
LEVEL = "level"
MESSAGE_TEMPLATE = "messageTemplate"
MESSAGE = "message"
EXCEPTIONS = "exceptions"
EXCEPTION = "exception"
FIELDS = "fields"
RENDERINGS = "renderings"
ENVELOPE = (TIMESTAMP, LEVEL, MESSAGE_TEMPLATE, MESSAGE, EXCEPTIONS, EXCEPTION, RENDERINGS)


def envelope(ts: Column, offset_minutes: Column, level: Column, template: Column, message: Column) -> list[Column]:
    """The envelope as columns under their document names."""
    return [
        iso_time(ts, offset_minutes).alias(TIMESTAMP), level.alias(LEVEL),
        template.alias(MESSAGE_TEMPLATE), message.alias(MESSAGE),
    ]


def colliding_fields(properties: Column) -> Column:
    """Property names that an inlined document cannot carry beside its envelope."""
    return F.filter(F.map_keys(properties), lambda name: name.isin(*ENVELOPE))


def document(
    options: DocumentOptions,
    ts: Column,
    offset_minutes: Column,
    level: Column,
    template: Column,
    properties: Column,
    exceptions: Column | None = None,
    common: Sequence[str] = (),
) -> Column:
    """The whole document: time, level, template, message, exceptions, properties, renderings.

    ``properties`` is a ``map<name, JSON text>`` (see ``functions.jsontext``).
    Empty sections are left out. Inlined properties give way to envelope names.
    ``common`` names templates worth an expression of their own.
    """
    texts = message_texts(template, properties, common)
    parts = [member(TIMESTAMP, string_json(iso_time(ts, offset_minutes))), member(LEVEL, string_json(level))]
    if options.render_template:
        parts.append(member(MESSAGE_TEMPLATE, string_json(template)))
    if options.render_message:
        parts.append(member(MESSAGE, string_json(texts["message"])))
    if exceptions is not None:
        if options.exceptions_as_object:
            parts.append(member(EXCEPTION, nested_json(exceptions, options.stack_trace_as_array)))
        else:
            parts.append(member(EXCEPTIONS, flat_json(exceptions, options.stack_trace_as_array)))
    if options.inline_fields:
        free = F.map_filter(properties, lambda name, _: ~name.isin(*ENVELOPE))
        parts.append(fields_members(free))
    else:
        parts.append(member(FIELDS, fields_json(properties)))
    parts.append(member(RENDERINGS, texts["renderings"]))
    if options.omit_enclosing_object:
        return F.concat_ws(",", *parts)
    whole = object_json(*parts)
    return F.concat(whole, F.lit(options.closing_delimiter)) if options.closing_delimiter else whole


def event_document(options: DocumentOptions, common: Sequence[str] = ()) -> Column:
    """:func:`document` over the columns of an event table (see ``model.EVENT_COLUMNS``)."""
    return document(
        options, F.col("ts"), F.col("offset_minutes"), F.col("level"), F.col("message_template"),
        F.col("properties"), F.col("exceptions"), common)


def with_document(
    events: DataFrame, options: DocumentOptions = DocumentOptions(), out: str = "doc", common: Sequence[str] | None = None
) -> DataFrame:
    """Add the document; the property and exception columns are no longer needed after it.

    Give ``common`` when ``events`` is costly to read a few rows of.
    """
    if common is None:
        common = common_templates(events)
    return events.withColumn(out, event_document(options, common)).drop("properties", "exceptions")


def with_message(events: DataFrame, common: Sequence[str] | None = None) -> DataFrame:
    """Add ``message`` and ``renderings``, both from the template and the properties."""
    if common is None:
        common = common_templates(events)
    texts = message_texts(F.col("message_template"), F.col("properties"), common)
    return events.withColumn("_texts", texts).select("*", "_texts.message", "_texts.renderings").drop("_texts")


def custom_document(events: DataFrame, formatter: Callable[[DataFrame], Column], out: str = "doc") -> tuple[DataFrame, DataFrame]:
    """Documents of a caller's own formatter: those that are valid JSON, and the events whose are not."""
    made = events.withColumn(out, formatter(events)).withColumn("_valid", F.try_parse_json(out).isNotNull())
    return made.filter("_valid").drop("_valid"), made.filter(~F.coalesce("_valid", F.lit(False))).drop("_valid")
