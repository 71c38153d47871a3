"""Bulk requests: action lines, batches, bodies, and what a store makes of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.operators.routing import blank_to_null
from eventmill.operators.running import ROWS_PER_CHUNK, number_rows_at_scale
from eventmill.options import BATCH_POSTING_LIMIT
from eventmill.session import attach, written


def action_line(
    op: str,
    index: Column,
    type_name: Column | None = None,
    pipeline: Column | None = None,
    doc_id: Column | None = None,
) -> Column:
    """The action line; members without a value are left out, in this order."""
    absent = F.lit(None).cast("string")
    target = F.struct(
        (absent if type_name is None else type_name).alias("_type"),
        index.alias("_index"),
        (absent if pipeline is None else blank_to_null(pipeline)).alias("pipeline"),
        (absent if doc_id is None else doc_id).alias("_id"),
    )
    return F.to_json(F.struct(target.alias(op)))


def request_lines(action: Column, doc: Column) -> Column:
    """Action and document as adjacent lines of one text row."""
    return F.concat(action, F.lit("\n"), doc)


def in_batches(
    events: DataFrame,
    keys: list[str],
    order: list[str],
    limit: int = BATCH_POSTING_LIMIT,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Number events into full batches per ``keys``: adds ``batch_no``, ``pos`` and ``batch_id``.

    A busy index is numbered range by range, not in one task.
    """
    placed = number_rows_at_scale(events, keys, order, "_place", rows_per_chunk)
    at = F.col("_place") - 1
    batch = F.floor(at / limit).cast("bigint")
    return placed.withColumns({
        "batch_no": batch,
        "pos": (at % limit).cast("int"),
        "batch_id": F.concat_ws("#", *[F.col(key) for key in keys], batch.cast("string")),
    }).drop("_place")


def durable_id(pos: Column, file_name: Column, offset: Column) -> Column:
    """``<position>_<digest>``: found again after a reject, and the same when a line is replayed."""
    return F.concat(pos.cast("string"), F.lit("_"), F.md5(F.concat_ws(":", file_name, offset.cast("string"))))


def request_bodies(batched: DataFrame, lines: str = "lines") -> DataFrame:
    """One newline-terminated body per batch. A batch has at most its posting limit of rows."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", lines)))
    return batched.groupBy("batch_id").agg(ordered.alias("_rows")).select(
        "batch_id",
        F.size("_rows").alias("n_events"),
        F.concat(F.array_join(F.transform("_rows", lambda r: r[lines]), "\n"), F.lit("\n")).alias("body"))


def latest_per_id(events: DataFrame, doc_id: str, order: list[str], values: list[str]) -> DataFrame:
    """The last event per id, by partial aggregation: a hot id costs one row per task."""
    return events.groupBy(doc_id).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_v")).select(doc_id, "_v.*")


def first_per_id(events: DataFrame, doc_id: str, order: list[str], values: list[str]) -> DataFrame:
    """The first event per id."""
    return events.groupBy(doc_id).agg(F.min_by(F.struct(*values), F.struct(*order)).alias("_v")).select(doc_id, "_v.*")


def apply_index(store: DataFrame, events: DataFrame, doc_id: str, order: list[str]) -> DataFrame:
    """The store after ``index`` operations: created or replaced, the last event per id winning.

    Events are brought down to one per id first; the store is then passed
    through but for the ids they replace, which is a broadcast when they are few.
    """
    values = [name for name in store.columns if name != doc_id]
    new = written(latest_per_id(events, doc_id, order, values).select(store.columns), "latest")
    return attach(store, new.select(doc_id), [doc_id], "left_anti", null_safe=True, label="replaced").unionByName(new)


def apply_create(store: DataFrame, events: DataFrame, doc_id: str, order: list[str]) -> DataFrame:
    """The store after ``create`` operations: an id that exists is left alone, else its first event wins."""
    values = [name for name in store.columns if name != doc_id]
    added = first_per_id(events, doc_id, order, values).join(store.select(doc_id), doc_id, "left_anti")
    return store.unionByName(added.select(*store.columns))


def create_conflicts(store: DataFrame, events: DataFrame, doc_id: str, event_key: str, order: list[str]) -> DataFrame:
    """Events whose ``create`` fails: the id is stored already, or another event came first.

    Winners are one event per id and are removed by the unique event key, so no
    join runs on a hot id.
    """
    winners = first_per_id(events, doc_id, order, [event_key]).join(store.select(doc_id), doc_id, "left_anti")
    return events.join(winners.select(event_key), event_key, "left_anti")
