"""A limit of events per bucket over all steps of a stream, and events that come again.

How many events a bucket has had is a value state with a time to live: buckets
that nothing comes for any more are forgotten. Before the state, each task lets at
most ``limit`` events of a bucket through, the first ones it has, since no more can
be admitted: a bucket with a third of all events sends its task a bounded number.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from eventmill.options import BatchOptions
from eventmill.streaming.durable import with_state


class Admission(StatefulProcessor):
    """Passes events of a bucket until it has had ``limit`` of them."""

    def __init__(self, limit: int, order: list[str], columns: list[str], keep_seconds: float):
        self.limit, self.order, self.columns, self.keep_ms = limit, order, columns, int(keep_seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.admitted = handle.getValueState("admitted", "n long", self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = self.admitted.get()[0] if self.admitted.exists() else 0
        left = self.limit - before
        first = None
        for frame in rows:  # only the first ones so far are held
            first = frame if first is None else pd.concat([first, frame])
            first = first.sort_values(self.order, kind="stable").head(max(left, 0))
        self.admitted.update((before + len(first),))
        if len(first):
            yield first[self.columns]

    def close(self) -> None:
        pass


def admitted_stream(events: DataFrame, bucket: str, order: list[str], batches: BatchOptions = BatchOptions(), keep_seconds: float = 86_400.0) -> DataFrame:
    """The first ``batches.queue_limit`` events of each bucket of a stream, as they arrive; within a step in ``order``. No limit admits all.

    A bucket is forgotten ``keep_seconds`` after its last event.
    """
    limit = batches.queue_limit
    if limit is None:
        return events
    with_state(events.sparkSession)
    columns = events.columns

    def local(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The first events of each bucket of a task, batch by batch. Those of a later batch may come before them, so each batch has its own."""
        for frame in frames:
            yield frame.sort_values(order, kind="stable").groupby(bucket, dropna=False, sort=False).head(limit)

    fewer = events.mapInPandas(local, events.schema)
    return fewer.groupBy(bucket).transformWithStateInPandas(
        Admission(limit, order, columns, keep_seconds), outputStructType=events.schema, outputMode="append", timeMode="processingTime")


def without_replays(rows: DataFrame, doc_id: str, ts: str, lateness: str) -> DataFrame:
    """Rows of a stream once per durable id: a line that is shipped again within ``lateness`` adds nothing.

    A late row is kept, unlike under a plain watermark on the time of the event:
    what the watermark follows is ``ts``, the time of shipping, which only grows.
    Ids are forgotten once that time is ``lateness`` ahead of them.
    """
    return rows.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([doc_id])
