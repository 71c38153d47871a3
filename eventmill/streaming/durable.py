"""Durable shipping with its position as stream state.

The lines of a source (``sources.ordered``) become request rows; the position up to
which they were turned is a value state under the source. State and output of a
step stand or fall together: a failed step leaves the position where it was, and the
run after it gives the same rows with the same ids. A batch of the stream has a
bounded number of lines of a source, so a source with a third of all lines is no
more work for its task than any other. A payload holds lines of one step.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from eventmill.operators.bulk import action_line, durable_id
from eventmill.operators.filters import fits
from eventmill.operators.retention import check_shippable
from eventmill.operators.routing import buffered_index
from eventmill.options import BatchOptions, RouteOptions, ShippingOptions

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
POSITION = "file_date string, seq long, file_name string, next_offset long, payloads long"
#: A line in its payload. ``payload`` counts those of its source from 0; ``place`` is missing for a line that is not sent.
PLACED = "source string, file_name string, start_offset long, next_offset long, line string, payload long, place long"


def with_state(spark: SparkSession) -> SparkSession:
    """Keep stream state in the store that keyed state with timers needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return spark


class Payloads(StatefulProcessor):
    """Cuts the new lines of a source into payloads of one file and step and at most ``limit`` lines, and remembers where it is."""

    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.position = handle.getValueState("position", POSITION)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        lines = pd.concat(list(rows)).sort_values(["file_date", "seq", "start_offset"], kind="stable")
        payloads = 0
        if self.position.exists():
            date, seq, _, offset, payloads = self.position.get()
            same_date, same_file = lines.file_date == date, (lines.file_date == date) & (lines.seq == seq)
            lines = lines[(lines.file_date > date) | same_date & (lines.seq > seq) | same_file & (lines.start_offset >= offset)]
        if lines.empty:  # all of them were shipped before
            return
        in_file = lines.groupby(["file_date", "seq", "step"]).cumcount() // self.limit
        starts = (in_file.diff() != 0) | (lines.seq.diff() != 0) | (lines.step.diff() != 0) | (lines.file_date != lines.file_date.shift())
        number = starts.cumsum() - 1
        place = lines.fits.astype("int64").groupby(number).cumsum() - 1
        last = lines.iloc[-1]
        self.position.update((last.file_date, int(last.seq), last.file_name, int(last.next_offset), payloads + int(number.iloc[-1]) + 1))
        yield pd.DataFrame({
            "source": lines.source, "file_name": lines.file_name, "start_offset": lines.start_offset, "next_offset": lines.next_offset, "line": lines.line,
            "payload": payloads + number, "place": place.where(lines.fits).astype("Int64")})

    def close(self) -> None:
        pass


def durable_stream(
    lines: DataFrame, routes: RouteOptions = RouteOptions(), batches: BatchOptions = BatchOptions(), shipping: ShippingOptions = ShippingOptions(),
    doc_type: Column | None = None, index_decider: Column | None = None,
) -> DataFrame:
    """Request rows of a stream of :func:`sources.ordered.ordered_lines`.

    ``source, payload, pos, file_name, start_offset, next_offset, _index, doc_id,
    action, doc``. Lines over the size limit count for their payload but are not
    sent. A line that comes again, at or before the position, gives no row.
    """
    check_shippable(shipping.rolling_interval)
    with_state(lines.sparkSession)
    if "step" not in lines.columns:  # lines of another source: a batch is a step
        lines = lines.withColumn("step", F.lit(0).cast("long"))
    sized = lines.withColumn("fits", fits(F.col("line"), batches.event_bytes_limit))
    placed = sized.groupBy("source").transformWithStateInPandas(
        Payloads(batches.posting_limit), outputStructType=PLACED, outputMode="append", timeMode="none")
    index = buffered_index(F.col("file_name"), shipping.rolling_interval, routes.index_format) if index_decider is None else index_decider
    file = F.when(F.col("source") == "", F.col("file_name")).otherwise(F.concat_ws("/", "source", "file_name"))
    doc_id = durable_id(F.col("place"), file, F.col("start_offset"))
    return placed.filter("place IS NOT NULL").select(
        "source", "payload", F.col("place").alias("pos"), "file_name", "start_offset", "next_offset", index.alias("_index"), doc_id.alias("doc_id"),
        action_line(batches.op, index, doc_type, F.lit(routes.pipeline).cast("string"), doc_id).alias("action"), F.col("line").alias("doc"))


def positions(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``(source, file_name, next_offset, payloads)`` committed by a query, read from its checkpoint."""
    state = with_state(spark).read.format("statestore").option("path", checkpoint).option("stateVarName", "position").load()
    return state.select(F.col("key.source").alias("source"), "value.file_name", "value.next_offset", "value.payloads")


def bookmarks(found: DataFrame) -> DataFrame:
    """Positions as the lines of bookmark files."""
    return found.select("source", F.concat(F.col("next_offset").cast("string"), F.lit(":::"), F.col("file_name")).alias("bookmark"))
