"""Structured Streaming: direct delivery, durable shipping, run-time thresholds."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventmill.options import PERIOD_SECONDS, ShippingOptions
from eventmill.session import prepare


def event_stream(spark: SparkSession, folder: str, name: str, max_files: int | None = None) -> DataFrame:
    """A stream over the files of a table, which is one file or a folder of files."""
    spark = prepare(spark)
    # A pattern may stand for a file or a folder; as a plain path Spark takes a folder only.
    reader = spark.readStream.schema(spark.read.parquet(f"{folder}/{name}.parquet").schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{folder}/{name}.parque[t]")


def buffer_stream(spark: SparkSession, folder: str, max_files: int | None = None, clean: str = "off",
                  archive: str | None = None) -> DataFrame:
    """Buffered lines, oldest file first. ``clean`` lets Spark archive or delete files once they are read."""
    reader = prepare(spark).readStream.schema("value string").option("cleanSource", clean).option(
        "recursiveFileLookup", True).option("latestFirst", False)
    if archive:
        reader = reader.option("sourceArchiveDir", archive)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(folder).select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("line"))


def ship(
    stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str,
    partition_by: list[str] | None = None, seconds: float | None = None,
) -> StreamingQuery:
    """Run ``transform`` on each micro-batch and write it to a folder of its own.

    A batch that is run again after a failure overwrites its folder, so nothing
    is lost or doubled. Without ``seconds`` the stream drains and stops.
    """
    def write(batch: DataFrame, number: int) -> None:
        rows = transform(batch).withColumn("batch", F.lit(number))
        rows.drop("batch").write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(f"{out}/batch={number}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{seconds} seconds").start()


def ship_direct(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Direct mode: a micro-batch each period."""
    return ship(stream, transform, out, checkpoint, seconds=PERIOD_SECONDS)


def ship_durable(
    stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, shipping: ShippingOptions = ShippingOptions()
) -> StreamingQuery:
    """Durable mode: a micro-batch each shipping interval."""
    return ship(stream, transform, out, checkpoint, seconds=shipping.period_seconds)


def drained(query: StreamingQuery) -> None:
    """Wait for a draining stream and report its failure, if any."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def drained_steps(query: StreamingQuery) -> None:
    """Let a periodic stream go on step by step until nothing new comes, and stop it; for sources that limit their steps themselves."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def switched(read_minimum: Callable[[SparkSession], str | None],
             transform: Callable[[DataFrame, str | None], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """A transform whose level threshold is read anew for every micro-batch."""
    return lambda batch: transform(batch, read_minimum(batch.sparkSession))


def until(query: StreamingQuery, done: Callable[[], bool], most_seconds: float = 600, each_seconds: float = 0.5) -> None:
    """Let a periodic stream go on until ``done``, and stop it; for streams whose timers make rows without new input."""
    end = time.monotonic() + most_seconds
    try:
        while not done():
            if query.exception() is not None:
                raise query.exception()
            if time.monotonic() > end:
                raise TimeoutError("the stream has not come to its end")
            time.sleep(each_seconds)
    finally:
        query.stop()


@contextmanager
def state_partitions(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Queries started in here keep their state in so many partitions (as many as there are cores), for the life of their checkpoint."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions or spark.sparkContext.defaultParallelism)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
