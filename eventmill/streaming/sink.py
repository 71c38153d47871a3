"""A stream writer whose output is there once, whole, or not at all.

Tasks write files under names of their own and report them; the driver commits a
step by one manifest under the step's number. Readers see the files of manifests
only. A step that is run again after its manifest was written finds it and drops
what it wrote anew; one that broke off before has left files that nothing names.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from eventmill.sources.ordered import put, store_of

DATA, COMMITS = "data", "commits"


@dataclass
class Wrote(WriterCommitMessage):
    """The file of a task, if it had rows."""

    file: str | None
    rows: int


class ManifestWriter(DataSourceStreamArrowWriter):
    """Writes Parquet files; a step counts from its manifest on."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def place(self, *parts: str) -> tuple[fs.FileSystem, str]:
        store, root = store_of(self.path)
        return store, posixpath.join(root, *parts)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Wrote:
        writer, name, rows = None, None, 0
        for batch in iterator:
            if not batch.num_rows:
                continue
            if writer is None:
                name = f"{uuid.uuid4().hex}.parquet"
                store, place = self.place(DATA, name)
                store.create_dir(posixpath.dirname(place), recursive=True)
                writer = pq.ParquetWriter(place, batch.schema, filesystem=store)
            writer.write_batch(batch)
            rows += batch.num_rows
        if writer is not None:
            writer.close()
        return Wrote(name, rows)

    def drop(self, messages: list[Wrote | None]) -> None:
        for message in messages:
            if message is not None and message.file:
                store, place = self.place(DATA, message.file)
                if store.get_file_info(place).type == fs.FileType.File:
                    store.delete_file(place)

    def commit(self, messages: list[Wrote | None], batchId: int) -> None:
        store, place = self.place(COMMITS, f"{batchId}.json")
        if store.get_file_info(place).type == fs.FileType.File:
            self.drop(messages)  # applied by a run that ended before Spark took note
            return
        store.create_dir(posixpath.dirname(place), recursive=True)
        written = [m for m in messages if m is not None and m.file]
        put(store, place, "".join(json.dumps({"step": batchId, "file": m.file, "n_rows": m.rows}) + "\n" for m in written).encode())

    def abort(self, messages: list[Wrote | None], batchId: int) -> None:
        self.drop(messages)


class CommittedFiles(DataSource):
    """Option: ``path``, a folder of one stream's own."""

    @classmethod
    def name(cls) -> str:
        return "committed_files"

    def streamWriter(self, schema: StructType, overwrite: bool) -> ManifestWriter:
        return ManifestWriter(self.options["path"])


def ship_committed(stream: DataFrame, path: str, checkpoint: str, seconds: float | None = None, source: type[DataSource] = CommittedFiles) -> StreamingQuery:
    """Write a stream to ``path``, each step once. Without ``seconds`` the stream drains and stops."""
    stream.sparkSession.dataSource.register(source)
    writer = stream.writeStream.format(source.name()).option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if seconds is None else writer.trigger(processingTime=f"{seconds} seconds")).start()


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """``(step, file, n_rows)`` of all committed steps."""
    return spark.read.schema("step long, file string, n_rows long").option("pathGlobFilter", "*.json").json(f"{path}/{COMMITS}")


def committed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of committed steps, with ``step``. Files are told by name in a join, so no list of files passes the driver."""
    rows = spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{path}/{DATA}").withColumn("file", F.col("_metadata.file_name"))
    return rows.join(manifests(spark, path).select("file", "step"), "file").drop("file")
