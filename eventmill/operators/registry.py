"""Field mappings kept between runs.

What is known of the documents so far is one row for each (index, path, type): the
least order in which it was seen, and how often. Two such tables merge into one by
least and sum, in any grouping, so only new documents are ever opened. The type
that was seen first is the mapping of a path.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from eventmill.operators.mapping import merged, summary
from eventmill.sources.ordered import put, store_of

CURRENT = "current.json"


class Registry:
    """A summary in a folder, as versions of which a small file names the current one.

    A run that breaks off leaves the current version as it was. Updates have
    rising numbers (those of micro-batches, say); one that was applied before
    changes nothing. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def current(self) -> dict:
        store, place = store_of(f"{self.path}/{CURRENT}")
        if store.get_file_info(place).type != fs.FileType.File:
            return {"version": None, "update": -1}
        with store.open_input_stream(place) as file:
            return json.loads(file.read())

    def known(self) -> DataFrame | None:
        """The summary so far."""
        version = self.current()["version"]
        return None if version is None else self.spark.read.parquet(f"{self.path}/{version}")

    def update(self, fields: DataFrame, order: Sequence[str], number: int) -> DataFrame:
        """Add the leaves of new documents and give the summary of all."""
        now = self.current()
        if number <= now["update"]:
            return self.known()
        new, before = summary(fields, order), self.known()
        version = f"version-{number}"
        (new if before is None else merged(before, new)).write.mode("overwrite").parquet(f"{self.path}/{version}")
        put(*store_of(f"{self.path}/{CURRENT}"), json.dumps({"version": version, "update": number}).encode())
        return self.known()
