"""What the operators share: reading a table, whole texts, ids that may be missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(column: str | Column = "text") -> Column:
    """The text, with a missing text read as an empty one."""
    return F.coalesce((F.col(column) if isinstance(column, str) else column).cast("string"), F.lit(""))


def ids_and_texts(docs: DataFrame) -> DataFrame:
    """Only what an operator reads, so that no other column of ``docs`` can clash with its own names."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, though it is used several times."""
    return F.transform(F.array(value), body)[0]


class Remembered(dict):
    """What a worker has worked out for short texts: bounded in entries and in the length of each.

    A full table becomes the older one, in place of the one before; what is
    asked for there comes back, so what is common stays.
    """

    longest, most = 64, 300_000

    def __init__(self):
        self.older: dict = {}

    def keep(self, text: str, value):
        """The value, remembered if the text is short."""
        if len(text) <= self.longest:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[text] = value
        return value

    def recall(self, text: str):
        """A value that only the older table has."""
        value = self.older.get(text)
        return None if value is None else self.keep(text, value)
