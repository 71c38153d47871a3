"""Document tables and request files: written per index, read back by pattern or alias."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.model import DOCUMENT

INDEX = "_index"


def balanced(documents: DataFrame) -> DataFrame:
    """Rows of an index together, with large indices split and small ones merged at run time."""
    return documents.hint("rebalance", INDEX)


def write_documents(documents: DataFrame, path: str, mode: str = "append") -> None:
    """A queryable table partitioned by index."""
    balanced(documents).write.mode(mode).partitionBy(INDEX).parquet(path)


def write_requests(requests: DataFrame, path: str, mode: str = "append", max_rows: int = 0) -> None:
    """Newline-delimited request files per index; each row is an action line and its document."""
    balanced(requests.select(INDEX, "request")).write.mode(mode).option("maxRecordsPerFile", max_rows).partitionBy(
        INDEX).text(path)


def read_documents(
    spark: SparkSession, path: str, pattern: str = "*", aliases: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Documents of the indices a pattern or alias names; other indices' files are not opened."""
    table = spark.read.parquet(path)
    patterns = list((aliases or {}).get(pattern, [pattern]))
    test = F.lit(False)
    for one in patterns:
        escaped = one.replace("\\", "\\\\").replace("%", r"\%").replace("_", r"\_").replace("*", "%")
        test = test | F.col(INDEX).like(escaped)
    return table.filter(test)


def write_dumps(dumps: DataFrame, path: str, mode: str = "append") -> None:
    """Rejected payloads (see ``delivery.dump_rows``) as text files per HTTP status."""
    dumps.select("http_status", F.col("payload").alias("value")).write.mode(mode).partitionBy("http_status").text(path)


def typed(documents: DataFrame, doc: str = "doc") -> DataFrame:
    """Documents read back under their explicit types; the JSON column gives way to its members."""
    rest = [name for name in documents.columns if name != doc]
    return documents.select(*rest, F.from_json(doc, DOCUMENT).alias("_d")).select(*rest, "_d.*")


def counts(documents: DataFrame, index: str = INDEX) -> DataFrame:
    """Documents per index."""
    return documents.groupBy(index).agg(F.count(F.lit(1)).alias("n"))
