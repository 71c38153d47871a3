"""A document store that finds ids without reading it.

Documents of an index are dealt to buckets by a hash of their id, and files carry a
Bloom filter of the ids. So operations on a few ids touch the buckets of those ids
only: other folders are not opened, and of a bucket only files that may have the
id. New documents are appended; only buckets with a replaced document are written
again, by dynamic partition overwrite.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.operators.bulk import first_per_id, latest_per_id
from eventmill.session import attach, written
from eventmill.sources.store import INDEX

BUCKET = "_bucket"
BUCKETS = 64
#: Touched folders up to which they are named in the plan, and ids up to which these are.
NAMED_FOLDERS, NAMED_IDS = 4_096, 256


def bucket_of(doc_id: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(doc_id)), F.lit(buckets)).cast("int")


class IndexedStore:
    """Documents with ``_index`` and an id, unique in their index, under ``path``."""

    def __init__(self, spark: SparkSession, path: str, doc_id: str, buckets: int = BUCKETS):
        self.spark, self.path, self.doc_id, self.buckets = spark, path.rstrip("/"), doc_id, buckets

    def dealt(self, documents: DataFrame) -> DataFrame:
        return documents.withColumn(BUCKET, bucket_of(self.doc_id, self.buckets))

    def write(self, documents: DataFrame, mode: str = "append") -> None:
        """Write documents whose ids are new to the store; large buckets are split, small ones merged at run time."""
        self.save(self.dealt(documents), mode)

    def save(self, dealt: DataFrame, mode: str, replace: bool = False) -> None:
        writer = dealt.hint("rebalance", INDEX, BUCKET).write.mode(mode).partitionBy(INDEX, BUCKET).option(
            f"parquet.bloom.filter.enabled#{self.doc_id}", "true")
        (writer.option("partitionOverwriteMode", "dynamic") if replace else writer).parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).withColumn(BUCKET, F.col(BUCKET).cast("int"))

    def touched(self, ids: DataFrame) -> DataFrame:
        """The folders that may hold ``ids(_index, id)``, of the whole store where they are too many to name."""
        folders = self.dealt(ids).select(INDEX, BUCKET).distinct().take(NAMED_FOLDERS + 1)
        if len(folders) > NAMED_FOLDERS:
            return self.read()
        by_index: dict[str, list[int]] = {}
        for folder in folders:
            by_index.setdefault(folder[INDEX], []).append(folder[BUCKET])
        test = F.lit(False)
        for index, numbers in by_index.items():
            test = test | (F.col(INDEX) == index) & F.col(BUCKET).isin(numbers)
        return self.read().filter(test)

    def stored(self, ids: DataFrame) -> DataFrame:
        """Those of ``ids`` that are stored: ``(_index, id)``."""
        there = self.touched(ids)
        named = ids.select(self.doc_id).distinct().take(NAMED_IDS + 1)
        if len(named) <= NAMED_IDS:
            there = there.filter(F.col(self.doc_id).isin([row[0] for row in named]))  # reaches the Bloom filters
        return attach(there.select(INDEX, self.doc_id), ids.select(INDEX, self.doc_id).distinct(), [INDEX, self.doc_id], "inner", label="ids")

    def create(self, events: DataFrame, order: list[str], columns: list[str] | None = None) -> DataFrame:
        """``create`` operations: an id that is stored is left alone, else its first event is appended. Gives what was added."""
        first = self.one_per_id(first_per_id, events, order, columns)
        added = written(first.join(self.stored(first), [INDEX, self.doc_id], "left_anti").select(first.columns), "added")
        self.write(added)
        return added

    def replace(self, events: DataFrame, order: list[str], columns: list[str] | None = None) -> DataFrame:
        """``index`` operations: the last event per id is stored, in place of what was. Gives what was stored.

        New ids of folders without a replaced one are appended first; after a
        failure in between, the same events give the same store.
        """
        latest = self.one_per_id(latest_per_id, events, order, columns)
        hit = written(self.stored(latest), "hit")
        if not hit.take(1):
            self.write(latest)
            return latest
        folders = written(self.dealt(hit).select(INDEX, BUCKET).distinct(), "folders")
        new = self.dealt(latest)
        kept = attach(self.touched(hit), hit, [INDEX, self.doc_id], "left_anti", label="replaced")
        both = attach(new.unionByName(kept.select(new.columns)), folders, [INDEX, BUCKET], "left_semi", label="folders")
        again = written(both, "again")  # what is read must not be overwritten while it is
        self.save(attach(new, folders, [INDEX, BUCKET], "left_anti", label="folders"), "append")
        self.save(again, "overwrite", replace=True)
        return latest

    def one_per_id(self, choose, events: DataFrame, order: list[str], columns: list[str] | None) -> DataFrame:
        """The event that counts for each id, with the columns to store."""
        columns = list(columns or events.columns)
        keyed = events.withColumn("_key", F.struct(INDEX, self.doc_id))
        return written(choose(keyed, "_key", order, columns).select(*columns), "chosen")
