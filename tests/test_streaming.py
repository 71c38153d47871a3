"""Streams: draining, restart after a failed batch, run-time thresholds."""

import pytest
from pyspark.sql import functions as F

from eventmill.operators.filters import at_least
from eventmill.streaming import jobs


@pytest.fixture
def folder(spark, tmp_path):
    def add(name, values):
        tmp_path.joinpath("in").mkdir(exist_ok=True)
        tmp_path.joinpath("in", name).write_text("".join(f"{v}\n" for v in values))
    return tmp_path, add


def start(spark, path, transform, max_files=None):
    return jobs.ship(jobs.buffer_stream(spark, str(path / "in"), max_files), transform, str(path / "out"), str(path / "check"))


def shipped(spark, path):
    return sorted(int(r.line) for r in spark.read.parquet(str(path / "out")).collect())


def test_restart_loses_and_doubles_nothing(spark, folder):
    path, add = folder
    add("a.json", range(5))
    jobs.drained(start(spark, path, lambda batch: batch))
    add("b.json", range(5, 9))
    add("c.json", range(9, 12))

    def fails(batch):
        raise RuntimeError("node lost")

    with pytest.raises(Exception, match="node lost"):
        jobs.drained(start(spark, path, fails, max_files=1))
    assert shipped(spark, path) == list(range(5))
    jobs.drained(start(spark, path, lambda batch: batch, max_files=1))
    jobs.drained(start(spark, path, lambda batch: batch, max_files=1))
    assert shipped(spark, path) == list(range(12))


def test_threshold_changes_between_batches(spark, folder):
    path, add = folder
    add("a.json", range(6))
    levels = ["Verbose", "Debug", "Information", "Warning", "Error", "Fatal"]
    current = {"minimum": "Error"}

    def transform(batch, minimum):
        level = F.get(F.array(*map(F.lit, levels)), F.col("line").cast("int"))
        return at_least(batch.withColumn("level", level), minimum).select("line")

    run = jobs.switched(lambda session: current["minimum"], transform)
    jobs.drained(start(spark, path, run))
    assert shipped(spark, path) == [4, 5]
    current["minimum"] = "Warning"
    add("b.json", range(6))
    jobs.drained(start(spark, path, run))
    assert shipped(spark, path) == [3, 4, 4, 5, 5]


@pytest.mark.parametrize("files", [1, 3])
def test_table_of_several_files(spark, tmp_path, files):
    """A table may be a folder of files, and the folder may hold other tables."""
    spark.range(30).repartition(files).write.parquet(str(tmp_path / "events.parquet"))
    spark.range(5).write.parquet(str(tmp_path / "other.parquet"))
    jobs.drained(jobs.ship(jobs.event_stream(spark, str(tmp_path), "events", max_files=1), lambda batch: batch, str(tmp_path / "out"), str(tmp_path / "check")))
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(30))


def test_periodic_direct_delivery(spark, folder):
    path, add = folder
    add("a.json", range(3))
    query = jobs.ship_direct(jobs.buffer_stream(spark, str(path / "in")), lambda batch: batch, str(path / "out"), str(path / "check"))
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert shipped(spark, path) == [0, 1, 2]
