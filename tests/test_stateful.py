"""Streams with keyed state: retries after a delay, output committed once, admission across steps, replays."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from eventmill.operators import delivery, filters
from eventmill.options import BatchOptions
from eventmill.session import new_folder
from eventmill.streaming import admission, jobs, retry, sink

START = datetime.datetime(2024, 1, 1)
ATTEMPT = "target string, attempt_no long, ts timestamp, success boolean, payload string"


def put(spark, folder, number, rows, schema):
    """One more file; files are read in the order of their times."""
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/part={number}")


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(folder)


def attempts(rng, first, n):
    return [(f"t{rng.randint(0, 2)}", i, START + datetime.timedelta(seconds=i // 2), rng.random() < 0.4, f"body {i}") for i in range(first, first + n)]


def runs(rows):
    """Failures in a row of each attempt, by walking the ledger."""
    count, out = {}, {}
    for target, number, _, success, _ in sorted(rows, key=lambda r: (r[2], r[1])):
        count[target] = 0 if success else count.get(target, 0) + 1
        out[number] = count[target]
    return out


@pytest.mark.parametrize("n", range(1, 70))
def test_delay_is_that_of_the_column(spark, n):
    if n > 12 and n % 19:
        return
    for period in (2, 30, 1000):
        assert spark.range(1).select(delivery.retry_delay(F.lit(n), period)).first()[0] == retry.delay_after(n, period)


def test_failed_attempts_come_back_once(spark, tmp_path):
    """Over two steps and a stop between failure and timer; each failure is sent again after its delay, none twice."""
    rng = random.Random(4)
    folder, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    rows = attempts(rng, 0, 60)
    put(spark, folder, 0, rows[:40], ATTEMPT)

    def start():
        return jobs.ship(retry.retries(stream(spark, folder, ATTEMPT), 2, clock=0.01), lambda b: b, out, check, seconds=0)

    def sent():
        try:
            return spark.read.parquet(out).collect()
        except Exception:
            return []

    first = sum(not r[3] for r in rows[:40])
    jobs.until(start(), lambda: 0 < len(sent()) or not first, 60, 0.1)  # stopped while others wait
    put(spark, folder, 1, rows[40:], ATTEMPT)
    want = {r[1]: r for r in rows if not r[3]}
    jobs.until(start(), lambda: len(sent()) >= len(want), 90, 0.2)
    found, in_a_row = sent(), runs(rows)
    assert sorted(r.attempt_no for r in found) == sorted(want)
    for r in found:
        assert (r.target, r.payload) == (want[r.attempt_no][0], want[r.attempt_no][4])
        assert r.failures_in_a_row == in_a_row[r.attempt_no] and r.delay_seconds == retry.delay_after(in_a_row[r.attempt_no], 2)
        assert r.sent_ms >= r.due_ms


def interrupted(late):
    """A sink that ends once at the commit of step 1: before the manifest, or right after it."""
    class Interrupted(sink.ManifestWriter):
        def commit(self, messages, batchId):
            store, place = self.place("interrupted")
            if batchId == 1 and store.get_file_info(place).type.name == "NotFound":
                store.open_output_stream(place).close()
                if late:
                    super().commit(messages, batchId)
                raise RuntimeError("the driver is lost")
            super().commit(messages, batchId)

        def abort(self, messages, batchId):
            """A lost driver cleans nothing up."""

    class Source(sink.CommittedFiles):
        @classmethod
        def name(cls):
            return f"committed_{'late' if late else 'early'}"

        def streamWriter(self, schema, overwrite):
            return Interrupted(self.options["path"])

    return Source


@pytest.mark.parametrize("late", [False, True])
def test_a_step_counts_once(spark, tmp_path, late):
    folder, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    for part in range(3):
        put(spark, folder, part, [(i,) for i in range(10 * part, 10 * part + 10)], "id long")
    rows = stream(spark, folder, "id long")
    with pytest.raises(Exception, match="the driver is lost"):
        jobs.drained(sink.ship_committed(rows, out, check, source=interrupted(late)))
    seen = sink.committed(spark, out, rows.schema).collect()
    assert sorted(r.id for r in seen) == list(range(20 if late else 10)), "what is not committed is not seen"
    jobs.drained(sink.ship_committed(rows, out, check, source=interrupted(late)))
    seen = sink.committed(spark, out, rows.schema).collect()
    assert sorted((r.step, r.id) for r in seen) == [(i // 10, i) for i in range(30)]
    assert sum(r.n_rows for r in sink.manifests(spark, out).collect()) == 30


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    folder, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    put(spark, folder, 0, [(i,) for i in range(10)], "id long")
    rows = stream(spark, folder, "id long").repartition(3).selectExpr("id", "CASE WHEN id = 7 THEN raise_error('no') ELSE 1 END AS one")
    with pytest.raises(Exception, match="no"):
        jobs.drained(sink.ship_committed(rows, out, check))
    assert not list((tmp_path / "out").rglob("commits/*"))


EVENT = "event_id long, ts timestamp, bucket string"


def test_admission_across_steps(spark, tmp_path):
    """As the batch operator, with events that arrive in order; a null bucket is one like others."""
    rng = random.Random(6)
    rows = [(i, START + datetime.timedelta(seconds=i // 3), rng.choice(["a", "a", "a", "b", None])) for i in range(300)]
    for part in range(5):
        put(spark, str(tmp_path / "in"), part, rows[60 * part:60 * part + 60], EVENT)
    events = stream(spark, str(tmp_path / "in"), EVENT)
    got = admission.admitted_stream(events.repartition(4), "bucket", ["ts", "event_id"], BatchOptions(queue_limit=37))
    query = jobs.ship(got, lambda b: b, str(tmp_path / "out"), str(tmp_path / "check"), seconds=0)
    jobs.until(query, lambda: sum(p["numInputRows"] for p in {p["batchId"]: p for p in query.recentProgress}.values()) >= 300, 90)
    found = spark.read.parquet(str(tmp_path / "out"))
    want = filters.admitted(spark.createDataFrame(rows, EVENT), "bucket", ["ts", "event_id"], 37)
    assert sorted(r.event_id for r in found.collect()) == sorted(r.event_id for r in want.collect())
    assert admission.admitted_stream(events, "bucket", ["ts"], BatchOptions(queue_limit=None)) is events


def test_a_bucket_is_forgotten(spark, tmp_path):
    put(spark, str(tmp_path / "in"), 0, [(i, START, "a") for i in range(5)], EVENT)
    got = admission.admitted_stream(stream(spark, str(tmp_path / "in"), EVENT), "bucket", ["event_id"], BatchOptions(queue_limit=3), keep_seconds=0.5)
    query = jobs.ship(got, lambda b: b, str(tmp_path / "out"), str(tmp_path / "check"), seconds=0)
    done = lambda n: lambda: len(spark.read.schema(EVENT).parquet(new_or(tmp_path / "out")).collect()) >= n
    jobs.until(query, done(3), 60)
    put(spark, str(tmp_path / "in"), 1, [(i, START, "a") for i in range(5, 10)], EVENT)
    query = jobs.ship(got, lambda b: b, str(tmp_path / "out"), str(tmp_path / "check"), seconds=0)
    jobs.until(query, done(6), 60)
    assert sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [0, 1, 2, 5, 6, 7]


def new_or(path):
    path.mkdir(exist_ok=True)
    return str(path)


def test_replays_add_nothing_and_late_rows_stay(spark, tmp_path):
    schema = "doc_id string, shipped timestamp, ts timestamp"
    day = datetime.timedelta(days=1)
    shipped = START + 10 * day
    first = [(f"d{i}", shipped, START + i * day) for i in range(5)]
    again = [(f"d{i}", shipped + datetime.timedelta(minutes=i), START + i * day) for i in range(5)]
    late = [("late", shipped + datetime.timedelta(minutes=7), START - 30 * day)]
    for part, rows in enumerate((first, again, late)):
        put(spark, str(tmp_path / "in"), part, rows, schema)
    got = admission.without_replays(stream(spark, str(tmp_path / "in"), schema), "doc_id", "shipped", "1 hour")
    jobs.drained(jobs.ship(got, lambda b: b, str(tmp_path / "out"), str(tmp_path / "check")))
    assert sorted(r.doc_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["d0", "d1", "d2", "d3", "d4", "late"]
