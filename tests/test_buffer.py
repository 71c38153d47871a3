"""Buffer files on disk, bookmarks, retention, rolling, whole durable requests."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from eventmill.operators import retention
from eventmill.options import BatchOptions, RouteOptions, ShippingOptions
from eventmill.plans import indexing
from eventmill.sources import buffer, store

NAMES = ["app-20240102.json", "app-20240101_002.json", "app-20240101.json", "app-20240101_010.json"]
DECOYS = ["app-202401.json", "app-2024010107.json", "other-20240101.json", "app-20240101_01.json", "app-20240101.txt"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("buffer")
    for i, name in enumerate(NAMES + DECOYS):
        lines = [f'{{"n":{i * 100 + j},"t":"é{"x" * j}"}}' for j in range(40)]
        path.joinpath(name).write_bytes(b"\xef\xbb\xbf" + "".join(f"{line}\n" for line in lines).encode())
    return str(path)


def test_listing(spark, folder):
    files = buffer.ranked(buffer.listed(buffer.stored_files(spark, folder, "app"), "app"))
    rows = files.orderBy("rank").collect()
    assert [r.file_name for r in rows] == [NAMES[2], NAMES[1], NAMES[3], NAMES[0]]
    assert [r.seq for r in rows] == [0, 2, 10, 0] and [r["rank"] for r in rows] == [1, 2, 3, 4]


@pytest.mark.parametrize("interval, name", [
    ("Month", "app-202401.json"), ("Hour", "app-2024010107.json"), ("Year", None), ("Minute", None)])
def test_other_intervals(spark, folder, interval, name):
    files = buffer.listed(buffer.stored_files(spark, folder, "app"), "app", interval)
    assert [r.file_name for r in files.collect()] == ([name] if name else [])


def test_positions_are_those_of_the_bytes(spark, folder):
    """Also when a file is read in several splits."""
    whole = {name: open(f"{folder}/{name}", "rb").read() for name in NAMES}
    for split in ("134217728", "300"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            rows = buffer.stored_lines_with_offsets(spark, folder, "app").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        rows = [r for r in rows if r.file_name in whole]
        assert len(rows) == 160
        for row in rows:
            start = 3 if row.start_offset == 0 else row.start_offset
            assert whole[row.file_name][start:row.next_offset].decode() == row.line + "\n"


def test_other_line_ends(spark, tmp_path):
    data = b"first\r\nsecond\r\nthird\r\n"
    (tmp_path / "app-20240101.json").write_bytes(data)
    rows = buffer.stored_lines_with_offsets(spark, str(tmp_path), "app", assume_bom=False, newline="\r\n").collect()
    assert {data[r.start_offset:r.next_offset] for r in rows} == {b"first\r\n", b"second\r\n", b"third\r\n"}


def test_without_mark(spark):
    lines = spark.createDataFrame([("f", 1, "test 1"), ("f", 2, "test 2"), ("f", 3, "1234567")], "f string, n long, line string")
    placed = buffer.with_offsets(lines, ["f"], ["n"], assume_bom=False, newline="\r\n").orderBy("n").collect()
    assert [(r.start_offset, r.next_offset) for r in placed] == [(0, 8), (8, 16), (16, 25)]


@pytest.mark.parametrize("text, position", [
    ("12:::f-1.json", (12, "f-1.json")), ("12:::", None), ("x:::f", None), ("f", None), ("1:::a:::b", None), (None, None)])
def test_bookmarks(spark, text, position):
    row = spark.createDataFrame([(text,)], "b string").select(buffer.bookmark_position(F.col("b")).alias("p")).first()
    assert (row.p and tuple(row.p)) == position


def test_resuming(spark, folder):
    lines = buffer.listed(buffer.stored_lines_with_offsets(spark, folder, "app"), "app").withColumn("source", F.lit("s"))
    files = lines.select("source", "file_name", "file_date", "seq").distinct()
    marks = lambda text: spark.createDataFrame([("s", text)], "source string, bookmark string")
    read = lambda text: buffer.resumed(lines, files, marks(text), line_key="start_offset")
    assert read("junk").count() == read("9:::gone.json").count() == 160
    third = lines.filter(f"file_name = '{NAMES[1]}'").orderBy("start_offset").collect()[30]
    left = read(f"{third.start_offset}:::{NAMES[1]}")
    assert left.count() == 10 + 80 and left.filter(f"file_name = '{NAMES[2]}'").count() == 0


def test_durable_requests(spark, folder):
    lines = buffer.listed(buffer.stored_lines_with_offsets(spark, folder, "app"), "app")
    rows = indexing.durable_requests(lines, RouteOptions(pipeline="p"), BatchOptions(op="create", posting_limit=25, event_bytes_limit=40)).collect()
    assert {r._index for r in rows} == {"logstash-2024.01.01", "logstash-2024.01.02"}
    assert all(len(r.doc.encode()) <= 40 for r in rows) and 0 < len(rows) < 160
    action = json.loads(rows[0].action)["create"]
    assert list(action) == ["_index", "pipeline", "_id"] and action["_id"] == rows[0].doc_id
    assert len({r.doc_id for r in rows}) == len(rows)
    for batch in {r.batch_id for r in rows}:
        places = sorted(r.pos for r in rows if r.batch_id == batch)
        assert places == list(range(len(places))) and len(places) <= 25


def test_coarse_intervals_do_not_ship():
    for interval in ("Infinite", "Year", "Month"):
        with pytest.raises(ValueError):
            retention.check_shippable(interval)
    retention.check_shippable("Day")


@pytest.fixture(scope="module")
def files(spark):
    return spark.createDataFrame(
        [(f"2024010{d}", s, 10 * d + s) for d in range(1, 5) for s in range(3)], "file_date string, seq int, size_bytes long")


def kept(frame):
    return sorted((r.file_date, r.seq) for r in frame.filter("keep").collect())


def test_retention(files):
    order = [F.col("seq").desc()]
    newest = sorted(((r.file_date, r.seq, r.size_bytes) for r in files.collect()), reverse=True)
    for limit in (0, 90, 300, 10_000):
        total, want = 0, []
        for i, (date, seq, size) in enumerate(newest):
            total += size
            if i < 2 or total <= limit:
                want.append((date, seq))
        assert kept(retention.keep_by_size(files, limit, "file_date", order)) == sorted(want)
    assert kept(retention.keep_by_count(files, "file_date", order, 5)) == sorted((d, s) for d, s, _ in newest[:5])
    assert len(kept(retention.keep_by_count(files, "file_date", order, None))) == 12
    # Dumps: none is safe, and the incoming one takes its bytes from the limit.
    assert len(kept(retention.keep_dumps(files, 100, 20, "file_date", order))) == 1
    assert kept(retention.keep_dumps(files, 10, 20, "file_date", order)) == []


def test_stored_requests(spark, folder):
    """From files to requests: every line of a dated file, none of the others."""
    rows, undated = indexing.stored_requests(spark, folder, "app")
    got = {r.file_name: r.n for r in rows.groupBy("file_name").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {n: got.get(n) for n in NAMES} == dict.fromkeys(NAMES, 40)
    assert {r.reason for r in undated.collect()} == {"no date in file name app-202401.json"}


def test_kept_buffers(spark):
    files = spark.createDataFrame([(f"2024010{d}", d, 10) for d in range(1, 8)], "file_date string, seq int, size_bytes int")
    for size, count, want in ((10, 5, 5), (7, 5, 3), (None, 4, 4), (5, None, 7)):
        options = ShippingOptions(file_size_limit=size, file_count_limit=count)
        assert retention.kept_buffers(files, options, "file_date", [F.col("seq").desc()]).where("keep").count() == want


def test_evictions(spark):
    files = spark.createDataFrame([
        ("one", "f1", 1, 5), ("two", "f1", 1, 5), ("two", "f2", 2, 5), ("part", "f1", 1, 5), ("part", "f2", 2, 5),
        ("many", "f1", 1, 5), ("many", "f2", 2, 5), ("many", "f3", 3, 5), ("new", "f1", 1, 5), ("new", "f2", 2, 5),
        ("midway", "f1", 1, 10), ("midway", "f2", 2, 5), ("midway", "f3", 3, 5), ("unmarked", "f1", 1, 5), ("unmarked", "f2", 2, 5), ("unmarked", "f3", 3, 5),
        ("gone", "f1", 1, 5), ("gone", "f2", 2, 5), ("gone", "f3", 3, 5), ("second", "f1", 1, 5), ("second", "f2", 2, 5)],
        "source string, file_name string, file_rank int, size_bytes long")
    marks = spark.createDataFrame([("one", "f1", 5), ("two", "f1", 5), ("part", "f1", 4), ("many", "f2", 5), ("midway", "f1", 5),
                                   ("gone", "f0", 5), ("second", "f2", 5)],
                                  "source string, bookmark_file string, next_offset long")
    rows = {r.source: (r.action, r.file) for r in retention.evictions(files, marks).collect()}
    assert rows == {"one": ("wait", None), "two": ("advance", "f2"), "part": ("wait", None), "many": ("delete", "f1"), "new": ("wait", None),
                    "midway": ("wait", None), "unmarked": ("wait", None), "gone": ("wait", None), "second": ("wait", None)}


@pytest.mark.parametrize("interval, bucket", [
    ("Infinite", ""), ("Year", "2024"), ("Month", "202401"), ("Day", "20240102"), ("Hour", "2024010203"), ("Minute", "202401020304")])
def test_buckets(spark, interval, bucket):
    when = datetime.datetime(2024, 1, 2, 3, 4, tzinfo=datetime.timezone.utc)
    row = spark.createDataFrame([(when,)], "ts timestamp").select(retention.rolling_bucket(F.col("ts"), interval))
    assert row.first()[0] == bucket


def test_store_round_trip(spark, tmp_path):
    docs = spark.createDataFrame([("logs_a-1", "x"), ("logs_a-2", "y"), ("logsXa-1", "z")], "_index string, doc string")
    path = str(tmp_path / "docs")
    store.write_documents(docs, path)
    assert store.read_documents(spark, path, "logs_a-*").count() == 2
    assert store.read_documents(spark, path, "all", {"all": ["logs_a-1", "logsX*"]}).count() == 2
    found = store.read_documents(spark, path, "logs_a-1")
    assert "PartitionFilters: [isnotnull" in found._jdf.queryExecution().toString() and found.count() == 1


def test_request_files(spark, tmp_path):
    rows = spark.createDataFrame([("i-1", "a1", "d1"), ("i-1", "a2", "d2"), ("i-2", "a3", "d3")], "_index string, action string, doc string")
    path = tmp_path / "requests"
    store.write_requests(indexing.requests(rows), str(path))
    text = "".join(p.read_text() for p in path.glob("_index=i-1/*.txt"))
    assert text.endswith("\n") and sorted([text[:6], text[6:]]) == ["a1\nd1\n", "a2\nd2\n"]
