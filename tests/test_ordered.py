"""The ordered stream of buffer files: order, limits, byte positions, runs after a failure."""

import os
import random

import pytest
from pyspark.sql import functions as F

from eventmill.options import BatchOptions
from eventmill.sources import ordered
from eventmill.streaming import durable, jobs

MARK = b"\xef\xbb\xbf"


def fill(folder, files, mark=MARK):
    """Write files; the later in reading order, the older by its time."""
    for i, (name, lines) in enumerate(files):
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(mark + b"".join(line if line.endswith(b"!") else line + b"\n" for line in lines))
        os.utime(path, (2_000_000_000 - 1000 * i, 2_000_000_000 - 1000 * i))


def steps(folder, lines=None, bookmark=None, base="buf"):
    """All steps of a reader, each as (source, file, line) in the order of its ranges."""
    options = {"path": str(folder), "base": base} | ({"lines": str(lines), "bookmark": str(bookmark)} if lines else {})
    reader, at, out = ordered.BufferReader(options), {}, []
    while (end := reader.latestOffset()) != at:
        rows = [r for p in reader.partitions(at, end) for b in reader.read(p) for r in b.to_pylist()]
        assert rows == [r for p in reader.partitions(at, end) for b in reader.read(p) for r in b.to_pylist()]
        out.append(rows)
        at = end
    return out


def test_date_then_sequence_whatever_the_file_times(tmp_path):
    fill(tmp_path / "in", [(f"buf-{n}.json", [n.encode()] * 3) for n in ("20240101", "20240101_002", "20240101_010", "20240102")])
    fill(tmp_path / "in", [("buf-202401.json", [b"month"]), ("other-20240101.json", [b"other"]), ("buf-20240101_01.json", [b"short"])])
    rows = [r["line"] for r in sum(steps(tmp_path / "in"), [])]
    assert rows == [n for n in ("20240101", "20240101_002", "20240101_010", "20240102") for _ in range(3)]


@pytest.mark.parametrize("limit", [1, 2, 5, 7, 100])
@pytest.mark.parametrize("block", [3, 1 << 20])
def test_limit_of_lines(tmp_path, monkeypatch, limit, block):
    """No step has more lines of a source; positions are bytes of the file; nothing is lost or doubled."""
    monkeypatch.setattr(ordered, "BLOCK", block)
    monkeypatch.setattr(ordered, "RANGE", 20)
    rng = random.Random(limit)
    files = [(f"{s}/buf-2024010{d}{q}.json", [("é" * rng.randint(0, 9)).encode() + b"%d" % rng.randint(0, 99) for _ in range(rng.randint(0, 9))])
             for s in ("a", "b/c") for d in (1, 2) for q in ("", "_001")]
    fill(tmp_path / "in", files)
    found = steps(tmp_path / "in", limit, tmp_path / "mark")
    for step in found:
        for source in ("a", "b/c"):
            assert sum(r["source"] == source for r in step) <= limit
    for source in ("a", "b/c"):
        rows = [r for step in found for r in step if r["source"] == source]
        assert [r["line"].encode() for r in rows] == [line for name, lines in files if name.startswith(source + "/") for line in lines]
        for r in rows:
            raw = (tmp_path / "in" / source / r["file_name"]).read_bytes()[r["start_offset"]:r["next_offset"]]
            assert raw.removeprefix(MARK) == r["line"].encode() + b"\n"


def test_open_lines_wait(tmp_path):
    """A line without its end is read when the end comes, or when the writer has begun another file."""
    folder = tmp_path / "in"
    fill(folder, [("buf-20240101.json", [b"one", b"two!"])])
    reader = ordered.BufferReader({"path": str(folder), "base": "buf", "lines": "10", "bookmark": str(tmp_path / "mark")})
    read = lambda a, b: [r["line"] for p in reader.partitions(a, b) for x in reader.read(p) for r in x.to_pylist()]
    first = reader.latestOffset()
    assert read({}, first) == ["one"] and reader.latestOffset() == first
    fill(folder, [("buf-20240101_001.json", [b"three\r"])], mark=b"")
    second = reader.latestOffset()
    assert read(first, second) == ["two!", "three"]
    # A new reader goes on from the bookmark; a file behind the position is not read.
    fill(folder, [("buf-20231231.json", [b"late"]), ("buf-20240103.json", [b"four"])])
    reader = ordered.BufferReader({"path": str(folder), "base": "buf", "lines": "10", "bookmark": str(tmp_path / "mark")})
    third = reader.latestOffset()
    assert read(second, third) == ["four"]
    assert read(first, second) == ["two!", "three"], "a step run again is the same"


def test_a_limit_needs_a_bookmark(tmp_path):
    with pytest.raises(ValueError, match="bookmark"):
        ordered.BufferReader({"path": str(tmp_path), "base": "buf", "lines": "5"})
    assert steps(tmp_path / "nothing") == []


def test_long_lines(tmp_path, monkeypatch):
    monkeypatch.setattr(ordered, "BLOCK", 64)
    monkeypatch.setattr(ordered, "RANGE", 100)
    lines = [b"x" * 5000, b"", b"y" * 199, b"z"]
    fill(tmp_path / "in", [("buf-20240101.json", lines)])
    for limit in (None, 2):
        assert [r["line"].encode() for step in steps(tmp_path / "in", limit, tmp_path / f"mark{limit}") for r in step] == lines


def run(spark, tmp_path, transform, lines, limit):
    stream = ordered.ordered_lines(spark, str(tmp_path / "in"), "buf", lines=lines, bookmark=str(tmp_path / "mark"))
    rows = durable.durable_stream(stream, batches=BatchOptions(posting_limit=limit, event_bytes_limit=8))
    jobs.drained_steps(jobs.ship(rows, transform, str(tmp_path / "out"), str(tmp_path / "check"), seconds=0))


def plain(files, lines, limit):
    """Payloads, places and positions by reading the files of each source line by line."""
    out, position = [], {}
    for source in sorted({name.split("/")[0] for name, _ in files}):
        flat, payload, step, left = [], -1, [], lines
        for name, content in sorted((n.split("/")[1], c) for n, c in files if n.startswith(source + "/")):
            at = 0
            for line in content:
                end = at + len(line) + 1 + (3 if at == 0 else 0)
                flat.append((name, at, end, line.decode()))
                at = end
        for i, (name, start, end, line) in enumerate(flat):
            step_start = i % lines == 0
            if step_start or flat[i - 1][0] != name:
                in_file = 0
            if in_file % limit == 0:
                payload, place = payload + 1, 0
            in_file += 1
            if len(line.encode()) <= 8:
                out.append((source, payload, place, name, start, end, line))
                place += 1
            position[source] = (name, end, payload + 1)
    return sorted(out), position


def test_positions_after_a_failed_step_and_a_restart(spark, tmp_path):
    rng = random.Random(1)
    files = [(f"{s}/buf-2024010{d}{q}.json", [b"l" * rng.randint(0, 10) for _ in range(rng.randint(5, 30))])
             for s in ("a", "b") for d in (1, 2) for q in ("", "_001")]
    fill(tmp_path / "in", files)
    seen = []

    def fails_once(batch):
        rows = batch.select("source", "payload", "doc_id").collect()
        seen.append(sorted(r.doc_id for r in rows))
        if len(seen) == 3:
            raise RuntimeError("the store is gone")
        return batch

    with pytest.raises(Exception, match="the store is gone"):
        run(spark, tmp_path, fails_once, 20, 6)
    before = {r.source: (r.file_name, r.next_offset) for r in durable.positions(spark, str(tmp_path / "check")).collect()}
    run(spark, tmp_path, fails_once, 20, 6)
    assert seen[3] == seen[2], "the failed step comes back with the same ids"
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    want, position = plain(files, 20, 6)
    assert sorted((r.source, r.payload, r.pos, r.file_name, r.start_offset, r.next_offset, r.doc) for r in rows) == want
    assert len({r.doc_id for r in rows}) == len(rows)
    found = durable.positions(spark, str(tmp_path / "check"))
    assert {r.source: (r.file_name, r.next_offset, r.payloads) for r in found.collect()} == position
    assert all(before[s] < position[s][:2] for s in position)
    assert {r.source: r.bookmark for r in durable.bookmarks(found).collect()} == {s: f"{end}:::{name}" for s, (name, end, _) in position.items()}


def test_lines_that_come_again(spark, tmp_path):
    """A second copy of lines at or before the position gives no row."""
    schema = "source string, file_name string, file_date string, seq long, start_offset long, next_offset long, line string"
    def put(name, rows):
        spark.createDataFrame([("s", "buf-20240101.json", "20240101", 0, at, at + 5, f"l{at}") for at in rows], schema).coalesce(1).write.parquet(str(tmp_path / "in" / name))
    put("one", range(0, 50, 5))
    put("two", range(30, 80, 5))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    jobs.drained(jobs.ship(durable.durable_stream(stream), lambda b: b, str(tmp_path / "out"), str(tmp_path / "check")))
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.start_offset for r in rows.collect()) == list(range(0, 80, 5))


def test_stored_lines(spark, tmp_path):
    lines = spark.range(100).select(F.concat(F.lit("s"), F.col("id") % 3).alias("source"), F.lit("buf-20240101.json").alias("file_name"), F.col("id"), F.col("id").cast("string").alias("line"))
    ordered.store_lines(lines, str(tmp_path / "in"), ["id"])
    rows = [r for step in steps(tmp_path / "in") for r in step]
    assert [r["line"] for r in rows if r["source"] == "s1"] == [str(i) for i in range(1, 100, 3)]


@pytest.mark.parametrize("limit", [1, 3, 7])
@pytest.mark.parametrize("most", [2, 5, 100])
def test_several_steps_in_a_batch(tmp_path, monkeypatch, limit, most):
    """A source that is behind takes more steps each time, up to the bound; lines have the steps that they have one by one."""
    monkeypatch.setattr(ordered, "BLOCK", 16)
    monkeypatch.setattr(ordered, "RANGE", 20)
    rng = random.Random(limit)
    fill(tmp_path / "in", [(f"{s}/buf-2024010{d}{q}.json", [b"l" * rng.randint(0, 9) for _ in range(rng.randint(0, 30))])
                           for s in ("a", "b/c") for d in (1, 2, 3) for q in ("", "_001")])

    def numbered(steps):
        reader = ordered.BufferReader({"path": str(tmp_path / "in"), "base": "buf", "lines": str(limit), "steps": str(steps), "bookmark": str(tmp_path / f"mark{steps}")})
        at, out = {}, []
        while (end := reader.latestOffset()) != at:
            out.append([r for p in reader.partitions(at, end) for b in reader.read(p) for r in b.to_pylist()])
            at = end
        return out

    one, several = numbered(1), numbered(most)
    key = lambda r: (r["source"], r["file_date"], r["seq"], r["start_offset"])
    assert sorted(sum(several, []), key=key) == sorted(sum(one, []), key=key)
    for source in ("a", "b/c"):
        lines = [r for r in sorted(sum(several, []), key=key) if r["source"] == source]
        assert [r["step"] for r in lines] == [i // limit for i in range(len(lines))]
        taken = [len({r["step"] for r in batch if r["source"] == source}) for batch in several]
        whole = [n for n in taken if n][:-1]  # the last batch has what is left
        assert whole == [min(2**i, most) for i in range(len(whole))]
    assert len(several) < len(one)


def test_steps_of_a_source_that_catches_up(tmp_path):
    """Once nothing is left, a source starts with one step again, in a batch and under a number of its own."""
    options = {"path": str(tmp_path / "in"), "base": "buf", "lines": "2", "steps": "8", "bookmark": str(tmp_path / "mark")}
    at, out = {}, []
    for day in (1, 2):
        fill(tmp_path / "in", [(f"buf-2024010{day}.json", [b"x"] * 5)])
        while (end := (reader := ordered.BufferReader(options)).latestOffset()) != at:  # each time a restart
            out.append([r["step"] for p in reader.partitions(at, end) for b in reader.read(p) for r in b.to_pylist()])
            at = end
    assert out == [[0, 0], [1, 1, 2], [3, 3], [4, 4, 5]]


def test_payloads_do_not_depend_on_steps_in_a_batch(spark, tmp_path):
    files = [(f"{s}/buf-2024010{d}.json", [b"l" * (i % 11) for i in range(50)]) for s in ("a", "b") for d in (1, 2)]
    fill(tmp_path / "in", files)
    stream = ordered.ordered_lines(spark, str(tmp_path / "in"), "buf", lines=20, bookmark=str(tmp_path / "mark"), steps=4)
    rows = durable.durable_stream(stream, batches=BatchOptions(posting_limit=6, event_bytes_limit=8))
    jobs.drained_steps(jobs.ship(rows, lambda b: b, str(tmp_path / "out"), str(tmp_path / "check"), seconds=0))
    found = spark.read.parquet(str(tmp_path / "out"))
    want, position = plain(files, 20, 6)
    assert sorted((r.source, r.payload, r.pos, r.file_name, r.start_offset, r.next_offset, r.doc) for r in found.collect()) == want
    assert found.select("batch").distinct().count() == 3
    assert {r.source: (r.file_name, r.next_offset, r.payloads) for r in durable.positions(spark, str(tmp_path / "check")).collect()} == position
