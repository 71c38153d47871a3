"""Buffer files as a stream of lines: oldest file first by date and sequence, so many lines at a time, from byte positions.

``spark.readStream.format("buffer_files")``. A folder holds one folder of rolling
files per source (or the files of one source). What has been read of a source is a
position: file and byte. Times of files play no part. The offset of a step also
names the files it passes with their sizes, so a step that is run again reads the
same lines, whatever has come to the folder since.

A step is so many lines of a source, numbered from 0. A source that is behind may
have several in a batch of the stream: one at first, then twice as many each time,
up to a bound. Every line tells its step, so what is made of the lines is the same
in however many batches they come.

The driver looks for line ends only, block by block; lines are read by tasks, each
from a range of bytes that starts and ends with a line.
"""

from __future__ import annotations

import json
import posixpath
import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from eventmill.session import prepare
from eventmill.sources.buffer import file_pattern

BYTE_ORDER_MARK = b"\xef\xbb\xbf"
BLOCK = 1 << 20
#: Bytes of a file that a task reads.
RANGE = 64 << 20
#: Sources that the driver looks at side by side.
THREADS = 16
LINES = "source string, file_name string, file_date string, seq long, start_offset long, next_offset long, line string, step long"


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path there."""
    return fs.FileSystem.from_uri(path) if re.match(r"^\w+:/", path) else (fs.LocalFileSystem(), path)


def put(store: fs.FileSystem, path: str, content: bytes) -> None:
    """Write a small file so that readers see the whole of it or none."""
    new = f"{path}.new"
    with store.open_output_stream(new) as out:
        out.write(content)
    store.move(new, path)


def lines_end(file: pa.NativeFile, start: int, size: int, lines: int | None) -> tuple[int, int]:
    """Where ``lines`` lines from ``start`` end (all whole lines without a limit), and how many there are; an open last line is left."""
    file.seek(start)
    at = end = start
    count = 0
    while at < size and (lines is None or count < lines):
        block = file.read(min(BLOCK, size - at))
        if not block:
            break
        found = block.count(b"\n")
        if lines is not None and count + found > lines:
            place = -1
            for _ in range(lines - count):
                place = block.find(b"\n", place + 1)
            return at + place + 1, lines
        if found:
            end = at + block.rfind(b"\n") + 1
        count += found
        at += len(block)
    return end, count


def last_line_end(file: pa.NativeFile, start: int, size: int) -> int:
    """Where the last whole line before ``size`` ends, looked for from behind."""
    at = size
    while at > start:
        begin = max(start, at - BLOCK)
        file.seek(begin)
        place = file.read(at - begin).rfind(b"\n")
        if place >= 0:
            return begin + place + 1
        at = begin
    return start


@dataclass
class Range(InputPartition):
    """Bytes of one file, from the start of a line to the end of one."""

    source: str
    file_name: str
    file_date: str
    seq: int
    path: str
    start: int
    end: int
    #: The first step of its batch, and how many lines of the source the batch has before.
    step: int = 0
    place: int = 0


class BufferReader(DataSourceStreamReader):
    """Positions are ``{source: {file, date, seq, at, passed: {file: size}, counts: {file: lines}, done, took}}``.

    ``done`` counts the steps up to there; ``took`` is how many its batch had, 0 if there was nothing left for more.
    """

    def __init__(self, options: dict[str, str]):
        self.folder = options["path"].rstrip("/")
        self.pattern = re.compile(file_pattern(options["base"], options.get("interval", "Day")))
        self.lines = int(options["lines"]) if options.get("lines") else None
        self.steps = int(options.get("steps") or 1)
        self.bookmark = options.get("bookmark")
        if self.lines is not None and (self.lines < 1 or not self.bookmark):
            raise ValueError("lines must be at least 1, and a limit of lines needs the path of a bookmark")
        if self.steps < 1:
            raise ValueError("steps must be at least 1")
        self.at: dict | None = None

    def initialOffset(self) -> dict:
        return {}

    def position(self) -> dict:
        """The end of the last planned step: of this run, or by its bookmark of the run before."""
        if self.at is None and self.bookmark:
            store, path = store_of(self.bookmark)
            if store.get_file_info(path).type == fs.FileType.File:
                with store.open_input_stream(path) as file:
                    self.at = json.loads(file.read())
        return self.at or {}

    def files(self) -> dict[str, list[tuple[str, int, str, int]]]:
        """(date, sequence, name, size) of the files of each source, in reading order."""
        store, root = store_of(self.folder)
        found: dict[str, list] = {}
        for info in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            name = posixpath.basename(info.path)
            match = self.pattern.match(name)
            if info.type == fs.FileType.File and match:
                source = posixpath.relpath(posixpath.dirname(info.path), root)
                found.setdefault("" if source == "." else source, []).append((match[1], int((match[2] or "_0")[1:]), name, info.size))
        return {source: sorted(files) for source, files in found.items()}

    def path(self, source: str, name: str) -> str:
        return posixpath.join(store_of(self.folder)[1], source, name)

    def next_position(self, source: str, files: list[tuple[str, int, str, int]], before: dict | None) -> dict | None:
        """How far a source may be read now; nothing new leaves it where it was."""
        here = (before["date"], before["seq"]) if before else ("", -1)
        done, took = (before.get("done", 0), before.get("took", 0)) if before else (0, 0)
        steps = max(1, min(self.steps, 2 * took))
        store, left, passed, counts, now = store_of(self.folder)[0], self.lines and self.lines * steps, {}, {}, before
        ahead = [f for f in files if f[:2] >= here]
        for number, (date, seq, name, size) in enumerate(ahead):
            start = before["at"] if before and here == (date, seq) else 0
            closed = number + 1 < len(ahead)  # the writer has moved on
            with store.open_input_file(self.path(source, name)) as file:
                end, count = (last_line_end(file, start, size), 0) if left is None else lines_end(file, start, size, left)
                if closed and end < size and (left is None or count < left):
                    end, count = size, count + 1  # its last line is whole without a line end
            if left is not None:
                left -= count
            counts[name] = count
            if closed and end == size and left != 0:
                passed[name] = size
                continue
            if end > start or passed:
                new = -(-sum(counts.values()) // self.lines) if self.lines else 1
                now = {"file": name, "date": date, "seq": seq, "at": end, "passed": passed, "counts": counts, "done": done + new, "took": 0 if left else steps}
            break
        return now

    def latestOffset(self) -> dict:
        before, files = self.position(), self.files()
        with ThreadPoolExecutor(THREADS) as pool:
            after = pool.map(lambda source: self.next_position(source, files[source], before.get(source)), files)
            moved = {source: position for source, position in zip(files, after) if position}
        return before | moved

    def partitions(self, start: dict, end: dict) -> list[Range]:
        self.at = end
        if self.bookmark:
            put(*store_of(self.bookmark), json.dumps(end).encode())
        store, out = store_of(self.folder)[0], []
        for source, position in sorted(end.items()):
            before = start.get(source)
            if before == position:
                continue
            ends = position["passed"] | {position["file"]: position["at"]}
            step, place = before.get("done", 0) if before else 0, 0
            for name, last in ends.items():
                match = self.pattern.match(name)
                at = before["at"] if before and before["file"] == name else 0
                path, behind = self.path(source, name), place + position.get("counts", {}).get(name, 0)
                with store.open_input_file(path) as file:
                    while at < last:
                        cut = last
                        if last - at > RANGE:
                            end_of_line, found = lines_end(file, at + RANGE - 1, last, 1)
                            cut = end_of_line if found else last
                        out.append(Range(source, name, match[1], int((match[2] or "_0")[1:]), path, at, cut, step, place))
                        if cut < last and self.lines:
                            place += lines_end(file, at, cut, None)[1]
                        at = cut
                place = behind
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        with store_of(self.folder)[0].open_input_file(partition.path) as file:
            file.seek(partition.start)
            at, left, rest, place = partition.start, partition.end - partition.start, b"", partition.place
            while left > 0:
                block = file.read(min(max(BLOCK, len(rest)), left))
                left = left - len(block) if block else 0
                begin = at
                *lines, rest = (rest + block).split(b"\n")
                ends = [at := at + len(line) + 1 for line in lines]
                if not left and rest and (at or rest != BYTE_ORDER_MARK):  # the last line of a file that its writer has left
                    lines.append(rest)
                    ends.append(at := at + len(rest))
                if lines:
                    yield self.batch(partition, lines, [begin, *ends[:-1]], ends, place)
                    place += len(lines)

    def batch(self, partition: Range, lines: list[bytes], starts: list[int], ends: list[int], place: int) -> pa.RecordBatch:
        if starts[0] == 0 and lines[0].startswith(BYTE_ORDER_MARK):
            lines[0] = lines[0][len(BYTE_ORDER_MARK):]
        n = len(lines)
        texts = [line.removesuffix(b"\r").decode("utf-8", "replace") for line in lines]
        steps = [partition.step + i // self.lines for i in range(place, place + n)] if self.lines else [partition.step] * n
        columns = [[partition.source] * n, [partition.file_name] * n, [partition.file_date] * n, [partition.seq] * n, starts, ends, texts, steps]
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [f.split()[0] for f in LINES.split(", ")])


class BufferFiles(DataSource):
    """Options: ``path``, ``base``; ``interval`` (Day); ``lines`` per source and step, with the path of a ``bookmark``; ``steps`` in a batch at most (1)."""

    @classmethod
    def name(cls) -> str:
        return "buffer_files"

    def schema(self) -> str:
        return LINES

    def streamReader(self, schema) -> BufferReader:
        return BufferReader(dict(self.options))


def ordered_lines(
    spark: SparkSession, folder: str, base: str, interval: str = "Day", lines: int | None = None, bookmark: str | None = None, steps: int = 1,
) -> DataFrame:
    """The stream of ``LINES``. With a limit, give each query a ``bookmark`` of its own beside its checkpoint.

    The bookmark tells a restarted query where its last step ends, as Spark does
    not tell the source before it asks how far to read. ``steps``: how many steps
    of a source that is behind a batch may hold, ``lines`` each.
    """
    prepare(spark).dataSource.register(BufferFiles)
    reader = spark.readStream.format("buffer_files").option("path", folder).option("base", base).option("interval", interval)
    if lines is not None:
        reader = reader.option("lines", lines).option("bookmark", bookmark or "").option("steps", steps)
    return reader.load()


def store_lines(lines: DataFrame, folder: str, order: list[str], source: str = "source", mark: bool = True) -> None:
    """Write ``(source, file_name, line)`` as rolling files, each whole file in its order by one task, with a byte order mark.

    Rolling files are small by what they are for; a file here is what one writer wrote.
    """
    def write(rows) -> None:
        store, root = store_of(folder)
        out, current = None, None
        for row in rows:
            if (row[0], row[1]) != current:
                if out:
                    out.close()
                current = (row[0], row[1])
                store.create_dir(posixpath.join(root, row[0]), recursive=True)
                out = store.open_output_stream(posixpath.join(root, row[0], row[1]))
                if mark:
                    out.write(BYTE_ORDER_MARK)
            out.write(row[2].encode() + b"\n")
        if out:
            out.close()

    lines.select(source, "file_name", "line", *order).repartition(source, "file_name").sortWithinPartitions(source, "file_name", *order).foreachPartition(write)
