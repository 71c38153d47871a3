"""Rolling buffer files: listing, lines with byte positions, resuming from bookmarks."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.functions.times import ROLLING_INTERVALS
from eventmill.operators.retention import ordered_files
from eventmill.operators.running import running
from eventmill.session import attach, prepare

# Bytes of a byte order mark, and what separates the parts of a bookmark.
BOM_BYTES = 3
BOOKMARK_SEPARATOR = ":::"


def stored_files(spark: SparkSession, folder: str, base: str) -> DataFrame:
    """Names, sizes and times of the files of a folder; contents are not read."""
    files = prepare(spark).read.format("binaryFile").option("pathGlobFilter", f"{base}-*.json").load(folder)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"))


def file_pattern(base: str, interval: str = "Day") -> str:
    """The names of one interval's files only; a sequence has three digits or more."""
    digits = ROLLING_INTERVALS[interval][1]
    return rf"^{re.escape(base)}-(\d{{{digits}}})(_\d{{3,}})?\.json$"


def listed(files: DataFrame, base: str, interval: str = "Day", name: str = "file_name") -> DataFrame:
    """Files of the interval with ``file_date`` and numeric ``seq`` (none is 0)."""
    pattern = file_pattern(base, interval)
    sequence = F.regexp_replace(F.regexp_extract(name, pattern, 2), "_", "")
    return files.filter(F.col(name).rlike(pattern)).withColumns({
        "file_date": F.regexp_extract(name, pattern, 1),
        "seq": F.coalesce(sequence.try_cast("bigint"), F.lit(0)),
    })


def ranked(files: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Listed files with ``rank`` in reading order: by date text, then sequence."""
    return ordered_files(files, keys or [], "file_date", [F.col("seq")], newest_first=False)


def stored_lines(spark: SparkSession, folder: str, base: str, newline: str = "\n") -> DataFrame:
    """Lines of buffer files with ``line_no``-like order and the file split they came from."""
    text = prepare(spark).read.option("pathGlobFilter", f"{base}-*.json").option("lineSep", newline).text(folder)
    return text.select(
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line_order"),
        F.regexp_replace("value", r"^\uFEFF", "").alias("line"))


def with_offsets(
    lines: DataFrame, keys: list[str], order: list[str], line: str = "line", assume_bom: bool = True,
    newline: str = "\n", chunk: Column | None = None,
) -> DataFrame:
    """Adds ``start_offset`` and ``next_offset``: UTF-8 bytes of the line and the newline, and the mark at the start.

    ``chunk`` splits a file into pieces summed side by side: the file split for
    stored lines, or :func:`running.plan_chunks` for lines of a table.
    """
    width = F.octet_length(line).cast("bigint") + len(newline.encode())
    mark = BOM_BYTES if assume_bom else 0
    out = running(lines, keys, order, sums={"_end": width}, chunk=chunk)
    start = F.col("_end") - width
    return out.withColumns({
        "start_offset": F.when(start == 0, 0).otherwise(start + mark),
        "next_offset": F.col("_end") + mark,
    }).drop("_end")


def stored_lines_with_offsets(
    spark: SparkSession, folder: str, base: str, assume_bom: bool = True, newline: str = "\n"
) -> DataFrame:
    """Stored lines with byte positions. A large file is summed split by split."""
    lines = stored_lines(spark, folder, base, newline)
    return with_offsets(lines, ["file_name"], ["line_order"], assume_bom=assume_bom, newline=newline, chunk=F.col("split")).drop(
        "split", "line_order")


def bookmark_position(bookmark: Column) -> Column:
    """``struct<offset, file>`` of ``offset:::file``; null when it is malformed."""
    parts = F.filter(F.split(bookmark, BOOKMARK_SEPARATOR), lambda p: p != "")
    offset = F.get(parts, F.lit(0)).try_cast("bigint")
    return F.when((F.size(parts) == 2) & offset.isNotNull(), F.struct(offset.alias("offset"), F.get(parts, F.lit(1)).alias("file")))


def resumed(lines: DataFrame, files: DataFrame, bookmarks: DataFrame, source: str = "source", line_key: str = "event_id") -> DataFrame:
    """Lines at or after their source's bookmark.

    ``lines`` have ``(source, file_date, seq, start_offset)``, ``files`` the
    catalog with ``file_name``, ``bookmarks`` one ``bookmark`` per source. A
    missing or malformed bookmark, or one of an unknown file, starts from the first line.
    """
    position = bookmarks.select(source, bookmark_position(F.col("bookmark")).alias("_at")).select(
        source, F.col("_at.offset").alias("_offset"), F.col("_at.file").alias("file_name"))
    known = position.join(files.select(source, "file_name", "file_date", "seq"), [source, "file_name"]).select(
        source, F.struct(F.col("file_date"), F.col("seq"), F.col("_offset").alias("start_offset")).alias("_from"))
    joined = attach(lines, known, [source], spread_by=line_key, label="bookmarks")
    here = F.struct("file_date", "seq", "start_offset")
    return joined.filter(F.col("_from").isNull() | (here >= F.col("_from"))).drop("_from")
