"""Line deduplication over overlapping windows of three lines.

Each run of three consecutive lines is hashed to 128 bits. A window that occurs
again anywhere in the corpus is a later occurrence wherever it is not the first
one (by document, then position); the lines that later occurrences cover are
removed, overlapping windows merged. Only hashes and positions are shuffled to
find repeats: they are counted with partial aggregation, and just the windows
that repeat are joined back, a join that Spark splits where a window is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.llm.common import whole_text

WINDOW_LINES = 3


def windows(docs: DataFrame, size: int = WINDOW_LINES) -> DataFrame:
    """(doc_id, text_hash, pos, h1, h2): one row for each run of ``size`` lines; shorter texts have none.

    ``text_hash`` tells apart different texts under one id. A window of blank
    lines alone is none.
    """
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.split("text", "\n", -1).alias("lines")).where(F.size("lines") >= size)
    starts = F.sequence(F.lit(0), F.size("lines") - size)

    def hashed(start: Column) -> Column:
        parts = [F.col("lines")[start + i] for i in range(size)]
        filled = F.length(F.trim(F.concat_ws("", *parts))) > 0
        return F.struct(start.alias("pos"), F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit("second"), *parts).alias("h2"), filled.alias("filled"))

    return lines.select("doc_id", "text_hash", F.inline(F.transform(starts, hashed))).where("filled").drop("filled")


def covered_lines(docs: DataFrame, size: int = WINDOW_LINES) -> DataFrame:
    """(doc_id, text_hash, covered): the sorted positions of lines that later occurrences of a window cover."""
    rows = windows(docs, size)
    where = F.struct("doc_id", "text_hash", "pos")
    repeated = rows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(where).alias("first")).where("n > 1").drop("n")
    later = rows.join(repeated, ["h1", "h2"]).where(where > F.col("first"))
    return later.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("starts")).select(
        "doc_id", "text_hash",
        F.array_sort(F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s, s + (size - 1)))))).alias("covered"))


def without_lines(text: Column, covered: Column) -> Column:
    """The text without the lines at the sorted positions ``covered``: what lies between them, joined again."""
    lines = F.split(text, "\n", -1)
    bounds = F.concat(F.array(F.lit(-1)), covered, F.array(F.size(lines)))

    def between(last: Column, i: Column) -> Column:
        return F.slice(lines, last + 2, F.element_at(bounds, i + 2) - last - 1)

    return F.array_join(F.flatten(F.transform(F.slice(bounds, F.lit(1), F.size(bounds) - 1), between)), "\n")


def drop_repeated_lines(docs: DataFrame, size: int = WINDOW_LINES) -> DataFrame:
    """``docs`` with shortened texts, and n_lines_before and n_removed (long).

    A document without a later occurrence keeps its text unchanged, a missing
    text stays missing. Rows alike in id and text count as one document: none
    is a later occurrence of the other. A missing id comes before all others.
    All columns of ``docs`` are kept, but for former columns of the two new names.
    """
    names = [c for c in docs.columns if c not in ("n_lines_before", "n_removed")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    covered = covered_lines(rows, size).select(
        F.struct("doc_id", "text_hash").alias("_whose"), F.col("covered").alias("_covered"))
    key = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(whole_text()).alias("text_hash"))
    joined = docs.select(F.struct(*names).alias("_doc"), key.alias("_whose")).join(covered, "_whose", "left")
    text, n = F.col("_doc.text"), F.coalesce(F.size("_covered"), F.lit(0)).cast("long")
    new = F.when(F.col("_covered").isNull(), text).otherwise(without_lines(whole_text(text), F.col("_covered")))
    return joined.select(
        *(new.alias("text") if c == "text" else F.col("_doc")[c].alias(c) for c in names),
        F.when(whole_text(text) == "", 0).otherwise(F.size(F.split(text, "\n", -1))).cast("long").alias("n_lines_before"),
        F.when(F.col("_covered").isNull(), F.lit(0)).otherwise(n).cast("long").alias("n_removed"))
