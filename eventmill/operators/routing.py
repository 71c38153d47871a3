"""Target choice per event: index, pipeline, type name, covering template."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.functions.times import file_date, formatted_name
from eventmill.options import DEFAULT_INDEX_FORMAT, DEFAULT_TYPE_NAME, RouteOptions
from eventmill.session import BROADCAST_ROWS, attach, written

# What to do when a template could not be registered.
INDEX_ANYWAY = "IndexAnyway"
INDEX_TO_DEAD_LETTER = "IndexToDeadletterIndex"
FAIL_SINK = "FailSink"
# Fixed value: types are gone from this major version on.
FIRST_TYPELESS_MAJOR = 7


def index_name(ts: Column, index_format: str = DEFAULT_INDEX_FORMAT) -> Column:
    """The index for a UTC time, in lower case."""
    return F.lower(formatted_name(index_format, ts))


def decided_index(ts: Column, options: RouteOptions = RouteOptions(), decider: Column | None = None) -> Column:
    """A caller's own index expression, taken as it is, or the formatted name."""
    return decider if decider is not None else index_name(ts, options.index_format)


def buffered_index(file_name: Column, interval: str = "Day", index_format: str = DEFAULT_INDEX_FORMAT) -> Column:
    """The index for a buffered line: the date of its file; null for a file without one."""
    return index_name(file_date(file_name, interval), index_format)


def blank_to_null(text: Column) -> Column:
    return F.when(F.trim(text) != "", text)


def pipeline_name(default: str | None, decider: Column | None = None) -> Column:
    """The decider's pipeline, else the default; a blank one means none."""
    fallback = F.lit(default).cast("string")
    return blank_to_null(fallback if decider is None else F.coalesce(decider, fallback))


def type_name(version: Column, configured: Column) -> Column:
    """The document type: configured or the default before version 7, none from then on."""
    major = F.substring_index(version, ".", 1).try_cast("int")
    return F.when(major < FIRST_TYPELESS_MAJOR, F.coalesce(blank_to_null(configured), F.lit(DEFAULT_TYPE_NAME)))


@dataclass(frozen=True)
class Routed:
    """Events with their index, and those that a failed sink does not send."""

    sent: DataFrame
    failed: DataFrame


def route_to_targets(
    events: DataFrame, targets: DataFrame, options: RouteOptions = RouteOptions(), decider: Column | None = None
) -> Routed:
    """Index per event given its target's registration state.

    ``targets`` is a short literal table (one row per destination), which Spark
    broadcasts by its known size. The dead-letter name keeps its case.
    """
    joined = events.join(targets, "target", "left")
    lost = ~F.coalesce(F.col("registration_ok"), F.lit(True))
    index = F.when(
        lost & (F.col("recovery") == INDEX_TO_DEAD_LETTER), formatted_name(options.dead_letter_format, F.col("ts"))
    ).otherwise(decided_index(F.col("ts"), options, decider))
    fails = lost & (F.col("recovery") == FAIL_SINK)
    return Routed(
        joined.filter(~F.coalesce(fails, F.lit(False))).withColumn("index", index),
        joined.filter(F.coalesce(fails, F.lit(False))))


@dataclass(frozen=True)
class IndexTemplate:
    """A template and the index names it covers."""

    name: str
    pattern: str
    priority: int = 0


def covers(index: Column, pattern: str) -> Column:
    """Whether a wildcard pattern covers an index name."""
    regex = "".join(".*" if part == "*" else rf"\Q{part}\E" for part in _wildcard_parts(pattern))
    return index.rlike(f"^{regex}$")


def _wildcard_parts(pattern: str) -> list[str]:
    pieces = pattern.split("*")
    return [part for i, piece in enumerate(pieces) for part in ([piece] if i == 0 else ["*", piece]) if part]


def best_template(index: Column, templates: Sequence[IndexTemplate]) -> Column:
    """The covering template of highest priority, ties by name; null without one.

    Templates are configuration, so they become one expression: no join, and
    nothing that multiplies rows.
    """
    ranked = sorted(templates, key=lambda t: (-t.priority, t.name))
    return F.coalesce(*[F.when(covers(index, t.pattern), t.name) for t in ranked], F.lit(None).cast("string"))


def like_pattern(pattern: Column) -> Column:
    """The LIKE pattern of a wildcard pattern in a column."""
    for mark in ("\\", "%", "_"):
        pattern = F.replace(pattern, F.lit(mark), F.lit("\\" + mark))
    return F.replace(pattern, F.lit("*"), F.lit("%"))


def best_templates(indices: DataFrame, templates: DataFrame, index: str = "index", max_broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Adds ``template``, as :func:`best_template`, for any number of ``templates(name, pattern, priority)``.

    The part of a pattern before its first wildcard is its head. Index names are
    few beside their rows, so each different name is worked on once: of its
    prefixes, those of a length that some head has are looked up among the heads,
    level by level of a prefix tree held as a table, and only patterns found
    there are tried.
    """
    heads = templates.select("name", "pattern", "priority", F.substring_index("pattern", "*", 1).alias("_head"))
    heads = written(heads, "templates")
    lengths = sorted(row[0] for row in heads.select(F.length("_head")).distinct().collect())  # at most as many as a name has characters
    names = written(indices.select(index).distinct(), "names").filter(F.col(index).isNotNull())
    inside = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length(index)) if lengths else F.array().cast("array<int>")
    prefixes = names.select(index, F.explode(F.transform(inside, lambda n: F.substring(F.col(index), F.lit(1), n))).alias("_head"))
    tried = attach(prefixes, heads, ["_head"], "inner", spread_by=index, max_broadcast_rows=max_broadcast_rows, label="heads")
    found = tried.filter(F.like(F.col(index), like_pattern(F.col("pattern"))))
    best = found.groupBy(index).agg(F.min_by("name", F.struct(-F.col("priority"), "name")).alias("template"))
    return attach(indices, best, [index], spread_by=index, max_broadcast_rows=max_broadcast_rows, label="best-templates")
