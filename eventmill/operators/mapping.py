"""Field types: inventory, first mapping wins, conflicts, dynamic and explicit rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.functions.jsontext import let
from eventmill.model import EXCEPTION
from eventmill.options import KEYWORD_LENGTH_LIMIT
from eventmill.session import BROADCAST_ROWS, attach, written

# Levels opened in one plan; deeper documents take another round.
LEVELS = 4


def field_type(kind: Column) -> Column:
    """The index type for the schema text of a variant; null for JSON null, which maps nothing."""
    return (
        F.when(kind == "STRING", "string").when(kind == "BIGINT", "long").when(kind == "BOOLEAN", "boolean")
        .when(kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "double").when(kind.rlike("^(OBJECT|ARRAY)"), "object"))


def field_values(documents: DataFrame, body: str, keys: Sequence[str], prefix: str = "") -> DataFrame:
    """One row per leaf of each JSON body: keys, ``path``, ``type``.

    Objects are opened level by level until none is left, ``LEVELS`` of them in
    one linear plan of lateral explodes; only what is still open goes on to the
    next round. Elements of an array count under the array's own path; an empty
    object or array is a leaf of type object.
    """
    rows = documents.select(*keys, F.lit(prefix).alias("path"), F.col(body).alias("body"))
    leaves = None
    while True:
        opened = written(_opened(rows, keys), "fields")
        found = opened.where("body IS NULL").select(*keys, "path", "type").filter("type IS NOT NULL")
        leaves = found if leaves is None else leaves.unionAll(found)
        rows = opened.where("body IS NOT NULL").select(*keys, "path", "body")
        if rows.isEmpty():
            return leaves


def _opened(documents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, path, type, body) after ``LEVELS`` levels; ``body`` is the JSON text of what is still an object or array."""
    spark = documents.sparkSession

    def described(rows: DataFrame, path: Column, value: Column) -> DataFrame:
        rows = rows.select(*keys, path.alias("_path"), value.alias("_value"))
        return rows.withColumn("_kind", F.schema_of_variant("_value"))

    nested = F.col("_kind").startswith("OBJECT") | F.col("_kind").startswith("ARRAY")
    rows = described(documents, F.col("path"), F.try_parse_json("body"))
    for _ in range(LEVELS):
        rows = rows.lateralJoin(spark.tvf.variant_explode_outer(F.when(nested, F.col("_value")).outer()))
        name = F.when(F.col("key").isNull(), F.col("_path")).when(F.col("_path") == "", F.col("key")).otherwise(
            F.concat(F.col("_path"), F.lit("."), F.col("key")))
        rows = described(rows, name, F.coalesce(F.col("value"), F.col("_value")))
    filled = nested & ~F.to_json("_value").isin("{}", "[]")
    return rows.select(*keys, F.col("_path").alias("path"), field_type(F.col("_kind")).alias("type"), F.when(filled, F.to_json("_value")).alias("body"))


def inventory(fields: DataFrame) -> DataFrame:
    """Paths, their types, and how often each occurs."""
    return fields.groupBy("path", "type").agg(F.count(F.lit(1)).alias("n"))


def first_mappings(fields: DataFrame, order: Sequence[str]) -> DataFrame:
    """Per index and path, the type seen first; partial aggregation keeps a busy index spread."""
    return fields.groupBy("index", "path").agg(F.min_by("type", F.struct(*order)).alias("mapped_type"))


def summary(fields: DataFrame, order: Sequence[str]) -> DataFrame:
    """``(index, path, type, first, n)`` of leaves ``(index, path, type, *order)``; partial aggregation keeps a busy index spread."""
    return fields.groupBy("index", "path", "type").agg(F.min(F.struct(*order)).alias("first"), F.count(F.lit(1)).alias("n"))


def merged(one: DataFrame, other: DataFrame) -> DataFrame:
    """The summary of the documents of both."""
    return one.unionByName(other).groupBy("index", "path", "type").agg(F.min("first").alias("first"), F.sum("n").alias("n"))


def mappings(known: DataFrame) -> DataFrame:
    """``(index, path, mapped_type, mixed)``: the type seen first, and whether there are others."""
    return known.groupBy("index", "path").agg(
        F.min_by("type", F.struct("first", "type")).alias("mapped_type"), (F.count(F.lit(1)) > 1).alias("mixed"))


def conflicting(fields: DataFrame, known: DataFrame, event_key: str = "event_id", max_broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Leaves whose type is not the mapping of their path. Only paths with several types reach the join."""
    mixed = mappings(known).where("mixed").select("index", "path", "mapped_type")
    joined = attach(fields, mixed, ["index", "path"], "inner", spread_by=event_key, max_broadcast_rows=max_broadcast_rows, label="mappings")
    return joined.filter(F.col("type") != F.col("mapped_type"))


def conflicts(
    fields: DataFrame, order: Sequence[str], event_key: str = "event_id", max_broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Field values whose type is not the one mapped first: the leaves are summed up once, then looked up once."""
    return conflicting(fields, written(summary(fields, order), "summary"), event_key, max_broadcast_rows)


def rejected_documents(conflicting: DataFrame, event_key: str = "event_id") -> DataFrame:
    """Conflicts as failed items: one per event, for the failure routes."""
    reason = F.concat(F.lit("failed to parse field ["), F.col("path"), F.lit("] of type ["), F.col("mapped_type"), F.lit("]"))
    error = F.struct(F.lit("mapper_parsing_exception").alias("type"), reason.alias("reason"))
    return conflicting.groupBy(event_key, "index").agg(F.min_by(error, "path").alias("error")).withColumn("status", F.lit(400))


@dataclass(frozen=True)
class DynamicRule:
    """A dynamic mapping: by path pattern or value type, giving a mapped type and maybe an exact-match subfield."""

    name: str
    mapped_type: str
    path_regex: str | None = None
    value_type: str | None = None
    raw_limit: int | None = None


# The default rules, in order. The pattern is one character wide.
DEFAULT_RULES = (
    DynamicRule("numerics_in_fields", "text", path_regex=r"^fields\.[\d+]$"),
    DynamicRule("string_fields", "text", value_type="string", raw_limit=KEYWORD_LENGTH_LIMIT),
)


def _matches(rule: DynamicRule, path: Column, kind: Column) -> Column:
    test = F.lit(True)
    if rule.path_regex is not None:
        test = test & path.rlike(rule.path_regex)
    if rule.value_type is not None:
        test = test & (kind == rule.value_type)
    return test


def dynamic_mapping(path: Column, kind: Column, rules: Sequence[DynamicRule] = DEFAULT_RULES) -> Column:
    """The first rule that matches, as ``struct<rule, type, raw_limit>``; without one the value's own type.

    Rules are configuration, so they become one expression instead of a join.
    """
    def result(name: str | None, mapped: Column, limit: int | None) -> Column:
        return F.struct(
            F.lit(name).cast("string").alias("rule"), mapped.alias("type"), F.lit(limit).cast("int").alias("raw_limit"))

    chosen = [F.when(_matches(r, path, kind), result(r.name, F.lit(r.mapped_type), r.raw_limit)) for r in rules]
    return F.coalesce(*chosen, result(None, kind, None))


# The fields that must be integers.
INTEGER_FIELDS = ("Depth", "RemoteStackIndex", "HResult")
_LOOSE = "array<struct<Depth:variant,RemoteStackIndex:variant,HResult:variant,ExceptionMethod:struct<MemberType:variant>>>"


def explicit_mapping(body: Column) -> Column:
    """Message and exceptions of a document under their explicit types, and whether every value fitted."""
    parsed = F.try_parse_json(body)
    return let(
        F.struct(
            F.try_variant_get(parsed, "$.message", "string").alias("message"),
            F.try_variant_get(parsed, "$.exceptions", f"array<{EXCEPTION}>").alias("exceptions"),
            F.try_variant_get(parsed, "$.exceptions", _LOOSE).alias("loose")),
        lambda m: F.struct(m["message"].alias("message"), m["exceptions"].alias("exceptions"),
                           (~F.coalesce(_lost_value(m), F.lit(False))).alias("fits")))


def _lost_value(mapped: Column) -> Column:
    def lost(loose: Column, typed: Column) -> Column:
        return loose.isNotNull() & ~F.is_variant_null(loose) & typed.isNull()

    def differs(pair: Column) -> Column:
        loose, typed = pair["loose"], pair["typed"]
        any_lost = lost(loose["ExceptionMethod"]["MemberType"], typed["ExceptionMethod"]["MemberType"])
        for name in INTEGER_FIELDS:
            any_lost = any_lost | lost(loose[name], typed[name])
        return any_lost

    pairs = F.zip_with(mapped["loose"], mapped["exceptions"],
                       lambda loose, typed: F.struct(loose.alias("loose"), typed.alias("typed")))
    return F.exists(pairs, lambda pair: F.coalesce(differs(pair), F.lit(False)))


def raw_keyword(value: Column, limit: int = KEYWORD_LENGTH_LIMIT) -> Column:
    """The exact-match subfield; absent for a longer value."""
    return F.when(F.length(value) <= limit, value)


def field_counts(fields: DataFrame, limit: int) -> DataFrame:
    """Distinct paths per index against the limit; paths are made unique before they are counted."""
    unique = fields.select("index", "path").distinct()
    counts = unique.groupBy("index").agg(F.count(F.lit(1)).alias("n_fields"))
    return counts.withColumn("over_limit", F.col("n_fields") > limit)
