"""Assembling JSON text from native expressions, keeping member order."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHOW_NULLS = {"ignoreNullFields": "false"}
# Fixed value: the member that names a structure's type; it comes first.
TYPE_TAG = "_typeTag"
# Text that is the same inside a JSON string: no quote, backslash or control character.
PLAIN_TEXT = r'^[^"\\\x00-\x1f]*\z'


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` computed once; inside lambdas Spark does not share subexpressions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def inside(text: Column) -> Column:
    """``{...}`` or ``[...]`` without its outer pair; null when nothing is inside."""
    return let(text, lambda t: F.when(F.length(t) > 2, F.substring(t, F.lit(2), F.length(t) - 2)))


def string_json(value: Column) -> Column:
    """An escaped JSON string, or ``null``. Most text needs no escapes and is only quoted."""
    return F.when(value.rlike(PLAIN_TEXT), F.concat(F.lit('"'), value, F.lit('"'))).otherwise(
        F.coalesce(F.to_json(value.cast("variant")), F.lit("null")))


def number_json(value: Column) -> Column:
    """Plain text of a double: ``2`` rather than ``2.0``, no exponent within usual sizes."""
    size = F.abs(value)
    short = value.cast("string")
    plain = F.regexp_replace(short.try_cast("decimal(38,20)").cast("string"), "0+$", "")
    return (
        F.when(value.isNull(), "null")
        .when(F.isnan(value) | (size == float("inf")), F.concat(F.lit('"'), short, F.lit('"')))
        .when((size < 1e15) & (value == F.floor(value)), value.cast("bigint").cast("string"))
        .when((size >= 1e-3) & (size < 1e7), short)
        .when((size >= 1e-5) & (size < 1e15), F.coalesce(plain, short))
        .otherwise(short)
    )


def integer_json(value: Column) -> Column:
    """Text of an integer or decimal, or ``null``."""
    return F.coalesce(value.cast("string"), F.lit("null"))


def member(name: str, value: Column) -> Column:
    """``"name":value``; null (and so left out by :func:`object_json`) when ``value`` is null."""
    return F.concat(F.lit(json.dumps(name) + ":"), value)


def object_json(*members: Column) -> Column:
    """An object of the members that are not null."""
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def fields_members(fields: Column) -> Column:
    """A ``map<name, JSON text>`` as the members of an object; null when it is empty."""
    pairs = F.transform(F.map_entries(fields), lambda e: F.concat(string_json(e["key"]), F.lit(":"), e["value"]))
    return F.nullif(F.array_join(pairs, ","), F.lit(""))


def fields_json(fields: Column) -> Column:
    """A ``map<name, JSON text>`` as one object; null when it is empty."""
    return F.concat(F.lit("{"), fields_members(fields), F.lit("}"))


def dynamic_fields(properties: Column) -> Column:
    """Properties given as JSON text, as ``map<name, JSON text>``."""
    parsed = F.try_parse_json(properties).try_cast("map<string,variant>")
    return F.transform_values(parsed, lambda _, value: F.coalesce(F.to_json(value), F.lit("null")))


def merged_maps(first: Column, second: Column) -> Column:
    """Both maps in one; a name in ``first`` wins, a missing ``second`` adds nothing."""
    def join(f: Column) -> Column:
        return let(second, lambda s: F.when(s.isNull(), f).otherwise(
            F.map_concat(f, F.map_filter(s, lambda name, _: ~F.map_contains_key(f, name)))))

    return let(first, join)


def value_json(value: Column, kind: T.DataType) -> Column:
    """JSON text of a value of any Spark type, everything in its own order.

    A structure with a field ``_typeTag`` writes it first, and leaves it out
    when it is null; keys of a dictionary are quoted whatever their type; a
    missing value is ``null``.
    """
    if isinstance(kind, T.StructType):
        named = sorted(kind.fields, key=lambda f: f.name != TYPE_TAG)  # the sort is stable: the others keep their order
        members = [F.when(value[f.name].isNotNull(), member(f.name, value_json(value[f.name], f.dataType))) if f.name == TYPE_TAG
                   else member(f.name, value_json(value[f.name], f.dataType)) for f in named]
        text = object_json(*members)
    elif isinstance(kind, T.ArrayType):
        text = F.concat(F.lit("["), F.array_join(F.transform(value, lambda x: value_json(x, kind.elementType)), ","), F.lit("]"))
    elif isinstance(kind, T.MapType):
        pairs = F.transform(F.map_entries(value), lambda e: F.concat(
            string_json(e["key"].cast("string")), F.lit(":"), value_json(e["value"], kind.valueType)))
        text = F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))
    elif isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        text = number_json(value.cast("double"))
    elif isinstance(kind, T.NumericType | T.BooleanType):
        text = value.cast("string")
    else:
        text = string_json(value.cast("string"))
    return F.coalesce(F.when(value.isNotNull(), text), F.lit("null"))


def structured_fields(
    events: DataFrame, names: list[str], serializers: dict[str, Callable[[Column], Column]] | None = None
) -> Column:
    """The named columns as properties, ``map<name, JSON text>``, in this order.

    A serializer of one's own for a column is a function of it that gives JSON
    text, such as a pandas UDF; where it gives null the usual text stays.
    """
    serializers = serializers or {}
    entries = []
    for name in names:
        usual = value_json(F.col(name), events.schema[name].dataType)
        text = F.coalesce(serializers[name](F.col(name)), usual) if name in serializers else usual
        entries += [F.lit(name), text]
    return F.create_map(*entries)
