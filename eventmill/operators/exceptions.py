"""Exception chains: flat array, nested object, relational rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.functions.jsontext import SHOW_NULLS, let
from eventmill.options import EXCEPTION_DEPTH_LIMIT
from eventmill.session import written

# Parts of a method description, and how an assembly name is spelled.
METHOD_SEPARATORS = ("\x00", "\n")
METHOD_PART_COUNT = 5
NEUTRAL_CULTURE = "neutral"
# Members of an exception before and after its method, and the names of traces given as lines.
BEFORE_METHOD = ("ClassName", "Message", "Source", "StackTraceString", "RemoteStackTraceString", "RemoteStackIndex")
AFTER_METHOD = ("HResult", "HelpURL")
STACK_ARRAYS = {"StackTraceString": "StackTrace", "RemoteStackTraceString": "RemoteStackTrace"}


def _attribute(assembly: Column, name: str) -> Column:
    """An attribute of an assembly name, such as its version; null without it."""
    value = F.substring_index(F.substring_index(assembly, f"{name}=", -1), ",", 1)
    return F.when(assembly.contains(f"{name}="), value)


def exception_method(description: Column) -> Column:
    """The parts of a method description; null unless it has exactly five."""
    def described(parts: Column) -> Column:
        assembly = F.get(parts, 2)
        culture = _attribute(assembly, "Culture")
        return F.struct(
            F.get(parts, 1).alias("Name"),
            F.trim(F.substring_index(assembly, ",", 1)).alias("AssemblyName"),
            _attribute(assembly, "Version").alias("AssemblyVersion"),
            F.when(culture == NEUTRAL_CULTURE, "").otherwise(culture).alias("AssemblyCulture"),
            F.get(parts, 3).alias("ClassName"),
            F.get(parts, 4).alias("Signature"),
            F.get(parts, 0).try_cast("int").alias("MemberType"))

    first, second = METHOD_SEPARATORS
    one_kind = F.when(description.contains(first), F.translate(description, first, second)).otherwise(description)
    return let(F.split(one_kind, second), lambda parts: F.when(F.size(parts) == METHOD_PART_COUNT, described(parts)))


def _with_depth(entry: Column, depth: Column) -> Column:
    return F.struct(
        depth.cast("int").alias("Depth"),
        *[entry[name].alias(name) for name in BEFORE_METHOD],
        exception_method(entry["ExceptionMethod"]).alias("ExceptionMethod"),
        *[entry[name].alias(name) for name in AFTER_METHOD],
    )


def flattened(chain: Column, depth_limit: int = EXCEPTION_DEPTH_LIMIT) -> Column:
    """The chain, outermost first, with depths; entries past the limit are left out."""
    return F.transform(F.slice(chain, 1, depth_limit + 1), _with_depth)


def stack_lines(trace: Column) -> Column:
    """A stack trace as its non-empty lines; no trace gives no lines."""
    return F.filter(F.split(F.coalesce(trace, F.lit("")), r"\r?\n"), lambda line: line != "")


def exception_json(entry: Column, depth: Column, method: Column, stack_as_array: bool = False) -> Column:
    """One exception as JSON; unset fields are shown as null, an unusable method is left out."""
    def shown(name: str) -> Column:
        if stack_as_array and name in STACK_ARRAYS:
            return stack_lines(entry[name]).alias(STACK_ARRAYS[name])
        return entry[name].alias(name)

    head = [depth.cast("int").alias("Depth"), *[shown(name) for name in BEFORE_METHOD]]
    tail = [shown(name) for name in AFTER_METHOD]
    with_method = F.to_json(F.struct(*head, method.alias("ExceptionMethod"), *tail), SHOW_NULLS)
    return F.when(method.isNull(), F.to_json(F.struct(*head, *tail), SHOW_NULLS)).otherwise(with_method)


def _entry_json(stack_as_array: bool) -> Callable[[Column, Column], Column]:
    return lambda entry, depth: let(
        exception_method(entry["ExceptionMethod"]), lambda method: exception_json(entry, depth, method, stack_as_array))


def flat_json(chain: Column, stack_as_array: bool = False) -> Column:
    """The ``exceptions`` array; null without an exception."""
    items = F.transform(F.slice(chain, 1, EXCEPTION_DEPTH_LIMIT + 1), _entry_json(stack_as_array))
    return F.concat(F.lit("["), F.nullif(F.array_join(items, ","), F.lit("")), F.lit("]"))


def nested_json(chain: Column, stack_as_array: bool = False) -> Column:
    """The ``exception`` object with ``innerException`` inside it, to any depth; null without an exception.

    All opening parts come first, then all closing braces: one join of the
    texts instead of a copy of the inner text at every level.
    """
    def open_ended(text: Column) -> Column:
        return F.substring(text, F.lit(1), F.length(text) - 1)

    items = F.transform(F.transform(chain, _entry_json(stack_as_array)), open_ended)
    opened = F.nullif(F.array_join(items, ',"innerException":'), F.lit(""))
    return F.concat(opened, F.repeat(F.lit("}"), F.size(chain)))


def exceptions_table(events: DataFrame, keys: list[str], chain: str = "exceptions") -> DataFrame:
    """One row per exception of an event, with its depth."""
    return events.select(*keys, F.inline(flattened(F.col(chain))))


def depths_from_links(
    links: DataFrame, node: str = "exc_id", inner: str = "inner_exc_id", depth_limit: int = EXCEPTION_DEPTH_LIMIT
) -> DataFrame:
    """Depth of every exception given as links to its inner one; those past the limit are left out.

    Pointer doubling: each round doubles how far up every row has looked, so
    the 20 levels need five rounds of equi-joins on unique ids, and no chain is
    ever gathered in one place. Each round is written to the shared folder.
    """
    outer = links.filter(F.col(inner).isNotNull()).select(F.col(inner).alias("_node"), F.col(node).alias("_up"))
    steps = (
        links.select(F.col(node).alias("_node"))
        .join(outer, "_node", "left")
        .select("_node", "_up", F.when(F.col("_up").isNull(), 0).otherwise(1).alias("_depth"))
    )
    reach = 1
    while reach <= depth_limit:
        steps = written(steps, "exception-depths")
        above = steps.select(F.col("_node").alias("_up"), F.col("_up").alias("_next"), F.col("_depth").alias("_more"))
        # Rows that have reached the outermost exception look no further: joined, they would all meet in the task of the missing key.
        done = steps.filter(F.col("_up").isNull())
        steps = steps.filter(F.col("_up").isNotNull()).join(above, "_up", "left").select(
            "_node", F.col("_next").alias("_up"), (F.col("_depth") + F.coalesce("_more", F.lit(0))).alias("_depth")).unionByName(done)
        reach *= 2
    known = steps.filter(F.col("_up").isNull() & (F.col("_depth") <= depth_limit))
    return links.join(known.select(F.col("_node").alias(node), F.col("_depth").alias("depth")), node)
