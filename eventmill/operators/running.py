"""Running values per key without one task per key.

``sum(...) OVER (PARTITION BY key ORDER BY ...)`` puts a whole key into one
task, which fails when a key (an index, a file, a delivery target) holds a large
share of the rows. Here the order is cut into ranges, "chunks". Each
(key, chunk) is numbered on its own, the chunk totals (a small table) are summed
along the order, and both are added up. The result equals the plain window.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmill.session import KEY, whole_key

ROWS_PER_CHUNK = 4_000_000
MAX_CHUNKS = 131_072
SAMPLES_PER_CHUNK = 8

CHUNK = "_chunk"


def plan_chunks(df: DataFrame, order: Sequence[str], rows_per_chunk: int = ROWS_PER_CHUNK) -> Column | None:
    """An expression giving each row the number of its range of ``order``.

    Boundaries come from a bounded random sample, as for a distributed sort;
    they only steer how work is split, never what the result is. ``None`` means
    the data fits one chunk and a plain window is enough.
    """
    rows = df.select(*order).count()
    chunks = min(MAX_CHUNKS, math.ceil(rows / rows_per_chunk))
    if chunks <= 1:
        return None
    fraction = min(1.0, chunks * SAMPLES_PER_CHUNK / rows)
    key = F.struct(*order)
    sample = df.select(*order).sample(fraction, seed=7)
    # Sorting and ranking the sample stay in Spark; only the boundaries are collected.
    ranked = sample.select(key.alias("at"), F.ntile(chunks).over(Window.orderBy(key)).alias("part"))
    bounds = ranked.groupBy("part").agg(F.min("at").alias("at")).filter("part > 1").select(F.array_sort(F.collect_list("at")).alias("bounds"))
    values = bounds.select(F.to_json(F.struct("bounds"), {"timestampFormat": _TIMES, "timestampNTZFormat": _TIMES_NTZ})).first()[0]
    kind = f"struct<bounds:{bounds.schema['bounds'].dataType.simpleString()}>"
    literal = F.from_json(F.lit(values), kind, {"timestampFormat": _TIMES, "timestampNTZFormat": _TIMES_NTZ})["bounds"]
    return bisected(literal, chunks, key)


_TIMES = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
_TIMES_NTZ = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def bisected(bounds: Column, count: int, key: Column) -> Column:
    """How many boundaries are at or below ``key``, by bisection."""
    steps = [2**i for i in reversed(range(count.bit_length()))]

    def advance(found: Column, step: Column) -> Column:
        ahead = found + step
        inside = (ahead <= F.size(bounds)) & (F.get(bounds, ahead - 1) <= key)
        return F.when(inside, ahead).otherwise(found)

    # Never null, so that joins on the position do not work it out once more to test that.
    return F.coalesce(F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), advance), F.lit(0))


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    maxima: Mapping[str, Column] | None = None,
    chunk: Column | None = None,
) -> DataFrame:
    """Add running sums and running maxima per ``keys`` along ``order``.

    ``chunk`` must not decrease along ``order``; see :func:`plan_chunks`.
    """
    sums, maxima = dict(sums or {}), dict(maxima or {})
    so_far = lambda parts: Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    if chunk is None:
        here = so_far(keys)
        return df.withColumns(
            {name: F.sum(value).over(here) for name, value in sums.items()}
            | {name: F.max(value).over(here) for name, value in maxima.items()}
        )
    cut = df.withColumns({KEY: whole_key(keys), CHUNK: chunk})
    parts = [KEY, CHUNK]
    totals = cut.groupBy(*parts).agg(
        *[F.sum(value).alias(f"_t_{name}") for name, value in sums.items()],
        *[F.max(value).alias(f"_t_{name}") for name, value in maxima.items()],
    )
    before = Window.partitionBy(KEY).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *parts,
        *[F.sum(f"_t_{name}").over(before).alias(f"_c_{name}") for name in sums],
        *[F.max(f"_t_{name}").over(before).alias(f"_c_{name}") for name in maxima],
    )
    here = so_far(parts)
    local = cut.withColumns(
        {name: F.sum(value).over(here) for name, value in sums.items()}
        | {name: F.max(value).over(here) for name, value in maxima.items()}
    )
    # The window already distributes rows by (keys, chunk); the join reuses that.
    joined = local.join(carried.hint("merge"), parts)
    return joined.withColumns(
        {name: F.col(name) + F.coalesce(F.col(f"_c_{name}"), F.lit(0)) for name in sums}
        | {name: F.greatest(name, f"_c_{name}") for name in maxima}
    ).select(*df.columns, *sums, *maxima)


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "rn", chunk: Column | None = None
) -> DataFrame:
    """``row_number()`` per ``keys`` along ``order`` (which must be unique per key)."""
    if chunk is None:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint"))
    return running(df, keys, order, sums={out: F.lit(1).cast("bigint")}, chunk=chunk)


def number_rows_at_scale(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "rn", rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """:func:`number_rows` with chunks planned from the data."""
    return number_rows(df, keys, order, out, plan_chunks(df, order, rows_per_chunk))
