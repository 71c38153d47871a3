"""Which events go on: level thresholds, size limits, admission."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmill.functions.levels import level_at_least
from eventmill.operators.asof import as_of
from eventmill.operators.running import CHUNK, ROWS_PER_CHUNK, bisected, number_rows, plan_chunks
from eventmill.session import attach


def at_least(events: DataFrame, minimum: str | None, level: str = "level") -> DataFrame:
    """Events at or above a level; ``None`` keeps all."""
    return events if minimum is None else events.filter(level_at_least(F.col(level), minimum))


#: Switches up to which they become an expression.
LITERAL_SWITCHES = 1_000


def at_least_switched(
    events: DataFrame, control: DataFrame, rank: str = "level_rank", ts: str = "ts", literal_switches: int = LITERAL_SWITCHES,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Events at or above the threshold in force at their time.

    ``control`` holds ``(effective_from, min_rank)``. A few switches become one
    sorted array in which the time of an event is looked up, so events are not
    moved; more are merged with the events along time (:mod:`operators.asof`).
    Of several switches at one time the highest rank counts. Events before the
    first row, and those without a time, pass, like those of a logger without a switch.
    """
    control = control.filter("effective_from IS NOT NULL")
    first = control.select(F.unix_micros("effective_from"), "min_rank").take(literal_switches + 1)
    if len(first) > literal_switches:
        judged = as_of(events, control, ts, "effective_from", "min_rank", "_threshold", rows_per_chunk)
        return judged.filter(F.col(rank) >= F.coalesce("_threshold", F.lit(0))).drop("_threshold")
    if not first:
        return events.filter(F.col(rank) >= 0)
    switches = sorted((at, -1 if least is None else least) for at, least in first)
    times, ranks = F.array(*(F.lit(at) for at, _ in switches)), F.array(F.lit(0), *(F.lit(least) for _, least in switches))
    place = bisected(times, len(switches), F.unix_micros(ts))
    return events.filter(F.col(rank) >= F.get(ranks, place))


def fits(body: Column, limit: int | None) -> Column:
    """Whether the UTF-8 size of an event is within the limit."""
    return F.lit(True) if limit is None else F.octet_length(body) <= limit


def split_by_size(events: DataFrame, body: str, limit: int | None) -> tuple[DataFrame, DataFrame]:
    """Events within the limit, and the dropped ones. Dropped events still count as processed."""
    ok = fits(F.col(body), limit)
    return events.filter(ok), events.filter(~ok)


def admitted(
    events: DataFrame, bucket: str, order: list[str], limit: int | None, rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """The first ``limit`` events of each bucket; ``None`` admits all.

    For data of more than one range, counts per (bucket, range of the order)
    decide nearly all rows: ranges below the limit pass whole and those beyond
    it are dropped whole, without a shuffle. Only the one range of a bucket in
    which the limit is reached is put in order.
    """
    if limit is None:
        return events
    chunk = plan_chunks(events, order, rows_per_chunk)
    if chunk is None:
        return number_rows(events, [bucket], order, "_place").filter(F.col("_place") <= limit).drop("_place")
    cut = events.withColumn(CHUNK, chunk)
    earlier = Window.partitionBy(bucket).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy(bucket, CHUNK).agg(F.count(F.lit(1)).alias("_rows")).withColumn(
        "_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    reached = attach(
        cut, counts, [bucket, CHUNK], "inner", spread_by=order[-1], null_safe=True, label="admission"
    ).filter(F.col("_before") < limit)
    fits_whole = F.col("_before") + F.col("_rows") <= limit
    edge = number_rows(reached.filter(~fits_whole), [bucket], order, "_place").filter(
        F.col("_before") + F.col("_place") <= limit)
    return reached.filter(fits_whole).select(*events.columns).unionByName(edge.select(*events.columns))


def admission_counts(events: DataFrame, bucket: str, limit: int | None) -> DataFrame:
    """Admitted and dropped events per bucket, from the counts alone."""
    seen = events.groupBy(bucket).agg(F.count(F.lit(1)).alias("seen"))
    admitted_count = F.col("seen") if limit is None else F.least(F.col("seen"), F.lit(limit))
    return seen.select(bucket, admitted_count.alias("admitted"), (F.col("seen") - admitted_count).alias("dropped"))
