"""Rolling files by size, for writers of any volume.

A file takes events until its size has reached the limit, so where a file
starts depends on every file before it. To work on one writer in many tasks,
its order is cut into ranges. For each range a small table tells what it does to
a file that is part full at its start: how many files it completes and how full
the last one is at its end, by how many bytes the first one still needs. These
tables are combined in groups, level by level, and then resolved from the top
down, like a parallel prefix sum. At last each range numbers its own events.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from eventmill.operators.running import CHUNK, plan_chunks
from eventmill.session import written

# Workers need not have this package installed to run its functions.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Tables combined in one group, and rows of a range: both bound what a task holds.
FAN_IN = 8
ROWS_PER_RANGE = 1_000_000


def range_table(sizes: np.ndarray, limit: int) -> pd.DataFrame:
    """What a range does to a file that still needs some bytes.

    A row holds for needs up to ``upto`` (and above the row before it): the
    range then completes ``files`` files and leaves ``used`` bytes in the last one.
    The row with ``files`` 0 completes none: there ``used`` is added instead.
    """
    ends = np.cumsum(sizes)
    total = int(ends[-1])
    first = np.arange(min(int(np.searchsorted(ends, limit)) + 1, len(ends)))
    first = first[np.concatenate(([True], ends[first[1:]] > ends[first[:-1]]))]
    begun = ends[first].copy()
    files = np.ones(len(first), dtype=np.int64)
    active = np.ones(len(first), dtype=bool)
    while active.any():
        at = np.searchsorted(ends, begun[active] + limit)
        done = at >= len(ends)
        where = np.flatnonzero(active)
        begun[where[~done]] = ends[at[~done]]
        files[where[~done]] += 1
        active[where[done]] = False
    table = pd.DataFrame({"upto": np.minimum(ends[first], limit), "files": files, "used": total - begun})
    table = table[table["upto"] > 0]
    if total < limit:
        table = pd.concat([table, pd.DataFrame({"upto": [limit], "files": [0], "used": [total]})])
    return table.reset_index(drop=True)


def combined(first: pd.DataFrame, second: pd.DataFrame, limit: int) -> pd.DataFrame:
    """The table of two ranges in a row."""
    upto, files, used = (second[name].to_numpy() for name in ("upto", "files", "used"))
    ended = first[first["files"] > 0]
    left = ended["used"].to_numpy()
    row = np.searchsorted(upto, limit - left)
    out = [pd.DataFrame({
        "upto": ended["upto"].to_numpy(), "files": ended["files"].to_numpy() + files[row],
        "used": np.where(files[row] > 0, used[row], left + used[row])})]
    if len(ended) < len(first):
        added = int(first["used"].iloc[-1])
        need = np.minimum(upto + added, limit)
        keep = np.concatenate(([True], need[1:] > need[:-1]))
        out.append(pd.DataFrame({
            "upto": need[keep], "files": files[keep], "used": np.where(files[keep] > 0, used[keep], added + used[keep])}))
    table = pd.concat(out, ignore_index=True)
    # Neighbours with the same outcome become one row.
    same = (table["files"] == table["files"].shift(-1)) & (table["used"] == table["used"].shift(-1)) & (table["files"] > 0)
    return table[~same].reset_index(drop=True)


def passed(table: pd.DataFrame, used: int, limit: int) -> tuple[int, int]:
    """Files completed and bytes left in the last one, for a file that holds ``used`` bytes at the start."""
    row = int(np.searchsorted(table["upto"].to_numpy(), limit - used))
    files, left = int(table["files"].iloc[row]), int(table["used"].iloc[row])
    return files, left if files else used + left


def numbered(sizes: np.ndarray, used: int, number: int, limit: int) -> np.ndarray:
    """The file number of each event of a range."""
    ends, ended, need = np.cumsum(sizes), [], limit - used
    while (at := int(np.searchsorted(ends, need))) < len(ends):
        ended.append(at)
        need = int(ends[at]) + limit
    return number + np.searchsorted(np.array(ended, dtype=np.int64), np.arange(len(ends)))


def rolling_sequences(
    lines: DataFrame, keys: list[str], order: list[str], size: str, limit_bytes: int, rows_per_chunk: int = ROWS_PER_RANGE
) -> DataFrame:
    """Adds ``sequence``: the file of its writer (the keys) an event lands in. Sizes are not negative."""
    lines = lines.select(*keys, *order, size)
    schema = _extended(lines.schema, "sequence")
    chunk = plan_chunks(lines, order, rows_per_chunk)

    def ordered(frame: pd.DataFrame) -> pd.DataFrame:
        return frame.sort_values(order, ignore_index=True)

    def assign(frame: pd.DataFrame, used: int, number: int) -> pd.DataFrame:
        frame = ordered(frame)
        return frame.assign(sequence=numbered(frame[size].to_numpy(), used, number, limit_bytes))

    if chunk is None:
        return lines.groupBy(*keys).applyInPandas(lambda frame: assign(frame, 0, 0), schema)

    cut = lines.withColumn(CHUNK, chunk.cast("long"))  # as in the tables: groups meet by the hash of their keys, and an int has another one
    by_key = lines.select(*keys).schema
    table_schema = _extended(by_key, CHUNK, "upto", "files", "used")
    state_schema = _extended(by_key, CHUNK, "held", "number")

    def tabled(frame: pd.DataFrame) -> pd.DataFrame:
        return labelled(range_table(ordered(frame)[size].to_numpy(), limit_bytes), frame, int(frame[CHUNK].iloc[0]))

    def labelled(out: pd.DataFrame, frame: pd.DataFrame, number: int) -> pd.DataFrame:
        for name in keys:
            out[name] = frame[name].iloc[0]
        out[CHUNK] = number
        return out[[*keys, CHUNK, "upto", "files", "used"]]

    def merged(frame: pd.DataFrame) -> pd.DataFrame:
        whole = None
        for _, table in _tables(frame):
            whole = table if whole is None else combined(whole, table, limit_bytes)
        return labelled(whole, frame, int(frame[CHUNK].iloc[0]) // FAN_IN)

    def resolved(states: pd.DataFrame, tables: pd.DataFrame) -> pd.DataFrame:
        used, number, rows = int(states["held"].iloc[0]), int(states["number"].iloc[0]), []
        for place, table in _tables(tables):
            rows.append((place, used, number))
            files, used = passed(table, used, limit_bytes)
            number += files
        out = pd.DataFrame(rows, columns=[CHUNK, "held", "number"])
        for name in keys:
            out[name] = states[name].iloc[0]
        return out[[*keys, CHUNK, "held", "number"]]

    levels = [written(cut.groupBy(*keys, CHUNK).applyInPandas(tabled, table_schema), "rolling-ranges")]
    last = levels[0].agg(F.max(CHUNK)).first()[0] or 0
    while last > 0:
        above = levels[-1].withColumn("_block", F.floor(F.col(CHUNK) / FAN_IN)).groupBy(*keys, "_block").applyInPandas(
            merged, table_schema)
        levels.append(written(above, "rolling-ranges"))
        last //= FAN_IN
    states = levels[-1].select(*keys, F.lit(0).cast("long").alias(CHUNK), F.lit(0).cast("long").alias("held"),
                               F.lit(0).cast("long").alias("number")).distinct()
    for tables in reversed(levels[:-1]):
        below = states.groupBy(*keys, CHUNK).cogroup(
            tables.withColumn("_block", F.floor(F.col(CHUNK) / FAN_IN)).groupBy(*keys, "_block"))
        states = written(below.applyInPandas(resolved, state_schema), "rolling-states")

    def finish(states: pd.DataFrame, frame: pd.DataFrame) -> pd.DataFrame:
        done = assign(frame, int(states["held"].iloc[0]), int(states["number"].iloc[0]))
        return done[[*keys, *order, size, "sequence"]]

    return states.groupBy(*keys, CHUNK).cogroup(cut.groupBy(*keys, CHUNK)).applyInPandas(finish, schema)


def _extended(schema: StructType, *names: str) -> StructType:
    return StructType([*schema.fields, *[StructField(name, LongType()) for name in names]])


def _tables(frame: pd.DataFrame) -> list[tuple[int, pd.DataFrame]]:
    """The tables of a group in order of their ranges."""
    frame = frame.sort_values([CHUNK, "upto"], ignore_index=True)
    return [(int(place), table.reset_index(drop=True)) for place, table in frame.groupby(CHUNK, sort=True)]
