"""The setting in force at the time of each row, for settings of any number.

Rows and settings are merged along time and cut into ranges; the last setting is
carried along each range and from range to range. So a day with a million settings
and a second with a third of all rows are both spread over tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmill.operators.running import ROWS_PER_CHUNK, plan_chunks, running

_AT, _IS_ROW, _SETTING = "_at", "_is_row", "_setting"
#: Ranges at least, so that small tables too are worked on side by side.
RANGES = 8


def as_of(rows: DataFrame, settings: DataFrame, ts: str, at: str, value: str, out: str, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Adds ``out``: the ``value`` of the last row of ``settings`` whose ``at`` is not after ``ts``; null before the first, or without a time.

    Of several settings at one time the one of the largest value counts. Rows
    that repeat stay as many as they are.
    """
    setting = F.struct(F.col(at).alias("at"), F.col(value).alias("value"))
    kind = settings.select(setting.alias("s")).schema["s"].dataType
    of_rows = rows.withColumns({_AT: F.col(ts), _IS_ROW: F.lit(1), _SETTING: F.lit(None).cast(kind)})
    of_settings = settings.filter(F.col(at).isNotNull()).select(
        *(F.lit(None).cast(field.dataType).alias(field.name) for field in rows.schema), F.col(at).alias(_AT), F.lit(0).alias(_IS_ROW), setting.alias(_SETTING))
    merged = of_rows.unionAll(of_settings)
    order = [_AT, _IS_ROW]  # a setting stands before the rows of its own time
    chunk = plan_chunks(merged, order, rows_per_chunk)
    if chunk is None:
        chunk = plan_chunks(merged, order, max(1, math.ceil(merged.count() / RANGES)))
    carried = running(merged, [], order, maxima={"_in_force": F.col(_SETTING)}, chunk=F.lit(0) if chunk is None else chunk)
    return carried.filter(F.col(_IS_ROW) == 1).select(*rows.columns, F.col("_in_force.value").alias(out))
