"""Which buffer files and dumps to keep, and how events fall into rolling files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmill.functions.times import ROLLING_INTERVALS
from eventmill.options import BUFFER_FILE_COUNT_LIMIT, ShippingOptions

# The newest files always kept, and the intervals too coarse to ship.
ALWAYS_KEPT = 2
TOO_COARSE = ("Infinite", "Year", "Month")


def ordered_files(
    files: DataFrame, keys: list[str], part: str, order: list[Column], size: str = "size_bytes", newest_first: bool = True
) -> DataFrame:
    """Adds ``rank`` and ``running_bytes`` along the order of files.

    Files are ranked within a part (such as a day); parts are few and are summed
    along the order, so a catalog of many files is not sorted in one task.
    ``part`` must agree with ``order``: a newer file never lies in an older part.
    """
    inner = Window.partitionBy(*keys, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = files.groupBy(*keys, part).agg(F.sum(size).alias("_bytes"), F.count(F.lit(1)).alias("_files"))
    along = F.col(part).desc() if newest_first else F.col(part).asc()
    outer = Window.partitionBy(*keys).orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        *keys, part,
        F.coalesce(F.sum("_bytes").over(outer), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_files").over(outer), F.lit(0)).alias("_files_before"))
    ranked = files.withColumns({"_sum": F.sum(size).over(inner), "_rank": F.count(F.lit(1)).over(inner)})
    return ranked.join(before, [*keys, part]).select(
        *files.columns,
        (F.col("_rank") + F.col("_files_before")).cast("bigint").alias("rank"),
        (F.col("_sum") + F.col("_bytes_before")).cast("bigint").alias("running_bytes"))


def keep_by_size(
    files: DataFrame, limit_bytes: int, part: str, order: list[Column], size: str = "size_bytes",
    always_kept: int = ALWAYS_KEPT, keys: list[str] | None = None,
) -> DataFrame:
    """Adds ``keep``: the newest files always, others while the running size is within the limit."""
    ranked = ordered_files(files, keys or [], part, order, size)
    return ranked.withColumn("keep", (F.col("rank") <= always_kept) | (F.col("running_bytes") <= limit_bytes))


def keep_dumps(
    dumps: DataFrame, limit_bytes: int, incoming_bytes: int, part: str, order: list[Column], size: str = "size_bytes"
) -> DataFrame:
    """Dumps kept so that the incoming one fits; none is kept regardless, the incoming one is always written."""
    return keep_by_size(dumps, limit_bytes - incoming_bytes, part, order, size, always_kept=0)


def keep_by_count(
    files: DataFrame, part: str, order: list[Column], limit: int | None = BUFFER_FILE_COUNT_LIMIT,
    size: str = "size_bytes", keys: list[str] | None = None,
) -> DataFrame:
    """Adds ``keep``: the newest ``limit`` files; ``None`` keeps all."""
    ranked = ordered_files(files, keys or [], part, order, size)
    return ranked.withColumn("keep", F.lit(True) if limit is None else F.col("rank") <= limit)


def kept_buffers(
    files: DataFrame, shipping: ShippingOptions, part: str, order: list[Column], size: str = "size_bytes", keys: list[str] | None = None
) -> DataFrame:
    """Adds ``keep``: files within the count limit of the options, and within their size limit for one file times that count."""
    counted = keep_by_count(files, part, order, shipping.file_count_limit, size, keys)
    if shipping.file_size_limit is None or shipping.file_count_limit is None:
        return counted
    total = shipping.file_size_limit * shipping.file_count_limit
    return counted.withColumn("keep", F.col("keep") & ((F.col("rank") <= ALWAYS_KEPT) | (F.col("running_bytes") <= total)))


def evictions(files: DataFrame, positions: DataFrame, source: str = "source", file: str = "file_name",
              order: str = "file_rank") -> DataFrame:
    """What an idle shipper does per source.

    ``files(source, file_name, file_rank, size_bytes)`` and one bookmark per
    source in ``positions(source, bookmark_file, next_offset)``. Without a
    bookmark, or with one of a file that is gone, a shipper stands at the start
    of the oldest file. As long as the file it stands in has more to send it
    waits. Then, with two files and the first one read: move on to the second.
    With more than two: delete the oldest.
    """
    pair = F.struct(order, file, "size_bytes")
    ends = files.groupBy(source).agg(F.count(F.lit(1)).alias("n_files"), F.min(pair).alias("_first"), F.max(pair).alias("_last"))
    standing = positions.join(
        files.select(source, F.col(file).alias("bookmark_file"), F.col("size_bytes").alias("_size")), [source, "bookmark_file"])
    state = ends.join(standing.select(source, "bookmark_file", "next_offset", "_size"), source, "left")
    at = F.coalesce("bookmark_file", F.col(f"_first.{file}"))
    drained = F.coalesce("next_offset", F.lit(0)) >= F.coalesce("_size", F.col("_first.size_bytes"))
    delete = drained & (F.col("n_files") > 2)
    advance = drained & (F.col("n_files") == 2) & (at == F.col(f"_first.{file}"))
    return state.select(
        source, "n_files",
        F.when(delete, "delete").when(advance, "advance").otherwise("wait").alias("action"),
        F.when(delete, F.col(f"_first.{file}")).when(advance, F.col(f"_last.{file}")).alias("file"))


def rolling_bucket(ts: Column, interval: str = "Day") -> Column:
    """The date part of the rolling file an event is written to."""
    pattern, _ = ROLLING_INTERVALS[interval]
    return F.date_format(ts, pattern) if pattern else F.lit("")


def check_shippable(interval: str) -> None:
    """Files that roll less often than daily cannot be shipped."""
    if interval in TOO_COARSE:
        raise ValueError(f"rolling interval {interval} is coarser than a day and cannot be shipped")

