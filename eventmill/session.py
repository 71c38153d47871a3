"""Session settings, the shared work folder, and size-checked joins."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when it was written out and measured within both bounds.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
# Copies of the other side (and slices of a hot key) when the bound does not hold.
SALT_SLICES = 16


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on: event times are UTC instants."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def work_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables and stream checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    without that setting (tests) gets a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="eventmill-")
    context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A path of its own for one run; never reused, so a retried job cannot read leftovers."""
    return f"{work_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage so that a lost executor re-reads files instead of
    recomputing the whole plan, and gives Spark the true size of the table.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


KEY = "_key"


def whole_key(names: Sequence[str]) -> Column:
    """The key columns as one struct: never null itself, and missing parts are equal to each other.

    Unlike a null-safe comparison it is a plain join key, so a join on it reuses
    the distribution of a window over it.
    """
    return F.struct(*names) if names else F.struct(F.lit(0).alias("all"))


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns where a missing key matches a missing key; keeps one copy of the keys."""
    keyed = right.withColumn(KEY, whole_key(on)).drop(*on)
    return left.withColumn(KEY, whole_key(on)).join(keyed, [KEY], how).drop(KEY)


def attach(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "left",
    spread_by: str | None = None,
    null_safe: bool = False,
    max_broadcast_rows: int = BROADCAST_ROWS,
    label: str = "attach",
) -> DataFrame:
    """Join ``big`` to a side expected to be small, after measuring that side.

    The small side is computed once and measured. Within the bounds it is
    broadcast, so ``big`` is not shuffled and a hot key stays spread over the
    scan tasks. Beyond it the join shuffles with every key cut into
    ``SALT_SLICES`` slices by ``spread_by`` (a high-cardinality column of
    ``big``), so a key holding a third of the rows still uses many tasks.
    """
    small = written(small, label)
    join = join_null_safe if null_safe else DataFrame.join
    if _small_enough(small, max_broadcast_rows):
        return join(big, F.broadcast(small), list(on), how)
    if spread_by is None:
        return join(big, small, list(on), how)
    slice_of_row = F.pmod(F.xxhash64(spread_by), F.lit(SALT_SLICES)).cast("int")
    slices = F.explode(F.sequence(F.lit(0), F.lit(SALT_SLICES - 1)))
    return join(
        big.withColumn("_slice", slice_of_row), small.withColumn("_slice", slices), [*on, "_slice"], how).drop("_slice")


def _small_enough(table: DataFrame, max_rows: int) -> bool:
    """Rows first, which the files tell without reading them; then the bytes of their text."""
    if table.count() > max_rows:
        return False
    size = table.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return size <= BROADCAST_BYTES
