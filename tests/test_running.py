"""Ranges give the same as plain windows, whatever the skew."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from eventmill.operators import delivery, filters, rolling, running
from eventmill.operators.bulk import in_batches
from eventmill.session import attach
from eventmill.sources import views

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, a third at one instant, and some without a key."""
    key = F.when(F.col("id") % 97 == 5, None).when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50)
    at = F.when(F.col("id") % 3 == 1, F.lit(0)).otherwise((F.col("id") * 7919) % 5000)
    return spark.range(6000).select(
        F.col("id").alias("n"), key.cast("int").alias("key"), F.timestamp_seconds(at).alias("ts"),
        (F.col("id") % 13 + 1).alias("weight"), (F.col("id") % 11 != 3).alias("success")).cache()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_ranges_follow_the_order(skewed):
    chunk = running.plan_chunks(skewed, ["ts", "n"], rows_per_chunk=300)
    spans = skewed.select(chunk.alias("c"), F.struct("ts", "n").alias("at")).groupBy("c").agg(
        F.min("at").alias("low"), F.max("at").alias("high"), F.count("*").alias("rows")).orderBy("c").collect()
    assert len(spans) >= 15 and max(span["rows"] for span in spans) < 1500
    assert all(a["high"] < b["low"] for a, b in zip(spans, spans[1:]))


def test_small_data_needs_no_ranges(skewed):
    assert running.plan_chunks(skewed, ["ts", "n"]) is None


def test_failure_runs_read_only_columns_that_are_there(spark):
    """Without the order among the columns that are read, no filter asks the totals for it."""
    attempts = views.attempts(spark, SMALL)
    got = delivery.failure_runs(attempts, "target", ["ts", "attempt_no"], rows_per_chunk=100).select("target", "attempt_no", "failures_in_a_row")
    assert "!Filter" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert rows(got) == rows(delivery.failure_runs(attempts, "target", ["ts", "attempt_no"]).select(*got.columns))


def test_numbers(skewed):
    got = running.number_rows_at_scale(skewed, ["key"], ["ts", "n"], rows_per_chunk=300)
    want = skewed.withColumn("rn", F.row_number().over(Window.partitionBy("key").orderBy("ts", "n")).cast("bigint"))
    assert rows(got) == rows(want)


def test_sums_and_maxima(skewed):
    chunk = running.plan_chunks(skewed, ["ts", "n"], rows_per_chunk=300)
    values = {"sums": {"total": F.col("weight")}, "maxima": {"top": F.when(F.col("success"), F.col("weight"))}}
    got = running.running(skewed, ["key"], ["ts", "n"], **values, chunk=chunk)
    assert rows(got) == rows(running.running(skewed, ["key"], ["ts", "n"], **values))


def test_failure_runs(skewed):
    got = delivery.failure_runs(skewed, "key", ["ts", "n"], rows_per_chunk=300)
    by_key, want = {}, []
    for row in sorted(skewed.collect(), key=lambda r: (-1 if r.key is None else r.key, r.ts, r.n)):
        by_key[row.key] = 0 if row.success else by_key.get(row.key, 0) + 1
        want.append((*row, by_key[row.key]))
    assert rows(got) == sorted(want, key=repr)
    assert rows(delivery.failure_runs(skewed, "key", ["ts", "n"])) == sorted(want, key=repr)


def test_admission(skewed):
    got = filters.admitted(skewed, "key", ["ts", "n"], 25, rows_per_chunk=300)
    assert rows(got) == rows(filters.admitted(skewed, "key", ["ts", "n"], 25))
    assert filters.admitted(skewed, "key", ["ts", "n"], None).count() == 6000


def test_batches_are_full(skewed):
    batched = in_batches(skewed, ["key"], ["ts", "n"], 50, rows_per_chunk=300)
    sizes = batched.groupBy("key", "batch_no").count().groupBy("key").agg(
        F.sum(F.when(F.col("count") < 50, 1).otherwise(0)).alias("short"), F.max("count").alias("most")).collect()
    assert all(row.short <= 1 and row.most <= 50 for row in sizes)


def brute_force_rolling(sizes, limit):
    used, number, out = 0, 0, []
    for size in sizes:
        if used >= limit:
            used, number = 0, number + 1
        used += size
        out.append(number)
    return out


@pytest.mark.parametrize("limit", [40, 700])
def test_rolling_files(skewed, limit):
    got = rolling.rolling_sequences(skewed, ["key"], ["ts", "n"], "weight", limit, rows_per_chunk=300)
    numbers = {row.n: row.sequence for row in got.collect()}
    by_key = {}
    for row in sorted(skewed.collect(), key=lambda r: (r.ts, r.n)):
        by_key.setdefault(row.key, []).append(row)
    for members in by_key.values():
        assert [numbers[r.n] for r in members] == brute_force_rolling([r.weight for r in members], limit)


def test_rolling_files_in_many_partitions(spark, skewed):
    """Ranges meet their tables also when partitions are not joined into one."""
    names = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        test_rolling_files(skewed, 40)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@pytest.mark.parametrize("bound", [10, 1000])
def test_attach(spark, skewed, bound):
    side = spark.range(40).select(F.col("id").cast("int").alias("key"), (F.col("id") * 2).alias("double"))
    got = attach(skewed.select("n", "key"), side, ["key"], spread_by="n", max_broadcast_rows=bound)
    want = skewed.select("n", "key").join(side, "key", "left").select(*got.columns)
    assert rows(got.na.fill(-1)) == rows(want.na.fill(-1))
    plan = got._jdf.queryExecution().toString()
    assert ("rightHint=(strategy=broadcast)" in plan) == (bound == 1000)
