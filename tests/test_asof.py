"""The setting in force: against DuckDB's as-of join and a walk along time."""

import datetime
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from eventmill.operators import asof, filters

START = datetime.datetime(2024, 1, 1)


def walk(rows, settings):
    return {i: (max((s for s in settings if s[0] is not None and at is not None and s[0] <= at), default=(None, None))[1]) for i, at in rows}


@pytest.mark.parametrize("per_chunk", [7, 1_000_000])
def test_against_a_walk(spark, per_chunk):
    rng = random.Random(3)
    at = lambda: START + datetime.timedelta(seconds=rng.randint(0, 50))
    rows = [(i, rng.choice([at(), START + datetime.timedelta(seconds=20)]) if i % 17 else None) for i in range(300)]
    settings = [(at(), rng.randint(0, 5)) for _ in range(40)] + [(None, 5)]
    frames = spark.createDataFrame(rows, "i int, ts timestamp").repartition(5), spark.createDataFrame(settings, "since timestamp, v int")
    got = asof.as_of(*frames, "ts", "since", "v", "out", per_chunk).collect()
    assert len(got) == 300 and {r.i: r.out for r in got} == walk(rows, settings)
    assert {r.out for r in asof.as_of(frames[0], frames[1].limit(0), "ts", "since", "v", "out", per_chunk).collect()} == {None}
    assert asof.as_of(frames[0].limit(0), frames[1], "ts", "since", "v", "out", per_chunk).collect() == []


def test_both_ways_of_a_switch(spark):
    rng = random.Random(4)
    events = spark.createDataFrame([(i, START + datetime.timedelta(seconds=rng.randint(0, 90)) if i % 29 else None, rng.randint(0, 5)) for i in range(400)],
                                   "event_id int, ts timestamp, level_rank int")
    control = spark.createDataFrame([(START + datetime.timedelta(seconds=s), rng.randint(0, 5)) for s in (10, 20, 20, 50, 80)], "effective_from timestamp, min_rank int")
    few, many = (sorted(map(str, filters.at_least_switched(events, control, literal_switches=n, rows_per_chunk=50).collect())) for n in (100, 2))
    assert few == many and 0 < len(few) < 400


def test_a_million_switches_in_a_day(spark, tmp_path):
    """No list of a day, no window without a key; the rows of the as-of join."""
    switches = spark.range(1_000_000).select(
        (F.lit(START).cast("timestamp") + F.make_dt_interval(secs=(F.col("id") * 0.0864).cast("decimal(18,6)"))).alias("effective_from"), (F.hash("id") % 6).cast("int").alias("min_rank"))
    events = spark.range(20_000).select(
        F.col("id").alias("event_id"), (F.lit(START).cast("timestamp") + F.make_dt_interval(secs=((F.col("id") * 7919) % 90_000 - 1000).cast("decimal(18,6)"))).alias("ts"),
        (F.hash("id", F.lit(1)) % 6).cast("int").alias("level_rank"))
    kept = filters.at_least_switched(events, switches, rows_per_chunk=100_000)
    plan = kept._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "collect_list" not in plan
    switches.write.parquet(str(tmp_path / "switches"))
    events.write.parquet(str(tmp_path / "events"))
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    want = con.execute(f"""SELECT e.event_id FROM '{tmp_path}/events/*.parquet' e ASOF LEFT JOIN '{tmp_path}/switches/*.parquet' s ON e.ts >= s.effective_from
        WHERE e.level_rank >= coalesce(s.min_rank, 0) ORDER BY 1""").fetchall()
    assert sorted(r.event_id for r in kept.collect()) == [i for i, in want] and 0 < len(want) < 20_000
