"""Delivery: a caller's client, responses, correlation, failure routes, resends."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from eventmill.model import RESPONSE_BODY
from eventmill.operators.running import CHUNK, ROWS_PER_CHUNK, number_rows, plan_chunks
from eventmill.options import MAXIMUM_BACKOFF_SECONDS, MINIMUM_BACKOFF_SECONDS
from eventmill.session import KEY, attach, whole_key, written

# Where failures go, as a set of flags.
WRITE_TO_SELF_LOG = 1
WRITE_TO_FAILURE_SINK = 2
THROW_EXCEPTION = 4
RAISE_CALLBACK = 8
# Fixed value: an item from this status on has failed.
FIRST_FAILED_STATUS = 300
UNKNOWN = "Unknown"

# Bodies that a task holds at once: each has a whole batch of documents.
BODIES_AT_ONCE = 100
ROWS_AT_ONCE = "spark.sql.execution.arrow.maxRecordsPerBatch"

RESPONSE = "batch_id string, attempt int, http_status int, success boolean, response string"


class Client(Protocol):
    """What the caller brings to send a request body."""

    def send(self, body: str) -> tuple[int, bool, str]:
        """HTTP status, success, response text."""


def deliver(requests: DataFrame, client_factory: Callable[[], Client], attempt: int = 1) -> DataFrame:
    """Send each body of ``requests(batch_id, body)``; one client per task."""
    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = client_factory()
        for frame in frames:
            sent = [client.send(body) for body in frame["body"]]
            yield pd.DataFrame({
                "batch_id": frame["batch_id"],
                "attempt": attempt,
                "http_status": [status for status, _, _ in sent],
                "success": [ok for _, ok, _ in sent],
                "response": [text for _, _, text in sent],
            })

    return requests.select("batch_id", "body").mapInPandas(send, RESPONSE)


def sent(requests: DataFrame, client_factory: Callable[[], Client], attempt: int = 1) -> DataFrame:
    """:func:`deliver`, run now: the answers are kept, so that reading them again sends nothing again.

    A task passes ``BODIES_AT_ONCE`` bodies to the client at a time, whatever the session's number of rows.
    """
    conf = requests.sparkSession.conf
    before = conf.get(ROWS_AT_ONCE)
    conf.set(ROWS_AT_ONCE, BODIES_AT_ONCE)
    try:
        return written(deliver(requests, client_factory, attempt), "responses")
    finally:
        conf.set(ROWS_AT_ONCE, before)


def parsed(responses: DataFrame) -> DataFrame:
    """Responses with their ``errors`` flag and items."""
    body = F.from_json("response", RESPONSE_BODY)
    return responses.withColumn("_body", body).select(
        *responses.columns, F.coalesce("_body.errors", F.lit(False)).alias("errors"), F.col("_body.items").alias("items"))


def response_items(responses: DataFrame, op: str = "index", only_errors: bool = True) -> DataFrame:
    """One row per item under the operation's key, with its position in the request."""
    rows = responses.filter("success AND errors") if only_errors else responses.filter("success")
    return rows.select("batch_id", "http_status", F.posexplode("items").alias("pos", "_item")).select(
        "batch_id", "http_status", "pos",
        F.col(f"_item.{op}._index").alias("_index"),
        F.col(f"_item.{op}._id").alias("_id"),
        F.col(f"_item.{op}.status").alias("status"),
        F.col(f"_item.{op}.error").alias("error"))


def failures_by_position(events: DataFrame, responses: DataFrame, op: str = "index") -> DataFrame:
    """Direct mode: item *i* of a response belongs to event *i* of its batch."""
    failed = response_items(responses, op).filter("error IS NOT NULL").select("batch_id", "pos", "status", "error")
    # Rejects are few beside the events, and each place occurs once.
    return attach(events, failed, ["batch_id", "pos"], "inner", label="failed-items")


def error_text(error: Column) -> Column:
    """Type and reason of an error, as reported to the cleaner."""
    return F.concat(
        F.lit("type: "), F.coalesce(error["type"], F.lit(UNKNOWN)),
        F.lit(", reason: "), F.coalesce(error["reason"], F.lit(UNKNOWN)))


def failed_items(responses: DataFrame, op: str = "index") -> DataFrame:
    """Durable mode: items with a failed status and the position their id starts with (null: report only)."""
    items = response_items(responses, op, only_errors=False).filter(F.col("status") >= FIRST_FAILED_STATUS)
    place = F.get(F.split("_id", "_"), F.lit(0)).try_cast("int")
    return items.select(
        "batch_id", "http_status", "_id", "status", error_text(F.col("error")).alias("error_text"),
        place.alias("pos"))


def failures_by_id(events: DataFrame, responses: DataFrame, op: str = "index") -> DataFrame:
    """Failed items with the event at their position; items without one stay, for the report."""
    failed = written(failed_items(responses, op), "failed-items")
    places = failed.select("batch_id", "pos").filter("pos IS NOT NULL").distinct()
    hit = attach(events, places, ["batch_id", "pos"], "inner", label="failed-places")
    return failed.join(hit, ["batch_id", "pos"], "left")


def has_flag(flags: Column, flag: int) -> Column:
    return flags.bitwiseAND(F.lit(flag)) != 0


ROUTES = {"self_log": WRITE_TO_SELF_LOG, "failure_sink": WRITE_TO_FAILURE_SINK, "callback": RAISE_CALLBACK}


def failure_routes(failures: DataFrame, flags: int) -> dict[str, DataFrame]:
    """The failed events per chosen route."""
    return {name: failures for name, flag in ROUTES.items() if flags & flag}


def whole_batch_failures(events: DataFrame, responses: DataFrame) -> DataFrame:
    """Every event of a batch whose request failed as a whole."""
    lost = responses.filter(~F.col("success")).select("batch_id", "http_status")
    return attach(events, lost, ["batch_id"], "inner", label="lost-batches")


class DeliveryFailed(RuntimeError):
    """A whole request failed and the options ask for an exception."""


def handle_failures(
    item_failures: DataFrame, batch_failures: DataFrame, flags: int, handlers: dict[str, Callable[[DataFrame], None]]
) -> None:
    """Hand failures to the caller's handlers. Only a whole failed request may raise, after all handlers ran."""
    for name, rows in failure_routes(item_failures.unionByName(batch_failures, allowMissingColumns=True), flags).items():
        if name in handlers:
            try:
                handlers[name](rows)
            except Exception as error:  # a failing handler must not stop delivery
                if "self_log" in handlers and name != "self_log":
                    handlers["self_log"](rows.limit(1).select(F.lit(f"{name}: {error}").alias("message")))
    if flags & THROW_EXCEPTION and not batch_failures.isEmpty():
        raise DeliveryFailed("a bulk request failed")


def cleaned(failures: DataFrame, cleaner: Callable[[Column, Column, Column], Column]) -> DataFrame:
    """Rejected documents after the caller's cleaner (an expression or pandas UDF of row, status, error)."""
    return failures.filter("pos IS NOT NULL").withColumn(
        "doc", cleaner(F.col("doc"), F.col("status").cast("bigint"), F.col("error_text")))


def dump_rows(failures: DataFrame) -> DataFrame:
    """The rejected lines of each batch, as one dump under its HTTP status; at most a batch of rows each."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", F.array("action", "doc").alias("pair"))))
    return failures.filter("pos IS NOT NULL").groupBy("batch_id").agg(
        F.max("http_status").alias("http_status"), F.max("status").alias("item_status"),
        F.count(F.lit(1)).alias("n_rejected"), ordered.alias("_rows"),
    ).select(
        "batch_id", "http_status", "item_status", "n_rejected",
        F.concat(F.lit("invalid-"), F.col("http_status").cast("string"), F.lit("-"), F.md5("batch_id"), F.lit(".json")).alias("file_name"),
        F.array_join(F.flatten(F.transform("_rows", lambda r: r["pair"])), "\n").alias("payload"))


def retry_delay(failures_in_a_row: Column, period_seconds: float) -> Column:
    """Seconds until the next attempt."""
    ramp = F.least(
        F.lit(float(MAXIMUM_BACKOFF_SECONDS)),
        F.lit(max(float(period_seconds), float(MINIMUM_BACKOFF_SECONDS))) * F.pow(F.lit(2.0), failures_in_a_row - 1))
    return F.when(failures_in_a_row <= 1, F.lit(float(period_seconds))).otherwise(
        F.greatest(F.lit(float(period_seconds)), ramp))


def failure_runs(
    attempts: DataFrame, key: str, order: list[str], success: str = "success", rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """Adds ``failures_in_a_row``: failures since the key's last success, 0 at a success.

    It is the place of an attempt minus the place of the last success before it.
    There are few delivery targets, so each is worked on in many ranges: a range
    hands on its row count and the place of its last success.
    """
    chunk = plan_chunks(attempts, order, rows_per_chunk)
    cut = attempts.withColumns({KEY: whole_key([key]), CHUNK: F.lit(0) if chunk is None else chunk})
    placed = number_rows(cut, [KEY, CHUNK], order, "_place")
    if chunk is not None:
        # Read back, the number of a range is a plain column: Spark turns its expression into a filter on the totals, which lack what it is made of.
        placed = written(placed, "failure-places")
    last = F.max(F.when(F.col(success), F.col("_place")))
    here = Window.partitionBy(KEY, CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumn("_last", last.over(here))
    if chunk is None:
        rows = local.withColumns({"_before": F.lit(0), "_carried": F.lit(0)})
    else:
        totals = placed.groupBy(KEY, CHUNK).agg(F.max("_place").alias("_rows"), last.alias("_last_here"))
        before = Window.partitionBy(KEY).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        carried = offsets.select(
            KEY, CHUNK, "_before",
            F.coalesce(F.max(F.col("_before") + F.col("_last_here")).over(before), F.lit(0)).alias("_carried"))
        rows = local.join(carried.hint("merge"), [KEY, CHUNK])
    since = F.col("_before") + F.col("_place") - F.coalesce(F.col("_before") + F.col("_last"), F.col("_carried"))
    return rows.select(*attempts.columns, since.cast("bigint").alias("failures_in_a_row"))


def committed_positions(attempts: DataFrame, file: str = "file", order: str = "attempt_no", success: str = "success",
                        offset: str = "next_offset") -> DataFrame:
    """Per file, the position that the last successful attempt reached (0 if none).

    A failed batch is sent again from where it starts, so a later success stands
    for everything before it.
    """
    reached = F.max(F.when(F.col(success), F.struct(order, offset)))[offset]
    return attempts.groupBy(file).agg(F.coalesce(reached, F.lit(0)).alias("committed"))


def diagnostics(*kinds: tuple[str, DataFrame, Column]) -> DataFrame:
    """Dropped, rejected and failed rows in one shape: ``(kind, detail)``."""
    rows = [df.select(F.lit(kind).alias("kind"), detail.cast("string").alias("detail")) for kind, df, detail in kinds]
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out


def observed(rows: DataFrame, observation: Observation, **conditions: Column) -> DataFrame:
    """Count rows, and rows of each condition, while they pass through a job that runs anyway."""
    counts = [F.count(F.when(condition, 1)).alias(name) for name, condition in conditions.items()]
    return rows.observe(observation, F.count(F.lit(1)).alias("rows"), *counts)
