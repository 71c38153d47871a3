"""Sending request rows and dealing with what comes back."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.operators import delivery
from eventmill.operators.bulk import request_bodies, request_lines
from eventmill.session import written

Cleaner = Callable[[Column, Column, Column], Column]


@dataclass(frozen=True)
class Outcome:
    """What became of the request rows."""

    responses: DataFrame
    item_failures: DataFrame
    batch_failures: DataFrame
    resent: DataFrame | None
    dumps: DataFrame


def bodies(rows: DataFrame) -> DataFrame:
    """Request bodies of ``rows(batch_id, pos, action, doc)``."""
    return request_bodies(rows.withColumn("lines", request_lines(F.col("action"), F.col("doc"))))


def ship_direct_rows(rows: DataFrame, client_factory: Callable[[], delivery.Client], op: str = "index") -> Outcome:
    """Direct mode: failures are found by their place in the request."""
    responses = delivery.parsed(delivery.sent(bodies(rows), client_factory))
    failures = delivery.failures_by_position(rows, responses, op)
    with_text = failures.withColumns({"error_text": delivery.error_text(F.col("error")), "http_status": F.lit(None).cast("int")})
    return Outcome(responses, failures, delivery.whole_batch_failures(rows, responses), None, delivery.dump_rows(with_text))


def ship_durable_rows(
    rows: DataFrame, client_factory: Callable[[], delivery.Client], op: str = "index", cleaner: Cleaner | None = None
) -> Outcome:
    """Durable mode: failures are found by the position in their id, cleaned and sent once more.

    Rows and failures are kept in the shared folder: they are read several times, and making documents is most of the work.
    """
    rows = written(rows, "request-rows")
    responses = delivery.parsed(delivery.sent(bodies(rows), client_factory))
    failures = written(delivery.failures_by_id(rows, responses, op), "item-failures")
    resent = None
    if cleaner is not None:
        again = bodies(delivery.cleaned(failures, cleaner))
        resent = delivery.parsed(delivery.sent(again, client_factory, attempt=2))
    return Outcome(responses, failures, delivery.whole_batch_failures(rows, responses), resent, delivery.dump_rows(failures))
