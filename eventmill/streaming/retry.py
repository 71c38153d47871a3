"""Failed attempts that come back after their delay, by timers of keyed state.

The number of failures in a row belongs to a target. Each failed attempt waits in
the state of its target under the time it is due; a processing-time timer brings it
back then, once, also when the query was stopped meanwhile. All that is due at one
time is one timer: the delays are few.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from eventmill.options import MAXIMUM_BACKOFF_SECONDS, MINIMUM_BACKOFF_SECONDS
from eventmill.streaming.durable import with_state

WAITING = "attempts array<struct<attempt_no: long, payload: string, failures_in_a_row: long>>, delay_seconds double"
RETRY = "target string, attempt_no long, payload string, failures_in_a_row long, delay_seconds double, due_ms long, sent_ms long"


def delay_after(failures: int, period_seconds: float) -> float:
    """Seconds to the next attempt; the same as :func:`operators.delivery.retry_delay` of a Column."""
    if failures <= 1:
        return float(period_seconds)
    steps = min(failures - 1, 64)  # far beyond the cap
    return max(float(period_seconds), min(float(MAXIMUM_BACKOFF_SECONDS), max(float(period_seconds), float(MINIMUM_BACKOFF_SECONDS)) * 2.0**steps))


class Backoff(StatefulProcessor):
    """State of a target: its failures in a row, and what waits, by the time it is due."""

    def __init__(self, period_seconds: float, clock: float):
        self.period, self.clock = period_seconds, clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.failures = handle.getValueState("failures", "n long")
        self.waiting = handle.getMapState("waiting", "due_ms long", WAITING)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        attempts = pd.concat(list(rows)).sort_values(["ts", "attempt_no"], kind="stable")
        before = self.failures.get()[0] if self.failures.exists() else 0
        runs = attempts.success.cumsum()
        in_a_row = (~attempts.success).groupby(runs).cumsum() + before * (runs == 0)
        self.failures.update((int(in_a_row.iloc[-1]),))
        failed = attempts[~attempts.success].assign(n=in_a_row[~attempts.success])
        now = timerValues.getCurrentProcessingTimeInMs()
        for delay, group in failed.groupby(failed.n.map(lambda n: delay_after(int(n), self.period))):
            due = (now + int(delay * 1000 * self.clock),)
            new = [(int(a), p, int(n)) for a, p, n in zip(group.attempt_no, group.payload, group.n)]
            if self.waiting.containsKey(due):
                new = [tuple(a) for a in self.waiting.getValue(due)[0]] + new
            self.waiting.updateValue(due, (new, float(delay)))
            self.handle.registerTimer(due[0])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due = (expiredTimerInfo.getExpiryTimeInMs(),)
        if not self.waiting.containsKey(due):
            return
        attempts, delay = self.waiting.getValue(due)
        self.waiting.removeKey(due)
        found = pd.DataFrame([tuple(a) for a in attempts], columns=["attempt_no", "payload", "failures_in_a_row"])
        yield found.assign(target=key[0], delay_seconds=delay, due_ms=due[0], sent_ms=timerValues.getCurrentProcessingTimeInMs())[
            ["target", "attempt_no", "payload", "failures_in_a_row", "delay_seconds", "due_ms", "sent_ms"]]

    def close(self) -> None:
        pass


def retries(attempts: DataFrame, period_seconds: float, clock: float = 1.0) -> DataFrame:
    """The failed ones of a stream of ``attempts(target, attempt_no, ts, success, payload)``, each when its delay is over.

    Attempts of a target arrive in order, step by step; within a step they are put
    in order of ``(ts, attempt_no)``, so a step should be bounded (files or bytes
    per trigger). ``clock`` shortens delays, for tests and drills.
    """
    with_state(attempts.sparkSession)
    return attempts.select("target", "attempt_no", "ts", "success", "payload").groupBy("target").transformWithStateInPandas(
        Backoff(period_seconds, clock), outputStructType=RETRY, outputMode="append", timeMode="processingTime")
