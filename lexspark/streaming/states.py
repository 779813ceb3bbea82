"""States of deliveries kept by the stream itself: what was done, how often a delivery was tried, and manifests that are waited for.

A queue (a producer's folder) is a key; its state lives in Spark's state store and goes with the checkpoint, so that no
file of former states is read again. Timers tell manifests that don't come.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lexspark.operators.deliveries import BLOCKED, DONE, DUPLICATE, FAILED, LOADING, PARTIAL

EVENTS = "queue string, run long, at timestamp, zip string, sha256 string, manifest boolean, convert_error string, accepted long, rejected long, zip_errors long, pending boolean, failed boolean"
STATES = "queue string, run long, zip string, state string, reason string, attempt int"
WAITING, OVERDUE = "pending_manifest", "manifest_overdue"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PIECE = 65_536


def end_of(r, done: bool, first: bool) -> tuple[str, str | None]:
    """State and reason of one delivery by itself."""
    count = lambda x: 0 if x is None or pd.isna(x) else int(x)
    if done or not first:
        return DUPLICATE, None
    if isinstance(r.convert_error, str):
        return FAILED, r.convert_error
    if r.pending is True:
        return LOADING, None
    if r.failed is True:
        return FAILED, "load_failed"
    if count(r.rejected) == 0 and count(r.zip_errors) == 0:
        return DONE, None
    return (FAILED, "all_rejected") if count(r.accepted) == 0 else (PARTIAL, None)


class Deliveries(StatefulProcessor):
    """One queue's runs, in order. Within a run deliveries go by name: behind one that is loading the others are blocked."""

    def __init__(self, wait_ms: int, most_attempts: int):
        self.wait_ms, self.most_attempts = wait_ms, most_attempts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.done = handle.getMapState("done", "sha256 string", "zip string")
        self.tries = handle.getMapState("tries", "zip string", "n int")
        self.waits = handle.getMapState("waits", "zip string", "until long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        """Calls to the store cost far more than a row's rules: open deliveries (tried or waiting) are read once for a batch, each digest is asked for once."""
        given = pd.concat([b.drop(columns="queue") for b in rows]).sort_values(["run", "zip"], kind="stable")
        self.tried = {name: n for (name,), (n,) in self.tries.iterator()}
        self.waiting = {name for (name,) in self.waits.keys()}
        self.known: dict[str, bool] = {}
        for run, part in given.groupby("run"):
            told = self._run(key[0], int(run), part)
            while some := list(islice(told, PIECE)):
                yield pd.DataFrame(some, columns=["queue", "run", "zip", "state", "reason", "attempt"])

    def _done(self, sha: str) -> bool:
        if sha not in self.known:
            self.known[sha] = self.done.containsKey((sha,))
        return self.known[sha]

    def _run(self, queue: str, run: int, part: pd.DataFrame) -> Iterator[tuple]:
        first: dict[str, str] = {}
        for sha, name in zip(part["sha256"], part["zip"]):
            first.setdefault(sha, name)
        blocked, finished = False, {}
        for r in part.itertuples():
            n = self.tried.get(r.zip, 0)
            if r.manifest is False:
                until = int(pd.Timestamp(r.at).timestamp() * 1000) + self.wait_ms
                if r.zip not in self.waiting:
                    self.waiting.add(r.zip)
                    self.waits.updateValue((r.zip,), (until,))
                    self.handle.registerTimer(until)
                yield queue, run, r.zip, WAITING, None, n
                continue
            if r.zip in self.waiting:
                self.waiting.remove(r.zip)
                self.waits.removeKey((r.zip,))
            if blocked:
                yield queue, run, r.zip, BLOCKED, None, n
                continue
            state, reason = end_of(r, self._done(r.sha256), first[r.sha256] == r.zip)
            n += state == LOADING
            if state == LOADING and n >= self.most_attempts:
                state, reason = FAILED, "attempts_exhausted"
            blocked = state == LOADING
            if blocked:
                self.tried[r.zip] = int(n)
                self.tries.updateValue((r.zip,), (int(n),))
            elif r.zip in self.tried:
                del self.tried[r.zip]
                self.tries.removeKey((r.zip,))
            if state in (DONE, PARTIAL):
                finished[r.sha256] = r.zip
            yield queue, run, r.zip, state, reason, int(n)
        for sha, name in finished.items():  # a run sees what earlier ones did
            self.known[sha] = True
            self.done.updateValue((sha,), (name,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        late = [name for (name,), (until,) in self.waits.iterator() if until <= now]
        for name in late:
            self.waits.removeKey((name,))
        yield pd.DataFrame([(key[0], -1, name, OVERDUE, None, 0) for name in sorted(late)], columns=["queue", "run", "zip", "state", "reason", "attempt"])

    def close(self) -> None:
        pass


def delivery_states(events: DataFrame, wait: str = "3 days", wait_ms: int = 259_200_000, most_attempts: int = 5) -> DataFrame:
    """queue, run, zip, state, reason and attempt of each delivery of each run, as the stream of events goes on.

    events: a stream of EVENTS, a run's rows in one batch. Times are those of `at`, late by `wait` at most; a manifest
    that hasn't come wait_ms after its delivery gives a row manifest_overdue (run -1), once. A delivery that loads for
    the most_attempts-th time fails. Needs the RocksDB state store (STORE).
    """
    given = events.withWatermark("at", wait)
    return given.groupBy("queue").transformWithStateInPandas(Deliveries(wait_ms, most_attempts), outputStructType=STATES, outputMode="Append", timeMode="EventTime")
