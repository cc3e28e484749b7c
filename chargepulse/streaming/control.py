"""Stopping a running query between two batches.

A stop is asked for by a marker in the output folder, from any machine (:func:`ask_to_stop`).  The
application's listener looks for it after every batch and while the query is idle.  From then on no new
batch begins; the running one finishes and is committed; then the query is stopped.
"""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from chargepulse import storage

MARKER = "_stop"


class StoppedBeforeBatch(RuntimeError):
    """A batch did not begin because its query is to stop; it runs after the restart."""


class Gate:
    """Lets batches of one output folder begin until it is closed."""

    def __init__(self):
        self.closed = threading.Event()

    def enter(self, batch_id: int) -> None:
        if self.closed.is_set():
            raise StoppedBeforeBatch(f"batch {batch_id} waits for the restart")


_gates: dict[str, Gate] = {}


def gate_of(root: str) -> Gate:
    return _gates.setdefault(root.rstrip("/"), Gate())


def ask_to_stop(spark: SparkSession, root: str) -> None:
    """Ask the application that writes to ``root`` to stop after its running batch."""
    storage.write_text(spark, f"{root.rstrip('/')}/{MARKER}", "")


class _Watch(StreamingQueryListener):
    """Wakes the application when its marker is there or its query has ended."""

    def __init__(self, spark: SparkSession, q: StreamingQuery, root: str):
        self.spark, self.id, self.marker, self.wake = spark, str(q.id), f"{root.rstrip('/')}/{MARKER}", threading.Event()

    def _look(self, query_id) -> None:
        if str(query_id) == self.id and storage.exists(self.spark, self.marker):
            self.wake.set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._look(event.progress.id)

    def onQueryIdle(self, event) -> None:
        self._look(event.id)

    def onQueryTerminated(self, event) -> None:
        if str(event.id) == self.id:
            self.wake.set()


def stop_cleanly(spark: SparkSession, q: StreamingQuery, root: str, poll: float = 0.05) -> None:
    """Let the running batch finish and be committed, then stop; the marker goes.

    A batch that would begin meanwhile is refused before it writes anything; Spark runs it after the restart, from the
    same positions.
    """
    gate = gate_of(root)
    gate.closed.set()
    try:
        pause = threading.Event()
        while q.isActive and q.status["isTriggerActive"]:
            pause.wait(poll)
        q.stop()
        error = q.exception()
        if error is not None and StoppedBeforeBatch.__name__ not in str(error):
            raise error
    finally:
        gate.closed.clear()
        storage.delete(spark, f"{root.rstrip('/')}/{MARKER}")


def run_until_stopped(spark: SparkSession, q: StreamingQuery, root: str) -> str:
    """Wait until the query ends (``"ended"``) or is asked to stop and has stopped (``"stopped"``).

    A failed query raises its error.  A marker that is there before the query starts stops it after its first batch.
    """
    watch = _Watch(spark, q, root)
    spark.streams.addListener(watch)
    try:
        while q.isActive and not watch.wake.wait(60):
            pass
    finally:
        spark.streams.removeListener(watch)
    if q.isActive:
        stop_cleanly(spark, q, root)
        return "stopped"
    if q.exception() is not None:
        raise q.exception()
    return "ended"
