"""Streaming jobs over a message stream (Kafka or files).

* :func:`running_totals` -- T4: a KPI as a stateful aggregate in update mode,
  stored through :class:`ChangelogUpsert`.
* :func:`watermarked_totals` -- T4: the same for additive KPIs, with the late rows in a table of their own.
* :func:`per_batch` -- T2/T3: reports of each micro-batch, appended by batch.
* :func:`raw_to_files` -- S9/T1: the parsed stream itself to a file sink.

A restart with the same ``checkpoint`` resumes after the last committed batch
(T6); sources and sinks here are all replayable or idempotent.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from chargepulse import storage
from chargepulse.plans.rollup import EVENT_BUCKET, with_event_bucket
from chargepulse.session import setting
from chargepulse.streaming.sinks import (
    BATCH_COL, ChangelogUpsert, PerBatchWriter, Recorded, _overwrite_batch, claim_output, read_batches, read_positions,
)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _trigger(writer, trigger: str | None):
    if trigger is None or trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def running_totals(clean_stream: DataFrame, kpi: Callable[[DataFrame], DataFrame], sink_path: str,
                   checkpoint: str, trigger: str | None = None, name: str | None = None,
                   watermark: tuple[str, str, str] | None = None,
                   state_partitions: int | None = None,
                   state_store: str | None = ROCKSDB) -> StreamingQuery:
    """T4: ``kpi(clean_stream)`` kept as running totals (update mode + changelog sink).

    Without ``watermark`` (the default, as in the reference) every key stays in
    state forever and a late message still adds to its own bucket.  With
    ``watermark=(time_key, pattern, delay)``, e.g. ``("minute", "yyyyMMddHHmm",
    "2 hours")``, buckets older than ``delay`` are evicted and later rows for
    them are dropped; :func:`watermarked_totals` keeps those rows.

    ``state_partitions`` (default: the session's shuffle partitions) and
    ``state_store`` (default RocksDB: state off the JVM heap, incremental
    checkpoints) are fixed at the first batch and kept by the checkpoint; size
    the partitions to the number of keys (days: a handful; phone-months: many).
    """
    if watermark:
        if watermark[0] not in kpi(clean_stream).columns:
            raise ValueError(f"the watermark's time key {watermark[0]!r} is not a key of this KPI; "
                             "a bucket finer than the key would split its sums")
        clean_stream = with_event_bucket(clean_stream, *watermark)
    claim_output(clean_stream.sparkSession, sink_path, checkpoint)
    agg = kpi(clean_stream)
    w = (agg.writeStream.outputMode("update")
         .foreachBatch(Recorded(ChangelogUpsert(sink_path), sink_path, checkpoint, once=False))
         .option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    conf = {}
    if state_partitions:
        conf["spark.sql.shuffle.partitions"] = str(state_partitions)
    if state_store:
        conf["spark.sql.streaming.stateStore.providerClass"] = state_store
    with setting(clean_stream.sparkSession, conf):
        return _trigger(w, trigger).start()


class _LateSplit:
    """``foreachBatch`` body: the sums of the rows in time, and the late rows as they are."""

    def __init__(self, root: str, checkpoint: str, kpi: Callable[[DataFrame], DataFrame]):
        self.root, self.checkpoint, self.kpi = root.rstrip("/"), checkpoint.rstrip("/"), kpi

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        behind = batch_watermark(batch.sparkSession, self.checkpoint, batch_id)
        late = F.coalesce(F.unix_millis(EVENT_BUCKET) <= behind, F.lit(False))
        rows = batch.withColumn("_late", late).drop(EVENT_BUCKET).persist()
        try:
            _overwrite_batch(self.kpi(rows.where("not _late").drop("_late")), f"{self.root}/sums", batch_id)
            _overwrite_batch(rows.where("_late").drop("_late"), f"{self.root}/late", batch_id)
        finally:
            rows.unpersist()


def batch_watermark(spark, checkpoint: str, batch_id: int) -> int:
    """The watermark that a batch runs with, in ms: Spark logs it with the batch's positions before the batch runs."""
    log = storage.read_text(spark, f"{checkpoint.rstrip('/')}/offsets/{batch_id}").splitlines()
    return int(json.loads(log[1])["batchWatermarkMs"])


def watermarked_totals(clean_stream: DataFrame, kpi: Callable[[DataFrame], DataFrame], root: str, checkpoint: str,
                       watermark: tuple[str, str, str], trigger: str | None = None) -> StreamingQuery:
    """T4: totals of the rows in time, and the rows behind the watermark in a table of their own.

    ``kpi`` is additive (counts and sums).  A batch's watermark is the one that Spark logs for it, so a replay splits the rows alike: a row
    is late if its bucket is not after the newest bucket of earlier batches less the delay.  Late rows are kept whole before
    anything is summed (:func:`late_rows`); what is in time is summed per batch (:func:`read_totals` adds up), so no
    state is kept, and a bucket behind the watermark never changes.  Totals and late rows together are all rows.
    """
    stream = with_event_bucket(clean_stream, *watermark)
    claim_output(stream.sparkSession, root, checkpoint)
    w = (stream.writeStream.foreachBatch(Recorded(_LateSplit(root, checkpoint, kpi), root, checkpoint, once=False))
         .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


def read_totals(spark, root: str, keys: list[str]) -> DataFrame:
    """The totals of :func:`watermarked_totals` over the batches that count."""
    sums = read_batches(spark, root, "sums").drop(BATCH_COL)
    return sums.groupBy(*keys).agg(*[F.sum(c).cast(sums.schema[c].dataType).alias(c) for c in sums.columns if c not in keys])


def late_rows(spark, root: str) -> DataFrame:
    """The clean rows that came behind the watermark, with the ``batch_id`` that brought them."""
    return read_batches(spark, root, "late")


def per_batch(clean_stream: DataFrame, reports: dict[str, Callable[[DataFrame], DataFrame]],
              root: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Each report over each micro-batch, kept per ``batch_id``."""
    claim_output(clean_stream.sparkSession, root, checkpoint)
    w = (clean_stream.writeStream.foreachBatch(Recorded(PerBatchWriter(root, reports), root, checkpoint))
         .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


def raw_to_files(stream: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
                 fmt: str = "parquet") -> StreamingQuery:
    """S9 in queryable form: append the rows to a file sink (exactly once via its log)."""
    w = (stream.writeStream.format(fmt).outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


def console(stream: DataFrame, trigger: str | None = "2 seconds", rows: int = 2_147_483_647) -> StreamingQuery:
    """Print each batch, all its rows unless ``rows`` says less (development only)."""
    w = stream.writeStream.format("console").option("numRows", str(rows)).option("truncate", "false")
    return _trigger(w, trigger).start()


def run_to_end(q: StreamingQuery, timeout_sec: float | None = None) -> None:
    """Wait for an ``availableNow`` query; raise if it failed or did not finish in time."""
    finished = q.awaitTermination(timeout_sec)
    if finished is False or q.isActive:
        q.stop()
        raise TimeoutError(f"streaming query {q.id} did not finish within {timeout_sec} s")
    err = q.exception()
    if err is not None:
        raise RuntimeError(f"streaming query failed: {err}")


def progress_ledger(spark, root: str) -> DataFrame:
    """Positions of every batch that counts in ``root``: ``batch_id, source, start_offset, end_offset``.

    ``source`` numbers the query's sources; offsets are their JSON (for Kafka
    ``{"topic":{"0":123}}``, the form ``startingOffsets`` takes).  Each batch records its own
    row, so the ledger forgets nothing.
    """
    return read_positions(spark, root)


def resume_positions(ledger: DataFrame) -> DataFrame:
    """``(source, end_offset)`` of the newest batch per source."""
    return ledger.groupBy("source").agg(F.max_by("end_offset", "batch_id").alias("end_offset"))
