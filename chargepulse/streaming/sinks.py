"""Sinks: keyed running totals (S7), per-batch results (S8/T3), relational tables.

All writers are replay-safe: a micro-batch that Spark re-runs after a failure
rewrites exactly its own ``batch_id`` partition (dynamic partition overwrite),
so nothing is counted twice -- unlike additive counters, which double-count a
batch that is replayed after its outputs but before its offsets were stored.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StructType, TimestampType

from chargepulse import storage
from chargepulse.streaming.control import gate_of
from chargepulse.streaming.published import claim_output, foldable, newest_published, publish

BATCH_COL = "batch_id"


def _overwrite_batch(df: DataFrame, path: str, batch_id: int) -> None:
    (df.withColumn(BATCH_COL, F.lit(batch_id).cast("bigint"))
       .write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(BATCH_COL)
       .parquet(path))


# ------------------------------------------------------- position ledger --

#
# _positions/range=K/N.json     the positions of batch N, one small file per batch; K = N div RANGE
# _ledger/range=K               the rows of a whole range, as one table
# _ledger/_done/K               marker, written last; from then on the range's small files do not count

POSITIONS = "batch_id bigint, source int, start_offset string, end_offset string"
RANGE = 1000


def record_positions(spark: SparkSession, checkpoint: str, root: str, batch_id: int) -> None:
    """The batch's positions, one small file per batch.

    Spark writes a batch's end positions to the checkpoint before it runs the batch, and
    keeps only the newest hundred; a replay writes the same file again.
    """
    def ends(b: int) -> list[str]:
        path = f"{checkpoint.rstrip('/')}/offsets/{b}"
        return storage.read_text(spark, path).splitlines()[2:] if b >= 0 and storage.exists(spark, path) else []

    before = ends(batch_id - 1)
    rows = [{"batch_id": batch_id, "source": i, "start_offset": before[i] if i < len(before) else None, "end_offset": e}
            for i, e in enumerate(ends(batch_id))]
    storage.write_text(spark, f"{root.rstrip('/')}/_positions/range={batch_id // RANGE}/{batch_id}.json",
                       "".join(json.dumps(r) + "\n" for r in rows))


def _ranges(spark: SparkSession, root: str) -> tuple[list[int], list[int]]:
    """Ranges that are tables, and ranges that still are small files."""
    done = {int(n) for n in storage.children(spark, f"{root}/_ledger/_done")}
    small = {int(n.split("=")[1]) for n in storage.children(spark, f"{root}/_positions") if n.startswith("range=")}
    return sorted(done), sorted(small - done)


def fold_positions(spark: SparkSession, root: str, upto: int) -> None:
    """Put the position files of every whole range of batches ``<= upto`` into a table; the rows stay.

    Spark reads and writes the rows, one range (``RANGE`` files) a job; the driver knows the numbers of the ranges.  A fold
    that dies before its marker is written again; one that dies after it leaves small files that do not count.
    """
    root = root.rstrip("/")
    done, small = _ranges(spark, root)
    for k in small:
        if (k + 1) * RANGE - 1 <= upto:
            rows = spark.read.schema(POSITIONS).json(f"{root}/_positions/range={k}")
            rows.coalesce(1).write.mode("overwrite").parquet(f"{root}/_ledger/range={k}")
            storage.write_text(spark, f"{root}/_ledger/_done/{k}", "")
            done.append(k)
    for k in done:
        storage.delete(spark, f"{root}/_positions/range={k}")


def read_positions(spark: SparkSession, root: str) -> DataFrame:
    """The positions of every batch that counts, a row per batch and source."""
    root = root.rstrip("/")
    done, small = _ranges(spark, root)
    rows = spark.createDataFrame([], POSITIONS)
    if done:
        rows = rows.unionByName(spark.read.schema(POSITIONS).parquet(*[f"{root}/_ledger/range={k}" for k in done]))
    if small:
        rows = rows.unionByName(spark.read.schema(POSITIONS).json([f"{root}/_positions/range={k}" for k in small]))
    return counted(rows, root)


def counted(rows: DataFrame, root: str, after: int = -1) -> DataFrame:
    """Rows of the batches that count, newer than ``after``."""
    last = newest_published(rows.sparkSession, root)
    rows = rows.where(F.col(BATCH_COL) > after)
    return rows if last is None else rows.where(F.col(BATCH_COL) <= last)


class Recorded:
    """A ``foreachBatch`` body that records the batch's positions after its outputs and then lets the batch count.

    ``once`` skips a batch that counts already (it failed after that, before Spark's commit).  A stateful query
    must run it again all the same, to bring its state up to date; the outputs are then rewritten with the same rows.
    """

    def __init__(self, body, root: str, checkpoint: str, once: bool = True):
        self.body, self.root, self.checkpoint, self.once = body, root, checkpoint, once

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        gate_of(self.root).enter(batch_id)
        if self.once and batch_id <= newest_published(spark, self.root):
            return
        self.body(batch, batch_id)
        record_positions(spark, self.checkpoint, self.root, batch_id)
        publish(spark, self.root, batch_id)


# -------------------------------------------------------------- changelog --
#
# batch_id=N                    keys that batch N changed, with their new values
# _snapshot/upto=U              every key's newest row over the batches <= U
# _snapshot/_done/U             marker, written last; the newest one counts

class ChangelogUpsert:
    """``foreachBatch`` sink for an update-mode aggregate: absolute values per key.

    Every batch writes only the keys it changed, with their new absolute
    values, to ``path/batch_id=<b>``.  The current table is the newest row per
    key (:func:`read_current`).  A batch costs O(changed keys), not O(all keys),
    and a replay rewrites the same partition with the same rows.
    """

    def __init__(self, path: str):
        self.path = path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        _overwrite_batch(batch, self.path, batch_id)


def _snapshots(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n) for n in storage.children(spark, f"{path}/_snapshot/_done"))


def _resolved(log: DataFrame, keys: list[str]) -> DataFrame:
    """The newest row of each key, with its ``batch_id``.

    Values of fixed size are kept in the buffers of a hash aggregation, one ``max_by`` each; it sums up
    before the shuffle, so a hot key is one row per input partition.  Text values need a sort-based one.
    """
    values = [c for c in log.columns if c not in keys and c != BATCH_COL]
    last = F.max(BATCH_COL).alias(BATCH_COL)
    if all(isinstance(log.schema[c].dataType, (NumericType, DateType, TimestampType, BooleanType)) for c in values):
        return log.groupBy(*keys).agg(*[F.max_by(c, BATCH_COL).alias(c) for c in values], last)
    latest = log.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col(BATCH_COL)).alias("v"), last)
    return latest.select(*keys, *[F.col("v").getField(c).alias(c) for c in values], BATCH_COL)


def _changes(spark: SparkSession, path: str) -> DataFrame | None:
    """Snapshot rows and newer changes of the batches that count; None if there are none."""
    done = _snapshots(spark, path)
    low = done[-1] if done else -1
    parts = [spark.read.parquet(f"{path}/_snapshot/upto={low}")] if done else []
    if any(n.startswith(f"{BATCH_COL}=") and int(n.split("=")[1]) > low for n in storage.children(spark, path)):
        log = spark.read.parquet(path)
        parts.append(counted(log.withColumn(BATCH_COL, F.col(BATCH_COL).cast("bigint")), path, low))
    return None if not parts else parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_current(spark: SparkSession, path: str, keys, schema: StructType | None = None) -> DataFrame:
    """One row per key: the values of its newest batch, from the newest snapshot and the batches after it.

    Folded batches are not read (their partitions are pruned, then removed), so the cost is that of
    the keys and of the changes since.
    """
    path = path.rstrip("/")
    log = _changes(spark, path)
    if log is None:
        if schema is None:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    return _resolved(log, list(keys)).drop(BATCH_COL)


def snapshot(spark: SparkSession, path: str, keys, upto: int | None = None) -> int:
    """Fold the committed batches (not beyond ``upto``) into a new snapshot; returns the newest folded batch, -1 if none.

    It counts once its marker is written.  What it folds stays until the next snapshot, so tables that were read before
    it still find their files; a call with nothing to fold removes that too.
    """
    path = path.rstrip("/")
    done, upto = _snapshots(spark, path), foldable(spark, path, upto)
    low = done[-1] if done else -1
    old = low
    if upto > low:
        log = _changes(spark, path)
        if log is not None:
            _resolved(log.where(F.col(BATCH_COL) <= upto), list(keys)).write.mode("overwrite").parquet(f"{path}/_snapshot/upto={upto}")
            storage.write_text(spark, f"{path}/_snapshot/_done/{upto}", str(low))
            done.append(upto)
    for name in storage.children(spark, path):
        if name.startswith(f"{BATCH_COL}=") and int(name.split("=")[1]) <= old:
            storage.delete(spark, f"{path}/{name}")
    for u in done[:-2]:
        storage.delete(spark, f"{path}/_snapshot/_done/{u}")
        storage.delete(spark, f"{path}/_snapshot/upto={u}")
    return done[-1] if done else -1


def compact(spark: SparkSession, path: str, keys, out_path: str) -> DataFrame:
    """Write the resolved current table to ``out_path``, for readers outside this library, and return it."""
    cur = read_current(spark, path, keys)
    cur.write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)


class PerBatchWriter:
    """``foreachBatch`` sink: run each named report on the batch, keep every batch's rows.

    Output ``root/<name>/batch_id=<b>``.  The batch is persisted while its
    reports run, so the source is read once per batch.
    """

    def __init__(self, root: str, reports: dict):
        self.root = root.rstrip("/")
        self.reports = reports

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        many = len(self.reports) > 1
        if many:
            batch = batch.persist()
        try:
            for name, fn in self.reports.items():
                _overwrite_batch(fn(batch), f"{self.root}/{name}", batch_id)
        finally:
            if many:
                batch.unpersist()


def read_batches(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The rows of report ``name`` of every batch that counts."""
    return counted(spark.read.parquet(f"{root.rstrip('/')}/{name}"), root)


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, batch_size: int = 1000,
                 truncate: bool = False) -> dict[str, str]:
    """Options of Spark's JDBC writer (prepared, batched inserts).

    ``truncate=True`` with mode ``overwrite`` republishes a table from the
    replay-safe Parquet results without dropping its definition.
    """
    opts = {"url": url, "dbtable": table, "batchsize": str(batch_size),
            "isolationLevel": "READ_COMMITTED"}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver:
        opts["driver"] = driver
    if truncate:
        opts["truncate"] = "true"
    return opts


def write_jdbc(df: DataFrame, options: dict[str, str], mode: str = "append") -> None:
    """Write rows to a relational table (append, or overwrite with ``truncate``)."""
    df.write.format("jdbc").options(**options).mode(mode).save()

