"""Tables, shared scratch space and small column helpers of the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chargepulse.session import checkpoint_root


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of ``sf_dir``.

    Texts are large rows, so Arrow batches hold 1,000 of them where the session has not chosen a
    number itself; otherwise a batch of long texts alone would fill a worker.
    """
    if not spark.sparkContext.getConf().contains(ARROW_ROWS) and spark.conf.get(ARROW_ROWS) == "10000":
        spark.conf.set(ARROW_ROWS, "1000")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, which all executors share."""
    return f"{checkpoint_root(spark).rstrip('/')}/chargepulse/llm/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage with files that outlive executors, and gives the planner the
    real size of the table, so a broadcast is chosen from measured bytes only.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def fingerprint(*cols: Column | str) -> list[Column]:
    """Two independent 64-bit hashes; equal pairs stand for equal values."""
    return [F.xxhash64(F.lit(seed), *cols).alias(name) for seed, name in ((11, "fp_a"), (29, "fp_b"))]


def slices(batch, chars: int = 1_000_000, col: str = "text"):
    """Parts of an Arrow batch of about so many bytes of text each, so that Python objects are few at a time.

    A text longer than that is a part of its own, whole.
    """
    import numpy as np
    import pyarrow.compute as pc
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(col)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size, dtype=np.int64) // chars
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield batch.slice(a, b - a)


def trimmed(work):
    """An Arrow function that gives its task's memory back to the system when it ends.

    Spark keeps Python workers between tasks, and allocators keep what a task has freed.
    """
    def run(batches):
        try:
            yield from work(batches)
        finally:
            give_back()
    return run


def give_back() -> None:
    """Return freed memory to the system; allocators otherwise keep it."""
    import ctypes
    import gc

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
