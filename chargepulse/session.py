"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from chargepulse import storage

# Settings a job of this library wants; applied only where the cluster has not
# chosen a value already.  Launch-time settings must reach the builder before
# the JVM starts; SQL settings are filled in on the running session.
LAUNCH_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Large running-total state (one row per phone and month) lives off-heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}
DEFAULTS = {**LAUNCH_DEFAULTS, **SQL_DEFAULTS}


def get_session(master: str | None = None, app: str = "chargepulse",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session.

    :data:`SQL_DEFAULTS` fill only the keys the cluster left unset
    (spark-defaults, submit arguments); ``shuffle_partitions`` and ``extra``
    are explicit and win.
    """
    wanted = dict(extra or {})
    if shuffle_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    spark = SparkSession.getActiveSession()
    if spark is None:
        b = SparkSession.builder.appName(app)
        if master:
            b = b.master(master)
        for k, v in {**LAUNCH_DEFAULTS, **wanted}.items():
            b = b.config(k, v)
        spark = b.getOrCreate()
    else:
        for k, v in wanted.items():
            spark.conf.set(k, v)
    configured = spark.sparkContext.getConf()
    for k, v in SQL_DEFAULTS.items():
        if not configured.contains(k) and k not in wanted:
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    use_utc(spark)
    return spark


@contextmanager
def setting(spark: SparkSession, conf: dict[str, str]):
    """Session settings for a while, e.g. while a query starts: it copies them then, and a stateful query
    keeps its partition count and state store in its checkpoint from then on."""
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def use_utc(spark: SparkSession) -> None:
    """Message times are UTC text; keep every conversion in UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def parallelism(spark: SparkSession) -> int:
    """Cores of the cluster (falls back to the shuffle partitions setting)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - sessions without a SparkContext (Spark Connect)
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


def checkpoint_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        jdir = spark.sparkContext.getCheckpointDir()
        root = jdir if jdir else None
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        # Local runs only (tests): a temp folder on this machine is shared by all threads.
        root = tempfile.mkdtemp(prefix="chargepulse-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """The name of a fresh folder for one run, under the cluster's shared checkpoint dir.

    All folders of an application lie below one, which goes when the application ends.
    """
    run = f"{checkpoint_root(spark).rstrip('/')}/chargepulse/{spark.sparkContext.applicationId}"
    storage.delete_on_exit(spark, run)
    return f"{run}/{name}-{uuid.uuid4().hex[:12]}"  # the writers create it, on the file system that the path names


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a scratch folder and read it back: a cut lineage that outlives executors."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
