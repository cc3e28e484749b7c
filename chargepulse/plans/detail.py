"""Parse once, query many: the cleaned detail as a day-partitioned Parquet table.

JSON parsing is the dominant per-row cost.  Writing the cleaned rows once, as
columnar data partitioned by ``day``, lets every later KPI read only the
columns it uses and only the days it asks for (partition pruning), and cuts
the lineage back to the raw messages (a written table in the shared folder
survives lost executors).

How many tasks write a day follows from the day's bytes: the rows are rebalanced by day, which splits a
day that is larger than ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` and joins small ones, from the
sizes that the shuffle has measured.  A day, an hour or a minute holding a third of all rows is so many times that size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

PARTITION_COL = "day"


def by_bytes(rows: DataFrame, day: str = PARTITION_COL) -> DataFrame:
    """Deal rows for writing by ``day``: tasks of about the advisory partition size, by measured bytes (needs AQE)."""
    return rows.hint("rebalance", F.col(day))


def write_detail(clean: DataFrame, path: str, files: int | None = None, salts: int = 64) -> str:
    """Write clean rows (with ``day`` and ``request_id``, whatever else) under ``path/day=<yyyyMMdd>/``.

    By default the number of writers of a day follows from its bytes.  ``files`` fixes the number of
    writer tasks instead, over ``salts`` of which a single day is then spread.
    """
    if files is None:
        dealt = by_bytes(clean)
    else:
        salt = F.pmod(F.xxhash64("request_id"), F.lit(min(salts, files)))
        dealt = clean.withColumn("_salt", salt).repartition(files, PARTITION_COL, "_salt").drop("_salt")
    dealt.write.mode("overwrite").partitionBy(PARTITION_COL).parquet(path)
    return path


def read_detail(spark: SparkSession, path: str, first_day: str | None = None,
                last_day: str | None = None) -> DataFrame:
    """The detail table, optionally limited to ``[first_day, last_day]`` (partition pruning)."""
    df = spark.read.option("basePath", path).parquet(path) \
        .withColumn(PARTITION_COL, F.lpad(F.col(PARTITION_COL).cast("string"), 8, "0"))
    if first_day:
        df = df.where(F.col(PARTITION_COL) >= first_day)
    if last_day:
        df = df.where(F.col(PARTITION_COL) <= last_day)
    return df
