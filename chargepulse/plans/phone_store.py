"""A7/M10 from a stored table of top-up sums, bucketed by phone.

The store holds one row per (month, phone, day), partitioned by month and bucketed by phone.  Rows of a phone lie in one
bucket, so sums by phone or by (month, phone) need no exchange, however large the store is; only a new day's sums are dealt
to the buckets once.  Putting a day again replaces it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from chargepulse import storage
from chargepulse.session import setting

COLUMNS = "phone STRING, day STRING, orders BIGINT, money BIGINT, month STRING"


class PhoneStore:
    """A store below ``path``; ``buckets`` is fixed when it is made (default: the session's shuffle partitions).

    The table's definition lives in the session's catalog under a name made from the path, its files and their number of
    buckets below the path, so any session can open it.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        if not storage.exists(spark, f"{self.path}/_buckets"):
            storage.write_text(spark, f"{self.path}/_buckets", str(buckets or spark.conf.get("spark.sql.shuffle.partitions")))
        self.buckets = int(storage.read_text(spark, f"{self.path}/_buckets"))
        self.name = f"phone_store_{hashlib.sha256(self.path.encode()).hexdigest()[:16]}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({COLUMNS}) USING parquet PARTITIONED BY (month) "
                  f"CLUSTERED BY (phone) SORTED BY (phone) INTO {self.buckets} BUCKETS LOCATION '{self.path}/sums'")

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def _kept(self, days: DataFrame) -> DataFrame:
        """Stored rows of the months of ``days`` that are not of these days; the stored side is not exchanged.

        ``days`` holds calendar days (valid ISO dates, at most 3.7 million of them in all), so it is broadcast.
        """
        months = [r[0] for r in days.select("_month").distinct().collect()]
        old = self.read().where(F.col("month").isin(months))
        return old.join(F.broadcast(days), (old["month"] == days["_month"]) & (old["day"] == days["_day"]), "left_anti")

    def put(self, sums: DataFrame) -> None:
        """Put whole days: ``(month, day, phone, orders, money)``, one row per phone and day.

        The months of these days are rewritten, the other ones are not read.  Of the store only a bucket's own task touches a
        bucket; days that are put again lose their old rows first, so a repeated put changes nothing.  One put at a time.
        """
        new = sums.select("phone", "day", "orders", "money", "month").repartition(self.buckets, "phone")
        days = sums.select(F.col("month").alias("_month"), F.col("day").alias("_day")).distinct()
        with setting(self.spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic",
                                  "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}):
            self._kept(days).select(new.columns).unionByName(new).write.insertInto(self.name, overwrite=True)
        self.spark.catalog.refreshTable(self.name)
