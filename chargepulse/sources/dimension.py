"""The province dimension (text ``code name``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_province_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def province_dim(lines: DataFrame) -> DataFrame:
    """``(province_code, province)``, one row per code.

    Lines split on a single space, tokens 0 and 1.  Blank or one-token lines are
    dropped.  A code listed twice keeps the smallest name, so the lookup stays
    a function of the code (a map would silently keep an arbitrary one).
    """
    parts = F.split(F.col("value"), " ")
    kv = lines.select(parts.getItem(0).alias("province_code"),
                      F.get(parts, 1).alias("province"))
    kv = kv.where((F.col("province_code") != "") & F.col("province").isNotNull())
    return kv.groupBy("province_code").agg(F.min("province").alias("province"))
