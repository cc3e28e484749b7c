"""Deal an input that arrives in too few partitions to more, where the caller asks for it.

An input is read in as many splits as its files and ``spark.sql.files.maxPartitionBytes``
give.  Only an unsplittable one (one row group, a single-partition topic) needs this; whether it is
worth a shuffle of the raw rows is the caller's knowledge, so there is no default.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    return df if partitions is None or df.isStreaming else df.repartition(partitions)
