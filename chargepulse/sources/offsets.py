"""S3: stored consumer positions -> ``startingOffsets`` JSON.

A position ledger holds rows ``(group_id, field, offset)`` where ``field`` is
``topic-partition``.  The split is at the *last* hyphen, so topics that contain
hyphens survive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

FIELD_RE = r"^(.*)-([0-9]+)$"


def _parsed(ledger: DataFrame) -> DataFrame:
    partition = F.regexp_extract("field", FIELD_RE, 2).try_cast("int")
    return ledger.select("group_id", "field", F.col("offset").cast("string").alias("offset"),
                         F.regexp_extract("field", FIELD_RE, 1).alias("topic"), partition.alias("partition"),
                         F.col("offset").try_cast("bigint").alias("position")).withColumn(
        "bad", (F.col("topic") == "") | F.col("topic").isNull() | F.col("partition").isNull()
        | F.col("position").isNull() | (F.col("position") < 0))


def ledger_rows(ledger: DataFrame) -> DataFrame:
    """``(group_id, topic, partition, offset)`` from ``(group_id, field, offset)``.

    Of several positions of one topic-partition the greatest holds.  Rows that are no
    position are in :func:`ledger_quarantine`.
    """
    return (_parsed(ledger).where("not bad").groupBy("group_id", "topic", "partition")
            .agg(F.max("position").alias("offset")))


def ledger_quarantine(ledger: DataFrame) -> DataFrame:
    """``(group_id, field, offset)`` of the rows whose field or offset is malformed."""
    return _parsed(ledger).where("bad").select("group_id", "field", "offset")


def starting_offsets_json(ledger: DataFrame) -> DataFrame:
    """``(group_id, partitions, starting_offsets)``: one JSON document per group.

    ``{"topic":{"0":5,"1":9}}`` with topics and partitions in ascending order.
    Two small aggregations; the ledger has one row per topic-partition.
    """
    rows = ledger_rows(ledger)
    per_topic = rows.groupBy("group_id", "topic").agg(
        F.map_from_entries(F.array_sort(F.collect_list(
            F.struct(F.col("partition").alias("p"), F.col("offset").alias("o")))))
        .alias("pm"),
        F.count("*").alias("n"))
    per_topic = per_topic.select(
        "group_id", "topic", "n",
        F.map_from_arrays(F.transform(F.map_keys("pm"), lambda k: k.cast("string")),
                          F.map_values("pm")).alias("pm"))
    return per_topic.groupBy("group_id").agg(
        F.sum("n").alias("partitions"),
        F.to_json(F.map_from_entries(F.array_sort(
            F.collect_list(F.struct("topic", "pm")),
            lambda a, b: F.when(a["topic"] < b["topic"], -1)
                          .when(a["topic"] > b["topic"], 1).otherwise(0))))
        .alias("starting_offsets"))
