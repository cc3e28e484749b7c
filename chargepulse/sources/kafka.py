"""Kafka source and sink.

The Kafka connector jar is not part of the development image, so these are
option builders plus thin reader/writer calls; tests cover the options only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def kafka_source_options(brokers: str, topics, starting_offsets: str | None = None,
                         max_rate_per_partition: int | None = None, partitions: int | None = None,
                         interval_sec: float | None = None,
                         min_partitions: int | None = None,
                         max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Options for ``readStream.format("kafka")``.

    ``starting_offsets`` is ``"earliest"`` (first run) or the JSON built by
    :func:`chargepulse.sources.offsets.starting_offsets_json` (S2, the positions of
    another system).  Once a query has a checkpoint, the checkpoint wins.

    ``max_rate_per_partition`` x ``partitions`` x ``interval_sec`` becomes the
    per-trigger cap ``maxOffsetsPerTrigger`` (T5); ``max_offsets_per_trigger`` gives it directly.

    ``min_partitions`` (``minPartitions``) lets Spark split the offset range of
    a large topic-partition over several tasks, so one hot partition holding a
    third of the messages does not become one task.
    """
    if isinstance(topics, str):
        topics = [topics]
    opts = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": ",".join(sorted(topics)),
        "startingOffsets": starting_offsets or "earliest",
        "failOnDataLoss": "true",
    }
    if max_rate_per_partition:
        if not (partitions and interval_sec):
            raise ValueError("rate cap needs partitions and interval_sec")
        opts["maxOffsetsPerTrigger"] = str(int(max_rate_per_partition * partitions * interval_sec))
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    return opts


def kafka_sink_options(brokers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": brokers, "topic": topic}


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Streaming ``value STRING`` (P1: project the record's value)."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(F.col("value").cast("string").alias("value"))


def write_kafka(lines: DataFrame, options: dict[str, str]) -> None:
    """One message per text line (batch write)."""
    lines.select(F.col("value").cast("string").alias("value")) \
        .write.format("kafka").options(**options).save()
