"""File stand-ins for the message queue: staged text files and a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from chargepulse.storage import count_files

LINE_SCHEMA = StructType([StructField("value", StringType())])


def stage_lines(lines: DataFrame, path: str, files: int | None = None) -> str:
    """Write ``value`` lines as text files under ``path`` (``files`` even splits).

    The split is round-robin, so no value of any column can concentrate the
    write in one task.
    """
    (lines.repartition(files) if files else lines).select("value").write.mode("overwrite").text(path)
    return path


def stage_in_batches(spark: SparkSession, lines: DataFrame, path: str, batches: int) -> int:
    """Write ``lines`` with their own partitioning (the file count grows with the
    data) and return the ``maxFilesPerTrigger`` that replays them in ``batches``
    micro-batches."""
    stage_lines(lines, path)
    return max(1, -(-count_files(spark, path) // batches))


def read_lines_stream(spark: SparkSession, path: str,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``value STRING`` over text files (S6's feeder as a file source)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path).select("value")
