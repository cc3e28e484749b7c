"""Additive roll-up shared by all KPIs.

A KPI input is either clean rows (one per message) or an already summed
frame that carries an ``orders`` column.  Counts, money and milliseconds are
all sums, so any coarser grain can be computed from a finer one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Name of the optional watermarked event-time column (see ``with_event_bucket``).
EVENT_BUCKET = "event_bucket"

_CAST = {"orders": "bigint", "success": "bigint", "costtime": "bigint", "ms": "bigint",
         "money": "decimal(28,2)", "should_money": "decimal(28,2)"}


def rollup(df: DataFrame, keys, measures, typed: dict[str, str] | None = None, orders_as: str = "orders") -> DataFrame:
    """``keys`` + ``orders`` (rows or summed) + ``sum`` of each measure; ``typed`` adds measures with a type of their own."""
    pre = "orders" in df.columns
    aggs = [(F.sum("orders") if pre else F.count(F.lit(1))).cast("bigint").alias(orders_as)]
    aggs += [F.sum(m).cast(t).alias(m) for m, t in [*((m, _CAST.get(m, "bigint")) for m in measures), *(typed or {}).items()]]
    if EVENT_BUCKET in df.columns:
        # A watermarked stream: the bucket time joins the key so that finished
        # buckets can be evicted from the state store; it is a function of the
        # KPI's own time key, so the grouping does not change.
        return df.groupBy(*keys, EVENT_BUCKET).agg(*aggs).drop(EVENT_BUCKET)
    return df.groupBy(*keys).agg(*aggs)


def with_event_bucket(stream: DataFrame, time_key: str, pattern: str, delay: str) -> DataFrame:
    """Add the watermarked ``event_bucket`` = ``time_key`` parsed with ``pattern``.

    ``time_key`` must be the KPI's own time key (``minute`` with ``yyyyMMddHHmm``,
    ``day`` with ``yyyyMMdd``): then state older than ``delay`` behind the
    newest bucket is dropped, and rows arriving later than that are ignored.
    """
    t = F.to_timestamp(F.col(time_key), pattern)
    return stream.withColumn(EVENT_BUCKET, t).withWatermark(EVENT_BUCKET, delay)
