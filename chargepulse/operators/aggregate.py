"""Key-wise sums of a measure vector.

The reference sums ``List[Double]`` element by element with ``reduceByKey``;
here each measure is a column and ``groupBy().agg(sum...)`` gets a partial
(map-side) and a final hash aggregate.  A hot key therefore costs one partial
row per input partition, never a third of the data in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

def vector_sum(df: DataFrame, keys, measures, count_as: str = "orders",
               names: dict[str, str] | None = None) -> DataFrame:
    """A1/A2/A3: ``keys`` + ``count(*)`` (as ``count_as``) + ``sum(m)`` for each measure.

    Sums of money keep DECIMAL(18,2); counts and milliseconds are BIGINT.
    ``names`` renames output measures (``{"success": "successes"}``).
    """
    from chargepulse.plans.rollup import rollup

    out = rollup(df, keys, measures, orders_as=count_as)
    for old, new in (names or {}).items():
        out = out.withColumnRenamed(old, new)
    return out


def with_failures(df: DataFrame, orders: str = "orders", success: str = "success") -> DataFrame:
    """A5/A4: ``failures = orders - success`` and ``failure_rate = failures / orders``."""
    fails = (F.col(orders) - F.col(success)).cast("bigint")
    return df.withColumns({
        "failures": fails,
        "failure_rate": fails.cast("double") / F.col(orders).cast("double"),
    })
