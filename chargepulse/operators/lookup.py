"""Code -> name lookup against a dimension.

How the join runs is Spark's choice from measured bytes: below
``spark.sql.autoBroadcastJoinThreshold`` the dimension is broadcast (AQE decides again
on the size it sees at run time); beyond it both sides are shuffled, and AQE splits hot codes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join ``dim`` (unique on ``key``) onto ``fact``.

    ``how="left"`` keeps unmatched fact rows with NULL dimension columns, which
    is what the quarantine step needs; ``"inner"`` drops them.
    """
    if dim.isStreaming:
        raise ValueError("the lookup dimension must be a static DataFrame")
    return fact.join(dim, on=key, how=how)
