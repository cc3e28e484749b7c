"""K1/K2: descending sort and top-N with a deterministic tie-break.

``orderBy(...).limit(n)`` plans as ``TakeOrderedAndProject``: every partition
keeps its own best ``n`` and only those reach the final merge, so no global
sort or shuffle of the input happens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _order(by: str, tie: str | list[str]):
    ties = [tie] if isinstance(tie, str) else list(tie)
    return [F.col(by).desc()] + [F.col(t).asc() for t in ties]


def sort_desc(df: DataFrame, by: str, tie) -> DataFrame:
    """K1: all rows, ``by`` descending, ``tie`` ascending."""
    return df.orderBy(*_order(by, tie))


def top_n(df: DataFrame, n: int, by: str, tie) -> DataFrame:
    """K2: the ``n`` rows with the largest ``by`` (ties: smaller ``tie`` first)."""
    return df.orderBy(*_order(by, tie)).limit(n)
