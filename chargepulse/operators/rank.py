"""K1 as a column: the place of every row in a global order, without a window over all rows.

Rows are dealt to ranges of the order (sampled bounds) and sorted inside their range, so a
row's number inside its range is known where it lies.  The rows of each range, and of each
group inside it, are counted; running sums of those counts say where a range begins.  What meets in one
task is a range of rows, or one count per range, never a group or the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from chargepulse.session import stored

LOCAL_BITS = 33   # a row number inside a partition takes so many bits of monotonically_increasing_id


def ranked(df: DataFrame, order: Sequence[Column], by: Sequence[str] = (), name: str = "rank",
           ranges: int | None = None) -> DataFrame:
    """Add ``name`` (BIGINT, from 1): the row's place by ``order``, inside its group if there is ``by``.

    Every row gets a place of its own.  Rows that ``order`` does not tell apart stay together in
    one range and follow each other in any order, so give a total order where ranks must be
    reproducible.  Nulls of ``by`` are a group.  ``ranges`` (default: the session's shuffle
    partitions) is the number of tasks that sort.

    The ranged rows are a written table: the sampled bounds are drawn once, and a lost executor
    cannot move a row to another range.  Without ``by`` the table of ranges holds at most ``ranges``
    rows of two numbers and is broadcast; with ``by`` it has a row per range and group, and Spark chooses the join.
    """
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in by] + list(order)
    place = F.monotonically_increasing_id()
    rows = stored(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                  .withColumn("_range", F.shiftright(place, LOCAL_BITS))
                  .withColumn("_row", place.bitwiseAND(F.lit((1 << LOCAL_BITS) - 1))), "ranked")
    counts = rows.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_range").alias("_in"),
                           (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_before"))
    same = rows["_range"] == starts["_in"]
    for c in by:
        same &= rows[c].eqNullSafe(starts[f"_by_{c}"])
    out = rows.join(starts if by else F.broadcast(starts), same)
    return out.select(*[rows[c] for c in df.columns], (F.col("_before") + F.col("_row") + 1).cast("bigint").alias(name))
