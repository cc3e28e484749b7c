"""Connected components of an edge table by alternating star contraction.

Every round is a few group-bys and equi-joins; the largest neighbourhood is
reduced with partial aggregates and joined (AQE may split it), so a hub with a
third of all edges never meets in one task.  Each round is written to the shared
scratch folder, which keeps the plan short and survives lost executors.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargepulse.llm.common import staged, trimmed


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(a, b)`` edges -> ``(node, component)``, the smallest node reachable.

    Nodes are integers.  Self-loops, repeated edges and either direction are fine;
    only nodes with an edge to another node are returned.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = staged(now.mapInArrow(trimmed(_contracted), "a long, b long").distinct(), "edges")
    seen = _state(now)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        now = staged(_small_star(_large_star(now)), "edges")
        last, seen = seen, _state(now)
        if last == seen:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _contracted(batches):
    """A spanning forest of the edges of one task, each node linked to its smallest."""
    import pyarrow as pa
    parts, held = [], 0

    def forest():
        names, at = np.unique(np.concatenate(parts), return_inverse=True)
        at = at.reshape(2, -1) if len(parts) == 1 else np.concatenate([x.reshape(2, -1) for x in np.split(
            at, np.cumsum([len(p) for p in parts])[:-1])], axis=1)
        lab = local_labels(len(names), at[0], at[1])
        moved = np.flatnonzero(lab != np.arange(len(names)))
        return pa.RecordBatch.from_arrays([pa.array(names[moved], pa.int64()), pa.array(names[lab[moved]], pa.int64())], ["a", "b"])
    for b in batches:
        parts.append(np.concatenate([b.column("a").to_numpy(), b.column("b").to_numpy()]))
        held += b.num_rows
        if held > 500_000:
            yield forest()
            parts, held = [], 0
    if parts:
        yield forest()


def _state(e: DataFrame) -> tuple:
    hashed = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(e.agg(F.count("*"), F.sum(hashed)).first())


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
    low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    moved = e.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low).distinct()


def local_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index per node ``0..n-1`` for index edges, inside one task."""
    lab = np.arange(n)
    while len(a):
        la, lb = lab[a], lab[b]
        apart = la != lb
        if not apart.any():
            break
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(lab, np.maximum(la, lb), np.minimum(la, lb))
        while not np.array_equal(up := lab[lab], lab):
            lab = up
    return lab
