"""Embedding near-dedup by collision counting on one-dimensional projections.

Unit vectors are projected on orthonormal directions.  A *table* is a group of
``g`` projections cut into cells; every vector is stored in its own cell and asks
each cell that its query-centred window (half width ``t``) reaches.  Inside a cell
the stored side is sorted by its first projection, so a query's window is one
slice.  Pairs that fall into all windows of the table are counted over all ``m``
projections; those with at least ``least`` window collisions are verified with the
exact cosine in double precision.

Windows, ``g``, the number of tables and ``least`` follow from the wanted recall, the
length of the vectors and the number of vectors of that length (:func:`calibrate`), never
from a cap: ``g`` grows with the logarithm of the input, so cells stay about the same size.
Every length has a calibration of its own.  Oversized cells (a hot
group of near copies) are cut into tiles of ``block`` stored rows by ``block``
queries, each its own task.  A tile returns link counts and a spanning forest, not
pairs.  Equal vectors are one class from the start.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargepulse.llm.common import fingerprint, staged
from chargepulse.llm.components import components, local_labels

HALF_WIDTH = 2.2      # window half width, in standard deviations of a pair at the threshold
CELL_WIDTH = 2.0      # cell width in half widths: a window reaches two cells of a projection
PER_CELL = 3000       # vectors a cell holds on average
LANES = 24            # projections that collisions are counted on


@lru_cache(maxsize=64)
def calibrate(n: int, dim: int, cosine: float, recall: float) -> dict:
    """Window, projections per table, tables and the least collision count.

    For a pair exactly at the threshold a projection's difference is close to normal
    with deviation ``d / sqrt(dim)``; closer pairs collide more often.
    """
    sd = math.sqrt(max(2 - 2 * cosine, 1e-12)) / math.sqrt(dim)
    hit = math.erf(HALF_WIDTH / math.sqrt(2))
    # Share of random unit vectors that meet in a cell of one projection.
    share = min(0.9, CELL_WIDTH * HALF_WIDTH * sd * math.sqrt(dim) / math.sqrt(4 * math.pi))
    g = max(1, round(math.log(max(n, 1) / PER_CELL) / math.log(1 / share)))
    tables = max(1, math.ceil(math.log(1 - recall) / math.log(1 - hit ** g)))
    lanes = max(LANES, g * tables)
    least, tail = lanes, 0.0
    while least and 1 - (tail := sum(math.comb(lanes, k) * hit ** k * (1 - hit) ** (lanes - k)
                                     for k in range(least, lanes + 1))) > (1 - recall) / 2:
        least -= 1
    return {"t": HALF_WIDTH * sd, "width": CELL_WIDTH * HALF_WIDTH * sd, "g": g, "tables": tables,
            "lanes": lanes, "least": least, "cosine": cosine}


@lru_cache(maxsize=8)
def directions(dim: int, lanes: int, seed: int = 17) -> np.ndarray:
    """``dim x lanes`` unit columns, orthonormal in runs of ``dim``."""
    rng, out = np.random.default_rng(seed + dim), []
    while sum(q.shape[1] for q in out) < lanes:
        out.append(np.linalg.qr(rng.standard_normal((dim, dim)))[0])
    return np.concatenate(out, axis=1)[:, :lanes]


def unit_rows(vectors: list, dim: int) -> np.ndarray:
    x = np.asarray(np.stack(vectors), dtype=np.float64).reshape(-1, dim)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def is_usable(col: str = "embedding"):
    """Whether the vector has only finite components, at least one of them not zero; never null."""
    bad = F.exists(col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return ~F.coalesce(bad, F.lit(True)) & F.coalesce(F.exists(col, lambda x: x != 0), F.lit(False))


def usable(df: DataFrame, col: str = "embedding") -> DataFrame:
    """Rows whose vector has only finite components, at least one of them not zero."""
    return df.where(is_usable(col))


def _probes(lanes: np.ndarray, p: dict, stored_only: bool):
    """(row, table, cell, stored?) of every vector: its own cell, and all cells its windows reach."""
    for r in range(p["tables"]):
        v = lanes[:, r * p["g"]:(r + 1) * p["g"]]
        own = np.floor(v / p["width"]).astype(np.int64)
        yield np.arange(len(v)), r, own, True
        if stored_only:
            continue
        low, high = (np.floor((v + s * p["t"]) / p["width"]).astype(np.int64) for s in (-1, 1))
        for side in range(2 ** p["g"]):
            pick = np.array([(side >> k) & 1 for k in range(p["g"])], dtype=bool)
            ok = np.all(~pick | (high > low), axis=1)
            yield np.flatnonzero(ok), r, np.where(pick, high, low)[ok], False


def _dealer(cosine: float, recall: float, stored_only: bool):
    def deal(frames):
        for f in frames:
            for (dim, peers), part in f.groupby(["dim", "peers"]):
                dim, p = int(dim), calibrate(int(peers), int(dim), cosine, recall)
                lanes = unit_rows(list(part["embedding"]), dim) @ directions(dim, p["lanes"])
                for rows, r, cell, stored in _probes(lanes, p, stored_only):
                    names = np.full(len(rows), dim, np.uint64)
                    for c in cell.T:  # two cells with one name only cost some tests
                        names = (names ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                        names ^= names >> np.uint64(31)
                    out = {"dim": np.full(len(rows), dim, dtype=np.int32), "tab": np.int32(r), "cell": names.view(np.int64)}
                    if not stored_only:
                        some = part.iloc[rows]
                        out |= {"peers": peers, "stored": stored, "rep": some["rep"].to_numpy(), "n": some["n"].to_numpy(),
                                "embedding": some["embedding"].to_numpy()}
                    yield pd.DataFrame(out)
    return deal


def _enough(lanes: np.ndarray, u: np.ndarray, v: np.ndarray, p: dict, r: int):
    """The pairs with enough window collisions; a pair that an earlier table finds is left to it."""
    t, g, most = p["t"], p["g"], p["lanes"] - p["least"]
    misses = np.zeros(len(u), np.int16)
    for done, k in enumerate([k for k in range(p["lanes"]) if not r * g <= k < (r + 1) * g], 1):
        misses += np.abs(lanes[k][u] - lanes[k][v]) > t
        if done > most and done % 2:
            alive = misses <= most
            u, v, misses = u[alive], v[alive], misses[alive]
    alive = misses <= most
    u, v = u[alive], v[alive]
    for e in range(r):
        new = (np.abs(lanes[e * g:(e + 1) * g, u] - lanes[e * g:(e + 1) * g, v]) > t).any(axis=0)
        u, v = u[new], v[new]
    return u, v


def _counter(cosine: float, recall: float):
    def count(key, f):
        dim, r = int(f["dim"].iloc[0]), int(f["tab"].iloc[0])
        p = calibrate(int(f["peers"].iloc[0]), dim, cosine, recall)
        g, t = p["g"], p["t"]
        stored = f["stored"].to_numpy(dtype=bool)
        unit = unit_rows(list(f["embedding"]), dim)
        lanes = np.ascontiguousarray((unit @ directions(dim, p["lanes"])).T)
        ids, size = f["rep"].to_numpy(), f["n"].to_numpy()
        mine = lanes[r * g:(r + 1) * g].T
        data, ask = np.flatnonzero(stored), np.flatnonzero(~stored)
        data, ask = data[np.argsort(mine[data, 0], kind="stable")], ask[np.argsort(mine[ask, 0], kind="stable")]
        first = mine[data, 0]
        links, edges_a, edges_b = np.zeros(len(f), dtype=np.int64), [], []
        names, node = np.unique(ids, return_inverse=True)
        for at in range(0, len(ask), 256):
            q = ask[at:at + 256]
            lo = np.searchsorted(first, mine[q[0], 0] - t, "left")
            hi = np.searchsorted(first, mine[q[-1], 0] + t, "right")
            d = data[lo:hi]
            near = np.abs(mine[q, 0][:, None] - mine[d, 0][None, :]) <= t
            for k in range(1, g):
                near &= np.abs(mine[q, k][:, None] - mine[d, k][None, :]) <= t
            i, j = np.nonzero(near)
            i, j = q[i], d[j]
            other = ids[i] != ids[j]
            i, j = i[other], j[other]
            for cut in range(0, len(i), 100_000):
                u, v = _enough(lanes, i[cut:cut + 100_000], j[cut:cut + 100_000], p, r)
                ok = np.einsum("ij,ij->i", unit[u], unit[v]) >= p["cosine"]
                u, v = u[ok], v[ok]
                np.add.at(links, u, size[v])
                nodes, at = np.unique(np.concatenate([node[u], node[v]]), return_inverse=True)
                lab = local_labels(len(nodes), at[:len(u)], at[len(u):])
                edges_a.append(nodes)
                edges_b.append(nodes[lab])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (edges_a, edges_b))
        lab = local_labels(len(names), a, b)
        moved = np.flatnonzero(lab != np.arange(len(names)))
        some = np.flatnonzero(links)
        return pd.DataFrame({
            "a": np.concatenate([names[moved], ids[some]]),
            "b": np.concatenate([names[lab[moved]], ids[some]]),
            "links": np.concatenate([np.zeros(len(moved), np.int64), links[some]])})
    return count


def embedding_near_dedup(vectors: DataFrame, cosine: float = 0.95, recall: float = 0.999,
                         block: int = 4096, id_col: str = "vec_id", col: str = "embedding") -> DataFrame:
    """``(id, embedding)`` rows -> ``id, n_links, component_id, kept``, one row per input row.

    Null vectors or ids, zero vectors and vectors with null or non-finite components
    link with nothing (component: the own id, kept).  Vectors of different length do
    not link.  Repeated rows count as vectors of their own.  ``recall`` is the
    calibrated chance to find a pair exactly at the threshold.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("_id"), F.col(col).alias("embedding"))
    valid = usable(rows.where("_id is not null"))
    keyed = valid.select("_id", "embedding", *fingerprint("embedding"))
    classes = staged(keyed.groupBy("fp_a", "fp_b").agg(F.min("_id").alias("rep"), F.count("*").alias("n")),
                     "vec-classes")
    reps = staged(keyed.withColumnRenamed("_id", "rep").join(classes, ["fp_a", "fp_b", "rep"])
                  .dropDuplicates(["fp_a", "fp_b"])
                  .select("rep", "n", F.size("embedding").alias("dim"), "embedding"), "vec-reps")
    # One row per vector length; its rows know how many they are, from which tasks calibrate.
    sizes = staged(reps.groupBy("dim").agg(F.count("*").alias("peers")), "vec-lengths")
    reps = reps.join(sizes, "dim")

    cells = (reps.select("dim", "peers", "embedding").mapInPandas(_dealer(cosine, recall, True), "dim int, tab int, cell long")
             .groupBy("dim", "tab", "cell").count())
    large = staged(cells.where(F.col("count") > block)
                   .select("dim", "tab", "cell", F.ceil(F.col("count") / block).cast("int").alias("cuts")), "vec-cells")
    kind = reps.schema["embedding"].dataType.simpleString()
    dealt = (reps.mapInPandas(_dealer(cosine, recall, False), "dim int, tab int, cell long, peers long, stored boolean, "
                                                              f"rep long, n long, embedding {kind}")
             .join(large, ["dim", "tab", "cell"], "left").withColumn("cuts", F.coalesce("cuts", F.lit(1))))
    cut = F.pmod(F.xxhash64("rep"), F.col("cuts")).cast("int")
    all_cuts = F.sequence(F.lit(0), F.col("cuts") - 1)
    # Stored rows meet every block of queries, queries every block of stored rows.
    tiles = (dealt.withColumn("other", F.explode(all_cuts))
             .withColumn("q_cut", F.when(F.col("stored"), F.col("other")).otherwise(cut))
             .withColumn("d_cut", F.when(F.col("stored"), cut).otherwise(F.col("other"))))
    found = staged(tiles.select("dim", "tab", "cell", "q_cut", "d_cut", "peers", "stored", "rep", "n", "embedding")
                   .groupBy("dim", "tab", "cell", "q_cut", "d_cut")
                   .applyInPandas(_counter(cosine, recall), "a long, b long, links long"), "vec-links")
    links = found.where("links > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    comp = components(found.where("a <> b").select("a", "b")).withColumnRenamed("node", "rep")
    known = (classes.join(links, "rep", "left").join(comp, "rep", "left")
             .select("fp_a", "fp_b", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                     F.coalesce("component", "rep").alias("component_id")))
    # Vectors that take no part have no class; by their ids they spread over the tasks of the join.
    took = rows.select("_id", is_usable("embedding").alias("some"), *fingerprint("embedding"))
    out = (took.withColumns({fp: F.when(F.col("some"), F.col(fp)).otherwise(F.xxhash64(F.lit(5), "_id")) for fp in ("fp_a", "fp_b")})
           .join(known, ["fp_a", "fp_b"], "left"))
    linked = F.col("_id").isNotNull() & F.col("some")
    return out.select(
        F.col("_id").alias(id_col),
        F.coalesce(F.when(linked, F.col("n_links")), F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.when(linked, F.col("component_id")), F.col("_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))


def op2_embedding_near_dedup(spark, sf_dir):
    from chargepulse.llm.common import table
    return embedding_near_dedup(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id AS u, vec_id AS w FROM v UNION SELECT r.u, l.w FROM reach r JOIN l ON r.w = l.u),
c AS (SELECT u, min(w) AS component_id FROM reach GROUP BY u),
n AS (SELECT u, count(*) AS n FROM l GROUP BY u)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, coalesce(c.component_id, e.vec_id) AS component_id,
       coalesce(c.component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN c ON e.vec_id = c.u LEFT JOIN n ON e.vec_id = n.u
"""
