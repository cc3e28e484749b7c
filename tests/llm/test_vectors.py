"""Embedding near-dedup and nearest neighbours against brute force."""

import math

import numpy as np
import pytest

from chargepulse.llm.ann import calibrated, nearest_neighbours, ratio_at
from chargepulse.llm.components import components, local_labels
from chargepulse.llm.embedding_dedup import calibrate, embedding_near_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, n int, rep long"


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, None, 1, 2) for i, v in rows], SCHEMA)


def _rows():
    rng = np.random.default_rng(1)
    base = rng.standard_normal((60, 16))
    rows = [(i, base[i].tolist()) for i in range(60)]
    rows += [(100 + i, (base[i % 5] + 0.02 * rng.standard_normal(16)).tolist()) for i in range(40)]
    rows += [(200 + i, base[7].tolist()) for i in range(10)]
    rows += [(300, (3 * base[8]).tolist())]
    return rows


ODD = [(400, None), (401, []), (402, [0.0] * 16), (403, [float("nan")] * 16), (404, [float("inf")] + [1.0] * 15),
       (405, [None] + [1.0] * 15), (406, [1.0, 2.0]), (407, [2.0, 4.0])]


def _brute_links(rows, cosine=0.95):
    ids, out = [i for i, _ in rows], {}
    x = np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = x @ x.T >= cosine
    lab = local_labels(len(ids), *np.nonzero(s))
    low = {}
    for i, c in zip(ids, lab):
        low[c] = min(low.get(c, i), i)
    for k, i in enumerate(ids):
        out[i] = (int(s[k].sum()) - 1, low[lab[k]])
    return out


def test_near_dedup_matches_brute_force(spark):
    rows = _rows()
    want = _brute_links(rows) | {406: (1, 406), 407: (1, 406)} | {i: (0, i) for i in range(400, 406)}
    for block in (4096, 7):
        got = embedding_near_dedup(_frame(spark, rows + ODD), block=block).collect()
        assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == want
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_near_dedup_of_rare_lengths(spark):
    # 900 vectors of 64 components, 160 of 8 whose pairs lie at the threshold: each length needs windows of its own.
    rng = np.random.default_rng(5)
    long = [(i, v) for i, v in enumerate(rng.standard_normal((900, 64)).tolist())]
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in rng.standard_normal((2, 80, 8)))
    b -= (a * b).sum(1, keepdims=True) * a
    near = 0.952 * a + math.sqrt(1 - 0.952 ** 2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    short = [(10_000 + 2 * i + k, v) for i, pair in enumerate(zip(a.tolist(), near.tolist())) for k, v in enumerate(pair)]
    got = embedding_near_dedup(_frame(spark, long + short)).collect()
    want = _brute_links(long) | _brute_links(short)
    assert sum(n for n, _ in want.values()) >= 160
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == want


def test_near_dedup_empty_null_and_repeated(spark):
    assert embedding_near_dedup(_frame(spark, [(1, [1.0])]).limit(0)).count() == 0
    got = embedding_near_dedup(_frame(spark, [(None, [1.0, 0.0]), (5, [1.0, 0.0]), (5, [1.0, 0.0]), (4, None)])).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(
        [(None, 0, None, True), (5, 1, 5, True), (5, 1, 5, True), (4, 0, 4, True)], key=str)


def test_calibration_keeps_its_recall():
    for n in (100, 10_000, 10_000_000):
        p = calibrate(n, 64, 0.95, 0.999)
        hit = math.erf(2.2 / math.sqrt(2))
        assert 1 - (1 - hit ** p["g"]) ** p["tables"] >= 0.999
        assert p["lanes"] >= p["g"] * p["tables"]


def test_components(spark):
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 300, 200), rng.integers(0, 300, 200)
    a, b = np.concatenate([a, np.arange(1000, 1100)]), np.concatenate([b, np.arange(1001, 1101)])
    lab = local_labels(2000, a, b)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(
        list(zip(a.tolist(), b.tolist())), "a long, b long")).collect()}
    touched = {int(x) for p in zip(a, b) if p[0] != p[1] for x in p}
    assert got == {i: int(lab[i]) for i in touched}


def _brute_nearest(rows, q, k=10):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    d = np.sqrt(((x - x[list(ids).index(q)]) ** 2).sum(1))
    return [(int(ids[j]), d[j]) for j in np.lexsort((ids, d)) if ids[j] != q][:k]


def test_neighbours_of_a_small_table_are_exact(spark):
    rows = _rows()
    df = _frame(spark, rows + ODD)
    got = nearest_neighbours(df, df.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect()
    for q in (0, 100, 200, 300):
        mine = [r for r in got if r["query_id"] == q]
        want = _brute_nearest(rows, q)
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert [r["vec_id"] for r in mine] == [i for i, _ in want]
        assert np.allclose([r["score"] for r in mine], [d for _, d in want])
    assert {r["query_id"] for r in got} == {0, 100, 200, 300}  # 400 has no vector


@pytest.mark.parametrize("block", [4096, 50])
def test_recall(spark, block):
    rng = np.random.default_rng(2)
    rows = [(i, v) for i, v in enumerate(rng.standard_normal((3000, 24)).tolist())]
    df = _frame(spark, rows)
    got = nearest_neighbours(df, df.where("vec_id % 100 = 0"), per_list=50, block=block).collect()
    hits = sum(len({r["vec_id"] for r in got if r["query_id"] == q} & {i for i, _ in _brute_nearest(rows, q)})
               for q in range(0, 3000, 100))
    assert len(got) == 300 and hits >= 0.9 * 300


def test_neighbours_empty_and_few(spark):
    df = _frame(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0])])
    assert nearest_neighbours(df.limit(0), df).count() == 0
    got = nearest_neighbours(df, df.where("vec_id = 0")).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"]) for r in got] == [(1, 2), (2, 1)]


def test_few_lists_are_read_where_vectors_cluster(spark):
    # 120 clusters of unequal spread: reading by a ratio must leave most of the table alone.
    rng = np.random.default_rng(6)
    centre = rng.standard_normal((120, 32))
    rows = [(i, (centre[i % 120] + (0.1 + 0.3 * (i % 3)) * rng.standard_normal(32)).tolist()) for i in range(6000)]
    df = _frame(spark, rows)
    got = nearest_neighbours(df, df.where("vec_id % 100 = 0")).collect()
    hits = sum(len({r["vec_id"] for r in got if r["query_id"] == q} & {i for i, _ in _brute_nearest(rows, q)})
               for q in range(0, 6000, 100))
    share = {r["query_id"]: r["rows_read"] / 6000 for r in got}
    assert len(got) == 600 and hits >= 0.9 * 600
    assert sum(share.values()) / len(share) < 0.2


def test_ratio_follows_the_nearest_distance():
    nearest = np.repeat([1.0, 2.0, 3.0, 4.0], 64)
    need = np.where(nearest[:, None] < 2.5, 1.5, 1.1) * np.ones((256, 10))
    ratio = calibrated(nearest, need, 0.95)
    assert np.allclose(ratio_at(ratio, np.array([0.5, 1, 2, 2.5, 3, 9])), [1.5, 1.5, 1.5, 1.3, 1.1, 1.1])


def test_every_length_has_its_neighbours(spark):
    rng = np.random.default_rng(8)
    long, short = ([(at + i, v) for i, v in enumerate(rng.standard_normal((n, d)).tolist())] for at, n, d in ((0, 400, 16), (1000, 60, 4)))
    df = _frame(spark, long + short)
    got = nearest_neighbours(df, df.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect()
    for q, rows in ((100, long), (1000, short)):
        assert [r["vec_id"] for r in got if r["query_id"] == q] == [i for i, _ in _brute_nearest(rows, q)]
    assert {r["query_id"] for r in got} == {0, 100, 200, 300, 1000}
