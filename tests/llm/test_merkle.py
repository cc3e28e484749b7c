"""Merkle manifest: roots, proofs and tampering against a plain recursion over whole levels."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from chargepulse.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, at int, node string, witness string, _place int, block int, root int"


def h(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(r, text):
    values = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(tree, i):
    out = []
    for nodes in tree[:-1]:
        run = i - i % 3
        out.append((nodes[run:i], nodes[i + 1:run + 3]))
        i //= 3
    return out


def expected(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of every row."""
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        own = sorted(groups[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees[s] = (own, levels([leaf(r, r["text"]) for r in own]))
    top = levels([trees[s][1][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        own, tree = trees[s]
        for i, r in enumerate(own):
            steps = siblings(tree, i) + siblings(top, k)
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and r["text"] is not None
            acc = leaf(r, r["text"].replace("\n", "") if hit else r["text"])
            for a, b in steps:
                acc = h("".join(a) + acc + "".join(b))
            out.append((r["doc_id"], leaf(r, r["text"]), tree[-1][0], top[-1][0],
                        h("".join("".join(a) + "".join(b) for a, b in steps)), acc, acc == top[-1][0]))
    return sorted(out, key=str)


def run(spark, rows, tmp_path, parts=5):
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], 1, "n", "w", 2, 3, 4) for r in rows],
                          SCHEMA).repartition(parts).write.parquet(path)
    got = merkle.op11_merkle(spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, got.collect()), key=str)


def doc(i, source, text="a\nb", lang="en", n=3):
    return {"doc_id": i, "source": source, "text": text, "lang": lang, "n_chars": n}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 728, 729, 730, 2300])
def test_one_source_of_any_length(spark, tmp_path, n):
    rows = [doc(i * 7 % 10007, "s", f"text {i}" + "\nx" * (i % 2)) for i in range(n)]
    assert run(spark, rows, tmp_path) == expected(rows)


def test_many_sources_and_odd_rows(spark, tmp_path):
    rows = [doc(i, f"s{i % 37}") for i in range(800)] + [doc(10_000 + i, "hot", f"hot {i}\n") for i in range(1600)]
    rows += [doc(5, None), doc(None, None, None, None, None), doc(None, "s1", "no id\n"), doc(None, "s1", ""),
             doc(7, "é", "x\n" * 200_000), doc(7, "z", ""), doc(20, "s20", "\n\n"), doc(20, "s20", "\n\n"), doc(20, "s20", "other")]
    got = run(spark, rows, tmp_path)
    assert got == expected(rows)
    assert {r[6] for r in got} == {True, False}


def test_more_sources_than_a_block(spark, tmp_path):
    rows = [doc(i, f"s{i}") for i in range(800)]
    assert run(spark, rows, tmp_path) == expected(rows)


def test_empty_table(spark, tmp_path):
    assert run(spark, [], tmp_path) == []


def test_witnesses_prove_their_rows_only(spark):
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("en").alias("lang"),
                                   F.lit(1).alias("n_chars"), F.col("id").cast("string").alias("text"))
    got = merkle.manifest(docs).select("root", merkle.fold("leaf", "witness").alias("own"), F.size("witness").alias("n"),
                                       merkle.fold(F.sha2(F.lit("other"), 256), "witness").alias("forged")).collect()
    assert all(r["own"] == r["root"] != r["forged"] and r["n"] == 7 for r in got)


def test_growth_extends_open_witnesses():
    tree = merkle.Growth()
    for d in map(h, "abcd"):
        tree.append(d)
    # a, b and c are complete siblings; d waits alone.
    assert [len(w) for w in tree.witnesses] == [1, 1, 1, 0]
    assert tree.close() == levels([h(x) for x in "abcd"])[-1][0]
    assert [len(w) for w in tree.witnesses] == [2, 2, 2, 2]
