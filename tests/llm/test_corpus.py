"""Mixing, toxicity and the pipeline."""

import math
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chargepulse.llm import label_model, mixing, toxicity

SF = "/root/testdata/sf0.01"


def _targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Reshare the excess by weight until no target is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, stopped = share * sum(sizes.values()), {}
    while True:
        rest = total - sum(stopped.values())
        free = [s for s in names if s not in stopped]
        out = stopped | {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        above = [s for s in free if out[s] > most * sizes[s]]
        if not above:
            return out
        stopped |= {s: most * sizes[s] for s in above}


def _mix_docs(spark):
    rows = [(i, "word " * (1 + i * 7 % 90), ["a", "b", None, "é", "", "hot", "hot", "hot"][i % 8], 5) for i in range(400)]
    rows += [(1000, None, "a", 5), (1001, "", "empty", 5), (None, "x y", "a", 5), (None, "x y", "a", 5), (1002, "w " * 20_000, "b", 5)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size long")


def test_mixing(spark):
    docs = _mix_docs(spark)
    got = mixing.mix_sources(docs).collect()
    assert len(got) == docs.count()
    sizes, took, target = {}, {}, {}
    for r in got:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        took[r["source"]] = took.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert all(r["source_size"] == sizes[r["source"]] for r in got)
    want = _targets(sizes)
    for s in sizes:
        assert math.isclose(target[s], want[s], rel_tol=1e-9, abs_tol=1e-9)
        assert abs(took[s] - target[s]) <= 10 + 0.001 * target[s]
    again = mixing.mix_sources(docs.repartition(7)).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, got), key=str)


def _brute_taken(rows):
    """Words taken of each ``(doc_id, source, size)``: all of its source by whole passes, and the first words of one further pass."""
    import struct

    import xxhash

    def key(i):
        seed = xxhash.xxh64_intdigest(struct.pack("<i", 41), 42)
        return seed if i is None else xxhash.xxh64_intdigest(struct.pack("<q", i), seed)

    sizes, out = {}, []
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    for s, target in _targets(sizes).items():
        goal, at = math.floor(target + 0.5), 0
        passes, rest = divmod(goal, sizes[s]) if sizes[s] else (0, 0)
        for i, n in sorted(((i, n) for i, x, n in rows if x == s), key=lambda r: (key(r[0]), r[0] is not None, r[0] or 0, r[1])):
            out.append((i, s, n, passes * n + max(0, min(at + n, rest) - at)))
            at += n
    return sorted(out, key=str)


def test_mixing_takes_what_brute_force_takes(spark):
    rows = [(i, ["a", "b", None, "é", "", "hot", "hot", "hot"][i % 8], 1 + i * 7 % 90) for i in range(400)]
    rows += [(None, "a", 3), (5000, "b", 20_000), (5001, "a", 0), (7, "a", 11), (5002, "tiny", 1)]
    docs = spark.createDataFrame([(i, s, "w " * n) for i, s, n in rows], "doc_id long, source string, text string")
    got = mixing.mix_sources(docs).select("doc_id", "source", "size", "taken").collect()
    assert sorted(map(tuple, got), key=str) == _brute_taken(rows)


def test_mixing_small_sources_of_a_large_table(spark):
    # 60 million words in few rows: a block of all would be larger than some sources.
    big = spark.range(600).select("id", F.repeat(F.lit("w "), 100_000).alias("text"), F.lit("hot").alias("source"))
    small = spark.createDataFrame([(1000, "w " * 40, "tiny"), (1001, "w " * 160, "tiny"), (1002, "w " * 1000, "small"),
                                   (1003, "w", "word"), (1004, "w " * 333, None)], "id long, text string, source string")
    docs = big.unionByName(small).withColumnRenamed("id", "doc_id")
    got = mixing.mix_sources(docs, slots=1 << 10).groupBy("source").agg(
        F.first("target").alias("target"), F.sum("taken").alias("taken")).collect()
    assert {r["source"]: r["taken"] for r in got if r["source"] != "hot"} == {"tiny": 400, "small": 2000, "word": 2, None: 666}
    assert all(abs(r["taken"] - r["target"]) <= 0.5 for r in got)


def test_mixing_empty_and_wordless(spark):
    docs = _mix_docs(spark)
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    got = mixing.mix_sources(docs.where("doc_id in (1000, 1001)")).collect()
    assert sorted((r["doc_id"], r["size"], r["taken"], r["target"]) for r in got) == [(1000, 0, 0, 0.0), (1001, 0, 0, 0.0)]


def test_toxicity_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), labels).where(toxicity.held_out())
    got = scored.join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id").select("toxic", "score", "lang").collect()
    right = sum((r["score"] >= 0.5) == (r["toxic"] == 1) for r in got)
    caught = [r["score"] >= 0.5 for r in got if r["toxic"] == 1 and r["lang"] == "en"]
    blamed = [r["score"] >= 0.5 for r in got if r["toxic"] == 0]
    # Few labels of the other languages are toxic here, too few to mine their words.
    assert len(got) > 500 and right >= 0.96 * len(got)
    assert sum(caught) >= 0.85 * len(caught) and sum(blamed) <= 0.005 * len(blamed)


def test_toxicity_reads_no_held_out_label(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (sorted(map(tuple, toxicity.score_toxicity(docs, x).select("doc_id", "score").collect())) for x in (labels, turned))
    assert one == two


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame([(1, "you idiot, worthless idiot", 9.0), (2, None, 9.0), (3, "", 9.0), (None, "fine", 9.0),
                                  (4, "fine " * 50_000, 9.0), (4, "fine " * 50_000, 9.0)], "doc_id long, text string, predicted double")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (3, 7)], "doc_id long, toxic int")
    for lab in (labels, labels.limit(0)):
        got = toxicity.score_toxicity(docs, lab).collect()
        assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert {r["doc_id"] for r in got if r["score"] >= 0.5} == {1}
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0
    with pytest.raises(ValueError):
        toxicity.score_toxicity(docs, labels, name="predicted")


def test_posterior_beats_wrong_labels():
    import numpy as np
    rng = np.random.default_rng(4)
    y = rng.random(5000) < 0.15
    fires = lambda p1, p0: (rng.random(5000) < np.where(y, p1, p0)).astype(np.int8)
    toxic = [fires(0.35, 0.004) for _ in range(8)] + [fires(0.1, 0.1)]
    toxic += [toxic[0].copy(), toxic[0].copy()]  # one voter thrice
    clean = [-fires(0.02, 0.3), -((np.stack(toxic).sum(0) == 0).astype(np.int8))]
    votes = np.stack(toxic + clean, axis=1)
    for wrong in (0.0, 0.2):
        gold = np.where(rng.random(5000) < wrong, ~y, y).astype(float)
        right = lambda guess: (guess == y).mean()
        post = toxicity.posteriors(votes, gold, np.ones(5000))
        assert right(post > 0.5) >= (0.97 if wrong else 0.99)
        assert right(post > 0.5) >= right(gold > 0.5) - 0.01
    e0, e1 = toxicity.label_errors(y, ~y, np.where(y, 0.0, 1.0), np.ones(5000))
    assert (e0, e1) == (0.45, 0.45)


def test_voters_for_and_against():
    import numpy as np
    index, signs = toxicity.voter_index(["idiot", "zoz*"], ["calm", "idiot"])
    look = lambda t: {n for n, i in index.items() if i in toxicity._features(t, index, signs)[0]}
    assert look("Idiot, please stay calm") == {"idiot", "please", "calm"}
    assert [int(signs[index[n]]) for n in ("idiot", "zoz*", "please", "calm")] == [1, 1, -1, -1]
    quiet = len(signs) - 1
    assert signs[quiet] == -1 and toxicity._features("thanks", index, signs)[0] == sorted([index["thanks"], quiet])
    assert quiet not in toxicity._features("!!!", index, signs)[0] and toxicity._features(None, index, signs)[0] == [quiet]
    assert np.all(np.abs(signs) == 1)


def test_label_model_tells_good_from_bad_voters():
    import numpy as np
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.3
    say = lambda p: np.where(rng.random(4000) < p, np.where(y, 1, -1), np.where(y, -1, 1))
    good, bad = say(0.9), say(0.55)
    votes = np.stack([good, say(0.85), bad, bad, bad], axis=1)  # one bad voter thrice
    post = label_model.label_model(votes, np.ones(4000), (votes[:, :3].sum(1) > 0) * 1.0)
    right = lambda guess: (guess == y).mean()
    assert right(post > 0.5) > 0.8 > right(votes.sum(1) > 0) + 0.2


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        before, now = now, stage(spark, now, SF).cache()
        assert now.columns == docs.columns and 0 < now.count() <= before.count()
    clean = {r["doc_id"] for r in docs.collect()}
    assert {r["doc_id"] for r in now.collect()} <= clean
    last = corpus_pipeline.run(spark, SF)
    assert last.columns == ["doc_id", "lang", "source", "n_tokens", "input_ids"] and last.count() > 0


def _planted():
    """Rows of ``documents`` and what the pipeline must do with each: (row, text after masking or None if it goes)."""
    import random
    rng, rows = random.Random(3), []
    sentence = lambda n: " ".join(f"{rng.choice('bcdfglmnprst')}{rng.choice('aeiou')}{rng.choice('lmnrst')}{rng.randrange(9)}" for _ in range(n))
    for i in range(60):
        clean = sentence(30 + i)
        source = ["a", "b", None, "hot", "hot"][i % 5]
        rows.append(((10 * i, source, clean), clean))
        if i % 6 == 0:   # a copy, a near copy (over 0.8) and a far one (under 0.8)
            words = clean.split()
            rows += [((10 * i + 1, "b", clean.upper()), None), ((10 * i + 2, "hot", " ".join([*words[:-1], "end"])), None)]
            far = " ".join(words[:len(words) // 2]) + " " + sentence(25)
            rows.append(((10 * i + 3, "a", far), far))
        if i % 7 == 0:
            rows.append(((10 * i + 4, "b", f"write {clean[:60]} to q{i}@w.org or 10.0.0.{i} {sentence(9)}"), "mask"))
        if i % 4 == 0:
            rows.append(((10 * i + 5, "hot", f"you idiot, worthless idiot {sentence(8)}"), None))
    other = sentence(40)
    rows += [((0, "a", other), other), ((None, "b", sentence(33)), "mask"), ((None, "a", sentence(20)), "mask"), ((9000, "a", None), "mask")]
    return rows


def test_pipeline_against_brute_force(spark, tmp_path):
    from collections import Counter

    from chargepulse.llm import bpe
    rows = _planted()
    docs = spark.createDataFrame([(*r, "en", len(r[2] or ""), "kept", 1) for r, _ in rows],
                                 "doc_id long, source string, text string, lang string, n_chars long, doc string, place long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    toxic = [(r[0], int("idiot" in (r[2] or ""))) for r, _ in rows if r[0]]
    spark.createDataFrame(toxic, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    mask = lambda t: re.sub(r"10\.0\.0\.[0-9]+", "[IP]", re.sub(r"q[0-9]+@w\.org", "[EMAIL]", t)) if t else t
    left = [(i, s, mask(t)) for (i, s, t), want in rows if want is not None]

    now = docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        now = stage(spark, now, str(tmp_path)).cache()
    got = now.select("doc_id", "source", "text", "n_chars", "place").collect()
    assert Counter(map(tuple, got)) == Counter((*r, len(r[2]) if r[2] is not None else None, 1) for r in left)

    size = lambda t: len((t or "").split())
    taken = _brute_taken([(i, s, size(t)) for i, s, t in left])
    copies = {(i, s, n): math.floor(took / n + 0.5) for i, s, n, took in taken if n}
    assert len(copies) == len(left) - 1   # sources, ids and sizes tell the rows apart, but for the empty text
    tok, want = bpe.load_tokenizer(bpe.default_tokenizer()), Counter()
    for i, s, t in left:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want[(i, s, len(ids), tuple(ids), tok.decode(ids, skip_special_tokens=False))] += copies.get((i, s, size(t)), 0)
    final = corpus_pipeline.run_whole(spark, str(tmp_path)).select("doc_id", "source", "n_tokens", "input_ids", "decoded").collect()
    assert Counter((r[0], r[1], r[2], tuple(r[3]), r[4]) for r in final) == +want
    assert len(set(copies.values())) > 1


def test_pipeline_encodes_and_decodes(spark):
    from chargepulse.llm import bpe
    from chargepulse.llm.catalog import LLM_QUERIES
    texts = ["Some words, and MORE words.", "", None, "é ü"]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    got = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert got.columns == ["doc_id", "lang", "source", "n_tokens", "input_ids", "decoded"]
    tok = bpe.load_tokenizer(bpe.default_tokenizer())
    for r in got.collect():
        ids = tok.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["input_ids"] == ids and r["n_tokens"] == len(ids) and r["decoded"] == tok.decode(ids, skip_special_tokens=False)
    assert LLM_QUERIES["pipeline"] is corpus_pipeline.run_whole


def test_pipeline_stages_take_odd_rows(spark):
    rows = [(1, "a b c d e f", "en", None, 1, "x"), (1, "a b c d e f", "en", None, 1, "x"), (None, None, None, "s", None, None),
            (2, "", "en", "s", 0, "y"), (3, "A B c d e f", "en", "s", 1, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    for some in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, some, SF)
            assert out.count() <= 2 * some.count()
            assert name == "bpe" or out.columns == docs.columns
