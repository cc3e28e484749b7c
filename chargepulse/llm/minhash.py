"""MinHash near-dedup with SuperMinHash signatures.

SuperMinHash visits, for each element, the slots in a random order of its own and gives the
``j``-th visited slot a value in ``[j, j + 1)``.  All elements of a document take
step ``j`` together; once every slot is filled no later step can lower one, so the
document stops early (a long text after one step).  Slots are banded; documents that
share a band are candidates, and candidates are confirmed on their full shingle sets.

Documents with equal sets are one class from the start.  In every band bucket each member
is checked against the bucket's hub, the member with most neighbours (linear in the bucket);
members that are connected by confirmed links need no further check.  Only where a hub
still has members of several components, all pairs across them are checked, in tiles of
bounded rows and bytes that return a spanning forest and not pairs.  No candidate is capped.
A hub's checks, and the copies of one set, are dealt to several tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargepulse.llm.common import slices, staged, table, trimmed
from chargepulse.llm.components import components, local_labels

BANDS, ROWS = 32, 6        # a pair at 0.8 shares a band with probability over 0.9999
SLOTS = BANDS * ROWS
SLICE_CHARS = 500_000      # text signed together in a task
STRAYS, BLOCK = 256, 512   # a tile compares so many strays with so many members, on average at most
STRAY_BYTES, BLOCK_BYTES = 4 << 20, 8 << 20   # and so many bytes of their texts; a longer text is whole all the same
HUB_CHECKS = 256           # checks of one document that a task makes, on average
COPY_DEALS = 16            # tasks that copies of one set are dealt to

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Hash of a word, remembered; emptied when it has grown."""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) > 200_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return (text or "").encode().lower().split()


def shingle_sets(texts: list, k: int, memo: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, one after another and sorted, and their offsets.

    Fewer than ``k`` words make one shingle of all of them; no words, none.
    """
    words = [words_of(t) for t in texts]
    size = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.fromiter((memo[w] for ws in words for w in ws), np.uint64, int(size.sum()))
    at = np.concatenate([[0], np.cumsum(size)])
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(len(flat) - k + 1, 0), np.uint64)
        for i in range(k):
            rolled = (rolled + flat[i:len(rolled) + i]) * _A
            rolled ^= rolled >> np.uint64(29)
        rolled = mix(rolled)
        sets = []
        for a, n in zip(at[:-1].tolist(), size.tolist()):
            if n >= k:
                sets.append(np.unique(rolled[a:a + n - k + 1]))
            elif n:
                h = np.uint64(n)
                for w in flat[a:a + n]:
                    h = mix((h + w) * _A)
                sets.append(np.array([h], np.uint64))
            else:
                sets.append(np.zeros(0, np.uint64))
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), offsets


def super_min_hash(flat: np.ndarray, offsets: np.ndarray, slots: int = SLOTS, seed: int = 1) -> np.ndarray:
    """``documents x slots`` signature values: step in the upper, draw in the lower 32 bits."""
    docs = len(offsets) - 1
    sig = np.full((docs, slots), np.iinfo(np.uint64).max, np.uint64)
    doc = np.repeat(np.arange(docs), np.diff(offsets))
    h, perm = flat, None
    with np.errstate(over="ignore"):
        for j in range(slots):
            draw = mix(h + np.uint64((seed * 1_000_003 + j + 1) & 0xFFFFFFFF) * _A)
            pick = (j + ((draw & np.uint64(0xFFFFFFFF)) * np.uint64(slots - j) >> np.uint64(32))).astype(np.int64)
            row = np.arange(len(h))
            slot = pick if perm is None else perm[row, pick].astype(np.int64)
            np.minimum.at(sig.reshape(-1), doc * slots + slot, np.uint64(j << 32) | (draw >> np.uint64(32)))
            open_docs = (sig >= np.uint64((j + 1) << 32)).any(axis=1)
            stay = open_docs[doc]
            if not stay.any():
                break
            if perm is None:
                perm = np.broadcast_to(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16),
                                       (int(stay.sum()), slots)).copy()
                h, doc, pick = h[stay], doc[stay], pick[stay]
            elif not stay.all():
                h, doc, pick, perm = h[stay], doc[stay], pick[stay], perm[stay]
            row = np.arange(len(h))
            perm[row, pick] = perm[row, j]
    return sig


def _bands(sig: np.ndarray, bands: int) -> np.ndarray:
    parts = sig.reshape(len(sig), bands, -1)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _C, parts.shape[:2]).copy()
        for i in range(parts.shape[2]):
            key = mix((key + parts[:, :, i]) * _A)
    return key.view(np.int64)


def _signer(k: int):
    def sign(batches):
        memo = WordHashes()
        for b in batches:
            for part in slices(b, SLICE_CHARS):
                flat, offsets = shingle_sets(part.column("text").to_pylist(), k, memo)
                n = np.diff(offsets)
                some = n > 0
                sig = super_min_hash(flat, offsets)
                with np.errstate(over="ignore"):
                    total = [np.concatenate([[np.uint64(0)], np.cumsum(mix(flat * c + _C), dtype=np.uint64)])
                             for c in (_A, _B)]
                    fp = [(t[offsets[1:]] - t[offsets[:-1]]).view(np.int64) for t in total]
                bands = pa.array([r if s else [] for r, s in zip(_bands(sig, BANDS), some)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(fp[0]),
                                                  pa.array(fp[1]), bands],
                                                 ["doc_id", "n_shingles", "fp_a", "fp_b", "bands"])
    return sign


def _verifier(k: int, percent: int):
    def verify(batches):
        memo = WordHashes()
        last, kept = None, None
        for b in (part for whole in batches for part in slices(whole, 2_000_000, "text_b")):
            ok = []
            for a, x, y in zip(b.column("a").to_pylist(), b.column("text_a").to_pylist(), b.column("text_b").to_pylist()):
                if last is None or last[0] != a or last[1] != x:
                    last, kept = (a, x), shingle_sets([x], k, memo)[0]
                other = shingle_sets([y], k, memo)[0]
                n, m = len(kept), len(other)
                both = 0
                if n and m and 100 * min(n, m) >= percent * max(n, m):
                    at = np.minimum(np.searchsorted(kept, other), n - 1)
                    both = int((kept[at] == other).sum())
                ok.append(both > 0 and 100 * both >= percent * (n + m - both))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(ok, pa.bool_())], ["a", "b", "ok"])
    return verify


def _with_text(pairs: DataFrame, ids: DataFrame, texts: DataFrame, side: str, other: str) -> DataFrame:
    """``pairs`` with the text of ``side``; a document of many ``ids`` pairs has copies, one for each deal of them."""
    busy = staged(ids.groupBy(side).count().where(F.col("count") > HUB_CHECKS)
                  .select(side, F.ceil(F.col("count") / HUB_CHECKS).cast("int").alias("deals")), "busy")
    deals = F.coalesce("deals", F.lit(1))
    dealt = pairs.join(busy, side, "left").withColumn("deal", F.pmod(F.xxhash64(other), deals).cast("int")).drop("deals")
    copies = (texts.select(F.col("doc_id").alias(side), F.col("text").alias(f"text_{side}")).join(busy, side, "left")
              .withColumn("deal", F.explode(F.sequence(F.lit(0), deals - 1))).drop("deals"))
    return dealt.join(copies.hint("merge"), [side, "deal"]).drop("deal")


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int, name: str) -> DataFrame:
    """``(a, b)`` pairs -> staged ``a, b, ok``; the later text travels once per pair, the earlier joins it."""
    rows = _with_text(_with_text(pairs, pairs, texts, "b", "a"), pairs, texts, "a", "b").select("a", "b", "text_a", "text_b")
    return staged(rows.mapInArrow(trimmed(_verifier(k, percent)), "a long, b long, ok boolean"), name)


def _across(k: int, percent: int):
    """Links between a tile's strays and its members of other components, as a spanning forest."""
    def compare(key, f):
        import pandas as pd
        flat, offsets = shingle_sets(f["text"].to_list(), k, WordHashes())
        size, comp = np.diff(offsets), f["component"].to_numpy()
        code = np.unique(flat, return_inverse=True)[1].reshape(-1)
        strays, others = np.flatnonzero(f["stray"].to_numpy()), np.flatnonzero(~f["stray"].to_numpy() & (size > 0))
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(strays) and len(others):
            theirs = np.concatenate([code[offsets[j]:offsets[j + 1]] for j in others])
            starts = np.concatenate([[0], np.cumsum(size[others])[:-1]])
            mark = np.zeros(int(code.max()) + 1 if len(code) else 1, np.int32)
            for i in strays:
                own = code[offsets[i]:offsets[i + 1]]
                mark[own] = 1
                both = np.add.reduceat(mark[theirs], starts)
                mark[own] = 0
                ok = (both > 0) & (comp[others] != comp[i]) & (100 * both >= percent * (size[i] + size[others] - both))
                b.append(others[ok])
                a.append(np.full(int(ok.sum()), i))
        ids = f["doc_id"].to_numpy()
        names, at = np.unique(ids, return_inverse=True)
        lab = local_labels(len(names), at[np.concatenate(a)], at[np.concatenate(b)])
        moved = np.flatnonzero(lab != np.arange(len(names)))
        return pd.DataFrame({"a": names[moved].astype(np.int64), "b": names[lab[moved]].astype(np.int64)})
    return compare


def _links_across(near: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """All links between different components among the members of a hub.

    ``near`` has ``hub, doc_id, component``.  Each such pair has a member outside the hub's largest
    component: those strays, in blocks, meet all members, in blocks; a tile is one task's work.
    """
    per = near.groupBy("hub", "component").count()
    main = (per.groupBy("hub").agg(F.max(F.struct("count", "component")).alias("m"), F.count("*").alias("comps"))
            .where("comps > 1").select("hub", F.col("m.component").alias("main")))
    sizes = texts.groupBy("doc_id").agg(F.sum("bytes").alias("bytes"))
    rest = staged(near.join(main.hint("merge"), "hub").join(sizes.hint("merge"), "doc_id"), "rest")
    stray = F.col("component") != F.col("main")
    parts = lambda rows, most, size, bytes_: F.ceil(F.greatest(rows / most, size / bytes_)).cast("int")
    cuts = rest.groupBy("hub").agg(
        parts(F.count("*"), BLOCK, F.sum("bytes"), BLOCK_BYTES).alias("blocks"),
        parts(F.count_if(stray), STRAYS, F.sum(F.when(stray, F.col("bytes"))), STRAY_BYTES).alias("cuts"))
    rows = rest.join(cuts.hint("merge"), "hub").join(texts.select("doc_id", "text").hint("merge"), "doc_id")
    cut = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    strays = rows.where("component <> main").withColumn("i", cut("cuts")).withColumn("j", every("blocks"))
    others = rows.withColumn("j", cut("blocks")).withColumn("i", every("cuts"))
    cols = ["hub", "i", "j", "doc_id", "component", "text"]
    return (strays.select(*cols, F.lit(True).alias("stray")).union(others.select(*cols, F.lit(False)))
            .groupBy("hub", "i", "j").applyInPandas(_across(k, percent), "a long, b long"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, text)`` rows -> ``doc_id, n_shingles, component_id, kept``, one row per input row.

    Documents are linked if ``100 * intersection >= percent * union`` of their sets of
    ``k``-word shingles (words between ASCII white space, A-Z lower-cased; fewer words: the whole
    sequence is one shingle).  Empty and null texts have no shingles and link with nothing.
    Rows that share a ``doc_id`` are one document with several texts.  A null ``doc_id`` links with nothing
    (null component, kept).  ``percent`` below 80 would need other bands.
    """
    if percent < 80:
        raise ValueError("the bands are calibrated for 80 % and more")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sigs = staged(texts.mapInArrow(trimmed(_signer(k)), "doc_id long, n_shingles long, fp_a long, fp_b long, bands array<long>"), "sigs")
    full = sigs.where("doc_id is not null and n_shingles > 0")
    classes = staged(full.groupBy("fp_a", "fp_b", "n_shingles").agg(F.min("doc_id").alias("rep"), F.count("*").alias("size")), "classes")
    reps = (full.join(classes.select(F.col("rep").alias("doc_id"), "fp_a", "fp_b"), ["doc_id", "fp_a", "fp_b"])
            .dropDuplicates(["doc_id", "fp_a", "fp_b"]))
    banded = reps.select("doc_id", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = staged(banded.join(buckets.hint("merge"), "key"), "members")
    # The texts of documents in shared buckets, moved once; their ids grow with the input, so they are never broadcast.
    involved = members.select("doc_id").distinct().hint("merge")
    one_text = staged(texts.where("doc_id is not null").join(involved, "doc_id", "left_semi")
                      .dropDuplicates(["doc_id", "text"]).withColumn("bytes", F.octet_length("text")), "texts")

    # Each member against its buckets' hubs: the member with most neighbours is the likeliest to be near all others.
    weight = members.groupBy("doc_id").agg(F.sum("size").alias("weight"))
    hubs = staged(members.select("key", "doc_id").join(weight.hint("merge"), "doc_id")
                  .groupBy("key").agg(F.max(F.struct("weight", "doc_id"))["doc_id"].alias("hub")), "hubs")
    pairs = (members.select("key", "doc_id").join(hubs.hint("merge"), "key").where("doc_id <> hub")
             .select(F.least("doc_id", "hub").alias("a"), F.greatest("doc_id", "hub").alias("b")).distinct())
    first = _confirmed(staged(pairs, "pairs"), one_text, k, percent, "confirmed")
    links = first.where("ok").select("a", "b")
    comp = staged(components(links).select(F.col("node").alias("doc_id"), "component"), "comp")

    # Hubs whose members are still of several components: all pairs across them.  Members
    # of one bucket have one hub, so no candidate is left out.
    near = (members.select("key", "doc_id").join(hubs.hint("merge"), "key").select("hub", "doc_id").distinct()
            .join(comp.hint("merge"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id")))
    second = _links_across(near, one_text, k, percent)
    # Copies join their representative; rows of one document link its texts, so its classes meet here too.
    several = classes.where("size > 1").withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(COPY_DEALS - 1))))
    own = (full.withColumn("deal", F.pmod(F.xxhash64("doc_id"), F.lit(COPY_DEALS)).cast("int"))
           .join(several, ["fp_a", "fp_b", "n_shingles", "deal"]).select("doc_id", "rep").where("doc_id <> rep"))
    place = components(comp.where("doc_id <> component").union(second).union(own).toDF("a", "b"))
    out = sigs.select("doc_id", "n_shingles").join(place.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    found = F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", found.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op8_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), k=4)


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\v\f\r]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n_both FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT u, v FROM i JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * n_both >= 80 * (x.n + y.n - n_both)),
e AS (SELECT u, v FROM l UNION SELECT v, u FROM l),
r AS (SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u),
c AS (SELECT u, min(v) AS component_id FROM r GROUP BY u)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c ON d.doc_id = c.u LEFT JOIN n ON n.doc_id = d.doc_id
"""
