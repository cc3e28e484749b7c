"""Toxicity by weak supervision.

Many voters look at a text.  For toxic vote a small fixed lexicon, patterns, and words and word
stems mined from the training labels (candidates whose association with label 1 outlasts the
number of candidates tried); against it vote courteous words, words mined for label 0, and a
text in which nothing else was found.  The given label is one more voter; how often it is wrong is
estimated where the other voters are sure.  A generative label model estimates the accuracies of the
voters and the correlations between them; a linear classifier trained on its posteriors scores every
whole text, without the label's vote.  Only labels of rows whose
``crc32(doc_id as text) mod 5`` is not 0 are read, of at most ``fit_rows`` rows.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chargepulse.llm.common import give_back, slices, staged, table, trimmed
from chargepulse.llm.label_model import label_model, logistic

#: General insults; the rest of the lexicon is mined.
LEXICON = ["bastard", "clown", "crap", "damn", "disgusting", "dumb", "dumbass", "fool", "freak", "garbage", "hate",
           "idiot", "idiota", "imbecile", "jerk", "kill", "loser", "moron", "pathetic", "scum", "shut", "stupid",
           "trash", "ugly", "vermin", "worthless"]
COURTEOUS = ["appreciate", "congratulations", "danke", "gracias", "grateful", "kindly", "merci", "please", "thank", "thanks",
             "welcome"]
PATTERNS = [re.compile(r"!{2,}|[?!]{3,}"), re.compile(r"[A-Z]{4,}(?:[ \t]+[A-Z]{4,}){2}"),
            re.compile(r"1d[i1]0t|m0r[o0]n|stup1d|l0s[e3]r|tr4sh")]
WORD = re.compile(r"[^\W\d_]+")
STEMS = (4, 5, 6, 7)       # lengths of word beginnings that may vote
MOST_VOTERS = 400          # mined voters for each label, at most
SURE = 999.0               # odds at which the other voters are sure that a text is toxic; toxic texts are few
FIT_ROWS = 20_000          # labelled rows that the model is fitted on, at most
FLUSH = 150_000


def held_out(col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def words_of(text: str | None) -> Counter:
    return Counter(WORD.findall((text or "").lower()))


def candidates(words) -> set[str]:
    return {*words, *(f"{w[:n]}*" for w in words for n in STEMS if len(w) >= n)}


def _mine(batches):
    seen: Counter = Counter()

    def rows():
        keys = list(seen)
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                                           pa.array([seen[k] for k in keys], pa.int64())], ["voter", "toxic", "n"])
    for b in (part for whole in batches for part in slices(whole)):
        for text, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
            seen.update((c, y) for c in candidates(words_of(text)))
            if len(seen) > FLUSH:
                yield rows()
                seen.clear()
    if seen:
        yield rows()


def mined_voters(train: DataFrame, most: int = MOST_VOTERS) -> tuple[list[str], list[str]]:
    """Words and stems (``stem*``) for label 1, and for label 0, whose G statistic beats the number of candidates tried."""
    sums = train.groupBy("toxic").count().collect()
    n1, n0 = (sum(r["count"] for r in sums if r["toxic"] == y) for y in (1, 0))
    if not n1 or not n0:
        return [], []
    counts = staged(train.select("text", "toxic").mapInArrow(trimmed(_mine), "voter string, toxic int, n long").groupBy("voter")
                    .agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"),
                         F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b")), "tox-voters")
    tried = counts.count()
    a, b = F.col("a"), F.col("b")
    term = lambda o, e: F.when(o > 0, o * F.log(o / e)).otherwise(0.0)
    both, total = a + b, float(n0 + n1)
    g = (term(a, both * n1 / total) + term(b, both * n0 / total)
         + term(n1 - a, (total - both) * n1 / total) + term(n0 - b, (total - both) * n0 / total))
    good = counts.withColumn("g", g).where(F.col("g") > float(np.log(max(tried, 1)) + 2))
    return tuple([r["voter"] for r in good.where(more).orderBy(F.desc("g"), "voter").limit(most).collect()]
                 for more in (a / n1 > 3 * b / n0, b / n0 > 3 * a / n1))


def voter_index(toxic: list[str], clean: list[str]) -> tuple[dict[str, int], np.ndarray]:
    """The place of each word and stem, and what each place votes: 1 or -1.

    Behind the words stand the patterns and, last, the vote of a text in which no voter for toxic fires.
    """
    up = [*LEXICON, *(m for m in toxic if m not in LEXICON)]
    down = [m for m in dict.fromkeys([*COURTEOUS, *clean]) if m not in up]
    signs = np.concatenate([np.ones(len(up)), -np.ones(len(down)), np.ones(len(PATTERNS)), [-1]]).astype(np.int8)
    return {n: i for i, n in enumerate(up + down)}, signs


def _features(text: str | None, index: dict[str, int], signs: np.ndarray) -> tuple[list[int], list[float]]:
    """Voters that fire, and the shares of words hit by voters for toxic."""
    text = text or ""
    words = words_of(text)
    fired, hits, total = set(), 0, 0
    for w, n in words.items():
        total += n
        own = [index[c] for c in (w, *(f"{w[:s]}*" for s in STEMS)) if c in index]
        fired.update(own)
        hits += n * any(signs[i] > 0 for i in own)
    patterns = [len(index) + i for i, p in enumerate(PATTERNS) if p.search(text)]
    fired.update(patterns)
    if not hits and not patterns:
        fired.add(len(signs) - 1)
    return sorted(fired), [float(np.log1p(hits)), 10.0 * hits / (total + 10.0)]


def _sampler(index, signs):
    def sample(batches):
        for b in (part for whole in batches for part in slices(whole)):
            made = [_features(t, index, signs) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array([m[0] for m in made], pa.list_(pa.int32())),
                                              pa.array([m[1] for m in made], pa.list_(pa.float64()))],
                                             ["toxic", "fired", "extra"])
    return sample


def _matrix(fired: list, extra: list, voters: int) -> np.ndarray:
    x = np.zeros((len(fired), voters + 2))
    for i, (f, e) in enumerate(zip(fired, extra)):
        x[i, f] = 1
        x[i, voters:] = e
    return x


def fit_toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> dict:
    """Voter names, what they vote, and the classifier's coefficients."""
    known = (labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out())
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    n = known.count()
    share = min(1.0, fit_rows / max(n, 1))
    some = known.where(F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    train = staged(docs.select("doc_id", "text").join(some, "doc_id").select("text", "toxic"), "tox-train")
    index, signs = voter_index(*mined_voters(train))
    voters = len(signs)
    rows = train.mapInArrow(trimmed(_sampler(index, signs)), "toxic int, fired array<int>, extra array<double>")
    # Texts with the same votes, shares and label are one weighted row; most have no votes at all.
    seen = Counter((r["toxic"], tuple(r["fired"]), tuple(r["extra"])) for r in rows.toLocalIterator())
    rows = sorted(seen)
    x = _matrix([r[1] for r in rows], [r[2] for r in rows], voters)
    gold = np.array([r[0] for r in rows], dtype=np.float64)
    weight = np.array([seen[r] for r in rows], dtype=np.float64)
    if not rows:  # nothing to learn from: the lexicon alone
        weights = np.concatenate([np.full(len(LEXICON), 3.0), np.zeros(voters - len(LEXICON) + 2), [-2.0]])
        return {"index": index, "signs": signs, "weights": weights}
    post = posteriors(x[:, :voters].astype(np.int8) * signs, gold, weight)
    weights = logistic(x, post, weight)
    del x
    give_back()
    return {"index": index, "signs": signs, "weights": weights}


def label_errors(sure_toxic: np.ndarray, sure_clean: np.ndarray, gold: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """How often a clean text is labelled 1 and a toxic one 0, among rows that the other voters are sure of.

    Smoothed by ten rows of a label that is right nine times in ten.
    """
    wrong = [(weight[rows & (gold == y)].sum() + 1) / (weight[rows].sum() + 10) for rows, y in ((sure_clean, 1), (sure_toxic, 0))]
    return tuple(float(np.clip(e, 0.002, 0.45)) for e in wrong)


def posteriors(votes: np.ndarray, gold: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Posterior of each row from the votes (-1, 0, 1) and the given label, which is a voter as well.

    The label's own accuracy is estimated from where the other voters are sure: first by the sum of their
    votes, then by what the label model says without the label.  (A label estimated inside the
    expectation-maximisation would agree with itself on all texts of which the others say little.)
    """
    net = votes.sum(1, dtype=np.int64)
    sure = net >= 2, net < 0
    share = (weight * gold).sum() / weight.sum()
    for _ in range(3):
        e0, e1 = label_errors(*sure, gold, weight)
        base = np.clip((share - e0) / (1 - e0 - e1), 0.01, 0.99)
        odds = np.log(base / (1 - base)) + np.where(gold > 0, np.log((1 - e1) / e0), np.log(e1 / (1 - e0)))
        start = 1 / (1 + np.exp(-odds))
        post = np.clip(label_model(votes, weight, start, prior=start), 1e-9, 1 - 1e-9)
        others = np.log(post / (1 - post)) - odds
        sure = others > np.log(SURE), others < 0
    return post


def _scorer(model: dict, name: str):
    index, signs, weights = model["index"], model["signs"], model["weights"]
    voters = len(signs)

    def score(batches):
        for b in (part for whole in batches for part in slices(whole)):
            out = []
            for t in b.column("text").to_pylist():
                fired, extra = _features(t, index, signs)
                z = weights[-1] + weights[fired].sum() + weights[voters] * extra[0] + weights[voters + 1] * extra[1]
                out.append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.float64())], [*b.schema.names, name])
    return score


def score_toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, name: str = "score") -> DataFrame:
    """``docs`` (any columns, with ``doc_id`` and ``text``) plus the score of each row in column ``name``.

    One row per input row, nulls and repeats included; null texts score as empty ones.  A
    column of ``docs`` named ``name`` is an error.  Labels other than 0 and 1 are
    ignored; of several labels of a document the largest holds.  Without labels the fixed
    lexicon scores alone.
    """
    if name in docs.columns:
        raise ValueError(f"docs has a column {name}; choose another name for the score")
    model = fit_toxicity(docs, labels, fit_rows)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return docs.mapInArrow(trimmed(_scorer(model, name)), schema)


def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
