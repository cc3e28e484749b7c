"""Personal data by weak supervision.

Candidates are spans of loose patterns: the base kinds (email, ip, card, phone) and names after a
title, local phone numbers, identity numbers, bank accounts and secrets.  Five labelers vote
on each candidate: a strict pattern, a gazetteer, the words in front, the shape and the
surroundings.  The counts of all vote patterns in the corpus (a table bounded by the number of
patterns) go through a generative label model, and a logistic classifier trained on its
posteriors decides on the added spans.  Base spans that pass their own test stay whatever
the votes; added spans that touch one are left out.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chargepulse.llm.common import slices, table, trimmed
from chargepulse.llm.label_model import label_model, logistic

BASE = ["email", "ip", "card", "phone"]
ADDED = ["name", "local_phone", "national_id", "bank_account", "secret"]
KINDS = BASE + ADDED

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOOSE = {
    "name": re.compile(r"(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sra?)\.? ([A-ZÀ-ÖØ-Þ][a-zà-öø-ÿ]+(?: [A-ZÀ-ÖØ-Þ][a-zà-öø-ÿ]+)?)"),
    "local_phone": re.compile(r"(\(?[0-9]{3}\)?[-. ][0-9]{3}[-. ][0-9]{4})(?![0-9])"),
    "national_id": re.compile(r"([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])"),
    "bank_account": re.compile(r"([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"),
    "secret": re.compile(r"[=:] ?[\"']?([0-9A-Za-z_-]{20,})"),
}
#: Words that announce a kind, before the span.
CUES = {
    "email": ("mail", "contact", "contacto", "kontakt", "write to"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "karte", "carte", "tarjeta"),
    "phone": ("tel", "phone", "call", "fax", "mobile", "telefon", "appel"),
    "local_phone": ("tel", "phone", "call", "fax", "mobile", "telefon", "appel"),
    "name": ("dear", "by", "from", "signed", "name"),
    "national_id": ("ssn", "social security", "passport", "id"),
    "bank_account": ("iban", "account", "konto", "compte", "cuenta", "bank"),
    "secret": ("token", "key", "password", "passwd", "secret", "pwd"),
}
#: Two-letter codes of bank accounts, common given names and domains; small gazetteers.
COUNTRIES = ("AT", "BE", "CH", "DE", "DK", "ES", "FI", "FR", "GB", "IE", "IT", "LU", "NL", "NO", "PL", "PT", "SE")
GIVEN = ("Anna", "Carlos", "David", "Emma", "Hans", "James", "Jean", "John", "Jose", "Juan", "Julia", "Karl", "Maria",
         "Marie", "Mary", "Michael", "Paul", "Peter", "Pierre", "Robert", "Sarah", "Thomas", "William")
DOMAINS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "eu", "info")
LABELERS = ["pattern", "gazetteer", "context", "shape", "surroundings"]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of ``[A-Za-z0-9._%+-]+@domain(.domain)+``; each holds one ``@``, so they are sought from there."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        tail = DOMAIN.match(text, at + 1)
        if tail:
            begin = at
            while begin > last and (text[begin - 1].isascii() and (text[begin - 1].isalnum() or text[begin - 1] in "._%+-")):
                begin -= 1
            if begin < at:
                out.append((begin, tail.end()))
                last = tail.end()
        at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by start, then kind: matches of a kind's pattern that pass its test; no retries inside a failed one."""
    digits = lambda s: "".join(c for c in s if c in "0123456789")
    found = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    found += [("ip", m.start(), m.end()) for m in IP.finditer(text)
              if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    found += [("card", m.start(), m.end()) for m in CARD.finditer(text)
              if 12 <= len(d := digits(m[0])) <= 19 and luhn(d)]
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def votes_on(kind: str, span: str, before: str, after: str) -> tuple[int, ...]:
    """The labelers' votes in -1, 0, 1."""
    pattern = 1 if kind in BASE or kind in ("national_id", "bank_account") else 0
    if kind == "bank_account":
        turned = span.replace(" ", "")
        turned = turned[4:] + turned[:4]
        pattern = 1 if int("".join(str(int(c, 36)) for c in turned)) % 97 == 1 else -1
    gazetteer = {"email": lambda: 1 if span.rsplit(".", 1)[-1].lower() in DOMAINS else -1,
                 "bank_account": lambda: 1 if span[:2] in COUNTRIES else -1,
                 "name": lambda: 1 if span.split()[0] in GIVEN else 0}.get(kind, lambda: 0)()
    near = before[-32:].lower()
    context = 1 if any(re.search(rf"(?<![^\W\d_]){re.escape(c)}", near) for c in CUES[kind]) else 0
    shape = 0
    if kind == "secret":
        shape = 1 if re.search("[0-9]", span) and re.search("[A-Za-z]", span) and len(set(span)) >= 10 else -1
    elif kind in ("card", "phone", "local_phone", "national_id"):
        shape = -1 if len({c for c in span if c.isdigit()}) <= 2 else 1
    elif kind == "ip":
        shape = -1 if span.split(".")[0] in ("0", "127") else 1
    elif kind == "name":
        shape = 1 if " " in span else 0
    glued = bool(before and (before[-1].isalnum() or before[-1] in "./_")) or bool(after and (after[0].isalnum() or after[0] == "_"))
    return pattern, gazetteer, context, shape, -1 if glued else 1


def candidate_spans(text: str, base: list) -> list[tuple[str, int, int]]:
    """Spans of the loose patterns that touch no base span, by start, then kind; non-overlapping among themselves."""
    found = []
    for kind, p in LOOSE.items():
        for m in p.finditer(text):
            if kind == "name" and m.start() and text[m.start() - 1].isalnum():
                continue
            a, b = m.span(1)
            if a and kind != "secret" and (text[a - 1].isdigit() or (kind == "bank_account" and text[a - 1].isalnum())):
                continue
            found.append((kind, a, b))
    found.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    # Of the base spans that begin before ``b``, the one that ends last tells whether any is touched.
    starts, ends = [a for _, a, _ in base], [0, *accumulate((b for _, _, b in base), max)]
    out, end = [], 0
    for kind, a, b in found:
        if a >= end and ends[bisect_left(starts, b)] <= a:
            out.append((kind, a, b))
            end = b
    return out


def pattern_of(kind: str, a: int, b: int, text: str) -> tuple:
    return (kind, *votes_on(kind, text[a:b], text[max(0, a - 32):a], text[b:b + 1]))


def _count(batches):
    from collections import Counter
    seen: Counter = Counter()
    for batch in (part for whole in batches for part in slices(whole)):
        for t in batch.column("text").to_pylist():
            base = base_spans(t or "")
            seen.update(pattern_of(*s, t) for s in base + candidate_spans(t or "", base))
    if seen:
        cols = list(zip(*seen))
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), *(pa.array(c, pa.int32()) for c in cols[1:]),
                                          pa.array(list(seen.values()), pa.int64())], ["kind", *LABELERS, "n"])


def fit_pii(docs: DataFrame) -> dict[tuple, bool]:
    """Decision of the span classifier on each (kind, votes) that occurs in the corpus.

    The counts are of all documents; the table has at most ``kinds * 3 ** labelers`` rows.
    """
    shape = ", ".join(f"{c} int" for c in LABELERS)
    rows = (docs.select("text").mapInArrow(trimmed(_count), f"kind string, {shape}, n long")
            .groupBy("kind", *LABELERS).agg(F.sum("n").alias("n")).orderBy("kind", *LABELERS).collect())
    if not rows:
        return {}
    votes = np.array([[r[c] for c in LABELERS] for r in rows], dtype=np.int8)
    weight = np.array([r["n"] for r in rows], dtype=np.float64)
    start = np.where(votes.sum(1) > 1, 0.85, np.where(votes.sum(1) > 0, 0.5, 0.1))
    # Logarithmic weights: a kind with many more spans than the others must not be all there is to learn from.
    weight = np.log1p(weight)
    post = label_model(votes, weight, start)
    kinds = np.array([[r["kind"] == k for k in KINDS] for r in rows], dtype=np.float64)
    x = np.concatenate([kinds, (votes > 0), (votes < 0)], axis=1).astype(np.float64)
    beta = logistic(x, post, weight)
    score = 1 / (1 + np.exp(-np.clip(np.concatenate([x, np.ones((len(x), 1))], axis=1) @ beta, -30, 30)))
    vouched = (votes[:, 1:4] > 0).any(axis=1) & (votes[:, 4] >= 0)  # something beyond the loose pattern speaks for it
    return {(r["kind"], *(r[c] for c in LABELERS)): bool(s >= 0.5 and v) for r, s, v in zip(rows, score, vouched)}


def spans_of(text: str | None, model: dict) -> tuple[list, list]:
    text = text or ""
    base = base_spans(text)
    added = [s for s in candidate_spans(text, base) if model.get(pattern_of(*s, text))]
    return base, sorted(base + added, key=lambda s: (s[1], KINDS.index(s[0])))


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                  T.StructField("end", T.IntegerType())]))
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _finder(model, mask: bool):
    def find(batches):
        for b in (part for whole in batches for part in slices(whole)):
            texts = b.column("text").to_pylist()
            made = [spans_of(t, model) for t in texts]
            as_rows = lambda i: pa.array([[dict(zip(("kind", "start", "end"), s)) for s in m[i]] for m in made], _ARROW)
            names, cols = list(b.schema.names), list(b.columns)
            at = names.index("text")
            if mask:
                cols[at] = pa.array([masked(t, m[1]) for t, m in zip(texts, made)], pa.string())
                yield pa.RecordBatch.from_arrays(cols, names)
            else:
                yield pa.RecordBatch.from_arrays([*cols[:at], *cols[at + 1:], as_rows(0), as_rows(1)],
                                                 [*names[:at], *names[at + 1:], "base", "spans"])
    return find


def masked(text: str | None, spans: list) -> str | None:
    """The text with ``[KIND]`` in place of each span; where spans overlap the first one stands for all."""
    if text is None or not spans:
        return text
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def find_pii(docs: DataFrame, id_cols: list[str]) -> DataFrame:
    """``id_cols`` and two arrays of ``kind, start, end`` (code points, end exclusive) per row of ``docs``.

    ``base`` holds the base kinds' spans, ``spans`` those and the added ones, by start, then kind.
    Null and empty texts have none; repeated rows and null ids stay rows of their own;
    texts are read whole; an empty table gives no rows.  ``id_cols`` may not be named ``base`` or ``spans``.
    """
    if {"base", "spans"} & set(id_cols):
        raise ValueError("base and spans are columns of the result")
    model = fit_pii(docs)
    kinds = T.StructType([*(docs.schema[c] for c in id_cols), T.StructField("base", SPANS), T.StructField("spans", SPANS)])
    return docs.select(*id_cols, "text").mapInArrow(trimmed(_finder(model, False)), kinds)


def mask_pii(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of personal data in ``text`` replaced by its kind; all columns and rows stay."""
    return docs.mapInArrow(trimmed(_finder(fit_pii(docs), True)), docs.schema)


def op7_pii(spark, sf_dir):
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
    line = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(line("base"), 256).alias("base_sha256"),
                        line("spans").alias("spans"))
