"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

The tokenizer drops white space, and none of its steps looks across ASCII white space,
so a text's ids are the ids of its chunks (runs without ASCII white space, stops apart) one
after another.  The most frequent chunks of the whole corpus are compiled into a minimal
acyclic automaton (common prefixes and suffixes shared); the outputs on its arcs add up to
a chunk's number, which selects its ids.  The automaton is a few flat arrays in the
shared scratch folder; Spark hands the files to executors, where tasks memory-map
them.  A batch's distinct chunks walk the automaton together, one byte per step; unseen
chunks are merged exactly by the tokenizer itself.  The lexicon only saves
work: any lexicon, an empty one too, gives the same ids.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargepulse.llm.common import give_back, scratch_path, slices, staged, table, trimmed

MAX_WORDS = 262_144        # chunks in the lexicon, at most
MAX_BYTES = 48             # longer chunks stay outside
STOPS = re.compile(rb"(?<=[a-z])[.,;:!?]+(?=[ \t\n\r\x0b\x0c]|\Z)")
MEMO = 150_000             # merges of unseen chunks that a task remembers
FLUSH = 150_000            # distinct chunks a counting task holds


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def load_tokenizer(path: str):
    """The tokenizer, with one thread: Spark runs tasks side by side."""
    import os

    from tokenizers import Tokenizer
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def chunks_of(text: str | None) -> list[bytes]:
    """Pieces whose ids, one after another, are the text's.

    A run of stops after an ASCII letter and before white space is a token of its own to the
    tokenizer, and A-Z are lower-cased by it, so both are done here: fewer pieces are distinct.  A text that
    may hold a special token, which is matched before lower-casing, is left as it is.
    """
    raw = (text or "").encode()
    return raw.split() if b"<|" in raw else STOPS.sub(rb" \g<0>", raw.lower()).split()


# ---- corpus counts -----------------------------------------------------------------

def _count(batches):
    seen: Counter = Counter()

    def rows():
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()),
                                           pa.array(list(seen.values()), pa.int64())], ["word", "n"])
    for b in batches:
        for part in slices(b):
            for t in part.column("text").to_pylist():
                seen.update(chunks_of(t))
            if len(seen) > FLUSH:
                yield rows()
                seen.clear()
    if seen:
        yield rows()


def frequent_chunks(docs: DataFrame, most: int = MAX_WORDS) -> list[bytes]:
    """At most ``most`` chunks, the most frequent of all documents (whole steps of a log scale of counts)."""
    counted = (docs.select("text").mapInArrow(trimmed(_count), "word binary, n long")
               .where(F.length("word") <= MAX_BYTES).groupBy("word").agg(F.sum("n").alias("n"))
               .withColumn("step", F.floor(F.log2("n") * 8).cast("int")))
    counted = staged(counted.select("word", "step"), "bpe-words")
    total, least = 0, None
    for step, n in sorted(((r["step"], r["count"]) for r in counted.groupBy("step").count().collect()), reverse=True):
        if total + n > most:
            break
        total, least = total + n, step
    if least is None:
        return []
    return [bytes(r["word"]) for r in counted.where(F.col("step") >= least).select("word").toLocalIterator()]


# ---- lexicon -----------------------------------------------------------------------

def compile_lexicon(words: list[bytes], ids: list[list[int]]) -> dict[str, np.ndarray]:
    """Flat arrays of the minimal automaton of ``words`` and their ids.

    Built from sorted words; a state is final once no later word can pass it, and is then
    replaced by an equal one if there is any.  ``arc[state, class]`` numbers an arc
    (0: none), ``to`` and ``out`` hold its target and output, ``final`` marks ends of words.
    """
    order = sorted(range(len(words)), key=words.__getitem__)
    children: list[dict] = [{}]
    final = [False]
    known: dict[tuple, int] = {}
    path: list[tuple[int, int, int]] = []

    def settle(depth: int) -> None:
        while len(path) > depth:
            parent, byte, child = path.pop()
            key = (final[child], tuple(children[child].items()))
            same = children[parent][byte] = known.setdefault(key, child)
            if same != child:
                children[child] = None  # its equal stands for it
    last = b""
    for k in order:
        w = words[k]
        same = 0
        while same < min(len(w), len(last)) and w[same] == last[same]:
            same += 1
        settle(same)
        at = path[-1][2] if path else 0
        for byte in w[same:]:
            children.append({})
            final.append(False)
            children[at][byte] = len(children) - 1
            path.append((at, byte, len(children) - 1))
            at = len(children) - 1
        final[at] = True
        last = w
    settle(0)

    names, stack, states = {0: 0}, [0], [0]
    while stack:
        for t in children[stack.pop()].values():
            if t not in names:
                names[t] = len(names)
                states.append(t)
                stack.append(t)
    count: dict[int, int] = {}
    for s in _bottom_up(children):
        count[s] = final[s] + sum(count[t] for t in children[s].values())
    used = sorted({b for s in states for b in children[s]})
    classes = np.zeros(256, dtype=np.int32)  # 0: a byte that no word has
    classes[used] = np.arange(1, len(used) + 1)
    arc = np.zeros((len(states), len(used) + 1), dtype=np.int32)
    to, out = [0], [0]
    for s in states:
        passed = int(final[s])
        for byte in sorted(children[s]):
            t = children[s][byte]
            arc[names[s], classes[byte]] = len(to)
            to.append(names[t])
            out.append(passed)
            passed += count[t]
    sizes = np.array([len(ids[k]) for k in order], dtype=np.int64)
    flat = [i for k in order for i in ids[k]]
    return {"classes": classes, "arc": arc, "to": np.array(to, dtype=np.int32), "out": np.array(out, dtype=np.int32),
            "final": np.array([final[s] for s in states]), "starts": np.concatenate([[0], np.cumsum(sizes)]),
            "ids": np.array(flat, dtype=np.uint32)}


def _bottom_up(children: list[dict]) -> list[int]:
    done, out, stack = set(), [], [(0, False)]
    while stack:
        s, ready = stack.pop()
        if ready:
            out.append(s)
        elif s not in done:
            done.add(s)
            stack.append((s, True))
            stack += [(t, False) for t in children[s].values()]
    return out


def look_up(lex: dict, words: list[bytes]) -> np.ndarray:
    """Each word's number in the lexicon, -1 if it is not there; all words step together."""
    found = np.full(len(words), -1, dtype=np.int64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    live = np.flatnonzero((size > 0) & (size <= MAX_BYTES))
    if not len(live) or not len(lex["to"]):
        return found
    size = size[live]
    rows = np.frombuffer(b"".join(words[i] for i in live), dtype=np.uint8)
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    arc, to, out, classes = lex["arc"], lex["to"], lex["out"], lex["classes"]
    state, number = np.zeros(len(live), np.int64), np.zeros(len(live), np.int64)
    for step in range(int(size.max())):
        here = arc[state, classes[rows[start + step]]]
        ok = here > 0
        if not ok.all():
            live, start, size, state, number, here = (x[ok] for x in (live, start, size, state, number, here))
        state, number = to[here].astype(np.int64), number + out[here]
        over = size == step + 1
        if over.any():
            ends = over & lex["final"][state]
            found[live[ends]] = number[ends]
            live, start, size, state, number = (x[~over] for x in (live, start, size, state, number))
        if not len(live):
            break
    return found


def publish(spark, lex: dict[str, np.ndarray]) -> dict[str, str]:
    """Write the arrays to the shared scratch folder and have Spark hand them to executors."""
    import io
    root = scratch_path(spark, "bpe-lexicon")
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = {}
    for key, value in lex.items():
        names[key] = f"{key}-{uuid.uuid4().hex[:12]}.npy"
        buf = io.BytesIO()
        np.save(buf, value)
        data = buf.getbuffer()
        to = fs.create(jvm.org.apache.hadoop.fs.Path(f"{root}/{names[key]}"))
        for at in range(0, len(data), 1 << 22):
            to.write(bytearray(data[at:at + (1 << 22)]))
        to.close()
        spark.sparkContext.addFile(f"{root}/{names[key]}")
    return names


def opened(names: dict[str, str]) -> dict[str, np.ndarray]:
    return {k: np.load(SparkFiles.get(v), mmap_mode="r") for k, v in names.items()}


# ---- encoding and decoding -----------------------------------------------------------

def encode_texts(texts: list, lex: dict, tok, memo: dict | None = None) -> list[np.ndarray]:
    """Ids of each text (null: empty), as unsigned 32-bit integers; ``memo`` keeps merges between calls."""
    import pandas as pd
    split = [chunks_of(t) for t in texts]
    flat = [c for s in split for c in s]
    if not flat:
        return [np.zeros(0, np.uint32)] * len(texts)
    codes, words = pd.factorize(np.array(flat, dtype=object))
    number = look_up(lex, list(words))
    unseen = np.flatnonzero(number < 0)
    memo = {} if memo is None else memo
    new = [words[i] for i in unseen if words[i] not in memo]
    memo.update(zip(new, _merged(new, tok)))
    merged = [memo[words[i]] for i in unseen]
    known = np.maximum(number, 0)
    starts = lex["starts"]
    begin, size = starts[known].astype(np.int64), (starts[np.minimum(known + 1, len(starts) - 1)] - starts[known]).astype(np.int64)
    pool = np.concatenate([lex["ids"], np.array([i for m in merged for i in m], dtype=np.uint32)])
    own = np.fromiter(map(len, merged), np.int64, len(merged))
    size[unseen] = own
    begin[unseen] = len(lex["ids"]) + np.cumsum(own) - own
    size, begin = size[codes], begin[codes]
    ends = np.cumsum(size)
    ids = pool[np.repeat(begin - (ends - size), size) + np.arange(ends[-1])]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    last = np.concatenate([[0], ends])[np.cumsum(counts)]
    return np.split(ids, last[:-1])


def _merged(words: list[bytes], tok) -> list:
    """Ids of each chunk by the tokenizer's own merges, few encodings at a time."""
    out = []
    for at in range(0, len(words), 4000):
        out += [e.ids for e in tok.encode_batch_fast([w.decode() for w in words[at:at + 4000]], add_special_tokens=False)]
    return out


class Decoder:
    """Decodes as a tokenizer without a decoder step does: the tokens' strings, one space between.

    The strings lie in one byte array; all texts of a slice are gathered from it at once.
    """

    def __init__(self, tok):
        names = [(tok.id_to_token(i) or "").encode() + b" " for i in range(tok.get_vocab_size())]
        self.pool = np.frombuffer(b"".join(names), np.uint8)
        self.size = np.fromiter(map(len, names), np.int64, len(names))
        self.start = np.cumsum(self.size) - self.size

    def __call__(self, texts: list[np.ndarray]) -> list[bytes]:
        flat = np.concatenate(texts) if texts else np.zeros(0, np.uint32)
        size = self.size[flat]
        ends = np.cumsum(size)
        at = np.repeat((self.start[flat] - (ends - size)).astype(np.int32), size)
        at += np.arange(len(at), dtype=np.int32)
        out = self.pool[at].tobytes()
        cuts = np.concatenate([[0], ends])[np.cumsum([0, *map(len, texts)])].tolist()
        return [out[a:max(a, b - 1)] for a, b in zip(cuts[:-1], cuts[1:])]


def _encoder(names: dict, tokenizer: str, want: str):
    def encode(batches):
        lex, tok = opened(names), load_tokenizer(SparkFiles.get(tokenizer))
        decode, memo = Decoder(tok), {}
        for b in batches:
            for part in slices(b):
                some = [n for n in part.schema.names if n != "text"]
                kept = [part.column(n) for n in some]
                if len(memo) > MEMO:
                    memo.clear()
                ids = encode_texts(part.column("text").to_pylist(), lex, tok, memo)
                made = {"n_tokens": pa.array([len(i) for i in ids], pa.int64())}
                if want == "digests":
                    sha = lambda x: hashlib.sha256(x).hexdigest()
                    made |= {"ids_sha256": pa.array([sha(i.astype("<u4").tobytes()) for i in ids], pa.string()),
                             "decoded_sha256": pa.array([sha(t) for t in decode(ids)], pa.string())}
                else:
                    made["input_ids"] = pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32()))
                if want == "texts":
                    made["decoded"] = pa.array([t.decode() for t in decode(ids)], pa.string())
                yield pa.RecordBatch.from_arrays([*kept, *made.values()], [*some, *made])
    return encode


def encode_documents(docs: DataFrame, id_cols: list[str], tokenizer: str | None = None, want: str = "texts",
                     max_words: int = MAX_WORDS) -> DataFrame:
    """Encode and decode every ``text`` (null: empty), one row per row of ``docs``.

    Returns ``id_cols`` (nulls, repeats and all), ``n_tokens`` and what is wanted:
    ``input_ids`` (``want="ids"``), these and ``decoded`` (``"texts"``), or the SHA-256 of both, made
    where the ids are (``"digests"``).  Long texts are encoded whole; an empty table gives no rows.
    """
    spark = docs.sparkSession
    path = tokenizer or default_tokenizer()
    tok = load_tokenizer(path)
    if tok.to_str().find('"decoder":null') < 0:
        raise ValueError("this decoder joins tokens by a space; the tokenizer has a decoder step of its own")
    words = frequent_chunks(docs, max_words)
    words = [w for w in words if w]
    names = publish(spark, compile_lexicon(words, _merged(words, tok)))
    give_back()
    spark.sparkContext.addFile(path)
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in id_cols)
    made = {"ids": "input_ids array<int>", "texts": "input_ids array<int>, decoded string",
            "digests": "ids_sha256 string, decoded_sha256 string"}[want]
    return docs.select(*id_cols, "text").mapInArrow(
        trimmed(_encoder(names, path.rsplit("/", 1)[-1], want)), f"{kinds}, n_tokens long, {made}")


def op5_bpe(spark, sf_dir):
    return encode_documents(table(spark, sf_dir, "documents"), ["doc_id"], want="digests")
