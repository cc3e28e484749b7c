"""Token files against the tokenizer itself; the format read by hand; what a reader decompresses; damage."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from chargepulse.llm import token_files as T
from chargepulse.llm.bpe import default_tokenizer, load_tokenizer
from chargepulse.session import work_dir

SCHEMA = "doc_id long, text string, start long, n int, entries string, frames string"
TEXTS = ["Some words, and MORE words.", "", None, "é ü <|endoftext|> x", "a\n\tb  c", "junk" * 500, "long text here. " * 60_000]


def rows_of(extra=()):
    texts = [TEXTS[i % 6] for i in range(300)] + [TEXTS[6]]
    rows = [(i * 37 % 1000, t) for i, t in enumerate(texts)]
    return [*rows, (None, "no id"), (None, "no id"), (None, None), (5000, "b"), (5000, "a a"), (5000, "b"), *extra]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "e", "f") for i, t in rows], SCHEMA).repartition(5)


def expected(rows):
    tok = load_tokenizer(default_tokenizer())
    out = []
    for i, t in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        out.append((i, np.array(ids, "<u4").tobytes()))
    groups = {}
    for i, raw in out:
        groups.setdefault(i, []).append(raw)
    return groups


def test_round_trip(spark):
    rows = rows_of()
    path = work_dir(spark, "test-tokens")
    files = T.write_token_files(frame(spark, rows), path, files=6)
    assert files.count() == 6
    want = expected(rows)
    got = sorted(T.read_token_files(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    at, seen = 0, {}
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["input_ids"])
        at += r["n_tokens"]
        seen.setdefault(r["doc_id"], []).append(np.array(r["input_ids"], "<u4").tobytes())
    assert {i: sorted(x) for i, x in seen.items()} == {i: sorted(x) for i, x in want.items()}
    digests = T.read_token_files(spark, path, want="digests").collect()
    assert sorted((r["start"], r["ids_crc32"]) for r in digests) == sorted(
        (r["start"], zlib.crc32(np.array(r["input_ids"], "<u4").tobytes())) for r in got)
    # long documents have several frames, and no frame holds two documents
    index = {r["start"]: r for r in T.document_index(spark, path).collect()}
    assert all(len(index[r["start"]]["entries"]) == 12 * -(-r["n_tokens"] // T.FRAME_IDS) for r in got)


def test_query(spark, tmp_path):
    rows = [(i, TEXTS[i % 6]) for i in range(200)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    tok, at, want = load_tokenizer(default_tokenizer()), 0, []
    for i, t in sorted(rows):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = T.op12_token_files(spark, str(tmp_path))
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and sorted(map(tuple, got.collect())) == want


def test_requested_documents_only(spark, monkeypatch):
    rows = rows_of()
    path = work_dir(spark, "test-tokens-some")
    T.write_token_files(frame(spark, rows), path, files=4)
    wanted = spark.createDataFrame([(37,), (None,), (74,), (999_999,), (5000,)], "doc_id long")
    some = T.read_documents(spark, path, wanted).collect()
    every = [r for r in T.read_token_files(spark, path).collect() if r["doc_id"] in (37, None, 74, 5000)]
    assert sorted(map(str, some)) == sorted(map(str, every)) and len(some) == 8
    # Frames of the others may be ruined: nobody reads them.
    keep = {(r["file"], r["place"]): len(r["entries"]) for r in T.document_index(spark, path).collect() if r["doc_id"] in (37, None, 74, 5000)}
    for r in T.token_files(spark, path).collect():
        at = f"{path}/files/{r['file']}"
        data = bytearray(open(at, "rb").read())
        documents, entries = T.read_tail(lambda n, o: bytes(data[o:o + n]), len(data))
        place = 0
        for e in entries:
            if (r["file"], place) not in keep:
                data[place:place + int(e["packed"])] = b"\xff" * int(e["packed"])
            place += int(e["packed"])
        open(at, "wb").write(data)
    assert sorted(map(str, T.read_documents(spark, path, wanted).collect())) == sorted(map(str, some))
    with pytest.raises(Exception):
        T.read_token_files(spark, path).collect()


def test_public_format(spark):
    """A file is plain zstandard, and its seek table is that of the public seekable format."""
    import xxhash
    import zstandard
    path = work_dir(spark, "test-tokens-format")
    T.write_token_files(frame(spark, [(1, "one two"), (2, None), (3, "three")]), path, files=1)
    name = T.token_files(spark, path).first()["file"]
    data = open(f"{path}/files/{name}", "rb").read()
    n, flags, magic = struct.unpack("<IBI", data[-9:])
    assert (n, flags, magic) == (4, 0x80, 0x8F92EAB1)
    entries = [struct.unpack_from("<3I", data, len(data) - 9 - 12 * (n - i)) for i in range(n)]
    at = 0
    for packed, size, total in entries[:-1]:
        raw = zstandard.ZstdDecompressor().decompress(data[at:at + packed])
        assert len(raw) == size and xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF == total
        at += packed
    assert struct.unpack_from("<I", data, at)[0] == 0x184D2A50 and entries[-1][1] == 0
    assert struct.unpack_from("<I", data, at + entries[-1][0])[0] == 0x184D2A5E


def test_checksums_find_damage():
    import zstandard
    frames, entries = T.compressed(np.arange(1000, dtype="<u4").tobytes(), zstandard.ZstdCompressor())
    entries = np.frombuffer(entries, T.ENTRY).copy()
    d = zstandard.ZstdDecompressor()
    assert b"".join(T.decompressed(frames, entries, d)) == np.arange(1000, dtype="<u4").tobytes()
    entries["sum"] ^= 1
    with pytest.raises(ValueError):
        list(T.decompressed(frames, entries, d))
    with pytest.raises(ValueError):
        T.read_tail(lambda n, o: b"\0" * n, 100)


def test_empty_table(spark):
    path = work_dir(spark, "test-tokens-empty")
    assert T.write_token_files(frame(spark, [(1, "x")]).where("doc_id = 2"), path).count() == 0
    assert T.read_token_files(spark, path).count() == 0
    assert T.read_documents(spark, path, spark.createDataFrame([(1,)], "doc_id long")).count() == 0


def test_hot_id_is_split(spark):
    docs = spark.range(4000).select(F.lit(7).cast("long").alias("doc_id"), F.col("id").cast("string").alias("text"))
    path = work_dir(spark, "test-tokens-hot")
    sizes = [r["documents"] for r in T.write_token_files(docs, path, files=8).collect()]
    assert sum(sizes) == 4000 and max(sizes) < 2000


def test_chunk_ids_are_the_tokenizers():
    import random
    tok, rng = load_tokenizer(default_tokenizer()), random.Random(0)
    known = T.ChunkIds(tok)
    letters = "abcdefgzABZ éßÿäÀÉİıſK Å.,;:!?'s't##<|>|09\t\n\x0b\x0c\r\x1c\x85\xa0 ́中あ😀_-ﬁǅ"
    words = ["<|endoftext|>", "<|startoftext|>", "it's", "i'll", "x.", "É.", "x...!", "3.", "é!", "a.b.", "<|", "..", "'S"]
    for _ in range(8000):
        text = "".join(rng.choice(letters) if rng.random() < 0.8 else rng.choice(words) for _ in range(rng.randint(0, 14)))
        assert known.of(text) == np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text
