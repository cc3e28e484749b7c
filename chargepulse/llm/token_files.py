"""Token ids in seekable files: independent zstandard frames, a trailing seek table, checksums.

A file holds documents in ascending order of their ids.  A document is one frame, or several of at most
``FRAME_IDS`` ids, of little-endian unsigned 32-bit token ids; no frame holds two documents, so a reader
decompresses what it asks for and nothing else.  Behind the frames stand two skippable frames, which
other zstandard readers pass over::

    0x184D2A50 size  documents: count, then per document id, null mark, ids, frames (zstandard)
    0x184D2A5E size  seek table: per frame compressed size, size, low half of the content's XXH64;
                     then the number of frames, 0x80 and 0x8F92EAB1 (the public seekable format)

The seek table's last entry is the documents' frame, of size 0 when decompressed.

Documents are encoded and compressed where they lie.  Only finished frames are dealt to ranges of document ids and
put one after another by the task that writes a range, straight to the shared folder, under a name of its own; a file
counts when the stored list of files names it, so a lost or repeated task leaves nothing but an unnamed file.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chargepulse.llm.bpe import default_tokenizer, load_tokenizer
from chargepulse.llm.common import shuffle_partitions, slices, table, trimmed
from chargepulse.session import work_dir

FRAME_IDS = 1 << 18
FILE_BYTES = 256_000_000   # of frames, about
MEMO = 600_000             # chunks whose ids a task remembers, 0.2 KB each
END = 1
LETTERS = re.compile("[a-zß-öø-ÿ]+")

# Fixed values of the public formats.
DOCUMENTS, SEEK_TABLE, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("sum", "<u4")])
DOCUMENT = np.dtype([("id", "<i8"), ("null", "u1"), ("ids", "<u8"), ("frames", "<u4")])


# ---- frames --------------------------------------------------------------------------

def compressed(raw: bytes, compressor) -> tuple[bytes, bytes]:
    """Frames of a document's ids, and their seek table entries."""
    import xxhash
    frames, entries = [], []
    for at in range(0, len(raw), 4 * FRAME_IDS):
        part = raw[at:at + 4 * FRAME_IDS]
        frames.append(compressor.compress(part))
        entries.append(struct.pack("<3I", len(frames[-1]), len(part), xxhash.xxh64_intdigest(part) & 0xFFFFFFFF))
    return b"".join(frames), b"".join(entries)


def decompressed(frames: bytes, entries, decompressor):
    """The content of each frame; a frame that does not keep its entry's size and checksum is an error."""
    import xxhash
    at = 0
    for packed, size, total in entries.tolist():
        part = decompressor.decompress(frames[at:at + packed], max_output_size=size)
        if len(part) != size or xxhash.xxh64_intdigest(part) & 0xFFFFFFFF != total:
            raise ValueError("a frame's checksum is wrong")
        yield part
        at += packed


def tail(documents: np.ndarray, entries: bytes) -> bytes:
    """What stands behind the frames: the documents' frame and the seek table."""
    import xxhash
    import zstandard
    listed = struct.pack("<Q", len(documents)) + zstandard.ZstdCompressor(level=3).compress(documents.tobytes())
    first = struct.pack("<2I", DOCUMENTS, len(listed)) + listed
    entries += struct.pack("<3I", len(first), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)
    foot = struct.pack("<IBI", len(entries) // ENTRY.itemsize, 0x80, SEEKABLE)
    return first + struct.pack("<2I", SEEK_TABLE, len(entries) + len(foot)) + entries + foot


def read_tail(read_at, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents and entries of a file of ``size`` bytes, of which ``read_at(count, place)`` gives parts."""
    import zstandard
    n, flags, magic = struct.unpack("<IBI", read_at(9, size - 9))
    if magic != SEEKABLE or flags != 0x80:
        raise ValueError("no seek table")
    begin = size - 9 - ENTRY.itemsize * n
    kind, length = struct.unpack("<2I", read_at(8, begin - 8))
    if kind != SEEK_TABLE or length != ENTRY.itemsize * n + 9:
        raise ValueError("the seek table is damaged")
    entries = np.frombuffer(read_at(ENTRY.itemsize * n, begin), ENTRY)
    packed = int(entries["packed"][-1])
    first = read_at(packed, begin - 8 - packed)
    if struct.unpack_from("<I", first)[0] != DOCUMENTS or int(entries["packed"].sum(dtype=np.int64)) != begin - 8:
        raise ValueError("the list of documents is damaged")
    count = struct.unpack_from("<Q", first, 8)[0]
    raw = zstandard.ZstdDecompressor().decompress(first[16:], max_output_size=max(1, count * DOCUMENT.itemsize))
    return np.frombuffer(raw, DOCUMENT), entries[:-1]


# ---- encoding ------------------------------------------------------------------------

class ChunkIds(dict):
    """Ids of chunks (runs without ASCII white space, A-Z lower-cased) as bytes, found when first asked for.

    No step of the tokenizer looks across ASCII white space, so a text's ids are its chunks' ids one after
    another.  A run of stops after a letter is a token of its own.  A run of letters is what the steps before the
    tokenizer's model leave as it is, so the model takes it at once; other chunks go through the whole tokenizer.
    """

    def __init__(self, tok):
        from tokenizers import pre_tokenizers
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.tok, self.model = tok, tok.model
        self.spelt = {c: spell(chr(c))[0][0] for c in (*range(0xDF, 0xF7), *range(0xF8, 0x100))}

    def __missing__(self, chunk: bytes) -> bytes:
        base = chunk.rstrip(b".,;:!?")
        if len(base) < len(chunk) and base[-1:].islower() and b"<|" not in chunk:
            ids = self[base] + self[chunk[len(base):]]
        else:
            text = chunk.decode()
            if LETTERS.fullmatch(text):
                found = [t.id for t in self.model.tokenize(text.translate(self.spelt))]
            else:
                found = self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids
            ids = array("I", found).tobytes()
        self[chunk] = ids
        return ids

    def of(self, text: str | None) -> bytes:
        raw = (text or "").encode()
        # What may hold a special token, which is matched before lower-casing, stays as it is.
        return b"".join(map(self.__getitem__, (raw if b"<|" in raw else raw.lower()).split()))


def _framed(tokenizer: str, end: int):
    """Each document's frames; a task remembers the ids of the chunks that it has seen."""
    stop = struct.pack("<I", end)

    def work(batches):
        import zstandard
        known = ChunkIds(load_tokenizer(SparkFiles.get(tokenizer)))
        compressor = zstandard.ZstdCompressor(level=3)
        for b in batches:
            for part in slices(b):
                if len(known) > MEMO:
                    known.clear()
                raws = [known.of(t) + stop for t in part.column("text").to_pylist()]
                made = [compressed(raw, compressor) for raw in raws]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(raw) // 4 for raw in raws], pa.int64()),
                     pa.array([m[1] for m in made], pa.binary()), pa.array([len(m[0]) for m in made], pa.int64()),
                     pa.array([m[0] for m in made], pa.binary())], ["doc_id", "n", "entries", "bytes", "frames"])
    return work


# ---- files ---------------------------------------------------------------------------

def _opened(path: str):
    """The file system of a path or URI, and the path inside it."""
    from pyarrow import fs
    if path.startswith("file:") and not path.startswith("file://"):
        path = path[5:]
    return fs.FileSystem.from_uri(path)


LISTED = "file string, doc_id long, n long, entries binary, documents long, ids long, bytes long"


def _writer(folder: str):
    """Writes the rows of a task, in order, as one file, and names it."""
    def work(batches):
        out, documents, entries, first, total = None, [], [], None, 0
        try:
            for b in batches:
                ids, sizes, marks = (b.column(c).to_pylist() for c in ("doc_id", "n", "entries"))
                if out is None and ids:
                    fs, at = _opened(folder)
                    fs.create_dir(at, recursive=True)
                    name = f"ids-{uuid.uuid4().hex}.zst"
                    out, first = fs.open_output_stream(f"{at}/{name}", compression=None), (ids[0], sizes[0], marks[0])
                for frames in b.column("frames"):
                    out.write(frames.as_buffer())
                documents.append(np.array([(i or 0, i is None, n, len(m) // ENTRY.itemsize) for i, n, m in zip(ids, sizes, marks)],
                                          dtype=DOCUMENT))
                entries += marks
                total += sum(sizes)
            if out is not None:
                out.write(tail(np.concatenate(documents), b"".join(entries)))
                size = out.tell()
        finally:
            if out is not None:
                out.close()
        if out is not None:
            n = sum(map(len, documents))
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(
                [name, *first, n, total, size], [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()])],
                ["file", "doc_id", "n", "entries", "documents", "ids", "bytes"])
    return work


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, end: int = END, files: int | None = None) -> DataFrame:
    """Write the ids of every ``text`` (null: empty), each followed by ``end``, below ``path``.

    Documents go by ``doc_id`` (null first; repeats by their number of ids, then checksums).  Long texts are encoded
    whole; an empty table gives no files; further columns are ignored.  There are ``files`` files, by default the shuffle partitions or
    one per ``FILE_BYTES`` of frames.  Returns the list of files, as stored in ``path/list``: ``file``, ``start`` (ids in
    the files before it), ``documents``, ``ids``, ``bytes``.
    """
    spark, path = docs.sparkSession, path.rstrip("/")
    model = tokenizer or default_tokenizer()
    spark.sparkContext.addFile(model)
    work = work_dir(spark, "token-files")
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
     .mapInArrow(trimmed(_framed(model.rsplit("/", 1)[-1], end)), "doc_id long, n long, entries binary, bytes long, frames binary")
     .write.option("compression", "none").parquet(f"{work}/frames"))
    framed = spark.read.parquet(f"{work}/frames")
    total = framed.agg(F.sum("bytes")).first()[0] or 0
    order = [F.col("doc_id").asc_nulls_first(), F.col("n").asc(), F.col("entries").asc()]
    ranges = files or max(shuffle_partitions(spark), -(-total // FILE_BYTES))
    (framed.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select("doc_id", "n", "entries", "frames")
     .mapInArrow(trimmed(_writer(f"{path}/files")), LISTED).write.parquet(f"{work}/written"))
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    listed = spark.read.schema(LISTED).parquet(f"{work}/written").select(
        "file", F.coalesce(F.sum("ids").over(before), F.lit(0)).cast("long").alias("start"), "documents", "ids", "bytes")
    listed.write.parquet(f"{path}/list")
    return token_files(spark, path)


def token_files(spark: SparkSession, path: str) -> DataFrame:
    """The list of files below ``path``."""
    return spark.read.schema("file string, start long, documents long, ids long, bytes long").parquet(f"{path.rstrip('/')}/list")


def _dealt(spark: SparkSession, path: str) -> DataFrame:
    """The list, a file a task."""
    files = token_files(spark, path)
    return files.repartitionByRange(max(1, files.count()), "start").select("file", "start", "bytes")


def _each_document(fs, at: str, size: int, start: int):
    """(document, its entries, place of its frames, ids before it) of a file, from its tail alone."""
    with fs.open_input_file(at) as f:
        documents, entries = read_tail(f.read_at, size)
    offsets = np.concatenate([[0], np.cumsum(entries["packed"], dtype=np.int64)])
    frame = 0
    for doc in documents:
        mine = entries[frame:frame + int(doc["frames"])]
        yield (None if doc["null"] else int(doc["id"])), int(doc["ids"]), mine, int(offsets[frame]), start
        frame, start = frame + len(mine), start + int(doc["ids"])


def _batches(rows, names, kinds, most: int = 1_000_000, weight=lambda r: 1):
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += weight(r)
        if size >= most or len(held) >= 2000:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)


def _reader(folder: str, want: str):
    """Every document of whole files, front to back."""
    def rows(batches):
        import zstandard
        d = zstandard.ZstdDecompressor()
        fs, at = _opened(folder)
        for b in batches:
            for name, start, size in zip(*(b.column(c).to_pylist() for c in ("file", "start", "bytes"))):
                with fs.open_input_stream(f"{at}/{name}", compression=None, buffer_size=1 << 20) as f:
                    for doc, n, entries, _, begin in _each_document(fs, f"{at}/{name}", size, start):
                        parts = decompressed(f.read(int(entries["packed"].sum(dtype=np.int64))), entries, d)
                        if want == "ids":
                            yield doc, begin, n, np.frombuffer(b"".join(parts), "<u4").astype(np.int32)
                        else:
                            crc = 0
                            for p in parts:
                                crc = zlib.crc32(p, crc)
                            yield doc, begin, n, crc
    return _rows_of(rows, want)


def _rows_of(rows, want: str):
    last = ("input_ids", pa.list_(pa.int32())) if want == "ids" else ("ids_crc32", pa.int64())
    names, kinds = ["doc_id", "start", "n_tokens", last[0]], [pa.int64()] * 3 + [last[1]]
    return lambda batches: _batches(rows(batches), names, kinds, weight=lambda r: r[2] if want == "ids" else 1)


def _schema(want: str) -> str:
    return "doc_id long, start long, n_tokens long, " + {"ids": "input_ids array<int>", "digests": "ids_crc32 long"}[want]


def read_token_files(spark: SparkSession, path: str, want: str = "ids") -> DataFrame:
    """``doc_id, start`` (ids of all documents before it), ``n_tokens`` and ``input_ids`` of every document, or (``"digests"``)
    the CRC-32 of its ids.  Every frame's checksum is verified."""
    return _dealt(spark, path).mapInArrow(trimmed(_reader(f"{path.rstrip('/')}/files", want)), _schema(want))


def document_index(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, file, place, start, n_tokens, entries`` of every document, from the files' tails alone."""
    folder = f"{path.rstrip('/')}/files"

    def work(batches):
        fs, at = _opened(folder)
        for b in batches:
            rows = ((doc, name, place, begin, n, entries.tobytes())
                    for name, start, size in zip(*(b.column(c).to_pylist() for c in ("file", "start", "bytes")))
                    for doc, n, entries, place, begin in _each_document(fs, f"{at}/{name}", size, start))
            yield from _batches(rows, ["doc_id", "file", "place", "start", "n_tokens", "entries"],
                                [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()])
    return _dealt(spark, path).mapInArrow(trimmed(work), "doc_id long, file string, place long, start long, n_tokens long, entries binary")


def read_documents(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Rows as :func:`read_token_files` gives them, of the documents whose ``doc_id`` (nulls too) is in ``wanted``.

    Tails are read, and of the frames only those of these documents.
    """
    folder, index, ids = f"{path.rstrip('/')}/files", document_index(spark, path), wanted.select("doc_id").distinct()
    asked = (index.join(ids, index["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi")
             .repartition("file", F.expr("place div 100000000")).sortWithinPartitions("file", "place"))

    def rows(batches):
        import zstandard
        d, held, f = zstandard.ZstdDecompressor(), None, None
        fs, at = _opened(folder)
        try:
            for b in batches:
                for doc, name, place, start, n, marks in zip(*(b.column(c).to_pylist() for c in b.schema.names)):
                    if name != held:
                        if f is not None:
                            f.close()
                        f, held = fs.open_input_file(f"{at}/{name}"), name
                    entries = np.frombuffer(marks, ENTRY)
                    parts = decompressed(f.read_at(int(entries["packed"].sum(dtype=np.int64)), place), entries, d)
                    yield doc, start, n, np.frombuffer(b"".join(parts), "<u4").astype(np.int32)
        finally:
            if f is not None:
                f.close()
    return asked.mapInArrow(trimmed(_rows_of(rows, "ids")), _schema("ids"))


def op12_token_files(spark, sf_dir):
    path = work_dir(spark, "op12")
    write_token_files(table(spark, sf_dir, "documents"), path)
    return read_token_files(spark, path, want="digests")
