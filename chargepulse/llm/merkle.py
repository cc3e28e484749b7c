"""A Merkle manifest of a dataset: a proof for every row, grown by incremental witnesses.

A row's leaf is a hash of its columns.  The leaves of a group (a source) are appended in order to a tree
whose inner nodes hash three children each.  An open subtree keeps the partial
witnesses of its leaves; each later completion of a run of siblings extends them, and the run's
hash is appended one level up.  Leaves are dealt to aligned blocks of 3^6, which grow apart on the cluster
with one block in memory; the roots of blocks are nodes of the next round of appends, and so
are the groups' roots in the tree above them.  Going back down, a block's own witness is
appended to those of its leaves.  What meets in one task is a block of at most 729 nodes, whatever the group.

The ragged rule: while a level has several nodes, every three consecutive ones (the last run may be
shorter, even one) become their hash; a single node is the root.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chargepulse.llm.common import table, trimmed
from chargepulse.llm.sql import CRC_TABLE, crc32_of
from chargepulse.operators.rank import ranked
from chargepulse.session import stored

ARITY = 3
HEIGHT = 6
BLOCK = ARITY ** HEIGHT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEPS = "array<struct<left: binary, right: binary>>"


# ---- hashes as columns ---------------------------------------------------------------

def leaf_hash(fields: list[Column]) -> Column:
    """Hash of a row: per field ``-`` if null, else its length in UTF-8 bytes, ``:`` and its text."""
    parts = [F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
             for s in (f.cast("string") for f in fields)]
    return F.sha2(F.concat(*parts), 256)


def _text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def fold(leaf: Column | str, witness: Column | str) -> Column:
    """The root that ``leaf`` and its witness give."""
    leaf = F.col(leaf) if isinstance(leaf, str) else leaf
    return F.aggregate(witness, leaf, lambda acc, s: F.sha2(F.concat(_text(s["left"]), acc, _text(s["right"])), 256))


def proof_hash(witness: Column | str) -> Column:
    """Hash of the siblings, level by level upwards, left to right."""
    return F.sha2(F.array_join(F.transform(witness, lambda s: F.concat(_text(s["left"]), _text(s["right"]))), ""), 256)


# ---- the growing tree ----------------------------------------------------------------

class Growth:
    """An append-only tree that extends the witnesses of its leaves as runs of siblings complete.

    ``open[l]`` holds the nodes of level ``l`` that wait for siblings, each with the witnesses below it.
    """

    def __init__(self):
        self.open: list[list] = []
        self.count: list[int] = []
        self.witnesses: list[list] = []

    def append(self, digest: str) -> None:
        own: list = []
        self.witnesses.append(own)
        self._add(0, digest, [own])

    def _add(self, level: int, digest: str, below: list) -> None:
        if level == len(self.open):
            self.open.append([])
            self.count.append(0)
        self.open[level].append((digest, below))
        self.count[level] += 1
        if len(self.open[level]) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        digests = [d for d, _ in run]
        below: list = []
        for i, (_, members) in enumerate(run):
            step = (bytes.fromhex("".join(digests[:i])), bytes.fromhex("".join(digests[i + 1:])))
            for w in members:
                w.append(step)
            below += members
        self._add(level + 1, hashlib.sha256("".join(digests).encode()).hexdigest(), below)

    def close(self, height: int | None = None) -> str:
        """The root: at ``height`` if it is given (a block that others follow or precede), else the single node left."""
        level = 0
        while level != height and (height is not None or self.count[level] > 1):
            if self.open[level]:
                self._complete(level)
            level += 1
        return self.open[level][0][0]


def _grown(names: list[str], keys: int, types: list):
    """Streams blocks in order: every node with its witness, the first of a block with the block's root too."""
    def grow(batches):
        kinds = [pa.binary(), pa.binary()]

        def block(rows, at):
            tree = Growth()
            for r in rows:
                tree.append(r[-1])
            # A block 0 that is not full is the whole group.
            root = tree.close(HEIGHT if at or len(rows) == BLOCK else None)
            steps = [s for w in tree.witnesses for s in w]
            ends = [0]
            for w in tree.witnesses:
                ends.append(ends[-1] + len(w))
            pairs = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(zip(*steps), kinds)]
                                               if steps else [pa.array([], k) for k in kinds], ["left", "right"])
            made = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
            return pa.RecordBatch.from_arrays(
                [*made, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs),
                 pa.array([root] + [None] * (len(rows) - 1), pa.string())], [*names, "witness", "root"])
        rows, now = [], None
        for b in batches:
            for r in zip(*(b.column(n).to_pylist() for n in names)):
                if r[:keys + 1] != now:
                    if rows:
                        yield block(rows, now[-1])
                    rows, now = [], r[:keys + 1]
                rows.append(r)
        if rows:
            yield block(rows, now[-1])
    return grow


def _append_all(nodes: DataFrame, keys: list[str], payload: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """Appends the nodes (``keys, at, node`` and payload) of each key; levels from below, and the roots.

    A level has ``keys, block, at, payload, node, witness`` (inside its block) and the block's
    ``root`` in the block's first row.
    """
    levels = []
    while True:
        names = [*keys, "block", "at", *payload, "node"]
        rows = (nodes.withColumn("block", F.expr(f"at div {BLOCK}")).select(names)
                .repartition(*keys, "block").sortWithinPartitions(*keys, "block", "at"))
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        work = _grown(names, len(keys), _arrow_types(rows))
        levels.append(stored(rows.mapInArrow(trimmed(work), f"{schema}, witness {STEPS}, root string"), "merkle-level"))
        done = levels[-1].where("root is not null")
        nodes, payload = done.select(*keys, F.col("block").alias("at"), F.col("root").alias("node")), []
        if not done.where("block > 0").take(1):
            return levels, nodes


def _arrow_types(df: DataFrame) -> list:
    from pyspark.sql.pandas.types import to_arrow_type
    return [to_arrow_type(f.dataType) for f in df.schema]


def _descend(levels: list[DataFrame], keys: list[str], payload: list[str], above: DataFrame, more: list[str]) -> DataFrame:
    """Extends the witnesses of each level by those of the level above; ``above`` is that of the roots."""
    for k, level in enumerate(reversed(levels)):
        mine = payload if k == len(levels) - 1 else []
        up = above.select(*[F.col(c).alias(f"_{c}") for c in keys], F.col("at").alias("_at"),
                          F.col("witness").alias("_witness"), *more)
        same = level["block"] == up["_at"]
        for c in keys:
            same &= level[c].eqNullSafe(up[f"_{c}"])
        above = level.drop("root").join(up, same).select(
            *keys, "at", *mine, "node", F.concat("witness", "_witness").alias("witness"), *more)
    return above


def prove(leaves: DataFrame, payload: list[str] = ()) -> DataFrame:
    """``source, at (from 0), node`` and payload -> the same with ``subroot``, ``root`` and ``witness``.

    ``witness`` lists the steps to the root of all groups: what stands left and right of the
    node's ancestor in its run, as bytes of 32 a digest (hashed as hex text).  A null source is a group,
    the first.  Groups are nodes of one more tree, in UTF-8 order.  An empty table gives no rows.
    """
    levels, roots = _append_all(leaves, ["source"], list(payload))
    groups = ranked(stored(roots.select("source", "node"), "merkle-roots"), [F.col("source").asc_nulls_first()], name="_place")
    groups = groups.select("source", (F.col("_place") - 1).alias("at"), "node")
    above, top = _append_all(groups, [], ["source"])
    nothing = F.array().cast(STEPS)
    tops = top.select("at", nothing.alias("witness"), F.col("node").alias("root"))
    by_group = _descend(above, [], ["source"], tops, ["root"])
    by_group = stored(by_group.select("source", F.lit(0).cast("bigint").alias("at"), "witness",
                                      F.col("node").alias("subroot"), "root"), "merkle-groups")
    return _descend(levels, ["source"], list(payload), by_group, ["subroot", "root"])


# ---- the manifest --------------------------------------------------------------------

def tampered(doc_id: Column) -> Column:
    """The rows of the audit's tampering; a null id is left alone."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 2 == 0, F.lit(False))


def manifest(docs: DataFrame, other: Column | None = None) -> DataFrame:
    """``doc_id, source, leaf, other, subroot, root, witness`` of every row of ``docs``.

    Rows of a source go by ``doc_id`` (null first), then by leaf; equal rows are leaves of their own, one after the
    other.  Nulls have hashes of their own; a text is hashed whole, where it lies, and only digests move.
    ``other`` may be a second hash of the row, which is passed through.  Further columns are ignored.
    """
    leaf = leaf_hash([F.col(c) for c in FIELDS])
    rows = stored(docs.select("doc_id", "source", leaf.alias("leaf"),
                              (F.lit(None).cast("string") if other is None else other).alias("other")), "merkle-leaves")
    placed = ranked(rows, [F.col("doc_id").asc_nulls_first(), F.col("leaf").asc()], by=["source"], name="_place")
    leaves = placed.select("source", (F.col("_place") - 1).alias("at"), "doc_id", "other", F.col("leaf").alias("node"))
    return (prove(leaves, ["doc_id", "other"]).withColumnRenamed("node", "leaf")
            .select("doc_id", "source", "leaf", "other", "subroot", "root", "witness"))


def op11_merkle(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    changed = leaf_hash([F.replace("text", F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in FIELDS])
    other = F.when(tampered(F.col("doc_id")) & F.contains("text", F.lit("\n")), changed)
    got = manifest(docs, other)
    folded = fold(F.coalesce("other", "leaf"), "witness")
    return got.select("doc_id", "leaf", "subroot", "root", proof_hash("witness").alias("proof_sha256"),
                      folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def _leaf_sql(text: str) -> str:
    value = {"text": text}
    return "sha256(" + " || ".join(
        f"coalesce(strlen({v})::VARCHAR || ':' || {v}, '-')"
        for v in (value.get(c, f"{c}::VARCHAR") for c in FIELDS)) + ")"


ORACLE = f"""
WITH RECURSIVE crc AS ({CRC_TABLE}),
d AS (SELECT row_number() OVER () AS rid, doc_id, source, {_leaf_sql('text')} AS leaf,
             {_leaf_sql("replace(text, chr(10), '')")} AS changed,
             coalesce({crc32_of('doc_id::VARCHAR')} % 2 = 0, false) AS hit FROM documents, crc),
p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
up(source, l, pos, h) AS (
  SELECT source, 0, pos, leaf FROM p UNION ALL
  SELECT source, l + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY source) AS n FROM up) WHERE n > 1 GROUP BY source, l, pos // 3),
sub AS (SELECT source, max(l) AS height, arg_max(h, l) AS subroot FROM up GROUP BY source),
place AS (SELECT *, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM sub),
top(l, pos, h) AS (
  SELECT 0, pos, subroot FROM place UNION ALL
  SELECT l + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS n FROM top) WHERE n > 1 GROUP BY l, pos // 3),
steps AS (
  SELECT p.rid, up.l AS l, up.pos AS pos, p.pos // CAST(pow(3, up.l) AS BIGINT) AS mine, up.h AS h
  FROM p JOIN sub ON p.source IS NOT DISTINCT FROM sub.source
         JOIN up ON up.source IS NOT DISTINCT FROM p.source AND up.l < sub.height
              AND up.pos // 3 = p.pos // CAST(pow(3, up.l + 1) AS BIGINT)
  UNION ALL
  SELECT p.rid, 1000 + top.l, top.pos, place.pos // CAST(pow(3, top.l) AS BIGINT), top.h
  FROM p JOIN place ON p.source IS NOT DISTINCT FROM place.source
         JOIN top ON top.l < (SELECT max(l) FROM top) AND top.pos // 3 = place.pos // CAST(pow(3, top.l + 1) AS BIGINT)),
runs AS (SELECT rid, l, coalesce(string_agg(h, '' ORDER BY pos) FILTER (pos < mine), '') AS lefts,
                coalesce(string_agg(h, '' ORDER BY pos) FILTER (pos > mine), '') AS rights,
                row_number() OVER (PARTITION BY rid ORDER BY l) AS k FROM steps GROUP BY rid, l),
proofs AS (SELECT rid, sha256(string_agg(lefts || rights, '' ORDER BY l)) AS proof, max(k) AS n FROM runs GROUP BY rid),
folding(rid, k, acc) AS (
  SELECT rid, 0::BIGINT, CASE WHEN hit THEN changed ELSE leaf END FROM p UNION ALL
  SELECT f.rid, r.k, sha256(r.lefts || f.acc || r.rights) FROM folding f JOIN runs r ON r.rid = f.rid AND r.k = f.k + 1),
ends AS (SELECT rid, arg_max(acc, k) AS folded_root FROM folding GROUP BY rid)
SELECT p.doc_id, p.leaf, sub.subroot, r.root, coalesce(proofs.proof, sha256('')) AS proof_sha256, ends.folded_root,
       ends.folded_root = r.root AS verified
FROM p JOIN sub ON p.source IS NOT DISTINCT FROM sub.source JOIN ends ON ends.rid = p.rid
     LEFT JOIN proofs ON proofs.rid = p.rid, (SELECT arg_max(h, l) AS root FROM top) r
"""
