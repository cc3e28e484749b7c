"""A corpus pipeline of five operators: toxicity, near-dedup, personal data, mixing, encoding.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before kept;
all but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chargepulse.llm import bpe, minhash, mixing, pii, toxicity
from chargepulse.llm.common import staged, table
from chargepulse.operators.rank import ranked


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    name = "_toxicity"
    while name in docs.columns:
        name += "_"
    scored = toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"), name=name)
    return scored.where(F.col(name) < 0.5).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group (five-word shingles, similarity 0.8).

    Rows are told apart by their place by id (null ids last) and content, so rows that share an id, or
    have none, are documents of their own: a different text stays, of equal or linked ones the first.
    Rows without words all stay.
    """
    placed = ranked(docs.select(F.struct(*docs.columns).alias("doc")),
                    [F.col("doc.doc_id").asc_nulls_last(), F.xxhash64("doc").asc()], name="place")
    kept = minhash.near_duplicates(placed.select(F.col("place").alias("doc_id"), "doc.text"), k=5).where("kept")
    return placed.join(kept.select(F.col("doc_id").alias("place")), "place", "left_semi").select("doc.*")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; ``n_chars``, if there is one, follows."""
    out = pii.mask_pii(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it, to the nearest whole copy.

    Blocks are taken whole, so a source has few documents that are taken in part.  Rows that
    share an id, or have none, are taken each by its own source; documents without words are not taken.
    """
    rows = staged(docs.select(F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("row")), "mix-rows")
    taken = (mixing.mix_sources(rows.select("doc.doc_id", "doc.source", "doc.text", "row"), row="row").where("size > 0")
             .select("row", F.floor(F.col("taken") / F.col("size") + 0.5).cast("int").alias("copies")).where("copies > 0"))
    return (rows.join(taken, "row").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the text that they decode to."""
    return bpe.encode_documents(docs, ["doc_id", "lang", "source"], want="texts")


STAGES = [("toxicity", drop_toxic), ("minhash_near_dedup", drop_near_duplicates), ("pii", mask_personal_data),
          ("mixing", mix), ("bpe", encode)]

#: SQL cannot express the trained stages; tests hold them against brute force.
ORACLE_SQL = None


def run_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, in order, on ``documents``; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``run_whole`` without the decoded texts."""
    return run_whole(spark, sf_dir).drop("decoded")
