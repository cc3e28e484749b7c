"""Mixing sources to target weights with a low-discrepancy schedule.

Golden-ratio points ``frac(i * phi)`` go through the sources' cumulative weights, so every
stretch of the schedule holds each source in its share.  A source's documents lie in a
hash-shuffled order, cut into blocks of equal token counts; its ``k``-th slot takes block ``k``,
beginning again after the last one; the last slot takes only what its target leaves.  A document is
taken as often as slots take the blocks it lies in.

The number of slots depends on the sources alone, so the schedule does not grow with the input; blocks
do.  A source has its own block, from its target and the slots that fell to it, so it takes its
target, rounded to words, at every size.  Places of documents are two-level running sums over hash ranges, so a hot
source is many groups.  The table of sources is small against the documents (one row per
source) and meets slots through an equi-join on cells of the unit interval.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chargepulse.llm.common import staged, table

PHI = 0.6180339887498949
SLOTS = 1 << 18            # slots of the schedule, dealt by target
LEAST = 1 << 6             # slots of a source, at least
CELLS = 1 << 10            # cells of the unit interval, at least
RANGES = 1 << 11           # hash ranges of a source's documents
STEP = 1 << 13             # consecutive slots that are ranked together
#: Weights of the sources in code point order (null last), repeating, and the share of all sizes; from the contract.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0


def word_count(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source, source_size, target``: shares by weight; what would pass ``most`` sizes is reshared by weight.

    Sorted by size over weight, the sources that stop at their limit are a prefix; the rest
    share what is left.  The windows run over one row per source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (place % len(weights) + 1).cast("int"))
    ranked = per.withColumn("w", w).withColumn("full", F.col("source_size") * F.lit(most))
    order = Window.orderBy(F.col("full") / F.col("w"), F.col("source").isNull(), F.encode("source", "UTF-8"))
    everything = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (ranked.withColumn("total", F.sum("source_size").over(everything) * F.lit(share))
              .withColumn("w_all", F.sum("w").over(everything))
              .withColumn("full_before", F.coalesce(F.sum("full").over(before), F.lit(0.0)))
              .withColumn("w_before", F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    level = (F.col("total") - F.col("full_before")) / (F.col("w_all") - F.col("w_before"))
    ranked = ranked.withColumns({"level": level, "place": F.row_number().over(order)})
    # The sources before the first one below its limit stop; its level holds for the rest.
    free = F.min(F.when(F.col("full") > F.col("level") * F.col("w"), F.struct("place", "level"))).over(everything)
    ranked = ranked.withColumn("free", free)
    stops = F.col("free").isNull() | (F.col("place") < F.col("free.place"))
    return ranked.select("source", "source_size", F.when(stops, F.col("full")).otherwise(
        F.col("free.level") * F.col("w")).alias("target"))


def mix_sources(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST,
                slots: int = SLOTS, row: str | None = None) -> DataFrame:
    """``doc_id, source, text`` rows -> ``doc_id, size, source_size, target, taken``, one row per input row.

    ``size`` counts words between ASCII white space (null text: 0); a null source is a
    source.  ``taken`` counts words with repeats and is at most ``most`` times the size.
    Rows with equal ids take places by their size, repeated rows one after another.  Empty
    tables and tables without words take nothing.  ``row`` names a column of ``docs`` that numbers its rows;
    the result then holds it too, as ``row``.
    """
    # The row number only tells equal rows apart; it is written once and then read.
    number = F.col(row) if row else F.monotonically_increasing_id()
    sized = staged(docs.select("doc_id", "source", word_count().alias("size"), number.alias("row")), "mix-sizes")
    targets = staged(source_targets(sized, weights, share, most), "mix-targets")
    total = targets.agg(F.sum("target")).first()[0] or 0.0

    # Places of documents in their source's shuffled order.
    key = F.xxhash64(F.lit(41), "doc_id")
    same = F.coalesce("source", F.lit("")), F.col("source").isNull()
    placed = sized.withColumns({"key": key, "s": same[0], "s_null": same[1]})
    placed = placed.withColumn("range", F.shiftrightunsigned("key", 64 - RANGES.bit_length() + 1))
    of = ["s", "s_null"]
    sums = placed.groupBy(*of, "range").agg(F.sum("size").alias("range_size"))
    before = Window.partitionBy(*of).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = staged(sums.withColumn("offset", F.coalesce(F.sum("range_size").over(before), F.lit(0))).drop("range_size"),
                     "mix-offsets")
    inside = Window.partitionBy(*of, "range").orderBy("key", "doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, -1)
    spans = (placed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
             .join(offsets, [*of, "range"]).withColumn("start", F.col("offset") + F.col("inside")))

    # The schedule: slots, their sources, and the rank of a slot among its source's.
    lines = (targets.where("target > 0").withColumns({"s": same[0], "s_null": same[1]})
             .withColumn("slots", F.greatest(F.lit(LEAST), F.ceil(F.col("target") * (slots / (total or 1.0))))))
    wanted = lines.agg(F.sum("slots"), F.count("*")).first()
    n_slots, cells = wanted[0] or 0, max(CELLS, wanted[1])
    cum = Window.orderBy("s_null", F.encode("s", "UTF-8")).rowsBetween(Window.unboundedPreceding, -1)
    lines = (lines.withColumn("low", F.coalesce(F.sum("slots").over(cum), F.lit(0)) / F.lit(float(n_slots or 1)))
             .withColumn("high", F.lead("low").over(Window.orderBy("s_null", F.encode("s", "UTF-8"))))
             .withColumn("high", F.coalesce("high", F.lit(1.0))))
    cell = lambda x: F.least(F.floor(x * cells), F.lit(cells - 1)).cast("int")
    lines = (lines.withColumn("cell", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high")))))
             .select(*of, "low", "high", "cell"))
    ids = docs.sparkSession.range(n_slots)
    point = F.col("id") * F.lit(PHI)
    points = ids.withColumn("u", point - F.floor(point)).withColumn("cell", cell(F.col("u")))
    chosen = staged(points.join(lines, "cell").where("low <= u and u < high")
                    .select("id", (F.col("id") / STEP).cast("long").alias("step"), *of), "mix-slots")
    per_step = staged(chosen.groupBy(*of, "step").count(), "mix-steps")
    first = per_step.withColumn("first", F.coalesce(F.sum("count").over(
        Window.partitionBy(*of).orderBy("step").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    # A source's words, its passes over all blocks and what is left for one further pass.  Each pass ends
    # with a block that may be short, hence the slots that are kept back.
    goal = F.floor(F.col("target") + 0.5)
    got_slots = F.greatest(F.coalesce("n_slots", F.lit(1)) - int(most) - 1, F.lit(1))
    plan = (targets.withColumns({"s": same[0], "s_null": same[1]})
            .join(per_step.groupBy(*of).agg(F.sum("count").alias("n_slots")), of, "left")
            .withColumn("block", F.greatest(F.ceil(goal / got_slots), F.lit(1)))
            .withColumn("passes", F.coalesce(F.floor(goal / F.when(F.col("source_size") > 0, F.col("source_size"))), F.lit(0)))
            .withColumn("rest", goal - F.col("passes") * F.col("source_size"))
            .withColumn("blocks", F.greatest(F.ceil(F.col("source_size") / F.col("block")), F.lit(1))))
    plan = staged(plan.select(*of, "source_size", "target", "block", "blocks", "passes", "rest"), "mix-plan")
    rank = F.col("first") + F.row_number().over(Window.partitionBy(*of, "step").orderBy("id")) - 1
    turn = F.floor(F.col("rank") / F.col("blocks"))
    taken = (chosen.join(first, [*of, "step"]).withColumn("rank", rank).join(plan, of)
             .withColumns({"turn": turn, "block_no": (F.col("rank") % F.col("blocks")).cast("long")})
             .where((F.col("turn") < int(most)) & ((F.col("turn") < F.col("passes")) | (
                 (F.col("turn") == F.col("passes")) & (F.col("block_no") * F.col("block") < F.col("rest")))))
             .groupBy(*of, "block_no").agg(F.count_if(F.col("turn") < F.col("passes")).alias("times"),
                                           F.count_if(F.col("turn") == F.col("passes")).alias("further")))
    taken = staged(taken, "mix-taken")

    # A document meets the blocks that it lies in; the further pass ends at the rest.
    last = F.greatest(F.col("start") + F.col("size") - 1, F.col("start"))
    end = F.least(F.col("start") + F.col("size"), (F.col("block_no") + 1) * F.col("block"))
    begin = F.greatest(F.col("start"), F.col("block_no") * F.col("block"))
    pieces = (spans.join(plan, of).withColumn("block_no", F.explode(F.sequence(
                  (F.col("start") / F.col("block")).cast("long"), (last / F.col("block")).cast("long"))))
              .withColumns({"words": end - begin,
                            "words_further": F.greatest(F.least(end, F.col("rest")) - begin, F.lit(0))}))
    words = (F.col("words") * F.coalesce("times", F.lit(0))
             + F.col("words_further") * F.coalesce("further", F.lit(0)))
    got = (pieces.join(taken, [*of, "block_no"], "left")
           .groupBy("row", "doc_id", *of, "size", "source_size", "target").agg(F.sum(words).alias("taken")))
    return got.select(*["row"] * bool(row), "doc_id", F.when(~F.col("s_null"), F.col("s")).alias("source"), "size", "source_size",
                      F.col("target").cast("double").alias("target"), F.col("taken").cast("long").alias("taken"))


def op9_mixing(spark, sf_dir):
    mixed = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")
