"""Distributed rank: places against a plain sort; groups, ties, nulls, hot keys, empty tables."""

import pytest
from pyspark.sql import functions as F

from chargepulse.operators.rank import ranked
from chargepulse.plans.catalog import QUERIES

from conftest import SF001
from tools import explain_text


def test_global_rank_is_the_sorted_place(spark):
    df = spark.range(5000).select(F.xxhash64("id").alias("v"), F.col("id"))
    got = ranked(df, [F.col("v").desc(), F.col("id").asc()], ranges=7).collect()
    want = sorted(((r.v, r.id) for r in got), key=lambda x: (-x[0], x[1]))
    assert {(r.v, r.id): r.rank for r in got} == {x: i + 1 for i, x in enumerate(want)}


def test_rank_inside_groups_with_a_hot_one_and_nulls(spark):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("g"), (F.col("id") % 40).cast("string"))).alias("g"), F.xxhash64("id").alias("v"))
    got = ranked(df, [F.col("v").asc()], by=["g"], name="at", ranges=11)
    assert got.columns == ["g", "v", "at"]
    groups = {}
    for r in got.collect():
        groups.setdefault(r.g, []).append((r.v, r.at))
    assert len(groups) > 20 and None in groups and len(groups["hot"]) == 2000
    for rows in groups.values():
        assert [at for _, at in sorted(rows)] == list(range(1, len(rows) + 1))


def test_equal_rows_get_places_of_their_own(spark):
    df = spark.range(1000).select(F.lit(1).alias("v"))
    assert sorted(r.rank for r in ranked(df, [F.col("v").asc()], ranges=5).collect()) == list(range(1, 1001))


@pytest.mark.parametrize("by", [[], ["g"]])
def test_rank_of_an_empty_table(spark, by):
    got = ranked(spark.createDataFrame([], "g string, v int"), [F.col("v").asc()], by=by)
    assert got.count() == 0 and got.columns == ["g", "v", "rank"]


def test_sort_rank_sorts_in_ranges(spark):
    df = QUERIES["sort_rank"](spark, SF001)
    plan = explain_text(df)
    # The only window runs over one count per range.
    assert plan.count("SinglePartition") <= 1 and "rangepartitioning" not in plan.lower()
    rows = df.collect()
    assert [r["rank"] for r in sorted(rows, key=lambda r: (-r["orders"], r["minute"], r["province"]))] == list(range(1, len(rows) + 1))
