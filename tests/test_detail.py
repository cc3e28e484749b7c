"""Parse once into a day-partitioned table; KPIs from it; day ranges prune partitions."""

from chargepulse.plans import notify as N
from chargepulse.plans.catalog import QUERIES, notify_clean
from chargepulse.plans.detail import read_detail, write_detail
from chargepulse.session import work_dir

from conftest import SF001
from tools import explain_text


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_detail_table_kpis_and_pruning(spark):
    path = write_detail(notify_clean(spark, SF001), work_dir(spark, "test-detail") + "/t", files=4)
    t = read_detail(spark, path)
    assert rows(N.daily_totals(t)) == rows(QUERIES["daily_totals"](spark, SF001))
    assert rows(N.top10_province(t)) == rows(QUERIES["top10_province"](spark, SF001))
    some = read_detail(spark, path, first_day="20240105", last_day="20240107")
    plan = explain_text(some)
    assert "PartitionFilters: [isnotnull(day" in plan or "PartitionFilters: [" in plan
    assert sorted(r.day for r in N.daily_totals(some).collect()) == ["20240105", "20240106", "20240107"]
    scan = explain_text(N.hourly_totals(t))
    assert "costtime" not in scan.split("ReadSchema:")[1].split("\n")[0]


def test_hot_minute_is_spread(spark):
    from pyspark.sql import functions as F
    hot = spark.range(20_000).select(F.lit("20240101").alias("day"), F.lit("202401010000").alias("minute"),
                                     F.col("id").cast("string").alias("request_id"))
    path = write_detail(hot, work_dir(spark, "test-hot-minute") + "/t", files=8)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 12_000
