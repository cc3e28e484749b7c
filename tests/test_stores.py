"""The bucketed phone store, detail tables sized by bytes, the ODS detail as a stream, fields that no schema names."""

import json
import os

import pytest
from pyspark.sql import functions as F

from chargepulse import storage
from chargepulse.functions.messages import field_census, message_variant, variant_field
from chargepulse.operators import clean as C
from chargepulse.plans import topup as T
from chargepulse.plans.catalog import QUERIES, dim, rlog, topup_clean
from chargepulse.plans.detail import by_bytes, read_detail, write_detail
from chargepulse.plans.phone_store import PhoneStore
from chargepulse.session import setting, work_dir
from chargepulse.sources.files import read_lines_stream, stage_lines
from chargepulse.streaming import apps as A
from chargepulse.streaming.jobs import run_to_end

from conftest import SF001
from tools import explain_text


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# ---- phone store ---------------------------------------------------------------------

@pytest.fixture(scope="module")
def store(spark):
    s = PhoneStore(spark, work_dir(spark, "test-phones"), buckets=4)
    s.put(T.topup_base(topup_clean(spark, SF001)))
    return s


def test_sums_of_the_store_need_no_exchange(spark, store):
    for kpi, key in ((T.month_phone_avg, "month_phone_avg"), (T.phone_mean_monthly, "phone_mean_monthly")):
        df = kpi(store.read())
        assert "Exchange" not in explain_text(df) and "Bucketed: true" in explain_text(df)
        assert rows(df) == rows(QUERIES[key](spark, SF001))


def test_putting_a_day_exchanges_the_day_only(spark, store):
    day = T.topup_base(topup_clean(spark, SF001)).where("day = '1995-06-15'")
    days = day.select(F.col("month").alias("_month"), F.col("day").alias("_day")).distinct()
    plan = explain_text(store._kept(days))
    stored_side = plan[plan.index("FileScan"):] if "FileScan" in plan else plan
    assert "PartitionFilters" in plan and "SortMergeJoin" not in plan and "hashpartitioning(phone" not in plan
    assert stored_side


def test_a_day_that_is_put_again_replaces_itself(spark):
    s = PhoneStore(spark, work_dir(spark, "test-phones-again"), buckets=3)
    sums = "month string, day string, phone string, orders bigint, money bigint"
    first = spark.createDataFrame([("2024-01", "2024-01-01", "1", 2, 10), ("2024-01", "2024-01-02", "1", 1, 5),
                                   ("2024-02", "2024-02-01", "2", 1, 7)], sums)
    s.put(first)
    s.put(first)
    s.put(spark.createDataFrame([("2024-01", "2024-01-02", "1", 3, 30), ("2024-01", "2024-01-02", "3", 1, 1)], sums))
    want = [("1", "2024-01-01", 2, 10, "2024-01"), ("1", "2024-01-02", 3, 30, "2024-01"), ("2", "2024-02-01", 1, 7, "2024-02"),
            ("3", "2024-01-02", 1, 1, "2024-01")]
    assert rows(s.read()) == want
    again = PhoneStore(spark, s.path, buckets=99)          # its files say how many buckets there are
    assert again.buckets == 3 and rows(again.read()) == want


def test_an_empty_store(spark):
    s = PhoneStore(spark, work_dir(spark, "test-phones-empty"), buckets=2)
    assert T.phone_mean_monthly(s.read()).count() == 0


# ---- detail by bytes -----------------------------------------------------------------

def _files(path):
    return {d.split("=")[1]: len([f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")])
            for d in os.listdir(path) if d.startswith("day=")}


def test_a_hot_day_is_written_by_tasks_in_proportion_to_its_bytes(spark):
    ids = spark.range(0, 60_000, 1, 24)
    clean = ids.select(F.when(F.col("id") % 4 < 3, "20240101").otherwise(F.concat(F.lit("202402"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0")))
                       .alias("day"), F.sha2(F.col("id").cast("string"), 256).alias("request_id"))
    found = {}
    for size in ("100k", "400k"):
        with setting(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": size}):
            path = write_detail(clean, work_dir(spark, "test-hot-bytes") + "/t")
        found[size] = _files(path)
        assert read_detail(spark, path).count() == 60_000
        # A small day has a twentieth of the hot one's rows.
        assert found[size]["20240101"] >= 4 * max(n for d, n in found[size].items() if d != "20240101")
    # 45,000 rows of the hot day take about 3 MB
    assert found["100k"]["20240101"] >= 12 and found["400k"]["20240101"] >= 4
    assert found["100k"]["20240101"] >= 2 * found["400k"]["20240101"]


# ---- ODS as a stream -----------------------------------------------------------------

def test_ods_stream_equals_batch_and_replays(spark):
    root = work_dir(spark, "test-ods")
    stage_lines(rlog(spark, SF001), f"{root}/src/a", files=3)
    run = lambda: run_to_end(A.ods_app(read_lines_stream(spark, f"{root}/src/*", 1), dim(spark, SF001), f"{root}/out",
                                       f"{root}/ck", trigger=None), 300)
    run()
    want = rows(QUERIES["ods_detail"](spark, SF001))
    got = lambda: rows(A.read_ods(spark, f"{root}/out").drop("batch_id").select(QUERIES["ods_detail"](spark, SF001).columns))
    assert got() == want and A.read_ods(spark, f"{root}/out").select("batch_id").distinct().count() == 3
    for name in ("2", ".2.crc"):
        storage.delete(spark, f"{root}/ck/commits/{name}")
    run()                                                   # the last batch runs again
    assert got() == want
    some = A.read_ods(spark, f"{root}/out", "20240105", "20240106")
    assert {r.date for r in some.collect()} <= {"20240105", "20240106"} and "PartitionFilters: [" in explain_text(some)


def test_ods_stream_splits_a_hot_date(spark):
    root = work_dir(spark, "test-ods-hot")
    line = json.dumps({"serviceName": "reChargeNotifyReq", "interFacRst": "0000", "bussinessRst": "0000", "provinceCode": "1", "chargefee": "1"})
    lines = spark.range(0, 20_000, 1, 16).select(F.concat(F.lit(line[:-1]), F.lit(', "requestId": "20240101000000000'), F.sha2(F.col("id").cast("string"), 256),
                                                      F.lit('", "receiveNotifyTime": "20240101000000000"}')).alias("value"))
    lines.write.text(f"{root}/src/a")
    with setting(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k"}):
        run_to_end(A.ods_app(read_lines_stream(spark, f"{root}/src/*"), dim(spark, SF001), f"{root}/out", f"{root}/ck", trigger=None), 300)
    at = f"{root}/out/detail/date=20240101/batch_id=0"
    assert len([f for f in os.listdir(at) if f.endswith(".parquet")]) >= 4
    assert A.read_ods(spark, f"{root}/out").count() == 20_000


# ---- fields that no schema names -----------------------------------------------------

def test_variant_fields(spark):
    msgs = ['{"a": "1.50", "b": {"c": [1, 2]}, "odd \\" name.x": 7}', '{"a": 2}', "no json", "[1]", None, "", '{"a": "x"}', '{}']
    log = spark.createDataFrame([(m,) for m in msgs], "value string").withColumn("m", message_variant())
    got = [tuple(r) for r in log.select(variant_field("m", "a", "decimal(18,2)").cast("string"), variant_field("m", "b"),
                                        variant_field("m", 'odd " name.x', "int"), variant_field("m", "none")).collect()]
    assert got[0] == ("1.50", '{"c":[1,2]}', 7, None) and got[1] == ("2.00", None, None, None)
    assert got[2:] == [(None,) * 4] * 6
    census = rows(field_census(log))
    assert ("a", "STRING", 2) in census and len(census) == 4 and {r[0] for r in census} == {"a", "b", 'odd " name.x'}


def test_detail_keeps_the_message(spark):
    log = rlog(spark, SF001).withColumn("message", message_variant())
    path = write_detail(C.good(C.notify_rows(log, dim(spark, SF001), carry=("message",))), work_dir(spark, "test-variant") + "/t")
    kept = read_detail(spark, path)
    assert dict(kept.dtypes)["message"] == "variant"
    assert kept.where(variant_field("message", "provinceCode") != F.col("province_code")).count() == 0


def test_by_bytes_is_a_rebalance(spark):
    assert "REBALANCE" in explain_text(by_bytes(spark.range(5).select(F.lit("d").alias("day"))))
