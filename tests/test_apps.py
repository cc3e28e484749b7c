"""The three streaming apps: every KPI equals its batch query; per-batch rows add up."""

import json

import pytest
from pyspark.sql import functions as F

from chargepulse.plans.catalog import QUERIES, dim, rlog, tlog
from chargepulse.session import work_dir
from chargepulse.sources.files import read_lines_stream, stage_lines
from chargepulse.streaming import apps as A
from chargepulse.streaming.jobs import run_to_end

from conftest import SF001


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def _run(spark, start, log, with_dim=True, extra=()):
    root = work_dir(spark, "test-app")
    stage_lines(log(spark, SF001), f"{root}/src/a", files=4)
    if extra:
        spark.createDataFrame([(v,) for v in extra], "value string").coalesce(1) \
            .write.text(f"{root}/src/b")
    stream = read_lines_stream(spark, f"{root}/src/*", 2)
    args = (stream, dim(spark, SF001)) if with_dim else (stream,)
    run_to_end(start(*args, f"{root}/out", f"{root}/ck", trigger=None), 600)
    return f"{root}/out"


@pytest.fixture(scope="module")
def notify_out(spark):
    bad = ["not json", json.dumps({"serviceName": "reChargeNotifyReq", "interFacRst": "0000",
                                   "bussinessRst": "0000", "provinceCode": "99", "chargefee": "1",
                                   "requestId": "20240101000000000", "receiveNotifyTime": "20240101000000000"})]
    return _run(spark, A.notify_app, rlog, extra=bad)


def test_notify_app_equals_batch(spark, notify_out):
    res = A.notify_results(spark, notify_out)
    for k in ("daily_totals", "minute_orders", "province_hour_failures", "top10_province",
              "hourly_totals"):
        assert rows(res[k]) == rows(QUERIES[k](spark, SF001)), k


def test_notify_app_per_batch_adds_up(spark, notify_out):
    res = A.notify_results(spark, notify_out)
    b = res["batch_hourly_totals"].groupBy("hour").agg(
        F.sum("orders").cast("bigint").alias("orders"), F.sum("money").cast("decimal(18,2)").alias("money"))
    assert rows(b) == rows(QUERIES["hourly_totals"](spark, SF001))
    assert res["batch_hourly_totals"].select("batch_id").distinct().count() >= 2
    top = res["batch_top10_province"]
    assert top.groupBy("batch_id").count().where("count > 10").count() == 0


def test_notify_app_quarantine(spark, notify_out):
    q = spark.read.parquet(f"{notify_out}/quarantine")
    assert sorted(r.reason for r in q.collect()) == ["bad_json", "unknown_province"]


def test_request_app_equals_batch(spark):
    out = _run(spark, A.request_app, rlog)
    res = A.request_results(spark, out)
    for k in ("top3_failure_province", "province_minute", "province_hour"):
        assert rows(res[k]) == rows(QUERIES[k](spark, SF001)), k
    b = res["batch_province_hour"].groupBy("hour", "province").agg(
        F.sum("orders").cast("bigint").alias("orders"), F.sum("money").cast("decimal(18,2)").alias("money"))
    assert rows(b) == rows(QUERIES["province_hour"](spark, SF001))
    assert res["batch_top3_failure_province"].groupBy("batch_id").count().where("count > 3").count() == 0


def test_topup_app_equals_batch(spark):
    out = _run(spark, A.topup_app, tlog, with_dim=False)
    res = A.topup_results(spark, out)
    for k in ("topup_daily_money", "month_phone_avg", "phone_mean_monthly"):
        assert rows(res[k]) == rows(QUERIES[k](spark, SF001)), k


def test_app_batch_replay_is_idempotent(spark):
    root = work_dir(spark, "test-app-replay")
    body = A._AppBatch(root, lambda b: A.C.notify_rows(b, dim(spark, SF001)), A.notify_partials)
    batch = rlog(spark, SF001)
    body(batch, 0)
    body(batch, 0)
    res = A.notify_results(spark, root)
    assert rows(res["daily_totals"]) == rows(QUERIES["daily_totals"](spark, SF001))


def test_compaction_keeps_results(spark):
    out = _run(spark, A.topup_app, tlog, with_dim=False)
    before = {k: rows(v) for k, v in A.topup_results(spark, out).items()}
    assert A.compact(spark, out, 0) == 0
    assert A.compact(spark, out, 1) == 1
    assert A.compact(spark, out, 1) == 1          # idempotent
    after = {k: rows(v) for k, v in A.topup_results(spark, out).items()}
    assert after == before
    assert A.storage.children(spark, f"{out}/folded/_done") == ["0", "1"]
    assert not [n for n in A.storage.children(spark, f"{out}/partials") if n in ("batch_id=0", "batch_id=1")]


def test_compaction_keeps_per_batch_rows(spark, notify_out):
    names = ("batch_hourly_totals", "batch_top10_province", "batch_province_hour_failures", "daily_totals")
    before = {k: rows(A.notify_results(spark, notify_out)[k]) for k in names}
    last = max(r[0] for r in before["batch_hourly_totals"])
    for upto in (0, last):
        A.compact(spark, notify_out, upto)
        assert {k: rows(A.notify_results(spark, notify_out)[k]) for k in names} == before


def test_unpublished_compaction_does_not_count(spark):
    out = _run(spark, A.topup_app, tlog, with_dim=False)
    before = {k: rows(v) for k, v in A.topup_results(spark, out).items()}
    A.read_partials(spark, out).limit(3).write.parquet(f"{out}/folded/upto=0/totals")   # died before its marker
    assert {k: rows(v) for k, v in A.topup_results(spark, out).items()} == before
    assert A.compact(spark, out, 0) == 0
    assert {k: rows(v) for k, v in A.topup_results(spark, out).items()} == before


def test_app_of_bad_batches_only_has_empty_results(spark):
    root = work_dir(spark, "test-all-bad")
    spark.createDataFrame([("no json",)], "value string").coalesce(1).write.text(f"{root}/src/a")
    q = A.notify_app(read_lines_stream(spark, f"{root}/src/*"), dim(spark, SF001), f"{root}/out", f"{root}/ck", trigger=None)
    run_to_end(q, 300)
    assert A.compact(spark, f"{root}/out", 0) == 0
    assert all(df.count() == 0 for df in A.notify_results(spark, f"{root}/out").values())


def test_poison_amounts_leave_the_other_rows_right(spark):
    root = work_dir(spark, "test-poison")
    msgs = [{"phoneNum": "1", "money": m, "date": "2024-01-01T00:00:00.000Z"}
            for m in (str(2 ** 63 - 1), str(2 ** 63 - 1), "99999999999999999999", "5", 7.9, "")]
    spark.createDataFrame([(json.dumps(m),) for m in msgs], "value string").coalesce(1).write.text(f"{root}/src/a")
    run_to_end(A.topup_app(read_lines_stream(spark, f"{root}/src/*"), f"{root}/out", f"{root}/ck", trigger=None), 300)
    assert rows(A.topup_results(spark, f"{root}/out")["topup_daily_money"]) == [("2024-01-01", 12)]
    bad = spark.read.parquet(f"{root}/out/quarantine")
    assert [r.reason for r in bad.collect()] == ["bad_amount"] * 3


def test_processing_time_trigger_picks_up_new_files(spark):
    root = work_dir(spark, "test-app-trigger")
    lines = rlog(spark, SF001)
    stage_lines(lines.where(F.col("value").contains('"provinceCode":"1"')), f"{root}/src/a", files=1)
    stream = read_lines_stream(spark, f"{root}/src/*", 1)
    q = A.notify_app(stream, dim(spark, SF001), f"{root}/out", f"{root}/ck", trigger="1 second")
    try:
        q.processAllAvailable()
        stage_lines(lines.where(~F.col("value").contains('"provinceCode":"1"')), f"{root}/src/b", files=1)
        q.processAllAvailable()
    finally:
        q.stop()
    res = A.notify_results(spark, f"{root}/out")
    assert rows(res["daily_totals"]) == rows(QUERIES["daily_totals"](spark, SF001))


def test_strict_app_fails_on_a_bad_message(spark):
    root = work_dir(spark, "test-app-strict")
    spark.createDataFrame([("not json",)], "value string").coalesce(1).write.text(f"{root}/src/a")
    q = A.topup_app(read_lines_stream(spark, f"{root}/src/*", 1), f"{root}/out", f"{root}/ck",
                    trigger=None, mode="strict")
    with pytest.raises(Exception):
        run_to_end(q, 300)
