"""Streaming: replay safety, stream total = batch total for any split, resume."""

import pytest
from pyspark.sql import functions as F

from chargepulse.plans import notify as N
from chargepulse.plans.catalog import QUERIES
from chargepulse.session import work_dir
from chargepulse.streaming import catalog as SC
from chargepulse.streaming.sinks import ChangelogUpsert, PerBatchWriter, read_batches, read_current

from conftest import SF001


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_changelog_replay_is_idempotent(spark):
    path = work_dir(spark, "test-changelog") + "/t"
    sink = ChangelogUpsert(path)
    b0 = spark.createDataFrame([("d1", 1), ("d2", 5)], "day string, total bigint")
    b1 = spark.createDataFrame([("d1", 3)], "day string, total bigint")
    sink(b0, 0)
    sink(b1, 1)
    sink(b1, 1)            # replay of batch 1
    sink(b0, 0)            # replay of an old batch does not win over batch 1
    assert rows(read_current(spark, path, ["day"])) == [("d1", 3), ("d2", 5)]


def test_per_batch_replay_overwrites_own_partition(spark):
    root = work_dir(spark, "test-perbatch")
    w = PerBatchWriter(root, {"n": lambda df: df.groupBy().count()})
    df = spark.range(7)
    w(df, 0)
    w(df, 0)
    w(spark.range(3), 1)
    got = rows(read_batches(spark, root, "n"))
    assert got == [(3, 1), (7, 0)]


@pytest.mark.parametrize("batches", [1, 3, 8])
def test_stream_equals_batch_for_any_split(spark, batches):
    q = SC._running(N.daily_totals, ["day"], SC.rlog, SC._clean_notify_stream, batches=batches)
    assert rows(q(spark, SF001)) == rows(QUERIES["daily_totals"](spark, SF001))


def test_resume_equals_batch(spark):
    assert rows(SC.q_stream_resume(spark, SF001)) == rows(QUERIES["daily_totals"](spark, SF001))


def test_rollup_properties(spark):
    """Σ minute = Σ hour = Σ day; failures + successes = orders; shared base = direct."""
    from chargepulse.plans.catalog import notify_clean
    clean = notify_clean(spark, SF001)
    tot = lambda df, c: df.agg(F.sum(c)).collect()[0][0]
    day = N.daily_totals(clean)
    assert tot(N.minute_orders(clean), "orders") == tot(N.hourly_totals(clean), "orders") \
        == tot(day, "total")
    assert tot(N.province_hour_failures(clean), "failures") + tot(day, "success") == tot(day, "total")
    rep = N.notify_report(clean)
    assert rows(rep["daily_totals"]) == rows(day)
    assert rows(rep["top10_province"]) == rows(N.top10_province(clean))
    assert rows(rep["province_hour_failures"]) == rows(N.province_hour_failures(clean))


def _running_query(spark, lines_by_file, kpi, keys, watermark=None, per_trigger=1):
    from chargepulse.operators.clean import clean_notify
    from chargepulse.plans.catalog import dim
    from chargepulse.sources.files import read_lines_stream
    from chargepulse.streaming.jobs import run_to_end, running_totals
    root = work_dir(spark, "test-running")
    for i, vals in enumerate(lines_by_file):
        spark.createDataFrame([(v,) for v in vals], "value string").coalesce(1) \
            .write.mode("overwrite").text(f"{root}/src/f{i}")
        stream = clean_notify(read_lines_stream(spark, f"{root}/src/*", per_trigger), dim(spark, SF001))
        schema = kpi(stream).schema
        run_to_end(running_totals(stream, kpi, f"{root}/out", f"{root}/ck", watermark=watermark), 600)
    return rows(read_current(spark, f"{root}/out", keys, schema))


def _msg(minute_digits, rid_tail="000000000000001"):
    import json
    t = minute_digits + "00000"
    return json.dumps({"serviceName": "reChargeNotifyReq", "interFacRst": "0000", "bussinessRst": "0000",
                       "provinceCode": "1", "chargefee": "1.00", "requestId": t + rid_tail,
                       "receiveNotifyTime": t})


def test_watermark_evicts_and_drops_late_rows(spark):
    early, late = "202401010000", "202401011000"
    files = [[_msg(early)], [_msg(late)], [_msg(early)]]    # the third arrives 10 h late
    no_wm = _running_query(spark, files, N.minute_orders, ["minute"])
    assert no_wm == [(early, 2), (late, 1)]                  # reference behaviour: late row still counts
    wm = _running_query(spark, files, N.minute_orders, ["minute"],
                        watermark=("minute", "yyyyMMddHHmm", "1 hour"))
    assert wm == [(early, 1), (late, 1)]


def test_per_batch_top10_of_one_batch_equals_batch_query(spark):
    from chargepulse.plans.catalog import notify_clean
    from chargepulse.sources.files import read_lines_stream, stage_lines
    from chargepulse.streaming.jobs import per_batch, run_to_end
    from chargepulse.operators.clean import clean_notify
    from chargepulse.plans.catalog import dim, rlog
    root = work_dir(spark, "test-top10")
    stage_lines(rlog(spark, SF001), f"{root}/src", files=1)
    stream = clean_notify(read_lines_stream(spark, f"{root}/src"), dim(spark, SF001))
    run_to_end(per_batch(stream, {"top10": N.top10_province}, f"{root}/out", f"{root}/ck"), 600)
    got = rows(read_batches(spark, f"{root}/out", "top10").drop("batch_id"))
    assert got == rows(N.top10_province(notify_clean(spark, SF001)))


def test_progress_ledger(spark):
    import json
    from chargepulse.sources.files import read_lines_stream, stage_lines
    from chargepulse.streaming.jobs import per_batch, progress_ledger, resume_positions, run_to_end
    from chargepulse.streaming.sinks import fold_positions
    root, n = work_dir(spark, "test-ledger"), 104
    stage_lines(spark.range(50 * n).selectExpr("cast(id AS string) AS value"), f"{root}/src", files=n)
    stream = read_lines_stream(spark, f"{root}/src", 1)
    run_to_end(per_batch(stream, {"rows": lambda b: b}, f"{root}/out", f"{root}/ck"), 1200)
    for fold in (None, 50, 50, 102):  # more batches than the checkpoint remembers; folding keeps every row
        if fold is not None:
            fold_positions(spark, f"{root}/out", fold)
        led = progress_ledger(spark, f"{root}/out")
        assert sorted(r.batch_id for r in led.collect()) == list(range(n))
    last = resume_positions(led).first()
    assert json.loads(last.end_offset)["logOffset"] == n - 1
    assert led.where("batch_id = 7").first().start_offset == led.where("batch_id = 6").first().end_offset


def test_watermark_key_must_be_a_key_of_the_kpi(spark):
    from chargepulse.plans import topup as T
    from chargepulse.plans.catalog import dim, rlog
    from chargepulse.operators.clean import clean_notify, clean_topup
    from chargepulse.sources.files import read_lines_stream, stage_lines
    from chargepulse.streaming.jobs import running_totals
    root = work_dir(spark, "test-watermark-guard")
    stage_lines(rlog(spark, SF001), f"{root}/src", files=1)
    stream = clean_notify(read_lines_stream(spark, f"{root}/src"), dim(spark, SF001))
    with pytest.raises(ValueError):
        running_totals(stream, N.hourly_totals, f"{root}/t", f"{root}/ck", watermark=("minute", "yyyyMMddHHmm", "1 hour"))
    with pytest.raises(ValueError):
        running_totals(clean_topup(read_lines_stream(spark, f"{root}/src")), T.phone_mean_monthly, f"{root}/t", f"{root}/ck",
                       watermark=("month", "yyyy-MM", "1 hour"))


def test_watermark_evicts_days_of_topup_money(spark):
    import json
    from chargepulse.operators.clean import clean_topup
    from chargepulse.plans import topup as T
    from chargepulse.sources.files import read_lines_stream, stage_lines
    from chargepulse.streaming.jobs import run_to_end, running_totals
    root = work_dir(spark, "test-evict")
    kept = None
    for i, day in enumerate(("2024-01-01", "2024-01-02", "2024-03-01", "2024-03-02")):
        line = json.dumps({"phoneNum": "1", "money": "5", "date": f"{day}T08:00:00.000Z"})
        stage_lines(spark.createDataFrame([(line,)], "value string"), f"{root}/src/{i}", files=1)
        q = running_totals(clean_topup(read_lines_stream(spark, f"{root}/src/*")), T.topup_daily_money, f"{root}/t",
                           f"{root}/ck", watermark=("day", "yyyy-MM-dd", "2 days"), state_partitions=1)
        run_to_end(q, 600)
        kept = q.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert kept == 2          # the January days left the state
    assert rows(read_current(spark, f"{root}/t", ["day"])) == [(d, 5) for d in (
        "2024-01-01", "2024-01-02", "2024-03-01", "2024-03-02")]


def test_output_folder_belongs_to_one_checkpoint(spark):
    from chargepulse.streaming.sinks import claim_output
    root = work_dir(spark, "test-claim")
    claim_output(spark, f"{root}/out", f"{root}/ck1")
    claim_output(spark, f"{root}/out", f"{root}/ck1")      # the same query restarting: fine
    with pytest.raises(ValueError):
        claim_output(spark, f"{root}/out", f"{root}/ck2")


def test_request_and_topup_reports_equal_direct_queries(spark):
    from chargepulse.plans import request as R, topup as T
    from chargepulse.plans.catalog import request_clean, topup_clean
    for name, df in R.request_report(request_clean(spark, SF001)).items():
        assert rows(df) == rows(QUERIES[name](spark, SF001)), name
    for name, df in T.topup_report(topup_clean(spark, SF001)).items():
        assert rows(df) == rows(QUERIES[name](spark, SF001)), name


def test_changelog_compaction(spark):
    from chargepulse.streaming.sinks import compact
    root = work_dir(spark, "test-changelog-compact")
    sink = ChangelogUpsert(f"{root}/log")
    sink(spark.createDataFrame([("d1", 1), ("d2", 5)], "day string, total bigint"), 0)
    sink(spark.createDataFrame([("d1", 4)], "day string, total bigint"), 1)
    snap = compact(spark, f"{root}/log", ["day"], f"{root}/snap")
    assert rows(snap) == [("d1", 4), ("d2", 5)] == rows(read_current(spark, f"{root}/log", ["day"]))
