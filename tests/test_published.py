"""What counts of a stream: commit-bound compaction, one moment per batch, clean stop, ledger, snapshots, late rows, re-drive."""

import json
import os
import threading
import time
import tracemalloc

import pytest
from pyspark.sql import functions as F

from chargepulse import cli, storage
from chargepulse.plans import notify as N
from chargepulse.plans.catalog import QUERIES, dim, notify_clean, rlog, tlog
from chargepulse.session import work_dir
from chargepulse.sources.files import read_lines_stream, stage_lines
from chargepulse.streaming import apps as A, published as P, sinks as S
from chargepulse.streaming.control import ask_to_stop, run_until_stopped, stop_cleanly
from chargepulse.streaming.jobs import late_rows, progress_ledger, read_totals, run_to_end, running_totals, watermarked_totals

from conftest import SF001
from tools import explain_text


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def _topup(spark, root, trigger=None, files=None):
    return A.topup_app(read_lines_stream(spark, f"{root}/src/*", files), f"{root}/out", f"{root}/ck", trigger=trigger)


def _part(spark, root, k, of=3):
    lines = tlog(spark, SF001).where(F.pmod(F.xxhash64("value"), F.lit(of)) == k)
    stage_lines(lines, f"{root}/src/part{k}", files=1)


def _money(spark, root):
    return rows(A.topup_results(spark, f"{root}/out")["topup_daily_money"])


# ---- compaction ----------------------------------------------------------------------

def test_compaction_never_folds_batches_to_come(spark):
    root = work_dir(spark, "test-fold-bound")
    for k in range(3):
        _part(spark, root, k)
        run_to_end(_topup(spark, root), 300)
        assert A.compact(spark, f"{root}/out", upto=50 + k) == k      # far beyond what exists
    assert _money(spark, root) == rows(QUERIES["topup_daily_money"](spark, SF001))
    assert A.compact(spark, f"{root}/out") == 2


def test_compaction_follows_the_commit_log(spark):
    root = work_dir(spark, "test-fold-commit")
    for k in range(2):
        _part(spark, root, k)
        run_to_end(_topup(spark, root), 300)
    before = _money(spark, root)
    storage.delete(spark, f"{root}/ck/commits/1")                     # written, but not committed: it may run again
    storage.delete(spark, f"{root}/ck/commits/.1.crc")
    assert P.newest_commit(spark, f"{root}/ck") == 0 and A.compact(spark, f"{root}/out", 1) == 0
    assert _money(spark, root) == before
    run_to_end(_topup(spark, root), 300)                              # Spark runs batch 1 again
    assert _money(spark, root) == before and A.compact(spark, f"{root}/out") == 1 and _money(spark, root) == before


def test_results_built_before_a_compaction_still_run(spark):
    root = work_dir(spark, "test-fold-readers")
    _part(spark, root, 0)
    run_to_end(_topup(spark, root), 300)
    lazy = A.topup_results(spark, f"{root}/out")["topup_daily_money"]
    want = _money(spark, root)
    A.compact(spark, f"{root}/out")
    assert rows(lazy) == want == _money(spark, root)


def test_an_app_without_a_batch_has_empty_results(spark):
    root = work_dir(spark, "test-no-batch")
    os.makedirs(f"{root}/src/a")
    run_to_end(_topup(spark, root), 300)
    assert all(df.count() == 0 for df in A.topup_results(spark, f"{root}/out").values())
    assert A.read_quarantine(spark, f"{root}/out").count() == 0 and A.compact(spark, f"{root}/out") == -1


# ---- one visible moment --------------------------------------------------------------

@pytest.mark.parametrize("dies_at", ["quarantine", "positions", "marker"])
def test_a_batch_that_dies_between_its_writes_is_not_seen(spark, monkeypatch, dies_at):
    root = work_dir(spark, f"test-moment-{dies_at}")
    _part(spark, root, 0)
    stage_lines(spark.createDataFrame([("no json",)], "value string"), f"{root}/src/bad0", files=1)
    run_to_end(_topup(spark, root), 300)
    before, ledger = _money(spark, root), progress_ledger(spark, f"{root}/out").count()

    def fail(*a):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        if dies_at == "quarantine":
            write = A._overwrite_batch
            m.setattr(A, "_overwrite_batch", lambda df, path, b: fail() if path.endswith("quarantine") else write(df, path, b))
        elif dies_at == "positions":
            m.setattr(S, "record_positions", fail)
        else:
            m.setattr(S, "publish", fail)
        _part(spark, root, 1)
        stage_lines(spark.createDataFrame([("no json either",)], "value string"), f"{root}/src/bad1", files=1)
        with pytest.raises(Exception):
            run_to_end(_topup(spark, root), 300)
    assert "batch_id=1" in storage.children(spark, f"{root}/out/partials")     # some of it is there
    assert _money(spark, root) == before and progress_ledger(spark, f"{root}/out").count() == ledger
    assert A.read_quarantine(spark, f"{root}/out").count() == 1
    run_to_end(_topup(spark, root), 300)
    assert len(_money(spark, root)) >= len(before) and _money(spark, root) != before
    assert A.read_quarantine(spark, f"{root}/out").count() == 2


# ---- clean stop ----------------------------------------------------------------------

def _slow(spark, root, seconds=1.5):
    """The top-up app with slow batches, one file each."""
    body = A._AppBatch(f"{root}/out", A.C.topup_rows, A.topup_partials)
    work = body.partials

    def partials(clean):
        time.sleep(seconds)
        return work(clean)
    body.partials = partials
    return A._start(read_lines_stream(spark, f"{root}/src/*", 1), body, f"{root}/ck", "200 milliseconds")


def test_stop_marker_lets_the_running_batch_finish(spark):
    root = work_dir(spark, "test-stop")
    stage_lines(tlog(spark, SF001), f"{root}/src/a", files=6)
    q = _slow(spark, root)
    threading.Timer(4.0, lambda: ask_to_stop(spark, f"{root}/out")).start()
    assert run_until_stopped(spark, q, f"{root}/out") == "stopped" and not q.isActive
    done = P.newest_commit(spark, f"{root}/ck")
    assert 0 <= done < 5 and P.newest_published(spark, f"{root}/out") == done       # nothing half-way
    assert storage.children(spark, f"{root}/out/partials")[-1] == f"batch_id={done}"
    assert not storage.exists(spark, f"{root}/out/_stop")
    run_to_end(_topup(spark, root, files=1), 300)                                     # the rest, after a restart
    assert _money(spark, root) == rows(QUERIES["topup_daily_money"](spark, SF001))
    assert sorted(r.batch_id for r in progress_ledger(spark, f"{root}/out").collect()) == list(range(6))


def test_stop_between_batches_and_end_without_a_marker(spark):
    root = work_dir(spark, "test-stop-idle")
    _part(spark, root, 0)
    q = _topup(spark, root, trigger="100 milliseconds")
    q.processAllAvailable()
    stop_cleanly(spark, q, f"{root}/out")
    assert not q.isActive and P.newest_commit(spark, f"{root}/ck") == 0
    _part(spark, root, 1)
    q = _topup(spark, root)
    assert run_until_stopped(spark, q, f"{root}/out") == "ended"
    assert P.newest_commit(spark, f"{root}/ck") == 1


def test_cli_stop(spark):
    root = work_dir(spark, "test-stop-cli")
    _part(spark, root, 0)
    threading.Timer(6.0, lambda: cli.main(["stop", "--out", f"{root}/out"], spark=spark)).start()
    q = cli.main(["app", "topup", "--source", f"files:{root}/src/*", "--out", f"{root}/out", "--checkpoint", f"{root}/ck",
                  "--trigger", "1 second"], spark=spark)
    assert not q.isActive and P.newest_commit(spark, f"{root}/ck") == P.newest_published(spark, f"{root}/out") == 0


def test_a_failed_query_is_not_a_stop(spark):
    root = work_dir(spark, "test-stop-fail")
    stage_lines(spark.createDataFrame([("no json",)], "value string"), f"{root}/src/a", files=1)
    q = A.topup_app(read_lines_stream(spark, f"{root}/src/*"), f"{root}/out", f"{root}/ck", trigger="100 milliseconds", mode="strict")
    with pytest.raises(Exception, match="bad message"):
        run_until_stopped(spark, q, f"{root}/out")


# ---- ledger --------------------------------------------------------------------------

def test_ledger_of_many_batches_folds_in_spark(spark):
    root, n = work_dir(spark, "test-ledger-many"), 5_000
    for k in range(n // S.RANGE):
        os.makedirs(f"{root}/_positions/range={k}")
        for b in range(k * S.RANGE, (k + 1) * S.RANGE):
            with open(f"{root}/_positions/range={k}/{b}.json", "w") as f:
                f.write(json.dumps({"batch_id": b, "source": 0, "start_offset": str(b), "end_offset": str(b + 1)}) + "\n")
    tracemalloc.start()
    S.fold_positions(spark, root, n - 2)          # the last range is not whole
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 2_000_000
    assert storage.children(spark, f"{root}/_positions") == [f"range={n // S.RANGE - 1}"]
    led = S.read_positions(spark, root)
    assert led.agg(F.count("*"), F.count_distinct("batch_id"), F.min("batch_id"), F.max("batch_id")).first() == (n, n, 0, n - 1)


def test_a_ledger_fold_that_dies_loses_and_repeats_nothing(spark, monkeypatch):
    root = work_dir(spark, "test-ledger-dies")
    monkeypatch.setattr(S, "RANGE", 10)
    for b in range(35):
        storage.write_text(spark, f"{root}/_positions/range={b // 10}/{b}.json", json.dumps({"batch_id": b, "source": 0}) + "\n")
    want = list(range(35))
    ids = lambda: sorted(r.batch_id for r in S.read_positions(spark, root).collect())
    for name in ("write_text", "delete"):         # before its marker, then after it
        with monkeypatch.context() as m:
            m.setattr(S.storage, name, lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError):
                S.fold_positions(spark, root, 34)
        assert ids() == want
    S.fold_positions(spark, root, 34)
    assert ids() == want and storage.children(spark, f"{root}/_positions") == ["range=3"]


# ---- snapshots -----------------------------------------------------------------------

def test_snapshot_reads_no_folded_batch(spark):
    path = work_dir(spark, "test-snapshot") + "/log"
    sink = S.ChangelogUpsert(path)
    for b in range(6):
        sink(spark.createDataFrame([("d", b), (f"d{b}", b)], "day string, total bigint"), b)
    want = [("d", 5), *((f"d{b}", b) for b in range(6))]
    assert S.snapshot(spark, path, ["day"], 2) == 2 and rows(S.read_current(spark, path, ["day"])) == want
    assert S.snapshot(spark, path, ["day"], 4) == 4
    cur = S.read_current(spark, path, ["day"])
    assert rows(cur) == want
    read = {r[0] for r in S._changes(spark, path).select(F.input_file_name()).distinct().collect()}
    assert read and all("upto=4" in f or "batch_id=5" in f for f in read)
    plan = explain_text(cur)
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert not any(n in storage.children(spark, path) for n in ("batch_id=0", "batch_id=1", "batch_id=2"))
    sink(spark.createDataFrame([("d", 9)], "day string, total bigint"), 6)
    assert rows(S.read_current(spark, path, ["day"]))[0] == ("d", 9)
    S.snapshot(spark, path, ["day"], 6)
    S.snapshot(spark, path, ["day"], 6)           # nothing to fold: what is folded goes
    assert not [n for n in storage.children(spark, path) if n.startswith("batch_id")]
    assert rows(S.read_current(spark, path, ["day"]))[0] == ("d", 9)


def test_snapshot_of_text_values_and_of_an_unfinished_one(spark):
    path = work_dir(spark, "test-snapshot-text") + "/log"
    sink = S.ChangelogUpsert(path)
    sink(spark.createDataFrame([("a", "x", None), ("b", "y", 1)], "k string, t string, n int"), 0)
    sink(spark.createDataFrame([("b", None, 2)], "k string, t string, n int"), 1)
    want = [("a", "x", None), ("b", None, 2)]
    got = lambda: sorted((tuple(r) for r in S.read_current(spark, path, ["k"]).collect()), key=str)
    assert got() == want
    spark.createDataFrame([("z", "z", 0, 1)], "k string, t string, n int, batch_id bigint").write.parquet(f"{path}/_snapshot/upto=1")
    assert got() == want                          # died before its marker
    S.snapshot(spark, path, ["k"], 1)
    assert got() == want


def test_snapshot_is_bound_by_the_commit_log(spark):
    root = work_dir(spark, "test-snapshot-bound")
    stage_lines(rlog(spark, SF001), f"{root}/src/a", files=1)
    from chargepulse.operators.clean import clean_notify
    stream = clean_notify(read_lines_stream(spark, f"{root}/src/*"), dim(spark, SF001))
    run_to_end(running_totals(stream, N.daily_totals, f"{root}/t", f"{root}/ck", state_partitions=2), 300)
    assert S.snapshot(spark, f"{root}/t", ["day"], 99) == 0
    assert rows(S.read_current(spark, f"{root}/t", ["day"])) == rows(QUERIES["daily_totals"](spark, SF001))


# ---- late rows -----------------------------------------------------------------------

def _line(minute, rid="1"):
    t = minute + "00000"
    return json.dumps({"serviceName": "reChargeNotifyReq", "interFacRst": "0000", "bussinessRst": "0000", "provinceCode": "1",
                       "chargefee": "1.00", "requestId": t + rid, "receiveNotifyTime": t})


def test_totals_and_late_rows_are_all_rows(spark):
    from chargepulse.operators.clean import clean_notify
    root = work_dir(spark, "test-late")
    early, later, edge = "202401010000", "202401011000", "202401010900"
    for i, minutes in enumerate(([early, early], [later], [early, edge, later], [early])):
        stage_lines(spark.createDataFrame([(_line(m, f"{i}{j}"),) for j, m in enumerate(minutes)], "value string"), f"{root}/src/{i}", files=1)
        stream = clean_notify(read_lines_stream(spark, f"{root}/src/*"), dim(spark, SF001))
        run_to_end(watermarked_totals(stream, N.minute_orders, f"{root}/out", f"{root}/ck", ("minute", "yyyyMMddHHmm", "1 hour")), 300)
    assert rows(read_totals(spark, f"{root}/out", ["minute"])) == [(early, 2), (later, 2)]
    late = late_rows(spark, f"{root}/out")
    assert sorted((r.minute, r.batch_id) for r in late.collect()) == [(early, 2), (early, 3), (edge, 2)]    # a bucket at the mark is late
    assert "money" in late.columns and "request_id" in late.columns


# ---- re-drive ------------------------------------------------------------------------

def _unknown(code, n, minute="202401010001"):
    return [json.dumps(json.loads(_line(minute, f"{code}{i}")) | {"provinceCode": code}) for i in range(n)]


def _notify(spark, root, lines, k):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{root}/src/{k}")
    run_to_end(A.notify_app(read_lines_stream(spark, f"{root}/src/*"), dim(spark, SF001), f"{root}/out", f"{root}/ck", trigger=None), 300)


def test_redrive_adds_each_message_once(spark, monkeypatch):
    root = work_dir(spark, "test-redrive")
    _notify(spark, root, [*_unknown("77", 3), *_unknown("88", 2), _line("202401010001"), "no json"], 0)
    grown = dim(spark, SF001).unionByName(spark.createDataFrame([("77", "NEW")], "province_code string, province string"))
    total = lambda: sum(r.orders for r in A.notify_results(spark, f"{root}/out")["minute_orders"].collect())
    left = lambda: sorted(r.reason for r in A.read_quarantine(spark, f"{root}/out").collect())
    assert total() == 1 and A.redrive_notify(spark, f"{root}/out", dim(spark, SF001)) == 0
    with monkeypatch.context() as m:              # a run that dies before its marker does not count
        m.setattr(A.storage, "write_text", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            A.redrive_notify(spark, f"{root}/out", grown)
    assert total() == 1 and len(left()) == 6
    assert A.redrive_notify(spark, f"{root}/out", grown) == 3 and A.redrive_notify(spark, f"{root}/out", grown) == 0
    assert total() == 4 and left() == ["bad_json", "unknown_province", "unknown_province"]
    _notify(spark, root, _unknown("77", 1), 1)    # the running app still has the old dimension
    assert total() == 4 and A.redrive_notify(spark, f"{root}/out", grown) == 1 and total() == 5
    A.compact(spark, f"{root}/out")
    A.compact(spark, f"{root}/out")
    per_batch = {r.batch_id: r.orders for r in A.notify_results(spark, f"{root}/out")["batch_hourly_totals"].collect()}
    assert total() == 5 and per_batch == {0: 4, 1: 1}
    names = {r.province for r in A.notify_results(spark, f"{root}/out")["top10_province"].collect()}
    assert "NEW" in names


def test_redrive_of_requests(spark):
    root = work_dir(spark, "test-redrive-request")
    lines = [json.dumps({"serviceName": "sendRechargeReq", "interFacRst": "0000", "bussinessRst": "0000", "provinceCode": "77", "chargefee": "2",
                         "shouldfee": "2", "startReqTime": "20240101000100000", "endReqTime": "20240101000100000"})] * 2
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{root}/src/a")
    run_to_end(A.request_app(read_lines_stream(spark, f"{root}/src/*"), dim(spark, SF001), f"{root}/out", f"{root}/ck", trigger=None), 300)
    grown = dim(spark, SF001).unionByName(spark.createDataFrame([("77", "NEW")], "province_code string, province string"))
    assert [A.redrive_request(spark, f"{root}/out", grown) for _ in range(2)] == [2, 0]
    assert [(r.province, r.orders) for r in A.request_results(spark, f"{root}/out")["province_hour"].collect()] == [("NEW", 2)]
    assert A.read_quarantine(spark, f"{root}/out").count() == 0


def test_late_query_has_late_rows(spark):
    from chargepulse.streaming.catalog import q_stream_late_rows
    got = q_stream_late_rows(spark, SF001).agg(F.sum("total"), F.sum("late")).first()
    assert got[1] > 0 and got[0] + got[1] == notify_clean(spark, SF001).count()
