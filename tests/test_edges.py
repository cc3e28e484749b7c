"""Edge rows (FIXTURES.md §4): quarantine reasons, gates, negative times, ties."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql.utils import AnalysisException  # noqa: F401

from chargepulse.operators import clean as C
from chargepulse.plans import notify as N, request as R
from chargepulse.sources.dimension import province_dim


def notify(**kw):
    m = {"serviceName": "reChargeNotifyReq", "interFacRst": "0000", "bussinessRst": "0000",
         "provinceCode": "1", "chargefee": "10.50", "requestId": "20240101000352824000000000000001",
         "receiveNotifyTime": "20240101000353824"}
    m.update(kw)
    return json.dumps({k: v for k, v in m.items() if v is not None})


def request(**kw):
    m = {"serviceName": "sendRechargeReq", "interFacRst": "0000", "bussinessRst": "0000",
         "provinceCode": "1", "chargefee": "5.00", "shouldfee": "5.00",
         "startReqTime": "20240101000352824", "endReqTime": "20240101000353824"}
    m.update(kw)
    return json.dumps(m)


def lines(spark, *vals):
    return spark.createDataFrame([(v,) for v in vals], "value string")


@pytest.fixture(scope="module")
def dim(spark):
    return province_dim(lines(spark, "1 Beijing", "2 Shanghai", "3 Tianjin", "1 Zzz", "", "4"))


def reasons(df):
    return sorted((r.reason for r in C.quarantined(df).collect()))


def test_dimension_unique_and_lenient(spark, dim):
    assert sorted(tuple(r) for r in dim.collect()) == [
        ("1", "Beijing"), ("2", "Shanghai"), ("3", "Tianjin")]


def test_bad_json_and_missing_service(spark, dim):
    log = lines(spark, "not json", "[1]", None, "{}", notify())
    rows = C.notify_rows(log, dim)
    assert reasons(rows) == ["bad_json", "bad_json", "bad_json", "missing_service"]
    assert C.good(rows).count() == 1


def test_case_insensitive_name_passes(spark, dim):
    log = lines(spark, notify(serviceName="RECHARGENOTIFYREQ"),
                request(serviceName="SENDRECHARGEREQ"))
    assert C.clean_notify(log, dim).count() == 1
    assert C.clean_request(log, dim).count() == 1
    assert C.ods_detail(log, dim).count() == 0   # the ODS gate is case-sensitive


def test_business_failure_interface_vs_business_gate(spark, dim):
    log = lines(spark, notify(bussinessRst="1001"))
    row = C.clean_notify(log, dim, gate="interface").collect()
    assert len(row) == 1 and row[0].success == 0 and float(row[0].money) == 0.0
    assert row[0].costtime == 1000
    assert C.clean_notify(log, dim, gate="business").count() == 0


def test_unknown_province_bad_amount_bad_time(spark, dim):
    log = lines(spark, notify(provinceCode="99"), notify(chargefee="abc"),
                notify(requestId="2024010100"), notify(requestId="20241301000352824"))
    assert reasons(C.notify_rows(log, dim)) == ["bad_amount", "bad_time", "bad_time",
                                                "unknown_province"]


def test_strict_mode_raises(spark, dim):
    log = lines(spark, notify(provinceCode="99"))
    with pytest.raises(PySparkException):
        C.clean_notify(log, dim, mode="strict").collect()


def test_negative_elapsed_kept(spark, dim):
    log = lines(spark, notify(receiveNotifyTime="20240101000351824"))
    assert C.clean_notify(log, dim).collect()[0].costtime == -1000


def test_32_digit_request_id(spark, dim):
    log = lines(spark, notify(requestId="20230512040013393000000000000077",
                              receiveNotifyTime="20230512040014393"))
    r = C.clean_notify(log, dim).collect()[0]
    assert (r.day, r.hour, r.minute, r.costtime) == ("20230512", "2023051204", "202305120400", 1000)


def test_topup_missing_money_is_zero(spark):
    log = lines(spark, json.dumps({"phoneNum": "1", "date": "2024-03-05T08:01:00.000Z"}),
                json.dumps({"phoneNum": "1", "money": 7, "date": "2024-03-05T08:01:00.000Z"}),
                json.dumps({"phoneNum": "1", "money": "x", "date": "2024-03-05T08:01:00.000Z"}),
                json.dumps({"phoneNum": "1", "money": "1", "date": "2018-13-13T02:15:16.054Z"}))
    rows = C.topup_rows(log)
    assert sorted(r.money for r in C.good(rows).collect()) == [0, 7]
    assert reasons(rows) == ["bad_amount", "bad_time"]


def test_top10_tie_break_smaller_name(spark, dim):
    names = {"1": "Beijing", "2": "Shanghai", "3": "Tianjin"}
    msgs = [notify(provinceCode=c) for c in ("1", "1", "2", "2", "3")]
    top = N.top10_province(C.clean_notify(lines(spark, *msgs), dim), n=2).collect()
    assert [r.province for r in top] == [names["1"], names["2"]]


def test_failure_top3(spark, dim):
    msgs = [request(provinceCode="1", bussinessRst="1001"), request(provinceCode="1"),
            request(provinceCode="2", bussinessRst="1001"), request(provinceCode="3")]
    top = R.top3_failure_province(C.clean_request(lines(spark, *msgs), dim)).collect()
    assert [(r.province, r.failures, r.failure_rate) for r in top] == [
        ("Beijing", 1, 0.5), ("Shanghai", 1, 1.0), ("Tianjin", 0, 0.0)]


def test_lookup_without_broadcast_gives_same_rows(spark, dim):
    from chargepulse.operators.lookup import lookup_join
    fact = lines(spark, notify(), notify(provinceCode="2"), notify(provinceCode="99"))
    p = C.parse_notify(fact)
    d = dim.withColumnRenamed("province_code", "provinceCode")
    from tools import explain_text
    pick = lambda df: sorted((r.provinceCode, r.province) for r in df.collect())
    small = lookup_join(p, d, "provinceCode")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = lookup_join(p, d, "provinceCode")
        assert "BroadcastHashJoin" not in explain_text(big)
        assert pick(small) == pick(big) == [("1", "Beijing"), ("2", "Shanghai"), ("99", None)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_blank_messages_are_bad_json(spark, dim):
    rows = C.notify_rows(lines(spark, "", "   ", notify()), dim)
    assert reasons(rows) == ["bad_json", "bad_json"]
    assert C.good(rows).count() == 1
