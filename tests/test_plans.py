"""Physical-plan shape: broadcast lookup, partial aggregation, top-N without a
global sort, pruned scans, no Python UDF in any plan."""

from chargepulse.plans.catalog import QUERIES

from conftest import SF001
from tools import explain_text


def plan(df):
    return explain_text(df, "formatted") + explain_text(df, "extended")


def test_daily_totals_plan(spark):
    p = plan(QUERIES["daily_totals"](spark, SF001))
    assert "BroadcastHashJoin" in p
    assert "partial_count" in p or "partial_sum" in p
    assert "props" not in p.split("ReadSchema")[1].split("\n")[0]


def test_topn_is_take_ordered(spark):
    p = plan(QUERIES["top10_province"](spark, SF001))
    assert "TakeOrderedAndProject" in p


def test_topup_scan_pruned(spark):
    p = plan(QUERIES["month_phone_avg"](spark, SF001))
    schema = p.split("ReadSchema: ")[1].split("\n")[0]
    assert "o_custkey" in schema and "o_orderpriority" not in schema and "o_orderkey" not in schema


def test_no_python_udfs(spark):
    for k, q in QUERIES.items():
        p = plan(q(spark, SF001))
        for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas"):
            assert node not in p, (k, node)


def test_sorted_provinces_come_in_order(spark):
    got = [(r["orders"], r["province"]) for r in QUERIES["sort_province"](spark, SF001).collect()]
    assert got == sorted(got, key=lambda r: (-r[0], r[1])) and len(got) > 1
