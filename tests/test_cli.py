"""The command line runs an app as a stream and an application's KPIs as a batch report."""

from chargepulse import cli
from chargepulse.plans.catalog import QUERIES, rlog, tlog
from chargepulse.session import work_dir
from chargepulse.sources.files import stage_lines
from chargepulse.sources.fixtures import load_table, province_lines
from chargepulse.streaming import apps as A

from conftest import SF001


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def _inputs(spark, log):
    root = work_dir(spark, "test-cli")
    stage_lines(log(spark, SF001), f"{root}/log", files=3)
    province_lines(load_table(spark, SF001, "nation")).coalesce(1).write.text(f"{root}/dim")
    return root


def test_report_notify(spark):
    root = _inputs(spark, rlog)
    out = cli.main(["report", "notify", "--input", f"{root}/log", "--dim", f"{root}/dim",
                    "--out", f"{root}/out"], spark=spark)
    for k in ("daily_totals", "minute_orders", "province_hour_failures", "top10_province",
              "hourly_totals"):
        assert rows(spark.read.parquet(out[k])) == rows(QUERIES[k](spark, SF001)), k
    assert spark.read.parquet(out["quarantine"]).count() == 0


def test_app_topup_available_now(spark):
    root = _inputs(spark, tlog)
    cli.main(["app", "topup", "--source", f"files:{root}/log", "--out", f"{root}/out",
              "--checkpoint", f"{root}/ck", "--trigger", "availableNow",
              "--max-files-per-trigger", "1"], spark=spark)
    res = A.topup_results(spark, f"{root}/out")
    assert rows(res["month_phone_avg"]) == rows(QUERIES["month_phone_avg"](spark, SF001))


def test_kafka_options_reach_the_source(spark, monkeypatch):
    seen = {}

    def source(spark, options):
        seen.update(options)
        raise RuntimeError("no broker here")
    monkeypatch.setattr(cli, "read_kafka", source)
    try:
        cli.main(["app", "topup", "--source", "kafka:b:9092:recharge", "--out", "o", "--checkpoint", "c", "--min-partitions", "64",
                  "--starting-offsets", '{"recharge":{"0":5}}', "--max-offsets-per-trigger", "60000"], spark=spark)
    except RuntimeError:
        pass
    assert seen["startingOffsets"] == '{"recharge":{"0":5}}' and seen["subscribe"] == "recharge"
    assert seen["maxOffsetsPerTrigger"] == "60000" and seen["minPartitions"] == "64"
