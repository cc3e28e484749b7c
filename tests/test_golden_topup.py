"""Golden answers for the invented top-up sample (23 lines)."""

import os

from chargepulse.operators.clean import clean_topup
from chargepulse.plans.topup import month_phone_avg, phone_mean_monthly, topup_daily_money

from conftest import DATA


def _log(spark):
    return spark.read.text(os.path.join(DATA, "topup_sample.jsonl"))


def test_daily_money(spark):
    rows = topup_daily_money(clean_topup(_log(spark))).collect()
    assert sorted((r.day, r.money) for r in rows) == [("2024-03-05", 880), ("2024-03-06", 1099)]


def test_month_phone_avg(spark):
    got = {r.phone: (r.orders, r.avg_money, r.avg_trunc, r.month, r.counter_key)
           for r in month_phone_avg(clean_topup(_log(spark))).collect()}
    assert got == {
        "13900000001": (4, 94.75, 94, "2024-03", "2024-03 13900000001"),
        "13900000002": (3, 280 / 3, 93, "2024-03", "2024-03 13900000002"),
        "13900000003": (12, 1199 / 12, 99, "2024-03", "2024-03 13900000003"),
        "13900000004": (4, 30.25, 30, "2024-03", "2024-03 13900000004"),
    }


def test_phone_mean_monthly(spark):
    got = {r.phone: (r.total, r.months, r.mean_monthly)
           for r in phone_mean_monthly(clean_topup(_log(spark))).collect()}
    assert got == {
        "13900000001": (379, 1, 379.0),
        "13900000002": (280, 1, 280.0),
        "13900000003": (1199, 1, 1199.0),
        "13900000004": (121, 1, 121.0),
    }
