"""KPIs of personal top-ups (input: ``clean_topup`` rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chargepulse.functions.times import month_span
from chargepulse.functions.values import counter_key, trunc_long
from chargepulse.plans.rollup import rollup


def topup_daily_money(clean: DataFrame) -> DataFrame:
    """M9: ``day, money`` (BIGINT sum)."""
    return rollup(clean, ["day"], [], {"money": "bigint"}).select("day", "money")


def month_phone_avg(clean: DataFrame) -> DataFrame:
    """``month, phone, orders, avg_money, avg_trunc, counter_key``.

    Input: clean rows, or partial sums carrying ``orders``.  One average over
    all top-ups of the key (the reference added per-batch
    averages, a sum of averages).  ``avg_trunc`` truncates toward zero.
    """
    s = rollup(clean, ["month", "phone"], [], {"money": "bigint"}).withColumnRenamed("money", "total")
    avg = F.col("total").cast("double") / F.col("orders").cast("double")
    return s.select("month", "phone", "orders", avg.alias("avg_money"),
                    trunc_long(avg).alias("avg_trunc"),
                    counter_key("month", "phone").alias("counter_key"))


def phone_mean_monthly(clean: DataFrame) -> DataFrame:
    """``phone, total, first_month, last_month, months, mean_monthly``.

    Total money over the inclusive month span from the first to the last
    top-up.  Single-level: ``min``/``max`` of the month replace the reference's
    collect-and-sort of a phone's months, so no group is ever materialized.
    """
    s = clean.groupBy("phone").agg(
        F.sum("money").cast("bigint").alias("total"),
        F.min("month").alias("first_month"), F.max("month").alias("last_month"))
    months = month_span("first_month", "last_month")
    return s.select("phone", "total", "first_month", "last_month", months.alias("months"),
                    (F.col("total").cast("double") / months.cast("double")).alias("mean_monthly"))


def topup_base(clean: DataFrame) -> DataFrame:
    """Finest common grain of M9, M10 and A7: ``(month, day, phone)`` with ``orders`` and ``money``."""
    return clean.groupBy("month", "day", "phone").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("money").cast("bigint").alias("money"))


def topup_report(clean: DataFrame, materialize: bool = True) -> dict[str, DataFrame]:
    """M9 from the rows (a day's partial sums are few); M10 and A7 from one ``(month, phone)`` base."""
    base = rollup(clean, ["month", "phone"], [], {"money": "bigint"})
    if materialize:
        from chargepulse.session import checkpoint_root
        checkpoint_root(clean.sparkSession)
        base = base.checkpoint(eager=True)
    return {"topup_daily_money": topup_daily_money(clean),
            "month_phone_avg": month_phone_avg(base),
            "phone_mean_monthly": phone_mean_monthly(base)}
