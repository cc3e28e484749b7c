"""M1-M5: KPIs of the recharge-notify stream (input: ``clean_notify`` rows or ``notify_base``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chargepulse.functions.times import prefix
from chargepulse.functions.values import ratio
from chargepulse.operators.topn import top_n
from chargepulse.plans.rollup import rollup
from chargepulse.session import checkpoint_root


def daily_totals(clean: DataFrame) -> DataFrame:
    """M1: ``day, total, money, success, costtime`` (ms of failed orders included)."""
    return rollup(clean, ["day"], ["money", "success", "costtime"], orders_as="total")


def minute_orders(clean: DataFrame) -> DataFrame:
    """M2: ``minute, orders``."""
    return rollup(clean, ["minute"], [])


def province_hour_failures(clean: DataFrame) -> DataFrame:
    """M3: ``province, hour, failures`` (orders minus successes)."""
    s = rollup(clean, ["province", "hour"], ["success"])
    return s.select("province", "hour",
                    (F.col("orders") - F.col("success")).cast("bigint").alias("failures"))


def top10_province(clean: DataFrame, n: int = 10) -> DataFrame:
    """M4: the ``n`` provinces with most orders: ``province, success_rate, orders``."""
    s = rollup(clean, ["province"], ["success"])
    s = s.select("province", ratio("success", "orders").alias("success_rate"), "orders")
    return top_n(s, n, "orders", "province")


def hourly_totals(clean: DataFrame) -> DataFrame:
    """M5: ``hour, orders, money``."""
    return rollup(clean, ["hour"], ["money"])


def notify_base(clean: DataFrame) -> DataFrame:
    """Finest common grain of M1-M5: ``(province, minute)`` sums.

    Hour and day are prefixes of the minute, so every notify KPI is a roll-up
    of this frame.  Its size is bounded by provinces x minutes, independent of
    the message volume.
    """
    return rollup(clean, ["province", "minute"], ["money", "success", "costtime"]).withColumns({
        "hour": prefix("minute", 10), "day": prefix("minute", 8)})


def notify_report(clean: DataFrame, materialize: bool = True) -> dict[str, DataFrame]:
    """All five notify KPIs from one pass over the messages.

    The base aggregate is checkpointed (reliably, to the cluster's checkpoint
    folder) so the five roll-ups neither re-read the input nor depend on
    executors that may be lost.
    """
    base = notify_base(clean)
    if materialize:
        checkpoint_root(clean.sparkSession)
        base = base.checkpoint(eager=True)
    return {
        "daily_totals": daily_totals(base),
        "minute_orders": minute_orders(base),
        "province_hour_failures": province_hour_failures(base),
        "top10_province": top10_province(base),
        "hourly_totals": hourly_totals(base),
    }


def top_province_by_day(clean: DataFrame, n: int = 10) -> DataFrame:
    """M4 per day: ``day, rank, province, success_rate, orders``.

    Ranked after the (day, province) aggregate, so each window partition holds
    at most one row per province.
    """
    from pyspark.sql import Window

    s = rollup(clean, ["day", "province"], ["success"])
    w = Window.partitionBy("day").orderBy(F.col("orders").desc(), F.col("province").asc())
    ranked = s.select("day", F.row_number().over(w).cast("bigint").alias("rank"), "province",
                      ratio("success", "orders").alias("success_rate"), "orders")
    return ranked.where(F.col("rank") <= n)
