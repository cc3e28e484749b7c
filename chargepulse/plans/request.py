"""M6-M8: KPIs of the recharge-request stream (input: ``clean_request`` rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from chargepulse.operators.aggregate import with_failures
from chargepulse.operators.topn import top_n
from chargepulse.plans.rollup import rollup


def top3_failure_province(clean: DataFrame, n: int = 3) -> DataFrame:
    """M6: the ``n`` provinces with most failures: ``province, failures, failure_rate``."""
    s = with_failures(rollup(clean, ["province"], ["success"]))
    return top_n(s.select("province", "failures", "failure_rate"), n, "failures", "province")


def province_minute(clean: DataFrame) -> DataFrame:
    """M7: ``minute, province, orders, money``."""
    return rollup(clean, ["minute", "province"], ["money"])


def province_hour(clean: DataFrame) -> DataFrame:
    """M8: ``hour, province, orders, money``."""
    return rollup(clean, ["hour", "province"], ["money"])


def request_base(clean: DataFrame) -> DataFrame:
    """Finest common grain of M6-M8: ``(province, minute)`` sums (plus ``hour``)."""
    from pyspark.sql import functions as F

    return rollup(clean, ["province", "minute"], ["money", "success"]) \
        .withColumn("hour", F.substring("minute", 1, 10))


def request_report(clean: DataFrame, materialize: bool = True) -> dict[str, DataFrame]:
    """M6-M8 from one pass: one shuffle of message partials, then small roll-ups."""
    base = request_base(clean)
    if materialize:
        from chargepulse.session import checkpoint_root
        checkpoint_root(clean.sparkSession)
        base = base.checkpoint(eager=True)
    return {"top3_failure_province": top3_failure_province(base),
            "province_minute": province_minute(base),
            "province_hour": province_hour(base)}
