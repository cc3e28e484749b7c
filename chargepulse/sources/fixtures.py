"""Message logs derived from the driver's tables (rules in FIXTURES.md §2).

The reference's own recharge log and province file are not shipped, so the
recharge log is built from ``events``, the top-up log from ``orders`` and the
province file from ``nation``.  These are narrow per-row projections: they
scale with the tables and never shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chargepulse.operators.spread import spread

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Service names and result codes of the recharge messages.
NOTIFY_NAME = "reChargeNotifyReq"
REQUEST_NAME = "sendRechargeReq"
ORDER_NAME = "makeNewOrder"
OK, IFACE_FAIL, BIZ_FAIL = "0000", "9999", "1001"
DIGITS_FMT = "yyyyMMddHHmmssSSS"


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _fmt(ts: Column) -> Column:
    return F.date_format(ts, DIGITS_FMT)


def recharge_log(events: DataFrame, partitions: int | None = None, odd: bool = False) -> DataFrame:
    """``value STRING``: one recharge message (notify, request or order) per event.

    ``odd`` plants what quarantine is for, by event id: cut JSON, no service name, amounts that
    are no numbers or outside their domain, times that do not exist, provinces beyond the
    dimension; and a ``shouldfee`` one above ``chargefee``.
    """
    eid, et = F.col("event_id"), F.col("event_type")
    stop = F.col("ts") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), ((eid * 37) % 60000).cast("decimal(10,3)") / 1000)
    notify = et.isin("purchase", "error")
    name = (F.when(notify & (eid % 7 == 0), F.lit(NOTIFY_NAME.upper()))
            .when(notify, F.lit(NOTIFY_NAME))
            .when(et.isin("signup", "click"), F.lit(REQUEST_NAME))
            .otherwise(F.lit(ORDER_NAME)))
    fee = F.col("value").cast("decimal(18,2)").cast("string")
    msg = F.struct(
        name.alias("serviceName"),
        F.when(eid % 11 == 0, F.lit(IFACE_FAIL)).otherwise(F.lit(OK)).alias("interFacRst"),
        F.when((et == "error") | (eid % 5 == 0), F.lit(BIZ_FAIL)).otherwise(F.lit(OK))
         .alias("bussinessRst"),
        (F.col("user_id") % 25).cast("string").alias("provinceCode"),
        fee.alias("chargefee"),
        fee.alias("shouldfee"),
        F.concat(_fmt(F.col("ts")), F.lpad(eid.cast("string"), 15, "0")).alias("requestId"),
        _fmt(stop).alias("receiveNotifyTime"),
        _fmt(F.col("ts")).alias("startReqTime"),
        _fmt(stop).alias("endReqTime"),
    )
    src = spread(events.select("event_id", "ts", "user_id", "event_type", "value"), partitions)
    if not odd:
        return src.select(F.to_json(msg).alias("value"))
    odd_fee = (F.when(eid % 13 == 1, F.lit("1,000")).when(eid % 13 == 2, F.lit("9999999999999999")).otherwise(fee))
    odd_msg = F.struct(
        F.when(eid % 17 != 1, name).alias("serviceName"), msg.getField("interFacRst").alias("interFacRst"),
        msg.getField("bussinessRst").alias("bussinessRst"),
        (F.col("user_id") % 27).cast("string").alias("provinceCode"), odd_fee.alias("chargefee"),
        F.when(eid % 13 > 2, (F.col("value").cast("decimal(18,2)") + 1).cast("string")).otherwise(odd_fee).alias("shouldfee"),
        msg.getField("requestId").alias("requestId"),
        F.when(eid % 19 == 1, F.lit("20241399000000000")).otherwise(msg.getField("receiveNotifyTime")).alias("receiveNotifyTime"),
        F.when(eid % 19 == 1, F.lit("20241399000000000")).otherwise(msg.getField("startReqTime")).alias("startReqTime"),
        msg.getField("endReqTime").alias("endReqTime"))
    text = F.to_json(odd_msg)
    return src.select(F.when(eid % 23 == 1, F.substring(text, 1, 20)).otherwise(text).alias("value"))


def topup_log(orders: DataFrame, partitions: int | None = None) -> DataFrame:
    """``value STRING``: one personal top-up message per order."""
    msg = F.struct(
        F.concat(F.lit("1"), F.lpad(F.col("o_custkey").cast("string"), 10, "0")).alias("phoneNum"),
        F.floor("o_totalprice").cast("bigint").cast("string").alias("money"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("date"),
    )
    src = spread(orders.select("o_custkey", "o_totalprice", "o_orderdate"), partitions)
    return src.select(F.to_json(msg).alias("value"))


def province_lines(nation: DataFrame) -> DataFrame:
    """``value STRING``: the province file, ``code name`` per line."""
    return nation.select(F.concat_ws(" ", F.col("n_nationkey").cast("string"), "n_name").alias("value"))
