"""Query catalog: every operator and KPI as ``(spark, sf_dir) -> DataFrame``.

Each key also has an oracle: ANSI SQL for DuckDB written straight from the
base tables with the derivation rules of FIXTURES.md (no JSON on that side),
so the Spark chain (JSON build -> parse -> gate -> clean -> join -> aggregate)
is checked end to end against an independent formulation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from chargepulse.functions.messages import NOTIFY_FIELDS, parse_json
from chargepulse.functions.times import elapsed_ms, prefix
from chargepulse.operators import clean as C
from chargepulse.operators.aggregate import vector_sum
from chargepulse.operators.gates import notify_business_gate, notify_ods_gate, request_gate
from chargepulse.operators.rank import ranked
from chargepulse.operators.topn import sort_desc
from chargepulse.plans import notify as N, request as R, topup as T
from chargepulse.session import use_utc
from chargepulse.sources.dimension import province_dim
from chargepulse.sources.fixtures import load_table, province_lines, recharge_log, topup_log
from chargepulse.sources.offsets import starting_offsets_json

Query = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------------------ inputs -------

def _spread(spark: SparkSession) -> int | None:
    """Partitions to deal a table to, where the session asks for it (small unsplittable files)."""
    n = spark.conf.get("spark.chargepulse.spread", None)
    return int(n) if n else None


def rlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    return recharge_log(load_table(spark, sf_dir, "events"), _spread(spark))


def odd_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recharge log with planted bad messages (FIXTURES.md)."""
    use_utc(spark)
    return recharge_log(load_table(spark, sf_dir, "events"), _spread(spark), odd=True)


def tlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    return topup_log(load_table(spark, sf_dir, "orders"), _spread(spark))


def dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return province_dim(province_lines(load_table(spark, sf_dir, "nation")))


def notify_clean(spark, sf_dir, gate="interface") -> DataFrame:
    return C.clean_notify(rlog(spark, sf_dir), dim(spark, sf_dir), gate=gate)


def request_clean(spark, sf_dir) -> DataFrame:
    return C.clean_request(rlog(spark, sf_dir), dim(spark, sf_dir))


def topup_clean(spark, sf_dir) -> DataFrame:
    return C.clean_topup(tlog(spark, sf_dir))


def _parsed_ids(spark, sf_dir) -> DataFrame:
    p = parse_json(rlog(spark, sf_dir), NOTIFY_FIELDS)
    return p.withColumn("request_id", F.col("requestId"))


# ------------------------------------------------------- single operators --

def q_parse_notify(spark, sf_dir):
    p = C.parse_notify(rlog(spark, sf_dir))
    return p.select(F.col("requestId").alias("request_id"),
                    F.col("serviceName").alias("service_name"),
                    F.col("interFacRst").alias("interface_rst"),
                    F.col("bussinessRst").alias("business_rst"),
                    F.col("provinceCode").alias("province_code"),
                    F.col("chargefee").try_cast("decimal(18,2)").alias("charge_fee"),
                    "bad_json")


def _gate_query(gate):
    def q(spark, sf_dir):
        p = _parsed_ids(spark, sf_dir)
        return p.where(gate()).select("request_id", F.col("serviceName").alias("service_name"))
    return q


def q_filter_request(spark, sf_dir):
    p = parse_json(rlog(spark, sf_dir), ("serviceName", "interFacRst", "startReqTime"))
    return p.where(request_gate()).select(F.col("startReqTime").alias("start_time"),
                                          F.col("serviceName").alias("service_name"))


def q_clean_notify(spark, sf_dir):
    return notify_clean(spark, sf_dir)


def q_clean_request(spark, sf_dir):
    return C.clean_request(odd_log(spark, sf_dir), dim(spark, sf_dir))


def q_clean_topup(spark, sf_dir):
    return topup_clean(spark, sf_dir)


def q_ods_detail(spark, sf_dir):
    return C.ods_detail(rlog(spark, sf_dir), dim(spark, sf_dir))


def q_join_province(spark, sf_dir):
    return notify_clean(spark, sf_dir).select("request_id", "province_code", "province")


def q_quarantine_province(spark, sf_dir):
    rows = C.notify_rows(odd_log(spark, sf_dir), dim(spark, sf_dir))
    return C.quarantined(rows).where(F.col("reason") == "unknown_province") \
        .select("request_id", "province_code", "reason")


def q_quarantine_reasons(spark, sf_dir):
    rows = C.notify_rows(odd_log(spark, sf_dir), dim(spark, sf_dir))
    return C.quarantined(rows).groupBy("reason").agg(F.count("*").alias("n"))


def q_parse_odd(spark, sf_dir):
    p = parse_json(odd_log(spark, sf_dir), NOTIFY_FIELDS)
    return p.groupBy("bad_json", F.col("serviceName").alias("service_name")).agg(F.count("*").alias("n"))


def q_dim_province(spark, sf_dir):
    return dim(spark, sf_dir)


def q_agg_vector_sum(spark, sf_dir):
    return vector_sum(notify_clean(spark, sf_dir), ["province"], ["money", "success", "costtime"])


def q_sort_province(spark, sf_dir):
    s = vector_sum(notify_clean(spark, sf_dir), ["province"], [])
    return sort_desc(s, "orders", "province")


def q_sort_rank(spark, sf_dir):
    """K1 with its order as a column: (minute, province) rows, most orders first."""
    s = vector_sum(notify_clean(spark, sf_dir), ["minute", "province"], [])
    return ranked(s, [F.col("orders").desc(), F.col("minute").asc(), F.col("province").asc()])


def q_time_buckets(spark, sf_dir):
    p = _parsed_ids(spark, sf_dir)
    return p.select("request_id", prefix("requestId", 8).alias("day"),
                    prefix("requestId", 10).alias("hour"), prefix("requestId", 12).alias("minute"))


def q_elapsed_ms(spark, sf_dir):
    p = _parsed_ids(spark, sf_dir)
    return p.select("request_id", elapsed_ms("requestId", "receiveNotifyTime").alias("elapsed_ms"))


def q_month_span(spark, sf_dir):
    return T.phone_mean_monthly(topup_clean(spark, sf_dir)).select(
        "phone", "first_month", "last_month", "months")


# Fixed values of the derived position ledger: consumer group, topics by message kind, partitions.
LEDGER_GROUP = "kpi-consumers"
LEDGER_PARTITIONS = 4


def ledger(spark, sf_dir) -> DataFrame:
    """Consumer positions after reading the whole recharge log.

    Topic by message kind, partition = province code mod 4, position = number
    of messages in the topic-partition; field ``topic-partition``.
    """
    p = parse_json(rlog(spark, sf_dir), ("serviceName", "provinceCode"))
    name = F.lower("serviceName")
    topic = (F.when(name == "rechargenotifyreq", F.lit("recharge-notify"))
             .when(name == "sendrechargereq", F.lit("recharge-request"))
             .otherwise(F.lit("recharge-order")))
    part = (F.col("provinceCode").try_cast("int") % LEDGER_PARTITIONS)
    counts = p.groupBy(topic.alias("topic"), part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.lit(LEDGER_GROUP).alias("group_id"),
                         F.concat_ws("-", "topic", F.col("part").cast("string")).alias("field"),
                         F.col("n").cast("string").alias("offset"))


def q_offset_ledger_json(spark, sf_dir):
    return starting_offsets_json(ledger(spark, sf_dir))


def q_detail_table_daily_totals(spark, sf_dir):
    """Parse once into a day-partitioned detail table, then M1 from the table."""
    from chargepulse.plans.detail import read_detail, write_detail
    from chargepulse.session import work_dir
    path = write_detail(notify_clean(spark, sf_dir), work_dir(spark, "detail") + "/notify")
    return N.daily_totals(read_detail(spark, path))


def q_parse_variant(spark, sf_dir):
    """The detail table keeps the whole message; two fields that the notify schema does not name, read from it."""
    from chargepulse.functions.messages import message_variant, variant_field
    from chargepulse.plans.detail import read_detail, write_detail
    from chargepulse.session import work_dir
    log = rlog(spark, sf_dir).withColumn("message", message_variant())
    clean = C.good(C.notify_rows(log, dim(spark, sf_dir), carry=("message",)))
    kept = read_detail(spark, write_detail(clean, work_dir(spark, "variant") + "/notify"))
    return kept.select("request_id", variant_field("message", "endReqTime").alias("end_time"),
                       variant_field("message", "shouldfee", "decimal(18,2)").alias("should_fee"))


def q_message_fields(spark, sf_dir):
    """The fields of the odd log's messages."""
    from chargepulse.functions.messages import field_census
    return field_census(odd_log(spark, sf_dir))


def _phone_store(kpi):
    """The top-ups' sums put into a bucketed store in three goes, the last one a repetition; a KPI from the store."""
    def q(spark, sf_dir):
        from chargepulse.plans.phone_store import PhoneStore
        from chargepulse.session import work_dir
        sums = T.topup_base(topup_clean(spark, sf_dir))
        store = PhoneStore(spark, work_dir(spark, "phone-store"))
        early = F.col("day") < "1995-06-15"
        for some in (early, ~early, F.col("day").startswith("1995-06")):
            store.put(sums.where(some))
        return kpi(store.read())
    return q


# ----------------------------------------------------------------- KPIs ----

def _kpi(plan, clean):
    return lambda spark, sf_dir: plan(clean(spark, sf_dir))


QUERIES: dict[str, Query] = {
    # KPIs
    "daily_totals": _kpi(N.daily_totals, notify_clean),
    "minute_orders": _kpi(N.minute_orders, notify_clean),
    "province_hour_failures": _kpi(N.province_hour_failures, notify_clean),
    "top10_province": _kpi(N.top10_province, notify_clean),
    "hourly_totals": _kpi(N.hourly_totals, notify_clean),
    "top3_failure_province": _kpi(R.top3_failure_province, request_clean),
    "province_minute": _kpi(R.province_minute, request_clean),
    "province_hour": _kpi(R.province_hour, request_clean),
    "topup_daily_money": _kpi(T.topup_daily_money, topup_clean),
    "month_phone_avg": _kpi(T.month_phone_avg, topup_clean),
    "phone_mean_monthly": _kpi(T.phone_mean_monthly, topup_clean),
    # single operators
    "parse_notify": q_parse_notify,
    "filter_notify_business": _gate_query(notify_business_gate),
    "filter_notify_interface": _gate_query(notify_ods_gate),
    "filter_request": q_filter_request,
    "clean_notify": q_clean_notify,
    "clean_request": q_clean_request,
    "clean_topup": q_clean_topup,
    "ods_detail": q_ods_detail,
    "join_province": q_join_province,
    "quarantine_province": q_quarantine_province,
    "quarantine_reasons": q_quarantine_reasons,
    "parse_odd": q_parse_odd,
    "dim_province": q_dim_province,
    "agg_vector_sum": q_agg_vector_sum,
    "sort_province": q_sort_province,
    "sort_rank": q_sort_rank,
    "time_buckets": q_time_buckets,
    "elapsed_ms": q_elapsed_ms,
    "month_span": q_month_span,
    "offset_ledger_json": q_offset_ledger_json,
    "detail_table_daily_totals": q_detail_table_daily_totals,
    "parse_variant": q_parse_variant,
    "message_fields": q_message_fields,
    "phone_store_month_avg": _phone_store(T.month_phone_avg),
    "phone_store_mean_monthly": _phone_store(T.phone_mean_monthly),
    # the notify app's gate as written (business success required: no failures reach the KPIs)
    "daily_totals_business": lambda spark, sf_dir: N.daily_totals(notify_clean(spark, sf_dir, "business")),
    "minute_orders_business": lambda spark, sf_dir: N.minute_orders(notify_clean(spark, sf_dir, "business")),
    "province_hour_failures_business": lambda spark, sf_dir: N.province_hour_failures(
        notify_clean(spark, sf_dir, "business")),
    "hourly_totals_business": lambda spark, sf_dir: N.hourly_totals(notify_clean(spark, sf_dir, "business")),
    "top10_province_business": lambda spark, sf_dir: N.top10_province(
        notify_clean(spark, sf_dir, "business")),
}

# ------------------------------------------------------------- oracles -----

_RID = "strftime(e.ts, '%Y%m%d%H%M%S%g') || lpad(CAST(e.event_id AS VARCHAR), 15, '0')"
_OK = "(e.event_type <> 'error' AND e.event_id % 5 <> 0)"
_NAME = ("CASE WHEN e.event_type IN ('purchase','error') AND e.event_id % 7 = 0 THEN 'RECHARGENOTIFYREQ' "
         "WHEN e.event_type IN ('purchase','error') THEN 'reChargeNotifyReq' "
         "WHEN e.event_type IN ('signup','click') THEN 'sendRechargeReq' ELSE 'makeNewOrder' END")

NOTIFY_CTE = f"""c AS (
  SELECT {_RID} AS request_id, e.ts, CAST(e.user_id % 25 AS VARCHAR) AS province_code,
         n.n_name AS province, {_OK} AS ok, CAST(e.value AS DECIMAL(18,2)) AS fee,
         e.event_id * 37 % 60000 AS ms
  FROM events e JOIN nation n ON n.n_nationkey = e.user_id % 25
  WHERE e.event_type IN ('purchase','error') AND e.event_id % 11 <> 0)"""

REQUEST_CTE = f"""c AS (
  SELECT strftime(e.ts, '%Y%m%d%H%M%S%g') AS start_time, e.ts,
         CAST(e.user_id % 25 AS VARCHAR) AS province_code, n.n_name AS province,
         {_OK} AS ok, CAST(e.value AS DECIMAL(18,2)) AS fee
  FROM events e JOIN nation n ON n.n_nationkey = e.user_id % 25
  WHERE e.event_type IN ('signup','click') AND e.event_id % 11 <> 0)"""

TOPUP_CTE = """c AS (
  SELECT '1' || lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS phone,
         CAST(floor(o_totalprice) AS BIGINT) AS money, o_orderdate,
         strftime(o_orderdate, '%Y-%m') AS month, strftime(o_orderdate, '%Y-%m-%d') AS day
  FROM orders)"""

BUSINESS_CTE = f"""c AS (
  SELECT e.ts, n.n_name AS province, {_OK} AS ok, CAST(e.value AS DECIMAL(18,2)) AS fee,
         e.event_id * 37 % 60000 AS ms
  FROM events e JOIN nation n ON n.n_nationkey = e.user_id % 25
  WHERE e.event_type IN ('purchase','error') AND {_OK})"""

_SUCC = "CAST(sum(CASE WHEN ok THEN 1 ELSE 0 END) AS BIGINT)"
_MONEY = "CAST(sum(CASE WHEN ok THEN fee ELSE 0 END) AS DECIMAL(18,2))"

# Planted bad messages: what each one is, in the order that cleaning checks.
_GOOD = "e.event_id % 23 <> 1 AND e.event_id % 17 <> 1 AND e.event_id % 13 NOT IN (1, 2) AND e.event_id % 19 <> 1"
_REASON = """CASE WHEN e.event_id % 23 = 1 THEN 'bad_json' WHEN e.event_id % 17 = 1 THEN 'missing_service'
  WHEN e.event_type NOT IN ('purchase','error') OR e.event_id % 11 = 0 THEN NULL
  WHEN e.event_id % 13 IN (1, 2) THEN 'bad_amount' WHEN e.event_id % 19 = 1 THEN 'bad_time'
  WHEN n.n_nationkey IS NULL THEN 'unknown_province' END"""
ODD_REQUEST_CTE = f"""c AS (
  SELECT strftime(e.ts, '%Y%m%d%H%M%S%g') AS start_time, e.ts,
         CAST(e.user_id % 27 AS VARCHAR) AS province_code, n.n_name AS province,
         {_OK} AS ok, CAST(e.value AS DECIMAL(18,2)) AS fee,
         CAST(e.value AS DECIMAL(18,2)) + CASE WHEN e.event_id % 13 > 2 THEN 1 ELSE 0 END AS should
  FROM events e JOIN nation n ON n.n_nationkey = e.user_id % 27
  WHERE e.event_type IN ('signup','click') AND e.event_id % 11 <> 0 AND {_GOOD})"""

ORACLE: dict[str, str] = {
    "quarantine_reasons": f"""SELECT reason, count(*) AS n FROM (
  SELECT {_REASON} AS reason FROM events e LEFT JOIN nation n ON n.n_nationkey = e.user_id % 27)
WHERE reason IS NOT NULL GROUP BY 1""",
    "parse_odd": f"""SELECT e.event_id % 23 = 1 AS bad_json,
       CASE WHEN e.event_id % 23 <> 1 AND e.event_id % 17 <> 1 THEN {_NAME} END AS service_name, count(*) AS n
FROM events e GROUP BY 1, 2""",
    "minute_orders_business": f"""WITH {BUSINESS_CTE}
SELECT strftime(ts, '%Y%m%d%H%M') AS minute, count(*) AS orders FROM c GROUP BY 1""",
    "province_hour_failures_business": f"""WITH {BUSINESS_CTE}
SELECT province, strftime(ts, '%Y%m%d%H') AS hour, CAST(count(*) - {_SUCC} AS BIGINT) AS failures
FROM c GROUP BY 1, 2""",
    "hourly_totals_business": f"""WITH {BUSINESS_CTE}
SELECT strftime(ts, '%Y%m%d%H') AS hour, count(*) AS orders, {_MONEY} AS money FROM c GROUP BY 1""",
    "daily_totals_business": f"""WITH {BUSINESS_CTE}
SELECT strftime(ts, '%Y%m%d') AS day, count(*) AS total, {_MONEY} AS money,
       {_SUCC} AS success, CAST(sum(ms) AS BIGINT) AS costtime
FROM c GROUP BY 1""",
    "top10_province_business": f"""WITH {BUSINESS_CTE}
SELECT province, CAST({_SUCC} AS DOUBLE) / CAST(count(*) AS DOUBLE) AS success_rate,
       count(*) AS orders
FROM c GROUP BY 1 ORDER BY orders DESC, province ASC LIMIT 10""",
    "detail_table_daily_totals": f"""WITH {NOTIFY_CTE}
SELECT strftime(ts, '%Y%m%d') AS day, count(*) AS total, {_MONEY} AS money,
       {_SUCC} AS success, CAST(sum(ms) AS BIGINT) AS costtime
FROM c GROUP BY 1""",
    "daily_totals": f"""WITH {NOTIFY_CTE}
SELECT strftime(ts, '%Y%m%d') AS day, count(*) AS total, {_MONEY} AS money,
       {_SUCC} AS success, CAST(sum(ms) AS BIGINT) AS costtime
FROM c GROUP BY 1""",
    "minute_orders": f"""WITH {NOTIFY_CTE}
SELECT strftime(ts, '%Y%m%d%H%M') AS minute, count(*) AS orders FROM c GROUP BY 1""",
    "province_hour_failures": f"""WITH {NOTIFY_CTE}
SELECT province, strftime(ts, '%Y%m%d%H') AS hour, CAST(count(*) - {_SUCC} AS BIGINT) AS failures
FROM c GROUP BY 1, 2""",
    "top10_province": f"""WITH {NOTIFY_CTE}
SELECT province, CAST({_SUCC} AS DOUBLE) / CAST(count(*) AS DOUBLE) AS success_rate,
       count(*) AS orders
FROM c GROUP BY 1 ORDER BY orders DESC, province ASC LIMIT 10""",
    "hourly_totals": f"""WITH {NOTIFY_CTE}
SELECT strftime(ts, '%Y%m%d%H') AS hour, count(*) AS orders, {_MONEY} AS money FROM c GROUP BY 1""",
    "top3_failure_province": f"""WITH {REQUEST_CTE}
SELECT province, CAST(count(*) - {_SUCC} AS BIGINT) AS failures,
       CAST(count(*) - {_SUCC} AS DOUBLE) / CAST(count(*) AS DOUBLE) AS failure_rate
FROM c GROUP BY 1 ORDER BY failures DESC, province ASC LIMIT 3""",
    "province_minute": f"""WITH {REQUEST_CTE}
SELECT strftime(ts, '%Y%m%d%H%M') AS minute, province, count(*) AS orders, {_MONEY} AS money
FROM c GROUP BY 1, 2""",
    "province_hour": f"""WITH {REQUEST_CTE}
SELECT strftime(ts, '%Y%m%d%H') AS hour, province, count(*) AS orders, {_MONEY} AS money
FROM c GROUP BY 1, 2""",
    "topup_daily_money": f"""WITH {TOPUP_CTE}
SELECT day, CAST(sum(money) AS BIGINT) AS money FROM c GROUP BY 1""",
    "month_phone_avg": f"""WITH {TOPUP_CTE}
SELECT month, phone, count(*) AS orders,
       CAST(sum(money) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_money,
       CAST(trunc(CAST(sum(money) AS DOUBLE) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS avg_trunc,
       month || ' ' || phone AS counter_key
FROM c GROUP BY 1, 2""",
    "phone_mean_monthly": f"""WITH {TOPUP_CTE}
SELECT phone, CAST(sum(money) AS BIGINT) AS total, min(month) AS first_month, max(month) AS last_month,
       CAST(datediff('month', min(o_orderdate), max(o_orderdate)) + 1 AS BIGINT) AS months,
       CAST(sum(money) AS DOUBLE)
         / CAST(datediff('month', min(o_orderdate), max(o_orderdate)) + 1 AS DOUBLE) AS mean_monthly
FROM c GROUP BY 1""",
    "parse_notify": f"""SELECT {_RID} AS request_id, {_NAME} AS service_name,
       CASE WHEN e.event_id % 11 = 0 THEN '9999' ELSE '0000' END AS interface_rst,
       CASE WHEN e.event_type = 'error' OR e.event_id % 5 = 0 THEN '1001' ELSE '0000' END AS business_rst,
       CAST(e.user_id % 25 AS VARCHAR) AS province_code,
       CAST(e.value AS DECIMAL(18,2)) AS charge_fee, false AS bad_json
FROM events e""",
    "filter_notify_business": f"""SELECT {_RID} AS request_id, {_NAME} AS service_name FROM events e
WHERE e.event_type IN ('purchase','error') AND {_OK}""",
    "filter_notify_interface": f"""SELECT {_RID} AS request_id, {_NAME} AS service_name FROM events e
WHERE e.event_type IN ('purchase','error') AND e.event_id % 11 <> 0 AND e.event_id % 7 <> 0""",
    "filter_request": """SELECT strftime(e.ts, '%Y%m%d%H%M%S%g') AS start_time, 'sendRechargeReq' AS service_name
FROM events e WHERE e.event_type IN ('signup','click') AND e.event_id % 11 <> 0""",
    "clean_notify": f"""WITH {NOTIFY_CTE}
SELECT request_id, strftime(ts, '%Y%m%d') AS day, strftime(ts, '%Y%m%d%H') AS hour,
       strftime(ts, '%Y%m%d%H%M') AS minute, province_code, province,
       CAST(CASE WHEN ok THEN 1 ELSE 0 END AS BIGINT) AS success,
       CAST(CASE WHEN ok THEN fee ELSE 0 END AS DECIMAL(18,2)) AS money,
       CAST(ms AS BIGINT) AS costtime
FROM c""",
    "clean_request": f"""WITH {ODD_REQUEST_CTE}
SELECT start_time, strftime(ts, '%Y%m%d%H') AS hour, strftime(ts, '%Y%m%d%H%M') AS minute,
       province_code, province, CAST(CASE WHEN ok THEN 1 ELSE 0 END AS BIGINT) AS success,
       CAST(CASE WHEN ok THEN fee ELSE 0 END AS DECIMAL(18,2)) AS money,
       CAST(CASE WHEN ok THEN should ELSE 0 END AS DECIMAL(18,2)) AS should_money
FROM c""",
    "clean_topup": f"""WITH {TOPUP_CTE}
SELECT month, day, phone, money, strftime(o_orderdate, '%m') AS month_of_year FROM c""",
    "ods_detail": f"""WITH {NOTIFY_CTE.replace("e.event_id % 11 <> 0)", "e.event_id % 11 <> 0 AND e.event_id % 7 <> 0)")}
SELECT request_id, strftime(ts, '%Y%m%d') AS date, strftime(ts, '%H') AS hour,
       strftime(ts, '%M') AS minute, CAST(1 AS BIGINT) AS orders,
       CAST(CASE WHEN ok THEN 1 ELSE 0 END AS BIGINT) AS success,
       CAST(CASE WHEN ok THEN fee ELSE 0 END AS DECIMAL(18,2)) AS money,
       CAST(CASE WHEN ok THEN ms ELSE 0 END AS BIGINT) AS ms, province_code, province
FROM c""",
    "join_province": f"""WITH {NOTIFY_CTE}
SELECT request_id, province_code, province FROM c""",
    "quarantine_province": f"""SELECT {_RID} AS request_id, CAST(e.user_id % 27 AS VARCHAR) AS province_code,
       {_REASON} AS reason
FROM events e LEFT JOIN nation n ON n.n_nationkey = e.user_id % 27 WHERE ({_REASON}) = 'unknown_province'""",
    "dim_province": """SELECT CAST(n_nationkey AS VARCHAR) AS province_code, min(n_name) AS province
FROM nation GROUP BY 1""",
    "agg_vector_sum": f"""WITH {NOTIFY_CTE}
SELECT province, count(*) AS orders, {_MONEY} AS money, {_SUCC} AS success,
       CAST(sum(ms) AS BIGINT) AS costtime
FROM c GROUP BY 1""",
    "sort_province": f"""WITH {NOTIFY_CTE}
SELECT province, count(*) AS orders FROM c GROUP BY 1 ORDER BY orders DESC, province ASC""",
    "sort_rank": f"""WITH {NOTIFY_CTE},
s AS (SELECT strftime(ts, '%Y%m%d%H%M') AS minute, province, count(*) AS orders FROM c GROUP BY 1, 2)
SELECT *, CAST(row_number() OVER (ORDER BY orders DESC, minute ASC, province ASC) AS BIGINT) AS rank FROM s""",
    "time_buckets": f"""SELECT {_RID} AS request_id, strftime(e.ts, '%Y%m%d') AS day,
       strftime(e.ts, '%Y%m%d%H') AS hour, strftime(e.ts, '%Y%m%d%H%M') AS minute FROM events e""",
    "elapsed_ms": f"""SELECT {_RID} AS request_id, CAST(e.event_id * 37 % 60000 AS BIGINT) AS elapsed_ms
FROM events e""",
    "month_span": f"""WITH {TOPUP_CTE}
SELECT phone, min(month) AS first_month, max(month) AS last_month,
       CAST(datediff('month', min(o_orderdate), max(o_orderdate)) + 1 AS BIGINT) AS months
FROM c GROUP BY 1""",
    "offset_ledger_json": """WITH m AS (
  SELECT CASE WHEN event_type IN ('purchase','error') THEN 'recharge-notify'
              WHEN event_type IN ('signup','click') THEN 'recharge-request'
              ELSE 'recharge-order' END AS topic,
         (user_id % 25) % 4 AS part
  FROM events),
t AS (SELECT topic, part, count(*) AS n FROM m GROUP BY 1, 2),
tp AS (SELECT topic, count(*) AS np,
              '{' || string_agg('"' || CAST(part AS VARCHAR) || '":' || CAST(n AS VARCHAR), ',' ORDER BY part) || '}' AS pj
       FROM t GROUP BY 1)
SELECT 'kpi-consumers' AS group_id, CAST(sum(np) AS BIGINT) AS partitions,
       '{' || string_agg('"' || topic || '":' || pj, ',' ORDER BY topic) || '}' AS starting_offsets
FROM tp""",
    "parse_variant": f"""SELECT {_RID} AS request_id,
       strftime(e.ts + to_milliseconds(e.event_id * 37 % 60000), '%Y%m%d%H%M%S%g') AS end_time,
       CAST(e.value AS DECIMAL(18,2)) AS should_fee
FROM events e JOIN nation n ON n.n_nationkey = e.user_id % 25
WHERE e.event_type IN ('purchase','error') AND e.event_id % 11 <> 0""",
    "message_fields": """WITH f AS (
  SELECT unnest(['interFacRst', 'bussinessRst', 'provinceCode', 'chargefee', 'shouldfee', 'requestId', 'receiveNotifyTime',
                 'startReqTime', 'endReqTime', 'serviceName']) AS field, event_id FROM events WHERE event_id % 23 <> 1)
SELECT field, 'STRING' AS kind, count(*) AS n FROM f WHERE field <> 'serviceName' OR event_id % 17 <> 1 GROUP BY 1""",
}
ORACLE["phone_store_month_avg"] = ORACLE["month_phone_avg"]
ORACLE["phone_store_mean_monthly"] = ORACLE["phone_mean_monthly"]
