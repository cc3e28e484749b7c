"""Streaming query keys: each stages the derived message log as files in the
shared work folder, runs a Structured Streaming job over them to the end
(``availableNow``) and returns the job's output table.

The oracle of a running-total job is the batch SQL of the same KPI: after the
whole input has streamed through, the running totals must equal it exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chargepulse.operators import clean as C
from chargepulse.plans import notify as N, topup as T
from chargepulse.plans.catalog import _NAME, _REASON, _RID, ORACLE, dim, rlog, tlog
from chargepulse.session import parallelism, use_utc, work_dir
from chargepulse.sources.files import read_lines_stream, stage_in_batches, stage_lines
from chargepulse.sources.fixtures import load_table, recharge_log
from chargepulse.streaming import apps as A
from chargepulse.streaming.jobs import (
    late_rows, per_batch, raw_to_files, read_totals, run_to_end, running_totals, watermarked_totals,
)
from chargepulse.streaming.sinks import read_batches, read_current, snapshot

TIMEOUT = 1800


def _state_partitions(spark: SparkSession) -> int:
    """One state partition per core: the test keys (days, minutes, phone-months
    of one table) are few; a production job sizes this to its key count."""
    return parallelism(spark)


def _split(lines: DataFrame, parts: int) -> DataFrame:
    return lines.withColumn("part", (F.abs(F.xxhash64("value")) % parts).cast("string"))


def _notify_stream(spark, sf_dir, src, per_trigger):
    return C.clean_notify(read_lines_stream(spark, src, per_trigger), dim(spark, sf_dir))


def _running(kpi, keys, log, clean, batches=3):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = work_dir(spark, "running")
        per_trigger = stage_in_batches(spark, log(spark, sf_dir), f"{root}/source", batches)
        stream = clean(spark, sf_dir, read_lines_stream(spark, f"{root}/source", per_trigger))
        agg_schema = kpi(stream).schema
        run_to_end(running_totals(stream, kpi, f"{root}/totals", f"{root}/checkpoint",
                                  state_partitions=_state_partitions(spark)), TIMEOUT)
        return read_current(spark, f"{root}/totals", keys, agg_schema)
    return q


def _clean_notify_stream(spark, sf_dir, lines):
    return C.clean_notify(lines, dim(spark, sf_dir))


def _clean_topup_stream(spark, sf_dir, lines):
    return C.clean_topup(lines)


def q_stream_read_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 + S9 + T1/T5: the log replayed file by file, parsed, appended to a file sink."""
    root = work_dir(spark, "read-log")
    per_trigger = stage_in_batches(spark, rlog(spark, sf_dir), f"{root}/source", 4)
    parsed = C.parse_notify(read_lines_stream(spark, f"{root}/source", per_trigger))
    out = parsed.select(F.col("requestId").alias("request_id"),
                        F.col("serviceName").alias("service_name"))
    run_to_end(raw_to_files(out, f"{root}/out", f"{root}/checkpoint"), TIMEOUT)
    return spark.read.parquet(f"{root}/out")


def day_province_sums(batch: DataFrame) -> DataFrame:
    """Per-batch partial sums ``(day, province, orders, success)`` -- additive, so appendable."""
    from chargepulse.plans.rollup import rollup
    return rollup(batch, ["day", "province"], ["success"])


def q_stream_day_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every micro-batch appends its partial (day, province) sums under its
    ``batch_id``; the reader ranks the top-10 provinces per day over all batches.

    The result does not depend on where batch boundaries fall, and no day is
    ever funnelled into one task (the input is staged in even splits).
    """
    root = work_dir(spark, "batch-top10")
    per_trigger = stage_in_batches(spark, rlog(spark, sf_dir), f"{root}/source", 3)
    stream = _notify_stream(spark, sf_dir, f"{root}/source", per_trigger)
    run_to_end(per_batch(stream, {"day_province": day_province_sums},
                         f"{root}/out", f"{root}/checkpoint"), TIMEOUT)
    return N.top_province_by_day(read_batches(spark, f"{root}/out", "day_province"))


def q_stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop after half the input, add the rest, restart from the checkpoint."""
    root = work_dir(spark, "resume")
    lines = _split(rlog(spark, sf_dir), 2)
    src, ckpt, totals = f"{root}/source", f"{root}/checkpoint", f"{root}/totals"
    schema = None
    for part in ("0", "1"):
        per_trigger = stage_in_batches(spark, lines.where(F.col("part") == part).select("value"),
                                       f"{src}/part{part}", 2)
        stream = _notify_stream(spark, sf_dir, f"{src}/*", per_trigger)
        schema = N.daily_totals(stream).schema
        run_to_end(running_totals(stream, N.daily_totals, totals, ckpt,
                                  state_partitions=_state_partitions(spark)), TIMEOUT)
    return read_current(spark, totals, ["day"], schema)


def _app(start, results, pick, log, with_dim=True):
    """Run a whole streaming app over the staged log; return one of its KPIs."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = work_dir(spark, "app")
        per_trigger = stage_in_batches(spark, log(spark, sf_dir), f"{root}/source", 3)
        stream = read_lines_stream(spark, f"{root}/source", per_trigger)
        args = (stream, dim(spark, sf_dir)) if with_dim else (stream,)
        run_to_end(start(*args, f"{root}/out", f"{root}/checkpoint", trigger=None), TIMEOUT)
        return results(spark, f"{root}/out")[pick]
    return q


PARTS = 3


def _parts(spark: SparkSession, sf_dir: str):
    """The recharge log in parts by event id, so that the oracle knows each message's batch."""
    use_utc(spark)
    events = load_table(spark, sf_dir, "events")
    return [recharge_log(events.where(F.col("event_id") % PARTS == b)) for b in range(PARTS)]


def _batch_by_batch(spark, sf_dir, root, parts, after=None):
    """Run the notify app once per part: every run is one micro-batch."""
    for b, lines in enumerate(parts):
        stage_lines(lines, f"{root}/source/part{b}")
        stream = read_lines_stream(spark, f"{root}/source/*")
        run_to_end(A.notify_app(stream, dim(spark, sf_dir), f"{root}/out", f"{root}/checkpoint", trigger=None), TIMEOUT)
        if after:
            after(b)
    return A.notify_results(spark, f"{root}/out")


def _per_batch(pick):
    """A per-batch report of the notify app."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = work_dir(spark, "batches")
        return _batch_by_batch(spark, sf_dir, root, _parts(spark, sf_dir))[pick]
    return q


def _compacted(pick):
    """A first batch of bad messages only, then the log; compacted after every batch but the last."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = work_dir(spark, "compacted")
        bad = load_table(spark, sf_dir, "nation").select(F.concat(F.lit("no json "), "n_name").alias("value"))

        def fold(b: int) -> None:
            if b < PARTS:
                A.compact(spark, f"{root}/out", b)
                A.compact(spark, f"{root}/out", b)
        return _batch_by_batch(spark, sf_dir, root, [bad, *_parts(spark, sf_dir)], fold)[pick]
    return q


def q_stream_compact_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compactions that ask for batches to come fold the committed ones only; the next batch still counts."""
    root = work_dir(spark, "compact-idle")

    def idle(b: int) -> None:
        q = A.notify_app(read_lines_stream(spark, f"{root}/source/*"), dim(spark, sf_dir), f"{root}/out", f"{root}/checkpoint", trigger=None)
        run_to_end(q, TIMEOUT)
        A.compact(spark, f"{root}/out", b + 50)
    return _batch_by_batch(spark, sf_dir, root, _parts(spark, sf_dir), idle)["batch_hourly_totals"]


def q_stream_snapshot_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals whose changelog is folded into a snapshot after every part but the last."""
    root = work_dir(spark, "snapshot")
    schema = None
    for b, lines in enumerate(_parts(spark, sf_dir)):
        stage_lines(lines, f"{root}/source/part{b}")
        stream = _notify_stream(spark, sf_dir, f"{root}/source/*", None)
        schema = N.daily_totals(stream).schema
        run_to_end(running_totals(stream, N.daily_totals, f"{root}/totals", f"{root}/checkpoint",
                                  state_partitions=_state_partitions(spark)), TIMEOUT)
        if b < PARTS - 1:
            snapshot(spark, f"{root}/totals", ["day"])
    return read_current(spark, f"{root}/totals", ["day"], schema)


LATE, LATE_DAYS = "event_id % 10 = 3", 2


def q_stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: a tenth of the log comes after the rest; what is then more than two days behind is late."""
    use_utc(spark)
    root, events = work_dir(spark, "late"), load_table(spark, sf_dir, "events")
    for b, some in enumerate((f"not ({LATE})", LATE)):
        stage_lines(recharge_log(events.where(some)), f"{root}/source/part{b}")
        stream = _notify_stream(spark, sf_dir, f"{root}/source/*", None)
        run_to_end(watermarked_totals(stream, N.daily_totals, f"{root}/out", f"{root}/checkpoint",
                                      ("day", "yyyyMMdd", f"{LATE_DAYS} days")), TIMEOUT)
    late = late_rows(spark, f"{root}/out").groupBy("day").agg(F.count("*").alias("late"))
    both = read_totals(spark, f"{root}/out", ["day"]).join(late, "day", "full")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return both.select("day", zero("total"), zero("late"))


NEW_CODE = 25


def q_quarantine_redrive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The odd log's messages of one unknown province run again, once, when the dimension has it."""
    use_utc(spark)
    root = work_dir(spark, "redrive")
    stage_lines(recharge_log(load_table(spark, sf_dir, "events"), odd=True), f"{root}/source/a")
    run_to_end(A.notify_app(read_lines_stream(spark, f"{root}/source/*"), dim(spark, sf_dir), f"{root}/out",
                            f"{root}/checkpoint", trigger=None), TIMEOUT)
    grown = dim(spark, sf_dir).unionByName(spark.createDataFrame([(str(NEW_CODE), "ADDED LATER")], "province_code string, province string"))
    A.redrive_notify(spark, f"{root}/out", grown)
    A.redrive_notify(spark, f"{root}/out", grown)
    done = A.notify_results(spark, f"{root}/out")["province_hour_failures"]
    left = (A.read_quarantine(spark, f"{root}/out").groupBy("reason").agg(F.count("*").cast("bigint").alias("failures"))
            .select(F.col("reason").alias("province"), F.lit("quarantine").alias("hour"), "failures"))
    return done.unionByName(left)


def q_stream_ods_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: the ODS detail, written by a stream of three batches."""
    root = work_dir(spark, "ods")
    per_trigger = stage_in_batches(spark, rlog(spark, sf_dir), f"{root}/source", 3)
    stream = read_lines_stream(spark, f"{root}/source", per_trigger)
    run_to_end(A.ods_app(stream, dim(spark, sf_dir), f"{root}/out", f"{root}/checkpoint", trigger=None), TIMEOUT)
    return A.read_ods(spark, f"{root}/out").drop("batch_id")


STREAM_QUERIES = {
    "stream_ods_detail": q_stream_ods_detail,
    "stream_compact_idle": q_stream_compact_idle,
    "stream_snapshot_totals": q_stream_snapshot_totals,
    "stream_late_rows": q_stream_late_rows,
    "quarantine_redrive": q_quarantine_redrive,
    "stream_batch_top10": _per_batch("batch_top10_province"),
    "stream_batch_hour_failures": _per_batch("batch_province_hour_failures"),
    "stream_compact_totals": _compacted("daily_totals"),
    "stream_compact_batches": _compacted("batch_hourly_totals"),
    "stream_read_log": q_stream_read_log,
    "stream_daily_totals": _running(N.daily_totals, ["day"], rlog, _clean_notify_stream),
    "stream_minute_orders": _running(N.minute_orders, ["minute"], rlog, _clean_notify_stream),
    "stream_month_phone_avg": _running(T.month_phone_avg, ["month", "phone"], tlog,
                                       _clean_topup_stream),
    "stream_day_top10": q_stream_day_top10,
    "stream_resume": q_stream_resume,
    "stream_notify_app": _app(A.notify_app, A.notify_results, "province_hour_failures", rlog),
    "stream_request_app": _app(A.request_app, A.request_results, "province_minute", rlog),
    "stream_topup_app": _app(A.topup_app, A.topup_results, "phone_mean_monthly", tlog,
                             with_dim=False),
}

_BATCHED = f"""c AS (
  SELECT e.event_id % {PARTS} AS batch_id, e.ts, n.n_name AS province, CAST(e.value AS DECIMAL(18,2)) AS fee,
         (e.event_type <> 'error' AND e.event_id % 5 <> 0) AS ok
  FROM events e JOIN nation n ON n.n_nationkey = e.user_id % 25
  WHERE e.event_type IN ('purchase','error') AND e.event_id % 11 <> 0)"""

STREAM_ORACLE = {
    "stream_ods_detail": ORACLE["ods_detail"],
    "stream_compact_idle": f"""WITH {_BATCHED}
SELECT batch_id, strftime(ts, '%Y%m%d%H') AS hour, count(*) AS orders,
       CAST(sum(CASE WHEN ok THEN fee ELSE 0 END) AS DECIMAL(18,2)) AS money FROM c GROUP BY 1, 2""",
    "stream_snapshot_totals": ORACLE["daily_totals"],
    "stream_late_rows": f"""WITH c AS (
  SELECT date_trunc('day', ts) AS d, {LATE} AS second FROM events
  WHERE event_type IN ('purchase','error') AND event_id % 11 <> 0),
w AS (SELECT *, (SELECT max(d) FROM c WHERE NOT second) - INTERVAL {LATE_DAYS} DAY AS mark FROM c)
SELECT strftime(d, '%Y%m%d') AS day, count(*) FILTER (NOT second OR d > mark) AS total,
       count(*) FILTER (second AND d <= mark) AS late FROM w GROUP BY 1""",
    "quarantine_redrive": f"""WITH e AS (
  SELECT e.ts, e.event_type, e.event_id, {_REASON} AS reason,
         CASE WHEN e.user_id % 27 = {NEW_CODE} THEN 'ADDED LATER' ELSE n.n_name END AS province,
         e.user_id % 27 AS code, (e.event_type <> 'error' AND e.event_id % 5 <> 0) AS ok
  FROM events e LEFT JOIN nation n ON n.n_nationkey = e.user_id % 27)
SELECT province, strftime(ts, '%Y%m%d%H') AS hour, CAST(sum(CASE WHEN ok THEN 0 ELSE 1 END) AS BIGINT) AS failures
FROM e WHERE event_type IN ('purchase','error') AND event_id % 11 <> 0
  AND (reason IS NULL OR (reason = 'unknown_province' AND code = {NEW_CODE})) GROUP BY 1, 2
UNION ALL
SELECT reason, 'quarantine', count(*) FROM e
WHERE reason IS NOT NULL AND NOT (reason = 'unknown_province' AND code = {NEW_CODE}) GROUP BY 1""",
    "stream_read_log": f"SELECT {_RID} AS request_id, {_NAME} AS service_name FROM events e",
    "stream_daily_totals": ORACLE["daily_totals"],
    "stream_minute_orders": ORACLE["minute_orders"],
    "stream_month_phone_avg": ORACLE["month_phone_avg"],
    "stream_resume": ORACLE["daily_totals"],
    "stream_notify_app": ORACLE["province_hour_failures"],
    "stream_request_app": ORACLE["province_minute"],
    "stream_topup_app": ORACLE["phone_mean_monthly"],
    "stream_batch_top10": f"""WITH {_BATCHED},
s AS (SELECT batch_id, province, CAST(sum(CASE WHEN ok THEN 1 ELSE 0 END) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS success_rate,
             count(*) AS orders FROM c GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY batch_id ORDER BY orders DESC, province ASC) AS BIGINT) AS rank FROM s)
SELECT batch_id, province, success_rate, orders, rank FROM r WHERE rank <= 10""",
    "stream_batch_hour_failures": f"""WITH {_BATCHED}
SELECT batch_id, province, strftime(ts, '%Y%m%d%H') AS hour,
       CAST(sum(CASE WHEN ok THEN 0 ELSE 1 END) AS BIGINT) AS failures FROM c GROUP BY 1, 2, 3""",
    "stream_compact_totals": ORACLE["daily_totals"],
    "stream_compact_batches": f"""WITH {_BATCHED}
SELECT batch_id + 1 AS batch_id, strftime(ts, '%Y%m%d%H') AS hour, count(*) AS orders,
       CAST(sum(CASE WHEN ok THEN fee ELSE 0 END) AS DECIMAL(18,2)) AS money FROM c GROUP BY 1, 2""",
    "stream_day_top10": """WITH c AS (
  SELECT e.ts, n.n_name AS province, (e.event_type <> 'error' AND e.event_id % 5 <> 0) AS ok
  FROM events e JOIN nation n ON n.n_nationkey = e.user_id % 25
  WHERE e.event_type IN ('purchase','error') AND e.event_id % 11 <> 0),
s AS (SELECT strftime(ts, '%Y%m%d') AS day, province, count(*) AS orders,
             CAST(sum(CASE WHEN ok THEN 1 ELSE 0 END) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS success_rate
      FROM c GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY day ORDER BY orders DESC, province ASC) AS BIGINT) AS rank
      FROM s)
SELECT day, rank, province, success_rate, orders FROM r WHERE rank <= 10""",
}
