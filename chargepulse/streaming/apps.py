"""The three streaming applications, one Structured Streaming query each.

* notify app  -- recharge-notify messages -> M1-M5
* request app -- recharge-request messages -> M6-M8
* top-up app  -- personal top-ups -> M9, M10, A7

Each micro-batch is parsed and cleaned once (persisted while in use).  Its
rows are reduced to additive partial sums at the finest grain any KPI needs
and appended under the batch's ``batch_id``; quarantined messages go to their
own table.  Both writes are dynamic partition overwrites, so a replayed batch
replaces its own output.  Every KPI is then a roll-up over those partials:

* running totals (the reference's counters) = roll-up over all batches;
* per-batch results (the reference's appended rows, top-N "of this batch")
  = roll-up keyed by ``batch_id``.

The partials are bounded by the grain (provinces x minutes for notify and
request; months x phones for top-ups), not by message volume, and a source
is read once per batch however many KPIs there are.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from chargepulse import storage
from chargepulse.operators import clean as C
from chargepulse.operators.spread import spread
from chargepulse.plans import notify as N, request as R, topup as T
from chargepulse.plans.detail import by_bytes
from chargepulse.plans.rollup import rollup
from chargepulse.session import setting
from chargepulse.streaming.published import claim_output, foldable, newest_published
from chargepulse.streaming.sinks import BATCH_COL, Recorded, _overwrite_batch, counted, fold_positions

UNKNOWN = "unknown_province"


def _describe(spark: SparkSession, root: str, rows: Callable[[DataFrame], DataFrame],
              results: Callable[[DataFrame], DataFrame]) -> None:
    if storage.exists(spark, f"{root}/_quarantine_schema"):   # the second of the two
        return
    empty = rows(spark.createDataFrame([], "value string"))
    storage.write_text(spark, f"{root}/_schema", results(C.good(empty)).schema.json())
    storage.write_text(spark, f"{root}/_quarantine_schema", C.quarantined(empty).schema.json())


class _AppBatch:
    """``foreachBatch`` body: rows-with-reason -> partials + quarantine.

    ``spread_to`` deals a micro-batch that arrives in few partitions (one large file, one topic
    partition) to so many before the per-message work; by default it stays as read.
    """

    def __init__(self, root: str, rows: Callable[[DataFrame], DataFrame],
                 partials: Callable[[DataFrame], DataFrame], spread_to: int | None = None):
        self.root = root.rstrip("/")
        self.rows = rows
        self.partials = partials
        self.spread_to = spread_to

    def describe(self, spark: SparkSession) -> None:
        """Store the types of both tables, so that an app that has no batch yet has empty results."""
        _describe(spark, self.root, self.rows, self.partials)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.describe(batch.sparkSession)
        rows = self.rows(spread(batch, self.spread_to)).persist()
        try:
            part = self.partials(C.good(rows))
            _overwrite_batch(part, f"{self.root}/partials", batch_id)
            _overwrite_batch(C.quarantined(rows), f"{self.root}/quarantine", batch_id)
        finally:
            rows.unpersist()


# --------------------------------------------------------------- compaction --
#
# partials/batch_id=N          the sums of batch N, until a compaction folds it
# folded/upto=U/batches        the folded rows with their batch_id, in few files
# folded/upto=U/totals         sums over all batches <= U
# folded/_done/U               marker, written last; what has none does not count
# redriven/run=R/partials      sums of quarantined messages that found their province, with their batch_id
# redriven/run=R/codes         the provinces that run R knew
# redriven/_done/R             marker, written last: the newest batch that run R looked at

def _schema(spark: SparkSession, root: str, name: str = "_schema") -> StructType:
    return StructType.fromJson(json.loads(storage.read_text(spark, f"{root}/{name}")))


def _done(spark: SparkSession, root: str, kind: str = "folded") -> list[int]:
    return sorted(int(n) for n in storage.children(spark, f"{root}/{kind}/_done"))


def _table(spark: SparkSession, paths: list[str], schema: StructType) -> DataFrame:
    paths = [p for p in paths if storage.exists(spark, p)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _with_batch(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(BATCH_COL, LongType())])


def _live(spark: SparkSession, root: str, after: int) -> DataFrame:
    """Partials of the batches that count and that no published compaction has folded."""
    return counted(_table(spark, [f"{root}/partials"], _with_batch(_schema(spark, root))), root, after)


def _sums(rows: DataFrame) -> DataFrame:
    measures = [c for c in ("orders", "money", "success", "costtime") if c in rows.columns]
    grain = [c for c in rows.columns if c not in measures]
    return rows.groupBy(*grain).agg(*[F.sum(m).cast(rows.schema[m].dataType).alias(m) for m in measures])


def compact(spark: SparkSession, root: str, upto: int | None = None) -> int:
    """Fold committed batches (not beyond ``upto``, if given) into running sums and one table of their per-batch rows.

    Spark's commit log in the checkpoint that owns ``root`` says which batches are final; a batch beyond the newest
    committed one is never folded, whatever ``upto``.  Nothing counts before its marker is written, and what
    a marker covers is never read from ``partials`` again, so a compaction that dies half-way
    changes no result; running it again completes it.  What it folds is removed by the next call, so results
    that were built before it still find their files.  Returns the newest folded batch, -1 if none.
    """
    root = root.rstrip("/")
    done, upto = _done(spark, root), foldable(spark, root, upto)
    low = done[-1] if done else -1
    if upto > low:
        schema = _schema(spark, root)
        new = _live(spark, root, low).where(F.col(BATCH_COL) <= upto)
        at = f"{root}/folded/upto={upto}"
        new.hint("rebalance").write.mode("overwrite").parquet(f"{at}/batches")
        base = _table(spark, [f"{root}/folded/upto={low}/totals"], schema)
        _sums(base.unionByName(new.drop(BATCH_COL))).write.mode("overwrite").parquet(f"{at}/totals")
        storage.write_text(spark, f"{root}/folded/_done/{upto}", str(low))
        done.append(upto)
    for name in storage.children(spark, f"{root}/partials"):
        if name.startswith(f"{BATCH_COL}=") and int(name.split("=")[1]) <= low:
            storage.delete(spark, f"{root}/partials/{name}")
    for old in done[:-2]:
        storage.delete(spark, f"{root}/folded/upto={old}/totals")
    if done:
        fold_positions(spark, root, done[-1])
    return done[-1] if done else -1


def _redriven(spark: SparkSession, root: str) -> DataFrame:
    """Sums of re-driven messages, under the batch that brought them."""
    paths = [f"{root}/redriven/run={r}/partials" for r in _done(spark, root, "redriven")]
    return counted(_table(spark, paths, _with_batch(_schema(spark, root))), root)


def read_partials(spark: SparkSession, root: str) -> DataFrame:
    """Rows whose sums are the running totals: the newest folded sums, live partials and re-driven messages."""
    root = root.rstrip("/")
    done = _done(spark, root)
    live = _live(spark, root, done[-1] if done else -1).unionByName(_redriven(spark, root)).drop(BATCH_COL)
    return live if not done else _table(spark, [f"{root}/folded/upto={done[-1]}/totals"], _schema(spark, root)).unionByName(live)


def read_batch_partials(spark: SparkSession, root: str) -> DataFrame:
    """The partials of every batch, folded or not, with their ``batch_id``."""
    root = root.rstrip("/")
    done = _done(spark, root)
    live = _live(spark, root, done[-1] if done else -1).unionByName(_redriven(spark, root))
    return _table(spark, [f"{root}/folded/upto={u}/batches" for u in done], live.schema).unionByName(live)


# ------------------------------------------------------------- quarantine --

def _driven_codes(spark: SparkSession, root: str) -> DataFrame:
    """``(_code, _upto)``: for each province that a run knew, the newest batch whose messages it took."""
    known = spark.createDataFrame([], "_code string, _upto bigint")
    for r in _done(spark, root, "redriven"):
        upto = int(storage.read_text(spark, f"{root}/redriven/_done/{r}"))
        codes = spark.read.schema("provinceCode string").parquet(f"{root}/redriven/run={r}/codes")
        known = known.unionByName(codes.select(F.col("provinceCode").alias("_code"), F.lit(upto).cast("bigint").alias("_upto")))
    return known.groupBy("_code").agg(F.max("_upto").alias("_upto"))


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """Messages still in quarantine, of the batches that count, with ``reason`` and ``batch_id``."""
    root = root.rstrip("/")
    rows = counted(_table(spark, [f"{root}/quarantine"], _with_batch(_schema(spark, root, "_quarantine_schema"))), root)
    if "province_code" not in rows.columns:
        return rows
    driven = _driven_codes(spark, root)
    gone = (rows["reason"] == UNKNOWN) & (rows["province_code"] == driven["_code"]) & (rows[BATCH_COL] <= driven["_upto"])
    return rows.join(driven, gone, "left_anti")


def _redrive(spark: SparkSession, root: str, dim: DataFrame, rows: Callable[[DataFrame], DataFrame],
             partials: Callable[[DataFrame], DataFrame]) -> int:
    root = root.rstrip("/")
    upto = newest_published(spark, root)
    codes = C.province_lookup(dim).select("provinceCode")
    parked = read_quarantine(spark, root).where((F.col("reason") == UNKNOWN) & (F.col(BATCH_COL) <= upto))
    todo = parked.join(codes, parked["province_code"] == codes["provinceCode"], "left_semi").select("value", BATCH_COL)
    run = max(_done(spark, root, "redriven"), default=-1) + 1
    at = f"{root}/redriven/run={run}"
    partials(C.good(rows(todo))).write.mode("overwrite").parquet(f"{at}/partials")
    n = spark.read.parquet(f"{at}/partials").agg(F.sum("orders")).first()[0] or 0
    if n:
        codes.write.mode("overwrite").parquet(f"{at}/codes")
        storage.write_text(spark, f"{root}/redriven/_done/{run}", str(upto))
    return int(n)


def _start(log_stream: DataFrame, body: _AppBatch, checkpoint: str,
           trigger: str | None) -> StreamingQuery:
    claim_output(log_stream.sparkSession, body.root, checkpoint)
    body.describe(log_stream.sparkSession)
    w = log_stream.writeStream.foreachBatch(Recorded(body, body.root, checkpoint)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger in (None, "availableNow") \
        else w.trigger(processingTime=trigger)
    return w.start()


# ----------------------------------------------------------------- notify --

def notify_partials(clean: DataFrame, more=()) -> DataFrame:
    return rollup(clean, ["province", "minute", *more], ["money", "success", "costtime"])


def notify_app(log_stream: DataFrame, dim: DataFrame, root: str, checkpoint: str,
               trigger: str | None = "2 seconds", gate: str = "interface",
               mode: str = "quarantine", spread_to: int | None = None) -> StreamingQuery:
    """Notify messages -> ``root/partials`` (province, minute sums) + ``root/quarantine``.

    ``mode="strict"`` fails the batch (and the query) on a bad message instead.
    """
    side = C.province_lookup(dim)
    body = _AppBatch(root, lambda b: C.enforce(C.notify_rows(b, side, gate), mode), notify_partials, spread_to)
    return _start(log_stream, body, checkpoint, trigger)


def redrive_notify(spark: SparkSession, root: str, dim: DataFrame, gate: str = "interface") -> int:
    """Run the quarantined messages of unknown provinces again, those whose code ``dim`` has now.

    Each such message is added once to the results, under the batch that brought it, and leaves the quarantine; the run
    counts once its marker is written.  A second run with the same dimension finds nothing.  Returns their number.
    One run at a time.  A message whose code is still unknown stays.
    """
    side = C.province_lookup(dim)
    return _redrive(spark, root, dim, lambda rows: C.notify_rows(rows, side, gate, carry=(BATCH_COL,)),
                    lambda clean: notify_partials(clean, (BATCH_COL,)))


def _with_times(p: DataFrame) -> DataFrame:
    return p.withColumns({"hour": F.substring("minute", 1, 10), "day": F.substring("minute", 1, 8)})


def _top_per_batch(s: DataFrame, n: int, by: str, tie: str) -> DataFrame:
    w = Window.partitionBy(BATCH_COL).orderBy(F.col(by).desc(), F.col(tie).asc())
    return s.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= n)


def notify_results(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Running M1, M2 and per-batch M3-M5 (plus their running forms)."""
    p = _with_times(read_partials(spark, root))
    b = _with_times(read_batch_partials(spark, root))
    per_batch_top10 = rollup(b, [BATCH_COL, "province"], ["success"]).select(
        BATCH_COL, "province", (F.col("success") / F.col("orders")).alias("success_rate"), "orders")
    return {
        "daily_totals": N.daily_totals(p),
        "minute_orders": N.minute_orders(p),
        "province_hour_failures": N.province_hour_failures(p),
        "top10_province": N.top10_province(p),
        "hourly_totals": N.hourly_totals(p),
        "batch_province_hour_failures": rollup(b, [BATCH_COL, "province", "hour"], ["success"])
        .select(BATCH_COL, "province", "hour",
                (F.col("orders") - F.col("success")).cast("bigint").alias("failures")),
        "batch_top10_province": _top_per_batch(per_batch_top10, 10, "orders", "province"),
        "batch_hourly_totals": rollup(b, [BATCH_COL, "hour"], ["money"]),
    }


# -------------------------------------------------------------------- ods --

class _DetailBatch:
    """``foreachBatch`` body: ODS detail rows by date, and quarantine."""

    def __init__(self, root: str, dim: DataFrame, mode: str, spread_to: int | None):
        self.root, self.side, self.mode, self.spread_to = root.rstrip("/"), C.province_lookup(dim), mode, spread_to

    def rows(self, lines: DataFrame) -> DataFrame:
        return C.enforce(C.notify_rows(lines, self.side, "ods"), self.mode)

    def describe(self, spark: SparkSession) -> None:
        _describe(spark, self.root, self.rows, C.ods_columns)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        self.describe(spark)
        rows = self.rows(spread(batch, self.spread_to)).persist()
        try:
            # A stream's own session has AQE off, for its state; this write has none and needs the measured sizes.
            with setting(spark, {"spark.sql.adaptive.enabled": "true"}):
                detail = by_bytes(C.ods_columns(C.good(rows)), "date").withColumn(BATCH_COL, F.lit(batch_id).cast("bigint"))
                (detail.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("date", BATCH_COL).parquet(f"{self.root}/detail"))
                _overwrite_batch(C.quarantined(rows), f"{self.root}/quarantine", batch_id)
        finally:
            rows.unpersist()


def ods_app(log_stream: DataFrame, dim: DataFrame, root: str, checkpoint: str, trigger: str | None = "2 seconds",
            mode: str = "quarantine", spread_to: int | None = None) -> StreamingQuery:
    """P5 as a stream: notify messages -> ``root/detail`` (ODS rows by date and batch) + ``root/quarantine``.

    A date's files are sized by its bytes in the batch, so a hot date is written by as many tasks as it needs.
    """
    return _start(log_stream, _DetailBatch(root, dim, mode, spread_to), checkpoint, trigger)


def read_ods(spark: SparkSession, root: str, first_date: str | None = None, last_date: str | None = None) -> DataFrame:
    """The detail rows of the batches that count, with their ``batch_id``; dates outside the bounds are not read."""
    root = root.rstrip("/")
    rows = counted(_table(spark, [f"{root}/detail"], _with_batch(_schema(spark, root))), root)
    if first_date:
        rows = rows.where(F.col("date") >= first_date)
    return rows.where(F.col("date") <= last_date) if last_date else rows


# ---------------------------------------------------------------- request --

def request_partials(clean: DataFrame, more=()) -> DataFrame:
    return rollup(clean, ["province", "minute", *more], ["money", "success"])


def redrive_request(spark: SparkSession, root: str, dim: DataFrame) -> int:
    """As :func:`redrive_notify`, for the request app."""
    side = C.province_lookup(dim)
    return _redrive(spark, root, dim, lambda rows: C.request_rows(rows, side, carry=(BATCH_COL,)),
                    lambda clean: request_partials(clean, (BATCH_COL,)))


def request_app(log_stream: DataFrame, dim: DataFrame, root: str, checkpoint: str,
                trigger: str | None = "2 seconds", mode: str = "quarantine",
                spread_to: int | None = None) -> StreamingQuery:
    side = C.province_lookup(dim)
    body = _AppBatch(root, lambda b: C.enforce(C.request_rows(b, side), mode), request_partials, spread_to)
    return _start(log_stream, body, checkpoint, trigger)


def request_results(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    p = _with_times(read_partials(spark, root))
    b = _with_times(read_batch_partials(spark, root))
    fails = rollup(b, [BATCH_COL, "province"], ["success"]).select(
        BATCH_COL, "province", (F.col("orders") - F.col("success")).cast("bigint").alias("failures"),
        ((F.col("orders") - F.col("success")) / F.col("orders")).alias("failure_rate"))
    return {
        "top3_failure_province": R.top3_failure_province(p),
        "province_minute": R.province_minute(p),
        "province_hour": R.province_hour(p),
        "batch_top3_failure_province": _top_per_batch(fails, 3, "failures", "province"),
        "batch_province_minute": rollup(b, [BATCH_COL, "minute", "province"], ["money"]),
        "batch_province_hour": rollup(b, [BATCH_COL, "hour", "province"], ["money"]),
    }


# ----------------------------------------------------------------- top-up --

def topup_partials(clean: DataFrame) -> DataFrame:
    return T.topup_base(clean)


def topup_app(log_stream: DataFrame, root: str, checkpoint: str,
              trigger: str | None = "2 seconds", mode: str = "quarantine",
              spread_to: int | None = None) -> StreamingQuery:
    body = _AppBatch(root, lambda b: C.enforce(C.topup_rows(b), mode), topup_partials, spread_to)
    return _start(log_stream, body, checkpoint, trigger)


def topup_results(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    p = read_partials(spark, root)
    return {
        "topup_daily_money": T.topup_daily_money(p),
        "month_phone_avg": T.month_phone_avg(p),
        "phone_mean_monthly": T.phone_mean_monthly(p),
    }
