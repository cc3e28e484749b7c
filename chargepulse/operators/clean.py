"""P1-P5 + J1 + quarantine: from raw message lines to clean, typed rows.

Each ``*_rows`` function returns the gated rows with a ``reason`` column (NULL
for good rows).  ``good`` keeps the clean ones, ``quarantined`` the others, so
one parse feeds both outputs.  In ``mode="strict"`` a bad row fails the job
instead, as the reference's stream did.

Reasons, checked in this order: ``bad_json``, ``missing_service``,
``missing_result``, ``missing_phone``, ``bad_amount``, ``bad_time``,
``unknown_province``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chargepulse.functions.messages import NOTIFY_FIELDS, REQUEST_FIELDS, TOPUP_FIELDS, parse_json
from chargepulse.functions.times import digits_to_ts, elapsed_ms, iso_day_ok, middle, prefix
from chargepulse.functions.values import (
    OK_CODE, amount, month_of_year, when_ok, whole_amount,
)
from chargepulse.operators.gates import NOTIFY, REQUEST, notify_gate, request_gate
from chargepulse.operators.lookup import lookup_join


def _first(*cases: tuple[Column, str]) -> Column:
    out = None
    for cond, label in cases:
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def _pre_reason(name_matches: Column, result_col: str) -> Column:
    return _first((F.col("bad_json"), "bad_json"),
                  (F.col("serviceName").isNull(), "missing_service"),
                  (name_matches & F.col(result_col).isNull(), "missing_result"))


def _amount_reason(raw: str, needed: Column) -> Column:
    bad = (F.col(raw).isNotNull() & amount(raw).isNull()) | (needed & F.col(raw).isNull())
    return F.when(bad, F.lit("bad_amount"))


def enforce(rows: DataFrame, mode: str) -> DataFrame:
    """``quarantine``: keep bad rows (with their reason); ``strict``: fail on the first."""
    if mode == "quarantine":
        return rows
    if mode == "strict":
        fail = F.when(F.col("reason").isNotNull(),
                      F.raise_error(F.concat(F.lit("bad message: "), F.col("reason"))))
        return rows.where(fail.isNull())
    raise ValueError(f"unknown mode {mode!r}")


def province_lookup(dim: DataFrame) -> DataFrame:
    """The province dimension keyed for the join."""
    if "provinceCode" in dim.columns:
        return dim
    return dim.select(F.col("province_code").alias("provinceCode"), "province")


def _with_province(rows: DataFrame, dim: DataFrame) -> DataFrame:
    return lookup_join(rows, province_lookup(dim), "provinceCode", how="left")


def _raw_if_bad(reason: Column) -> Column:
    """The raw message, kept only for quarantined rows (a persisted batch of
    good rows then carries just the narrow clean columns)."""
    return F.when(reason.isNotNull(), F.col("value")).alias("value")


def good(rows: DataFrame) -> DataFrame:
    """Clean rows: no reason, and neither the reason nor the raw message."""
    keep = [c for c in rows.columns if c not in ("reason", "value")]
    return rows.where(F.col("reason").isNull()).select(*keep)


def quarantined(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reason").isNotNull())


# ---------------------------------------------------------------- notify --

def parse_notify(log: DataFrame, carry=()) -> DataFrame:
    """P1 + X1/X2: project and parse the notify fields (all STRING)."""
    return parse_json(log, NOTIFY_FIELDS, keep_value=True, carry=carry)


def notify_rows(log: DataFrame, dim: DataFrame, gate: str = "interface", carry=()) -> DataFrame:
    """Gated notify messages, cleaned (P2), with province (J1) and ``reason``; ``carry`` keeps columns of ``log``."""
    p = parse_notify(log, carry)
    name_ok = (F.col("serviceName") == NOTIFY) if gate == "ods" else \
        (F.lower("serviceName") == NOTIFY.lower())
    result_col = "bussinessRst" if gate == "business" else "interFacRst"
    pre = _pre_reason(name_ok, result_col)
    p = p.where(pre.isNotNull() | notify_gate(gate))
    ok = F.coalesce(F.col("bussinessRst") == OK_CODE, F.lit(False))
    rid = F.col("requestId")
    p = p.withColumns({
        "pre_reason": pre,
        "ok": ok,
        "amount_reason": _amount_reason("chargefee", ok),
        "costtime": elapsed_ms(rid, "receiveNotifyTime"),
    })
    j = _with_province(p, dim)
    reason = F.coalesce(
        F.col("pre_reason"), F.col("amount_reason"),
        F.when(F.col("costtime").isNull(), F.lit("bad_time")),
        F.when(F.col("province").isNull(), F.lit("unknown_province")))
    return j.select(
        _raw_if_bad(reason),
        rid.alias("request_id"),
        prefix(rid, 8).alias("day"),
        prefix(rid, 10).alias("hour"),
        prefix(rid, 12).alias("minute"),
        F.col("provinceCode").alias("province_code"),
        "province",
        F.col("ok").cast("bigint").alias("success"),
        when_ok(F.col("ok"), amount("chargefee"), 0).cast("decimal(18,2)").alias("money"),
        F.col("costtime"),
        *carry,
        reason.alias("reason"),
    )


def clean_notify(log: DataFrame, dim: DataFrame, gate: str = "interface",
                 mode: str = "quarantine") -> DataFrame:
    """``request_id, day, hour, minute, province_code, province, success, money, costtime``."""
    return good(enforce(notify_rows(log, dim, gate), mode))


def ods_detail(log: DataFrame, dim: DataFrame, mode: str = "quarantine") -> DataFrame:
    """P5: ODS detail rows, F3 gate; date, hour and minute as separate parts.

    ``success``, ``fee`` and ``ms`` are zeroed when the business result fails.
    """
    return ods_columns(good(enforce(notify_rows(log, dim, gate="ods"), mode)))


def ods_columns(clean: DataFrame) -> DataFrame:
    """The ODS detail columns of clean notify rows."""
    ok = F.col("success") == 1
    return clean.select(
        "request_id",
        prefix("request_id", 8).alias("date"),
        middle("request_id", 8, 10).alias("hour"),
        middle("request_id", 10, 12).alias("minute"),
        F.lit(1).cast("bigint").alias("orders"),
        "success",
        "money",
        when_ok(ok, F.col("costtime"), 0).cast("bigint").alias("ms"),
        "province_code",
        "province",
    )


# --------------------------------------------------------------- request --

def request_rows(log: DataFrame, dim: DataFrame, carry=()) -> DataFrame:
    """Gated (F2) request messages, cleaned (P3), with province and ``reason``; ``carry`` keeps columns of ``log``."""
    p = parse_json(log, REQUEST_FIELDS, keep_value=True, carry=carry)
    name_ok = F.lower("serviceName") == REQUEST.lower()
    pre = _pre_reason(name_ok, "interFacRst")
    p = p.where(pre.isNotNull() | request_gate())
    ok = F.coalesce(F.col("bussinessRst") == OK_CODE, F.lit(False))
    p = p.withColumns({
        "pre_reason": pre,
        "ok": ok,
        "amount_reason": F.coalesce(_amount_reason("chargefee", ok),
                                    _amount_reason("shouldfee", ok)),
        "start_ts": digits_to_ts("startReqTime"),
    })
    j = _with_province(p, dim)
    st = F.col("startReqTime")
    reason = F.coalesce(
        F.col("pre_reason"), F.col("amount_reason"),
        F.when(F.col("start_ts").isNull(), F.lit("bad_time")),
        F.when(F.col("province").isNull(), F.lit("unknown_province")))
    return j.select(
        _raw_if_bad(reason),
        st.alias("start_time"),
        prefix(st, 10).alias("hour"),
        prefix(st, 12).alias("minute"),
        F.col("provinceCode").alias("province_code"),
        "province",
        F.col("ok").cast("bigint").alias("success"),
        when_ok(F.col("ok"), amount("chargefee"), 0).cast("decimal(18,2)").alias("money"),
        when_ok(F.col("ok"), amount("shouldfee"), 0).cast("decimal(18,2)").alias("should_money"),
        *carry,
        reason.alias("reason"),
    )


def clean_request(log: DataFrame, dim: DataFrame, mode: str = "quarantine") -> DataFrame:
    """``start_time, hour, minute, province_code, province, success, money, should_money``."""
    return good(enforce(request_rows(log, dim), mode))


# ----------------------------------------------------------------- top-up --

def topup_rows(log: DataFrame) -> DataFrame:
    """Top-up messages, cleaned (P4), with ``reason``.  Missing ``money`` counts as 0."""
    p = parse_json(log, TOPUP_FIELDS, keep_value=True)
    money = whole_amount("money")
    reason = _first((F.col("bad_json"), "bad_json"),
                    (F.col("phoneNum").isNull(), "missing_phone"),
                    (F.col("money").isNotNull() & money.isNull(), "bad_amount"),
                    (~iso_day_ok("date"), "bad_time"))
    month = prefix("date", 7)
    return p.select(
        _raw_if_bad(reason),
        month.alias("month"),
        prefix("date", 10).alias("day"),
        F.col("phoneNum").alias("phone"),
        F.coalesce(money, F.lit(0).cast("bigint")).alias("money"),
        month_of_year(month).alias("month_of_year"),
        reason.alias("reason"),
    )


def clean_topup(log: DataFrame, mode: str = "quarantine") -> DataFrame:
    """``month, day, phone, money, month_of_year``."""
    return good(enforce(topup_rows(log), mode))
