"""Message gates (predicates over parsed STRING columns).

The business gate is the rule as the notify app wrote it: it already demands
business success, so failures never reach the failure KPIs.  The interface
gate (default) keeps business failures so that they can be counted.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from chargepulse.functions.values import OK_CODE

# The service names the gates look for.
NOTIFY = "reChargeNotifyReq"
REQUEST = "sendRechargeReq"


def _is(name_col: str, name: str, ignore_case: bool) -> Column:
    c = F.col(name_col)
    return (F.lower(c) == name.lower()) if ignore_case else (c == name)


def notify_business_gate() -> Column:
    """notify name (any case) and ``bussinessRst`` = 0000."""
    return F.coalesce(_is("serviceName", NOTIFY, True) & (F.col("bussinessRst") == OK_CODE),
                      F.lit(False))


def notify_interface_gate() -> Column:
    """Notify name (any case) and ``interFacRst`` = 0000."""
    return F.coalesce(_is("serviceName", NOTIFY, True) & (F.col("interFacRst") == OK_CODE),
                      F.lit(False))


def notify_ods_gate() -> Column:
    """notify name, exact case, and ``interFacRst`` = 0000."""
    return F.coalesce(_is("serviceName", NOTIFY, False) & (F.col("interFacRst") == OK_CODE),
                      F.lit(False))


def request_gate() -> Column:
    """request name (any case) and ``interFacRst`` = 0000."""
    return F.coalesce(_is("serviceName", REQUEST, True) & (F.col("interFacRst") == OK_CODE),
                      F.lit(False))


def notify_gate(gate: str = "interface") -> Column:
    if gate == "interface":
        return notify_interface_gate()
    if gate == "business":
        return notify_business_gate()
    if gate == "ods":
        return notify_ods_gate()
    raise ValueError(f"unknown gate {gate!r}")
