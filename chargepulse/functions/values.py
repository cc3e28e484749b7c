"""Amounts, conditional values, truncation, key building."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The result code meaning "ok", and the money type.
OK_CODE = "0000"
MONEY = "decimal(18,2)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: Largest amounts of a message, either sign.  Sums of ten million messages at these limits stay
#: inside DECIMAL(18,2) and BIGINT; partial sums are wider still.
MOST_MONEY = 1_000_000_000
MOST_TOPUP = 100_000_000_000


def amount(c) -> Column:
    """Text amount to DECIMAL(18,2); NULL when not a number or beyond :data:`MOST_MONEY`.

    The empty string is 0, as a getter with coercion reads it; digit groups (``1,000``) are no number.
    """
    n = F.when(F.trim(_c(c)) == "", F.lit(0).cast(MONEY)).otherwise(_c(c).try_cast(MONEY))
    return F.when(F.abs(n) <= MOST_MONEY, n)


def whole_amount(c) -> Column:
    """Integer amount of a top-up; NULL when not a number or beyond :data:`MOST_TOPUP`.

    A fraction is cut off toward zero (``100.5`` is 100), the empty string is 0.
    """
    n = F.when(F.trim(_c(c)) == "", F.lit(0).cast("decimal(38,6)")).otherwise(_c(c).try_cast("decimal(38,6)"))
    return F.when(F.abs(n) <= MOST_TOPUP, n.cast("bigint"))


def when_ok(ok: Column, value, zero=0) -> Column:
    """``value`` when ``ok`` else ``zero``."""
    v = _c(value) if isinstance(value, (str, Column)) else F.lit(value)
    return F.when(ok, v).otherwise(F.lit(zero))


def trunc_long(c) -> Column:
    """X11: toward-zero truncation to BIGINT."""
    return _c(c).cast("bigint")


def ratio(num, den) -> Column:
    """A4: ``num / den`` as DOUBLE."""
    return _c(num).cast("double") / _c(den).cast("double")


def counter_key(month, phone) -> Column:
    """The ``"yyyy-MM phone"`` key of the per-phone average."""
    return F.concat_ws(" ", _c(month), _c(phone))


def month_of_year(month) -> Column:
    """``"2018-09"`` -> ``"09"`` (split on ``-``, element 1)."""
    return F.split(_c(month), "-").getItem(1)
