"""Time buckets and elapsed times over digit strings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the 17-digit message time layout, yyyyMMddHHmmssSSS.
TIME_DIGITS = 17


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def prefix(c, n: int) -> Column:
    """The first ``n`` characters (8 = day, 10 = hour, 12 = minute; ISO 7 = month, 10 = day)."""
    return F.substring(_c(c), 1, n)


def middle(c, start0: int, end0: int) -> Column:
    """Characters ``start0`` (inclusive) to ``end0`` (exclusive), zero-based."""
    return F.substring(_c(c), start0 + 1, end0 - start0)


def has_time_digits(c) -> Column:
    """True when ``c`` starts with 17 digits."""
    return F.coalesce(_c(c).rlike(r"^[0-9]{17}"), F.lit(False))


def digits_to_ts(c) -> Column:
    """First 17 digits ``yyyyMMddHHmmssSSS`` to a timestamp; NULL if short or not a date.

    The compact pattern cannot be parsed directly (adjacent-value parsing of the
    fraction fails), so a dot is put before the milliseconds.
    """
    c = _c(c)
    text = F.concat(F.substring(c, 1, 14), F.lit("."), F.substring(c, 15, 3))
    ts = F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss.SSS"))
    return F.when(has_time_digits(c), ts)


def elapsed_ms(start_id, stop) -> Column:
    """Milliseconds from the time in the first 17 digits of ``start_id`` to ``stop``.

    May be negative (stop before start); NULL when either side is not a time.
    """
    return F.unix_millis(digits_to_ts(stop)) - F.unix_millis(digits_to_ts(start_id))


def iso_day_ok(c) -> Column:
    """True when ``c`` begins with an ISO date ``yyyy-MM-dd`` that exists."""
    c = _c(c)
    return F.coalesce(c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}")
                      & F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd").isNotNull(),
                      F.lit(False))


def month_span(first_month, last_month) -> Column:
    """Inclusive count of months from ``first_month`` to ``last_month`` (both ``yyyy-MM``)."""
    a, b = _c(first_month), _c(last_month)
    year = lambda m: F.substring(m, 1, 4).cast("int")
    mon = lambda m: F.substring(m, 6, 2).cast("int")
    return ((year(b) - year(a)) * 12 + (mon(b) - mon(a)) + 1).cast("bigint")
