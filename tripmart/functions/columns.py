"""Column -> Column helpers. All are built-in expressions, so they stay in generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart.contracts import BORO_LABEL, GREEN_LABEL, NUMERIC, PAYMENT_TYPES


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_integer(c: Column | str) -> Column:
    """64-bit integer, halves rounded away from zero.

    A bare cast truncates, and ``round`` goes through a decimal object per value; this
    steps the truncated value instead, exactly, in primitive arithmetic.
    """
    value = _column(c)
    whole = value.cast("bigint")
    rest = value - whole
    return whole + F.when(rest >= 0.5, 1).when(rest <= -0.5, -1).otherwise(0)


def to_numeric(c: Column | str) -> Column:
    """Exact decimal with nine digits after the point."""
    return _column(c).cast(NUMERIC)


def to_wall_clock(c: Column | str) -> Column:
    """Timestamp without zone, so no later step depends on the session zone."""
    return _column(c).cast("timestamp_ntz")


def utc_wall_clock(c: Column | str) -> Column:
    """Zone-free UTC reading of an instant (``timestamp``), whatever the session zone."""
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(_column(c)), epoch)


def pickup_date(c: Column | str) -> Column:
    return F.to_date(_column(c))


def month_start(c: Column | str) -> Column:
    """First instant of the month. Goes through DATE because ``date_trunc`` returns a
    session-zone timestamp even for zone-free input."""
    return F.trunc(F.to_date(_column(c)), "month").cast("timestamp_ntz")


def month_label(c: Column | str, separator: str = "-") -> Column:
    """``2019-01`` (file names) or, with ``_``, ``2019_01`` (table names)."""
    return F.date_format(F.to_date(_column(c)), f"yyyy{separator}MM")


def surrogate_key(*fields: Column | str) -> Column:
    """MD5 hex of the fields as text joined by ``-``; NULL counts as empty text.

    ``concat_ws`` would drop NULL fields and make ``(a, NULL)`` collide with ``(a)``.
    """
    texts = [F.coalesce(_column(f).cast("string"), F.lit("")) for f in fields]
    joined = reduce(lambda left, right: F.concat(left, F.lit("-"), right), texts)
    return F.md5(joined)


def payment_type_description(c: Column | str) -> Column:
    """Label of a payment code; unlisted and NULL codes give NULL."""
    code = _column(c)
    return reduce(lambda case, pair: case.when(code == pair[0], pair[1]), PAYMENT_TYPES.items(), F)


def service_zone_label(c: Column | str) -> Column:
    return F.replace(_column(c), F.lit(BORO_LABEL), F.lit(GREEN_LABEL))


def constant(value: object, dtype: str) -> Column:
    return F.lit(value).cast(dtype)
