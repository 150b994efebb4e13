"""Projections and filters over whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.contracts import RETENTION_DAYS, UNKNOWN_BOROUGH, Contract
from tripmart.functions import to_integer, utc_wall_clock

_INTEGRAL = {"tinyint", "smallint", "int", "bigint"}
_FRACTIONAL = ("double", "float", "decimal")


def conform(df: DataFrame, contract: Contract, nulled: Iterable[str] = ()) -> DataFrame:
    """Bind ``df`` to ``contract`` by column name, in contract order.

    Names match without regard to case. Fractional values entering an integer column are
    rounded, instants become UTC wall-clock times, and ``nulled`` columns are replaced by
    typed NULLs whatever the input holds (they may even be absent). A missing column
    raises rather than shifting its neighbours.
    """
    nulled = set(nulled)
    found = {name.lower(): (name, dtype) for name, dtype in df.dtypes}
    missing = [n for n in contract.names if n not in nulled and n.lower() not in found]
    if missing:
        raise ValueError(f"input lacks contract columns: {', '.join(missing)}")
    columns = []
    for name, dtype in contract.columns:
        if name in nulled:
            columns.append(F.lit(None).cast(dtype).alias(name))
        elif found[name.lower()] == (name, dtype):
            columns.append(name)
        else:
            columns.append(_bind(*found[name.lower()], dtype).alias(name))
    return df.select(*columns)


def bind(df: DataFrame, name: str, dtype: str) -> Column:
    """Column ``name`` of ``df`` as ``dtype``, by the rules of :func:`conform`."""
    found = {n.lower(): (n, t) for n, t in df.dtypes}
    return _bind(*found[name.lower()], dtype)


def _bind(name: str, source: str, target: str) -> Column:
    if target in _INTEGRAL and source.startswith(_FRACTIONAL):
        return to_integer(name).cast(target)
    if target == "timestamp_ntz" and source == "timestamp":
        return utc_wall_clock(name)
    return F.col(name) if source == target else F.col(name).cast(target)


def replace_with_null(df: DataFrame, *names: str) -> DataFrame:
    """The same columns in the same order and type, with ``names`` nulled."""
    types = dict(df.dtypes)
    return df.withColumns({n: F.lit(None).cast(types[n]) for n in names})


def known_zones(zones: DataFrame) -> DataFrame:
    """Zones with a usable borough; a NULL borough is as unusable as the Unknown label."""
    return zones.filter(F.col("borough") != UNKNOWN_BOROUGH)


def between_ts(df: DataFrame, ts: str, date: str, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Rows with ``start <= ts < end``.

    The date predicate is redundant for the result. It is there because a predicate on the
    timestamp alone cannot prune partitions of the date derived from it.
    """
    low, high = (F.lit(x.isoformat(sep=" ")).cast("timestamp_ntz") for x in (start, end))
    last_day = (end - dt.timedelta(microseconds=1)).date()
    return df.filter(
        F.col(date).between(F.lit(start.date()), F.lit(last_day)) & (F.col(ts) >= low) & (F.col(ts) < high)
    )


def unexpired(df: DataFrame, date: str, as_of: dt.date, days: int = RETENTION_DAYS) -> DataFrame:
    """Rows whose date is younger than ``days`` at ``as_of``. Undated rows never expire."""
    cutoff = as_of - dt.timedelta(days=days)
    return df.filter(F.col(date).isNull() | (F.col(date) > F.lit(cutoff)))
