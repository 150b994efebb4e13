"""Keep one row per key, by hash of the keys or by ranges of them."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_FLOATING = {"double", "float"}
_RANK, _HASH, _ROW = "__rank", "__key_hash", "__row"
_BUCKETS = 4096


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """The first row of every ``keys`` group; NULL keys form a group of their own.

    ``order`` defaults to all other columns, so two candidates can only tie when they are
    equal and the survivor does not depend on input order or partitioning.

    ``row_number() = 1`` lets Spark plan a ``WindowGroupLimit`` on both sides of the
    shuffle: every map task sends at most one row per key, so a key holding a large share
    of the table never lands whole in one reducer. The leading hash column changes no
    group; it gives the two sorts an eight-byte prefix that decides nearly every
    comparison, where e.g. a vendor id would tie almost always.
    """
    keys, rest = _split(df, keys)
    rest = rest if order is None else list(order)
    first = Window.partitionBy(_HASH, *keys).orderBy(*[F.col(c).asc_nulls_first() for c in rest or keys])
    return (
        df.withColumn(_HASH, _hash(df, keys))
        .withColumn(_RANK, F.row_number().over(first))
        .filter(F.col(_RANK) == 1)
        .drop(_RANK, _HASH)
    )


def keep_first_in_ranges(df: DataFrame, keys: Sequence[str], crowded: Collection[int] = ()) -> DataFrame:
    """The same rows as :func:`keep_first`, each task with those of one range of the keys.

    What is stored by a function that rises with the leading key, such as its month, then needs no second shuffle:
    a task meets few months, and a month with many rows is met by several tasks.

    A range holds all rows of its keys, so no group limit can go before this shuffle. Rows in the ``crowded`` buckets
    (see there) are therefore reduced to one per key by an aggregation first, which combines them per task.
    """
    keys, rest = _split(df, keys)
    if crowded:
        hot = _bucket(df, keys).isin(*crowded)
        least = df.filter(hot).groupBy(*keys).agg(F.min(F.struct(*(rest or keys))).alias(_ROW))
        df = df.filter(~hot).unionByName(least.select(*keys, *[F.col(_ROW)[c].alias(c) for c in rest]))
    first = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in rest or keys])
    ranked = df.repartitionByRange(*keys).withColumn(_RANK, F.row_number().over(first))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def crowded(df: DataFrame, keys: Sequence[str], times: int = 8, least: int = 100_000) -> list[int]:
    """The hash buckets, of 4096, with ``times`` as many rows as the average and ``least`` rows or more: those of hot keys.

    One job, which counts the rows of each bucket; no more than the counts reach the driver.
    """
    keys, _ = _split(df, keys)
    counts = df.groupBy(_bucket(df, keys).alias("bucket")).agg(F.count(F.lit(1)).alias("n_rows")).collect()
    limit = max(least, times * sum(r.n_rows for r in counts) / _BUCKETS)
    return sorted(r.bucket for r in counts if r.n_rows >= limit)


def _split(df: DataFrame, keys: Sequence[str]) -> tuple[list[str], list[str]]:
    """The keys by the names ``df`` has for them, and its other columns."""
    by_lower = {name.lower(): name for name in df.columns}
    keys = [by_lower[k.lower()] for k in keys]
    return keys, [c for c in df.columns if c not in keys]


def _hash(df: DataFrame, keys: Sequence[str]) -> Column:
    types = dict(df.dtypes)
    return F.xxhash64(*[_hashable(k, types[k]) for k in keys])


def _bucket(df: DataFrame, keys: Sequence[str]) -> Column:
    return F.pmod(_hash(df, keys), F.lit(_BUCKETS))


def _hashable(name: str, dtype: str) -> Column:
    # 0.0 and -0.0 are one group key but differ bit by bit
    return F.col(name) + F.lit(0.0).cast(dtype) if dtype in _FLOATING else F.col(name)
