"""What every load of a trip table took away or brought, on record beside it.

``<table>_loads`` has one row per load and touched partition: ``load`` (an id), ``delivered`` (the month of delivery; NULL
if rows only went), ``source_month`` and ``pickup_date`` (empty: undated; NULL: the delivery itself; ``*``: all
there is). ``<table>_months`` shows the months delivered so far. Rows are only added, by one write per load, so loads may run
side by side and a reader who remembers the loads it has seen misses none.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = "load string, delivered string, source_month string, pickup_date string"
EVERYTHING = "*"


def log(spark: SparkSession, table: str) -> DataFrame:
    if not spark.catalog.tableExists(f"{table}_loads"):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table}_loads ({COLUMNS}) USING parquet")
        spark.sql(
            f"CREATE OR REPLACE VIEW {table}_months AS "
            f"SELECT DISTINCT delivered AS source_month FROM {table}_loads WHERE delivered IS NOT NULL"
        )
    return spark.table(f"{table}_loads")


def record(spark: SparkSession, table: str, month: str | None, touched: Iterable[tuple[str, str]]) -> None:
    """A load: the month it delivered, if any, and the partitions ``(source_month, pickup_date)`` it touched."""
    load = uuid.uuid4().hex
    rows = [(load, month, *partition) for partition in sorted(touched)]
    _append(spark, table, [(load, month, month, None), *rows] if month else rows)


def record_all(spark: SparkSession, table: str, months: Iterable[str]) -> None:
    """A load that replaced the whole table by deliveries of these months."""
    load = uuid.uuid4().hex
    _append(spark, table, [(load, None, None, EVERYTHING), *((load, m, m, None) for m in sorted(months))])


def _append(spark: SparkSession, table: str, rows: list[tuple]) -> None:
    log(spark, table)
    # ids, months and dates: no value needs quoting
    values = ", ".join(f"({', '.join('NULL' if v is None else f'{v!r}' for v in row)})" for row in rows)
    spark.sql(f"INSERT INTO {table}_loads SELECT * FROM VALUES {values}")


def months(spark: SparkSession, table: str) -> set[str]:
    """The months delivered so far: one row per month."""
    log(spark, table)
    return {row.source_month for row in spark.table(f"{table}_months").collect()}


def loads(spark: SparkSession, table: str) -> set[str] | None:
    """The ids of all loads so far; ``None`` for a table without a record."""
    if not spark.catalog.tableExists(f"{table}_loads"):
        return None
    return {row.load for row in spark.table(f"{table}_loads").select("load").distinct().collect()}


def touched(spark: SparkSession, table: str, ids: Iterable[str]) -> set[str]:
    """The months of pickup that these loads touched: ``YYYY-MM``, empty for undated rows, ``*`` if it may be any."""
    rows = spark.table(f"{table}_loads").where(F.col("load").isin(*ids) & F.col("pickup_date").isNotNull())
    return {row.month for row in rows.select(F.substring("pickup_date", 1, 7).alias("month")).distinct().collect()}
