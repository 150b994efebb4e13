"""Named tables as views over versions, so that a refresh is one step for every reader.

The rows of ``db.name`` lie in managed tables ``db.name__v...``; the name is a view over the current one, and knows it
by a property. A refresh writes the next version beside it and moves the view by one ``CREATE OR REPLACE VIEW``.
Whoever planned a query before that still reads the version of then, which goes ``GRACE`` after it was
replaced, at a later refresh. Managed versions take their files along when they are dropped.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tripmart.session import remove

PREFIX = "tripmart."
CURRENT, REPLACED = f"{PREFIX}version", f"{PREFIX}replaced"
GRACE = dt.timedelta(hours=1)
#: Keys, such as digests, and amounts take little more than half of what they take by Spark's default.
COMPRESSION = "zstd"


def qualified(spark: SparkSession, name: str) -> tuple[str, str]:
    """Database and table of a name."""
    database, _, table = name.rpartition(".")
    return database or spark.catalog.currentDatabase(), table


def properties(spark: SparkSession, name: str) -> dict[str, str]:
    """The properties this library gave a table or view; none if there is no such name."""
    if not spark.catalog.tableExists(name):
        return {}
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return {r.key: r.value for r in rows if r.key.startswith(PREFIX)}


def set_properties(spark: SparkSession, name: str, values: dict[str, str | None]) -> None:
    """Set properties of a named table; a value of ``None`` takes one away."""
    kind = "VIEW" if CURRENT in properties(spark, name) else "TABLE"
    given = {k: v for k, v in values.items() if v is not None}
    if given:
        spark.sql(f"ALTER {kind} {name} SET TBLPROPERTIES ({_listed(given)})")
    if gone := [f"'{k}'" for k, v in values.items() if v is None]:
        spark.sql(f"ALTER {kind} {name} UNSET TBLPROPERTIES IF EXISTS ({', '.join(gone)})")


def stored(spark: SparkSession, name: str) -> str:
    """The table that holds the rows of a name now; the name itself if it has no versions."""
    return properties(spark, name).get(CURRENT, name)


def versions(spark: SparkSession, name: str) -> list[str]:
    """All tables that are or were a version of a name."""
    database, table = qualified(spark, name)
    rows = spark.sql(f"SHOW TABLES IN {database} LIKE '{table}__v*'").collect()
    return [f"{database}.{r.tableName}" for r in rows if r.tableName.startswith(f"{table.lower()}__v")]


def new_version(spark: SparkSession, name: str) -> str:
    """A name for the next version, which no failed or concurrent refresh uses."""
    database, table = qualified(spark, name)
    return f"{database}.{table}__v{uuid.uuid4().hex[:12]}"


def point(spark: SparkSession, name: str, version: str, columns: Sequence[str], **values: str) -> None:
    """Move a name to a version; its other properties stay."""
    kept = {**properties(spark, name), **values, CURRENT: version}
    selected = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({_listed(kept)}) AS SELECT {selected} FROM {version}")


def publish(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    grace: dt.timedelta = GRACE,
    buckets: int | None = None,
    bucket_by: Sequence[str] = (),
    hidden: Sequence[str] = (),
) -> DataFrame:
    """Make the rows of ``df`` the current version of a name.

    Readers see the old rows until all new ones are there; if writing fails, nothing changes for them. ``hidden`` columns
    are stored, but the name does not show them. With ``buckets`` the rows are stored by hash of
    ``bucket_by`` and sorted by it, so that grouping by it later needs no shuffle.
    """
    spark = df.sparkSession
    old = check_name(spark, name)
    version = new_version(spark, name)
    writer = df.write.format("parquet").option("compression", COMPRESSION)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    try:
        writer.saveAsTable(version)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        remove(spark, f"{home(spark, name)}/{version.rpartition('.')[2]}")
        raise
    point(spark, name, version, [c for c in df.columns if c not in hidden])
    if old:
        set_properties(spark, old, {REPLACED: str(time.time())})
    prune(spark, name, grace)
    return spark.table(name)


def check_name(spark: SparkSession, name: str) -> str | None:
    """The current version, or ``None`` if the name is free; raises if something else has the name."""
    if not spark.catalog.tableExists(name):
        return None
    current = properties(spark, name).get(CURRENT)
    if current is None:
        raise ValueError(f"{name} is no versioned table; drop it before a table is made of that name")
    return current


def prune(spark: SparkSession, name: str, grace: dt.timedelta = GRACE) -> None:
    """Drop the versions that were replaced longer than ``grace`` ago.

    One that is neither current nor marked (a refresh ended between its steps) is marked now.
    """
    now, current = time.time(), stored(spark, name).lower()
    for version in versions(spark, name):
        if version.lower() == current:
            continue
        replaced = properties(spark, version).get(REPLACED)
        if replaced is None:
            set_properties(spark, version, {REPLACED: str(now)})
        if now - float(replaced or now) >= grace.total_seconds():
            spark.sql(f"DROP TABLE IF EXISTS {version}")


def drop(spark: SparkSession, name: str) -> None:
    """Drop a name and all its versions with their files."""
    held = versions(spark, name)
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    for version in held:
        spark.sql(f"DROP TABLE IF EXISTS {version}")


def home(spark: SparkSession, name: str) -> str:
    """The folder of a name's database."""
    rows = spark.sql(f"DESCRIBE DATABASE EXTENDED {qualified(spark, name)[0]}").collect()
    return next(r.info_value for r in rows if r.info_name == "Location").rstrip("/")


def _listed(values: dict[str, str]) -> str:
    return ", ".join(f"'{k}' = '{v}'" for k, v in values.items())
