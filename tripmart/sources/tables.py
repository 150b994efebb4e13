"""Catalog tables: definition, refresh, monthly replacement and retention."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Iterable, Iterator, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmart.contracts import RETENTION_DAYS, ZONE_FILE, ZONE_SOURCE, ZONE_TABLE, Contract, Service
from tripmart.functions import pickup_date
from tripmart.operators.shape import conform, unexpired
from tripmart.session import setting, today
from tripmart.sources import changes, files, footers, versions

PARTITIONS_PER_STATEMENT = 500
EXTERNAL = f"{versions.PREFIX}external"
RETENTION = f"{versions.PREFIX}retention_days"


def external_table(spark: SparkSession, name: str, location: str, contract: Contract | None = None) -> DataFrame:
    """Name Parquet files in place as a table, anew if it was named before; the files stay untouched.

    Without a contract the schema comes from the files' footers, read in tasks. If all share one, the name is a table
    over the folder and shows what comes to lie there later. If they drift, it is a view that reads the
    files of each schema by themselves and casts them to the widened one; define it again for files that come later.
    Only names that this function made are made anew: anything else of that name raises.
    """
    if spark.catalog.tableExists(name):
        kind = versions.properties(spark, name).get(EXTERNAL)
        if kind is None:
            raise ValueError(f"{name} is a table of its own, not one over files in place")
        spark.sql(f"DROP {kind} {name}")
    if contract is None:
        groups = footers.grouped(footers.described(files.list_parquet(spark, location)))
        if len(groups) > 1:
            return _drifting(spark, name, groups)
    columns = f"({contract.ddl})" if contract else ""
    spark.sql(
        f"CREATE TABLE {name} {columns} USING parquet LOCATION '{location}' TBLPROPERTIES ('{EXTERNAL}' = 'TABLE')"
    )
    return spark.table(name)


def _drifting(spark: SparkSession, name: str, groups: list[footers.Alike]) -> DataFrame:
    """A view over files of several schemas, cast to the one that holds them all."""
    whole = footers.widened(g.schema for g in groups)
    parts = []
    for group in groups:
        own = {f.name.lower(): f"`{f.name}`" for f in group.schema.fields}
        columns = ", ".join(
            f"CAST({own.get(f.name.lower(), 'NULL')} AS {f.dataType.simpleString()}) AS `{f.name}`" for f in whole.fields
        )
        parts += [f"SELECT {columns} FROM parquet.`{glob}`" for glob in files.globs(group.months)]
    spark.sql(f"CREATE VIEW {name} TBLPROPERTIES ('{EXTERNAL}' = 'VIEW') AS {' UNION ALL '.join(parts)}")
    return spark.table(name)


def source(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(f"{database}.{table}")


def define_view(df: DataFrame, name: str) -> DataFrame:
    """Name a lazy frame for this session's SQL; nothing is computed."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def catalog_view(spark: SparkSession, name: str, sql: str) -> DataFrame:
    """Define a view that other sessions see too; ``name`` and ``sql`` name databases."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")
    return spark.table(name)


def refresh_table(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), grace: dt.timedelta = versions.GRACE, **layout
) -> DataFrame:
    """Replace a table by ``df`` and read it back, which also cuts the lineage.

    The rows become the next version of the table, see :func:`tripmart.sources.versions.publish` (which takes the
    ``layout``): readers see all of the old rows or all of the new ones, in any session, and a refresh that
    fails changes nothing.
    """
    return versions.publish(df, name, partition_by, grace, **layout)


def replace_partitions(df: DataFrame, name: str, column: str, values: Collection[dt.date | None]) -> None:
    """Replace those partitions of a refreshed table by the rows of ``df``, which lie in no others.

    All are written in one job; a partition that ``df`` has no rows for is dropped. Other partitions and their files
    stay as they are, so this happens within the current version and readers of these partitions may notice.
    """
    spark = df.sparkSession
    version = versions.stored(spark, name)
    seen = Observation()
    rows = df.select(*spark.table(version).columns).hint("rebalance", column)
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        rows.observe(
            seen, F.collect_set(column).alias("there"), F.count_if(F.col(column).isNull()).alias("undated")
        ).write.mode("overwrite").insertInto(version)
    there = {*seen.get["there"], *([None] if seen.get["undated"] else [])}
    for value in sorted({*values} - there, key=str):
        literal = "null" if value is None else f"DATE '{value}'"
        spark.sql(f"ALTER TABLE {version} DROP IF EXISTS PARTITION ({column} = {literal})")


def empty_like(df: DataFrame, name: str) -> DataFrame:
    """Replace a table by an empty one with the columns of ``df``."""
    return refresh_table(df.limit(0), name)


def schema_ddl(df: DataFrame) -> str:
    return df.schema.toDDL()


# ------------------------------------------------------------------ trip tables


def create_trip_table(
    spark: SparkSession, service: Service, database: str, days: int | None = RETENTION_DAYS
) -> str:
    """A service's typed table, partitioned by month of delivery and date of pickup, if it is not there.

    ``days`` become the table's retention, which every load obeys (``None``: rows never expire).
    """
    name = f"{database}.{service.table}"
    if versions.check_name(spark, name) is None:
        version = versions.new_version(spark, name)
        spark.sql(
            f"CREATE TABLE {version} ({service.table_contract.ddl}) "
            "USING parquet PARTITIONED BY (source_month, pickup_date)"
        )
        versions.point(spark, name, version, service.table_contract.names)
        set_retention(spark, name, days)
    return name


def set_retention(spark: SparkSession, table: str, days: int | None) -> None:
    """Keep the days of retention as a property of the table; ``None`` keeps rows for ever."""
    versions.set_properties(spark, table, {RETENTION: None if days is None else str(days)})


def retention(spark: SparkSession, table: str) -> int | None:
    days = versions.properties(spark, table).get(RETENTION)
    return None if days is None else int(days)


def _last_expired(spark: SparkSession, table: str, as_of: dt.date | None, days: int | None) -> dt.date | None:
    """The last date that has expired: by the table's own days and the calendar, unless told otherwise."""
    kept = retention(spark, table) if days is None else days
    return None if kept is None else (as_of or today(spark)) - dt.timedelta(days=kept)


def load_month(
    df: DataFrame,
    service: Service,
    table: str,
    month: str,
    as_of: dt.date | None = None,
    days: int | None = None,
) -> None:
    """Replace one delivered month in a trip table; running it again changes nothing.

    ``df`` may have drifted types: it is bound to the service's contract here. Days that the table's retention has
    expired by today are left out; ``as_of`` and ``days`` stand in for today and the table's own days.
    Static overwrite drops every date of the delivery before writing, so dates that a
    redelivery no longer holds disappear, while a stray date of another month stays inside
    its own delivery and cannot overwrite that other month. Rows are sorted by pickup time
    within each date (the write sorts by date anyway), so a time window skips row groups.
    The dates that the load took away or brought go on record, for builds that only redo those.
    """
    files.checked_month(month)
    spark = df.sparkSession
    version = versions.stored(spark, table)
    rows = _retained(_dated(conform(df, service.source, service.drifting), service), _last_expired(spark, table, as_of, days))
    before = _dates(spark, version, month)
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "static"):
        spark.sql(
            f"INSERT OVERWRITE TABLE {version} PARTITION (source_month = '{month}', pickup_date) "
            f"SELECT /*+ REBALANCE(pickup_date) */ * FROM {{rows}} SORT BY pickup_date, {service.pickup}",
            rows=rows,
        )
    changes.record(spark, table, month, before | _dates(spark, version, month))


def _dates(spark: SparkSession, version: str, month: str | None = None) -> set[tuple[str, str]]:
    """``(source_month, pickup_date)`` of the partitions that are there: names, no rows. Undated ones have no date."""
    of_month = f"PARTITION (source_month = '{month}')" if month else ""
    date = F.regexp_extract("partition", r"pickup_date=(\d{4}-\d{2}-\d{2})", 1)
    label = F.regexp_extract("partition", r"source_month=(\d{4}-\d{2})", 1)
    rows = spark.sql(f"SHOW PARTITIONS {version} {of_month}").select(label.alias("month"), date.alias("date"))
    return {(r.month, r.date) for r in rows.collect()}


def load_months(
    spark: SparkSession,
    landing: str,
    service: Service,
    table: str,
    first: str | None = None,
    last: str | None = None,
    as_of: dt.date | None = None,
    days: int | None = None,
) -> DataFrame:
    """Backfill landed months ``first`` to ``last`` (the service's own range by default).

    The loop is over months, not rows: each turn is one distributed job over a whole month.
    """
    last = last or service.last_month
    if last is None:
        raise ValueError("an open-ended service needs a last month")
    for month in months_between(first or service.first_month, last):
        rows = files.read_file(spark, files.landing_path(landing, service, month))
        load_month(rows, service, table, month, as_of, days)
    return spark.table(table)


def promote(
    spark: SparkSession,
    root: str,
    service: Service,
    table: str,
    months: Iterable[str] | None = None,
    as_of: dt.date | None = None,
    days: int | None = None,
) -> DataFrame:
    """Load raw months into the service's table: those it has never taken, or ``months``.

    Taken months are on record beside the table, so a month that was empty or has expired is
    not new again. Name a month to load its redelivery. One name per raw month is listed.
    """
    wanted = sorted(files.raw_months(spark, root, service).keys() - _consumed(spark, table) if months is None else months)
    for month in wanted:
        rows = files.read_file(spark, files.raw_path(root, service, month))
        load_month(rows, service, table, month, as_of, days)
    return spark.table(table)


def _consumed(spark: SparkSession, table: str) -> set[str]:
    """The months that a trip table has taken."""
    return changes.months(spark, table)


def load_zones(spark: SparkSession, csv: str, root: str, database: str) -> DataFrame:
    """Zone lookup CSV -> Parquet copy in the raw zone -> untyped table, replaced as a whole."""
    copy = files.csv_to_parquet(spark, csv, f"{root}/raw/{ZONE_FILE}", ZONE_SOURCE)
    return refresh_table(copy, f"{database}.{ZONE_TABLE}")


def rebuild(
    spark: SparkSession,
    root: str,
    service: Service,
    database: str,
    as_of: dt.date | None = None,
    days: int | None = None,
) -> DataFrame:
    """Full refresh of a trip table from everything promoted, in one job."""
    name = create_trip_table(spark, service, database)
    rows = _retained(_dated(files.read_service(spark, root, service), service), _last_expired(spark, name, as_of, days))
    dealt = (
        rows.select(*service.table_contract.names)
        .hint("rebalance", "source_month", "pickup_date")
        .sortWithinPartitions("source_month", "pickup_date", service.pickup)
    )
    rebuilt = refresh_table(dealt, name, ("source_month", "pickup_date"))
    changes.record_all(spark, name, {month for month, _ in _dates(spark, versions.stored(spark, name))})
    return rebuilt


def _retained(df: DataFrame, last_expired: dt.date | None) -> DataFrame:
    return df if last_expired is None else unexpired(df, "pickup_date", last_expired, 0)


def _dated(df: DataFrame, service: Service) -> DataFrame:
    return df.withColumn("pickup_date", pickup_date(service.pickup))


def expire_partitions(
    spark: SparkSession, table: str, as_of: dt.date | None = None, days: int | None = None
) -> DataFrame:
    """Drop the partitions whose ``pickup_date`` is as many days or more before today as the table keeps.

    ``as_of`` and ``days`` stand in for today and the table's own days. Only partition names are read. Undated
    partitions never expire.
    """
    last, version = _last_expired(spark, table, as_of, days), versions.stored(spark, table)
    if last is None:
        return spark.table(table)
    expired = sorted(p for p in _dates(spark, version) if p[1] and p[1] <= last.isoformat())
    for start in range(0, len(expired), PARTITIONS_PER_STATEMENT):
        batch = expired[start : start + PARTITIONS_PER_STATEMENT]
        specs = ", ".join(f"PARTITION (source_month = '{month}', pickup_date = DATE '{date}')" for month, date in batch)
        spark.sql(f"ALTER TABLE {version} DROP IF EXISTS {specs}")
    if expired:
        changes.record(spark, table, None, set(expired))
    return spark.table(table)


def months_between(first: str, last: str) -> Iterator[str]:
    """``YYYY-MM`` labels from ``first`` to ``last``, both included."""
    year, month = (int(part) for part in first.split("-"))
    while (label := f"{year:04d}-{month:02d}") <= last:
        yield label
        year, month = (year + 1, 1) if month == 12 else (year, month + 1)
