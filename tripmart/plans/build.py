"""Fill the source tables, build the whole warehouse in one database and check it."""

from __future__ import annotations

import datetime as dt
import operator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.contracts import DATABASE, FHV, GREEN, PAYMENT_TYPES, SERVICES, STAGED_FHV, YELLOW, ZONE_TABLE, Service
from tripmart.functions import month_start
from tripmart.operators import checks
from tripmart.operators.checks import ERROR, WARN, Check
from tripmart.plans import marts, staging
from tripmart.session import setting
from tripmart.sources import changes, versions
from tripmart.sources.tables import (
    catalog_view,
    create_trip_table,
    load_months,
    load_zones,
    refresh_table,
    replace_partitions,
    source,
)

STG_GREEN, STG_YELLOW, STG_FHV = "stg_green_taxi_trips", "stg_yellow_taxi_trips", "stg_fhv_trips"
FACT, FACT_FHV, ZONES, REVENUE = "fact_trips", "fact_fhv_trips", "dim_zones", "monthly_zone_revenue_cube"
STATE, MONTH = "build_state", "pickup_month"
_STAGED = {GREEN: staging.stage_green, YELLOW: staging.stage_yellow}
_NAMES = {GREEN: STG_GREEN, YELLOW: STG_YELLOW}
WRITERS = 20


def ingest(
    spark: SparkSession,
    landing: str,
    zone_csv: str,
    root: str,
    last: str,
    first: str | None = None,
    database: str = DATABASE,
    as_of: dt.date | None = None,
    days: int | None = None,
) -> None:
    """Landed files -> the four source tables: every service month by month, zones once.

    A service that ended earlier stops at its own last month. Days that the tables' retention has expired by
    today (or ``as_of``) are not loaded.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for service in SERVICES:
        table = create_trip_table(spark, service, database)
        load_months(spark, landing, service, table, first, min(last, service.last_month or last), as_of, days)
    load_zones(spark, zone_csv, root, database)


def build(
    spark: SparkSession, database: str = DATABASE, sample_limit: int | None = None, buckets: int | None = None
) -> DataFrame:
    """Source tables -> staging views -> mart tables; returns the check report.

    Both street-hail services are stored once staged, so that facts and checks share one
    deduplication; the staging views are catalog views over what is stored. All tables are partitioned by month
    of pickup, and revenue is stored as sums and counts, so that :func:`refresh` can redo single months. With
    ``buckets`` the staged services lie by hash of their key, which then is checked and joined without a shuffle.
    Raises :class:`tripmart.operators.checks.CheckFailed` if a check of severity ``error`` fails.
    """
    seen = _state(spark, database)  # before anything is read
    for service in _STAGED:
        rows, limit = source(spark, database, service.table), sample_limit if service is GREEN else None
        store_staged(rows, service, f"{database}.{_NAMES[service]}_stored", limit, buckets)
        catalog_view(spark, f"{database}.{_NAMES[service]}", f"SELECT * FROM {database}.{_NAMES[service]}_stored")
    green, yellow = (spark.table(f"{database}.{_NAMES[s]}_stored") for s in (GREEN, YELLOW))

    zones = refresh_table(marts.dim_zones(source(spark, database, ZONE_TABLE)), f"{database}.{ZONES}")
    facts = store_facts(marts.fact_trips(green, yellow, zones), f"{database}.{FACT}")
    # dealt out as they come: staged columns, most of them decimals, are wider
    fhv = _monthly(source(spark, database, FHV.table), FHV.pickup).hint("rebalance", MONTH)
    _store(_monthly(staging.stage_fhv(fhv)).select(*STAGED_FHV.names, MONTH), f"{database}.{FACT_FHV}")
    catalog_view(spark, f"{database}.{STG_FHV}", f"SELECT * FROM {database}.{FACT_FHV}")
    states = _by_month(marts.revenue_states(facts)).hint("rebalance", MONTH)
    _store(states, f"{database}.{REVENUE}_states")
    revenue = catalog_view(
        spark, f"{database}.{REVENUE}", f"SELECT {', '.join(marts.averaged())} FROM {database}.{REVENUE}_states"
    )
    report = _checked(spark, database, green, yellow, facts, revenue)
    refresh_table(spark.createDataFrame(sorted(seen), "source string, load string"), f"{database}.{STATE}")
    return report


def refresh(spark: SparkSession, database: str = DATABASE, buckets: int | None = None) -> DataFrame:
    """Bring a built warehouse up to date; returns the check report of what was redone.

    The record of loads says which months of pickup the deliveries since the last build or refresh took from or
    brought to. The deduplication key holds the pickup time and all later steps keep it, so only these months of
    staged trips, facts and revenue are computed, from partitions of those months alone, and replaced. Loads are
    marked as seen when all is written: a refresh that fails is mended by the next. Other zones, a rebuilt
    source or one without a record call for a full build.
    """
    now, state = _state(spark, database), f"{database}.{STATE}"
    seen = {tuple(r) for r in spark.table(state).collect()} if spark.catalog.tableExists(state) else set()
    new = now - seen
    if not seen or any(not load for _, load in now) or any(name == ZONE_TABLE for name, _ in new):
        return build(spark, database, buckets=buckets)
    ids = {s: [load for name, load in new if name == s.table] for s in SERVICES}
    months = {s: changes.touched(spark, f"{database}.{s.table}", i) for s, i in ids.items() if i}
    if any(changes.EVERYTHING in m for m in months.values()):
        return build(spark, database, buckets=buckets)
    street = [s for s in _STAGED if months.get(s)]
    for service in street:
        chosen = _dates(months[service])
        rows = _of_months(source(spark, database, service.table), "pickup_date", chosen)
        replace_partitions(_monthly(_STAGED[service](rows)), f"{database}.{_NAMES[service]}_stored", MONTH, chosen)
    if months.get(FHV):
        chosen = _dates(months[FHV])
        rows = _monthly(staging.stage_fhv(_of_months(source(spark, database, FHV.table), "pickup_date", chosen)))
        replace_partitions(rows, f"{database}.{FACT_FHV}", MONTH, chosen)
    chosen = _dates(set().union(*(months[s] for s in street)))
    if chosen:
        staged = [_partitions(spark, f"{database}.{_NAMES[s]}_stored", chosen) for s in (GREEN, YELLOW)]
        facts = marts.fact_trips(*staged, spark.table(f"{database}.{ZONES}"))
        replace_partitions(_monthly(facts), f"{database}.{FACT}", MONTH, chosen)
        facts = _partitions(spark, f"{database}.{FACT}", chosen)
        replace_partitions(_by_month(marts.revenue_states(facts)), f"{database}.{REVENUE}_states", MONTH, chosen)
        states = _partitions(spark, f"{database}.{REVENUE}_states", chosen)
        report = _checked(spark, database, *staged, facts, states.selectExpr(*marts.averaged()))
    else:
        report = spark.table(f"{database}.check_report")
    refresh_table(spark.createDataFrame(sorted(now), "source string, load string"), state)
    return report


def _state(spark: SparkSession, database: str) -> set[tuple[str, str]]:
    """What a build would see now: the loads of each source table and the version of the zones.

    A source without a record of its loads has the empty load, which calls for a full build.
    """
    found = {(ZONE_TABLE, versions.stored(spark, f"{database}.{ZONE_TABLE}"))}
    for service in SERVICES:
        loads = changes.loads(spark, f"{database}.{service.table}")
        found |= {(service.table, load) for load in ([""] if loads is None else loads)}
    return found


def _dates(months: set[str]) -> list[dt.date | None]:
    return [dt.date.fromisoformat(f"{m}-01") if m else None for m in sorted(months)]


def _of_months(df: DataFrame, date: str, months: list[dt.date | None]) -> DataFrame:
    """Rows of these months, by ranges of a date that partitions can be told by."""
    ends = [(m, (m.replace(day=28) + dt.timedelta(days=4)).replace(day=1)) for m in months if m]
    ranges = [(F.col(date) >= F.lit(first)) & (F.col(date) < F.lit(end)) for first, end in ends]
    return df.where(reduce(operator.or_, [*ranges, *([F.col(date).isNull()] if None in months else [])], F.lit(False)))


def _partitions(spark: SparkSession, name: str, months: list[dt.date | None]) -> DataFrame:
    """These months of a stored table, with the columns its name shows."""
    rows = spark.table(versions.stored(spark, name))
    undated = F.col(MONTH).isNull() if None in months else F.lit(False)
    return rows.where(F.col(MONTH).isin([m for m in months if m]) | undated).select(*spark.table(name).columns)


def _monthly(trips: DataFrame, pickup: str = "pickup_ts") -> DataFrame:
    return trips.withColumn(MONTH, month_start(pickup).cast("date"))


def _by_month(states: DataFrame) -> DataFrame:
    return states.withColumn(MONTH, F.col("revenue_month").cast("date"))


def store_staged(
    rows: DataFrame, service: Service, name: str, sample_limit: int | None = None, buckets: int | None = None
) -> DataFrame:
    """A street-hail source staged and stored by month of pickup, which the name does not show.

    Trips come out of their deduplication in ranges of pickup time, so its shuffle also is the one that deals
    them to months, and a hot month lies in several files. A sample and ``buckets`` are dealt out by themselves.
    """
    stage = _STAGED[service]
    if buckets:
        dealt = _monthly(stage(rows, sample_limit)).repartition(buckets, "trip_id")
        return _store(dealt, name, buckets=buckets, bucket_by=("trip_id",))
    if sample_limit:
        return _store(_monthly(stage(rows, sample_limit)).hint("rebalance", MONTH), name)
    return _store(_monthly(stage(rows, keep=staging.in_ranges(rows, service))), name)


def store_facts(facts: DataFrame, name: str) -> DataFrame:
    """Facts as a table partitioned by ``pickup_month``, a hot month in several files.

    Staged trips are stored by month, so a task that reads some of their files meets few months and writes them as it
    reads. Only if a join deals the trips out anew, by zones too many to broadcast, they are brought together by month.
    """
    facts = _monthly(facts)
    return _store(facts.hint("rebalance", MONTH) if _shuffled(facts) else facts, name, hidden=())


def _store(rows: DataFrame, name: str, hidden: tuple[str, ...] = (MONTH,), **layout) -> DataFrame:
    """Rows, of few months in each task, as a table partitioned by month of pickup.

    A task writes its months side by side; sorting them first would spill wide rows. Only with more months than
    ``WRITERS`` it sorts the rows that are left.
    """
    with setting(rows.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", str(WRITERS)):
        return refresh_table(rows, name, (MONTH,), hidden=hidden, **layout)


def _shuffled(df: DataFrame) -> bool:
    """Whether the plan deals rows out by hash."""
    return "Exchange hashpartitioning" in df._jdf.queryExecution().executedPlan().toString()


def _checked(
    spark: SparkSession, database: str, green: DataFrame, yellow: DataFrame, facts: DataFrame, revenue: DataFrame
) -> DataFrame:
    results = checks.report(staging_checks(green, yellow) + mart_checks(facts, revenue))
    results = refresh_table(results, f"{database}.check_report")
    checks.enforce(results)
    return results


def staging_checks(green: DataFrame, yellow: DataFrame) -> list[Check]:
    key = (checks.must_be_unique("trip_id"), checks.must_be_present("trip_id"))
    codes = checks.must_be_one_of("payment_type", PAYMENT_TYPES)
    return [*checks.ruled(STG_GREEN, green, WARN, *key, codes), *checks.ruled(STG_YELLOW, yellow, WARN, *key)]


def mart_checks(facts: DataFrame, revenue: DataFrame) -> list[Check]:
    """A green and a yellow trip may share a ``trip_id``, so facts are keyed with the service."""
    return [
        *checks.ruled(FACT, facts, WARN, checks.must_be_unique("service_type", "trip_id")),
        *checks.ruled(REVENUE, revenue, ERROR, checks.must_be_present("revenue_monthly_total_amount")),
    ]
