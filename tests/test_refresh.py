"""Bringing a built warehouse up to date: equal to a full build, and nothing but the touched months is redone."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmart.contracts import FHV, GREEN, REVENUE_SUMS, YELLOW, ZONE_TABLE
from tripmart.operators import checks
from tripmart.plans import build, marts, staging
from tripmart.session import scratch_database, setting
from tripmart.sources import changes, tables, versions
from tripmart.sources.tables import refresh_table

TABLES = (build.STG_GREEN, build.STG_YELLOW, build.STG_FHV, build.FACT, build.FACT_FHV, build.REVENUE, build.ZONES)


def at(month, day, hour=9):
    return dt.datetime(2019, month, day, hour)


@pytest.fixture
def deliver(spark, green, yellow, fhv):
    """Load a month of a service: pickups with a fare each."""

    def load(database, service, month, *pickups, **values):
        make = {GREEN: green, YELLOW: yellow, FHV: fhv}[service]
        trip = {"PULocationID": 4, "DOLocationID": 7} | ({} if service is FHV else {"VendorID": 1, "trip_distance": 1.5})
        rows = [
            trip | {service.pickup: p, ("driver_pay" if service is FHV else "total_amount"): float(i + 1)} | values
            for i, p in enumerate(pickups)
        ]
        tables.load_month(make(*rows), service, f"{database}.{service.table}", month)

    return load


@pytest.fixture
def warehouse(spark, database, zones, deliver):
    for service in (GREEN, YELLOW, FHV):
        tables.create_trip_table(spark, service, database)
    refresh_table(zones, f"{database}.{ZONE_TABLE}")
    for month in (1, 2, 3):
        deliver(database, GREEN, f"2019-{month:02d}", at(month, 1), at(month, 2), at(month, 2, 10))
        deliver(database, YELLOW, f"2019-{month:02d}", at(month, 3), at(month, 4))
        deliver(database, FHV, f"2019-{month:02d}", at(month, 5))
    build.build(spark, database)
    return database


def contents(spark, database):
    return {t: sorted(map(repr, spark.table(f"{database}.{t}").collect())) for t in TABLES}


def files_of(spark, database, name):
    """Data files by month of pickup."""
    found = {}
    for path in spark.table(versions.stored(spark, f"{database}.{name}")).inputFiles():
        found.setdefault(path.split(f"{build.MONTH}=")[1].split("/")[0], set()).add(path)
    return found


def same_as_full(spark, database):
    got = contents(spark, database)
    build.build(spark, database)
    return got == contents(spark, database)


STORED = (f"{build.STG_GREEN}_stored", f"{build.STG_YELLOW}_stored", build.FACT, f"{build.REVENUE}_states", build.FACT_FHV)


def test_a_redelivered_month_rewrites_only_its_months(spark, warehouse, deliver):
    before = {name: files_of(spark, warehouse, name) for name in STORED}
    deliver(warehouse, GREEN, "2019-02", at(2, 2), at(2, 20))
    report = build.refresh(spark, warehouse)
    assert {r.status for r in report.collect()} <= {"pass", "warn"}
    after = {name: files_of(spark, warehouse, name) for name in STORED}
    for name in STORED:
        changed = {m for m in before[name] if before[name][m] != after[name].get(m)}
        expected = {"2019-02-01"} if name in (STORED[0], STORED[2], STORED[3]) else set()
        assert changed == expected and set(before[name]) == set(after[name]), name
    fares = spark.table(f"{warehouse}.{build.FACT}").where("service_type = 'Green' AND month(pickup_ts) = 2")
    assert sorted(r.pickup_ts for r in fares.collect()) == [at(2, 2), at(2, 20)]
    assert same_as_full(spark, warehouse)


def test_a_stray_day_and_a_vanishing_month_are_redone(spark, warehouse, deliver):
    # February's delivery now holds a day of January, which collides with one there, and undated rows; nothing of its own
    deliver(warehouse, GREEN, "2019-02", at(1, 2), None, total_amount=0.5)
    build.refresh(spark, warehouse)
    assert set(files_of(spark, warehouse, STORED[0])) == {"2019-01-01", "2019-03-01", "__HIVE_DEFAULT_PARTITION__"}
    assert same_as_full(spark, warehouse)
    # and back
    deliver(warehouse, GREEN, "2019-02", at(2, 7))
    build.refresh(spark, warehouse)
    assert set(files_of(spark, warehouse, STORED[0])) == {"2019-01-01", "2019-02-01", "2019-03-01"}
    assert same_as_full(spark, warehouse)


def test_a_new_month_of_every_service(spark, warehouse, deliver):
    for service in (GREEN, YELLOW, FHV):
        deliver(warehouse, service, "2019-04", at(4, 1), at(4, 2))
    build.refresh(spark, warehouse)
    assert spark.table(f"{warehouse}.{build.FACT_FHV}").count() == 5
    assert same_as_full(spark, warehouse)


def test_expired_days_leave_the_marts(spark, warehouse):
    tables.expire_partitions(spark, f"{warehouse}.{GREEN.table}", dt.date(2019, 2, 3), days=1)
    build.refresh(spark, warehouse)
    left = spark.table(f"{warehouse}.{build.STG_GREEN}")
    assert sorted({r.pickup_ts.month for r in left.collect()}) == [3]
    assert same_as_full(spark, warehouse)


def test_nothing_new_writes_nothing(spark, warehouse):
    before = {name: files_of(spark, warehouse, name) for name in STORED}
    build.refresh(spark, warehouse)
    assert before == {name: files_of(spark, warehouse, name) for name in STORED}


def test_other_zones_call_for_a_full_build(spark, warehouse, zones):
    refresh_table(zones.filter("LocationID <> 7"), f"{warehouse}.{ZONE_TABLE}")
    build.refresh(spark, warehouse)
    assert spark.table(f"{warehouse}.{build.FACT}").count() == 0
    assert same_as_full(spark, warehouse)


def test_a_refresh_that_fails_is_mended_by_the_next(spark, warehouse, deliver, monkeypatch):
    deliver(warehouse, YELLOW, "2019-02", at(2, 9), at(2, 10))
    store = build.replace_partitions

    def fail(df, name, *args):
        if name.endswith(build.FACT):
            raise RuntimeError("lost")
        store(df, name, *args)

    monkeypatch.setattr(build, "replace_partitions", fail)
    with pytest.raises(RuntimeError, match="lost"):
        build.refresh(spark, warehouse)
    monkeypatch.undo()
    build.refresh(spark, warehouse)
    assert same_as_full(spark, warehouse)


def test_sources_without_a_record_are_built_whole(spark, database, green, yellow, fhv, zones):
    trip = {"VendorID": 1, "PULocationID": 4, "DOLocationID": 7, "total_amount": 1.0}
    for day in (1, 2):
        refresh_table(green(trip | {"lpep_pickup_datetime": at(1, day)}), f"{database}.{GREEN.table}")
        refresh_table(yellow(trip | {"tpep_pickup_datetime": at(1, day)}), f"{database}.{YELLOW.table}")
        refresh_table(fhv({"pickup_datetime": at(1, day)}), f"{database}.{FHV.table}")
        refresh_table(zones, f"{database}.{ZONE_TABLE}")
        build.refresh(spark, database)
        assert {r.pickup_ts for r in spark.table(f"{database}.{build.FACT}").collect()} == {at(1, day)}


def test_a_refresh_reads_only_partitions_of_its_months(spark, warehouse, deliver, monkeypatch):
    deliver(warehouse, GREEN, "2019-02", at(2, 2))
    plans = []
    store = build.replace_partitions

    def recorded(df, name, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        store(df, name, *args)

    monkeypatch.setattr(build, "replace_partitions", recorded)
    build.refresh(spark, warehouse)
    scans = [line for p in plans for line in p.splitlines() if "FileScan" in line and ("pickup_date" in line or build.MONTH in line)]
    assert len(scans) >= 4 and all("PartitionFilters: []" not in line for line in scans)


@settings(max_examples=2, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    deliveries=st.lists(
        st.tuples(
            st.sampled_from([GREEN, YELLOW]),
            st.integers(1, 3),
            st.lists(st.tuples(st.integers(1, 4), st.integers(1, 28)), max_size=4),
        ),
        min_size=1,
        max_size=3,
    )
)
def test_any_deliveries_give_what_a_full_build_gives(spark, zones, deliver, deliveries):
    database = scratch_database(spark)
    for service in (GREEN, YELLOW, FHV):
        tables.create_trip_table(spark, service, database)
    refresh_table(zones, f"{database}.{ZONE_TABLE}")
    deliver(database, FHV, "2019-01", at(1, 1))
    deliver(database, GREEN, "2019-01", at(1, 1), at(2, 1))
    deliver(database, YELLOW, "2019-02", at(2, 1))
    build.build(spark, database)
    for service, month, days in deliveries:
        deliver(database, service, f"2019-{month:02d}", *[at(m, d) for m, d in days])
    build.refresh(spark, database)
    assert same_as_full(spark, database)


# ------------------------------------------------------------------ states and layout


def test_states_merge_to_the_full_aggregate(spark, green, yellow, zones):
    trips = [
        {"VendorID": v, "lpep_pickup_datetime": at(m, d), "PULocationID": z, "DOLocationID": 7, "passenger_count": p,
         "trip_distance": x, "total_amount": x}
        for v, m, d, z, p, x in [(1, 1, 1, 56, 1.0, 0.1), (2, 1, 2, 57, None, 0.2), (3, 2, 3, 56, 4.0, None), (4, 2, 4, 4, 2.0, 1e9)]
    ]
    facts = marts.fact_trips(staging.stage_green(green(*trips)), staging.stage_yellow(yellow()), marts.dim_zones(zones))
    parts = [marts.revenue_states(facts.where(F.col("vendor_id") % 2 == k)) for k in (0, 1)]
    merged = marts.merged_states(parts[0].unionByName(parts[1]), *marts.REVENUE_KEYS).selectExpr(*marts.averaged())
    full = marts.monthly_zone_revenue(facts)
    assert merged.dtypes == full.dtypes
    assert sorted(map(repr, merged.collect())) == sorted(map(repr, full.collect()))
    # coarser groups come from states alone, with averages over all their trips
    year = marts.merged_states(marts.revenue_states(facts), "service_type").selectExpr(*marts.averaged(["service_type"]))
    row = year.first()
    assert row.total_monthly_trips == 4 and row.avg_montly_passenger_count == 7 / 3
    assert row.avg_montly_trip_distance == Decimal("333333333.433333333")
    assert set(REVENUE_SUMS.values()) <= set(year.columns)


def test_revenue_without_values_has_no_average(green, yellow, zones):
    trips = [{"VendorID": 1, "lpep_pickup_datetime": at(1, 1), "PULocationID": 4, "DOLocationID": 7}]
    facts = marts.fact_trips(staging.stage_green(green(*trips)), staging.stage_yellow(yellow()), marts.dim_zones(zones))
    row = marts.monthly_zone_revenue(facts).first()
    assert (row.total_monthly_trips, row.avg_montly_passenger_count, row.avg_montly_trip_distance) == (1, None, None)


def test_bucketed_services_are_checked_without_a_shuffle(spark, database, green, yellow, fhv, zones, deliver, plan):
    for service in (GREEN, YELLOW, FHV):
        tables.create_trip_table(spark, service, database)
        deliver(database, service, "2019-01", *[at(1, d) for d in range(1, 20)], at(2, 1))
    refresh_table(zones, f"{database}.{ZONE_TABLE}")
    build.build(spark, database, buckets=4)
    stored = spark.table(f"{database}.{build.STG_GREEN}")
    # a session that is told not to pick bucketed scans by itself still may not shuffle what lies by key
    with setting(spark, "spark.sql.sources.bucketing.autoBucketedScan.enabled", "true"):
        text = plan(checks.unique(stored, "trip_id"))
        assert "Exchange" not in text and "Bucketed: true" in text
        assert checks.unique(stored.unionAll(stored), "trip_id").count() == 20
        assert checks.unique(stored, "trip_id").count() == 0
    # a refresh keeps the layout
    deliver(database, GREEN, "2019-02", at(2, 1), at(2, 2))
    build.refresh(spark, database, buckets=4)
    assert "Exchange" not in plan(checks.unique(spark.table(f"{database}.{build.STG_GREEN}"), "trip_id"))
    assert spark.table(f"{database}.{build.STG_GREEN}").count() == 21
    names = [os.path.basename(p) for p in spark.table(versions.stored(spark, f"{database}.{STORED[0]}")).inputFiles()]
    assert len({n.split("_")[-1].split(".")[0] for n in names}) <= 4


# ------------------------------------------------------------------ the record of loads


def test_the_record_names_what_loads_touched(spark, database, deliver):
    table = tables.create_trip_table(spark, YELLOW, database)
    assert changes.loads(spark, table) is None
    deliver(database, YELLOW, "2019-01", at(1, 1), at(2, 1), None)
    first = changes.loads(spark, table)
    assert changes.touched(spark, table, first) == {"2019-01", "2019-02", ""} and changes.months(spark, table) == {"2019-01"}
    deliver(database, YELLOW, "2019-01", at(3, 1))
    second = changes.loads(spark, table) - first
    assert len(second) == 1 and changes.touched(spark, table, second) == {"2019-01", "2019-02", "2019-03", ""}
    tables.expire_partitions(spark, table, dt.date(2019, 4, 1), days=1)
    third = changes.loads(spark, table) - first - second
    assert changes.touched(spark, table, third) == {"2019-03"} and changes.months(spark, table) == {"2019-01"}
