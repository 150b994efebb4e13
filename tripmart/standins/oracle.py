"""The same queries in DuckDB SQL, written against the driver's tables.

Only the column mappings of :mod:`tripmart.standins.frames` and the source contracts are
shared with the Spark side. Everything computed from them is spelled out here a second time.
"""

from __future__ import annotations

from tripmart.contracts import FHV_SOURCE, GREEN_SOURCE, YELLOW_SOURCE, Contract
from tripmart.standins import frames

_TYPES = {"timestamp_ntz": "timestamp", "string": "varchar"}


def _mapped(columns: dict[str, str], contract: Contract) -> str:
    return ", ".join(f"cast({columns[n]} as {_TYPES.get(t, t)}) as {n}" for n, t in contract.columns)


def _zones(columns: dict[str, str], tables: str) -> str:
    raw = ", ".join(f"{text} as raw_{name}" for name, text in columns.items())
    return (
        "select cast(raw_LocationID as bigint) as location_id, raw_Borough as borough, raw_Zone as zone, "
        f"replace(raw_service_zone, 'Boro', 'Green') as service_zone from (select {raw} from {tables})"
    )


def _text(column: str) -> str:
    return f"coalesce(cast({column} as varchar), '')"


def _label(code: str) -> str:
    return f"""case {code}
        when 1 then 'Credit card'
        when 2 then 'Cash'
        when 3 then 'No charge'
        when 4 then 'Dispute'
        when 5 then 'Unknown'
        when 6 then 'Voided trip'
    end"""


def _staged(columns: dict[str, str], contract: Contract, rows: str, prefix: str, trip_type: str) -> str:
    pickup, dropoff = f"{prefix}_pickup_datetime", f"{prefix}_dropoff_datetime"
    others = ", ".join(f"{n} nulls first" for n in contract.names if n not in ("VendorID", pickup))
    return f"""
    select
        md5({_text("VendorID")} || '-' || {_text(pickup)}) as trip_id,
        cast(round(VendorID) as bigint) as vendor_id,
        cast(round(RatecodeID) as bigint) as rate_code_id,
        cast(round(PULocationID) as bigint) as pickup_location_id,
        cast(round(DOLocationID) as bigint) as dropoff_location_id,
        {pickup} as pickup_ts,
        {dropoff} as dropoff_ts,
        store_and_fwd_flag,
        cast(round(passenger_count) as bigint) as passenger_count,
        cast(trip_distance as decimal(38,9)) as trip_distance,
        cast(round({trip_type}) as bigint) as trip_type,
        cast(fare_amount as decimal(38,9)) as fare_amount,
        cast(extra as decimal(38,9)) as extra,
        cast(mta_tax as decimal(38,9)) as mta_tax,
        cast(tip_amount as decimal(38,9)) as tip_amount,
        cast(tolls_amount as decimal(38,9)) as tolls_amount,
        cast(0 as decimal(38,9)) as ehail_fee,
        cast(improvement_surcharge as decimal(38,9)) as improvement_surcharge,
        cast(total_amount as decimal(38,9)) as total_amount,
        cast(round(payment_type) as bigint) as payment_type,
        {_label("payment_type")} as payment_type_description,
        cast(congestion_surcharge as decimal(38,9)) as congestion_surcharge
    from (
        select *, row_number() over (partition by VendorID, {pickup} order by {others}) as rn
        from (select {_mapped(columns, contract)} from {rows})
        where VendorID is not null
    )
    where rn = 1"""


GREEN = _staged(frames.GREEN_COLUMNS, GREEN_SOURCE, f"{frames.LOCATED} where l_linestatus = 'O'", "lpep", "trip_type")
YELLOW = _staged(frames.YELLOW_COLUMNS, YELLOW_SOURCE, f"{frames.LOCATED} where l_linestatus = 'F'", "tpep", "1")

FHV = f"""
    select
        md5(
            {_text("hvfhs_license_num")} || '-' || {_text("dispatching_base_num")} || '-' || {_text("pickup_datetime")}
        ) as trip_id,
        hvfhs_license_num as hvfhs_license_code,
        dispatching_base_num as dispatching_base_code,
        originating_base_num as originating_base_code,
        request_datetime as request_ts,
        on_scene_datetime as on_scene_ts,
        pickup_datetime as pickup_ts,
        dropoff_datetime as dropoff_ts,
        PULocationID as pickup_location_id,
        DOLocationID as dropoff_location_id,
        cast(trip_miles as decimal(38,9)) as trip_distance,
        cast(trip_time as decimal(38,9)) as trip_time,
        cast(base_passenger_fare as decimal(38,9)) as base_passenger_fare,
        cast(tolls as decimal(38,9)) as tolls,
        cast(bcf as decimal(38,9)) as bcf,
        cast(sales_tax as decimal(38,9)) as sales_tax,
        cast(congestion_surcharge as decimal(38,9)) as congestion_surcharge,
        cast(driver_pay as decimal(38,9)) as driver_pay,
        shared_request_flag,
        shared_match_flag,
        access_a_ride_flag,
        wav_request_flag,
        wav_match_flag
    from (select {_mapped(frames.FHV_COLUMNS, FHV_SOURCE)} from events)"""

NATIONS = _zones(frames.NATION_ZONES, "nation join region on n_regionkey = r_regionkey")
CUSTOMERS = _zones(frames.CUSTOMER_ZONES, "customer")
PARTS = _zones(frames.PART_ZONES, "part")



def _facts(green: str, yellow: str) -> str:
    return (
        "select t.*, p.borough as pickup_borough, p.zone as pickup_zone, d.borough as dropoff_borough, "
        "d.zone as dropoff_zone "
        f"from (select *, 'Green' as service_type from ({green}) "
        f"union all by name select *, 'Yellow' as service_type from ({yellow})) t "
        f"join (select * from ({NATIONS}) where borough <> 'Unknown') p on pickup_location_id = p.location_id "
        f"join (select * from ({NATIONS}) where borough <> 'Unknown') d on dropoff_location_id = d.location_id"
    )


def _amounts(facts: str, keys: str) -> str:
    return f"""
    select
        {keys},
        sum(fare_amount) as revenue_monthly_fare,
        sum(extra) as revenue_monthly_extra,
        sum(mta_tax) as revenue_monthly_mta_tax,
        sum(tip_amount) as revenue_monthly_tip_amount,
        sum(tolls_amount) as revenue_monthly_tolls_amount,
        sum(ehail_fee) as revenue_monthly_ehail_fee,
        sum(improvement_surcharge) as revenue_monthly_improvement_surcharge,
        sum(total_amount) as revenue_monthly_total_amount,
        sum(congestion_surcharge) as revenue_monthly_congestion_surcharge,
        count(trip_id) as total_monthly_trips,
        cast(sum(passenger_count) as double) / count(passenger_count) as avg_montly_passenger_count,
        cast(cast(sum(trip_distance) as double) / count(trip_distance) as decimal(38,9)) as avg_montly_trip_distance
    from ({facts})
    group by all"""


def _revenue(facts: str) -> str:
    return _amounts(
        facts, "pickup_zone as revenue_zone, date_trunc('month', pickup_ts) as revenue_month, service_type"
    )


FACTS = _facts(GREEN, YELLOW)
REVENUE = _revenue(FACTS)


def _delivered(kind: str) -> str:
    return " union all ".join(
        f"select * replace ({shifted} as ts) from events where {rows} and {frames.EVENT_KINDS[kind]}"
        for rows, shifted in frames.DELIVERED.values()
    )


# loading nulls the drifting columns
EVENT_FACTS = _facts(
    _staged(
        {**frames.EVENT_GREEN_COLUMNS, "ehail_fee": "null"}, GREEN_SOURCE, f"({_delivered('green')})", "lpep", "trip_type"
    ),
    _staged({**frames.EVENT_YELLOW_COLUMNS, "airport_fee": "null"}, YELLOW_SOURCE, f"({_delivered('yellow')})", "tpep", "1"),
)

_FIRST, _SECOND = frames.MONTHS
DELIVERIES = " union all ".join(
    f"select * replace (cast(null as bigint) as airport_fee), '{month}' as source_month, "
    "cast(pickup_datetime as date) as pickup_date from "
    f"(select {_mapped(frames.FHV_COLUMNS, FHV_SOURCE)} "
    f"from (select * replace ({shifted} as ts) from events where {rows}))"
    for month, (rows, shifted) in frames.DELIVERED.items()
)
WHOLE = (
    f"select * replace (cast(null as bigint) as airport_fee), '{_FIRST}' as source_month, "
    "cast(pickup_datetime as date) as pickup_date "
    f"from (select {_mapped(frames.FHV_COLUMNS, FHV_SOURCE)} from events)"
)


def _check(table: str, check: str, column: str, severity: str, offending: str) -> str:
    return (
        f"select '{table}' as table_name, '{check}' as check_name, '{column}' as column_name, "
        f"'{severity}' as severity, n as failures, case when n = 0 then 'pass' else '{severity}' end as status "
        f"from (select count(*) as n from ({offending}))"
    )


def _repeated(rows: str, keys: str) -> str:
    return f"select {keys} from ({rows}) group by {keys} having count(*) > 1"


_TOTAL = "revenue_monthly_total_amount"
REPORT = " union all ".join((
    _check("stg_green_taxi_trips", "unique", "trip_id", "warn", _repeated(GREEN, "trip_id")),
    _check("stg_green_taxi_trips", "not_null", "trip_id", "warn", f"select 1 from ({GREEN}) where trip_id is null"),
    _check("stg_yellow_taxi_trips", "unique", "trip_id", "warn", _repeated(YELLOW, "trip_id")),
    _check("stg_yellow_taxi_trips", "not_null", "trip_id", "warn", f"select 1 from ({YELLOW}) where trip_id is null"),
    _check(
        "stg_green_taxi_trips",
        "accepted_values",
        "payment_type",
        "warn",
        f"select distinct payment_type from ({GREEN}) where payment_type not in (1, 2, 3, 4, 5, 6)",
    ),
    _check("fact_trips", "unique", "service_type, trip_id", "warn", _repeated(FACTS, "service_type, trip_id")),
    _check(
        "monthly_zone_revenue_cube", "not_null", _TOTAL, "error", f"select 1 from ({REVENUE}) where {_TOTAL} is null"
    ),
    _check(
        "fhv_trips",
        "freshness",
        "ts",
        "error",
        "select 1 from (select max(ts) as newest from events) where newest < timestamp '2024-01-30 18:00:00'",
    ),
))

ZONE_ROWS = (
    "select cast(location_id as integer) as LocationID, borough as Borough, zone as Zone, "
    f"replace(service_zone, 'Green', 'Boro') as service_zone from ({CUSTOMERS})"
)

ORACLE = {
    "monthly_zone_revenue": REVENUE,
    "fact_trips": FACTS,
    "fact_trips_service_counts": f"select service_type, count(trip_id) as trips from ({FACTS}) group by 1",
    "stg_green": GREEN,
    "stg_yellow": YELLOW,
    "stg_fhv": FHV,
    "fact_fhv": FHV,
    "dim_zones": CUSTOMERS,
    "build_warehouse": REVENUE,
    "refresh_warehouse": _revenue(EVENT_FACTS),
    "merged_revenue": _amounts(FACTS, "service_type"),
    "known_zones": f"select * from ({CUSTOMERS}) where borough <> 'Unknown'",
    "dedup_skewed": (
        "select event_id, ts, user_id, event_type, value, props from (select *, row_number() over "
        "(partition by event_type order by event_id, ts, user_id, value, props) as rn from events) where rn = 1"
    ),
    "dedup_null_key": (
        "select event_id, ts, user_id, value, props, kind from (select *, row_number() over "
        "(partition by user_id, kind order by event_id, ts, value, props) as rn "
        "from (select *, nullif(event_type, 'view') as kind from events)) where rn = 1"
    ),
    "surrogate_key_nulls": (
        f"select event_id, md5({_text('user_id')} || '-' || coalesce(nullif(event_type, 'view'), '') "
        f"|| '-' || {_text('ts')}) as key from events"
    ),
    "decode_payment": f"select {_label('l_linenumber')} as label, count(*) as n from lineitem group by 1",
    "int_cast_half_up": (
        "select cast(round(l_quantity * 0.5 - 12) as bigint) as rounded, count(*) as n from lineitem group by 1"
    ),
    "star_replace_null": "select * replace (cast(null as double) as o_totalprice) from orders",
    "typed_contract": (
        'select c_custkey as "C_CUSTKEY", cast(c_nationkey as bigint) as c_nationkey, '
        "cast(round(c_acctbal) as bigint) as c_acctbal, c_name, cast(null as double) as c_fee from customer"
    ),
    "zone_name_merge": (
        "select zone as pickup_zone, count(*) as trips, sum(cast(l_extendedprice as decimal(38,9))) as fare "
        f"from lineitem join ({PARTS}) on l_partkey = location_id where borough <> 'Unknown' group by 1"
    ),
    "avg_int_and_decimal": (
        "select l_suppkey, cast(sum(l_linenumber) as double) / count(l_linenumber) as avg_int, "
        "cast(cast(sum(cast(l_quantity as decimal(38,9))) as double) / count(l_quantity) as decimal(38,9)) "
        "as avg_decimal from lineitem group by 1"
    ),
    "month_labels": (
        "select date_trunc('month', o_orderdate) as month, strftime(o_orderdate, '%Y-%m') as file_label, "
        "strftime(o_orderdate, '%Y_%m') as table_label, count(*) as n from orders group by all"
    ),
    "row_count_capped": "select count(*) as n from lineitem limit 500",
    "sample_limit": f"select * from ({GREEN}) order by trip_id limit 100",
    "preview": "select * from orders order by o_orderkey limit 5",
    "expire_rows": (
        "select *, cast(l_shipdate as date) as ship_date from lineitem "
        "where cast(l_shipdate as date) > date '2001-11-04' - 1000"
    ),
    "read_whole_file": "select * from orders",
    "csv_roundtrip": "select * from events",
    "csv_line_breaks": (
        "select * replace ('\"' || event_type || '\"' || chr(10) || ',' || chr(10) || cast(event_id as varchar) as event_type, "
        "props || chr(10) as props) from events"
    ),
    "csv_inferred": ZONE_ROWS,
    "load_zones": ZONE_ROWS,
    "csv_to_parquet": "select * from orders",
    "read_month": (
        f"select * exclude (source_month, pickup_date) from ({DELIVERIES}) where source_month = '{_SECOND}'"
    ),
    "load_months": DELIVERIES,
    "promote_raw": DELIVERIES,
    "promote_stream": DELIVERIES,
    "rebuild_table": DELIVERIES,
    "partitioned_window": (
        f"select * from ({WHOLE}) where pickup_datetime >= timestamp '2024-01-05 00:00:00' "
        "and pickup_datetime < timestamp '2024-01-06 12:00:00'"
    ),
    "expire_partitions": f"select * from ({WHOLE}) where pickup_date > date '2024-01-30' - 12",
    "external_table": "select event_type, count(*) as n, max(ts) as last_ts from events group by 1",
    "external_drift": (
        "select event_id, case when ts < timestamp '2024-01-16 00:00:00' then ts "
        "else cast(cast(ts as date) as timestamp) end as ts, cast(user_id as double) as user_id, event_type, value, "
        "case when ts < timestamp '2024-01-16 00:00:00' then props end as props from events"
    ),
    "table_refresh": "select * from orders",
    "view_scan": f"select hvfhs_license_code, count(*) as trips, sum(driver_pay) as pay from ({FHV}) group by 1",
    "replace_append": "select * from customer union all select * replace (-c_custkey as c_custkey) from customer",
    "load_month_tables": (
        "select source_month as table_month, count(*) as trips, max(pickup_datetime) as last_pickup "
        f"from ({DELIVERIES}) group by 1"
    ),
    "load_csv_table": "select * from events",
    "check_unique": (
        "select key, count(*) as n_records from (select nullif(l_orderkey, 7) as key from lineitem) "
        "where key is not null group by 1 having count(*) > 1"
    ),
    "check_unique_bucketed": (
        "select key, count(*) as n_records from (select nullif(l_orderkey, 7) as key from lineitem) "
        "where key is not null group by 1 having count(*) > 1"
    ),
    "check_not_null": "select *, cast(null as varchar) as flag from lineitem where l_returnflag = 'R'",
    "check_accepted": (
        "select payment_type, count(*) as n_records from (select nullif(l_linenumber, 2) as payment_type "
        "from lineitem) where payment_type not in (1, 2, 3, 4, 5, 6) group by 1"
    ),
    "check_relationships": (
        "select * from (select * replace (nullif(o_custkey, 0) as o_custkey) from orders) "
        "where o_custkey is not null and o_custkey not in "
        f"(select location_id from ({CUSTOMERS}) where borough <> 'Unknown')"
    ),
    "orphan_counts": (
        "select l_linestatus, count(*) as n from lineitem where l_partkey not in "
        f"(select location_id from ({PARTS}) where borough <> 'Unknown') group by 1"
    ),
    # the newest event counts as 6 hours and 0.9 seconds old
    "check_freshness": """
        select
            newest as max_loaded_at,
            timestamp '2024-01-31 00:00:00' as as_of,
            date_sub('second', newest, timestamp '2024-01-31 00:00:00') as age_seconds,
            case when newest >= timestamp '2024-01-30 18:00:00' then 'pass' else 'error' end as status
        from (select max(least(ts, timestamp '2024-01-30 17:59:59.1')) as newest from events)""",
    "check_report": REPORT,
}
