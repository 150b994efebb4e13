"""Source frames of the warehouse, drawn from order, line-item and event tables.

The mappings are SQL text that Spark and DuckDB read alike, so a query and its oracle
start from the same rows and share nothing after that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.contracts import FHV_SOURCE, GREEN_SOURCE, YELLOW_SOURCE, Contract

_TRIP = {
    "VendorID": "nullif(l_suppkey, 3)",
    "store_and_fwd_flag": "l_returnflag",
    "RatecodeID": "nullif(l_linenumber, 3)",
    "PULocationID": "nullif(s_nationkey, 5)",
    "DOLocationID": "c_nationkey",
    "passenger_count": "l_quantity * 0.5 - 2",
    "trip_distance": "l_quantity",
    "fare_amount": "l_extendedprice",
    "extra": "l_discount",
    "mta_tax": "l_tax",
    "tip_amount": "l_extendedprice * l_discount",
    "tolls_amount": "l_quantity * l_tax",
    "improvement_surcharge": "l_tax",
    "total_amount": "l_extendedprice * (1 + l_tax)",
    "payment_type": "l_linenumber",
    "congestion_surcharge": "l_discount",
}
GREEN_COLUMNS = {
    **_TRIP,
    "lpep_pickup_datetime": "l_shipdate",
    "lpep_dropoff_datetime": "l_shipdate + interval '90' minute",
    "ehail_fee": "l_discount",
    "trip_type": "l_linenumber",
}
YELLOW_COLUMNS = {
    **_TRIP,
    "tpep_pickup_datetime": "l_shipdate",
    "tpep_dropoff_datetime": "l_shipdate + interval '90' minute",
    "airport_fee": "l_orderkey",
}
LOCATED = (
    "lineitem join supplier on l_suppkey = s_suppkey "
    "join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey"
)

# street-hail trips of two months, for deliveries by month: hours as pickup times, so that trips collide
_EVENT_TRIP = {
    "VendorID": "nullif(user_id % 7, 3)",
    "store_and_fwd_flag": "event_type",
    "RatecodeID": "nullif(user_id % 6, 3)",
    "PULocationID": "nullif(user_id % 25, 5)",
    "DOLocationID": "event_id % 25",
    "passenger_count": "user_id % 5 + 0.5",
    "trip_distance": "value",
    "fare_amount": "value * 2",
    "extra": "0.5",
    "mta_tax": "0.5",
    "tip_amount": "value * 0.25",
    "tolls_amount": "value * 0.5",
    "improvement_surcharge": "0.3",
    "total_amount": "value * 3",
    "payment_type": "event_id % 8",
    "congestion_surcharge": "2.5",
}
EVENT_GREEN_COLUMNS = {
    **_EVENT_TRIP,
    "lpep_pickup_datetime": "date_trunc('hour', ts)",
    "lpep_dropoff_datetime": "ts + interval '30' minute",
    "ehail_fee": "value",
    "trip_type": "event_id % 3",
}
EVENT_YELLOW_COLUMNS = {
    **_EVENT_TRIP,
    "tpep_pickup_datetime": "date_trunc('hour', ts)",
    "tpep_dropoff_datetime": "ts + interval '30' minute",
    "airport_fee": "event_id",
}
EVENT_KINDS = {"green": "event_type in ('click', 'view')", "yellow": "event_type not in ('click', 'view')"}

FHV_COLUMNS = {
    "hvfhs_license_num": "event_type",
    "dispatching_base_num": "cast(user_id as string)",
    "originating_base_num": "nullif(event_type, 'view')",
    "request_datetime": "ts - interval '5' minute",
    "on_scene_datetime": "ts - interval '30' second",
    "pickup_datetime": "ts",
    "dropoff_datetime": "ts + interval '45' minute",
    "PULocationID": "user_id",
    "DOLocationID": "event_id",
    "trip_miles": "value",
    "trip_time": "event_id",
    "base_passenger_fare": "value * 2",
    "tolls": "value * 0.5",
    "bcf": "value * 0.03",
    "sales_tax": "value * 0.08",
    "congestion_surcharge": "2.75",
    "airport_fee": "event_id",
    "tips": "value",
    "driver_pay": "value * 0.7",
    "shared_request_flag": "case when event_type = 'click' then 'Y' else 'N' end",
    "shared_match_flag": "case when event_type = 'view' then 'Y' else 'N' end",
    "access_a_ride_flag": "nullif(event_type, 'error')",
    "wav_request_flag": "case when user_id > 50 then 'Y' else 'N' end",
    "wav_match_flag": "case when user_id > 75 then 'Y' else 'N' end",
}

# nations as zones: every trip end resolves to one, some of them in the Unknown borough
NATION_ZONES = {
    "LocationID": "n_nationkey",
    "Borough": "case r_name when 'AFRICA' then 'Unknown' else r_name end",
    "Zone": "n_name",
    "service_zone": "case r_name when 'ASIA' then 'Boro Zone' when 'EUROPE' then null else 'Yellow Zone' end",
}
# customers and parts as zones: dimensions that grow with the data
CUSTOMER_ZONES = {
    "LocationID": "c_custkey",
    "Borough": "case c_mktsegment when 'AUTOMOBILE' then 'Unknown' when 'MACHINERY' then null else c_mktsegment end",
    "Zone": "c_name",
    "service_zone": "case c_mktsegment when 'BUILDING' then 'Boro Zone' when 'FURNITURE' then null else 'Yellow Zone' end",
}
PART_ZONES = {
    "LocationID": "p_partkey",
    "Borough": "case p_brand when 'Brand#1' then 'Unknown' else p_brand end",
    "Zone": "p_name",
    "service_zone": "p_type",
}

# two monthly deliveries: the second holds some rows of a month that is not its own
MONTHS = ("2024-01", "2024-02")
DELIVERED = {
    MONTHS[0]: ("ts < timestamp '2024-01-16 00:00:00'", "ts"),
    MONTHS[1]: (
        "ts >= timestamp '2024-01-16 00:00:00'",
        "case when ts >= timestamp '2024-01-20 00:00:00' then ts + interval '31' day else ts end",
    ),
}


# The driver tables' columns. Declaring them saves a footer-reading job per table.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def mapped(df: DataFrame, columns: dict[str, str], contract: Contract) -> DataFrame:
    return df.selectExpr(*[f"cast({columns[name]} as {dtype}) as {name}" for name, dtype in contract.columns])


def located_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the nations of their supplier and of their customer.

    Orders meet customers first, so the narrow rows travel for that join and both services
    reuse its result. The supplier join, whose key may be hot, is followed by a join on
    another key, which leaves adaptive execution free to split it.
    """
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    ends = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    return (
        table(spark, sf_dir, "lineitem")
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(ends, F.col("l_orderkey") == F.col("o_orderkey"))
    )


def green_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = located_lines(spark, sf_dir).filter(F.col("l_linestatus") == "O")
    return mapped(lines, GREEN_COLUMNS, GREEN_SOURCE)


def yellow_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = located_lines(spark, sf_dir).filter(F.col("l_linestatus") == "F")
    return mapped(lines, YELLOW_COLUMNS, YELLOW_SOURCE)


def fhv_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapped(table(spark, sf_dir, "events"), FHV_COLUMNS, FHV_SOURCE)


def fhv_delivery(spark: SparkSession, sf_dir: str, month: str) -> DataFrame:
    rows, shifted = DELIVERED[month]
    events = table(spark, sf_dir, "events").filter(rows).withColumn("ts", F.expr(shifted))
    return mapped(events, FHV_COLUMNS, FHV_SOURCE)


def street_hail_delivery(spark: SparkSession, sf_dir: str, kind: str, month: str) -> DataFrame:
    """One month of green or yellow trips."""
    rows, shifted = DELIVERED[month]
    events = table(spark, sf_dir, "events").filter(rows).filter(EVENT_KINDS[kind]).withColumn("ts", F.expr(shifted))
    if kind == "green":
        return mapped(events, EVENT_GREEN_COLUMNS, GREEN_SOURCE)
    return mapped(events, EVENT_YELLOW_COLUMNS, YELLOW_SOURCE)


def nation_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return _zones(nations, NATION_ZONES)


def customer_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zones(table(spark, sf_dir, "customer"), CUSTOMER_ZONES)


def part_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zones(table(spark, sf_dir, "part"), PART_ZONES)


def _zones(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{text} as {name}" for name, text in columns.items()])
