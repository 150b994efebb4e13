"""Column contracts, code labels and storage names of the trip warehouse.

Everything in this module is a fixed value that has to agree with the data and the
names the warehouse's users already query; no logic lives here beyond small accessors.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Contract:
    """Ordered ``(column, Spark SQL type)`` pairs."""

    columns: tuple[tuple[str, str], ...]

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{name}` {dtype}" for name, dtype in self.columns)

    def type_of(self, name: str) -> str:
        return dict(self.columns)[name]

    def without(self, *names: str) -> Contract:
        return Contract(tuple(c for c in self.columns if c[0] not in names))

    def plus(self, *columns: tuple[str, str]) -> Contract:
        return Contract(self.columns + columns)


# The exact decimal type every amount is staged to.
NUMERIC = "decimal(38,9)"

# Source column lists, in table order.
YELLOW_SOURCE = Contract((
    ("VendorID", "bigint"),
    ("tpep_pickup_datetime", "timestamp_ntz"),
    ("tpep_dropoff_datetime", "timestamp_ntz"),
    ("passenger_count", "double"),
    ("trip_distance", "double"),
    ("RatecodeID", "double"),
    ("store_and_fwd_flag", "string"),
    ("PULocationID", "bigint"),
    ("DOLocationID", "bigint"),
    ("payment_type", "bigint"),
    ("fare_amount", "double"),
    ("extra", "double"),
    ("mta_tax", "double"),
    ("tip_amount", "double"),
    ("tolls_amount", "double"),
    ("improvement_surcharge", "double"),
    ("total_amount", "double"),
    ("congestion_surcharge", "double"),
    ("airport_fee", "bigint"),
))

GREEN_SOURCE = Contract((
    ("VendorID", "bigint"),
    ("lpep_pickup_datetime", "timestamp_ntz"),
    ("lpep_dropoff_datetime", "timestamp_ntz"),
    ("store_and_fwd_flag", "string"),
    ("RatecodeID", "double"),
    ("PULocationID", "bigint"),
    ("DOLocationID", "bigint"),
    ("passenger_count", "double"),
    ("trip_distance", "double"),
    ("fare_amount", "double"),
    ("extra", "double"),
    ("mta_tax", "double"),
    ("tip_amount", "double"),
    ("tolls_amount", "double"),
    ("ehail_fee", "double"),
    ("improvement_surcharge", "double"),
    ("total_amount", "double"),
    ("payment_type", "double"),
    ("trip_type", "double"),
    ("congestion_surcharge", "double"),
))

FHV_SOURCE = Contract((
    ("hvfhs_license_num", "string"),
    ("dispatching_base_num", "string"),
    ("originating_base_num", "string"),
    ("request_datetime", "timestamp_ntz"),
    ("on_scene_datetime", "timestamp_ntz"),
    ("pickup_datetime", "timestamp_ntz"),
    ("dropoff_datetime", "timestamp_ntz"),
    ("PULocationID", "bigint"),
    ("DOLocationID", "bigint"),
    ("trip_miles", "double"),
    ("trip_time", "bigint"),
    ("base_passenger_fare", "double"),
    ("tolls", "double"),
    ("bcf", "double"),
    ("sales_tax", "double"),
    ("congestion_surcharge", "double"),
    ("airport_fee", "bigint"),
    ("tips", "double"),
    ("driver_pay", "double"),
    ("shared_request_flag", "string"),
    ("shared_match_flag", "string"),
    ("access_a_ride_flag", "string"),
    ("wav_request_flag", "string"),
    ("wav_match_flag", "string"),
))

ZONE_SOURCE = Contract((
    ("LocationID", "int"),
    ("Borough", "string"),
    ("Zone", "string"),
    ("service_zone", "string"),
))

# Output column lists, in table order.
STAGED_TRIP = Contract((
    ("trip_id", "string"),
    ("vendor_id", "bigint"),
    ("rate_code_id", "bigint"),
    ("pickup_location_id", "bigint"),
    ("dropoff_location_id", "bigint"),
    ("store_and_fwd_flag", "string"),
    ("passenger_count", "bigint"),
    ("trip_distance", NUMERIC),
    ("trip_type", "bigint"),
    ("fare_amount", NUMERIC),
    ("extra", NUMERIC),
    ("mta_tax", NUMERIC),
    ("tip_amount", NUMERIC),
    ("tolls_amount", NUMERIC),
    ("ehail_fee", NUMERIC),
    ("improvement_surcharge", NUMERIC),
    ("total_amount", NUMERIC),
    ("payment_type", "bigint"),
    ("payment_type_description", "string"),
    ("congestion_surcharge", NUMERIC),
    ("pickup_ts", "timestamp_ntz"),
    ("dropoff_ts", "timestamp_ntz"),
))

FACT_TRIP = Contract((
    ("trip_id", "string"),
    ("vendor_id", "bigint"),
    ("service_type", "string"),
    ("rate_code_id", "bigint"),
    ("pickup_location_id", "bigint"),
    ("pickup_borough", "string"),
    ("pickup_zone", "string"),
    ("dropoff_location_id", "bigint"),
    ("dropoff_borough", "string"),
    ("dropoff_zone", "string"),
    ("pickup_ts", "timestamp_ntz"),
    ("dropoff_ts", "timestamp_ntz"),
    ("store_and_fwd_flag", "string"),
    ("passenger_count", "bigint"),
    ("trip_distance", NUMERIC),
    ("trip_type", "bigint"),
    ("fare_amount", NUMERIC),
    ("extra", NUMERIC),
    ("mta_tax", NUMERIC),
    ("tip_amount", NUMERIC),
    ("tolls_amount", NUMERIC),
    ("ehail_fee", NUMERIC),
    ("improvement_surcharge", NUMERIC),
    ("total_amount", NUMERIC),
    ("payment_type", "bigint"),
    ("payment_type_description", "string"),
    ("congestion_surcharge", NUMERIC),
))

STAGED_FHV = Contract((
    ("trip_id", "string"),
    ("hvfhs_license_code", "string"),
    ("dispatching_base_code", "string"),
    ("originating_base_code", "string"),
    ("pickup_location_id", "bigint"),
    ("dropoff_location_id", "bigint"),
    ("shared_request_flag", "string"),
    ("shared_match_flag", "string"),
    ("access_a_ride_flag", "string"),
    ("wav_request_flag", "string"),
    ("wav_match_flag", "string"),
    ("trip_distance", NUMERIC),
    ("trip_time", NUMERIC),
    ("base_passenger_fare", NUMERIC),
    ("tolls", NUMERIC),
    ("bcf", NUMERIC),
    ("sales_tax", NUMERIC),
    ("congestion_surcharge", NUMERIC),
    ("driver_pay", NUMERIC),
    ("request_ts", "timestamp_ntz"),
    ("on_scene_ts", "timestamp_ntz"),
    ("pickup_ts", "timestamp_ntz"),
    ("dropoff_ts", "timestamp_ntz"),
))

ZONE_DIMENSION = Contract((
    ("location_id", "bigint"),
    ("borough", "string"),
    ("zone", "string"),
    ("service_zone", "string"),
))

# Amounts summed by the revenue mart -> output column.
REVENUE_SUMS = {
    "fare_amount": "revenue_monthly_fare",
    "extra": "revenue_monthly_extra",
    "mta_tax": "revenue_monthly_mta_tax",
    "tip_amount": "revenue_monthly_tip_amount",
    "tolls_amount": "revenue_monthly_tolls_amount",
    "ehail_fee": "revenue_monthly_ehail_fee",
    "improvement_surcharge": "revenue_monthly_improvement_surcharge",
    "total_amount": "revenue_monthly_total_amount",
    "congestion_surcharge": "revenue_monthly_congestion_surcharge",
}

# Payment codes and labels; any other code has no label.
PAYMENT_TYPES = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}

# The borough of trips with no usable location, and the zone relabelling.
UNKNOWN_BOROUGH = "Unknown"
BORO_LABEL, GREEN_LABEL = "Boro", "Green"

# Database, retention, check threshold, default sample and cap sizes.
DATABASE = "trips_data_all"
RETENTION_DAYS = 10000
FRESHNESS_HOURS = 6
ADHOC_ROWS = 500
PREVIEW_ROWS = 5
JDBC_BATCH_ROWS = 100000


@dataclass(frozen=True)
class Service:
    """Where one trip service lands, how its files are named and how it is typed."""

    landing_prefix: str
    raw_prefix: str
    folder: str
    table: str
    source: Contract
    pickup: str
    first_month: str
    last_month: str | None = None
    drifting: tuple[str, ...] = field(default=())

    @property
    def table_contract(self) -> Contract:
        """The source columns followed by the two partition columns."""
        return self.source.plus(("source_month", "string"), ("pickup_date", "date"))


# File, folder and table names, first and last month, nulled columns.
YELLOW = Service(
    landing_prefix="yellow_tripdata_",
    raw_prefix="output_yellow_taxi_",
    folder="yellow_taxi",
    table="yellow_taxi_trips",
    source=YELLOW_SOURCE,
    pickup="tpep_pickup_datetime",
    first_month="2019-01",
    drifting=("airport_fee",),
)
GREEN = Service(
    landing_prefix="green_tripdata_",
    raw_prefix="output_green_taxi_",
    folder="green_taxi",
    table="green_taxi_trips",
    source=GREEN_SOURCE,
    pickup="lpep_pickup_datetime",
    first_month="2019-01",
    drifting=("ehail_fee",),
)
FHV = Service(
    landing_prefix="fhvhv_tripdata_",
    raw_prefix="output_fhvhv_",
    folder="fhvhv",
    table="fhv_trips",
    source=FHV_SOURCE,
    pickup="pickup_datetime",
    first_month="2019-01",
    last_month="2020-01",
    drifting=("airport_fee",),
)
ZONE_TABLE = "taxi_zones"
ZONE_FILE = "output_taxi_zones.parquet"
SERVICES = (YELLOW, GREEN, FHV)
