"""Staged trips: one lazy frame per source table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.contracts import GREEN, STAGED_FHV, STAGED_TRIP, YELLOW, Service
from tripmart.functions import (
    constant,
    payment_type_description,
    surrogate_key,
    to_integer,
    to_numeric,
    to_wall_clock,
)
from tripmart.operators.dedup import crowded, keep_first, keep_first_in_ranges
from tripmart.operators.sampling import sample_rows
from tripmart.operators.shape import bind

# Staged column -> source column, by the type it is staged to.
_TRIP_INTEGERS = {
    "vendor_id": "VendorID",
    "rate_code_id": "RatecodeID",
    "pickup_location_id": "PULocationID",
    "dropoff_location_id": "DOLocationID",
    "passenger_count": "passenger_count",
    "payment_type": "payment_type",
}
_TRIP_AMOUNTS = (
    "trip_distance",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
)
_FHV_RENAMED = {
    "hvfhs_license_code": "hvfhs_license_num",
    "dispatching_base_code": "dispatching_base_num",
    "originating_base_code": "originating_base_num",
}
_FHV_FLAGS = (
    "shared_request_flag",
    "shared_match_flag",
    "access_a_ride_flag",
    "wav_request_flag",
    "wav_match_flag",
)
_FHV_INTEGERS = {"pickup_location_id": "PULocationID", "dropoff_location_id": "DOLocationID"}
_FHV_AMOUNTS = {
    "trip_distance": "trip_miles",
    "trip_time": "trip_time",
    "base_passenger_fare": "base_passenger_fare",
    "tolls": "tolls",
    "bcf": "bcf",
    "sales_tax": "sales_tax",
    "congestion_surcharge": "congestion_surcharge",
    "driver_pay": "driver_pay",
}
_FHV_TIMES = {
    "request_ts": "request_datetime",
    "on_scene_ts": "on_scene_datetime",
    "pickup_ts": "pickup_datetime",
    "dropoff_ts": "dropoff_datetime",
}


Keep = Callable[[DataFrame, Sequence[str]], DataFrame]


def stage_green(source: DataFrame, sample_limit: int | None = None, keep: Keep = keep_first) -> DataFrame:
    """Green trips: one per vendor and pickup time, typed, keyed and decoded."""
    return _stage_street_hail(source, GREEN, "lpep_dropoff_datetime", to_integer("trip_type"), sample_limit, keep)


def stage_yellow(source: DataFrame, sample_limit: int | None = None, keep: Keep = keep_first) -> DataFrame:
    """Yellow trips, which are street-hail by definition (trip type 1)."""
    return _stage_street_hail(source, YELLOW, "tpep_dropoff_datetime", constant(1, "bigint"), sample_limit, keep)


def in_ranges(source: DataFrame, service: Service) -> Keep:
    """A way for staging to keep one trip per key that leaves the trips in ranges of pickup time.

    Runs a job over the source that looks for hot keys.
    """
    hot = crowded(_vendored(source), _key(service))
    return lambda trips, keys: keep_first_in_ranges(trips, keys, hot)


def _key(service: Service) -> list[str]:
    return [service.pickup, "VendorID"]


def _vendored(source: DataFrame) -> DataFrame:
    return source.filter(F.col("VendorID").isNotNull())


def _stage_street_hail(
    source: DataFrame, service: Service, dropoff: str, trip_type: Column, sample_limit: int | None, keep: Keep
) -> DataFrame:
    trips = keep(_vendored(source), _key(service))
    staged = {
        "trip_id": surrogate_key("VendorID", service.pickup),
        **{name: bind(trips, c, "bigint") for name, c in _TRIP_INTEGERS.items()},
        **{name: to_numeric(name) for name in _TRIP_AMOUNTS},
        "store_and_fwd_flag": F.col("store_and_fwd_flag"),
        "trip_type": trip_type,
        "ehail_fee": to_numeric(F.lit(0)),
        "payment_type_description": payment_type_description("payment_type"),
        "pickup_ts": to_wall_clock(service.pickup),
        "dropoff_ts": to_wall_clock(dropoff),
    }
    frame = trips.select(*[staged[name].alias(name) for name in STAGED_TRIP.names])
    return sample_rows(frame, "trip_id", sample_limit)


def stage_fhv(source: DataFrame) -> DataFrame:
    """For-hire trips: renamed, typed and keyed. Repeated rows are kept."""
    staged = {
        "trip_id": surrogate_key("hvfhs_license_num", "dispatching_base_num", "pickup_datetime"),
        **{name: F.col(c) for name, c in _FHV_RENAMED.items()},
        **{name: F.col(name) for name in _FHV_FLAGS},
        **{name: bind(source, c, "bigint") for name, c in _FHV_INTEGERS.items()},
        **{name: to_numeric(c) for name, c in _FHV_AMOUNTS.items()},
        **{name: to_wall_clock(c) for name, c in _FHV_TIMES.items()},
    }
    return source.select(*[staged[name].alias(name) for name in STAGED_FHV.names])
