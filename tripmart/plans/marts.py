"""Dimension, fact and revenue tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.contracts import FACT_TRIP, NUMERIC, REVENUE_SUMS, STAGED_FHV
from tripmart.functions import month_start, service_zone_label
from tripmart.operators.joins import union_services, with_zone
from tripmart.operators.shape import bind, known_zones


def dim_zones(zones: DataFrame) -> DataFrame:
    """The zone dimension from the zone lookup."""
    return zones.select(
        bind(zones, "LocationID", "bigint").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
        service_zone_label("service_zone").alias("service_zone"),
    )


def fact_trips(green: DataFrame, yellow: DataFrame, zones: DataFrame) -> DataFrame:
    """Staged trips of both services whose two ends are known zones."""
    usable = known_zones(zones)
    trips = union_services(Green=green, Yellow=yellow)
    for role in ("pickup", "dropoff"):
        trips = with_zone(trips, usable, role)
    return trips.select(*FACT_TRIP.names)


def fact_fhv_trips(staged: DataFrame) -> DataFrame:
    return staged.select(*STAGED_FHV.names)


#: The groups of the revenue mart and its averages: what is averaged, the column of the average and of its sum and count.
REVENUE_KEYS = ("revenue_zone", "revenue_month", "service_type")
TRIPS = "total_monthly_trips"
PASSENGERS = ("passenger_count", "avg_montly_passenger_count", "passengers", "passenger_trips")
DISTANCE = ("trip_distance", "avg_montly_trip_distance", "distance", "distance_trips")


def revenue_states(facts: DataFrame) -> DataFrame:
    """Sums and counts per pickup zone name, month and service: what revenue is made of and can be merged by.

    Zones sharing a name share a row. The grouping shrinks the facts to zones x months x
    services inside each task before anything is shuffled.
    """
    groups = facts.groupBy(
        F.col("pickup_zone").alias("revenue_zone"),
        month_start("pickup_ts").alias("revenue_month"),
        "service_type",
    )
    return groups.agg(
        *[F.sum(amount).alias(name) for amount, name in REVENUE_SUMS.items()],
        F.count("trip_id").alias(TRIPS),
        *[
            column
            for value, _, total, trips in (PASSENGERS, DISTANCE)
            for column in (F.sum(value).alias(total), F.count(value).alias(trips))
        ],
    )


def merged_states(states: DataFrame, *keys: str) -> DataFrame:
    """States of coarser groups, or of the same groups that several states hold parts of, from states alone."""
    names = [c for c in states.columns if c in REVENUE_SUMS.values() or c in (TRIPS, *PASSENGERS[2:], *DISTANCE[2:])]
    return states.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in names])


def averaged(keys: Iterable[str] = REVENUE_KEYS) -> list[str]:
    """SQL of the revenue columns over states: sums and counts as they are, averages formed on reading."""
    _, people, passengers, passenger_trips = PASSENGERS
    _, length, distance, distance_trips = DISTANCE
    return [
        *keys,
        *REVENUE_SUMS.values(),
        TRIPS,
        f"CAST({passengers} AS DOUBLE) / nullif({passenger_trips}, 0) AS {people}",
        f"CAST({distance} / nullif({distance_trips}, 0) AS {NUMERIC}) AS {length}",
    ]


def monthly_zone_revenue(facts: DataFrame) -> DataFrame:
    """Amounts, trip count and averages per pickup zone name, month and service."""
    return revenue_states(facts).selectExpr(*averaged())
