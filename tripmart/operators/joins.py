"""Joins between trips and the zone dimension.

No join carries a broadcast hint. Catalyst broadcasts the dimension only while its known
size is under ``spark.sql.autoBroadcastJoinThreshold``; a larger one is shuffled, and
adaptive execution then splits the partitions of over-full keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_zone(trips: DataFrame, zones: DataFrame, role: str) -> DataFrame:
    """Add ``<role>_borough`` and ``<role>_zone`` by ``<role>_location_id``.

    Trips with a NULL location or one that ``zones`` does not list are dropped.
    """
    key = f"{role}_location_id"
    named = zones.select(
        F.col("location_id").alias(key),
        F.col("borough").alias(f"{role}_borough"),
        F.col("zone").alias(f"{role}_zone"),
    )
    return trips.join(named, key, "inner")


def union_services(**staged: DataFrame) -> DataFrame:
    """Stack staged services, tagged with their name in ``service_type``."""
    frames = [df.withColumn("service_type", F.lit(name)) for name, df in staged.items()]
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame)
    return stacked


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL ``key`` has no parent."""
    parents = parent.select(F.col(parent_key).alias("__parent"))
    present = child.filter(F.col(key).isNotNull())
    return present.join(parents, F.col(key) == F.col("__parent"), "left_anti")
