"""Session settings and the shared scratch folder."""

from __future__ import annotations

import datetime as dt
import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

MIB = 1024 * 1024
#: A session setting that stands in for the calendar (``YYYY-MM-DD``).
TODAY = "tripmart.today"


def settings(input_bytes: int, cores: int) -> dict[str, str]:
    """Spark SQL settings for a job over ``input_bytes`` on ``cores``.

    The shuffle gets one partition per 256 MiB of input and never fewer than the cores.
    Adaptive execution merges what turns out small and splits what turns out skewed.
    """
    partitions = max(cores, math.ceil(input_bytes / (256 * MIB)))
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(256 * MIB),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MIB),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        # never group on a partitioning by part of the key, where one value may be hot
        "spark.sql.requireAllClusterKeysForDistribution": "true",
        # a session that runs the models in turn needs more than the default 100 compiled stages
        "spark.sql.codegen.cache.maxEntries": "1000",
        # recording the Python call site of each column expression costs more than building it
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }


def today(spark: SparkSession) -> dt.date:
    """The date that retention counts from: the session's current date, unless the session sets ``tripmart.today``."""
    fixed = spark.conf.get(TODAY, None)
    return dt.date.fromisoformat(fixed) if fixed else spark.sql("SELECT current_date() AS today").first().today


def scratch_folder(spark: SparkSession, label: str | None = None) -> str:
    """A new folder name under the shared folder in ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it gets a temporary checkpoint folder.
    A labelled folder is the application's only one of that label: what an earlier call put
    there goes.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not shared:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="tripmart-")
        context.setCheckpointDir(shared)
    if label is None:
        return f"{shared.rstrip('/')}/tripmart-{uuid.uuid4().hex}"
    folder = f"{shared.rstrip('/')}/tripmart-{context.applicationId}-{label}"
    remove(spark, folder)
    return folder


def scratch_database(spark: SparkSession, label: str | None = None) -> str:
    """A new database whose tables live in a scratch folder; a label replaces its earlier one."""
    name = f"tripmart_{label or uuid.uuid4().hex}"
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    folder = scratch_folder(spark, None if label is None else f"{label}-tables")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}'")
    return name


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file in whatever store the path names, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Change one session setting for the duration of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
