from __future__ import annotations

import os
import sys
from contextlib import contextmanager

import pytest
from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

from tripmart.contracts import FHV_SOURCE, GREEN_SOURCE, YELLOW_SOURCE, ZONE_SOURCE, Contract  # noqa: E402
from tripmart.session import scratch_database, setting  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tripmart-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def database(spark):
    return scratch_database(spark)


@pytest.fixture
def zone(spark):
    """Switch the session time zone inside a block."""

    @contextmanager
    def switch(name: str):
        with setting(spark, "spark.sql.session.timeZone", name):
            yield

    return switch


@pytest.fixture
def plan(capsys):
    """The formatted physical plan of a frame."""

    def text(df: DataFrame) -> str:
        capsys.readouterr()
        df.explain("formatted")
        return capsys.readouterr().out

    return text


@pytest.fixture
def rows(spark):
    """Frames in a source's columns; unnamed columns are NULL."""

    def frame(contract: Contract, *records: dict) -> DataFrame:
        unknown = {k for r in records for k in r} - set(contract.names)
        assert not unknown, unknown
        values = [tuple(r.get(n) for n in contract.names) for r in records]
        return spark.createDataFrame(values, contract.ddl)

    return frame


@pytest.fixture
def green(rows):
    return lambda *records: rows(GREEN_SOURCE, *records)


@pytest.fixture
def yellow(rows):
    return lambda *records: rows(YELLOW_SOURCE, *records)


@pytest.fixture
def fhv(rows):
    return lambda *records: rows(FHV_SOURCE, *records)


@pytest.fixture
def zones(rows):
    """Eight zones: two share a name, one has no borough, two are unknown."""
    records = [
        (1, "EWR", "Newark Airport", "EWR"),
        (4, "Manhattan", "Alphabet City", "Yellow Zone"),
        (7, "Queens", "Astoria", "Boro Zone"),
        (56, "Queens", "Corona", "Boro Zone"),
        (57, "Queens", "Corona", "Boro Zone"),
        (90, None, "Nowhere", None),
        (264, "Unknown", "NV", "N/A"),
        (265, "Unknown", None, "N/A"),
    ]
    return rows(ZONE_SOURCE, *[dict(zip(ZONE_SOURCE.names, r)) for r in records])
