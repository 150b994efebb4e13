"""Every registered query against its SQL, types and values, on the smallest tables."""

from __future__ import annotations

import os

import pytest
from compare import connect, difference

import __spark_entry__ as driver
from tripmart.standins.oracle import ORACLE
from tripmart.standins.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = driver.queries()[name](spark, SF_DIR)
    assert difference(df, con, driver.oracle_sql()[name]) is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["dedup_skewed", "zone_name_merge", "monthly_zone_revenue"])
def test_results_do_not_follow_zone_or_parallelism(spark, con, zone, name):
    from tripmart.session import setting

    with zone("America/New_York"), setting(spark, "spark.sql.shuffle.partitions", "3"):
        with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
            df = driver.queries()[name](spark, SF_DIR)
            assert difference(df, con, driver.oracle_sql()[name]) is None
