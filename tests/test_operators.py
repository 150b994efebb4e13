from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tripmart.contracts import Contract
from tripmart.operators import sampling
from tripmart.operators.dedup import crowded, keep_first, keep_first_in_ranges
from tripmart.operators.joins import orphans, union_services, with_zone
from tripmart.operators.shape import between_ts, conform, replace_with_null, unexpired
from tripmart.session import setting, settings


def skewed(spark, n=3000, seed=3):
    """Repeated keys, a third of the rows under one of them, and NULL keys."""
    draw = random.Random(seed)
    values = []
    for i in range(n):
        key = (1, 1) if i % 3 == 0 else (draw.choice([None, 2, 3, 4]), draw.choice([None, *range(40)]))
        values.append((*key, draw.choice([None, "a", "b"]), float(draw.randrange(5)), draw.randrange(8)))
    return values, spark.createDataFrame(values, "k1 bigint, k2 bigint, s string, d double, n bigint")


def brute_force(values):
    def order(row):
        return [(x is not None, x if x is not None else 0) for x in row]

    first = {}
    for row in values:
        key, rest = row[:2], row[2:]
        if key not in first or order(rest) < order(first[key]):
            first[key] = rest
    return {(*k, *v) for k, v in first.items()}


def test_keep_first_against_brute_force_in_any_order(spark):
    values, df = skewed(spark)
    want = brute_force(values)
    for frame in (df, df.repartition(1), df.repartition(7, "n"), df.orderBy(F.desc("n")).coalesce(2)):
        got = [tuple(r) for r in keep_first(frame, ["k1", "k2"]).collect()]
        assert len(got) == len(set(got)) == len(want)
        assert set(got) == want


def test_keep_first_with_an_order_and_without_case(spark):
    values, df = skewed(spark)
    got = keep_first(df, ["K1", "K2"], order=["n", "d", "s"])
    assert got.columns == df.columns
    assert got.count() == len(brute_force(values))


def test_keep_first_treats_negative_zero_as_zero(spark):
    df = spark.createDataFrame([(0.0, 1), (-0.0, 2), (1.0, 3)], "k double, n bigint")
    assert sorted(r.n for r in keep_first(df, ["k"]).collect()) == [1, 3]


def test_keep_first_when_every_column_is_key(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (1, 3)], "a bigint, b bigint")
    assert sorted(tuple(r) for r in keep_first(df, ["a", "b"]).collect()) == [(1, 2), (1, 3)]


def test_keep_first_limits_groups_before_the_shuffle(spark, plan):
    _, df = skewed(spark)
    text = plan(keep_first(df, ["k1", "k2"]))
    assert "Partial" in text and "Final" in text and text.count("WindowGroupLimit") >= 4
    assert "Exchange" in text and "EvalPython" not in text


@pytest.mark.parametrize("reduced", [False, True])
def test_keep_first_in_ranges_against_brute_force_in_any_order(spark, reduced):
    values, df = skewed(spark)
    want = brute_force(values)
    hot = crowded(df, ["k1", "k2"], least=100) if reduced else []
    assert bool(hot) == reduced
    for frame in (df, df.repartition(1), df.repartition(7, "n"), df.orderBy(F.desc("n")).coalesce(2)):
        kept = keep_first_in_ranges(frame, ["K1", "k2"], hot)
        got = [tuple(r) for r in kept.collect()]
        assert kept.columns == df.columns and len(got) == len(want) and set(got) == want


def test_keep_first_in_ranges_when_every_column_is_key(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (1, 3), (None, 3), (None, 3)], "a bigint, b bigint")
    for hot in ([], crowded(df, ["a", "b"], least=2)):
        assert sorted(map(str, keep_first_in_ranges(df, ["a", "b"], hot).collect())) == sorted(
            map(str, keep_first(df, ["a", "b"]).collect())
        )


def test_keep_first_in_ranges_shuffles_once_and_leaves_each_range_to_one_task(spark, plan):
    _, df = skewed(spark)
    key = "spark.sql.requireAllClusterKeysForDistribution"
    for value in ("true", "false"):
        with setting(spark, key, value):
            kept = keep_first_in_ranges(df, ["k2", "k1"])
            text = plan(kept).split("\n\n(")[0]
            assert text.count("Exchange") == 1 and "rangepartitioning(k2" in plan(kept)
    with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        ranges = kept.groupBy(F.spark_partition_id().alias("task")).agg(F.min("k2").alias("low"), F.max("k2").alias("high"))
        ranges = sorted((r.low, r.high) for r in ranges.collect() if r.low is not None)
    assert len(ranges) > 1 and all(high <= low for (_, high), (low, _) in zip(ranges, ranges[1:]))


def test_a_hot_key_is_combined_before_ranges_are_dealt(spark, plan):
    _, df = skewed(spark)
    keys = ["k1", "k2"]
    assert crowded(df, keys) == [] and len(crowded(df, keys, least=100)) == 1
    text = plan(keep_first_in_ranges(df, keys, crowded(df, keys, least=100)))
    assert "partial_min(struct(" in text


def test_keep_first_is_not_grouped_on_part_of_its_key(spark, plan):
    _, df = skewed(spark)
    key = "spark.sql.requireAllClusterKeysForDistribution"
    assert settings(0, 1)[key] == "true"
    with setting(spark, key, "true"):
        assert "hashpartitioning(__key_hash" in plan(keep_first(df.repartition("k1"), ["k1", "k2"]))


def test_conform_binds_by_name_rounds_and_nulls(spark):
    contract = Contract((("A", "bigint"), ("b", "timestamp_ntz"), ("c", "double"), ("d", "string")))
    df = spark.sql("SELECT 'x' AS D, 2.5D AS a, TIMESTAMP '2020-01-01 00:00:00Z' AS B, 9 AS c, 1 AS extra")
    got = conform(df, contract, nulled=["c"])
    assert got.dtypes == list(contract.columns)
    assert tuple(got.first()) == (3, dt.datetime(2020, 1, 1), None, "x")


def test_conform_refuses_missing_columns_but_not_missing_nulled_ones(spark):
    contract = Contract((("a", "bigint"), ("fee", "double")))
    df = spark.range(1).withColumnRenamed("id", "a")
    assert conform(df, contract, nulled=["fee"]).columns == ["a", "fee"]
    with pytest.raises(ValueError, match="fee"):
        conform(df, contract)


def test_replace_with_null_keeps_position_and_type(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "a bigint, b double, c string")
    got = replace_with_null(df, "b")
    assert got.dtypes == df.dtypes and tuple(got.first()) == (1, None, "x")


def test_between_ts_is_half_open(spark):
    times = [dt.datetime(2020, 1, d, h) for d in (1, 2, 3) for h in (0, 12)]
    df = spark.createDataFrame([(t, t.date()) for t in times], "t timestamp_ntz, d date")
    got = between_ts(df, "t", "d", dt.datetime(2020, 1, 1, 12), dt.datetime(2020, 1, 3))
    assert sorted(r.t for r in got.collect()) == times[1:4]


def test_unexpired_drops_the_boundary_day_and_keeps_undated_rows(spark):
    as_of = dt.date(2024, 1, 30)
    days = [as_of, as_of - dt.timedelta(days=9999), as_of - dt.timedelta(days=10000), None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert {r.d for r in unexpired(df, "d", as_of).collect()} == {days[0], days[1], None}


def test_union_services_matches_columns_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "n bigint, s string")
    b = spark.createDataFrame([("y", 2)], "s string, n bigint")
    assert {tuple(r) for r in union_services(Green=a, Yellow=b).collect()} == {(1, "x", "Green"), (2, "y", "Yellow")}


def test_zone_join_is_the_same_broadcast_or_shuffled(spark, zones, plan):
    trips = spark.range(2000).select(
        F.expr("CASE WHEN id % 3 = 0 THEN 4 WHEN id % 5 = 0 THEN NULL ELSE id % 300 END").alias("pickup_location_id"),
        "id",
    )
    dim = zones.selectExpr("CAST(LocationID AS bigint) AS location_id", "Borough AS borough", "Zone AS zone")
    small = with_zone(trips, dim, "pickup")
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        large = with_zone(trips, dim, "pickup")
        assert "SortMergeJoin" in plan(large)
        shuffled = sorted(map(tuple, large.collect()), key=repr)
    assert sorted(map(tuple, small.collect()), key=repr) == shuffled
    assert shuffled and all(r[0] in {1, 4, 7, 56, 57, 90, 264, 265} for r in shuffled)


def test_a_hot_zone_is_split_when_zones_are_too_many_to_broadcast(spark):
    trips = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 20_000).alias("pickup_location_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    dim = spark.range(20_000).selectExpr("id AS location_id", "'b' AS borough", "string(id) AS zone")
    with (
        setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"),
        setting(spark, "spark.sql.adaptive.autoBroadcastJoinThreshold", "-1"),
        setting(spark, "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1000000"),
        setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "1000000"),
        setting(spark, "spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5"),
    ):
        joined = with_zone(trips, dim, "pickup")
        assert len(joined.collect()) == 300_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k bigint")
    parent = spark.createDataFrame([(1,), (None,)], "p bigint")
    assert [r.k for r in orphans(child, "k", parent, "p").collect()] == [2]


def test_limits(spark):
    df = spark.range(1000).withColumn("key", F.lpad(F.col("id").cast("string"), 5, "0"))
    assert [r.id for r in sampling.sample_rows(df, "key", 3).orderBy("id").collect()] == [0, 1, 2]
    assert sampling.sample_rows(df, "key", None).count() == 1000
    assert [r.id for r in sampling.preview(df, "id").collect()] == [0, 1, 2, 3, 4]
    assert sampling.preview(df).count() == 5
    assert sampling.ad_hoc(spark, "SELECT * FROM {t}", t=df).count() == 500
    assert sampling.ad_hoc(spark, "SELECT COUNT(*) AS n FROM {t}", t=df).first().n == 1000
