from __future__ import annotations

import datetime as dt
import hashlib
import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from tripmart.functions import (
    month_label,
    month_start,
    payment_type_description,
    service_zone_label,
    surrogate_key,
    to_integer,
    to_numeric,
    utc_wall_clock,
)

ZONES = ("UTC", "America/New_York", "Asia/Kolkata", "America/Sao_Paulo")


def test_integers_round_halves_away_from_zero(spark):
    draw = random.Random(5)
    values = [1.5, 2.5, -1.5, 0.49999999999999994, -0.5, 0.0, 4503599627370497.5, None]
    values += [draw.uniform(-1e6, 1e6) for _ in range(500)] + [draw.randrange(-1000, 1000) + 0.5 for _ in range(200)]
    got = [r.n for r in spark.createDataFrame([(v,) for v in values], "v double").select(to_integer("v").alias("n")).collect()]
    want = [None if v is None else int(Decimal(v).quantize(Decimal(1), ROUND_HALF_UP)) for v in values]
    assert got == want


def test_integer_of_integer_and_type(spark):
    df = spark.range(3).select(to_integer("id").alias("n"))
    assert dict(df.dtypes) == {"n": "bigint"}
    assert [r.n for r in df.collect()] == [0, 1, 2]


def test_numeric_keeps_the_cents(spark):
    df = spark.createDataFrame([(12.57,), (None,)], "v double").select(to_numeric("v").alias("n"))
    assert df.dtypes == [("n", "decimal(38,9)")]
    assert [r.n for r in df.collect()] == [Decimal("12.570000000"), None]


def test_surrogate_key_counts_null_as_empty_text(spark):
    at = dt.datetime(2019, 3, 10, 2, 30)
    df = spark.createDataFrame([("a", None, at), (None, None, None)], "a string, b bigint, t timestamp_ntz")
    got = [r.k for r in df.select(surrogate_key("a", "b", "t").alias("k")).collect()]
    assert got == [hashlib.md5(text).hexdigest() for text in (b"a--2019-03-10 02:30:00", b"--")]


def test_surrogate_key_does_not_follow_the_session_zone(spark, zone):
    df = spark.createDataFrame([(1, dt.datetime(2019, 3, 10, 2, 30))], "v bigint, t timestamp_ntz")
    keys = set()
    for name in ZONES:
        with zone(name):
            keys.add(df.select(surrogate_key("v", "t").alias("k")).first().k)
    assert keys == {hashlib.md5(b"1-2019-03-10 02:30:00").hexdigest()}


def test_payment_codes(spark):
    df = spark.createDataFrame([(float(c),) for c in range(1, 8)] + [(None,)], "c double")
    got = [r.d for r in df.select(payment_type_description("c").alias("d")).collect()]
    assert got == ["Credit card", "Cash", "No charge", "Dispute", "Unknown", "Voided trip", None, None]


def test_service_zone_label(spark):
    df = spark.createDataFrame([("Boro Zone",), ("Yellow Zone",), (None,)], "z string")
    assert [r.z for r in df.select(service_zone_label("z").alias("z")).collect()] == ["Green Zone", "Yellow Zone", None]


def test_month_edges_in_any_session_zone(spark, zone):
    times = [dt.datetime(2019, 3, 31, 23, 59, 59), dt.datetime(2019, 4, 1), dt.datetime(2018, 11, 4, 0, 30)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    for name in ZONES:
        with zone(name):
            got = df.select(month_start("t").alias("m"), month_label("t").alias("a"), month_label("t", "_").alias("b"))
            assert dict(got.dtypes)["m"] == "timestamp_ntz"
            assert [tuple(r) for r in got.collect()] == [
                (dt.datetime(2019, 3, 1), "2019-03", "2019_03"),
                (dt.datetime(2019, 4, 1), "2019-04", "2019_04"),
                (dt.datetime(2018, 11, 1), "2018-11", "2018_11"),
            ]


def test_instants_become_utc_wall_clock(spark, zone):
    for name in ZONES:
        with zone(name):
            instant = spark.sql("SELECT TIMESTAMP '2019-03-10 07:30:00.123456Z' AS t")
            got = instant.select(utc_wall_clock("t").alias("t"))
            assert got.dtypes == [("t", "timestamp_ntz")]
            assert got.first().t == dt.datetime(2019, 3, 10, 7, 30, 0, 123456)


def test_no_helper_leaves_the_jvm(spark, plan):
    df = spark.range(5).select(F.col("id").cast("double").alias("v"), F.lit(dt.datetime(2019, 1, 1)).alias("t"))
    text = plan(df.select(to_integer("v"), to_numeric("v"), surrogate_key("v"), payment_type_description("v")))
    assert "EvalPython" not in text
