from __future__ import annotations

import datetime as dt

import pytest

from tripmart.operators import checks
from tripmart.operators.checks import ERROR, WARN, Check


@pytest.fixture
def keyed(spark):
    return spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, None), (None, "c"), (None, "c")], "k bigint, s string")


def test_unique_exempts_null(keyed):
    assert [tuple(r) for r in checks.unique(keyed, "k").collect()] == [(1, 3)]
    assert [tuple(r) for r in checks.unique(keyed, "k", "s").collect()] == [(1, "a", 2)]


def test_not_null_returns_the_rows(keyed):
    assert [tuple(r) for r in checks.not_null(keyed, "k").collect()] == [(None, "c"), (None, "c")]


def test_accepted_values_lets_null_pass(keyed):
    assert [tuple(r) for r in checks.accepted_values(keyed, "k", [1]).collect()] == [(2, 1)]
    assert checks.accepted_values(keyed, "s", ["a", "b", "c"]).count() == 0


def test_relationships_let_null_pass(spark, keyed):
    parents = spark.createDataFrame([(1,)], "id bigint")
    assert [r.k for r in checks.relationships(keyed, "k", parents, "id").collect()] == [2]


@pytest.mark.parametrize(("hours", "status"), [(6, "pass"), (5, "error")])
def test_freshness_counts_the_boundary_as_fresh(spark, zone, hours, status):
    df = spark.createDataFrame([(dt.datetime(2019, 3, 10, 1),), (dt.datetime(2019, 3, 9),), (None,)], "t timestamp_ntz")
    as_of = dt.datetime(2019, 3, 10, 7)
    for name in ("UTC", "America/New_York"):
        with zone(name):
            row = checks.freshness(df, "t", as_of, hours).first()
            assert tuple(row) == (dt.datetime(2019, 3, 10, 1), as_of, 6 * 3600, status)
            assert checks.stale(df, "t", as_of, hours).count() == (status == "error")


def test_freshness_is_judged_to_the_fraction_of_a_second(spark):
    df = spark.createDataFrame([(dt.datetime(2019, 3, 10, 1),)], "t timestamp_ntz")
    late = dt.datetime(2019, 3, 10, 7, 0, 0, 900_000)
    assert tuple(checks.freshness(df, "t", late, 6).first())[2:] == (6 * 3600, "error")


def test_freshness_of_an_empty_table_is_an_error(spark):
    df = spark.createDataFrame([], "t timestamp_ntz")
    assert checks.freshness(df, "t", dt.datetime(2024, 1, 1)).first().status == "error"


def test_report_and_enforce(spark, keyed):
    warned = Check("t", "unique", "k", WARN, checks.unique(keyed, "k"))
    passed = Check("t", "accepted_values", "k", ERROR, checks.accepted_values(keyed, "k", [1, 2]))
    failed = Check("t", "not_null", "k", ERROR, checks.not_null(keyed, "k"))
    rows = {r.check_name: (r.severity, r.failures, r.status) for r in checks.report([warned, passed, failed]).collect()}
    assert rows == {
        "unique": ("warn", 1, "warn"),
        "accepted_values": ("error", 0, "pass"),
        "not_null": ("error", 2, "error"),
    }
    checks.enforce(checks.report([warned, passed]))
    with pytest.raises(checks.CheckFailed, match="t.k not_null: 2 rows"):
        checks.enforce(checks.report([warned, passed, failed]))


RULES = (
    checks.must_be_unique("k"),
    checks.must_be_present("k"),
    checks.must_be_unique("k", "s"),
    checks.must_be_one_of("k", [1]),
    checks.must_be_one_of("s", ["a", "b"]),
    checks.must_be_fresh("t", dt.datetime(2019, 3, 10, 7)),
    checks.must_be_present("s"),
)


def plain_failures(df, rule):
    if rule.name == "unique":
        return checks.unique(df, *rule.columns).count()
    if rule.name == "not_null":
        return checks.not_null(df, *rule.columns).count()
    if rule.name == "accepted_values":
        return checks.accepted_values(df, *rule.columns, rule.values).count()
    return checks.stale(df, *rule.columns, dt.datetime(2019, 3, 10, 7)).count()


@pytest.mark.parametrize("rows", ["all", "none", "nulls"])
@pytest.mark.parametrize("chosen", [RULES, RULES[:1], RULES[1:2], RULES[5:], RULES[3:5], RULES[:2] + RULES[5:6]])
def test_compiled_rules_count_what_single_checks_find(spark, rows, chosen):
    at = dt.datetime(2019, 3, 10, 1)
    data = {
        "all": [(1, "a", at), (1, "a", None), (1, "b", at), (2, None, at), (None, "c", at), (None, "c", None), (3, "d", at)],
        "none": [],
        "nulls": [(None, None, None)] * 2,
    }[rows]
    df = spark.createDataFrame(data, "k bigint, s string, t timestamp_ntz")
    found = checks.report(checks.ruled("t", df, WARN, *chosen)).collect()
    assert [r.failures for r in found] == [plain_failures(df, rule) for rule in chosen]
    assert [(r.check_name, r.column_name) for r in found] == [(c.name, ", ".join(c.columns)) for c in chosen]


def test_all_rules_of_a_frame_share_one_scan_and_one_exchange(spark, database, plan):
    spark.range(100).selectExpr("id % 7 AS k", "'a' AS s", "timestamp_ntz '2019-03-10 01:00:00' AS t").write.saveAsTable(
        f"{database}.t"
    )
    text = plan(checks.report(checks.ruled("t", spark.table(f"{database}.t"), WARN, *RULES)))
    body = text.split("\n\n(")[0]
    assert body.count("Scan parquet") == 1 and body.count("Exchange") == 2 and body.count("Expand") == 1
    # without a key there is nothing to expand
    rows = [r for r in RULES if not r.key]
    body = plan(checks.report(checks.ruled("t", spark.table(f"{database}.t"), WARN, *rows))).split("\n\n(")[0]
    assert body.count("Scan parquet") == 1 and body.count("Exchange") == 1 and "Expand" not in body


def test_texts_that_must_be_unique_travel_as_bytes_that_differ_when_they_do(spark, plan):
    digest, other = "0cc175b9c0f1b6a831c399e269772661", "92eb5ffee6ae2fec3ad71c777531578f"
    spelt = "abcdefghijklmnop"  # the 16 bytes that the last digest spells
    texts = [digest, digest, digest.upper(), other, spelt.encode().hex(), spelt, spelt + "\0", spelt + "\0\0"]
    texts += ["", "\0", "é" * 16, "é" * 16, "z" * 32, "z" * 32, digest[:31] + "\n", None, None]
    df = spark.createDataFrame([(t, i % 2) for i, t in enumerate(texts)], "k string, n int")
    rules = [checks.must_be_unique("k"), checks.must_be_present("k"), checks.must_be_unique("n", "k")]
    found = checks.report(checks.ruled("t", df, WARN, *rules))
    assert [r.failures for r in found.collect()] == [3, 2, checks.unique(df, "n", "k").count()]
    assert "unhex" in plan(found)
    # values are compared as the texts they are
    rules = [checks.must_be_unique("k"), checks.must_be_one_of("k", [digest])]
    found = checks.report(checks.ruled("t", df, WARN, *rules))
    assert [r.failures for r in found.collect()] == [3, checks.accepted_values(df, "k", [digest]).count()]


def test_a_hot_key_is_combined_before_the_exchange(spark, plan):
    df = spark.range(1000).selectExpr("if(id % 3 = 0, 7, id) AS k", "'x' AS s", "timestamp_ntz '2019-03-10 01:00:00' AS t")
    assert "partial_count" in plan(checks.report(checks.ruled("t", df, WARN, *RULES)))
    assert [r.failures for r in checks.report(checks.ruled("t", df, WARN, RULES[0])).collect()] == [1]
