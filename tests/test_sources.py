from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tripmart.contracts import FHV, GREEN, YELLOW, Contract
from tripmart.operators.shape import between_ts
from tripmart.session import scratch_database, scratch_folder, setting, settings, today
from tripmart.sources import files, ledger, relational, tables, versions
from tripmart.streaming import promote_available

NARROW = Contract((("t", "timestamp_ntz"), ("s", "string"), ("d", "double"), ("n", "bigint")))


@pytest.fixture
def folder(spark):
    return scratch_folder(spark)


@pytest.fixture
def trips(yellow):
    """One trip per given pickup, numbered by distance."""

    def make(*pickups):
        return yellow(*[
            {"VendorID": 1, "tpep_pickup_datetime": p, "trip_distance": float(i), "airport_fee": 5}
            for i, p in enumerate(pickups)
        ])

    return make


def on(*days, month=1, hour=9):
    return [dt.datetime(2019, month, d, hour) for d in days]


def contents(df):
    return sorted((r.source_month, str(r.pickup_date), r.tpep_pickup_datetime) for r in df.collect())


# ------------------------------------------------------------------ files


def test_csv_keeps_microseconds_quotes_and_nulls(spark, folder):
    rows = [
        (dt.datetime(2019, 3, 10, 2, 30, 0, 123456), 'say "hi", {"k": 1}', 0.1, 1),
        (dt.datetime(2019, 3, 10), "back\\slash", None, None),
        (None, None, 1e-9, 3),
    ]
    files.write_csv(spark.createDataFrame(rows, NARROW.ddl), f"{folder}/t")
    back = files.read_csv(spark, f"{folder}/t", NARROW)
    assert back.dtypes == list(NARROW.columns)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(rows, key=repr)


@pytest.mark.parametrize("line", ["abc,x,1.5,abc", "2019-01-01 00:00:00,x", '2019-01-01 00:00:00,"x\ny",1.5,1'])
def test_csv_that_does_not_fit_its_contract_raises(spark, folder, line):
    os.makedirs(folder)
    with open(f"{folder}/t.csv", "w") as out:
        out.write(f"t,s,d,n\n{line}\n")
    for action in (lambda df: df.collect(), lambda df: df.count(), lambda df: df.select("s").collect()):
        with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
            action(files.read_csv(spark, f"{folder}/t.csv", NARROW))


def test_csv_takes_both_forms_of_a_timestamp(spark, folder):
    os.makedirs(folder)
    with open(f"{folder}/t.csv", "w") as out:
        out.write("t,s,d,n\n2019-01-02T03:04:05,x,1.5,1\n2019-01-02 03:04:05.000006,y,,\n")
    at = dt.datetime(2019, 1, 2, 3, 4, 5)
    got = [r.t for r in files.read_csv(spark, f"{folder}/t.csv", NARROW).orderBy("s").collect()]
    assert got == [at, at.replace(microsecond=6)]


def test_csv_refuses_to_write_line_breaks(spark, folder):
    df = spark.createDataFrame([("a\nb", 1)], "s string, n int")
    with pytest.raises(Exception, match="line break in column s"):
        files.write_csv(df, f"{folder}/t")


def test_csv_to_parquet_converts_or_refuses(spark, folder, zones):
    files.write_csv(zones, f"{folder}/zones.csv")
    copy = files.csv_to_parquet(spark, f"{folder}/zones.csv", f"{folder}/zones.parquet")
    assert dict(copy.dtypes)["LocationID"] == "int"
    assert sorted(map(tuple, copy.collect()), key=repr) == sorted(map(tuple, zones.collect()), key=repr)
    with pytest.raises(ValueError, match="zones.txt"):
        files.csv_to_parquet(spark, f"{folder}/zones.txt", f"{folder}/zones2.parquet")


def test_a_month_is_bound_to_the_contract_whatever_its_types(spark, folder):
    drifted = spark.sql(
        "SELECT 2 AS vendorid, TIMESTAMP_NTZ '2019-01-05 10:00:00' AS tpep_pickup_datetime, "
        "TIMESTAMP_NTZ '2019-01-05 10:10:00' AS tpep_dropoff_datetime, 3L AS passenger_count, 1.5D AS trip_distance, "
        "1L AS RatecodeID, 'N' AS store_and_fwd_flag, 4 AS PULocationID, 7 AS DOLocationID, 1.0D AS payment_type, "
        "9.5D AS fare_amount, 0D AS extra, 0D AS mta_tax, 0D AS tip_amount, 0D AS tolls_amount, "
        "0D AS improvement_surcharge, 9.5D AS total_amount, 0D AS congestion_surcharge, 'text' AS airport_fee"
    )
    drifted.write.parquet(files.landing_path(folder, YELLOW, "2019-01"))
    got = files.read_month(spark, folder, YELLOW, "2019-01")
    assert got.dtypes == list(YELLOW.source.columns)
    row = got.first()
    assert (row.VendorID, row.passenger_count, row.payment_type, row.airport_fee) == (2, 3.0, 1, None)


def test_file_names():
    assert files.landing_path("/l", FHV, "2019-02") == "/l/fhvhv_tripdata_2019-02.parquet"
    assert files.raw_path("/r", GREEN, "2019-02") == "/r/raw/output_green_taxi_2019-02.parquet"
    assert files.service_folder("/r", YELLOW) == "/r/yellow_taxi"


# ------------------------------------------------------------------ trip tables


def test_months_between():
    assert list(tables.months_between("2019-11", "2020-02")) == ["2019-11", "2019-12", "2020-01", "2020-02"]
    assert list(tables.months_between("2020-02", "2020-01")) == []


def test_loading_a_month_again_changes_nothing(spark, database, trips):
    table = tables.create_trip_table(spark, YELLOW, database)
    for _ in range(2):
        tables.load_month(trips(*on(1, 1, 2)), YELLOW, table, "2019-01")
    loaded = spark.table(table)
    assert loaded.count() == 3 and loaded.filter("airport_fee IS NOT NULL").count() == 0
    assert loaded.dtypes == list(YELLOW.table_contract.columns)


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_a_redelivery_replaces_its_month_and_only_that(spark, database, trips, mode):
    key = "spark.sql.sources.partitionOverwriteMode"
    with setting(spark, key, mode):
        table = tables.create_trip_table(spark, YELLOW, database)
        tables.load_month(trips(*on(1, 2, 3)), YELLOW, table, "2019-01")
        stray = on(2, hour=23)
        tables.load_month(trips(*on(5, month=2), *stray), YELLOW, table, "2019-02")
        tables.load_month(trips(*on(1, 3)), YELLOW, table, "2019-01")
        assert spark.conf.get(key).lower() == mode
    days = [(m, d) for m, d, _ in contents(spark.table(table))]
    assert days == [
        ("2019-01", "2019-01-01"),
        ("2019-01", "2019-01-03"),
        ("2019-02", "2019-01-02"),
        ("2019-02", "2019-02-05"),
    ]


def test_undated_trips_are_kept(spark, database, trips):
    table = tables.create_trip_table(spark, YELLOW, database)
    for _ in range(2):
        tables.load_month(trips(None, *on(1)), YELLOW, table, "2019-01")
    assert spark.table(table).filter("pickup_date IS NULL").count() == 1
    tables.expire_partitions(spark, table, dt.date(2099, 1, 1))
    assert [r.pickup_date for r in spark.table(table).collect()] == [None]


def test_a_month_label_must_be_a_month(trips):
    with pytest.raises(ValueError, match="2019-13"):
        tables.load_month(trips(), YELLOW, "t", "2019-13")


def test_load_months_needs_an_end(spark):
    with pytest.raises(ValueError, match="last month"):
        tables.load_months(spark, "/nowhere", YELLOW, "t")


def test_load_months_from_landing(spark, database, folder, trips):
    trips(*on(1)).write.parquet(files.landing_path(folder, YELLOW, "2019-01"))
    trips(*on(1, month=2)).write.parquet(files.landing_path(folder, YELLOW, "2019-02"))
    table = tables.create_trip_table(spark, YELLOW, database)
    assert tables.load_months(spark, folder, YELLOW, table, last="2019-02").count() == 2


def test_a_hot_day_is_written_by_several_tasks(spark, database, folder):
    # rebalancing by date splits a partition that exceeds the advisory size
    df = spark.range(200_000).selectExpr(
        "id AS VendorID",
        "TIMESTAMP_NTZ '2019-01-01 00:00:00' AS tpep_pickup_datetime",
        "TIMESTAMP_NTZ '2019-01-01 00:00:00' AS tpep_dropoff_datetime",
        *[f"rand({i}) AS {n}" for i, (n, t) in enumerate(YELLOW.source.columns) if t == "double"],
        "uuid() AS store_and_fwd_flag",
        "id AS PULocationID",
        "id AS DOLocationID",
        "id AS payment_type",
    )
    table = tables.create_trip_table(spark, YELLOW, database)
    with setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", str(2 * 1024 * 1024)):
        tables.load_month(df, YELLOW, table, "2019-01")
    written = spark.table(table)
    assert written.count() == 200_000 and len(written.inputFiles()) > 1


def test_a_small_day_is_written_by_one_task(spark, database, trips):
    table = tables.create_trip_table(spark, YELLOW, database)
    spread = trips(*[t for hour in range(12) for t in on(1, 2, hour=hour)]).repartition(8)
    tables.load_month(spread, YELLOW, table, "2019-01")
    assert spark.table(table).count() == 24 and len(spark.table(table).inputFiles()) == 2


def test_expire_partitions(spark, database, trips):
    table = tables.create_trip_table(spark, YELLOW, database)
    tables.load_month(trips(*on(1, 2, 3)), YELLOW, table, "2019-01")
    boundary = dt.date(2019, 1, 2) + dt.timedelta(days=10000)
    assert [str(r.pickup_date) for r in tables.expire_partitions(spark, table, boundary).collect()] == ["2019-01-03"]
    assert spark.sql(f"SHOW PARTITIONS {versions.stored(spark, table)}").count() == 1
    assert tables.expire_partitions(spark, table, boundary).count() == 1


def test_a_time_window_prunes_dates(spark, database, trips, plan):
    table = tables.create_trip_table(spark, YELLOW, database)
    tables.load_month(trips(*on(1, 2, 3, 4)), YELLOW, table, "2019-01")
    window = dt.datetime(2019, 1, 2), dt.datetime(2019, 1, 4)
    df = between_ts(spark.table(table), YELLOW.pickup, "pickup_date", *window)
    assert [r.pickup_date.day for r in df.orderBy("pickup_date").collect()] == [2, 3]
    text = plan(df)
    filters = next(line for line in text.splitlines() if line.startswith("PartitionFilters"))
    assert "2019-01-02" in filters and "2019-01-03" in filters
    assert f"GreaterThanOrEqual({YELLOW.pickup},2019-01-02T00:00)" in text


def test_promote_takes_new_raw_months_and_named_ones(spark, database, folder, trips):
    table = tables.create_trip_table(spark, YELLOW, database)

    def days(**named):
        return [(m, d) for m, d, _ in contents(tables.promote(spark, folder, YELLOW, table, **named))]

    assert days() == []
    files.write_raw(trips(*on(1)), folder, YELLOW, "2019-01")
    assert days() == [("2019-01", "2019-01-01")]
    files.write_raw(trips(*on(1, month=2), *on(31)), folder, YELLOW, "2019-02")
    files.write_raw(trips(*on(5)), folder, YELLOW, "2019-01")
    second = [("2019-02", "2019-01-31"), ("2019-02", "2019-02-01")]
    assert days() == [("2019-01", "2019-01-01"), *second]
    assert days(months=["2019-01"]) == [("2019-01", "2019-01-05"), *second]


def test_streaming_promotes_each_file_once_and_rebuild_reads_it(spark, database, folder, trips):
    def run():
        promote_available(spark, folder, YELLOW, f"{folder}/checkpoint", files_per_batch=1).awaitTermination()
        return files.read_service(spark, folder, YELLOW)

    files.write_raw(trips(*on(1, 2)), folder, YELLOW, "2019-01")
    assert run().count() == 2
    assert run().count() == 2
    files.write_raw(trips(*on(3, month=2)), folder, YELLOW, "2019-02")
    promoted = run()
    assert sorted(r.source_month for r in promoted.collect()) == ["2019-01", "2019-01", "2019-02"]
    assert promoted.filter("airport_fee IS NOT NULL").count() == 0
    for _ in range(2):
        rebuilt = tables.rebuild(spark, folder, YELLOW, database)
        assert rebuilt.dtypes == list(YELLOW.table_contract.columns)
        days = [(m, d) for m, d, _ in contents(rebuilt)]
        assert days == [("2019-01", "2019-01-01"), ("2019-01", "2019-01-02"), ("2019-02", "2019-02-03")]
    table = f"{database}.{YELLOW.table}"
    tables.load_month(trips(*on(9)), YELLOW, table, "2019-01")
    kept = tables.expire_partitions(spark, table, dt.date(2019, 2, 3), days=10)
    assert [(m, d) for m, d, _ in contents(kept)] == [("2019-02", "2019-02-03")]


def stream(spark, folder):
    promote_available(spark, folder, YELLOW, f"{folder}/checkpoint").awaitTermination()
    rows = files.read_service(spark, folder, YELLOW).collect()
    days = [(r.source_month, r.tpep_pickup_datetime and r.tpep_pickup_datetime.day) for r in rows]
    return sorted(days, key=lambda d: (d[0], d[1] or 0))


def test_streaming_replaces_a_redelivered_month(spark, folder, trips):
    files.write_raw(trips(*on(1, 2)), folder, YELLOW, "2019-01")
    assert stream(spark, folder) == [("2019-01", 1), ("2019-01", 2)]
    files.write_raw(trips(*on(2)), folder, YELLOW, "2019-01")
    assert stream(spark, folder) == [("2019-01", 2)]
    assert stream(spark, folder) == [("2019-01", 2)]


def test_streaming_takes_files_with_older_times(spark, folder, trips):
    for month, day, age in (("2019-01", 1, 0), ("2019-03", 3, 0), ("2019-02", 2, 10)):
        path = files.write_raw(trips(*on(day)), folder, YELLOW, month)
        for file in os.listdir(path):
            past = os.path.getmtime(f"{path}/{file}") - age * 86_400
            os.utime(f"{path}/{file}", (past, past))
        got = stream(spark, folder)
    assert got == [("2019-01", 1), ("2019-02", 2), ("2019-03", 3)]


def test_streaming_binds_drifted_files(spark, folder, trips):
    drifted = trips(*on(1)).withColumn("passenger_count", F.lit(3)).withColumn("payment_type", F.lit(2.0))
    files.write_raw(drifted, folder, YELLOW, "2019-01")
    files.write_raw(trips(*on(2)), folder, YELLOW, "2019-02")
    assert stream(spark, folder) == [("2019-01", 1), ("2019-02", 2)]
    first = files.read_service(spark, folder, YELLOW).filter("source_month = '2019-01'").first()
    assert (first.passenger_count, first.payment_type) == (3.0, 2)


def test_streaming_finds_a_file_replaced_under_its_name(spark, folder, trips):
    def deliver(*days):
        files.write_raw(trips(*on(*days)).coalesce(1), f"{folder}/next", YELLOW, "2019-01")
        made = files.raw_path(f"{folder}/next", YELLOW, "2019-01")
        part = next(f for f in os.listdir(made) if f.startswith("part-"))
        path = files.raw_path(folder, YELLOW, "2019-01")
        os.makedirs(os.path.dirname(path), exist_ok=True)
        os.replace(f"{made}/{part}", path)

    deliver(1, 2)
    assert stream(spark, folder) == [("2019-01", 1), ("2019-01", 2)]
    deliver(3)
    assert stream(spark, folder) == [("2019-01", 3)]


def deliver(spark, folder, trips, *days, month="2019-01", age=0):
    """A month as one file under its fixed name, changed so many days ago."""
    source = trips(*on(*days)).coalesce(1)
    files.write_raw(source, f"{folder}/next", YELLOW, month)
    made = files.raw_path(f"{folder}/next", YELLOW, month)
    part = next(f for f in os.listdir(made) if f.startswith("part-"))
    path = files.raw_path(folder, YELLOW, month)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    os.replace(f"{made}/{part}", path)
    past = os.path.getmtime(path) - age * 86_400
    os.utime(path, (past, past))
    return path


def test_streaming_finds_an_older_file_under_the_same_name(spark, folder, trips):
    deliver(spark, folder, trips, 1, 2, 3)
    assert [d for _, d in stream(spark, folder)] == [1, 2, 3]
    deliver(spark, folder, trips, 4, age=30)
    assert [d for _, d in stream(spark, folder)] == [4]
    # the same length, an older time still
    before = os.path.getsize(deliver(spark, folder, trips, 5, age=60))
    assert [d for _, d in stream(spark, folder)] == [5]
    assert before == os.path.getsize(deliver(spark, folder, trips, 6, age=90))
    assert [d for _, d in stream(spark, folder)] == [6]
    assert [d for _, d in stream(spark, folder)] == [6]


def test_streaming_notices_files_that_left_a_month(spark, folder, trips):
    path = files.write_raw(trips(*on(1, 2)).repartition(2, "trip_distance"), folder, YELLOW, "2019-01")
    both = stream(spark, folder)
    gone = sorted(f for f in os.listdir(path) if f.startswith("part-"))[0]
    os.remove(f"{path}/{gone}")
    left = stream(spark, folder)
    assert len(both) == 2 and len(left) < 2 or len(os.listdir(path)) == 0


def test_a_month_without_rows_loses_what_it_had(spark, folder, trips):
    files.write_raw(trips(*on(1, 2)), folder, YELLOW, "2019-01")
    files.write_raw(trips(*on(1, month=2)), folder, YELLOW, "2019-02")
    assert len(stream(spark, folder)) == 3
    files.write_raw(trips(), folder, YELLOW, "2019-01")
    assert stream(spark, folder) == [("2019-02", 1)]


def test_jobs_of_a_run_do_not_grow_with_the_months(spark, folder, trips):
    """Months of two schemas, some of them mixed, are replaced by as many jobs as two months are."""

    def jobs(run):
        group = f"counted-{os.urandom(4).hex()}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            run()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    def run(months):
        listed = ledger.pending(spark, f"{folder}/book", ledger.listing(spark, folder, YELLOW).filter(F.col("month").isin(months)))
        files.write_promoted(spark, folder, YELLOW, listed)
        ledger.record(spark, f"{folder}/book", listed)

    months = [f"20{y}-{m:02d}" for y in (19, 20) for m in range(1, 13)]
    for i, month in enumerate(months):
        rows = trips(*on(1 + i % 27)).coalesce(1)
        files.write_raw(rows.withColumn("passenger_count", F.lit(3)) if i % 2 else rows, folder, YELLOW, month)
    few, many = jobs(lambda: run(months[:2])), jobs(lambda: run(months))
    assert files.read_service(spark, folder, YELLOW).select("source_month").distinct().count() == 24
    assert many <= few + 2
    assert ledger.due(spark, folder, YELLOW, f"{folder}/book").count() == 0


def test_the_ledger_is_merged_and_says_the_same(spark, folder, trips, monkeypatch):
    monkeypatch.setattr(ledger, "MOST_ENTRIES", 3)
    book = f"{folder}/book"
    for i in range(9):
        month = f"2019-{1 + i % 4:02d}"
        deliver(spark, folder, trips, 1 + i, month=month)
        due = ledger.due(spark, folder, YELLOW, book)
        assert [r.month for r in due.collect()] == [month]
        ledger.record(spark, book, ledger.pending(spark, book, due))
        assert len(ledger.entries(spark, book)) <= 4
        assert ledger.due(spark, folder, YELLOW, book).count() == 0
    assert {r.month for r in ledger.taken(spark, book).collect()} == {f"2019-{m:02d}" for m in range(1, 5)}


def test_an_entry_that_was_not_committed_does_not_count(spark, folder, trips):
    book = f"{folder}/book"
    deliver(spark, folder, trips, 1)
    ledger.record(spark, book, ledger.pending(spark, book, ledger.due(spark, folder, YELLOW, book)))
    os.makedirs(f"{book}/entry-000000000002")
    assert ledger.entries(spark, book) == [1] and ledger.taken(spark, book).count() == 1


def test_a_month_of_mixed_schemas_is_taken_whole(spark, folder, trips):
    path = files.write_raw(trips(*on(1)).coalesce(1), folder, YELLOW, "2019-01")
    drifted = trips(*on(2)).withColumn("passenger_count", F.lit(3)).withColumn("payment_type", F.lit(2.0))
    drifted.coalesce(1).write.mode("append").parquet(path)
    assert stream(spark, folder) == [("2019-01", 1), ("2019-01", 2)]


def test_a_raw_name_without_a_month_is_refused_by_name(spark, database, folder, trips):
    trips(*on(1)).write.parquet(files.raw_path(folder, YELLOW, "latest"))
    with pytest.raises(ValueError, match="latest"):
        files.raw_months(spark, folder, YELLOW)
    with pytest.raises(ValueError, match="latest"):
        tables.promote(spark, folder, YELLOW, tables.create_trip_table(spark, YELLOW, database))
    with pytest.raises(ValueError, match="latest"):
        stream(spark, folder)


def test_what_has_expired_or_was_empty_is_not_promoted_again(spark, database, folder, trips):
    table = tables.create_trip_table(spark, YELLOW, database)
    files.write_raw(trips(*on(1, 9)), folder, YELLOW, "2019-01")
    files.write_raw(trips(), folder, YELLOW, "2019-02")
    assert tables.promote(spark, folder, YELLOW, table).count() == 2
    assert tables.expire_partitions(spark, table, dt.date(2019, 1, 12), days=5).count() == 1
    assert tables.promote(spark, folder, YELLOW, table).count() == 1
    assert spark.table(f"{table}_months").count() == 2


def test_every_load_can_apply_retention(spark, database, folder, trips):
    files.write_raw(trips(*on(1, 9), None), folder, YELLOW, "2019-01")
    retention = {"as_of": dt.date(2019, 1, 12), "days": 5}
    table = tables.create_trip_table(spark, YELLOW, database)
    assert tables.promote(spark, folder, YELLOW, table, **retention).count() == 2
    stream(spark, folder)
    assert tables.rebuild(spark, folder, YELLOW, database, **retention).count() == 2


def test_no_path_brings_an_expired_day_back(spark, database, folder, trips):
    """Retention is a property of tables and folders: callers only ask for loads."""
    days = (1, 6, 7, 9)
    landing = f"{folder}/landing"
    trips(*on(*days), None).write.parquet(files.landing_path(landing, YELLOW, "2019-01"))
    files.write_raw(trips(*on(*days), None), folder, YELLOW, "2019-01")
    left = [None, 7, 9]

    def kept(df):
        return sorted((r[YELLOW.pickup] and r[YELLOW.pickup].day for r in df.collect()), key=lambda d: d or 0)

    with setting(spark, "tripmart.today", "2019-01-11"):
        table = tables.create_trip_table(spark, YELLOW, database, days=5)
        assert kept(tables.promote(spark, folder, YELLOW, table)) == left
        assert kept(tables.load_months(spark, landing, YELLOW, table, "2019-01", "2019-01")) == left
        files.set_retention(spark, folder, YELLOW, 5)
        stream(spark, folder)
        assert kept(files.read_service(spark, folder, YELLOW)) == left
        assert kept(tables.rebuild(spark, folder, YELLOW, database)) == left
        assert tables.retention(spark, table) == 5
    with setting(spark, "tripmart.today", "2019-01-13"):
        assert kept(files.read_service(spark, folder, YELLOW)) == [None, 9]
        assert kept(tables.expire_partitions(spark, table)) == [None, 9]
        assert kept(tables.promote(spark, folder, YELLOW, table, months=["2019-01"])) == [None, 9]
        tables.set_retention(spark, table, None)
        assert kept(tables.promote(spark, folder, YELLOW, table, months=["2019-01"])) == [None, 1, 6, 7, 9]


def test_today_is_the_calendar_unless_the_session_says_otherwise(spark):
    assert today(spark) == spark.sql("SELECT current_date() AS d").first().d
    with setting(spark, "tripmart.today", "2019-01-11"):
        assert today(spark) == dt.date(2019, 1, 11)


# ------------------------------------------------------------------ other tables


def test_a_named_external_table_may_be_defined_again(spark, database, folder, zones):
    zones.write.parquet(f"{folder}/zones")
    for _ in range(2):
        assert tables.external_table(spark, f"{database}.found", f"{folder}/zones").count() == 8
    tables.refresh_table(zones, f"{database}.own")
    spark.sql(f"CREATE TABLE {database}.managed (a INT) USING parquet")
    for taken in ("managed", "own"):
        with pytest.raises(ValueError, match=taken):
            tables.external_table(spark, f"{database}.{taken}", f"{folder}/zones")
    assert spark.table(f"{database}.own").count() == 8


def test_an_external_table_over_drifting_files(spark, database, folder):
    months = [
        "SELECT 1L AS n, 2 AS k, 'a' AS s, DATE '2019-01-01' AS d",
        "SELECT 1.5D AS n, 3L AS k, 'b' AS S, TIMESTAMP_NTZ '2019-01-02 03:00:00' AS d",
        "SELECT 7 AS n, 4S AS k, 'c' AS s, DATE '2019-01-03' AS d, true AS more",
    ]
    for i, month in enumerate(months):
        spark.sql(month).coalesce(1).write.parquet(f"{folder}/in/month,{i}.parquet")
    for _ in range(2):
        found = tables.external_table(spark, f"{database}.found", f"{folder}/in")
    assert found.dtypes == [("n", "double"), ("k", "bigint"), ("s", "string"), ("d", "timestamp_ntz"), ("more", "boolean")] or {
        *found.dtypes
    } == {("n", "double"), ("k", "bigint"), (found.columns[2], "string"), ("d", "timestamp_ntz"), ("more", "boolean")}
    rows = sorted(tuple(r)[:2] for r in found.collect())
    assert rows == [(1.0, 2), (1.5, 3), (7.0, 4)]
    assert spark.newSession().table(f"{database}.found").filter("more").count() == 1
    spark.sql("SELECT 'x' AS n").write.parquet(f"{folder}/in/more.parquet")
    with pytest.raises(ValueError, match="column n is"):
        tables.external_table(spark, f"{database}.found2", f"{folder}/in")


def test_a_failing_refresh_keeps_the_old_rows(spark, database, zones):
    name = f"{database}.zones"
    tables.refresh_table(zones, name)
    broken = zones.withColumn("Zone", F.raise_error(F.lit("no such zone")).cast("string"))
    with pytest.raises(Exception, match="no such zone"):
        tables.refresh_table(broken, name)
    assert spark.table(name).count() == 8


def test_a_refreshed_table_is_partitioned_and_leaves_no_old_folder(spark, database, trips, plan):
    name = f"{database}.trips"
    for days in ((1, 2, 3), (1, 2)):
        rows = trips(*on(*days), None).withColumn("day", F.to_date(YELLOW.pickup))
        tables.refresh_table(rows, name, ("day",), grace=dt.timedelta(0))
    assert spark.table(name).count() == 3 and spark.table(name).filter("day IS NULL").count() == 1
    one = spark.table(name).filter("day = DATE '2019-01-02'")
    assert one.count() == 1 and "PartitionFilters: [isnotnull(day" in plan(one)
    assert len(_folders(spark, database)) == 1
    versions.drop(spark, name)
    assert _folders(spark, database) == [] and not spark.catalog.tableExists(name)


def _folders(spark, database):
    return os.listdir(versions.home(spark, f"{database}.any").removeprefix("file:"))


def test_a_reader_in_another_session_survives_a_refresh(spark, database, zones):
    name = f"{database}.zones"
    tables.refresh_table(zones, name)
    other = spark.newSession().table(name)
    assert other.count() == 8
    tables.refresh_table(zones.filter("LocationID < 10"), name)
    assert other.count() == 8 and spark.newSession().table(name).count() == 3
    # the version goes with the first refresh after its time
    assert len(_folders(spark, database)) == 2
    tables.refresh_table(zones, name, grace=dt.timedelta(0))
    assert len(_folders(spark, database)) == 1


def test_a_refresh_may_read_its_own_table(spark, database, zones):
    name = f"{database}.zones"
    tables.refresh_table(zones, name)
    tables.refresh_table(spark.table(name).filter("LocationID < 10"), name)
    assert spark.table(name).count() == 3


def test_a_failing_refresh_leaves_no_files(spark, database, zones):
    name = f"{database}.zones"
    tables.refresh_table(zones, name)
    broken = zones.withColumn("Zone", F.raise_error(F.lit("no such zone")).cast("string"))
    with pytest.raises(Exception, match="no such zone"):
        tables.refresh_table(broken, name)
    assert len(_folders(spark, database)) == 1
    assert versions.versions(spark, name) == [versions.stored(spark, name)]


def test_a_version_that_was_never_published_goes_later(spark, database, zones):
    name = f"{database}.zones"
    tables.refresh_table(zones, name)
    zones.write.saveAsTable(versions.new_version(spark, name))  # a refresh that ended before it moved the name
    versions.prune(spark, name)
    assert len(versions.versions(spark, name)) == 2
    versions.prune(spark, name, dt.timedelta(0))
    assert versions.versions(spark, name) == [versions.stored(spark, name)]


def test_a_refresh_takes_no_name_of_another_kind(spark, database, zones):
    spark.sql(f"CREATE TABLE {database}.plain (a INT) USING parquet")
    with pytest.raises(ValueError, match="plain is no versioned table"):
        tables.refresh_table(zones, f"{database}.plain")


def test_a_catalog_view_is_seen_by_other_sessions(spark, database, zones):
    tables.refresh_table(zones, f"{database}.zones")
    tables.catalog_view(spark, f"{database}.near", f"SELECT * FROM {database}.zones WHERE LocationID < 10")
    assert spark.newSession().table(f"{database}.near").count() == 3


def test_external_table_with_and_without_a_contract(spark, database, folder, zones):
    zones.write.parquet(f"{folder}/zones")
    found = tables.external_table(spark, f"{database}.found", f"{folder}/zones")
    declared = Contract((("LocationID", "int"), ("Zone", "string")))
    named = tables.external_table(spark, f"{database}.named", f"{folder}/zones", declared)
    assert found.count() == named.count() == 8
    assert named.columns == declared.names


def test_refresh_empty_view_and_ddl(spark, database, zones):
    name = f"{database}.zones"
    assert tables.refresh_table(zones, name).count() == 8
    assert tables.refresh_table(zones.filter("LocationID < 10"), name).count() == 3
    empty = tables.empty_like(zones, name)
    assert empty.count() == 0 and empty.dtypes == zones.dtypes
    assert tables.schema_ddl(empty) == "LocationID INT,Borough STRING,Zone STRING,service_zone STRING"
    assert tables.define_view(zones, "zones_view").count() == 8
    assert spark.sql("SELECT count(*) AS n FROM zones_view").first().n == 8
    assert tables.source(spark, database, "zones").count() == 0


class Recorder:
    def __init__(self):
        self.saved = []

    def save(self, df, mode):
        self.saved.append((mode, df.count()))


def test_replace_then_append_creates_empty_first(spark):
    target = Recorder()
    relational.replace_then_append(spark.range(5), target)
    relational.replace(spark.range(2), target)
    assert target.saved == [("overwrite", 0), ("append", 5), ("overwrite", 2)]


def test_replace_then_append_on_a_table(spark, database):
    target = relational.TableTarget(f"{database}.numbers")
    for _ in range(2):
        relational.replace_then_append(spark.range(5), target)
    assert spark.table(target.name).count() == 5
    relational.append(spark.range(2), target)
    assert spark.table(target.name).count() == 7


def test_a_repeated_append_changes_nothing(spark, database):
    target = relational.TableTarget(f"{database}.numbers")
    relational.replace(spark.range(5), target)
    for _ in range(2):
        relational.append(spark.range(5, 8), target, "o'clock \\ 2019/01")
    relational.append(spark.range(8, 9), target, "second")
    assert sorted(r.id for r in spark.table(target.name).collect()) == list(range(9))
    assert spark.table(target.name).columns == ["id"]
    # a delivery that comes again with other rows replaces itself alone
    relational.append(spark.range(100, 101), target, "second")
    assert sorted(r.id for r in spark.table(target.name).collect()) == [*range(8), 100]
    for _ in range(2):
        relational.append(spark.range(7, 8), target)
    assert spark.table(target.name).filter("id = 7").count() == 3


def test_a_failed_append_is_mended_by_repeating_it(spark, database):
    target = relational.TableTarget(f"{database}.numbers")
    relational.replace_then_append(spark.range(5), target)
    broken = spark.range(3).selectExpr("if(id = 2, raise_error('no'), id) AS id")
    with pytest.raises(Exception, match="no"):
        relational.append(broken, target, "late")
    assert spark.table(target.name).count() == 5
    relational.append(spark.range(3), target, "late")
    assert spark.table(target.name).count() == 8


def test_appends_match_columns_by_name(spark, database):
    target = relational.TableTarget(f"{database}.pairs")
    relational.replace(spark.sql("SELECT 1 AS a, 'x' AS b"), target)
    relational.append(spark.sql("SELECT 'y' AS b, 2 AS a"), target, "second")
    assert sorted(map(tuple, spark.table(target.name).collect())) == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError, match="_delivery"):
        relational.append(spark.sql("SELECT 1 AS a, 'x' AS b, 'z' AS _delivery"), target)
    with pytest.raises(ValueError, match="JDBC"):
        relational.append(spark.range(1), relational.JdbcTarget("jdbc:x", "t"), "second")


def test_a_month_and_a_csv_go_into_their_own_tables(spark, database, folder, trips):
    assert relational.month_table(YELLOW, "2019-01") == "yellow_taxi_2019_01"
    trips(*on(1, 2)).write.parquet(files.landing_path(folder, YELLOW, "2019-01"))
    target = relational.TableTarget(f"{database}.{relational.month_table(YELLOW, '2019-01')}")
    for _ in range(2):
        relational.load_month(spark, folder, YELLOW, "2019-01", target)
    assert [r.airport_fee for r in spark.table(target.name).collect()] == [5, 5]
    files.write_csv(trips(*on(3)), f"{folder}/trips")
    relational.load_csv(spark, f"{folder}/trips", YELLOW.source, target)
    assert [r.tpep_pickup_datetime for r in spark.table(target.name).collect()] == on(3)


def test_jdbc_options():
    target = relational.JdbcTarget("jdbc:postgresql://h/db", "trips", {"user": "u", "password": "p"})
    assert target.options() == {
        "user": "u",
        "password": "p",
        "url": "jdbc:postgresql://h/db",
        "dbtable": "trips",
        "batchsize": "100000",
    }


# ------------------------------------------------------------------ session


def test_scratch_folders_are_new_and_shared(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_folder(spark), scratch_folder(spark)
    assert first != second and first.startswith(shared) and second.startswith(shared)


def test_a_labelled_folder_and_database_replace_their_earlier_ones(spark):
    folder = scratch_folder(spark, "label")
    spark.range(3).write.parquet(folder)
    assert scratch_folder(spark, "label") == folder and not os.path.exists(folder.removeprefix("file:"))
    for _ in range(2):
        database = scratch_database(spark, "label")
        tables.refresh_table(spark.range(3), f"{database}.numbers")
    assert spark.table(f"{database}.numbers").count() == 3


class Unset:
    """A session without ``spark.checkpoint.dir``."""

    def __init__(self, master):
        self.conf, self.sparkContext, self.master, self.checkpoint = self, self, master, None

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return self.checkpoint

    def setCheckpointDir(self, folder):
        self.checkpoint = folder


def test_only_a_local_session_may_lack_a_shared_folder():
    local = Unset("local[2]")
    assert scratch_folder(local).startswith(local.checkpoint)
    assert scratch_folder(local).startswith(local.checkpoint)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(Unset("yarn"))


def test_settings_grow_with_the_input():
    def partitions(size):
        return int(settings(size, 64)["spark.sql.shuffle.partitions"])

    assert partitions(0) == 64
    assert partitions(1 << 40) == 4096
    assert partitions(100 << 40) == 409_600


def test_timestamps_survive_files_in_any_zone(spark, folder, zone):
    df = spark.createDataFrame([(dt.datetime(2019, 3, 10, 2, 30),)], "t timestamp_ntz")
    with zone("America/New_York"):
        df.write.parquet(f"{folder}/t")
        files.write_csv(df, f"{folder}/c")
    back = files.read_file(spark, f"{folder}/t").unionByName(
        files.read_csv(spark, f"{folder}/c", Contract((("t", "timestamp_ntz"),)))
    )
    assert {r.t for r in back.select(F.col("t")).collect()} == {dt.datetime(2019, 3, 10, 2, 30)}
