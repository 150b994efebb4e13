"""One query per operator. Each takes ``(spark, sf_dir)`` and reads whole tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.contracts import FHV, GREEN, PAYMENT_TYPES, YELLOW, ZONE_TABLE, Contract
from tripmart.functions import (
    month_label,
    month_start,
    payment_type_description,
    surrogate_key,
    to_integer,
    to_numeric,
)
from tripmart.operators import checks, sampling
from tripmart.operators.dedup import keep_first
from tripmart.operators.joins import orphans, with_zone
from tripmart.operators.shape import between_ts, conform, known_zones, replace_with_null, unexpired
from tripmart.plans import build as warehouse
from tripmart.plans import marts, staging
from tripmart.session import TODAY, scratch_database, scratch_folder, setting
from tripmart.sources import files, relational, tables, versions
from tripmart.standins import frames
from tripmart.streaming import promote_available

AS_OF = dt.date(2024, 1, 30)
KEPT_DAYS = 12
LINES_AS_OF, LINES_KEPT_DAYS = dt.date(2001, 11, 4), 1000
WINDOW = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6, 12)
FRESH_AS_OF = dt.datetime(2024, 1, 31)

CUSTOMER_CONTRACT = Contract((
    ("C_CUSTKEY", "bigint"),
    ("c_nationkey", "bigint"),
    ("c_acctbal", "bigint"),
    ("c_name", "string"),
    ("c_fee", "double"),
))
EVENTS = Contract((
    ("event_id", "bigint"),
    ("ts", "timestamp_ntz"),
    ("user_id", "bigint"),
    ("event_type", "string"),
    ("value", "double"),
    ("props", "string"),
))
ORDERS = Contract((
    ("o_orderkey", "bigint"),
    ("o_custkey", "bigint"),
    ("o_orderstatus", "string"),
    ("o_totalprice", "double"),
    ("o_orderdate", "timestamp_ntz"),
    ("o_orderpriority", "string"),
))


# ------------------------------------------------------------------ models


def stg_green(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_green(frames.green_source(spark, sf_dir))


def stg_yellow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_yellow(frames.yellow_source(spark, sf_dir))


def stg_fhv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_fhv(frames.fhv_source(spark, sf_dir))


def fact_fhv(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{scratch_database(spark, 'fact_fhv')}.{warehouse.FACT_FHV}"
    return tables.refresh_table(marts.fact_fhv_trips(stg_fhv(spark, sf_dir)), name)


def fact_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = marts.dim_zones(frames.nation_zones(spark, sf_dir))
    return marts.fact_trips(stg_green(spark, sf_dir), stg_yellow(spark, sf_dir), zones)


def fact_trips_service_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_trips(spark, sf_dir).groupBy("service_type").agg(F.count("trip_id").alias("trips"))


def monthly_zone_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.monthly_zone_revenue(fact_trips(spark, sf_dir))


def dim_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dim_zones(frames.customer_zones(spark, sf_dir))


def build_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = scratch_database(spark, "build_warehouse")
    sources = {
        GREEN.table: frames.green_source(spark, sf_dir),
        YELLOW.table: frames.yellow_source(spark, sf_dir),
        FHV.table: frames.fhv_source(spark, sf_dir),
        ZONE_TABLE: frames.nation_zones(spark, sf_dir),
    }
    for name, df in sources.items():
        tables.refresh_table(df, f"{database}.{name}")
    warehouse.build(spark, database)
    return spark.table(f"{database}.{warehouse.REVENUE}")


def refresh_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build from two months, redeliver one with other amounts and one with other days, and bring the marts up to date."""
    database, (first, second) = scratch_database(spark, "refresh_warehouse"), frames.MONTHS
    for service in (GREEN, YELLOW, FHV):
        tables.create_trip_table(spark, service, database)
    tables.refresh_table(frames.nation_zones(spark, sf_dir), f"{database}.{ZONE_TABLE}")

    def load(kind: str, month: str, **wrong: Column) -> None:
        service = {"green": GREEN, "yellow": YELLOW}[kind]
        rows = frames.street_hail_delivery(spark, sf_dir, kind, month).withColumns(wrong)
        tables.load_month(rows, service, f"{database}.{service.table}", month)

    load("green", first, total_amount=F.lit(0.0))
    load("green", second)
    load("yellow", first)
    # the second month of yellow trips first comes with all its pickups a month early
    load("yellow", second, tpep_pickup_datetime=F.col("tpep_pickup_datetime") - F.expr("interval 31 days"))
    tables.load_month(frames.fhv_delivery(spark, sf_dir, first), FHV, f"{database}.{FHV.table}", first)
    warehouse.build(spark, database)
    load("green", first)
    load("yellow", second)
    warehouse.refresh(spark, database)
    return spark.table(f"{database}.{warehouse.REVENUE}")


def merged_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue per service from the states of its halves, which are merged without looking at trips again."""
    facts = fact_trips(spark, sf_dir)
    early = F.col("pickup_ts") < F.lit("1995-06-17 00:00:00").cast("timestamp_ntz")
    halves = [marts.revenue_states(facts.where(part)) for part in (early, ~early)]
    merged = marts.merged_states(halves[0].unionByName(halves[1]), "service_type")
    return merged.selectExpr(*marts.averaged(["service_type"]))


# ------------------------------------------------------------------ operators


def known_zones_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return known_zones(dim_zones(spark, sf_dir))


def dedup_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_first(frames.table(spark, sf_dir, "events"), ["event_type"])


def dedup_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = frames.table(spark, sf_dir, "events").withColumn("kind", F.expr("nullif(event_type, 'view')"))
    return keep_first(events.drop("event_type"), ["user_id", "kind"])


def surrogate_key_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.expr("nullif(event_type, 'view')")
    return frames.table(spark, sf_dir, "events").select("event_id", surrogate_key("user_id", kind, "ts").alias("key"))


def decode_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = frames.table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").cast("double").alias("code"))
    return codes.groupBy(payment_type_description("code").alias("label")).agg(F.count(F.lit(1)).alias("n"))


def int_cast_half_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    halves = to_integer(F.col("l_quantity") * 0.5 - 12)
    return frames.table(spark, sf_dir, "lineitem").groupBy(halves.alias("rounded")).agg(F.count(F.lit(1)).alias("n"))


def star_replace_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_with_null(frames.table(spark, sf_dir, "orders"), "o_totalprice")


def typed_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(frames.table(spark, sf_dir, "customer"), CUSTOMER_CONTRACT, nulled=["c_fee"])


def zone_name_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = frames.table(spark, sf_dir, "lineitem").withColumn("pickup_location_id", F.col("l_partkey"))
    zones = known_zones(marts.dim_zones(frames.part_zones(spark, sf_dir)))
    named = with_zone(lines, zones, "pickup")
    return named.groupBy("pickup_zone").agg(
        F.count("pickup_location_id").alias("trips"), F.sum(to_numeric("l_extendedprice")).alias("fare")
    )


def avg_int_and_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        frames.table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey")
        .agg(
            F.avg("l_linenumber").alias("avg_int"),
            to_numeric(F.avg(to_numeric("l_quantity"))).alias("avg_decimal"),
        )
    )


def month_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        frames.table(spark, sf_dir, "orders")
        .groupBy(
            month_start("o_orderdate").alias("month"),
            month_label("o_orderdate").alias("file_label"),
            month_label("o_orderdate", "_").alias("table_label"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


def row_count_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = frames.table(spark, sf_dir, "lineitem")
    return sampling.ad_hoc(spark, "SELECT COUNT(*) AS n FROM {trips}", trips=lines)


def sample_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_green(frames.green_source(spark, sf_dir), sample_limit=100)


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.preview(frames.table(spark, sf_dir, "orders"), "o_orderkey")


def expire_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = frames.table(spark, sf_dir, "lineitem").withColumn("ship_date", F.to_date("l_shipdate"))
    return unexpired(lines, "ship_date", LINES_AS_OF, LINES_KEPT_DAYS)


# ------------------------------------------------------------------ sources and sinks


def read_whole_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_file(spark, f"{sf_dir}/orders.parquet")


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_folder(spark, 'csv_roundtrip')}/events"
    files.write_csv(frames.table(spark, sf_dir, "events"), path)
    return files.read_csv(spark, path, EVENTS)


def csv_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with line breaks and quotes in two of their fields, written and read in splits."""
    path = f"{scratch_folder(spark, 'csv_line_breaks')}/events"
    broken = F.concat(F.lit('"'), F.col("event_type"), F.lit('"\n,\n'), F.col("event_id").cast("string"))
    events = frames.table(spark, sf_dir, "events").withColumns({"event_type": broken, "props": F.concat("props", F.lit("\n"))})
    files.write_csv(events, path, line_breaks=True)
    with setting(spark, "spark.sql.files.maxPartitionBytes", "1m"):
        return tables.refresh_table(
            files.read_csv(spark, path, EVENTS, line_breaks=True), f"{scratch_database(spark, 'csv_line_breaks')}.events"
        )


def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_folder(spark, 'csv_inferred')}/zones"
    files.write_csv(frames.customer_zones(spark, sf_dir), path)
    return files.read_csv(spark, path)


def csv_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "csv_to_parquet")
    files.write_csv(frames.table(spark, sf_dir, "orders"), f"{folder}/orders.csv")
    return files.csv_to_parquet(spark, f"{folder}/orders.csv", f"{folder}/orders.parquet", ORDERS)


def load_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_folder(spark, "load_zones")
    files.write_csv(frames.customer_zones(spark, sf_dir), f"{root}/zones.csv")
    return tables.load_zones(spark, f"{root}/zones.csv", root, scratch_database(spark, "load_zones"))


def read_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = _land(spark, sf_dir, "read_month")
    return files.read_month(spark, landing, FHV, frames.MONTHS[1])


def load_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = _land(spark, sf_dir, "load_months")
    table = tables.create_trip_table(spark, FHV, scratch_database(spark, "load_months"))
    for _ in range(2):
        loaded = tables.load_months(spark, landing, FHV, table, *frames.MONTHS)
    return loaded


def promote_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promote after each delivery; the first month is then delivered again and named."""
    root = scratch_folder(spark, "promote_raw")
    table = tables.create_trip_table(spark, FHV, scratch_database(spark, "promote_raw"))
    for month in frames.MONTHS:
        files.write_raw(frames.fhv_delivery(spark, sf_dir, month), root, FHV, month)
        tables.promote(spark, root, FHV, table)
    return tables.promote(spark, root, FHV, table, months=frames.MONTHS[:1])


def promote_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    promoted = files.read_service(spark, _stream(spark, sf_dir, "promote_stream"), FHV)
    return promoted.withColumn("pickup_date", F.to_date(FHV.pickup))


def rebuild_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.rebuild(spark, _stream(spark, sf_dir, "rebuild_table"), FHV, scratch_database(spark, "rebuild_table"))


def partitioned_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = spark.table(_promote_whole(spark, sf_dir, "partitioned_window")[0])
    return between_ts(loaded, FHV.pickup, "pickup_date", *WINDOW)


def expire_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promote, then keep few days: no path, a named redelivery and a rebuild included, brings the others back."""
    table, root = _promote_whole(spark, sf_dir, "expire_partitions")
    with setting(spark, TODAY, AS_OF.isoformat()):
        tables.set_retention(spark, table, KEPT_DAYS)
        tables.expire_partitions(spark, table)
        tables.promote(spark, root, FHV, table, months=frames.MONTHS[:1])
        promote_available(spark, root, FHV, f"{root}/checkpoint").awaitTermination()
        return tables.rebuild(spark, root, FHV, table.rpartition(".")[0])


def external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{scratch_database(spark, 'external_table')}.events_external"
    for _ in range(2):
        events = tables.external_table(spark, name, f"{sf_dir}/events.parquet", EVENTS)
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_ts"))


def external_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in place whose columns have one type here and another there."""
    database, folder = scratch_database(spark, "external_drift"), scratch_folder(spark, "external_drift")
    events = frames.table(spark, sf_dir, "events")
    early, late = (F.expr(frames.DELIVERED[month][0]) for month in frames.MONTHS)
    events.where(early).withColumn("user_id", F.col("user_id").cast("int")).write.parquet(f"{folder}/1")
    wide = {"user_id": F.col("user_id").cast("double"), "ts": F.to_date("ts")}
    events.where(late).withColumns(wide).drop("props").write.parquet(f"{folder}/2")
    return tables.external_table(spark, f"{database}.drifting", folder)


def table_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = scratch_database(spark, "table_refresh")
    orders = frames.table(spark, sf_dir, "orders")
    tables.refresh_table(orders.filter("o_orderstatus = 'F'"), f"{database}.orders")
    tables.refresh_table(orders, f"{database}.orders")
    return tables.source(spark, database, "orders")


def view_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view defined in one session and read by another."""
    database = scratch_database(spark, "view_scan")
    tables.refresh_table(stg_fhv(spark, sf_dir), f"{database}.staged")
    tables.catalog_view(spark, f"{database}.stg_fhv_trips", f"SELECT * FROM {database}.staged")
    return spark.newSession().sql(
        "SELECT hvfhs_license_code, count(*) AS trips, sum(driver_pay) AS pay "
        f"FROM {database}.stg_fhv_trips GROUP BY hvfhs_license_code"
    )


def replace_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = relational.TableTarget(f"{scratch_database(spark, 'replace_append')}.customers")
    customers = frames.table(spark, sf_dir, "customer")
    relational.replace(customers.withColumn("c_name", F.lit("stale")), target)
    relational.replace_then_append(customers, target)
    for _ in range(2):
        relational.append(customers.withColumn("c_custkey", -F.col("c_custkey")), target, "mirrored")
    return spark.table(target.name)


def load_month_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, database = _land(spark, sf_dir, "load_month_tables"), scratch_database(spark, "load_month_tables")
    loaded = []
    for month in frames.MONTHS:
        target = relational.TableTarget(f"{database}.{relational.month_table(FHV, month)}")
        relational.load_month(spark, landing, FHV, month, target)
        loaded.append(spark.table(target.name).withColumn("table_month", F.lit(month)))
    return loaded[0].unionByName(loaded[1]).groupBy("table_month").agg(
        F.count(F.lit(1)).alias("trips"), F.max("pickup_datetime").alias("last_pickup")
    )


def load_csv_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_folder(spark, 'load_csv_table')}/events.csv"
    target = relational.TableTarget(f"{scratch_database(spark, 'load_csv_table')}.events")
    files.write_csv(frames.table(spark, sf_dir, "events"), path)
    relational.load_csv(spark, path, EVENTS, target)
    return spark.table(target.name)


def _land(spark: SparkSession, sf_dir: str, label: str) -> str:
    landing = scratch_folder(spark, label)
    for month in frames.MONTHS:
        path = files.landing_path(landing, FHV, month)
        frames.fhv_delivery(spark, sf_dir, month).write.parquet(path)
    return landing


def _stream(spark: SparkSession, sf_dir: str, label: str) -> str:
    """Promote after each of five deliveries, the last of which brings nothing.

    The first month comes twice, with every row doubled and then as it should be. So does the second, the
    second time with files that look older than those they replace and hold integers as another type.
    """
    root = scratch_folder(spark, label)
    first, second = frames.MONTHS
    whole = frames.fhv_delivery(spark, sf_dir, first)
    late = frames.fhv_delivery(spark, sf_dir, second)
    deliveries = [
        (first, whole.union(whole), 0),
        (second, late.union(late), 10),
        (first, whole, 0),
        (second, late.withColumn("trip_time", F.col("trip_time").cast("double")), 20),
        None,
    ]
    for delivery in deliveries:
        if delivery:
            month, rows, age = delivery
            _backdate(spark, files.write_raw(rows, root, FHV, month), age)
        promote_available(spark, root, FHV, f"{root}/checkpoint").awaitTermination()
    return root


def _backdate(spark: SparkSession, folder: str, days: int) -> None:
    """Make a delivery's files look older than those that came before it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in store.listStatus(path):
        store.setTimes(status.getPath(), status.getModificationTime() - days * 86_400_000, -1)


def _promote_whole(spark: SparkSession, sf_dir: str, label: str) -> tuple[str, str]:
    """A trip table with all events in one month, and the raw zone it was promoted from."""
    root = scratch_folder(spark, label)
    table = tables.create_trip_table(spark, FHV, scratch_database(spark, label))
    files.write_raw(frames.fhv_source(spark, sf_dir), root, FHV, frames.MONTHS[0])
    tables.promote(spark, root, FHV, table)
    return table, root


# ------------------------------------------------------------------ checks


def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = frames.table(spark, sf_dir, "lineitem").withColumn("key", F.expr("nullif(l_orderkey, 7)"))
    return checks.unique(lines, "key")


def check_unique_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over a table that lies by its key, which needs no shuffle."""
    lines = frames.table(spark, sf_dir, "lineitem").withColumn("key", F.expr("nullif(l_orderkey, 7)"))
    name = f"{scratch_database(spark, 'check_unique_bucketed')}.lines"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = lines.repartition(buckets, "key")
    return checks.unique(versions.publish(dealt, name, buckets=buckets, bucket_by=["key"]), "key")


def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = frames.table(spark, sf_dir, "lineitem").withColumn("flag", F.expr("nullif(l_returnflag, 'R')"))
    return checks.not_null(lines, "flag")


def check_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = frames.table(spark, sf_dir, "lineitem").withColumn("payment_type", F.expr("nullif(l_linenumber, 2)"))
    return checks.accepted_values(lines, "payment_type", PAYMENT_TYPES)


def check_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = frames.table(spark, sf_dir, "orders").withColumn("o_custkey", F.expr("nullif(o_custkey, 0)"))
    parents = known_zones(dim_zones(spark, sf_dir))
    return checks.relationships(orders, "o_custkey", parents, "location_id")


def orphan_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = known_zones(marts.dim_zones(frames.part_zones(spark, sf_dir)))
    lost = orphans(frames.table(spark, sf_dir, "lineitem"), "l_partkey", zones, "location_id")
    return lost.groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("n"))


def check_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that are a fraction of a second too old."""
    events = frames.table(spark, sf_dir, "events")
    late = F.expr("timestamp_ntz '2024-01-30 17:59:59.1'")
    return checks.freshness(events.withColumn("ts", F.least("ts", late)), "ts", FRESH_AS_OF)


def check_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of a build over staged services that are stored, as a build stores them."""
    database = scratch_database(spark, "check_report")
    green = warehouse.store_staged(frames.green_source(spark, sf_dir), GREEN, f"{database}.green")
    yellow = warehouse.store_staged(frames.yellow_source(spark, sf_dir), YELLOW, f"{database}.yellow")
    zones = marts.dim_zones(frames.nation_zones(spark, sf_dir))
    facts = warehouse.store_facts(marts.fact_trips(green, yellow, zones), f"{database}.facts")
    results = warehouse.staging_checks(green, yellow) + warehouse.mart_checks(facts, marts.monthly_zone_revenue(facts))
    events = frames.table(spark, sf_dir, "events")
    fresh = checks.ruled("fhv_trips", events, checks.ERROR, checks.must_be_fresh("ts", FRESH_AS_OF))
    return checks.report([*results, *fresh])


QUERIES = {
    "monthly_zone_revenue": monthly_zone_revenue,
    "fact_trips": fact_trips,
    "fact_trips_service_counts": fact_trips_service_counts,
    "stg_green": stg_green,
    "stg_yellow": stg_yellow,
    "stg_fhv": stg_fhv,
    "fact_fhv": fact_fhv,
    "dim_zones": dim_zones,
    "build_warehouse": build_warehouse,
    "refresh_warehouse": refresh_warehouse,
    "merged_revenue": merged_revenue,
    "known_zones": known_zones_only,
    "dedup_skewed": dedup_skewed,
    "dedup_null_key": dedup_null_key,
    "surrogate_key_nulls": surrogate_key_nulls,
    "decode_payment": decode_payment,
    "int_cast_half_up": int_cast_half_up,
    "star_replace_null": star_replace_null,
    "typed_contract": typed_contract,
    "zone_name_merge": zone_name_merge,
    "avg_int_and_decimal": avg_int_and_decimal,
    "month_labels": month_labels,
    "row_count_capped": row_count_capped,
    "sample_limit": sample_limit,
    "preview": preview,
    "expire_rows": expire_rows,
    "read_whole_file": read_whole_file,
    "csv_roundtrip": csv_roundtrip,
    "csv_line_breaks": csv_line_breaks,
    "csv_inferred": csv_inferred,
    "csv_to_parquet": csv_to_parquet,
    "load_zones": load_zones,
    "read_month": read_month,
    "load_months": load_months,
    "promote_raw": promote_raw,
    "promote_stream": promote_stream,
    "rebuild_table": rebuild_table,
    "partitioned_window": partitioned_window,
    "expire_partitions": expire_partitions,
    "external_table": external_table,
    "external_drift": external_drift,
    "table_refresh": table_refresh,
    "view_scan": view_scan,
    "replace_append": replace_append,
    "load_month_tables": load_month_tables,
    "load_csv_table": load_csv_table,
    "check_unique": check_unique,
    "check_unique_bucketed": check_unique_bucketed,
    "check_not_null": check_not_null,
    "check_accepted": check_accepted,
    "check_relationships": check_relationships,
    "orphan_counts": orphan_counts,
    "check_freshness": check_freshness,
    "check_report": check_report,
}
