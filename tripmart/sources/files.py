"""Files in and out: monthly Parquet, folders of it, and CSV."""

from __future__ import annotations

import datetime as dt
import json
import re
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmart.contracts import RETENTION_DAYS, Contract, Service
from tripmart.operators.shape import conform
from tripmart.session import remove, today
from tripmart.sources import footers, quoted

# Text forms a CSV file keeps its rows in. The default timestamp pattern
# stops at milliseconds; doubled quotes are what other CSV readers expect.
CSV_OPTIONS = {
    "header": "true",
    "timestampNTZFormat": "yyyy-MM-dd[' ']['T']HH:mm:ss[.SSSSSS]",
    "quote": '"',
    "escape": '"',
}
# the writer would take the blanks around a text away
CSV_WRITE_OPTIONS = {
    **CSV_OPTIONS,
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


MONTH = re.compile(r"\d{4}-(0[1-9]|1[0-2])")


def checked_month(label: str, origin: str = "") -> str:
    """``label``, if it is a ``YYYY-MM`` month."""
    if not MONTH.fullmatch(label):
        raise ValueError(f"not a YYYY-MM month: {label}" + f" ({origin})" * bool(origin))
    return label


def landing_path(landing: str, service: Service, month: str) -> str:
    return f"{landing}/{service.landing_prefix}{month}.parquet"


def raw_path(root: str, service: Service, month: str) -> str:
    return f"{root}/raw/{service.raw_prefix}{month}.parquet"


def raw_glob(root: str, service: Service) -> str:
    return raw_path(root, service, "*")


def service_folder(root: str, service: Service) -> str:
    return f"{root}/{service.folder}"


def read_file(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet file or folder with its own schema."""
    return spark.read.parquet(path)


def read_month(spark: SparkSession, landing: str, service: Service, month: str) -> DataFrame:
    """One monthly drop, bound to the service's contract.

    The month's own schema is read and then cast, because column types drift from month to
    month and Parquet readers refuse some declared-type mismatches (bigint read as double).
    """
    return conform(spark.read.parquet(landing_path(landing, service, month)), service.source, service.drifting)


def write_raw(df: DataFrame, root: str, service: Service, month: str) -> str:
    """Put a month into the raw zone, replacing an earlier delivery of it."""
    path = raw_path(root, service, month)
    df.write.mode("overwrite").parquet(path)
    return path


def read_service(spark: SparkSession, root: str, service: Service) -> DataFrame:
    """Everything promoted for a service and not expired, with ``source_month`` from the folder names.

    The schema is declared, so no footers are read to infer it; the drifting columns are
    left out of it and come back as typed NULLs.
    """
    declared = service.source.without(*service.drifting).plus(("source_month", "string"))
    stored = spark.read.schema(declared.ddl).parquet(service_folder(root, service))
    rows = conform(stored, service.source.plus(("source_month", "string")), service.drifting)
    return _unexpired(rows, root, service)


def set_retention(spark: SparkSession, root: str, service: Service, days: int | None) -> None:
    """Keep the days of retention with a service's folder; ``None`` keeps rows for ever."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_properties(root, service))
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    try:
        out.write(bytearray(json.dumps({"retention_days": days}).encode()))
    finally:
        out.close()


def retention(spark: SparkSession, root: str, service: Service) -> int | None:
    """The days that a service's folder keeps; those of the contract if it was never told."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_properties(root, service))
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(path):
        return RETENTION_DAYS
    stream = store.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["retention_days"]
    finally:
        stream.close()


def _properties(root: str, service: Service) -> str:
    return f"{service_folder(root, service)}/_properties.json"


def _unexpired(rows: DataFrame, root: str, service: Service) -> DataFrame:
    """Rows picked up on a day that the folder still keeps. The bound is on the timestamp, which Parquet can skip by."""
    days = retention(rows.sparkSession, root, service)
    if days is None:
        return rows
    first = today(rows.sparkSession) - dt.timedelta(days=days - 1)
    kept = F.col(service.pickup) >= F.lit(first.isoformat()).cast("timestamp_ntz")
    return rows.filter(F.col(service.pickup).isNull() | kept)


def write_promoted(spark: SparkSession, root: str, service: Service, listed: DataFrame) -> None:
    """Replace months in the service's folder by what the raw zone holds of them, without what has expired.

    ``listed`` names the ``month``, ``path`` and ``schema`` of all their raw files. Files that share a schema
    are read together, all are bound to the service's contract and written in one job, in which a task writes what
    it has read. A month that has no rows left loses its folder.
    """
    alike = footers.grouped(listed)
    if not alike:
        return
    folder = service_folder(root, service)
    label = month_from_path(service, F.col("_metadata.file_path")).alias("source_month")
    contract = service.source.plus(("source_month", "string"))
    read = [
        spark.read.schema(a.schema).parquet(*[raw_path(root, service, m) for m in sorted(a.months)], *sorted(a.paths))
        for a in alike
    ]
    bound = [conform(df.select("*", label), contract, service.drifting) for df in read]
    rows = _unexpired(reduce(DataFrame.unionAll, bound), root, service)
    seen = Observation()
    (
        rows.observe(seen, F.collect_set("source_month").alias("months"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("source_month")
        .parquet(folder)
    )
    named = {m for a in alike for m in a.months} | {_month_of(service, p) for a in alike for p in a.paths}
    for month in named.difference(seen.get["months"]):
        remove(spark, f"{folder}/source_month={month}")


def _month_of(service: Service, path: str) -> str:
    return re.search(rf"{service.raw_prefix}([^/]*)\.parquet(?:/|$)", path)[1]


def month_from_path(service: Service, path: Column) -> Column:
    """The month label of a raw-zone file: from its name, never from the data."""
    return F.regexp_extract(path, rf"{service.raw_prefix}([^/]*)\.parquet(?:/|$)", 1)


def raw_months(spark: SparkSession, root: str, service: Service) -> dict[str, int]:
    """The delivered months and when each was last changed (milliseconds; 0 where a store does not know).

    One name per month is listed, however many files a month has.
    """
    pattern = spark._jvm.org.apache.hadoop.fs.Path(raw_glob(root, service))
    listed = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or ()
    found = {}
    for status in listed:
        path = status.getPath()
        label = path.getName().removeprefix(service.raw_prefix).removesuffix(".parquet")
        found[checked_month(label, path.toString())] = status.getModificationTime()
    return found


def list_parquet(spark: SparkSession, location: str) -> DataFrame:
    """``path`` of every Parquet file at a path or below a folder, each as a group of its own; no content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(location)
    visible = ~F.element_at(F.split("path", "/"), -1).rlike("^[_.]")
    return found.filter(visible).select("path", F.col("path").alias("month"))


def globs(paths: list[str]) -> list[str]:
    """Patterns that name exactly these files, one per folder."""
    folders = defaultdict(list)
    for path in paths:
        folder, _, name = path.rpartition("/")
        folders[folder].append(re.sub(r"([][{}*?,\\])", r"\\\1", name))
    return [f"{folder}/{{{','.join(sorted(names))}}}" for folder, names in sorted(folders.items())]


def read_csv(spark: SparkSession, path: str, contract: Contract | None = None, line_breaks: bool = False) -> DataFrame:
    """CSV with a header. Without a contract the types are inferred, at the price of a
    second pass over the text. With one, a cell or row that does not fit it raises, also
    when a query needs no or few columns. Fields may hold line breaks if ``line_breaks`` says so, at the price of a
    pass that counts quotes; files are read in splits all the same."""
    reader = spark.read.options(**CSV_OPTIONS)
    if line_breaks:
        return _read_records(spark, path, contract)
    if contract is None:
        return reader.option("inferSchema", True).csv(path)
    strict = reader.options(mode="FAILFAST", enforceSchema=False).schema(contract.ddl).csv(path)
    # a generator needs all its columns, so every cell is parsed whatever the query needs
    return strict.select(F.inline(F.array(F.struct(*[F.col(f"`{n}`") for n in contract.names]))))


def _read_records(spark: SparkSession, path: str, contract: Contract | None) -> DataFrame:
    if contract is None:
        raise ValueError("fields with line breaks are read by a contract")
    found = quoted.records(spark, path)
    options = {**CSV_OPTIONS, "mode": "FAILFAST", "multiLine": "true"}
    first = (F.col("split") == 0) & (F.col("record") == 1)
    header = F.from_csv("value", ", ".join(f"`{n}` string" for n in contract.names), options)
    named = F.struct(*[header[n].alias(n) for n in contract.names]) == F.struct(*[F.lit(n).alias(n) for n in contract.names])
    wrong = F.raise_error(F.concat(F.lit("MALFORMED header: "), "value"))
    # a header that does not fit raises as a row does; a line without anything is no row
    rows = found.where(~first | F.when(named, False).otherwise(wrong.cast("boolean"))).where(F.col("value") != "")
    parsed = F.from_csv("value", contract.ddl, options)
    return rows.select(F.inline(F.array(parsed)))


def write_csv(df: DataFrame, path: str, line_breaks: bool = False) -> None:
    """One line per row: a line break inside a text raises, since a reader in splits cannot see it, unless
    ``line_breaks`` is what its readers expect, too."""
    writer = df.write.mode("overwrite").options(**CSV_WRITE_OPTIONS)
    if line_breaks:
        return writer.csv(path)
    texts = [
        F.when(
            F.col(f"`{name}`").rlike("[\r\n]"), F.raise_error(F.lit(f"a line break in column {name}")).cast("string")
        )
        .otherwise(F.col(f"`{name}`"))
        .alias(name)
        if dtype == "string"
        else F.col(f"`{name}`")
        for name, dtype in df.dtypes
    ]
    df.select(*texts).write.mode("overwrite").options(**CSV_WRITE_OPTIONS).csv(path)


def csv_to_parquet(spark: SparkSession, source: str, target: str, contract: Contract | None = None) -> DataFrame:
    """Convert a CSV file and return the Parquet copy. Any other file name is an error."""
    if not source.endswith(".csv"):
        raise ValueError(f"not a .csv file: {source}")
    read_csv(spark, source, contract).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)
