"""Which raw files a promotion has taken, so that every redelivery is noticed.

A ledger is a folder of Parquet entries. An entry is written once per promotion and holds, for each month it took, all
raw files the month had: path, length and change time. The newest entry that names a month says what was
taken of it. Any difference to what the raw zone lists now (a new file, a missing one, another length, a change time
that is later *or earlier*) makes the month due again. Once there are more than ``MOST_ENTRIES`` entries they are merged
into one. Entries are complete or not there: only those whose write was committed are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.contracts import Service
from tripmart.session import remove
from tripmart.sources import files, footers

COLUMNS = "entry bigint, month string, path string, length bigint, changed timestamp"
MOST_ENTRIES = 16


def listing(spark: SparkSession, root: str, service: Service) -> DataFrame:
    """``month``, ``path``, ``length`` and ``changed`` of every raw file; no content is read."""
    if not files.raw_months(spark, root, service):  # also refuses a name without a month
        return spark.createDataFrame([], COLUMNS).drop("entry")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(files.raw_glob(root, service))
    return found.select(
        files.month_from_path(service, F.col("path")).alias("month"),
        "path",
        "length",
        F.col("modificationTime").alias("changed"),
    )


def entries(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of the committed entries, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(path):
        return []
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/entry-*/_SUCCESS")
    names = [s.getPath().getParent().getName() for s in store.globStatus(pattern) or ()]
    return sorted(int(n.removeprefix("entry-")) for n in names)


def taken(spark: SparkSession, folder: str) -> DataFrame:
    """What was last taken of every month."""
    paths = [_entry(folder, n) for n in entries(spark, folder)]
    if not paths:
        return spark.createDataFrame([], COLUMNS)
    newest = Window.partitionBy("month")
    rows = spark.read.schema(COLUMNS).parquet(*paths)
    return rows.withColumn("_newest", F.max("entry").over(newest)).where(F.col("entry") == F.col("_newest")).drop("_newest")


def due(spark: SparkSession, root: str, service: Service, folder: str) -> DataFrame:
    """The current listing of the months of which something differs from what was taken."""
    now, known = listing(spark, root, service), taken(spark, folder)
    sides = now.withColumn("listed", F.lit(1)).unionByName(known.drop("entry").withColumn("listed", F.lit(-1)))
    # a file that is listed as it was taken cancels out
    differing = (
        sides.groupBy("month", "path", "length", "changed")
        .agg(F.sum("listed").alias("_rest"))
        .where(F.col("_rest") != 0)
        .select(F.col("month").alias("_month"))
        .distinct()
    )
    return now.join(differing, F.col("month") == F.col("_month"), "left_semi")


def pending(spark: SparkSession, folder: str, rows: DataFrame) -> DataFrame:
    """Rows for the next entry, put down before their files are read, each with the schema of its file."""
    path = f"{folder.rstrip('/')}/pending"
    chosen = footers.described(rows.select("month", "path", "length", "changed"))
    chosen.write.mode("overwrite").parquet(path)
    return spark.read.schema(chosen.schema).parquet(path)


def record(spark: SparkSession, folder: str, rows: DataFrame) -> None:
    """Add an entry with the complete listing of some months, and merge the entries if there are many."""
    known = entries(spark, folder)
    number = (known[-1] if known else 0) + 1
    entry = rows.select(F.lit(number).cast("bigint").alias("entry"), "month", "path", "length", "changed")
    entry.coalesce(1).write.mode("overwrite").parquet(_entry(folder, number))
    if len(known) >= MOST_ENTRIES:
        # rows keep their numbers, so a merge that ends before the old entries went changes nothing
        taken(spark, folder).write.mode("overwrite").parquet(_entry(folder, number + 1))
        for old in [*known, number]:
            remove(spark, _entry(folder, old))


def _entry(folder: str, number: int) -> str:
    return f"{folder.rstrip('/')}/entry-{number:012d}"
