"""What several operators need: written intermediate tables and ranks without gaps."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.session import scratch_folder, setting

#: A word is a run of anything but these six white space characters.
SPACES = " \t\n\x0b\x0c\r"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"
ROWS_PER_BUCKET = 4096
BATCH_BYTES = "8m"


def words(text: Column) -> Column:
    """The words of a text, in order; none for NULL or white space alone."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE_PATTERN)).otherwise(
        F.array().cast("array<string>")
    )


def written(frame: DataFrame) -> DataFrame:
    """The frame as a Parquet table under the shared folder: it cuts the lineage and outlives executors.

    Texts go to Python tasks in batches of ``BATCH_BYTES``, which bounds what both sides hold.
    """
    spark = frame.sparkSession
    path = scratch_folder(spark)
    with setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES):
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def sampled(frame: DataFrame, by: list[str], rows: int) -> list:
    """About ``rows`` rows, never more, chosen by the hash of ``by``; all of a smaller frame.

    Whatever the input, no more than these rows travel.
    """
    every = max(1, math.ceil(frame.count() / rows))
    return frame.where(F.pmod(F.xxhash64(*by), F.lit(every)) == 0).limit(rows).collect()


def storage_of(uri: str) -> tuple:
    """The file system that tasks reach a shared folder or file by, and the path within it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def small(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of few, so that a task holds few texts as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        pa.default_memory_pool().release_unused()


def release(spark) -> None:
    """Let Spark drop the shuffle files of jobs whose results are written by now."""
    spark.sparkContext._jvm.System.gc()


def gapless(frame: DataFrame, keys: list[str], order: list[str], out: str) -> DataFrame:
    """Number the rows of each key from 0 without gaps, in no task more than a bucket of a key.

    Rows fall into hash buckets of about ``ROWS_PER_BUCKET``; a bucket starts where the buckets
    before it end. Equal rows get different numbers. ``frame`` is read twice, so it should be
    a written table.
    """
    buckets = max(64, math.ceil(frame.count() / ROWS_PER_BUCKET))
    dealt = frame.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(*keys, "_bucket")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_bucket").alias("_of_bucket"), "_start")
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    ranked = dealt.withColumn("_rank", F.row_number().over(inside))
    same = F.col("_bucket") == F.col("_of_bucket")
    for key in keys:
        same &= F.col(key) == F.col(f"_of_{key}")
    return ranked.join(starts, same).select(
        *frame.columns, (F.col("_start") + F.col("_rank") - 1).cast("long").alias(out)
    )


def globally_ranked(frame: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Number all rows from 0 in an order, with no task that sees more than its range of it.

    Rows are range partitioned and sorted, their place within their part is written with them, and the parts before it
    (one row each) say where a part starts. Equal rows are told apart by where they were read, so that many of
    them are not one part. ``frame`` should be a written table.
    """
    marked = frame.withColumn("_ranked_read", F.monotonically_increasing_id())
    place = written(
        marked.repartitionByRange(*order, "_ranked_read")
        .sortWithinPartitions(*order, "_ranked_read")
        .drop("_ranked_read")
        .withColumn("_ranked_place", F.monotonically_increasing_id())
        .withColumns({"_ranked_part": F.shiftright("_ranked_place", 33), "_ranked_place": F.col("_ranked_place").bitwiseAND((1 << 33) - 1)})
    )
    sizes = place.groupBy("_ranked_part").agg(F.count("*").alias("_ranked_rows"))
    before = Window.orderBy("_ranked_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("_ranked_part").alias("_ranked_of"), F.coalesce(F.sum("_ranked_rows").over(before), F.lit(0)).alias("_ranked_start"))
    joined = place.join(starts, F.col("_ranked_part") == F.col("_ranked_of"))
    return joined.select(*frame.columns, (F.col("_ranked_start") + F.col("_ranked_place")).alias(out))
