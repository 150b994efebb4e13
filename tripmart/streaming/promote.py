"""Move new and redelivered raw months into a service's folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripmart.contracts import Service
from tripmart.sources import files, ledger

_LISTED = "path string, modificationTime timestamp, length bigint, content binary"


def promote_available(
    spark: SparkSession, root: str, service: Service, checkpoint: str, files_per_batch: int | None = None
) -> StreamingQuery:
    """Start a run that takes every raw file not taken before and then stops.

    Files are told apart by name, length and change time, whatever their age; their types play no part. What was taken
    is on record in a ledger beside the checkpoint. Before the stream starts, every month of which the raw zone shows
    any difference to the ledger (new files, files replaced under their old names, also by older ones, files
    that are gone) is replaced as a whole by what the raw zone holds of it, bound to the service's contract and
    without what retention has expired. The stream takes what is delivered from then on; a batch whose files are
    entered already, as when it runs twice, changes nothing. All due months are read, replaced and recorded
    together, so the number of jobs does not grow with the months. A file whose name holds no month ends the run with
    an error that names it.
    """
    book = f"{checkpoint.rstrip('/')}-ledger"
    if files.raw_months(spark, root, service):  # refuses a name without a month
        _replace(spark, root, service, book)

    def replace(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        known = ledger.taken(session, book).select(F.col("path").alias("_path"), "length", "changed").alias("known")
        same = (
            (F.col("path") == F.col("_path"))
            & F.col("new.length").eqNullSafe(F.col("known.length"))
            & F.col("modificationTime").eqNullSafe(F.col("changed"))
        )
        unknown = batch.alias("new").join(known, same, "left_anti").select("path").first()
        if unknown:
            files.raw_months(session, root, service)
            _replace(session, root, service, book)

    reader = (
        spark.readStream.format("binaryFile")
        .schema(_LISTED)
        .option("maxFileAge", "36500d")
        .option("ignoreMissingFiles", True)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (
        reader.load(files.raw_glob(root, service))
        .select("path", "length", "modificationTime")
        .writeStream.foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _replace(spark: SparkSession, root: str, service: Service, book: str) -> None:
    """Replace the due months, then enter what was listed of them in the ledger."""
    # what is listed now is what will be entered, whatever is delivered meanwhile
    pending = ledger.pending(spark, book, ledger.due(spark, root, service, book))
    if not pending.isEmpty():
        files.write_promoted(spark, root, service, pending)
        ledger.record(spark, book, pending)
