"""Records of CSV files whose quoted fields hold line breaks, read in splits like any other text.

Whether a line starts a record depends on the number of quotes before it, which a task that starts in the middle of a file
cannot know. So tasks count under both assumptions: for every line, how many lines up to it start a record if its
split starts outside a field, and how many if it starts inside one. The quotes of the splits before it, one row per
split, then say which count holds. A line that is a record by itself stays where it is; only lines of records with
breaks in them, and what hangs over the end of a split, are gathered. Quotes inside a field are doubled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUOTE = '"'
_LINES = "file string, split long, line long, value string, inside int, quotes int, even long, odd long"


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its split and place in it, whether quotes open before it if the split starts outside a field
    (``inside``), its ``quotes``, and the records that start up to it if the split starts outside (``even``) or inside (``odd``)."""
    text = spark.read.option("lineSep", "\n").text(path)
    rows = text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, np.zeros(4, np.int64)  # of the split so far: lines, quotes, records by either count
        for batch in batches:
            if not batch.num_rows:
                continue
            names, places = batch.column(0).dictionary_encode().indices.to_numpy(), batch.column(1).to_numpy()
            quotes = pc.count_substring(batch.column(2), QUOTE).to_numpy().astype(np.int64)
            change = np.flatnonzero((names[1:] != names[:-1]) | (places[1:] != places[:-1])) + 1
            out = []
            for a, b in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows], strict=True):
                if (key := (batch.column(0)[a].as_py(), int(places[a]))) != last:
                    last, state = key, np.zeros(4, np.int64)
                own = quotes[a:b]
                before = (state[1] + np.cumsum(own) - own) % 2
                even, odd = state[2] + np.cumsum(before == 0), state[3] + np.cumsum(before == 1)
                out.append((state[0] + np.arange(b - a), before, even, odd))
                state = np.array([state[0] + b - a, state[1] + own.sum(), even[-1], odd[-1]])
            line, before, even, odd = (np.concatenate(c) for c in zip(*out, strict=True))
            columns = [pa.array(line), batch.column(2), pa.array(before, pa.int32()), pa.array(quotes, pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], *columns, pa.array(even), pa.array(odd)],
                ["file", "split", "line", "value", "inside", "quotes", "even", "odd"],
            )

    return rows.mapInArrow(run, _LINES)


def records(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``split``, ``record`` (its number in the split it starts in) and ``value``, without its line break."""
    found = lines(spark, path)
    in_order = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = found.groupBy("file", "split").agg(
        F.sum("quotes").alias("quotes"), F.max("even").alias("even"), F.max("odd").alias("odd")
    )
    # one row per split: is its start inside a field, how many records start in it, and which one is open when it starts
    splits = splits.withColumn("opens", F.coalesce(F.sum("quotes").over(in_order), F.lit(0)) % 2)
    splits = splits.withColumn("starts", F.when(F.col("opens") == 0, F.col("even")).otherwise(F.col("odd")))
    holds = F.when(F.col("starts") > 0, F.struct("split", F.col("starts").alias("record")))
    splits = splits.withColumn("open", F.last(holds, ignorenulls=True).over(in_order))
    named = splits.select(F.col("file").alias("_file"), F.col("split").alias("_split"), "opens", "open")
    placed = found.join(named, (F.col("file") == F.col("_file")) & (F.col("split") == F.col("_split")))
    own = F.when(F.col("opens") == 0, F.col("even")).otherwise(F.col("odd"))
    hangs = own == 0  # over from an earlier split
    placed = placed.select(
        "file",
        F.when(hangs, F.col("open.split")).otherwise(F.col("split")).alias("split"),
        F.when(hangs, F.col("open.record")).otherwise(own).alias("record"),
        F.struct(F.col("split").alias("of"), "line", "value").alias("part"),
        "value",
        ((F.col("inside") == F.col("opens")) & (F.col("quotes") % 2 == 0)).alias("whole"),
    )
    whole = placed.where("whole").select("file", "split", "record", "value")
    parts = placed.where("not whole").groupBy("file", "split", "record").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    joined = parts.select("file", "split", "record", F.array_join(F.col("parts.value"), "\n").alias("value"))
    # the line feed ends a record; a carriage return before it does so too
    return whole.union(joined).withColumn("value", F.regexp_replace("value", "\r$", ""))
