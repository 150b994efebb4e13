"""Sharding by Karmarkar-Karp differencing: shards of near equal bytes, equal texts together.

Equal texts (by MD5; NULL equals NULL) form a group that must not be divided. Groups above a
sixteen-thousandth of all bytes are items of their own, at most ``GRAIN`` of them; the rest are
summed into ``GRAIN`` items by hash. The driver therefore gets at most ``2 * GRAIN`` sums, whatever
the input, and differences them: the two partial partitions with the largest spread are combined
again and again, the fullest shard of one with the emptiest of the other.

A group that is larger than its even share makes a shard as large as itself; rows are never
divided to avoid that. Repeated rows are copies like others. An empty table gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.shared import gapless, written

GRAIN = 16_000


def differenced(sizes: list[int], shards: int) -> list[int]:
    """The shard of each size, by the largest differencing method over partitions of ``shards`` parts."""
    if not sizes:
        return []
    # a partial partition: spread, then per part its sum above the smallest part and its items as a linked list
    heap = []
    for i, size in enumerate(sizes):
        heap.append((-size, i, [0] * (shards - 1) + [size], [[] for _ in range(shards - 1)] + [[i]]))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, at, sums, parts = heapq.heappop(heap)
        _, _, others, more = heapq.heappop(heap)
        joined = []
        for k in range(shards):  # both ascend: the fullest meets the emptiest
            a, b = parts[k], more[shards - 1 - k]
            if len(a) < len(b):
                a, b = b, a
            a.extend(b)
            joined.append((sums[k] + others[shards - 1 - k], k, a))
        joined.sort()
        least = joined[0][0]
        heapq.heappush(heap, (least - joined[-1][0], at, [s - least for s, _, _ in joined], [p for _, _, p in joined]))
    shard = np.zeros(len(sizes), dtype=int)
    for k, part in enumerate(heap[0][3]):
        shard[part] = k
    return shard.tolist()


def digest(text: Column) -> Column:
    return F.coalesce(F.md5(text.cast("binary")), F.lit("null"))


def assign(docs: DataFrame, shards: int = 16, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) with ``size`` (long), ``shard`` (int) and ``slot`` (long).

    ``size`` is the text's UTF-8 bytes plus 1; columns of these names in the input are replaced.
    """
    keep = [c for c in keep or docs.columns if c not in ("size", "shard", "slot")]
    body = F.col(text)
    rows = written(
        docs.select(
            *keep,
            (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("long").alias("size"),
            digest(body).alias("_group"),
        )
    )
    light = F.concat(F.lit("b"), F.pmod(F.xxhash64("_group"), F.lit(GRAIN)).cast("string"))
    groups = written(rows.groupBy("_group").agg(F.sum("size").alias("_bytes")))
    total = groups.agg(F.sum("_bytes")).first()[0] or 0
    heavy = groups.where(F.col("_bytes") * GRAIN > total).select("_group", F.concat(F.lit("g"), "_group").alias("_own"))
    # fewer than GRAIN groups can hold more than a GRAIN-th of all bytes each
    placed = rows.join(F.broadcast(heavy), "_group", "left").withColumn("_item", F.coalesce("_own", light))
    items = sorted(
        ((r["_item"], r["_bytes"]) for r in placed.groupBy("_item").agg(F.sum("size").alias("_bytes")).collect()),
        key=lambda x: (-x[1], x[0]),
    )
    shard = differenced([size for _, size in items], shards)
    spark = docs.sparkSession
    table = spark.createDataFrame([(i, s) for (i, _), s in zip(items, shard, strict=True)], "_item string, shard int")
    sharded = written(placed.join(F.broadcast(table), "_item").select(*keep, "size", "shard", "_group"))
    order = [c for c in ("doc_id",) if c in keep] + ["_group"]
    return gapless(sharded, ["shard"], order, "slot").drop("_group")
