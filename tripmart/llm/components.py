"""Connected components of a graph that may have hubs, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.shared import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]


def _least(edges: DataFrame) -> DataFrame:
    """The smallest smaller neighbour ``m`` of every node ``w`` that has one."""
    return written(edges.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w"))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every node of ``links`` (``a``, ``b``: long).

    Edges point from the larger node ``u`` to the smaller ``v``. Each round hangs larger neighbours of
    a node on its smallest neighbour, then smaller ones; rounds grow with the logarithm of the
    diameter. Lists of neighbours are never built: smallest neighbours are aggregates in a table
    of their own, and the joins with it may be split by key. No links give no rows.
    """
    edges = written(
        links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    state = _state(edges)
    while state[0]:
        least = _least(edges)
        # a hub at the small end has no smaller neighbour, so its larger ones stay where they are
        moved = edges.join(least, F.col("v") == F.col("w"), "left").select("u", F.coalesce("m", "v").alias("v"))
        large = written(moved.union(least.select(F.col("w").alias("u"), F.col("m").alias("v"))))
        lower = _least(large)
        small = large.join(lower, F.col("u") == F.col("w")).where(F.col("v") != F.col("m"))
        edges = written(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(lower.select(F.col("w").alias("u"), F.col("m").alias("v")))
            .distinct()
        )
        after = _state(edges)
        if after == state:
            break
        state = after
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )


def joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` of a graph after ``links`` were added to it; the work grows with the links that join components."""
    ends = rooted(rooted(links, "a", roots), "b", roots)
    more = components(ends.select(F.col("a_root").alias("a"), F.col("b_root").alias("b")))
    named = written(more.withColumnsRenamed({"node": "_old", "root": "_new"}))
    kept = roots.join(named, F.col("root") == F.col("_old"), "left")
    single = named.join(roots, F.col("_old") == F.col("node"), "left_anti")
    return kept.select("node", F.coalesce("_new", "root").alias("root")).union(
        single.select(F.col("_old").alias("node"), F.col("_new").alias("root"))
    )


def rooted(rows: DataFrame, node: str, roots: DataFrame) -> DataFrame:
    """Add ``{node}_root`` to rows; a node without links is its own root."""
    named = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    return rows.join(named, F.col(node) == F.col("_node"), "left").select(
        *rows.columns, F.coalesce("_root", node).alias(f"{node}_root")
    )
