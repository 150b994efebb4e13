"""Near duplicates by an LSH forest over minhash signatures.

A document is the set of its distinct five-word shingles (lower case A-Z; the whole sequence, if
shorter). Texts of equal words are one node. Each of ``TREES`` trees orders the nodes by its own
sequence of minhashes: nodes that agree in the first ``DEPTH`` of them share a region, and within
a region the order goes on, so that neighbours have the longest common prefixes and a dense region
is searched at a greater depth than a thin one. The order is range partitioned: a hot region
spreads over tasks, and the driver joins the rows at the partitions' edges.

Neighbours are candidates; the shingle sets of both texts confirm a link. In the first trees the first node
of a region is a candidate for all the others too, which joins most copies in a few steps. After
that come the neighbours in the other trees that are still apart; and regions that still hold
several components are compared completely, in blocks of bounded size on signatures, so that
no pair sharing a region is lost to the order. A pair at the threshold shares no region of
any tree with probability (1 - 0.75 ** 4) ** 32, 5e-6.

NULL and empty texts have no shingles and are linked with nothing. Rows that share an id form one
row each; a NULL id never names a component unless nothing else is in it. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.components import components, joined, rooted
from tripmart.llm.hashing import Rolling, chunks, mixed
from tripmart.llm.shared import release, small, words, written

WORDS = 5
TREES, DEPTH, FURTHER = 32, 4, 4
HASHES = TREES * DEPTH
FIRST_TREES = 4
BLOCK = 64
#: Five standard deviations of the estimate below the threshold: it drops a pair with a probability of less than 1e-6.
ESTIMATE = 0.55
PERCENT = 75
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_MULTIPLIERS = np.random.default_rng(75).integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = np.random.default_rng(5).integers(0, 2**63, WORDS + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each (lower-cased) text."""
    lengths = np.array([len(t) + 1 for t in texts])
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space])) != 0)
    start, end = edge[::2], edge[1::2]
    word = Rolling(data).of(start, end)
    first = np.searchsorted(start, np.concatenate([[0], np.cumsum(lengths)]))
    n = len(word)
    if n >= WORDS:
        rows = n - WORDS + 1
        full = sum(word[k : k + rows] * _PLACES[k] for k in range(WORDS))
        full = mixed(full)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= WORDS:
            out.append(np.unique(full[a : b - WORDS + 1]))
        elif b > a:
            few = np.append(word[a:b], np.uint64(b - a)) * np.append(_PLACES[: b - a], _PLACES[WORDS])
            out.append(mixed(few.sum(dtype=np.uint64, keepdims=True)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(hashes: np.ndarray) -> bytes:
    """The minima of ``HASHES`` multiplied copies of the set, 4 bytes each; empty for an empty set."""
    if not len(hashes):
        return b""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1024):
        part = hashes[at : at + 1024, None] * _MULTIPLIERS
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(">u4").tobytes()


def signed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``_key``, ``words`` (digest of the word sequence), ``n_shingles``, ``signature``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = [(t or "").encode().lower() for t in batch.column(1).to_pylist()]
            digests = [hashlib.md5(b" ".join(t.split())).digest() for t in texts]
            counts, signatures = [], []
            for part in chunks(texts):
                for found in shingles([texts[i] for i in part]):
                    counts.append(len(found))
                    signatures.append(signature(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array(counts, pa.int64()), pa.array(signatures, pa.binary())],
                ["_key", "words", "n_shingles", "signature"],
            )

    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"_key {kind}, words binary, n_shingles long, signature binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ">u4").reshape(-1, HASHES)


def forest(nodes: DataFrame) -> DataFrame:
    """A row per node and tree: ``tree``, ``region``, ``label`` (the next minhashes), and the other columns."""
    others = [c for c in nodes.columns if c != "signature"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            table = _matrix(batch.column(batch.schema.get_field_index("signature")))
            twice = np.concatenate([table, table[:, :FURTHER]], axis=1)
            for tree in range(TREES):
                at = tree * DEPTH
                head = np.ascontiguousarray(twice[:, at : at + DEPTH]).astype(np.uint64)
                region = mixed(mixed(head[:, 0] << np.uint64(32) | head[:, 1]) + (head[:, 2] << np.uint64(32) | head[:, 3]))
                tail = np.ascontiguousarray(twice[:, at + DEPTH : at + DEPTH + FURTHER])
                labels = pa.Array.from_buffers(
                    pa.binary(4 * FURTHER), len(tail), [None, pa.py_buffer(tail.tobytes())]
                ).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(tail), tree, np.int32)),
                        pa.array(region.view(np.int64)),
                        labels,
                        *[batch.column(batch.schema.get_field_index(c)) for c in others],
                    ],
                    ["tree", "region", "label", *others],
                )

    kinds = dict(nodes.dtypes)
    return nodes.mapInArrow(run, "tree int, region long, label binary" + "".join(f", {c} {kinds[c]}" for c in others))


def neighbours(nodes: DataFrame) -> DataFrame:
    """``a`` < ``b`` and the first ``tree`` in whose order they are neighbours of one region."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, first = TaskContext.get().partitionId(), None, None
        names = ["tree", "region", "a", "b", "edge"]
        for batch in batches:
            if not batch.num_rows:
                continue
            tree, region, node = (
                np.asarray(batch.column(batch.schema.get_field_index(c))) for c in ("tree", "region", "node")
            )
            if last is not None:
                tree, region, node = (np.concatenate([[x], y]) for x, y in zip(last, (tree, region, node), strict=True))
            else:
                first = tree[0], region[0], node[0]
            new = np.concatenate([[True], (tree[1:] != tree[:-1]) | (region[1:] != region[:-1])])
            lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            same = np.flatnonzero(~new)
            early = same[(tree[same] < FIRST_TREES) & (lead[same] < same - 1)]
            a, b = np.concatenate([node[same - 1], node[lead[early]]]), np.concatenate([node[same], node[early]])
            same = np.concatenate([same, early])
            last = tree[-1], region[-1], node[-1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(tree[same].astype(np.int32)),
                    pa.array(region[same]),
                    pa.array(np.minimum(a, b)),
                    pa.array(np.maximum(a, b)),
                    pa.array(np.full(len(same), -1, np.int64)),
                ],
                names,
            )
        if last is not None:
            ends = [np.array([x, y]) for x, y in zip(first, last, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ends[0].astype(np.int32)),
                    pa.array(ends[1]),
                    pa.array(ends[2]),
                    pa.array(ends[2]),
                    pa.array(np.array([2 * part, 2 * part + 1])),
                ],
                names,
            )

    spark = nodes.sparkSession
    order = ["tree", "region", "label", "node"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = forest(nodes).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    found = written(ordered.mapInArrow(run, "tree int, region long, a long, b long, edge long"))
    # two rows per partition: the last of one and the first of the next may be neighbours
    ends = sorted(found.where("edge >= 0").collect(), key=lambda r: r["edge"])
    across = [
        (x["tree"], min(x["a"], y["a"]), max(x["a"], y["a"]))
        for x, y in zip(ends[1::2], ends[2::2], strict=False)
        if (x["tree"], x["region"]) == (y["tree"], y["region"])
    ]
    pairs = found.where("edge < 0").select("tree", "a", "b")
    if across:
        pairs = pairs.union(spark.createDataFrame(across, "tree int, a long, b long"))
    return written(pairs.groupBy("a", "b").agg(F.min("tree").alias("tree")))


def _alike(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold; ``texts`` has ``node`` and ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            left = [t.encode().lower() for t in batch.column(2).to_pylist()]
            right = [t.encode().lower() for t in batch.column(3).to_pylist()]
            good = []
            for part in chunks([x + y for x, y in zip(left, right, strict=True)]):
                sets = shingles([t for i in part for t in (left[i], right[i])])
                for k, i in enumerate(part):
                    if _alike(sets[2 * k], sets[2 * k + 1]):
                        good.append(i)
            yield batch.select([0, 1]).take(pa.array(good, pa.int64()))

    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(run, "a long, b long")


def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs that no chain of links joins yet."""
    return rooted(rooted(pairs, "a", roots), "b", roots).where("a_root != b_root").select("a", "b")


def leftovers(nodes: DataFrame, roots: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between different components that share a region, at least one per node and other component.

    Components above ``BLOCK`` nodes are compared as a whole with the nodes of smaller ones that meet them
    in any region, so that their texts are moved once and not for every tree. Nodes of small components
    are compared with each other region by region. Both go in blocks of about ``BLOCK`` nodes: a task
    compares two blocks by their signatures and then confirms on the full sets, in the order of the
    estimates and until a node is linked to a component.
    """
    nodes = written(rooted(nodes, "node", roots).withColumnRenamed("node_root", "root"))
    large = written(
        nodes.groupBy("root").agg(F.count("*").alias("nodes")).where(F.col("nodes") > BLOCK).withColumnRenamed("root", "_root")
    )
    sized = nodes.join(large, F.col("root") == F.col("_root"), "left")
    nodes = written(sized.select("node", "root", "signature", F.coalesce("nodes", F.lit(0)).cast("long").alias("nodes")))
    rows = written(forest(nodes).drop("label"))
    of_root = rows.groupBy("tree", "region", "root", "nodes").agg(F.count("*").alias("n"))
    bodies = written(nodes.join(texts, "node").select("node", "root", "nodes", "signature", "text"))

    # small components, region by region
    minor = F.col("nodes") == 0
    regions = of_root.groupBy("tree", "region").agg(
        F.sum("n").alias("all"), F.sum(F.when(minor, F.col("n"))).alias("n"), F.count(F.when(minor, 1)).alias("roots")
    )
    # two nodes alone in a region were neighbours
    crowded = written(
        regions.where(F.col("all") > 2).where("roots > 1").select(
            F.col("tree").alias("_tree"), F.col("region").alias("_region"), F.ceil(F.col("n") / BLOCK).alias("blocks")
        )
    )
    same_region = (F.col("tree") == F.col("_tree")) & (F.col("region") == F.col("_region"))
    inside = rows.where("nodes = 0").join(crowded, same_region).select(
        "tree", "region", F.col("node").alias("_node"), F.pmod(F.xxhash64("node"), "blocks").alias("block")
    )
    blocks = _gathered(inside, bodies, ["tree", "region", "block"])
    sides = [blocks.select("tree", "region", F.col("block").alias(f"block_{s}"), F.col("members").alias(s)) for s in "xy"]
    within = sides[0].join(sides[1], ["tree", "region"]).where("block_x <= block_y").select("tree", "x", "y")

    # large components, each as a whole, with what meets them
    hosts = of_root.where("nodes > 0").select(
        F.col("tree").alias("_tree"), F.col("region").alias("_region"), F.col("root").alias("host"), F.col("nodes").alias("host_nodes")
    )
    smaller = F.struct("nodes", "root") < F.struct("host_nodes", "host")
    guests = written(rows.join(written(hosts), same_region).where(smaller).select("host", F.col("node").alias("_node")).distinct())
    counts = written(
        guests.groupBy("host").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")).withColumnRenamed("host", "_host")
    )
    guests = guests.join(counts, F.col("host") == F.col("_host")).select(
        "host", "_node", F.pmod(F.xxhash64("_node"), "blocks").alias("block")
    )
    asked = _gathered(guests, bodies, ["host", "block"])
    met = nodes.join(counts, F.col("root") == F.col("_host"), "left_semi").select(
        F.col("root").alias("host"),
        F.col("node").alias("_node"),
        F.pmod(F.xxhash64("node"), F.ceil(F.col("nodes") / BLOCK)).alias("block"),
    )
    stored = _gathered(met, bodies, ["host", "block"])
    one = asked.select("host", F.col("members").alias("x"))
    whole = one.join(stored.select("host", F.col("members").alias("y")), "host").select(F.lit(TREES).alias("tree"), "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for tree, x, y in zip(*batch.columns, strict=True):
                found.extend(_linked(tree.as_py(), x.values, y.values))
            a, b = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return within.union(whole).mapInArrow(run, "a long, b long")


def _gathered(dealt: DataFrame, bodies: DataFrame, keys: list[str]) -> DataFrame:
    """The ``members`` of every block: node, root, signature and text of its ``_node`` rows."""
    members = dealt.join(bodies, F.col("_node") == F.col("node"))
    gathered = members.groupBy(*keys).agg(F.collect_list(F.struct("node", "root", "signature", "text")).alias("members"))
    return written(gathered)


def _linked(tree: int, x: pa.StructArray, y: pa.StructArray) -> Iterator[tuple[int, int]]:
    """Links between two blocks of a region of ``tree``; pairs that share a region of an earlier tree are left to it.

    With ``TREES`` for the tree, pairs that share a region of any.
    """
    nodes_x, nodes_y, roots_x, roots_y = (np.asarray(s.field(f)) for f in ("node", "root") for s in (x, y))
    sig_x, sig_y = _matrix(x.field("signature")), _matrix(y.field("signature"))
    earlier = tree * DEPTH
    sets: dict[tuple[int, int], np.ndarray] = {}

    def shingled(side: int, at: int) -> np.ndarray:
        if (side, at) not in sets:
            sets[side, at] = shingles([(x, y)[side].field("text")[at].as_py().encode().lower()])[0]
        return sets[side, at]

    for i in range(len(nodes_x)):
        equal = sig_y == sig_x[i]
        likely = equal.mean(axis=1)
        shared = equal[:, :earlier].reshape(len(equal), tree, DEPTH).all(axis=2).any(axis=1)
        open_ = np.flatnonzero((roots_y != roots_x[i]) & (likely >= ESTIMATE) & (shared == (tree == TREES)))
        linked = set()
        for j in open_[np.argsort(-likely[open_], kind="stable")].tolist():
            if roots_y[j] not in linked and _alike(shingled(0, i), shingled(1, j)):
                linked.add(roots_y[j])
                yield int(nodes_x[i]), int(nodes_y[j])


def _classes(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The rows as ``signed`` gives them, and the texts of equal words: ``words``, smallest ``first_key`` and ``root``."""
    rows = written(signed(docs, key, text))
    nodes = written(
        rows.where("n_shingles > 0")
        .groupBy("words")
        .agg(F.min("_key").alias("first_key"), F.first("signature").alias("signature"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    signatures = nodes.select("node", "signature")
    pairs = neighbours(signatures)
    release(docs.sparkSession)
    live = written(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    wanted = nodes.join(live, "node").select("node", F.col("first_key").alias("_first"), "words")
    body = docs.select(F.col(key).alias("_key"), F.col(text).alias("text"))
    texts = written(_of_words(body.join(wanted, F.col("_key").eqNullSafe(F.col("_first")))))
    release(docs.sparkSession)
    early = pairs.where(F.col("tree") < FIRST_TREES)
    roots = written(components(written(confirmed(early, texts))))
    live_nodes = signatures.join(live, "node").select("node", "signature")
    later = apart(pairs.where(F.col("tree") >= FIRST_TREES), roots)
    more = written(confirmed(later, texts).union(leftovers(live_nodes, roots, texts)))
    if not more.isEmpty():
        roots = written(joined(roots, more))
    found = written(rooted(nodes.select("node", "words", "first_key"), "node", roots).withColumnRenamed("node_root", "root"))
    return rows, found


def cluster(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id``, the smallest key among all documents that links reach."""
    rows, found = _classes(docs, key, text)
    kind = docs.schema[key].dataType.simpleString()
    least = written(found.groupBy("root").agg(F.min("first_key").alias("component_id")).withColumnRenamed("root", "_root"))
    named = written(found.join(least, F.col("root") == F.col("_root")).select(F.col("words").alias("_words"), "component_id"))
    return rows.join(named, F.col("words") == F.col("_words"), "left").select(
        F.col("_key").alias(key),
        "n_shingles",
        F.coalesce("component_id", "_key").cast(kind).alias("component_id"),
    )


def survivors(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every group of near duplicates, that with the smallest id, and all rows without words.

    An id that one row has names it. Rows that share their id with another one, or have none, are told apart by their
    words, and of those that repeat each other one stays.
    """
    rows, found = _classes(docs, key, text)
    best = F.min(F.struct(F.col("first_key").isNull().alias("none"), F.col("first_key"), F.col("words")))
    chosen = written(
        found.groupBy("root").agg(best.alias("best")).select(F.col("best.first_key").alias("_first"), F.col("best.words").alias("_words"))
    )
    stays = F.col("_key") == F.col("_first")
    first = rows.join(chosen, F.col("words") == F.col("_words"), "left").where(stays | (F.col("n_shingles") == 0))
    kept = written(first.select(F.col("_key").alias("_kept")).where("_kept is not null").distinct())
    several = rows.where("_key is not null").groupBy("_key").count().where("count > 1")
    several = written(several.select(F.col("_key").alias("_several")))
    named, shared = docs.where(F.col(key).isNotNull()), F.col(key) == F.col("_several")
    plain = named.join(kept, F.col(key) == F.col("_kept"), "left_semi")
    hard = docs.where(F.col(key).isNull())
    if not several.isEmpty():
        plain = plain.join(several, shared, "left_anti")
        hard = hard.union(named.join(several, shared, "left_semi"))
    own = words(F.translate(F.col(text), CAPITALS, CAPITALS.lower()))
    told = hard.withColumns({"_n": F.size(own), "_own": F.md5(F.array_join(own, " ").cast("binary"))})
    same = (F.col("_own") == F.lower(F.hex("_words"))) & F.col(key).eqNullSafe(F.col("_first"))
    once = told.where("_n > 0").join(chosen, same, "left_semi").dropDuplicates(["_own"])
    return reduce(DataFrame.union, [f.select(*docs.columns) for f in (plain, once, told.where("_n = 0"))])


def _of_words(rows: DataFrame) -> DataFrame:
    """``node`` and ``text`` of rows whose text has the node's words; ids alone may be shared by several texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            own = [
                hashlib.md5(b" ".join((t or "").encode().lower().split())).digest() == w
                for t, w in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            ]
            yield batch.filter(pa.array(own, pa.bool_())).select([0, 1])

    return rows.select("node", "text", "words").mapInArrow(run, "node long, text string")
