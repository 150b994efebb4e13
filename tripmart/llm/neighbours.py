"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing.

Vectors get one more coordinate that makes their norms equal (queries get 0 there and the same norm), so
that the largest inner product is the smallest Euclidean distance. Each of ``TABLES`` tables cuts
Gaussian projections into buckets; a query visits a table's buckets in the order of the estimated
probability that a neighbour at its distance falls there, until ``SUCCESS`` of the probability is spent.
A neighbour is missed by all tables with probability about ``(1 - SUCCESS) ** TABLES``, 0.06, whatever the
data; what the data decide is how much of the table that takes. Candidates are reranked by their
inner product in double precision on the original vectors.

The distance is each query's own. Buckets are first probed at the typical distance. A query's last answer is then
no nearer than its last neighbour; where it is further away than typical, the query goes on to the buckets that
reach ``SUCCESS`` at that distance. Those cells are star-shaped around the query, so that nearer neighbours are in them with a
higher probability still.

Equal vectors are searched as one, with as many of their smallest ids as an answer can hold, so a hot
vector costs one row. Buckets are cut into blocks of about ``BLOCK`` rows and joined block by block. The
typical neighbour distance comes from a sample of at most ``SAMPLE`` vectors; in a sample neighbours
are further away than in all rows, which errs towards more probes. A table has as many projections as its rows
ask for, but no more than let ``BEAM`` buckets reach ``SUCCESS``. Queries that would have to visit more, and those
that end with fewer neighbours than asked for, are compared with all vectors, in blocks.

Vectors that are NULL, zero, of another length than most, or hold NULL or non-finite components take no part, nor do
rows without an id. Rows that share an id are never neighbours of each other. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.hashing import mixed
from tripmart.llm.shared import globally_ranked, sampled, written
from tripmart.session import setting

TABLES, SUCCESS = 4, 0.5
BUCKETS_FOR = 200
BLOCK = 256
SAMPLE = 2000
WIDTH = 4 / 3
BEAM = 2048
SPARE = 4
PAIRS_PER_BATCH = 64
HELD = 1_000_000


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` and ``vec`` (array of double) of the vectors that take part."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    found = rows.where(F.col(key).isNotNull() & F.coalesce(sound & some, F.lit(False)))
    found = found.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    usual = found.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return found.where(F.size("vec") == (usual["n"] if usual else 0))


def classes(vectors: DataFrame, k: int) -> DataFrame:
    """Distinct vectors: ``class``, ``vec`` and ``ids``, their ``k`` + 1 smallest ids in order.

    Classes are numbered in order of their smallest id. Of classes with one score, the ``k`` + 1 first thus hold the
    ``k`` + 1 smallest ids of all: every class left out starts after as many others.
    """
    marked = vectors.withColumns({"x": F.xxhash64("vec"), "y": F.xxhash64(F.lit(1), "vec")}).dropDuplicates(["x", "y", "id"])
    first = marked.withColumn("n", F.row_number().over(Window.partitionBy("x", "y").orderBy("id"))).where(F.col("n") <= k + 1)
    grouped = first.groupBy("x", "y").agg(
        F.first("vec").alias("vec"), F.sort_array(F.collect_list("id")).alias("ids")
    )
    ranked = globally_ranked(written(grouped), [F.element_at("ids", 1), F.col("x"), F.col("y")], "class")
    return written(ranked.select("class", "vec", "ids"))


def likeliest(place: np.ndarray, width: float) -> np.ndarray | None:
    """The likeliest cells of a neighbour at distance 1 from ``place``, until ``SUCCESS`` is spent; None if ``BEAM`` fall short.

    The likeliest ``BEAM`` cells start with cells that are the likeliest ``BEAM`` of the first coordinates.
    """
    home = np.floor(place).astype(np.int64)
    reach = math.ceil(4 / width)
    offsets = np.arange(-reach, reach + 1)
    chance, cells = np.ones(1), np.zeros((1, 0), np.int64)
    for i in range(len(place)):
        edges = (np.append(offsets, reach + 1) - (place[i] - home[i])) * width
        below = np.array([0.5 * (1 + math.erf(z / math.sqrt(2))) for z in edges])
        chance = (chance[:, None] * np.diff(below)).ravel()
        best = np.argsort(-chance, kind="stable")[:BEAM]
        cells = np.column_stack([cells[best // len(offsets)], home[i] + offsets[best % len(offsets)]])
        chance = chance[best]
        if chance.sum() < SUCCESS:
            return None
    return cells[: int(np.searchsorted(np.cumsum(chance), SUCCESS)) + 1]


def depth_for(n: int) -> int:
    """Projections per table for ``n`` distinct vectors: at most as many as let ``BEAM`` cells reach ``SUCCESS`` wherever a query lies."""
    depth = max(1, round(math.log(max(n / BUCKETS_FOR, 1)) / math.log(4)))
    places = np.random.default_rng(2_005).uniform(size=(50, depth))
    while depth > 1 and any(likeliest(place[:depth], WIDTH) is None for place in places):
        depth -= 1
    return depth


class Projections:
    """The tables' random projections, and the buckets that they give vectors and probes."""

    def __init__(self, dim: int, depth: int, distance: float, largest: float):
        rng = np.random.default_rng(2_004)
        self.width = distance * WIDTH
        self.lines = rng.normal(size=(TABLES, dim + 1, depth))
        self.shifts = rng.uniform(0, self.width, (TABLES, depth))
        self.distance, self.largest, self.depth = distance, largest, depth

    def _cells(self, table: int, x: np.ndarray) -> np.ndarray:
        return (x @ self.lines[table] + self.shifts[table]) / self.width

    def stored(self, table: int, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.largest**2 - (x * x).sum(1), 0))
        return self._code(table, np.floor(self._cells(table, np.column_stack([x, rest]))).astype(np.int64))

    def _code(self, table: int, cells: np.ndarray) -> np.ndarray:
        code = np.full(len(cells), table, np.uint64)
        for i in range(cells.shape[1]):
            code = mixed(code * np.uint64(31) + cells[:, i].astype(np.uint64))
        return code.view(np.int64)

    def probed(self, table: int, x: np.ndarray, distance: float | None = None) -> np.ndarray | None:
        """Codes of the buckets to visit for one query, most promising first; None if ``BEAM`` do not reach ``SUCCESS``.

        Its neighbours are at the typical distance, or at ``distance``.
        """
        scaled = x * (self.largest / math.sqrt(float(x @ x)))
        cells = likeliest(self._cells(table, np.append(scaled, 0.0)[None])[0], self.width / (distance or self.distance))
        return None if cells is None else self._code(table, cells)


def _array(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def fitted(distinct: DataFrame, k: int) -> Projections | None:
    """Projections for the table's size, norms and typical distance of a ``k``-th neighbour."""
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    n, largest = distinct.agg(F.count("*"), F.max(norm)).first()
    if not n:
        return None
    x = np.array([r["vec"] for r in sampled(distinct.select("class", "vec"), ["class"], SAMPLE)])
    unit = x * (largest / np.sqrt((x * x).sum(1)))[:, None]
    products = unit @ x.T
    np.fill_diagonal(products, -np.inf)
    rank = min(max(1, round(k * len(x) / n)), len(x) - 1)
    if rank:
        near = np.partition(products, -rank, axis=1)[:, -rank]
        distance = float(np.median(np.sqrt(np.maximum(2 * largest**2 - 2 * near, 0))))
    else:
        distance = float(largest)
    return Projections(x.shape[1], depth_for(n), max(distance, 1e-6 * float(largest)), float(largest))


def _blocked(rows: DataFrame, members: list[str], out: str) -> DataFrame:
    """Rows of a bucket gathered into blocks of about ``BLOCK``: ``bucket``, ``out``. ``rows`` are read twice from a written table."""
    sizes = written(
        rows.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")).withColumnRenamed("bucket", "_bucket")
    )
    dealt = rows.join(sizes, F.col("bucket") == F.col("_bucket")).withColumn(
        "block", F.pmod(F.xxhash64(members[0]), F.col("blocks"))
    )
    gathered = dealt.groupBy("bucket", "block").agg(F.collect_list(F.struct(*members)).alias(out))
    return written(gathered.drop("block"))


def _merged(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], most: int) -> list[tuple[np.ndarray, ...]]:
    """The ``most`` best classes of each query among the parts, each class once; a list of one part."""
    query, kind, score = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((kind, -score, query))
    query, kind, score = query[order], kind[order], score[order]
    # a class has the same score whichever table found it, so repeats are neighbours
    new = np.concatenate([[True], (query[1:] != query[:-1]) | (kind[1:] != kind[:-1])])[: len(query)]
    query, kind, score = query[new], kind[new], score[new]
    start = np.maximum.accumulate(np.where(np.concatenate([[True], query[1:] != query[:-1]])[: len(query)], np.arange(len(query)), 0))
    keep = np.arange(len(query)) - start < most
    return [(query[keep], kind[keep], score[keep])]


def _nearest(q: np.ndarray, x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of the ``most`` nearest vectors of each query, and of all tied with the last: query, vector and exact score."""
    rough = q @ x.T
    if len(x) > most:
        last = np.partition(rough, len(x) - most, axis=1)[:, len(x) - most]
        # a product of the matrix may differ in its last digits from one by itself
        slack = 1e-12 * np.sqrt((q * q).sum(1) * (x * x).sum(1).max())
        asking, at = np.nonzero(rough >= (last - slack)[:, None])
    else:
        asking, at = (i.ravel() for i in np.indices(rough.shape))
    parts = [(q[asking[i : i + 8192]] * x[at[i : i + 8192]]).sum(-1) for i in range(0, len(at), 8192)]
    return asking, at, np.concatenate(parts) if parts else np.zeros(0)


def _best(pairs: DataFrame, k: int) -> DataFrame:
    """``query``, ``class``, ``score``: the best of all block pairs (``asked``, ``stored``).

    A task merges what its pairs find for a query and sends that query's best as one row, so what
    it sends grows with its queries, not with the buckets they visit. A second step merges a
    query's rows. Both hold at most about ``HELD`` candidates.
    """
    most = k + 1 + SPARE

    def compact(found: list, held: int) -> tuple[list, int]:
        found = _merged(found, most)
        return found, len(found[0][0])

    def packed(part: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        query, kind, score = part
        first = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])[: len(query)])
        offsets = pa.array(np.append(first, len(query)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(c)) for c in (kind.astype(np.int64), score.astype(np.float64))]
        return pa.RecordBatch.from_arrays([pa.array(query[first].astype(np.int64)), *lists], ["query", "classes", "scores"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for batch in batches:
            for asked, stored in zip(batch.column(0), batch.column(1), strict=True):
                asked, stored = asked.values, stored.values
                q, x = _array(asked.field("vec")), _array(stored.field("vec"))
                own, kinds = np.asarray(asked.field("query")), np.asarray(stored.field("class"))
                asking, at, exact = _nearest(q, x, most)
                found.append((own[asking], kinds[at], exact))
                held += len(at)
            if held > HELD:
                found, held = compact(found, held)
                if held > HELD // 2:
                    yield packed(found[0])
                    found, held = [], 0
        if found:
            yield packed(compact(found, held)[0][0])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for batch in batches:
            sizes = np.diff(np.asarray(batch.column(1).offsets))
            kinds, scores = (np.asarray(batch.column(i).flatten()) for i in (1, 2))
            found.append((np.repeat(np.asarray(batch.column(0)), sizes), kinds, scores))
            held += len(kinds)
            if held > HELD:  # the queries of a task and their best stay
                found, held = compact(found, held)
        if found:
            query, kind, score = compact(found, held)[0][0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(query.astype(np.int64)), pa.array(kind.astype(np.int64)), pa.array(score)], ["query", "class", "score"]
            )

    spark = pairs.sparkSession
    with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(PAIRS_PER_BATCH)):
        lists = written(
            pairs.select("asked", "stored").mapInArrow(compare, "query long, classes array<long>, scores array<double>")
        )
    return written(lists.repartition("query").mapInArrow(merge, "query long, class long, score double"))


def _answers(found: DataFrame, distinct: DataFrame, k: int) -> DataFrame:
    """Ranked rows per query from scored classes; a class may be scored several times."""
    ahead = Window.partitionBy("query").orderBy(F.desc("score"), "class")
    # the class of the query itself may be left without other rows, so one class more
    top = found.withColumn("n", F.dense_rank().over(ahead)).where(F.col("n") <= k + 1)
    few = top.select("query", F.col("class").alias("_class"), "score").distinct()
    rows = few.join(distinct.select("class", "ids"), F.col("_class") == F.col("class")).select(
        "query", "score", F.explode("ids").alias("id")
    )
    final = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return (
        rows.where(F.col("id") != F.col("query"))
        .withColumn("rank", F.row_number().over(final))
        .where(F.col("rank") <= k)
        .select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")
    )


def search(rows: DataFrame, queries: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the ``k`` nearest rows of each query, by id a row too."""
    spark = rows.sparkSession
    distinct = classes(usable(rows, key, vector), k)
    asked = written(usable(queries, key, vector).dropDuplicates(["id"]))
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    projections, wanted = fitted(distinct, k), asked.count()
    if projections is None or not wanted:
        return empty
    dim = projections.lines.shape[1] - 1

    def stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _array(batch.column(1))
            for table in range(TABLES if len(x) else 0):
                codes = projections.stored(table, x)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(codes), pa.array(np.full(len(x), table, np.int32))],
                    ["class", "vec", "bucket", "table"],
                )

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, owner, codes = _array(batch.column(1)), [], []
            reach = batch.column(2).to_pylist() if batch.num_columns > 2 else [None] * len(x)
            for i in range(len(x)):
                found = [projections.probed(table, x[i], reach[i]) for table in range(TABLES)]
                if any(f is None for f in found):  # falls short: one row without a bucket
                    owner.append(np.array([i]))
                    codes.append(pa.nulls(1, pa.int64()))
                    continue
                for table, new in enumerate(found):
                    before = None if reach[i] is None else projections.probed(table, x[i])
                    if before is not None:
                        new = new[~np.isin(new, before)]
                    owner.append(np.full(len(new), i))
                    codes.append(pa.array(new))
            if owner:
                at = pa.array(np.concatenate(owner))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.concat_arrays(codes)], ["query", "vec", "bucket"]
                )

    def visited(queries: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
        """Scored classes from the buckets of the queries, and the queries that fall short."""
        spread = queries.repartition(math.ceil(n / BLOCK), "query")
        probes = written(spread.mapInArrow(probed, "query long, vec array<double>, bucket long"))
        found = _best(blocks.join(_blocked(probes.where("bucket IS NOT NULL"), ["query", "vec"], "asked"), "bucket"), k)
        return found, probes.where("bucket IS NULL").select(F.col("query").alias("_query"))

    same_length = asked.where(F.size("vec") == dim).select(F.col("id").alias("query"), "vec")
    index = distinct.select("class", "vec").mapInArrow(stored, "class long, vec array<double>, bucket long, table int")
    blocks = _blocked(written(index.drop("table")), ["class", "vec"], "stored")
    found, _ = visited(same_length, wanted)
    answers = written(_answers(found, distinct, k))
    # a query's k-th answer is no nearer than its k-th neighbour: where it is beyond the typical distance, probe on
    ids = distinct.agg(F.sum(F.size("ids"))).first()[0]
    last = answers.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("last")).where(F.col("n") >= min(k, ids - 1))
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    square = 2 * projections.largest**2 - 2 * projections.largest * F.col("last") / norm
    reached = written(
        same_length.join(last, F.col("query") == F.col("query_id")).select("query", "vec", F.sqrt(F.greatest(square, F.lit(0.0))).alias("reach"))
    )
    short = same_length.join(reached.select(F.col("query").alias("_query")), F.col("query") == F.col("_query"), "left_anti")
    further = reached.where(F.col("reach") > projections.distance * (1 + 1e-9))
    n = further.count()
    if n:
        more, beyond = visited(further, n)
        both = found.join(further.select(F.col("query").alias("_query")), F.col("query") == F.col("_query"), "left_semi").union(more)
        settled = answers.join(further, F.col("query_id") == F.col("query"), "left_anti")
        answers = written(settled.union(_answers(both, distinct, k).select(settled.columns)))
        short = short.union(further.select("query", "vec").join(beyond, F.col("query") == F.col("_query"), "left_semi"))
    # queries with too few answers, though there are more vectors, or without enough buckets
    short = written(short)
    if short.isEmpty():
        return answers
    every = _blocked(
        written(distinct.select("class", "vec", F.pmod(F.xxhash64("class"), F.lit(64)).alias("bucket"))), ["class", "vec"], "stored"
    )
    asking = short.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(63)).cast("array<long>")))
    whole = _best(every.join(_blocked(written(asking), ["query", "vec"], "asked"), "bucket"), k)
    rest = answers.join(short, F.col("query_id") == F.col("query"), "left_anti")
    return rest.union(_answers(whole, distinct, k).select(rest.columns))
