"""Mixing sources to target weights by entropy balancing.

Each source has a target of tokens. Its documents get the rates closest in relative entropy to
"take each once" under the source's token constraint and a cap per document: rates are
``min(cap, exp(tilt * size / mean size))``, one tilt per source. The tilts solve the convex dual
by Newton steps whose sums Spark takes over a histogram of sizes; steps that leave the bracket of
the root are halved back into it. Rates are then rounded into whole copies, each bucket of
documents passing its rounding error on from its longest document to its shortest.

A NULL text has size 0 and is never taken more than once; NULL is a source of its own, the last.
Repeated rows are taken row by row. An empty table gives an empty mix. The number of sources is
a configuration: one weight each is kept on the driver.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.shared import words, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
STEPS = 60
ROWS_PER_BUCKET = 1024


def targets(sizes: dict[str | None, int], weights: tuple[int, ...], share: float, cap: float) -> dict[str | None, float]:
    """Split ``share`` of all tokens by weight; what is above ``cap`` times a source goes to the rest by weight.

    Weights repeat over the sources in code point order, NULL last.
    """
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), list(order), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * unit > cap * sizes[s]]
        if not full:
            return out | {s: weight[s] * unit for s in open_}
        for s in full:
            out[s] = float(cap * sizes[s])
        left -= sum(out[s] for s in full)
        open_ = [s for s in open_ if s not in full]
    return out


def _lookup(values: dict[str | None, float], source: Column) -> Column:
    named = {s: v for s, v in values.items() if s is not None}
    pairs = [F.lit(x) for pair in named.items() for x in pair]
    found = F.element_at(F.create_map(*pairs), source) if pairs else F.lit(None).cast("double")
    return F.when(source.isNull(), F.lit(values.get(None))).otherwise(found)


def _exact(value: Column) -> Column:
    """Summed in any order to the same number, so that reruns take the same steps."""
    return value.cast("decimal(28,6)")


def solve(histogram: DataFrame, sizes: dict, counts: dict, goal: dict, cap: float) -> dict[str | None, float]:
    """The tilt of each source; ``histogram`` has ``source``, ``size``, ``rows``.

    ``inf`` (every document at the cap) where the target is all there is, ``-inf`` where it is 0.
    """
    mean = {s: max(sizes[s] / counts[s], 1e-9) for s in sizes}
    tilt = {s: 0.0 for s in sizes}
    for s in sizes:
        if goal[s] >= cap * sizes[s] * (1 - 1e-12):
            tilt[s] = math.inf
        elif goal[s] <= 0:
            tilt[s] = -math.inf
    low, high = {s: -1e4 for s in sizes}, {s: 1e4 for s in sizes}
    open_ = {s for s in sizes if math.isfinite(tilt[s])}
    for _ in range(STEPS):
        if not open_:
            break
        feature = F.col("size") / _lookup(mean, F.col("source"))
        raw = F.exp(F.least(feature * _lookup({s: tilt[s] for s in open_}, F.col("source")), F.lit(50.0)))
        tokens = F.col("rows") * F.col("size")
        sums = (
            histogram.where(_lookup({s: 1.0 for s in open_}, F.col("source")).isNotNull())
            .groupBy("source")
            .agg(
                F.sum(_exact(tokens * F.least(raw, F.lit(float(cap))))).cast("double").alias("mass"),
                F.sum(_exact(F.when(raw < cap, tokens * raw * feature).otherwise(0.0))).cast("double").alias("slope"),
            )
            .collect()
        )
        for row in sums:
            s, gap = row["source"], row["mass"] - goal[row["source"]]
            if abs(gap) <= 1e-6 * goal[s]:
                open_.discard(s)
                continue
            if gap > 0:
                high[s] = min(high[s], tilt[s])
            else:
                low[s] = max(low[s], tilt[s])
            step = tilt[s] - gap / row["slope"] if row["slope"] > 0 else math.inf
            bounded = low[s] > -1e4 and high[s] < 1e4
            if not low[s] < step < high[s]:
                step = (low[s] + high[s]) / 2 if bounded else (2 * abs(tilt[s]) + 1) * (-1 if gap > 0 else 1)
            if abs(step - tilt[s]) <= 1e-13 * max(1.0, abs(step)) or high[s] - low[s] < 1e-12:
                open_.discard(s)
            tilt[s] = step
    return tilt


def _rounded(cap: int, names: list[str]):
    def diffuse(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "_tie", "_key"], ascending=[False, True, True], kind="stable")
        carry, copies = 0.0, []
        for size, rate in zip(rows["size"].tolist(), rows["rate"].tolist(), strict=True):
            if size == 0:
                copies.append(1 if rate > 0 else 0)
                continue
            wanted = carry + rate * size
            n = min(cap, max(0, math.floor(wanted / size + 0.5)))
            carry = wanted - n * size
            copies.append(n)
        return rows.assign(copies=copies)[names]

    return diffuse


def _mixed(
    docs: DataFrame, key: str, weights: tuple[int, ...], share: float, cap: int, carry: tuple[str, ...] = ()
) -> DataFrame:
    """The columns of ``mix``, and those named in ``carry`` behind ``_with_``."""
    sized = docs.select(
        F.col(key).alias("_key"),
        F.col("source").cast("string").alias("source"),
        F.size(words(F.col("text"))).cast("long").alias("size"),
        F.xxhash64(key, "text").alias("_tie"),
        *[F.col(c).alias(f"_with_{c}") for c in carry],
    )
    if not carry:
        sized = written(sized)
    histogram = written(sized.groupBy("source", "size").agg(F.count("*").alias("rows")))
    per_source = (
        histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("size"), F.sum("rows").alias("rows"))
    ).collect()
    sizes = {r["source"]: r["size"] for r in per_source}
    counts = {r["source"]: r["rows"] for r in per_source}
    goal = targets(sizes, weights, share, cap)
    tilt = solve(histogram, sizes, counts, goal, cap)
    source = F.col("source")
    mean = {s: max(sizes[s] / counts[s], 1e-9) for s in sizes}
    steep = _lookup({s: max(min(t, 1e300), -1e300) for s, t in tilt.items()}, source)
    exponent = F.least(F.col("size") / _lookup(mean, source) * steep, F.lit(50.0))
    rate = F.when(F.col("size") == 0, F.lit(1.0)).otherwise(F.least(F.exp(exponent), F.lit(float(cap))))
    buckets = F.greatest(_lookup({s: float(math.ceil(n / ROWS_PER_BUCKET)) for s, n in counts.items()}, source), F.lit(1.0))
    dealt = sized.withColumn("rate", rate).withColumn("_bucket", F.pmod(F.col("_tie"), buckets.cast("long")))
    names = ["_key", "source", "size", "rate", "copies", *[f"_with_{c}" for c in carry]]
    kinds = dict(dealt.dtypes) | {"copies": "long"}
    rounded = dealt.groupBy("source", "_bucket").applyInPandas(
        _rounded(cap, names), ", ".join(f"`{n}` {kinds[n]}" for n in names)
    )
    return rounded.select(
        F.col("_key").alias(key),
        "source",
        "size",
        _lookup({s: float(n) for s, n in sizes.items()}, source).cast("long").alias("source_size"),
        _lookup(goal, source).alias("target"),
        "rate",
        "copies",
        *[f"_with_{c}" for c in carry],
    )


def mix(
    docs: DataFrame, key: str = "doc_id", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP
) -> DataFrame:
    """Return ``key``, ``source``, ``size``, ``source_size``, ``target``, ``rate`` and ``copies``, a row per document."""
    return _mixed(docs, key, weights, share, cap)


def repeated(
    docs: DataFrame, key: str = "doc_id", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP
) -> DataFrame:
    """The mix itself: the rows and columns of ``docs``, each row as often as its copies say."""
    mixed = _mixed(docs, key, weights, share, cap, tuple(docs.columns))
    copies = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy")
    rows = mixed.where("copies > 0").select(*[f"_with_{c}" for c in docs.columns], copies)
    return rows.select(*[F.col(f"_with_{c}").alias(c) for c in docs.columns])
