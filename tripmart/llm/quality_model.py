"""Quality classifier: regularised quadratic discriminant over transformed statistics of the text.

Each document becomes a vector of square-root and logarithmic shares (character classes, word and
line shapes). Spark sums count, mean and scatter per class over all labelled rows; the driver
shrinks both covariances, factors them once (Cholesky) and every task scores its rows by the
difference of the classes' log densities.

A NULL text is an empty one; it gets a score like any other. Labels that are NULL or no 0/1 are not
learnt from; a document with several labels counts once for each. A class with fewer than two rows
makes the classes' share the score of all (0.5 without any label). Repeated rows score alike, an
empty table gives no rows, all columns stay (``score`` is replaced).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.shared import small, written

#: One byte each; their rates per word are features.
MARKS = b"#$%&*|!?.,<>"
SHRINKAGE = 0.1
TEMPERATURE = 1.0
FEATURES = len(MARKS) + 12


def features(text: str | None) -> np.ndarray:
    """The vector of one text; none of its entries depends on the text's length alone but the first."""
    raw = (text or "").encode()
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256).astype(float)
    tokens = raw.split()
    n, size = len(tokens), max(len(raw), 1)
    per_word = 1.0 / max(n, 1)
    lengths = np.fromiter(map(len, tokens), float, n) if n else np.zeros(1)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    upper, lower = count[65:91].sum(), count[97:123].sum()
    kinds, pairs = len(set(tokens)), len(set(zip(tokens, tokens[1:], strict=False)))
    return np.array(
        [
            np.log1p(n),
            np.log1p(lengths.mean()),
            np.log1p(lengths.std()),
            np.sqrt(upper / max(upper + lower, 1)),
            np.sqrt(count[48:58].sum() / size),
            np.sqrt(count[128:].sum() / size),
            np.sqrt(count[33:48].sum() / size),
            np.sqrt(1 - len(set(lines)) / max(len(lines), 1)),
            np.sqrt(max(0.0, 1 - pairs / max(n - 1, 1))),
            np.sqrt(kinds * per_word),
            np.log1p(n / max(len(lines), 1)),
            np.sqrt(sum(t[:1].isupper() for t in tokens) * per_word),
            *np.sqrt(count[list(MARKS)] * per_word),
        ]
    )


def featured(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and ``_features`` (array of double) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found = [features(t) for t in batch.column(batch.schema.get_field_index(own)).to_pylist()]
            flat = np.concatenate(found) if found else np.zeros(0)
            vectors = pa.ListArray.from_arrays(np.arange(len(found) + 1, dtype=np.int32) * FEATURES, pa.array(flat))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], vectors], [*keep, "_features"])

    # a kept text is sent once
    own = text if text in keep else "_text"
    chosen = docs.select(*keep, *[F.col(text).alias("_text")] * (own == "_text"))
    schema = T.StructType([*chosen.schema.fields[: len(keep)], T.StructField("_features", T.ArrayType(T.DoubleType()))])
    return chosen.mapInArrow(run, schema)


@dataclass(frozen=True)
class Model:
    """Log prior odds, and per class mean, lower Cholesky factor and log determinant."""

    prior: float
    means: tuple[np.ndarray, np.ndarray] | None = None
    factors: tuple[np.ndarray, np.ndarray] | None = None
    logdets: tuple[float, float] | None = None
    temperature: float = TEMPERATURE

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), 1 / (1 + np.exp(-self.prior)))
        logs = []
        for mean, factor, logdet in zip(self.means, self.factors, self.logdets, strict=True):
            z = np.linalg.solve(factor, (x - mean).T)
            logs.append(-0.5 * ((z * z).sum(0) + logdet))
        odds = self.prior + (logs[1] - logs[0]) / self.temperature
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit(vectors: DataFrame, label: str, shrinkage: float = SHRINKAGE, temperature: float = TEMPERATURE) -> Model:
    """Fit on ``_features`` of all rows whose label is 0 or 1; only sums reach the driver."""
    width = FEATURES

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + width + width * width))
        for batch in batches:
            flat = batch.column("_features").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            y = batch.column("_label").to_numpy(zero_copy_only=False)
            for c in (0, 1):
                x = flat[y == c]
                total[c] += np.concatenate([[len(x)], x.sum(0), (x.T @ x).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([0, 1]), pa.array(total.tolist())], ["c", "sums"])

    rows = vectors.where(F.col(label).isin(0, 1)).select(F.col(label).cast("int").alias("_label"), "_features")
    parts = rows.mapInArrow(sums, "c long, sums array<double>")
    added = (
        parts.select("c", F.posexplode("sums").alias("at", "value")).groupBy("c", "at").agg(F.sum("value").alias("value"))
    )
    total = np.zeros((2, 1 + width + width * width))
    for row in added.collect():  # 2 x (1 + width + width squared) numbers, whatever the input
        total[row["c"], row["at"]] = row["value"]
    counts = total[:, 0]
    prior = float(np.log((counts[1] + 1) / (counts[0] + 1)))
    if counts.min() < 2:
        return Model(prior)
    means = total[:, 1 : 1 + width] / counts[:, None]
    covs = [
        total[c, 1 + width :].reshape(width, width) / counts[c] - np.outer(means[c], means[c]) for c in (0, 1)
    ]
    pooled = (counts[0] * covs[0] + counts[1] * covs[1]) / counts.sum()
    floor = np.diag(np.maximum(np.diag(pooled), 1e-4))
    factors = []
    for c in (0, 1):
        shrunk = (1 - shrinkage) * covs[c] + shrinkage * floor
        factors.append(np.linalg.cholesky((shrunk + shrunk.T) / 2 + 1e-9 * np.eye(width)))
    logdets = tuple(float(2 * np.log(np.diag(f)).sum()) for f in factors)
    return Model(prior, (means[0], means[1]), (factors[0], factors[1]), logdets, temperature)


def scored(vectors: DataFrame, model: Model) -> DataFrame:
    """Replace ``_features`` by ``score``, the probability of label 1."""
    kept = [c for c in vectors.columns if c != "_features"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("_features")
            x = batch.column(at).flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES)
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(model.scores(x))], [*kept, "score"])

    schema = T.StructType([*vectors.drop("_features").schema.fields, T.StructField("score", T.DoubleType())])
    return vectors.mapInArrow(run, schema)


def held_out(key: str = "doc_id"):
    """One key in five, by the CRC-32 of its decimal text; a NULL key is like the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns but ``score`` by default), ``held_out`` and ``score`` of every document.

    The model learns from ``labels`` (``doc_id``, ``quality``) of documents that are not held out.
    """
    keep = [c for c in keep or docs.columns if c not in ("score", "held_out")]
    vectors = written(featured(docs, ["doc_id"], text))
    marked = labels.select(F.col("doc_id").alias("_of"), F.col("quality").alias("_quality")).where(~held_out("_of"))
    model = fit(vectors.join(marked, F.col("doc_id") == F.col("_of")).select("_features", "_quality"), "_quality")
    source = vectors if keep == ["doc_id"] else featured(docs, keep, text)
    return scored(source, model).withColumn("held_out", held_out())
