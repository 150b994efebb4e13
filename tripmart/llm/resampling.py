"""Importance resampling towards a target corpus, with hashed n-grams by prefix checksums.

A text is normalised once: its words, joined by single separators, as bytes. One scan keeps the running CRC-32 at the
end of every word. As a CRC is linear over GF(2), the CRC of any run of words follows from two of these prefixes:
the first, shifted by the length of the run (a multiplication by a power of x, one table look-up per byte of the
number and bit of the length), cancels out of the second. So n-grams of all lengths cost no second look at the text.

A document's n-grams fall into ``buckets`` by their CRC. The counts of all documents and of the target give every
bucket a gain, a document's weight is the mean gain of its n-grams, and Gumbel noise seeded by the id turns the
weights into a sample without replacement: the documents with the highest scores. Documents are scanned once and their
buckets stored; only counts per bucket (a parameter, not the data, bounds them) reach the driver. Scores are
ranked by a range partitioning and the sizes of its parts.

NULL and empty texts have no features and weight 0. A NULL id is hashed as an empty one and comes last among ties. Rows that
share id and score are ranked in any order. Without target texts or documents the counts are zero. Output columns
are fixed, so other columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.shared import globally_ranked, small, written

#: Fixed value: the CRC-32 polynomial, bits in reverse.
POLYNOMIAL = 0xEDB88320
NOISE = 4294967296


@dataclass(frozen=True)
class Settings:
    least_words: int = 1
    most_words: int = 1
    buckets: int = 10_000
    seed: int = 2024
    least_eligible: int = 20
    percent: int = 10


def _normal_bytes() -> bytes:
    """For every byte its lower case if it is part of a word (digits, letters, anything outside ASCII), else a space."""
    kept = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
    table = bytearray(b" " * 256)
    for b in kept:
        table[b] = b
    for b in range(0x41, 0x5B):
        table[b] = b + 32
    return bytes(table)


NORMAL = _normal_bytes()


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(NORMAL).split()


def _zero_byte_table() -> np.ndarray:
    """What a zero byte makes of each low byte of a CRC."""
    values = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        values = np.where(values & 1, (values >> 1) ^ np.uint32(POLYNOMIAL), values >> 1).astype(np.uint32)
    return values


class Shift:
    """Multiplies CRCs by x^8 to the power of a length: what follows when so many bytes come after."""

    def __init__(self):
        low = _zero_byte_table()
        bytes_ = np.arange(256, dtype=np.uint32)
        one = [(v >> np.uint32(8)) ^ low[v & 255] for v in (bytes_ << np.uint32(8 * k) for k in range(4))]
        self.tables = [one]

    def _through(self, tables: list[np.ndarray], crc: np.ndarray) -> np.ndarray:
        out = tables[0][crc & 255]
        for k in (1, 2, 3):
            out = out ^ tables[k][(crc >> np.uint32(8 * k)) & 255]
        return out

    def __call__(self, crc: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Squaring a table doubles its length, so a table per bit of the longest length will do."""
        out, bit = crc.copy(), 0
        most = int(length.max(initial=0))
        while most >> bit:
            if len(self.tables) <= bit:
                last = self.tables[-1]
                self.tables.append([self._through(last, t) for t in last])
            moved = (length >> bit) & 1 == 1
            out[moved] = self._through(self.tables[bit], out[moved])
            bit += 1
        return out


class Prefixes:
    """Running CRCs of normalised texts, one after the other, and the CRC of any run of words."""

    def __init__(self, texts: list[list[bytes]], shift: Shift):
        self.shift = shift
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        n = int(sizes.sum())
        lengths = np.fromiter((len(w) for words in texts for w in words), np.int64, n)
        # the scan
        self.end = np.fromiter((crc for words in texts for crc in _running(words)), np.uint32, n)
        first = np.zeros(n, bool)
        first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
        # the prefix before a word is the end of the word before and a separator; before the first word it is empty
        space = np.uint32(zlib.crc32(b" "))
        before = np.concatenate((np.zeros(min(n, 1), np.uint32), self.end[:-1]))
        self.start = np.where(first, 0, self.shift(before, np.ones(n, np.int64)) ^ space).astype(np.uint32)
        reach = lengths + ~first
        self.place = np.cumsum(reach)  # where words end, across all texts
        self.lengths, self.sizes = lengths, sizes
        self.left = np.repeat(np.cumsum(sizes), sizes) - np.arange(n)  # words from here to the end of the text

    def grams(self, words: int) -> tuple[np.ndarray, np.ndarray]:
        """The CRC of every run of so many words and the number of its text, in order."""
        at = np.flatnonzero(self.left >= words)
        last = at + words - 1
        length = self.place[last] - self.place[at] + self.lengths[at]
        return self.end[last] ^ self.shift(self.start[at], length), np.repeat(np.arange(len(self.sizes)), self.sizes)[at]


def _running(words: list[bytes]) -> Iterator[int]:
    """The CRC of the text up to the end of every word; a word after the first brings its separator along."""
    pieces = chain(words[:1], (b" " + w for w in words[1:]))
    return islice(accumulate(pieces, lambda crc, piece: zlib.crc32(piece, crc), initial=0), 1, None)


def features(docs: DataFrame, key: str, text: str, settings: Settings) -> DataFrame:
    """``_key``, ``n_words``, ``n_features`` and ``buckets`` (little-endian 32-bit numbers, one per n-gram)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = Shift()
        for batch in small(batches):
            found = Prefixes([words_of(t or "") for t in batch.column(1).to_pylist()], shift)
            crcs, owners = zip(
                *(found.grams(n) for n in range(settings.least_words, settings.most_words + 1)), strict=True
            )
            crcs, owners = np.concatenate(crcs), np.concatenate(owners)
            if settings.most_words > settings.least_words:
                crcs = crcs[np.argsort(owners, kind="stable")]
            counts = np.bincount(owners, minlength=batch.num_rows)
            raw = (crcs % np.uint32(settings.buckets)).astype("<u4")
            ends = np.concatenate(([0], np.cumsum(counts))) * 4
            stored = pa.Array.from_buffers(
                pa.large_binary(), batch.num_rows, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(raw)]
            )
            columns = [batch.column(0), pa.array(found.sizes), pa.array(counts, pa.int64()), stored.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["_key", "n_words", "n_features", "buckets"])

    kind = docs.schema[key].dataType.simpleString() if key in docs.columns else "long"
    chosen = docs.select(F.col(key).alias("_key"), F.col(text))
    return chosen.mapInArrow(run, f"_key {kind}, n_words long, n_features long, buckets binary")


def bucket_counts(stored: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs: one row per bucket and task meets in the shuffle, one per bucket the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                total += np.bincount(np.frombuffer(value.as_buffer(), "<u4"), minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(total[there])], ["bucket", "n"])

    summed = stored.select("buckets").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in summed.collect():
        out[row.bucket] = row.n
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole thousandths of the logarithm of how much likelier a bucket is in the target; one is added to every count."""
    n = len(documents)
    ratio = (target + 1.0) * (float(documents.sum()) + n) / ((documents + 1.0) * (float(target.sum()) + n))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighted(stored: DataFrame, gain: np.ndarray) -> DataFrame:
    """The features' rows with ``weight``, the floored mean gain, instead of their buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [int(gain[np.frombuffer(value.as_buffer(), "<u4")].sum()) for value in batch.column(3)]
            counts = batch.column(2).to_pylist()
            weight = [s // n if n else 0 for s, n in zip(sums, counts, strict=True)]
            columns = [*batch.columns[:3], pa.array(weight, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["_key", "n_words", "n_features", "weight"])

    kind = stored.schema["_key"].dataType.simpleString()
    return stored.mapInArrow(run, f"_key {kind}, n_words long, n_features long, weight long")


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings | None = None
) -> DataFrame:
    """``key``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` (from 1; NULL if not drawn) of every row."""
    settings = settings or Settings()
    stored = written(features(docs, key, text, settings))
    wanted = features(target.select(F.lit(None).cast("long").alias("_none"), F.col(text)), "_none", text, settings)
    gain = gains(bucket_counts(stored, settings.buckets), bucket_counts(wanted, settings.buckets))
    digits = F.sha2(F.concat(F.lit(f"{settings.seed}:"), F.coalesce(F.col("_key").cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digits, 1, 8), 16, 10).cast("double") + 0.5) / float(NOISE)
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log(uniform)))
    scored = written(weighted(stored, gain).withColumn("score", F.col("weight") + noise))

    eligible = scored.where(F.col("n_words") >= settings.least_eligible)
    drawn = settings.percent * eligible.count() // 100
    ranked = globally_ranked(eligible, [F.desc("score"), F.asc_nulls_last("_key")], "_place")
    rank = F.when(F.col("_place") < drawn, F.col("_place") + 1).alias("rank")
    columns = [F.col("_key").alias(key), "n_words", "n_features", "weight", "score"]
    rest = scored.where(F.col("n_words") < settings.least_eligible).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, rank).union(rest)
