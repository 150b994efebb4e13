"""Packing documents into sequences by best-two-fit.

Tasks tokenize whole texts and cut what is longer than a sequence into pieces. Only the number of
pieces of each length (at most one count per token of a sequence) reaches the driver, which plans
bins over lengths: a bin takes the longest pieces that fit, then swaps its shortest piece for the
two unpacked ones that fill the widened gap best. A plan of the same bin is repeated as
often as the counts allow, so planning takes time by lengths, not by documents. Pieces
of a length are then numbered without gaps and look up their bin and place.

A NULL text is an empty one: its piece is the end token alone. Repeated rows are packed row by
row. An empty table gives no rows. Output columns are fixed, so other columns cannot clash.
"""

from __future__ import annotations

import bisect
import json
import sys
import types
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.shared import gapless, release, small, written

LENGTH = 1024
END = 2
ENCODER = "byte_bpe_50k.json"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(ENCODER)


def _byte_of() -> dict[str, int]:
    """Printable Latin-1 characters stand for their own byte, those from U+0100 on for the rest in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Token ids as the tokenizers library gives them, without special tokens added.

    Byte-level vocabularies merge in the order of their ids, so plain text goes through tiktoken over
    the same vocabulary, which is several times faster. Texts that spell one of the vocabulary's
    added tokens go through the tokenizers library.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        model = json.load(open(path, encoding="utf-8"))
        added = {t["content"] for t in model["added_tokens"]}
        byte = _byte_of()
        ranks = {bytes(byte[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in added}
        self.added = tuple(added)
        self.whole = Tokenizer.from_file(path)
        self.fast = tiktoken.Encoding(
            "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def __call__(self, text: str) -> np.ndarray:
        if any(t in text for t in self.added):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4")


def encoder(path: str) -> Encoder:
    """One per worker process and path: loading takes longer than many a task."""
    cache = sys.modules.setdefault("tripmart_encoders", types.ModuleType("tripmart_encoders")).__dict__
    if path not in cache:
        cache[path] = Encoder(path)
    return cache[path]


def pieces(docs: DataFrame, key: str, text: str, length: int, end: int, tokenizer: str, with_ids: bool) -> DataFrame:
    """``_key``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, on demand, ``ids`` of every piece."""
    names = ["_key", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in small(batches):
            owner, out = [], []
            for i, body in enumerate(batch.column(1).to_pylist()):
                ids = np.append(encode(body or ""), np.uint32(end))
                cuts = [0, *range(len(ids) % length or length, len(ids) + 1, length)] if len(ids) > length else [0, len(ids)]
                for n, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    raw = ids[a:b].astype("<u4").tobytes()
                    owner.append(i)
                    out.append((n, a, b - a, zlib.crc32(raw), *[ids[a:b].astype(np.int32)] * with_ids))
            columns = list(zip(*out, strict=True)) if out else [[] for _ in names[1:]]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner, pa.int64())), *arrays], names)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"_key {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col(key).alias("_key"), F.col(text)).mapInArrow(run, schema)


def plan(counts: dict[int, int], room: int) -> list[tuple[list[int], int]]:
    """Bins as (lengths, how many such bins); every piece is in exactly one."""
    left = {size: n for size, n in counts.items() if n}
    sizes = sorted(left)
    bins = []
    while sizes:
        gap, picked = room, Counter()
        contents: list[int] = []
        at = len(sizes) - 1
        while True:
            at = min(at, bisect.bisect_right(sizes, gap) - 1)
            while at >= 0 and left[sizes[at]] == picked[sizes[at]]:
                at -= 1
            if at < 0:
                break
            contents.append(sizes[at])
            picked[sizes[at]] += 1
            gap -= sizes[at]
        greedy = Counter(picked)
        if gap and len(contents) > 1:
            small = contents[-1]
            two = _pair(sizes, left, picked, small, gap + small)
            if two:
                contents[-1:] = two
                picked[small] -= 1
                picked.update(two)
        times = min(left[s] // n for s, n in picked.items() if n)
        for s, n in greedy.items():  # the greedy step must find its pieces every time
            if picked[s] < n:
                times = min(times, (left[s] - n) // picked[s] + 1 if picked[s] else times)
        bins.append((contents, times))
        for s, n in picked.items():
            if n:
                left[s] -= n * times
                if not left[s]:
                    sizes.pop(bisect.bisect_left(sizes, s))
    return bins


def _pair(sizes: list[int], left: dict[int, int], picked: Counter, small: int, gap: int) -> list[int] | None:
    """The two unpacked lengths with the largest sum above ``small`` that the gap holds."""
    best, found = small, None
    low, high = 0, min(len(sizes), bisect.bisect_right(sizes, gap)) - 1
    while low <= high:
        a, b = sizes[low], sizes[high]
        free_a, free_b = left[a] - picked[a], left[b] - picked[b]
        if a + b > gap or free_b <= 0:
            high -= 1
        elif free_a <= 0:
            low += 1
        elif low == high:
            if free_a > 1 and a + b > best:
                best, found = a + b, [b, a]
            break
        else:
            if a + b > best:
                best, found = a + b, [b, a]
            low += 1
    return found


def placed(parts: DataFrame, bins: list[tuple[list[int], int]]) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces numbered by ``rank`` within their length."""
    taken: Counter = Counter()
    slots: dict[int, list[tuple[int, int, int]]] = {}
    base = 0
    for contents, times in bins:
        offset = 0
        for size in contents:
            slots.setdefault(size, []).append((taken[size], base, offset))
            taken[size] += times
            offset += size
        base += times
    lookup = {size: np.array(rows).T for size, rows in slots.items()}
    names = [c for c in parts.columns if c != "rank"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = np.asarray(batch.column(batch.schema.get_field_index("length")))
            rank = np.asarray(batch.column(batch.schema.get_field_index("rank")))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for size in np.unique(length).tolist():
                own = np.flatnonzero(length == size)
                first, start, place = lookup[size]
                at = np.searchsorted(first, rank[own], side="right") - 1
                sequence[own] = start[at] + rank[own] - first[at]
                offset[own] = place[at]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    kinds = dict(parts.dtypes)
    return parts.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in names) + ", sequence_id long, offset long")


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    end: int = END,
    tokenizer: str | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """A row per piece: ``key``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset`` (and ``ids``)."""
    parts = written(pieces(docs, key, text, length, end, tokenizer or default_tokenizer(), with_ids))
    counts = {r["length"]: r["count"] for r in parts.groupBy("length").count().collect()}  # at most `length` rows
    ranked = gapless(parts, ["length"], ["_key", "piece"], "rank")
    release(docs.sparkSession)
    return placed(ranked, plan(counts, length)).withColumnRenamed("_key", key)
