"""Exact removal of repeated passages with suffix arrays over blocks of the corpus.

A byte goes if some ``SPAN``-byte string that covers it also starts earlier: in a smaller id, or in the
same text at a smaller offset. Strings are judged on the input and never cross texts.

1. Every window of ``SPAN`` bytes has an anchor, the leftmost smallest hash among its ``GRAM``-byte
   grams; equal windows have equal anchors at equal places. Windows in a row with one anchor form a
   slice (at most ``RUN`` windows). Only slices whose anchor gram occurs twice can repeat.
2. Equal slices are one class; all but its first are repeats entirely. Repeats within an Arrow batch
   are settled before the shuffle and then travel under keys of their own, so that a hot passage
   sends one row per batch to its anchor's task.
3. First slices of different classes with one anchor may share single windows. Their texts are cut into
   ``BLOCK``-byte symbols counted from the anchor, and a suffix array over all slices of a
   task's next few hundred anchors brings equal strings together: a run of suffixes with
   a common prefix of ``SPAN // BLOCK - 1`` symbols holds every copy of a window. The hash of
   the whole window confirms it. An anchor with more than ``CROWD`` classes does not go through one
   task: its slices are grouped in runs of ``CELL`` windows and then, of runs that differ, window by
   window, each by a 128-bit hash.
4. The repeated windows go back to their texts, which are cut in one pass.

A NULL text is an empty one. Rows that share id and text are one text (neither is earlier);
texts that share an id are in an arbitrary but fixed order. NULL ids come last. Where texts share an id (or have none),
all texts are numbered anew, in order of id and of a 128-bit hash, so none is taken for another. Texts shorter than
``SPAN`` stay as they are. An empty table gives no rows. All columns of the input stay; ``n_bytes``,
``spans`` and ``kept`` replace columns of these names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.hashing import Rolling, chunks, mixed
from tripmart.llm.shared import globally_ranked, release, small, written
from tripmart.llm.suffix_array import suffix_array

SPAN, GRAM, BLOCK = 100, 37, 20
RUN = SPAN - GRAM + 1
SYMBOLS = SPAN // BLOCK - 1
CROWD = 512
CELL = 16
SLICES = 4096
#: Slices of a text longer than this are found in pieces that overlap by a span.
PIECE = 1 << 21
_LAST = 2**63 - 1


def numbered(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The rows with ``_place``, a number that two rows share only if they have the same id and text, in order of id.

    That is the id itself, which counting ids proves. Only if one stands for several texts the distinct pairs of id and
    text hash are ranked; pairs, not rows, so that neither a hot id nor a repeated row is one task's.
    """
    place = F.coalesce(F.col(key).cast("long"), F.lit(_LAST))
    plain = docs.withColumn("_place", place)
    shared = written(plain.groupBy("_place").count().where("count > 1").select(F.col("_place").alias("_shared")))
    if shared.isEmpty():
        return plain
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    hashed = plain.withColumns({"_own": F.md5(body), "_null": F.col(key).isNull()})
    # a real id may be as large as the one that stands for none
    apart = ["_place", "_null", "_own"]
    several = hashed.join(shared, F.col("_place") == F.col("_shared"), "left_semi").select(*apart).distinct()
    if several.groupBy("_place").count().where("count > 1").isEmpty():
        return plain
    pairs = written(hashed.select(*apart).distinct())
    ranks = written(globally_ranked(pairs, [F.col(c) for c in apart], "_rank"))
    named = ranks.select(*[F.col(c).alias(f"{c}_of") for c in apart], "_rank")
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"{c}_of") for c in apart])
    return written(hashed.join(named, same).select(*docs.columns, F.col("_rank").alias("_place")))


def _pack(start: np.ndarray, count: np.ndarray, offset: np.ndarray) -> np.ndarray:
    return start << 12 | (count - 1) << 6 | offset


def _unpack(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return packed >> 12, (packed >> 6 & 63) + 1, packed & 63


def slices(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Per slice: index of the text, start, windows, offset of the anchor, hash of the gram, hash of the slice."""
    lengths = np.array([len(t) for t in texts])
    begins = np.cumsum(lengths) - lengths
    rolling = Rolling(np.frombuffer(b"".join(texts), np.uint8))
    grams = rolling.windows(GRAM)
    least, at, step = grams, np.arange(len(grams), dtype=np.int32), 1
    while step < RUN:
        right = least[step:] < least[:-step]
        least, at, step = np.where(right, least[step:], least[:-step]), np.where(right, at[step:], at[:-step]), 2 * step
    room = np.maximum(lengths - SPAN + 1, 0)
    text = np.repeat(np.arange(len(texts)), room)
    window = np.arange(room.sum()) + np.repeat(begins - (np.cumsum(room) - room), room)
    anchor = at[window]
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])[: len(window)])
    count = np.diff(np.concatenate([new, [len(window)]]))
    start, anchor, text = window[new], anchor[new], text[new]
    whole = rolling.of(start, start + count + SPAN - 1)
    offset = anchor - start
    whole = mixed(whole + (offset * 64 + count).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return text, start - begins[text], count, offset, grams[anchor].view(np.int64), (whole | np.uint64(1)).view(np.int64)


def _pieces(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Texts of bounded length that hold every window once, and for each its text and where it starts there."""
    out, of, at = [], [], []
    for i, text in enumerate(texts):
        for start in range(0, max(len(text) - SPAN + 1, 1), PIECE):
            out.append(text[start : start + PIECE + SPAN - 1])
            of.append(i)
            at.append(start)
    return out, np.array(of), np.array(at)


def anchored(docs: DataFrame, text: str) -> DataFrame:
    """Rows ``gram``, ``slice``, ``doc``, ``packed``; ``slice`` 0 marks a slice that is a repeat for sure."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 2048):
            doc = np.asarray(batch.column(0))
            pieces, of, at = _pieces([(t or "").encode() for t in batch.column(1).to_pylist()])
            found = []
            for part in chunks(pieces):
                own, start, count, offset, gram, whole = slices(pieces[part.start : part.stop])
                own += part.start
                found.append((gram, whole, doc[of[own]], _pack(start + at[own], count, offset)))
            if not found:
                continue
            gram, whole, docs_, packed = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((packed, docs_, whole, gram))
            gram, whole, docs_, packed = gram[order], whole[order], docs_[order], packed[order]
            again = np.concatenate([[False], (gram[1:] == gram[:-1]) & (whole[1:] == whole[:-1])])[: len(gram)]
            twin = again & np.concatenate([[False], (docs_[1:] == docs_[:-1]) & (packed[1:] == packed[:-1])])[: len(gram)]
            # not a repeat of anything earlier than itself: rows of one id and text
            sure = again & ~twin
            sure &= ~_same_as_first(again, docs_, packed)
            gram = np.where(sure, mixed(mixed(docs_.view(np.uint64)) + packed.view(np.uint64)).view(np.int64), gram)
            whole = np.where(sure, 0, whole)
            keep = ~again | sure
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[keep]) for x in (gram, whole, docs_, packed)], ["gram", "slice", "doc", "packed"]
            )

    rows = docs.select("_place", F.col(text).alias("text"))
    return rows.mapInArrow(run, "gram long, slice long, doc long, packed long")


def _same_as_first(again: np.ndarray, doc: np.ndarray, packed: np.ndarray) -> np.ndarray:
    first = np.maximum.accumulate(np.where(again, 0, np.arange(len(again))))
    return (doc == doc[first]) & (packed == packed[first])


def repeated_windows(table: list[tuple[int, int, bytes]]) -> list[int]:
    """For each slice (``doc``, ``packed``, its bytes) a mask of the windows that another slice has earlier."""
    doc = np.array([x[0] for x in table])
    start, count, offset = _unpack(np.array([x[1] for x in table]))
    lengths = count + SPAN - 1
    begins = np.cumsum(lengths) - lengths
    rolling = Rolling(np.frombuffer(b"".join(x[2] for x in table), np.uint8))
    # symbols: blocks counted from the anchor, and one separator after each slice
    head = offset % BLOCK
    blocks = (lengths - head) // BLOCK
    owner = np.repeat(np.arange(len(table)), blocks + 1)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks + 1) - (blocks + 1), blocks + 1)
    begin = np.minimum(begins[owner] + head[owner] + nth * BLOCK, len(rolling.prefix) - 1)
    end = np.minimum(begin + BLOCK, len(rolling.prefix) - 1)
    _, symbols = np.unique(rolling.of(begin, end), return_inverse=True)
    symbols = np.where(nth == blocks[owner], 0, symbols + 1)
    order = suffix_array(symbols)
    # runs of neighbours in the array that agree in their first symbols
    n = len(symbols)
    padded = np.concatenate([symbols, np.zeros(SYMBOLS, np.int64)])
    same = np.ones(max(n - 1, 0), bool)
    for k in range(SYMBOLS):
        same &= padded[order[1:] + k] == padded[order[:-1] + k]
    run = np.empty(n, np.int64)
    run[order] = np.cumsum(np.concatenate([[0], ~same]))
    first_symbol = np.cumsum(blocks + 1) - (blocks + 1)
    own = np.repeat(np.arange(len(table)), count)
    shift = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
    at = first_symbol[own] + (shift - head[own] + BLOCK - 1) // BLOCK
    window = begins[own] + shift
    whole = rolling.of(window, window + SPAN)
    position = start[own] + shift
    rank = np.lexsort((position, doc[own], whole, run[at]))
    r, w, o = run[at][rank], whole[rank], own[rank]
    again = np.concatenate([[False], (r[1:] == r[:-1]) & (w[1:] == w[:-1])])
    first = np.maximum.accumulate(np.where(again, 0, np.arange(len(again))))
    d, p = doc[o], position[rank]
    later = again & ((d != d[first]) | (p != p[first]))
    masks = np.zeros(len(table), np.uint64)
    np.bitwise_or.at(masks, o[later], np.uint64(1) << shift[rank][later].astype(np.uint64))
    return masks.view(np.int64).tolist()


def compared(cut: DataFrame) -> DataFrame:
    """``doc``, ``packed``, ``mask`` of slices with a repeated window; all slices of a gram in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[int, int, bytes]] = []
        grams: list[int] = []

        def settle(until: int) -> pa.RecordBatch:
            table = waiting[:until]
            found = [(d, p, m) for (d, p, _), m in zip(table, repeated_windows(table), strict=True) if m]
            columns = zip(*found, strict=True) if found else ([], [], [])
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["doc", "packed", "mask"])

        for batch in batches:
            grams.extend(batch.column(0).to_pylist())
            waiting.extend(zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True))
            while len(grams) > SLICES:
                until = SLICES
                while until and grams[until] == grams[until - 1]:
                    until -= 1
                if not until:
                    until = next((i for i in range(SLICES, len(grams)) if grams[i] != grams[i - 1]), 0)
                    if not until:
                        break
                yield settle(until)
                del waiting[:until], grams[:until]
        if waiting:
            yield settle(len(waiting))

    ordered = cut.repartition("gram").sortWithinPartitions("gram", "doc", "packed")
    return ordered.select("gram", "doc", "packed", "bytes").mapInArrow(run, "doc long, packed long, mask long")


def texts_of(docs: DataFrame, wanted: DataFrame, value: Column) -> DataFrame:
    """Texts with the ``_list`` of ``value`` of the rows of ``wanted`` that lie in them (``doc``, ``packed``)."""
    lists = written(
        wanted.select("doc", value.alias("v")).groupBy("doc").agg(F.collect_list("v").alias("_list")).withColumnRenamed("doc", "_doc")
    )
    return docs.join(lists, F.col("_place") == F.col("_doc"), "left")


def _lists(column: pa.ListArray, *fields: str) -> tuple[np.ndarray, ...]:
    """For each entry of a column of lists of structs its row, and fields of all entries; a NULL list has none."""
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), 0))
    entries = column.flatten()
    return np.repeat(np.arange(len(column)), lengths), *[np.asarray(entries.field(f)) for f in fields]


def _cut_out(rows: DataFrame) -> DataFrame:
    """``gram``, ``doc``, ``packed`` and the ``bytes`` of every wanted slice; once for rows of one id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            own, gram, packed = _lists(batch.column(2), "gram", "packed")
            start, count, _ = _unpack(packed)
            places = zip(own.tolist(), start.tolist(), (start + count + SPAN - 1).tolist(), strict=True)
            parts = pa.array([texts[i][low:high] for i, low, high in places], pa.binary())
            doc = np.asarray(batch.column(0))[own]
            yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(doc), pa.array(packed), parts], ["gram", "doc", "packed", "bytes"])

    return rows.mapInArrow(run, "gram long, doc long, packed long, bytes binary")


def runs_of(raw: list[bytes], packed: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Slices (their bytes and ``packed``) cut, counted from the anchor, into runs of at most ``length`` windows.

    Of each run the index of its slice, the first window in the slice, the windows, its own ``packed``, and two hashes of
    all its bytes, read forwards and backwards. All slices are hashed as one buffer: a hash does not depend on the place.
    """
    start, count, offset = _unpack(packed)
    head = np.minimum(np.where(offset % length, offset % length, length), count)
    runs = 1 + (count - head + length - 1) // length
    own = np.repeat(np.arange(len(raw)), runs)
    nth = np.arange(len(own)) - np.repeat(np.cumsum(runs) - runs, runs)
    low = np.where(nth, head[own] + (nth - 1) * length, 0)
    windows = np.minimum(head[own] + nth * length, count[own]) - low
    lengths = count + SPAN - 1
    data = np.frombuffer(b"".join(raw), np.uint8)
    begin = (np.cumsum(lengths) - lengths)[own] + low
    end = begin + windows + SPAN - 1
    x, y = Rolling(data).of(begin, end), Rolling(data[::-1]).of(len(data) - end, len(data) - begin)
    return own, low, windows, _pack(start[own] + low, windows, (offset[own] - low) % length), x.view(np.int64), y.view(np.int64)


def _runs(slices: DataFrame, length: int) -> DataFrame:
    """The runs of slices (``doc``, ``packed``, ``bytes``): ``x``, ``y`` (hashes of all bytes) and the run as ``doc``, ``packed``
    and, unless it is a single window, ``bytes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, packed, raw = np.asarray(batch.column(0)), np.asarray(batch.column(1)), batch.column(2).to_pylist()
            for part in chunks(raw):
                texts = raw[part.start : part.stop]
                own, low, windows, place, x, y = runs_of(texts, packed[part.start : part.stop], length)
                columns = {"x": x, "y": y, "doc": doc[part.start : part.stop][own], "packed": place}
                if length > 1:
                    places = zip(own.tolist(), low.tolist(), (low + windows + SPAN - 1).tolist(), strict=True)
                    columns["bytes"] = pa.array([texts[i][a:b] for i, a, b in places], pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    return slices.mapInArrow(run, "x long, y long, doc long, packed long" + ", bytes binary" * (length > 1))


def _single(crowded: DataFrame) -> DataFrame:
    """``doc``, ``packed``, ``mask`` of the repeated windows of slices of crowded anchors.

    First runs of windows that are repeated as a whole, then the windows of each run's first
    copy one by one. Both are grouped by content, so a passage that every text has costs a task
    no more than its share.
    """
    runs = written(_runs(crowded.select("doc", "packed", "bytes"), CELL))
    groups = written(_groups(runs, F.max("bytes").alias("bytes")))
    single = written(_runs(groups.select("first.doc", "first.packed", "bytes"), 1))
    # of the groups of single windows only those that repeat are ever read
    return _again(runs, groups.where("n > 1")).union(_again(single, written(_groups(single).where("n > 1"))))


def _groups(runs: DataFrame, *more: Column) -> DataFrame:
    """Equal runs: their hashes, the ``first`` of them (``doc``, ``packed``) and how many there are."""
    return runs.groupBy("x", "y").agg(F.min(F.struct("doc", "packed")).alias("first"), F.count("*").alias("n"), *more)


def _again(runs: DataFrame, several: DataFrame) -> DataFrame:
    """``doc``, ``packed``, ``mask`` of the runs of ``several`` groups but the first of each."""
    firsts = several.select(F.col("x").alias("_x"), F.col("y").alias("_y"), "first")
    both = runs.select("x", "y", "doc", "packed").join(firsts, (F.col("x") == F.col("_x")) & (F.col("y") == F.col("_y")))
    again = both.where(F.struct("doc", "packed") != F.col("first"))
    return again.select("doc", "packed", F.lit(-1).cast("long").alias("mask"))


def _covered(begin: np.ndarray, packed: np.ndarray, mask: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` bytes the windows cover that ``mask`` marks in slices of texts that begin at ``begin``; one more at the end."""
    change = np.zeros(size + 1, np.int32)
    start, count, _ = _unpack(packed)
    start = begin + start
    whole = mask == -1
    np.add.at(change, start[whole], 1)
    np.add.at(change, (start + count + SPAN - 1)[whole], -1)
    start, count, mask = start[~whole], count[~whole], mask[~whole]
    bits = np.unpackbits(mask.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, shift = np.nonzero(bits & (np.arange(64) < count[:, None]))
    np.add.at(change, start[row] + shift, 1)
    np.add.at(change, start[row] + shift + SPAN, -1)
    return np.cumsum(change) > 0


def cut_texts(texts: list[bytes], own: np.ndarray, packed: np.ndarray, mask: np.ndarray) -> tuple[list[bytes], pa.Array]:
    """What is left of texts without the marked windows of their slices (``own``: the index of a slice's text), and the maximal
    runs of bytes that go, as lists of ``start`` and ``end``."""
    lengths = np.array([len(t) for t in texts], np.int64)
    # a byte between texts parts the runs that end one and start the next
    begins = np.cumsum(lengths + 1) - (lengths + 1)
    gone = _covered(begins[own], packed, mask, int(lengths.sum()) + len(texts))
    data = np.frombuffer(b"\0".join([*texts, b""]), np.uint8)
    edge = np.flatnonzero(gone[1:] != gone[:-1]) + 1
    edge = np.concatenate([[0], edge]) if gone[0] else edge
    low, high = edge[::2], edge[1::2]
    text = np.searchsorted(begins, low, side="right") - 1
    spans = pa.StructArray.from_arrays([pa.array(low - begins[text]), pa.array(high - begins[text])], ["start", "end"])
    offsets = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
    stays = ~gone[:-1]
    stays[begins + lengths] = False
    left = data[stays].tobytes()
    ends = np.cumsum(lengths - np.bincount(text, high - low, len(texts)).astype(np.int64)).tolist()
    return [left[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)], pa.ListArray.from_arrays(pa.array(offsets), spans)


def _cut(rows: DataFrame, kept: list[str], text: str, as_text: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = [t or b"" for t in batch.column(len(kept)).cast(pa.binary()).to_pylist()]
            for part in chunks(texts):
                some = batch.slice(part.start, len(part))
                own = texts[part.start : part.stop]
                left, spans = cut_texts(own, *_lists(some.column(len(kept) + 1), "packed", "mask"))
                rest = pa.array([x.decode(errors="ignore") for x in left]) if as_text else pa.array(left, pa.binary())
                sizes = pa.array([len(t) for t in own], pa.int64())
                columns = [some.column(i) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*columns, sizes, spans, rest], [*kept, "n_bytes", "spans", "kept"])

    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    chosen = rows.select(*kept, F.col(text).alias("_text"), "_list")
    schema = T.StructType(
        [
            *chosen.schema.fields[: len(kept)],
            T.StructField("n_bytes", T.LongType()),
            T.StructField("spans", span),
            T.StructField("kept", T.StringType() if as_text else T.BinaryType()),
        ]
    )
    return chosen.mapInArrow(run, schema)


def without_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", keep: list[str] | None = None, as_text: bool = False
) -> DataFrame:
    """``keep`` (all columns by default), ``n_bytes``, ``spans`` (start, end; removed bytes) and ``kept``.

    ``kept`` holds the remaining bytes; as text, without code points that lost a part.
    """
    spark = docs.sparkSession
    keep = [c for c in keep or docs.columns if c not in ("n_bytes", "spans", "kept")]
    by_gram, by_slice = Window.partitionBy("gram"), Window.partitionBy("gram", "slice").orderBy("doc", "packed")
    docs = numbered(docs, key, text)
    live = (
        anchored(docs, text)
        .withColumns(
            {
                "n": F.count("*").over(by_gram),
                "low": F.min("slice").over(by_gram),
                "high": F.max("slice").over(by_gram),
            }
        )
        .where("n > 1 or slice = 0")
        .withColumn("rank", F.rank().over(by_slice))
    )
    first = F.col("rank") == 1
    found = written(
        live.withColumn("sure", (F.col("slice") == 0) | ~first)
        .where(F.col("sure") | (F.col("low") != F.col("high")))
        .select("gram", "doc", "packed", "sure")
    )
    release(spark)
    repeats = found.where("sure").select("doc", "packed", F.lit(-1).cast("long").alias("mask"))
    mixed_grams = found.where("not sure")
    pieces = texts_of(docs, mixed_grams, F.struct("gram", "packed"))
    pieces = pieces.where("_list is not null").select("_place", F.col(text), "_list")
    cut = written(_cut_out(pieces))
    release(spark)
    crowds = written(cut.groupBy("gram").count().where(F.col("count") > CROWD).select(F.col("gram").alias("_gram")))
    few = cut.join(crowds, F.col("gram") == F.col("_gram"), "left_anti")
    many = cut.join(crowds, F.col("gram") == F.col("_gram"), "left_semi")
    partial = written(compared(few).union(_single(many)))
    release(spark)
    rows = texts_of(docs, repeats.union(partial), F.struct("packed", "mask"))
    return _cut(rows, keep, text, as_text)
