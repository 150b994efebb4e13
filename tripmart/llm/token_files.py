"""Token ids of a corpus in binary files, compressed by Re-Pair grammars, for random access.

Documents are range partitioned by id and sorted, a task writes one file of its range, and shards of about
``SHARD_BYTES`` of text inside it have a grammar each. A shard keeps rules, lengths of their expansions and where its documents
start, so any stretch of tokens of any document is decoded from the symbols that hold it. Files go to the shared
folder; only files that a finished task reported are in the list, so what a lost or repeated attempt left
behind is never read. Readers check marks, sizes and checksums and raise ``ValueError`` for a damaged file.

Ids are those of the tokenizers library without special tokens added. This vocabulary never merges across white
space, so texts are split there and every distinct word of a batch is encoded once.

A NULL text is an empty one: its end token alone. Rows without an id come first; rows that share an id are
ordered by their text. Repeated rows are documents of their own. An empty table gives no files and no rows. Output
columns are fixed, so other columns cannot clash.
"""

from __future__ import annotations

import json
import os
import struct
import sys
import types
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm import grammar
from tripmart.llm.shared import small, storage_of, written
from tripmart.session import scratch_folder

MARK = b"TMTOKEN1"
ENCODER = "word_bpe_49k.json"
END = 2
SHARD_BYTES = 3 << 20
#: Pieces of words whose ids a worker remembers at most; beyond that it starts afresh.
MEMORY = 1_000_000
_HEAD, _HEAD_BYTES = "<6Q", 48
#: Kinds of bytes.
BLANK, LETTER, DIGIT, SIGN, STOP, WHOLE = range(6)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(ENCODER)


class WordEncoder:
    """Ids of texts, word by word, for vocabularies that drop white space and mark the ends of words.

    Texts are cut with numpy, all of a batch at once, into runs of letters, digits and runs of signs, and every distinct
    piece is encoded once. That is what the vocabulary itself does with ASCII and Latin-1 letters, which no
    normalization composes and which have one lower case each. Words with anything else in them, an apostrophe or a sign
    that a special token starts with stay whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # for pieces, which are cut and in lower case already
        self.merger = Tokenizer.from_file(path)
        self.merger.normalizer = normalizers.Sequence([])
        self.merger.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split("\n", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.tokenizer.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.closes = np.zeros(self.size, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.kinds = np.full(256, WHOLE, np.uint8)
        self.kinds[0x21:0x7F] = SIGN
        self.kinds[0x30:0x3A] = DIGIT
        self.kinds[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
        self.kinds[[0x20, *range(0x09, 0x0E)]] = BLANK
        special = self.tokenizer.get_added_tokens_decoder().values()
        self.kinds[[ord("'"), *(t.content.encode()[0] for t in special)]] = WHOLE
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[0x41:0x5B] += 0x20
        self._forget()

    def _forget(self) -> None:
        self.known = {b"\n": 0}
        self.ids, self.at, self.count = array("I", [END]), array("q", [0]), array("q", [1])

    def _pieces(self, data: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """All pieces in order, that of a line feed at every end of a document, and which of them are whole words."""
        low, kind = self.lower[data], self.kinds[data]
        lead = np.flatnonzero(data == 0xC3)  # the UTF-8 lead byte of the Latin-1 letters
        lead = lead[~np.isin(data[lead + 1], (0x97, 0xB7))]  # but for the signs of multiplication and division
        kind[lead] = kind[lead + 1] = LETTER
        low[lead[data[lead + 1] < 0x9F] + 1] += 0x20
        kind[ends] = STOP
        odd = np.flatnonzero(kind == WHOLE)
        if len(odd):
            blanks = np.flatnonzero((kind == BLANK) | (kind == STOP))
            stop = np.unique(np.searchsorted(blanks, odd))
            step = np.zeros(len(data), np.int8)
            step[np.where(stop > 0, blanks[stop - 1] + 1, 0)] += 1
            step[blanks[stop]] -= 1
            inside = np.cumsum(step, dtype=np.int8).astype(bool)
            kind[inside] = WHOLE
            low[inside] = data[inside]
        first = kind != BLANK
        keep = first.copy()
        first[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT) | (kind[1:] == STOP)
        starts = np.flatnonzero(first[keep])
        offsets = np.append(starts, np.count_nonzero(keep))
        buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(low[keep])]
        return pa.Array.from_buffers(pa.large_binary(), len(starts), buffers), kind[first] == WHOLE

    def _learn(self, pieces: list[bytes], ids: list[int], ends: list[int]) -> None:
        self.known.update(zip(pieces, range(len(self.at), len(self.at) + len(pieces)), strict=True))
        starts = [0, *ends[:-1]]
        self.at.extend([len(self.ids) + a for a in starts])
        self.count.extend([b - a for a, b in zip(starts, ends, strict=True)])
        self.ids.extend(ids)

    def _study(self, plain: list[bytes], whole: list[bytes]) -> None:
        for start in range(0, len(plain), 1024):
            some = plain[start : start + 1024]
            ids = self._encoded(self.merger, [b"\n".join(some)])[0]
            ends = (np.flatnonzero(self.closes[ids]) + 1).tolist()
            if len(ends) != len(some):
                raise ValueError(f"{len(some)} pieces have {len(ends)} ends of words")
            self._learn(some, ids, ends)
        if whole:
            found = self._encoded(self.tokenizer, whole)
            self._learn(whole, [i for ids in found for i in ids], np.cumsum([len(ids) for ids in found]).tolist())

    def _encoded(self, tokenizer, texts: list[bytes]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, the end token after each, and where each text ends."""
        texts = texts.fill_null("").cast(pa.large_binary())
        _, places, body = texts.buffers()
        places = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(body or b"", np.uint8)[places[0] : places[-1]]
        data = np.insert(data, places[1:] - places[0], ord("\n"))
        pieces, odd = self._pieces(data, places[1:] - places[0] + np.arange(len(texts)))
        coded = pieces.dictionary_encode()
        index, distinct = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        if len(self.known) + len(distinct) > MEMORY:
            self._forget()
        is_whole = np.zeros(len(distinct), bool)
        is_whole[index[odd]] = True
        new = [k for k, piece in enumerate(distinct) if piece not in self.known]
        self._study([distinct[k] for k in new if not is_whole[k]], [distinct[k] for k in new if is_whole[k]])
        number = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        # a token has a byte at least, so narrow numbers will do for all but the longest texts
        kind = np.int32 if len(data) < 1 << 30 else np.int64
        at, count = (np.frombuffer(x, np.int64)[number].astype(kind) for x in (self.at, self.count))
        size = count[index]
        upto = np.cumsum(size, dtype=kind)
        place = np.repeat(at[index] - upto + size, size)
        place += np.arange(len(place), dtype=kind)
        ids = np.frombuffer(self.ids, np.uint32)[place]
        return ids, upto[(number == 0)[index]].astype(np.int64)


def encoder(path: str) -> WordEncoder:
    """One per worker process and path: loading takes longer than many a task."""
    cache = sys.modules.setdefault("tripmart_encoders", types.ModuleType("tripmart_encoders")).__dict__
    name = f"words of {path}"
    if name not in cache:
        cache[name] = WordEncoder(path)
    return cache[name]


# ------------------------------------------------------------------ the format


def _narrow(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width]).tobytes()


def _wide(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 4), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view("<u4").ravel().astype(np.int64)


def packed(keys: list[int | None], ids: np.ndarray, ends: np.ndarray, base: int) -> bytes:
    """A shard: sizes, then ids of documents, their symbols' starts, rules, lengths and symbols."""
    g = grammar.compressed(ids, ends, base)
    width = max(1, (int(base + len(g.left)).bit_length() + 7) // 8)
    known = np.array([k is not None for k in keys], np.uint8)
    numbers = np.array([k or 0 for k in keys], "<i8")
    return b"".join(
        [
            struct.pack(_HEAD, len(keys), len(ids), base, len(g.left), len(g.symbols), width),
            numbers.tobytes(),
            known.tobytes(),
            g.starts.astype("<i8").tobytes(),
            _narrow(g.left, width),
            _narrow(g.right, width),
            g.lengths.astype("<i8").tobytes(),
            _narrow(g.symbols, width),
        ]
    )


class Shard:
    """A shard's documents, whole or in part."""

    def __init__(self, raw: bytes):
        docs, self.n_tokens, base, rules, symbols, width = struct.unpack_from(_HEAD, raw)
        sizes = [8 * docs, docs, 8 * (docs + 1), width * rules, width * rules, 8 * rules, width * symbols]
        if len(raw) != _HEAD_BYTES + sum(sizes):
            raise ValueError(f"a shard of {len(raw)} bytes has another size than its head says")
        places = np.cumsum([_HEAD_BYTES, *sizes])
        numbers, known, starts, left, right, lengths, body = (raw[a:b] for a, b in zip(places[:-1], places[1:], strict=True))
        there = np.frombuffer(known, np.uint8).tolist()
        self.keys = [k if ok else None for k, ok in zip(np.frombuffer(numbers, "<i8").tolist(), there, strict=True)]
        self.grammar = grammar.Grammar(
            base,
            _wide(left, width),
            _wide(right, width),
            np.frombuffer(lengths, "<i8").astype(np.int64),
            _wide(body, width),
            np.frombuffer(starts, "<i8").astype(np.int64),
        )
        self.expand = grammar.Expander(self.grammar)

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        """All ids and where each document ends."""
        reach = np.concatenate(([0], np.cumsum(self.expand.length[self.grammar.symbols])))
        return self.expand(self.grammar.symbols), reach[self.grammar.starts[1:]]

    def tokens(self, document: int, start: int, stop: int) -> np.ndarray:
        return grammar.part(self.grammar, self.expand, document, start, stop)


class TokenFile:
    """A written file, read shard by shard from anything with ``read`` and ``seek``."""

    def __init__(self, stream, size: int):
        self.stream = stream
        tail = len(MARK) + 4
        if size < tail + len(MARK) or self._at(0, len(MARK)) != MARK or self._at(size - len(MARK), len(MARK)) != MARK:
            raise ValueError("no token file, or one that is cut off")
        length = struct.unpack("<I", self._at(size - tail, 4))[0]
        self.shards = json.loads(self._at(size - tail - length, length))["shards"]

    def _at(self, place: int, size: int) -> bytes:
        self.stream.seek(place)
        return self.stream.read(size)

    def shard(self, number: int) -> Shard:
        entry = self.shards[number]
        raw = self._at(entry["at"], entry["bytes"])
        if zlib.crc32(raw) != entry["crc32"]:
            raise ValueError(f"shard {number} is not what was written")
        return Shard(raw)

    def __iter__(self) -> Iterator[Shard]:
        return (self.shard(i) for i in range(len(self.shards)))

    def locate(self, key: int) -> tuple[int, int] | None:
        """The shard and place of the first document of an id; shards that cannot hold it are not read."""
        for number, entry in enumerate(self.shards):
            if entry["last"] is not None and (entry["first"] is None or entry["first"] <= key) and key <= entry["last"]:
                keys = self.shard(number).keys
                if key in keys:
                    return number, keys.index(key)
        return None


# ------------------------------------------------------------------ writing and reading on Spark


def _shards(batches: Iterator[pa.RecordBatch], encode: WordEncoder) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Keys, ids and ends of documents of about ``SHARD_BYTES`` of text at a time."""

    def encoded() -> tuple[list, np.ndarray, np.ndarray]:
        return keys, *encode(pa.concat_arrays(texts))

    keys, texts, size = [], [], 0
    for batch in small(batches):
        keys += batch.column(0).to_pylist()
        texts.append(batch.column(1))
        size += pc.sum(pc.binary_length(texts[-1])).as_py() or 0
        if size >= SHARD_BYTES:
            yield encoded()
            keys, texts, size = [], [], 0
    if keys:
        yield encoded()


def write(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Write all documents in order of id; returns ``path``, ``part``, ``n_docs`` and ``n_tokens`` of each file."""
    folder = scratch_folder(docs.sparkSession)
    tokenizer = tokenizer or default_tokenizer()
    body = F.coalesce(F.col(text), F.lit(""))
    # equal ids are told apart by text, equal rows by where they were read, so no id is a task of its own
    rows = docs.select(F.col(key).cast("long").alias("_key"), body.alias("_text")).withColumns(
        {"_hash": F.xxhash64("_text"), "_read": F.monotonically_increasing_id()}
    )
    order = [F.asc_nulls_first("_key"), "_hash", "_read"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("_key", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        storage, base = storage_of(folder)
        part = TaskContext.get().partitionId()
        name = f"{part:08d}-{uuid.uuid4().hex}.tokens"
        sink, listed, place = None, [], len(MARK)
        for keys, ids, ends in _shards(batches, encode):
            if sink is None:
                storage.create_dir(base, recursive=True)
                sink = storage.open_output_stream(f"{base}/{name}", compression=None)
                sink.write(MARK)
            raw = packed(keys, ids, ends, encode.size)
            sink.write(raw)
            there = {"at": place, "bytes": len(raw), "crc32": zlib.crc32(raw), "first": keys[0], "last": keys[-1]}
            listed.append(there | {"docs": len(keys), "tokens": len(ids)})
            place += len(raw)
        if sink is not None:
            footer = json.dumps({"shards": listed}).encode()
            sink.write(footer + struct.pack("<I", len(footer)) + MARK)
            sink.close()
        totals = [[sum(x[k] for x in listed)] if listed else [] for k in ("docs", "tokens")]
        there = 1 if listed else 0
        columns = [pa.array([f"{folder}/{name}"] * there, pa.string()), pa.array([part] * there, pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [*columns, *(pa.array(t, pa.int64()) for t in totals)], ["path", "part", "n_docs", "n_tokens"]
        )

    return written(dealt.mapInArrow(run, "path string, part long, n_docs long, n_tokens long"))


def read(files: DataFrame, with_ids: bool = True) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` and, on demand, ``ids`` of every document of written files."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per file, not per document
    placed = files.select("path", "n_docs", "n_tokens", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("before"))
    names = ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, docs, tokens, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                storage, place = storage_of(path)
                size = storage.get_file_info(place).size or 0
                first, seen = at, 0
                with storage.open_input_file(place) as stream:
                    for shard in TokenFile(stream, size):
                        ids, ends = shard.all()
                        starts = np.concatenate(([0], ends[:-1]))
                        raw = memoryview(ids.astype("<u4").tobytes())
                        crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                        columns = [pa.array(shard.keys, pa.int64()), pa.array(starts + at), pa.array(ends - starts), pa.array(crcs, pa.int64())]
                        if with_ids:
                            offsets = pa.array(np.concatenate((starts[:1], ends)), pa.int32())
                            columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))))
                        yield pa.RecordBatch.from_arrays(columns, names)
                        at, seen = at + len(ids), seen + len(ends)
                if (seen, at - first) != (docs, tokens):
                    raise ValueError(f"{path} holds {seen} documents of {at - first} tokens, not {docs} of {tokens}")

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    return placed.repartition(max(1, files.count())).mapInArrow(run, schema)
