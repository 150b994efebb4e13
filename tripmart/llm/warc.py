"""WARC archives in Zstandard: one record per frame, a shared dictionary in the leading skippable frame.

Pages of equal payload (SHA-1; from ``least`` bytes on) are stored once: the page with the largest id
becomes the response, the others revisit it. Tasks write archives of bounded size to the shared
folder and report them; only reported archives count, so what a lost or repeated attempt left
behind is never read. The reader streams an archive: it loads the dictionary, decodes one frame per
record and checks header, length and digest.

A NULL html is an empty payload, and NULL or empty url an empty target. A page without an id is a response of its
own. Rows that share id and payload are alike: all responses or all revisits. An empty table gives no
archives and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.shared import sampled, small, storage_of, written
from tripmart.session import scratch_folder

#: Fixed values of the formats.
SKIPPABLE, DICTIONARY, FRAME = 0x184D2A5D, b"\x37\xa4\x30\xec", b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
URN = "urn:page:"
ARCHIVE_BYTES = 32 << 20
#: The dictionary is trained on at most this many pages of at most so many bytes.
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 256, 1 << 16, 1 << 16
LEVEL = 3
CHUNK = 1 << 20


@dataclass(frozen=True)
class Record:
    """``payload`` is what follows the HTTP head; ``payload_bytes`` its full length, also for a revisit."""

    kind: str
    record_id: str
    target: str
    digest: str
    payload: bytes
    payload_bytes: int
    refers_to: str | None = None


def sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def encoded(record: Record) -> bytes:
    """The bytes of one WARC record."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {record.payload_bytes}\r\n\r\n"
    block = head.encode() + (record.payload if record.kind == "response" else b"")
    fields = [
        ("WARC-Type", record.kind),
        ("WARC-Record-ID", f"<{record.record_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(record.target, safe="/:?#[]@!$&'()*+,;=~")),
        ("WARC-Payload-Digest", f"sha1:{record.digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if record.kind == "revisit":
        fields[2:2] = [("WARC-Refers-To", f"<{record.refers_to}>"), ("WARC-Profile", PROFILE)]
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def decoded(raw: bytes) -> Record:
    """The record of one frame; raises ``ValueError`` if anything about it is not as it must be."""
    head, mark, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not mark or not lines[0].startswith("WARC/1."):
        raise ValueError("a frame does not start with a WARC header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"no WARC field: {line!r}")
        fields[name.strip().lower()] = value.strip()
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - fields.keys()
    if missing:
        raise ValueError(f"a record lacks {sorted(missing)}")
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"a record of {size} bytes holds {len(rest) - 4}, or goes on after its end")
    kind, block = fields["warc-type"], rest[:size]
    http, mark, payload = block.partition(b"\r\n\r\n")
    lengths = [x for x in http.decode("latin-1").split("\r\n") if x.lower().startswith("content-length:")]
    full = int(lengths[0].partition(":")[2]) if lengths else len(payload)
    method, _, given = fields.get("warc-payload-digest", "").rpartition(":")
    # other archives may leave the digest out or take it by another method: then that of the payload is as good
    checked = method.lower() == "sha1"
    if kind == "response" and (len(payload) != full or checked and sha1(payload) != given):
        raise ValueError(f"the payload of {fields['warc-record-id']} is not the one of its digest and length")
    digest = given if checked else sha1(payload) if kind == "response" else ""
    refers = fields.get("warc-refers-to")
    if kind == "revisit" and payload:
        raise ValueError(f"{fields['warc-record-id']} is no proper revisit")
    return Record(
        kind,
        fields["warc-record-id"].strip("<>"),
        unquote(fields.get("warc-target-uri", "")),
        digest,
        payload,
        full,
        refers.strip("<>") if refers else None,
    )


def preamble(dictionary: bytes) -> bytes:
    """The skippable frame with the dictionary; nothing without one."""
    return struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary if dictionary else b""


def records(stream) -> Iterator[Record]:
    """All records of an archive, read in bounded chunks from anything with ``read(size)``."""
    buffer = more = stream.read(CHUNK)
    while more and len(buffer) < 4:
        more = stream.read(CHUNK)
        buffer += more
    dictionary = None
    if buffer[:4] == struct.pack("<I", SKIPPABLE):

        def upto(size: int) -> bytes:
            held = buffer
            while len(held) < size:
                more = stream.read(CHUNK)
                if not more:
                    raise ValueError("the dictionary's frame is cut off")
                held += more
            return held

        buffer = upto(8)
        size = struct.unpack("<I", buffer[4:8])[0]
        buffer = upto(8 + size)
        content, buffer = buffer[8 : 8 + size], buffer[8 + size :]
        if content[:4] == FRAME:
            content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
        dictionary = zstandard.ZstdCompressionDict(content)
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    while True:
        buffer = buffer or stream.read(CHUNK)
        if not buffer:
            return
        frame, out = decompressor.decompressobj(), []
        while not frame.eof:
            if not buffer:
                raise ValueError("an archive ends within a frame")
            out.append(frame.decompress(buffer))
            buffer = frame.unused_data if frame.eof else stream.read(CHUNK)
        yield decoded(b"".join(out))


def trained(pages: DataFrame) -> bytes:
    """A dictionary from a bounded sample of whole pages; empty where there is too little to learn from."""
    whole = pages.select("page_id", F.col("html").cast("binary").alias("html"))
    sample = sampled(whole.where(F.length("html").between(1, SAMPLE_BYTES)), ["page_id", "html"], SAMPLE_PAGES)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [bytes(r["html"]) for r in sample]).as_bytes()
    except zstandard.ZstdError:
        return b""


def write(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write ``page_id``, ``url``, ``html`` to archives; returns ``path`` and ``n_records`` of each."""
    spark = pages.sparkSession
    dictionary = trained(pages)
    folder = scratch_folder(spark)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url"), F.lit("")).alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("sha", F.sha1("payload"))
    leaders = written(
        rows.where(F.length("payload") >= least)
        .groupBy("sha")
        .agg(F.max("page_id").alias("leader"))
        .withColumnRenamed("sha", "_sha")
    )
    same = (F.col("sha") == F.col("_sha")) & (F.length("payload") >= least)
    joined = rows.join(leaders, same, "left").select("page_id", "url", "payload", "leader")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        storage, base = storage_of(folder)
        storage.create_dir(base, recursive=True)
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
        attempt = f"{base}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        done, sink, size, count = [], None, 0, 0
        for batch in small(batches):
            for page, url, payload, leader in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                again = leader is not None and page is not None and page != leader
                record = Record(
                    "revisit" if again else "response",
                    f"{URN}{'' if page is None else page}",
                    url,
                    sha1(payload),
                    payload,
                    len(payload),
                    f"{URN}{leader}" if again else None,
                )
                if sink is None:
                    sink, size, count = storage.open_output_stream(f"{attempt}-{len(done)}.warc.zst", compression=None), 0, 0
                    sink.write(preamble(dictionary))
                frame = compressor.compress(encoded(record))
                sink.write(frame)
                size, count = size + len(frame), count + 1
                if size >= ARCHIVE_BYTES:
                    sink.close()
                    done.append((f"{attempt}-{len(done)}.warc.zst", count))
                    sink = None
        if sink is not None:
            sink.close()
            done.append((f"{attempt}-{len(done)}.warc.zst", count))
        paths, counts = zip(*done, strict=True) if done else ((), ())
        names = [f"{folder}/{p.rpartition('/')[2]}" for p in paths]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], ["path", "n_records"])

    return written(joined.mapInArrow(run, "path string, n_records long"))


_SCHEMA = (
    "page_id long, record_type string, target string, payload_digest string, payload_bytes long, refers_to long, payload binary"
)


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix(URN)
    return int(number) if number.lstrip("-").isdigit() else None


def _batches(found: Iterator[Record], with_payload: bool) -> Iterator[pa.RecordBatch]:
    """Record batches of bounded bytes."""
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in _SCHEMA.split(", ")]
    rows, size = [], 0
    for r in found:
        body = r.payload if with_payload else None
        rows.append((_page(r.record_id), r.kind, r.target, r.digest, r.payload_bytes, _page(r.refers_to), body))
        size += 200 + len(body or b"")
        if size >= 8 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def read(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the archives that ``write`` reported; raises if one holds another number of records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, expected in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                folder, _, name = path.rpartition("/")
                storage, base = storage_of(folder)
                seen = 0

                def counted(stream) -> Iterator[Record]:
                    nonlocal seen
                    for record in records(stream):
                        seen += 1
                        yield record

                with storage.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    yield from _batches(counted(stream), with_payload)
                if seen != expected:
                    raise ValueError(f"{path} holds {seen} records, not {expected}")

    parts = max(1, archives.count())
    return archives.select("path", "n_records").repartition(parts, "path").mapInArrow(run, _SCHEMA)


def read_files(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of any ``.warc.zst`` files below a path, each file streamed by the task that has its name.

    Names come from Spark's listing; the store must be one that ``pyarrow.fs`` can open.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                storage, place = storage_of(name)
                with storage.open_input_stream(place, compression=None) as stream:
                    yield from _batches(records(stream), with_payload)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").option("recursiveFileLookup", "true")
    return files.load(path).select("path").mapInArrow(run, _SCHEMA)
