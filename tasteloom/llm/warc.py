"""WARC archives with one compressed member per record and a dictionary in front.

Every file is a series of Zstandard frames. The first is a skippable frame that holds the
file's dictionary; each record after it is a frame of its own, compressed with that
dictionary, so a record can be read by its offset alone. The dictionary is trained on
records of the same file, ``TRAIN_BYTES`` of them at most, taken evenly from the first
``HEAD_BYTES`` of it; it changes only the size of the file.

Records with equal payloads: the one with the smallest page id is a response, the others
revisit it. Payloads meet by their SHA-1 alone: pages do not gather anywhere, however many
copies there are; the smallest id of a digest is an aggregate. A task writes the pages of
its partition in one pass, record by record.

Defined cases: null html is an empty payload; payloads under ``min_bytes`` are always
responses; rows with the same id and payload are alike, so if the id is the smallest they
are all responses; null ids come after all others, and a null id alone is no referrer
target, so if all are null all are responses; null url is written empty. Other columns are
not read. No pages, no files.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteloom.llm.base import arrow_map, saved, scratch, slices
from tasteloom.llm.files import opened, written

#: Magic number of the skippable frame that holds a dictionary.
DICTIONARY_MAGIC = 0x184D2A5D
DICTIONARY_BYTES = 64 << 10
TRAIN_BYTES = 1 << 20
#: Payload bytes that one file is made of, about.
FILE_BYTES = 64 << 20
LEVEL = 3
#: Archives hold dates; these are all written with the same one, so reruns agree.
DATE = "1970-01-01T00:00:00Z"
READ = 1 << 20

RECORDS = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
    "payload_digest string, path string, offset bigint"
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_origin(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, digest, first_id``, one row per id and payload; first_id as in the records."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        payloads = [(html or "").encode() for html in batch.column(1).to_pylist()]
        return pa.record_batch(
            [
                batch.column(0),
                pa.array([payload_digest(p) for p in payloads], pa.string()),
                pa.array([len(p) >= min_bytes for p in payloads]),
            ],
            ["page_id", "digest", "shared"],
        )

    found = arrow_map(
        pages.select("page_id", "html"), step, "page_id bigint, digest string, shared boolean", "html"
    ).groupBy("page_id", "digest").agg(F.max("shared").alias("shared"))
    first = found.filter("shared").groupBy("digest").agg(F.min("page_id").alias("first_id"))
    return found.join(first, "digest", "left").select("page_id", "digest", "first_id")


def record(page_id, url, kind: str, refers_to, payload: bytes, digest: str) -> bytes:
    """One record; a revisit has no payload, but names the one it stands for."""
    body = payload if kind == "response" else b""
    head = [
        b"WARC/1.1",
        f"WARC-Type: {kind}".encode(),
        f"WARC-Target-URI: {url or ''}".replace("\r", "").replace("\n", "").encode(),
        f"WARC-Date: {DATE}".encode(),
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>".encode(),
        f"WARC-Payload-Digest: sha1:{digest}".encode(),
        f"WARC-Payload-Length: {len(payload)}".encode(),
        b"Content-Type: text/html; charset=utf-8",
    ]
    if kind == "revisit":
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>".encode())
        head.append(b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    head.append(f"Content-Length: {len(body)}".encode())
    return b"\r\n".join(head) + b"\r\n\r\n" + body + b"\r\n\r\n"


def _trained(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    total = sum(map(len, records))
    step = max(1, -(-total // TRAIN_BYTES))
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records[::step])
    except zstandard.ZstdError:  # too few or too short records for one
        return None


def frames(records: list[bytes], more: Iterator[bytes]) -> Iterator[bytes]:
    """The frames of a file; the first ``records`` make the dictionary."""
    trained = _trained(records)
    raw = trained.as_bytes() if trained else b""
    yield struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
    for one in chain(records, more):
        yield packer.compress(one)


#: Record bytes of a file that its dictionary is made from, spread over them.
HEAD_BYTES = 8 << 20


def write(pages: DataFrame, min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the archives; ``path, n_records, n_bytes`` of every file, as a stored table."""
    spark = pages.sparkSession
    folder = scratch(spark, "warc")
    origin = with_origin(pages, min_bytes).select(
        F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), "first_id"
    )

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [payload_digest((html or "").encode()) for html in batch.column(2).to_pylist()]
        return pa.record_batch(
            [*batch.columns, pa.array(found, pa.string())], ["page_id", "url", "html", "digest"]
        )

    digested = arrow_map(
        pages.select("page_id", "url", "html"),
        add,
        "page_id bigint, url string, html string, digest string",
        "html",
    )
    same = F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    joined = digested.join(origin, same).select("page_id", "url", "html", "digest", "first_id")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        records = _records(slices(batches, "html"))
        number = 0
        while True:
            head, size = [], 0
            for one in records:
                head.append(one)
                size += len(one)
                if size >= HEAD_BYTES:
                    break
            if not head:
                return
            tally = {"records": 0, "bytes": 0, "raw": 0}

            def counted(head=head, tally=tally) -> Iterator[bytes]:
                def rest() -> Iterator[bytes]:
                    while tally["raw"] < file_bytes and (one := next(records, None)) is not None:
                        tally["raw"] += len(one)
                        yield one

                tally["raw"] = sum(map(len, head))
                for frame in frames(head, rest()):
                    tally["records"] += 1
                    tally["bytes"] += len(frame)
                    yield frame

            path = written(f"{folder}/files", f"{part:06d}-{number}.warc.zst", counted())
            number += 1
            yield pa.record_batch(
                [[path], [tally["records"] - 1], [tally["bytes"]]], ["path", "n_records", "n_bytes"]
            )

    schema = "path string, n_records bigint, n_bytes bigint"
    return saved(joined.mapInArrow(step, schema), f"{folder}/manifest")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
    for batch in batches:
        for page_id, url, html, digest, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            revisits = first is not None and first != page_id
            kind = "revisit" if revisits else "response"
            yield record(page_id, url, kind, first if revisits else None, (html or "").encode(), digest)


def read_records(path: str) -> Iterator[tuple[int, bytes]]:
    """Offset and bytes of every record of a file."""
    with opened(path) as file:
        magic, size = struct.unpack("<II", file.read(8))
        if magic != DICTIONARY_MAGIC:
            raise ValueError(f"{path} has no dictionary in front")
        raw = file.read(size)
        trained = zstandard.ZstdCompressionDict(raw) if raw else None
        reader = zstandard.ZstdDecompressor(dict_data=trained)
        offset, held = 8 + size, b""
        while True:
            unit, out, length = reader.decompressobj(), [], 0
            while not unit.eof:
                held = held or file.read(READ)
                if not held:
                    if length:
                        raise ValueError(f"{path} ends within a record")
                    return
                out.append(unit.decompress(held))
                rest = unit.unused_data if unit.eof else b""
                length += len(held) - len(rest)
                held = rest
            yield offset, b"".join(out)
            offset += length


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


def _number(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def read(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Every record of the files; a response's length and digest are taken from its payload."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split(" ")[0] for field in RECORDS.split(", ")]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                for offset, raw in read_records(path):
                    fields, body = parsed(raw)
                    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"][5:]
                    size = int(fields["WARC-Payload-Length"])
                    if kind == "response":
                        if payload_digest(body) != digest or len(body) != size:
                            raise ValueError(f"{path} at {offset}: the payload is damaged")
                    rows.append(
                        (
                            _number(fields["WARC-Record-ID"]),
                            fields["WARC-Target-URI"],
                            kind,
                            _number(fields.get("WARC-Refers-To")),
                            size,
                            digest,
                            path,
                            offset,
                        )
                    )
                    if len(rows) == 1000:
                        yield _batch(rows, names)
                        rows = []
                if rows:
                    yield _batch(rows, names)

    n = max(1, files.count())
    return files.select("path").repartition(n, "path").mapInArrow(step, RECORDS)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"page_id": pa.int64(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "offset": pa.int64()}
    columns = zip(*rows, strict=True)
    return pa.record_batch(
        [pa.array(c, kinds.get(n, pa.string())) for c, n in zip(columns, names, strict=True)], names
    )
