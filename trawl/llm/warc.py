"""WARC records as a table of chunks.

An archive is a Parquet table with rows (record, chunk): chunk 0 begins with
the record's header block, every chunk holds up to ``CHUNK_BYTES`` of payload,
and each carries the digest of the payload so far.  Header, chunks in order
and two line ends are the bytes of the record as WARC 1.1 defines them.  A
writer takes chunks straight out of Arrow's buffers and a reader keeps one
digest, so neither holds a record as a whole.

Of records with equal payloads of at least ``SHARED_BYTES`` the one with the
largest id is a response, the others are revisits of it without a payload.
Equality is found on digests and sizes; payloads are joined with the groups of
equal ones only, which are broadcast where they are small.

Null payloads are empty ones.  Null ids are written without a number; among
equal payloads they are revisits unless all ids are null.  Rows with one id
and equal payloads share their fate.  An empty table writes an archive without
records.  Further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.llm.batches import slices
from trawl.plans.lineage import materialize

CHUNK_BYTES = 64 << 10
SHARED_BYTES = 1000
#: Bytes of chunks in one Arrow batch of the writer.
BATCH_BYTES = 4 << 20
END = b"\r\n\r\n"

ARCHIVE = "record long, chunk int, last boolean, head binary, data binary, sha1_so_far string"
RECORDS = (
    "id long, payload_bytes long, payload_digest string, record_type string, refers_to long, uri string, n_chunks int"
)

# Names and the profile of WARC 1.1.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _name(number: int | None) -> str:
    return f"<urn:page:{'' if number is None else number}>"


def _number(name: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name)
    return int(found[1]) if found else None


def header_block(number: int | None, uri: str | None, refers_to: int | None, size: int, digest: bytes, revisit: bool, date: str) -> bytes:
    """Everything of a record ahead of its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = [
        VERSION,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_name(number)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + (0 if revisit else size)}",
    ]
    if uri is not None:
        lines.insert(3, "WARC-Target-URI: " + re.sub(r"[\r\n]", "", uri))
    if revisit:
        lines += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(lines).encode() + END + http


def fields_of(head: bytes) -> dict[str, str]:
    warc, _, http = head.partition(END)
    fields = dict(line.split(": ", 1) for line in warc.decode().split("\r\n")[1:])
    fields["payload-bytes"] = re.search(rb"Content-Length: (\d+)", http)[1].decode()
    return fields


def with_types(rows: DataFrame, id_column: str, payload_column: str, uri_column: str) -> DataFrame:
    """(id, uri, payload, digest, response): response is the id that a revisit
    refers to, null for responses."""
    payload = F.encode(F.coalesce(rows[payload_column].cast("string"), F.lit("")), "UTF-8")
    records = rows.select(
        rows[id_column].cast("long").alias("id"), rows[uri_column].cast("string").alias("uri"), payload.alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    sized = records.select("id", "digest", F.octet_length("payload").alias("size")).where(F.col("size") >= SHARED_BYTES)
    groups = sized.groupBy("digest", "size").agg(F.max("id").alias("response"), F.count("*").alias("copies"))
    groups = materialize(groups.where("copies > 1 AND response IS NOT NULL").select("digest", "size", "response"))
    joined = records.withColumn("size", F.octet_length("payload")).join(groups, ["digest", "size"], "left")
    revisit = F.col("response").isNotNull() & ~F.col("response").eqNullSafe(F.col("id"))
    return joined.select("id", "uri", "payload", "digest", F.when(revisit, F.col("response")).alias("response"))


def write_archive(
    rows: DataFrame, folder: str, id_column: str = "page_id", payload_column: str = "html", uri_column: str = "url",
    chunk_bytes: int = CHUNK_BYTES, date: str = "2024-01-01T00:00:00Z",
) -> None:
    """Write a record per row below ``folder``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record = TaskContext.get().partitionId() << 40
        columns: list[list] = [[] for _ in range(6)]
        held = 0

        def batch() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.string())
            names = [f.split()[0] for f in ARCHIVE.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for piece in slices(batches, "payload"):
            numbers, uris, digests, responses = (piece.column(c).to_pylist() for c in ("id", "uri", "digest", "response"))
            payloads = piece.column("payload")
            ends = np.frombuffer(payloads.buffers()[1], np.int32, len(payloads) + 1, 4 * payloads.offset)
            octets = memoryview(payloads.buffers()[2] or b"")
            for at, (number, uri, digest, response) in enumerate(zip(numbers, uris, digests, responses)):
                first, stop = int(ends[at]), int(ends[at + 1])
                head = header_block(number, uri, response, stop - first, bytes.fromhex(digest), response is not None, date)
                if response is not None:
                    first = stop
                running, chunk = hashlib.sha1(), 0
                while True:
                    data = octets[first : min(first + chunk_bytes, stop)]
                    running.update(data)
                    first += len(data)
                    last = first >= stop
                    for column, value in zip(columns, (record, chunk, last, None if chunk else head, data, running.hexdigest())):
                        column.append(value)
                    held += len(data) + len(head)
                    if held >= BATCH_BYTES:
                        yield batch()
                        columns, held = [[] for _ in range(6)], 0
                    chunk += 1
                    if last:
                        break
                record += 1
        if columns[0]:
            yield batch()

    records = with_types(rows, id_column, payload_column, uri_column)
    records.mapInArrow(run, ARCHIVE).write.option("compression", "zstd").parquet(folder)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record, read chunk by chunk; each chunk's digest is checked.

    Records of one chunk are read where they lie.  Those of several are dealt
    by record and streamed in the order of their chunks.
    """
    chunks = spark.read.schema(ARCHIVE).parquet(folder)
    whole = F.expr("chunk = 0 AND last")
    several = chunks.where(~whole).repartition("record").sortWithinPartitions("record", "chunk")
    return chunks.where(whole).mapInArrow(_read, RECORDS).union(several.mapInArrow(_read, RECORDS))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    running, fields, size, expected = None, {}, 0, 0
    names = [f.split()[0] for f in RECORDS.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32())
    for piece in slices(batches, "data"):
        columns: list[list] = [[] for _ in names]
        record, chunk, last, head, data, told = (piece.column(i) for i in range(6))
        for at in range(piece.num_rows):
            number = chunk[at].as_py()
            if not number:
                running, fields, size, expected = hashlib.sha1(), fields_of(head[at].as_py()), 0, 0
            octets = data[at].as_buffer()
            running.update(octets)
            size += octets.size
            if number != expected or running.hexdigest() != told[at].as_py():
                raise ValueError(f"record {record[at].as_py()}: chunk {number} is not what was written")
            expected += 1
            if last[at].as_py():
                kind = fields["WARC-Type"]
                digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                if kind == "response" and (running.hexdigest() != digest or size != int(fields["payload-bytes"])):
                    raise ValueError(f"record {record[at].as_py()}: the payload is not what its header says")
                refers_to = _number(fields["WARC-Refers-To"]) if kind == "revisit" else None
                values = (
                    _number(fields["WARC-Record-ID"]), int(fields["payload-bytes"]), digest, kind, refers_to,
                    fields.get("WARC-Target-URI"), expected,
                )
                for column, value in zip(columns, values):
                    column.append(value)
        if columns[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def record_bytes(chunks: Iterator[tuple[bytes | None, bytes]]) -> Iterator[bytes]:
    """The bytes of one record from its (head, data) in order, piece by piece."""
    for head, data in chunks:
        if head:
            yield head
        yield data
    yield END
