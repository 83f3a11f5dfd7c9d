"""WARC archives: written as one gzip stream each, then normalised to a member per record.

`write_archives` writes each partition's records as plain WARC inside one gzip stream.
`normalise` inflates such a stream once, piece by piece, writes every record as its own
gzip member, and beside it an index of the members' offsets; with it `read_archives` goes
to each record directly.

Of records with equal payloads the one with the smallest page_id is the response; the
others are revisits that name it and carry no payload, but its length and digest.

Defined results: a null html is an empty payload; a null page_id comes after all others,
and pages that share a payload and all lack an id are all responses, as are rows that
repeat the smallest page_id; an empty table gives no archives and no rows; a null url is left out
of the record; other columns are ignored; long payloads are whole.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guardwork.llm.files import reading, whole_file
from guardwork.llm.shared import shared_folder, stored
from guardwork.llm.words import text_bytes

#: Bytes of records (before compression) after which a partition begins a new archive.
ARCHIVE_BYTES = 128 << 20
#: Payloads of fewer bytes are never revisits.
LEAST_BYTES = 0
_PIECE = 1 << 20
_DATE = "2020-01-01T00:00:00Z"  # records carry a fixed date, so that equal input gives equal archives

_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A WARC record; with refers_to, a revisit."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    body = http.encode() + (payload if refers_to is None else b"")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", None if url is None else "".join(url.split())),
        ("Page-Id", page_id),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(body)),
    ]
    if refers_to is not None:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_id(refers_to, digest)),
            ("Refers-To-Page-Id", refers_to),
        ]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return f"WARC/1.1\r\n{head}\r\n".encode() + body + b"\r\n\r\n"


def head_fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:] if line)}


def records_in(stream) -> Iterator[bytes]:
    """The records of a gzip file of one or more members, inflated piece by piece."""
    inflate = zlib.decompressobj(31)
    held = bytearray()
    ended = False
    while not ended:
        raw = stream.read(_PIECE)
        ended = not raw
        while raw:
            held += inflate.decompress(raw, _PIECE)
            raw = inflate.unconsumed_tail
            if inflate.eof:
                raw = inflate.unused_data
                inflate = zlib.decompressobj(31)
            yield from _complete(held)
    yield from _complete(held)
    if held:
        raise ValueError("the archive ends within a record")


def _complete(held: bytearray) -> Iterator[bytes]:
    """Takes whole records off the front."""
    at = 0
    while (end := held.find(b"\r\n\r\n", at)) >= 0:
        size = int(head_fields(bytes(held[at:end]))["content-length"])
        stop = end + 4 + size + 4
        if stop > len(held):
            break
        yield bytes(held[at:stop])
        at = stop
    del held[:at]


def member(data: bytes) -> bytes:
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


def with_responses(pages: DataFrame) -> DataFrame:
    """Adds refers_to: for a revisit, the page_id of the response.

    Digests are counted before the join, so only those that repeat are looked up; the join is
    on the digest and adaptive execution splits a digest of very many pages.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"))
    pages = pages.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    repeated = (
        pages.where(F.octet_length("html") >= LEAST_BYTES)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("response"))
        .where("n > 1")
        .select("digest", "response")
    )
    is_revisit = F.coalesce(F.col("page_id") > F.col("response"), F.col("page_id").isNull())
    return (
        pages.join(repeated, "digest", "left")
        .withColumn("refers_to", F.when(is_revisit, F.col("response")))
        .select("page_id", "url", "html", "refers_to")
    )


_FILES = "name string, records long"


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes the archives of pages (page_id, url, html, refers_to), a gzip stream each; returns
    their names and records."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        rows = (
            row
            for batch in batches
            for row in zip(
                batch.column("page_id").to_pylist(),
                batch.column("url").to_pylist(),
                text_bytes(batch.column("html")),
                batch.column("refers_to").to_pylist(),
                strict=True,
            )
        )
        row = next(rows, None)
        while row is not None:
            name, size, records = f"part-{part:06d}-{number:06d}.warc.gz", 0, 0
            deflate = zlib.compressobj(1, zlib.DEFLATED, 31)
            with whole_file(folder, name) as stream:
                while row is not None and size < ARCHIVE_BYTES:
                    data = record(*row)
                    stream.write(deflate.compress(data))
                    size, records, row = size + len(data), records + 1, next(rows, None)
                stream.write(deflate.flush())
            yield pa.RecordBatch.from_pylist([{"name": name, "records": records}])
            number += 1

    return stored(pages.sortWithinPartitions("page_id", "url").mapInArrow(write, _FILES), "warc-files")


def _spread(files: DataFrame) -> DataFrame:
    """A file or two for each task."""
    return files.repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def normalise(files: DataFrame, source: str, folder: str) -> DataFrame:
    """Rewrites each archive of `source` into `folder` with a member per record, and an index
    beside it (a line for each: offset, length); returns names and records."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("name").to_pylist():
                offset, lines = 0, []
                with reading(source, name) as stream, whole_file(folder, name) as out:
                    for data in records_in(stream):
                        packed = member(data)
                        out.write(packed)
                        lines.append(f"{offset}\t{len(packed)}\n")
                        offset += len(packed)
                with whole_file(folder, f"{name}.idx") as out:
                    out.write("".join(lines).encode())
                yield pa.RecordBatch.from_pylist([{"name": name, "records": len(lines)}])

    return stored(_spread(files).mapInArrow(rewrite, _FILES), "warc-normalised")


def parsed(data: bytes) -> dict:
    """What a record says of its page; a response's digest and length are taken from the payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = head_fields(head)
    body = rest[: int(fields["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    sizes = [line for line in http.decode("latin-1").split("\r\n") if line.lower().startswith("content-length:")]
    digest, size = fields["warc-payload-digest"].removeprefix("sha1:"), int(sizes[0].partition(":")[2])
    if fields["warc-type"] == "response":
        digest, size = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
    number = {key: int(fields[key]) if key in fields else None for key in ("page-id", "refers-to-page-id")}
    return {
        "page_id": number["page-id"],
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["warc-type"],
        "refers_to": number["refers-to-page-id"],
    }


def read_archives(files: DataFrame, folder: str) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("name").to_pylist():
                with reading(folder, f"{name}.idx") as stream:
                    index = [tuple(map(int, line.split())) for line in stream.read().decode().splitlines()]
                with reading(folder, name) as archive:
                    rows = []
                    for offset, length in index:
                        archive.seek(offset)
                        rows.append(parsed(zlib.decompress(archive.read(length), 31)))
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return _spread(files).mapInArrow(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


def archive_report(pages: DataFrame) -> DataFrame:
    """Writes pages to archives in the shared folder, normalises them and reads them back."""
    whole, folder = (shared_folder(pages.sparkSession, name) for name in ("warc-whole", "warc"))
    files = write_archives(with_responses(pages), whole)
    return read_archives(normalise(files, whole, folder), folder)
