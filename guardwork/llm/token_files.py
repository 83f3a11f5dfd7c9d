"""Token ids in files of Simple-8b words.

A 64-bit word holds a selector and as many ids as fit into 60 bits at the selector's width;
an id of more than 60 bits is an escape word followed by the id itself.  A file holds its
documents' ids in blocks of `BLOCK_IDS` with an offset for each, so that any block can be
decoded alone, a whole block at a time in numpy.

File: a header (`HEADER`: magic, documents, ids, blocks), then for the documents their ids
(int64), a null mark (uint8 each) and the end of their tokens (uint64), then the blocks'
offsets in words (uint64, one more than blocks), then the words.  All little-endian.

Files are written in ascending order of doc_id over all partitions (null first, equal ids by
text) and split at `FILE_IDS`, so a task holds one file's words at most.

Defined results: a null text has only the end id; repeated rows are all written; an empty
table gives no files and no rows; other columns are ignored; ids must not be negative.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from guardwork.llm.files import whole_file
from guardwork.llm.shared import shared_folder, stored
from guardwork.llm.word_pieces import worker_tokenizer
from guardwork.llm.words import text_bytes

BLOCK_IDS = 1 << 14
FILE_IDS = 1 << 22
MAGIC = b"TOK8"
HEADER = struct.Struct("<4sQQQ")

#: Ids per word and bits of each, by selector; selector 0 is the escape.
ESCAPE = 0
COUNTS = (0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (0, *(60 // n for n in COUNTS[1:]))
_PAYLOAD_BITS = 60


def pack(ids: np.ndarray) -> np.ndarray:
    """The words of a block."""
    n = len(ids)
    if n == 0:
        return np.zeros(0, np.uint64)
    ids = ids.astype(np.uint64)
    bits = np.zeros(n + COUNTS[1], np.uint8)  # zeros behind the end: the last word may be half empty
    low = ids.copy()
    for shift in (32, 16, 8, 4, 2, 1):
        high = low >> np.uint64(shift)
        more = high > 0
        bits[:n] += more.astype(np.uint8) * np.uint8(shift)
        low = np.where(more, high, low)
    bits[:n] += (low > 0).astype(np.uint8)

    # widest[i]: most bits among as many ids from i on as the selector takes.
    selector = np.zeros(n, np.uint8)
    widest, size = bits[:n].copy(), 1
    for choice in range(len(COUNTS) - 1, 0, -1):
        while size < COUNTS[choice]:
            np.maximum(widest, bits[size : size + n], out=widest)
            size += 1
        fits = widest <= WIDTHS[choice]
        if not fits.any() and COUNTS[choice] >= 2:
            break
        selector[fits] = choice

    steps = np.maximum(np.array(COUNTS), 1)[selector].tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += steps[at]
    at = np.array(starts)
    chosen = selector[at]
    place = np.cumsum(np.where(chosen == ESCAPE, 2, 1))
    words = np.zeros(place[-1], np.uint64)
    place -= np.where(chosen == ESCAPE, 2, 1)
    padded = np.concatenate((ids, np.zeros(COUNTS[1], np.uint64)))
    for choice in np.unique(chosen):
        rows = chosen == choice
        if choice == ESCAPE:
            words[place[rows] + 1] = ids[at[rows]]
            continue
        slots = np.arange(COUNTS[choice])
        values = padded[at[rows][:, None] + slots] << (slots * WIDTHS[choice]).astype(np.uint64)
        words[place[rows]] = np.bitwise_or.reduce(values, axis=1) | np.uint64(int(choice) << _PAYLOAD_BITS)
    return words


def unpack(words: np.ndarray, n: int) -> np.ndarray:
    """The n ids of a block."""
    selector = (words >> np.uint64(_PAYLOAD_BITS)).astype(np.int64)
    # A word behind an escape is an id, whatever its top bits say; escapes are rare.
    raw = np.zeros(len(words), bool)
    for at in np.flatnonzero(selector == ESCAPE):
        if not raw[at]:
            raw[at + 1] = True
    counts = np.where(raw, 1, np.array([*COUNTS, 0])[np.minimum(selector, len(COUNTS))])
    ends = np.cumsum(counts)
    out = np.zeros(ends[-1] if len(ends) else 0, np.uint64)
    starts = ends - counts
    out[starts[raw]] = words[raw]
    for choice in range(1, len(COUNTS)):
        rows = (selector == choice) & ~raw
        if rows.any():
            slots = np.arange(COUNTS[choice])
            values = words[rows][:, None] >> (slots * WIDTHS[choice]).astype(np.uint64)
            out[starts[rows][:, None] + slots] = values & np.uint64((1 << WIDTHS[choice]) - 1)
    return out[:n]


def file_bytes(doc_ids: list[int | None], ends: np.ndarray, ids: np.ndarray) -> bytes:
    blocks = [pack(ids[i : i + BLOCK_IDS]) for i in range(0, len(ids), BLOCK_IDS)]
    offsets = np.concatenate(([0], np.cumsum([len(b) for b in blocks]))).astype("<u8")
    parts = [HEADER.pack(MAGIC, len(doc_ids), len(ids), len(blocks))]
    parts.append(np.array([d or 0 for d in doc_ids], "<i8").tobytes())
    parts.append(np.array([d is None for d in doc_ids], np.uint8).tobytes())
    parts += [ends.astype("<u8").tobytes(), offsets.tobytes(), *(b.astype("<u8").tobytes() for b in blocks)]
    return b"".join(parts)


class TokenFile:
    """Reads a file's bytes; blocks are decoded when asked for."""

    def __init__(self, content: bytes):
        magic, docs, self.n_ids, blocks = HEADER.unpack_from(content)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = HEADER.size
        numbers = np.frombuffer(content, "<i8", docs, at)
        nulls = np.frombuffer(content, np.uint8, docs, at := at + 8 * docs)
        self.ends = np.frombuffer(content, "<u8", docs, at := at + docs).astype(np.int64)
        self.offsets = np.frombuffer(content, "<u8", blocks + 1, at := at + 8 * docs).astype(np.int64)
        self.words = np.frombuffer(content, "<u8", -1, at + 8 * (blocks + 1))
        self.doc_ids = [None if null else int(n) for n, null in zip(numbers, nulls, strict=True)]

    def block(self, i: int) -> np.ndarray:
        n = min(BLOCK_IDS, self.n_ids - i * BLOCK_IDS)
        return unpack(self.words[self.offsets[i] : self.offsets[i + 1]], n)

    def ids(self, start: int, end: int) -> np.ndarray:
        if end <= start:
            return np.zeros(0, np.uint64)
        first = start // BLOCK_IDS
        parts = [self.block(i) for i in range(first, (end - 1) // BLOCK_IDS + 1)]
        return np.concatenate(parts)[start - first * BLOCK_IDS : end - first * BLOCK_IDS]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """doc_id, start within the file and ids of each document, with one block held at a time."""
        at, held, block = 0, -1, np.zeros(0, np.uint64)
        for doc_id, end in zip(self.doc_ids, self.ends.tolist(), strict=True):
            parts, start = [], at
            while at < end:
                if at // BLOCK_IDS != held:
                    held = at // BLOCK_IDS
                    block = self.block(held)
                stop = min(end, (held + 1) * BLOCK_IDS)
                parts.append(block[at - held * BLOCK_IDS : stop - held * BLOCK_IDS])
                at = stop
            yield doc_id, start, np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int) -> DataFrame:
    """Writes the files; returns their manifest: part, number, name, docs, ids."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = worker_tokenizer(path)
        part = TaskContext.get().partitionId()
        tail = np.array([end_id], np.uint32)
        doc_ids: list[int | None] = []
        ends: list[int] = []
        ids: list[np.ndarray] = []
        total = number = 0

        def finish() -> pa.RecordBatch:
            name = f"part-{part:06d}-{number:06d}.tok"
            with whole_file(folder, name) as stream:
                stream.write(file_bytes(doc_ids, np.array(ends), np.concatenate(ids)))
            row = {"part": part, "number": number, "name": name, "docs": len(doc_ids), "ids": total}
            return pa.RecordBatch.from_pylist([row])

        for batch in batches:
            texts = (text.decode("utf-8", "replace") for text in text_bytes(batch.column("text")))
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), tokenizer.encode_texts(texts), strict=True):
                doc_ids.append(doc_id)
                ids += [found, tail]
                total += len(found) + 1
                ends.append(total)
                if total >= FILE_IDS:
                    yield finish()
                    doc_ids, ends, ids, total, number = [], [], [], 0, number + 1
        if doc_ids:
            yield finish()

    # Equal or null ids are dealt out by the starts of their texts, in the same order.
    by_id, start = F.col("doc_id").asc_nulls_first(), F.substring("text", 1, 64).asc_nulls_first()
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(partitions, by_id, start)
        .sortWithinPartitions(by_id, F.col("text").asc_nulls_first())
    )
    return stored(ordered.mapInArrow(write, "part long, number long, name string, docs long, ids long"), "token-manifest")


def read_token_files(spark, folder: str, manifest: DataFrame) -> DataFrame:
    """One row per document: doc_id, start among all files' ids, n_tokens, ids_crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows = [
                    (doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                    for doc_id, start, ids in TokenFile(content.as_py()).documents()
                ]
                doc_ids, starts, sizes, crcs = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path.rsplit("/", 1)[-1]] * len(rows)),
                        pa.array(doc_ids, pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["name", "doc_id", "start", "n_tokens", "ids_crc32"],
                )

    before = Window.partitionBy(F.lit(0)).orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    offsets = manifest.select("name", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("offset"))
    if manifest.isEmpty():
        files = spark.createDataFrame([], "path string, content binary")
    else:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.tok").load(folder)
    rows = files.select("path", "content").mapInArrow(
        read, "name string, doc_id long, start long, n_tokens long, ids_crc32 long"
    )
    return rows.join(offsets, "name").select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_file_report(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Writes the token files of docs to the shared folder and reads them back."""
    folder = shared_folder(docs.sparkSession, "token-files")
    return read_token_files(docs.sparkSession, folder, write_token_files(docs, folder, path, end_id))
