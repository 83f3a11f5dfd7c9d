"""Documents' tokens packed into sequences of bounded length by bounded-space online best fit.

A packer holds a fixed number of open bins.  Their free spaces are the set bits of one whole number,
so the bin that fits a piece best is the lowest set bit from the piece's length on.  If none fits
and all bins are open, the fullest is closed; a full bin closes at once.

Each task packs its own documents, in the order of its input; only longer documents are cut, into
pieces of whole sequences and a shorter last one.  What is still in open bins at a task's
end is packed again, by lots of `LOT` tasks, so that the ends of small partitions fill up too;
those rows carry no text and are few: what a fixed number of bins holds.

Defined results: an empty or null text has the end id alone; repeated rows and ids are packed each;
an empty table gives an empty result; other columns are not read; a very long text is cut, its
pieces follow each other in numbers, not in sequences.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guardwork.llm.shared import stored
from guardwork.llm.word_pieces import worker_tokenizer
from guardwork.llm.words import text_bytes

OPEN_BINS = 256
#: Tasks whose open bins are packed again together.
LOT = 64


class Bin:
    __slots__ = ("number", "pieces", "free")

    def __init__(self, number: int, free: int):
        self.number, self.free, self.pieces = number, free, []


class BestFit:
    """Open bins by free space; `put` returns the bins that it closes."""

    def __init__(self, size: int, most: int = OPEN_BINS):
        self.size, self.most = size, most
        self.spaces = 0  # bit f is set if a bin with free space f is open
        self.bins: defaultdict[int, list[Bin]] = defaultdict(list)
        self.n_open = self.n_bins = 0

    def _take(self, free: int) -> Bin:
        found = self.bins[free].pop()
        if not self.bins[free]:
            self.spaces ^= 1 << free
        self.n_open -= 1
        return found

    def put(self, length: int, piece: object) -> list[Bin]:
        """Places a piece of 1 to `size`."""
        closed = []
        fits = self.spaces >> length
        if fits:
            bin_ = self._take(length + (fits & -fits).bit_length() - 1)
        else:
            if self.n_open == self.most:
                closed.append(self._take((self.spaces & -self.spaces).bit_length() - 1))
            bin_ = Bin(self.n_bins, self.size)
            self.n_bins += 1
        bin_.pieces.append((piece, self.size - bin_.free))
        bin_.free -= length
        if not bin_.free:
            closed.append(bin_)
        else:
            self.bins[bin_.free].append(bin_)
            self.spaces |= 1 << bin_.free
            self.n_open += 1
        return closed

    def still_open(self) -> list[Bin]:
        """All open bins, the fullest first."""
        return [b for free in sorted(self.bins) for b in self.bins[free]]


class Piece(NamedTuple):
    doc_id: int | None
    piece: int
    start: int
    length: int
    ids_crc32: int
    ids: bytes | None = None


def pieces_of(doc_id: int | None, ids: np.ndarray, size: int, keep_ids: bool) -> Iterator[Piece]:
    for number, start in enumerate(range(0, len(ids), size)):
        raw = ids[start : start + size].astype("<u4").tobytes()
        yield Piece(doc_id, number, start, len(raw) // 4, zlib.crc32(raw), raw if keep_ids else None)


_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("ids", pa.binary()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("task", pa.int64()),
        ("closed", pa.bool_()),
    ]
)
_COLUMNS = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, sequence_id long, offset long"


def _rows(bins: list[Bin], task: int, closed: bool, again: bool = False) -> pa.RecordBatch:
    """Sequences are numbered by task; those packed again have the next bit set."""
    base = task << 32 | int(again) << 62
    columns: list[list] = [[] for _ in _SCHEMA]
    for bin_ in bins:
        for piece, offset in bin_.pieces:
            for column, value in zip(columns, (*piece, base | bin_.number, offset, task, closed), strict=True):
                column.append(value)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)


#: Bins whose rows are sent on together.
_SENT = 64


def pack(docs: DataFrame, path: str, end_id: int, size: int, keep_ids: bool = False) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, ids (little-endian, if asked for),
    sequence_id and offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, packer, done = worker_tokenizer(path), BestFit(size), []
        task, end = TaskContext.get().partitionId(), np.array([end_id], np.uint32)
        for batch in batches:
            texts = (text.decode("utf-8", "replace") for text in text_bytes(batch.column("text")))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tokenizer.encode_texts(texts), strict=True):
                for piece in pieces_of(doc_id, np.concatenate((ids, end)), size, keep_ids):
                    done += packer.put(piece.length, piece)
                if len(done) >= _SENT:
                    yield _rows(done, task, True)
                    done = []
        yield _rows(done, task, True)
        yield _rows(packer.still_open(), task, False)

    def again(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("task", "ascending"), ("sequence_id", "ascending"), ("offset", "ascending")])
        packer, done = BestFit(size), []
        names = list(Piece._fields)
        for values in zip(*(rows.column(name).to_pylist() for name in names), strict=True):
            piece = Piece(*values)
            done += packer.put(piece.length, piece)
        lot = rows.column("lot")[0].as_py()
        out = _rows([*done, *packer.still_open()], lot, True, again=True)
        return pa.Table.from_batches([out]).select([f.split()[0] for f in _COLUMNS.split(", ")])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    packed = stored(texts.mapInArrow(run, f"{_COLUMNS}, task long, closed boolean"), "packed")
    names = [f.split()[0] for f in _COLUMNS.split(", ")]
    lots = packed.where("NOT closed").withColumn("lot", F.expr(f"task div {LOT}"))
    return packed.where("closed").select(*names).unionByName(lots.groupBy("lot").applyInArrow(again, _COLUMNS))
