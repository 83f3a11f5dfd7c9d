"""Two tokenizers aligned on each text: overlaps, groups, links, and how often links occur.

Both cut the same bytes.  Per block of texts `merge_asof`, keyed by document, finds for each token
start of one side the token of the other side that covers it; both directions together are all
overlaps.  Where overlapping tokens end at the same byte, a group ends.  All token pairs within a group
are links; an id pair's count is the number of documents that hold it linked.

Counts.  Documents are taken in chunks of some megabytes.  A chunk's distinct pairs are counted
by its task, so a pair that every document holds is one row a chunk; these rows are summed by
pair, and the sums go back to the chunks that asked for them, where they meet the chunk's documents.
No table of all pairs is sent anywhere.  Only the highest count of each first id is broadcast: a row an
id at most, so its bound is the vocabulary.

Defined results: null and empty texts, and texts whose tokens on either side do not spell a space
and the text, have no tokens; repeated rows and ids count as documents of their own; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guardwork.llm.shared import stored
from guardwork.llm.text_tokens import worker_byte_tokens, worker_piece_tokens
from guardwork.llm.words import text_bytes

#: Bytes of text that are aligned at once, and whose links are counted together.
BLOCK_BYTES = 1 << 19
CHUNK_BYTES = 1 << 23
#: Groups of more links are reduced to their distinct ids first.
LARGE_GROUP = 1 << 8
#: Links that are held at once.
SLICE_LINKS = 1 << 20

PAIR_BITS = 31
_B_BITS = 15


class Tokens(NamedTuple):
    """Of a block: ids, documents (ascending, from 0) and starts (bytes, over the whole block)."""

    ids: np.ndarray
    docs: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def block_tokens(ids: list[np.ndarray], lengths: np.ndarray) -> Tokens:
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    ends = np.cumsum(lengths[flat])
    return Tokens(flat, np.repeat(np.arange(len(ids)), [len(x) for x in ids]), ends - lengths[flat], ends)


def _covering(side: Tokens, other: Tokens) -> np.ndarray:
    """For each token of a side the other side's token that covers its start."""
    starts = pd.DataFrame({"at": side.starts, "doc": side.docs})
    covers = pd.DataFrame({"at": other.starts, "doc": other.docs, "cover": np.arange(len(other.ids))})
    return pd.merge_asof(starts, covers, on="at", by="doc")["cover"].to_numpy(np.int64)


def overlaps(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of overlapping tokens, as indices into both sides, once each."""
    over_a, over_b = _covering(a, b), _covering(b, a)
    # Pairs that start together are found from both sides.
    inner = np.flatnonzero(a.starts[over_b] != b.starts)
    return np.concatenate((np.arange(len(over_a)), over_b[inner])), np.concatenate((over_a, inner))


class Groups(NamedTuple):
    """Each token's group, and the first token of each group and the number of all, by side."""

    of_a: np.ndarray
    of_b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray


def groups(a: Tokens, b: Tokens) -> Groups:
    pair_a, pair_b = overlaps(a, b)
    together = a.ends[pair_a] == b.ends[pair_b]
    found = []
    for size, last in ((len(a.ids), pair_a[together]), (len(b.ids), pair_b[together])):
        ends = np.zeros(size, np.int64)
        ends[last] = 1
        found.append((np.cumsum(ends) - ends, np.concatenate(([0], np.flatnonzero(ends) + 1))))
    (of_a, first_a), (of_b, first_b) = found
    return Groups(of_a, of_b, first_a, first_b)


class Texts(NamedTuple):
    """Ids in decimal for writing: digits padded by zero bytes, and how many there are."""

    digits: np.ndarray
    sizes: np.ndarray


def id_texts(n: int) -> Texts:
    width = len(str(n))
    digits = np.char.encode(np.arange(n).astype(f"U{width}")).astype(f"S{width}").view(np.uint8).reshape(n, width)
    return Texts(digits, (digits > 0).sum(axis=1))


def group_texts(a: Tokens, b: Tokens, found: Groups, texts: Texts, docs: int) -> list[bytes]:
    """Of each document `a1,a2|b1;a3|b2,b3`."""
    n_a, n_b = len(a.ids), len(b.ids)
    at_a = np.arange(n_a) + found.first_b[found.of_a]
    at_b = np.arange(n_b) + found.first_a[found.of_b + 1]
    ids = np.empty(n_a + n_b, np.int64)
    ids[at_a], ids[at_b] = a.ids, b.ids
    rows = np.empty((n_a + n_b, texts.digits.shape[1] + 1), np.uint8)
    rows[:, :-1] = texts.digits[ids]
    rows[:, -1] = ord(",")
    rows[at_a[found.first_a[1:] - 1], -1] = ord("|")
    rows[at_b[found.first_b[1:] - 1], -1] = ord(";")
    flat = rows[rows > 0].tobytes()
    sizes = np.bincount(a.docs, texts.sizes[a.ids] + 1, docs) + np.bincount(b.docs, texts.sizes[b.ids] + 1, docs)
    ends = np.cumsum(sizes.astype(np.int64)).tolist()
    return [flat[start : max(start, end - 1)] for start, end in zip([0, *ends], ends, strict=False)]


class Links(NamedTuple):
    """Documents and id pairs, ascending and distinct, with the number of their links."""

    docs: np.ndarray
    pairs: np.ndarray
    links: np.ndarray


def _summed(keys: np.ndarray, links: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    if links is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, links = keys[order], links[order]
    new = np.concatenate(([True], keys[1:] != keys[:-1]))[: len(keys)]
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(keys))) if links is None else np.add.reduceat(links, starts) if len(starts) else links
    return keys[starts], sizes


def _distinct_ids(ids: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups, distinct ids within each, and how often they occur."""
    keys, times = np.unique(group << 32 | ids, return_counts=True)
    return keys >> 32, keys & (1 << 32) - 1, times


def links(a: Tokens, b: Tokens, found: Groups) -> Links:
    size_a, size_b = np.diff(found.first_a), np.diff(found.first_b)
    large = size_a * size_b > LARGE_GROUP
    keys, times = [], []
    # Tokens of ordinary groups meet each token of the other side; those of large ones each distinct id.
    left, right = ~large[found.of_a], ~large[found.of_b]
    parts = [(a.docs[left], found.of_a[left], a.ids[left], None, found.of_b[right], b.ids[right], None)]
    if large.any():
        doc_of = a.docs[found.first_a[:-1]]
        group_a, ids_a, times_a = _distinct_ids(a.ids[~left], found.of_a[~left])
        group_b, ids_b, times_b = _distinct_ids(b.ids[~right], found.of_b[~right])
        parts.append((doc_of[group_a], group_a, ids_a, times_a, group_b, ids_b, times_b))
    for docs, of_a, ids_a, times_a, of_b, ids_b, times_b in parts:
        first = np.searchsorted(of_b, of_a)
        meets = np.searchsorted(of_b, of_a, "right") - first
        done = np.concatenate(([0], np.cumsum(meets)))
        start = 0
        while start < len(of_a):
            end = max(start + 1, int(np.searchsorted(done, done[start] + SLICE_LINKS, "right")) - 1)
            many = meets[start:end]
            other = np.repeat(first[start:end] - (done[start:end] - done[start]), many) + np.arange(done[end] - done[start])
            key = np.repeat(docs[start:end] << PAIR_BITS | ids_a[start:end] << _B_BITS, many) | ids_b[other]
            weight = None if times_a is None else np.repeat(times_a[start:end], many) * times_b[other]
            for out, value in zip((keys, times), _summed(key, weight), strict=True):
                out.append(value)
            start = end
    if not keys:
        return Links(*[np.zeros(0, np.int64)] * 3)
    key, number = (keys[0], times[0]) if len(keys) == 1 else _summed(np.concatenate(keys), np.concatenate(times))
    return Links(key >> PAIR_BITS, key & (1 << PAIR_BITS) - 1, number)


class Aligner:
    """Aligns blocks of texts; ids of the first tokenizer must be below 2^16, of the second below 2^15."""

    def __init__(self, byte_path: str, pattern: str, piece_path: str):
        self.a, self.b = worker_byte_tokens(byte_path, pattern), worker_piece_tokens(piece_path)
        self.lengths = self.a.lengths(), self.b.lengths()
        if len(self.lengths[0]) > 1 << PAIR_BITS - _B_BITS or len(self.lengths[1]) > 1 << _B_BITS:
            raise ValueError("a vocabulary is too large for the pairs")
        self.texts = id_texts(max(map(len, self.lengths)))

    def tokens(self, texts: list[str]) -> tuple[Tokens, Tokens]:
        ids: tuple[list, list] = [], []
        none = np.zeros(0, np.int64)
        for text in texts:
            a = self.a.encode(" " + text) if text else None
            b = None if a is None else self.b.encode(" " + text)
            ids[0].append(none if b is None else a)
            ids[1].append(none if b is None else b)
        return block_tokens(ids[0], self.lengths[0]), block_tokens(ids[1], self.lengths[1])


def _sized(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[list, list[str]]]:
    """doc_ids and texts of successive rows, up to so many bytes; a longer text comes alone."""
    doc_ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), text_bytes(batch.column("text")), strict=True):
            if size and size + len(text) > limit:
                yield doc_ids, texts
                doc_ids, texts, size = [], [], 0
            doc_ids.append(doc_id)
            texts.append(text.decode("utf-8", "replace"))
            size += len(text) + 1
    if doc_ids:
        yield doc_ids, texts


def align(docs: DataFrame, byte_path: str, pattern: str, piece_path: str) -> DataFrame:
    """Per document the tokens of both sides (`a_ids`, `b_ids`) and the group of each (`a_group`, `b_group`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_path, pattern, piece_path)
        for doc_ids, texts in _sized(batches, BLOCK_BYTES):
            a, b = aligner.tokens(texts)
            found = groups(a, b)
            columns = [pa.array(doc_ids, pa.int64())]
            for side, of in ((a, found.of_a), (b, found.of_b)):
                offsets = np.searchsorted(side.docs, np.arange(len(texts) + 1))
                # Groups are numbered over the block; a document's start at 0.
                start = of[offsets[:-1][side.docs]] if len(of) else of
                lists = [pa.array(offsets.astype(np.int32))] * 2
                columns += [
                    pa.ListArray.from_arrays(o, pa.array(v.astype(np.int32)))
                    for o, v in zip(lists, (side.ids, of - start), strict=True)
                ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "a_ids", "a_group", "b_ids", "b_group"])

    schema = "doc_id long, a_ids array<int>, a_group array<int>, b_ids array<int>, b_group array<int>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


_FIGURES = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
#: A row a document with its distinct pairs, and behind each chunk one with the chunk's pairs and in how many documents each is.
_LINKED = f"chunk long, {_FIGURES}, pairs array<int>, links array<int>, of_chunk boolean"
_NAMES = [part.split()[0] for part in _LINKED.split(", ")]


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(values.astype(np.int32)))


def linked_documents(docs: DataFrame, byte_path: str, pattern: str, piece_path: str) -> DataFrame:
    """Documents with their links, and the chunks' pairs."""
    block_bytes, chunk_bytes = BLOCK_BYTES, CHUNK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_path, pattern, piece_path)
        part = TaskContext.get().partitionId()
        number = size = 0
        held: list[np.ndarray] = []  # pairs of the chunk, once a document

        def chunk_row() -> pa.RecordBatch:
            pairs, documents = np.unique(np.concatenate(held), return_counts=True)
            nothing = [pa.nulls(1, pa.int64())] * 5 + [pa.nulls(1, pa.string())]
            columns = [pa.array([chunk]), *nothing, _lists(pairs, np.array([len(pairs)])), _lists(documents, np.array([len(pairs)])), pa.array([True])]
            return pa.RecordBatch.from_arrays(columns, names=_NAMES)

        chunk = part << 32
        for doc_ids, texts in _sized(batches, block_bytes):
            a, b = aligner.tokens(texts)
            found = groups(a, b)
            link = links(a, b, found)
            n = len(texts)
            counts = [np.bincount(side.docs, minlength=n) for side in (a, b)]
            n_groups = np.bincount(a.docs[found.first_a[:-1]], minlength=n)
            n_links = np.zeros(n, np.int64)
            np.add.at(n_links, link.docs, link.links)
            digests = [hashlib.sha256(t).hexdigest() if t else "" for t in group_texts(a, b, found, aligner.texts, n)]
            ends = np.searchsorted(link.docs, np.arange(n), "right")
            columns = [pa.array(np.full(n, chunk)), pa.array(doc_ids, pa.int64())]
            columns += [pa.array(c.astype(np.int64)) for c in (*counts, n_groups, n_links)]
            columns += [pa.array(digests, pa.string()), _lists(link.pairs, ends), _lists(link.links, ends)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([False] * n)], names=_NAMES)
            held.append(link.pairs)
            size += sum(map(len, texts))
            if size >= chunk_bytes:
                yield chunk_row()
                number, size, held = number + 1, 0, []
                chunk = part << 32 | number
        if held:
            yield chunk_row()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, _LINKED)


def _totals(documents: pa.Table, counts: pa.Table) -> pa.Table:
    """Of a chunk's documents: links of the highest count, and the sum of counts."""
    order = np.argsort(counts.column("pair").to_numpy())
    known = counts.column("pair").to_numpy()[order]
    documents = documents.combine_chunks()
    pairs = documents.column("pairs").combine_chunks()
    at = np.searchsorted(known, pairs.flatten().to_numpy())
    number = documents.column("links").combine_chunks().flatten().to_numpy().astype(np.int64)
    sizes = pairs.value_lengths().to_numpy()
    out = {}
    for name, values in (("n_best", counts.column("best").to_numpy()), ("count_sum", counts.column("documents").to_numpy())):
        sums = np.concatenate(([0], np.cumsum(values[order][at].astype(np.int64) * number)))
        ends = np.cumsum(sizes)
        out[name] = pa.array(sums[ends] - sums[ends - sizes], pa.int64())
    kept = documents.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    columns = [*kept.columns, out["n_best"], out["count_sum"], documents.column("groups_sha256")]
    return pa.Table.from_arrays(columns, names=[*kept.column_names, "n_best", "count_sum", "groups_sha256"])


def alignment_report(docs: DataFrame, byte_path: str, pattern: str, piece_path: str) -> DataFrame:
    """Per document its tokens, groups and links, with the counts of its links over all documents."""
    linked = stored(linked_documents(docs, byte_path, pattern, piece_path), "linked-documents")
    asked = linked.where("of_chunk").select(
        "chunk", F.explode(F.arrays_zip("pairs", "links")).alias("found")
    ).select("chunk", F.col("found.pairs").alias("pair"), F.col("found.links").alias("documents"))
    counts = asked.groupBy("pair").agg(F.sum("documents").cast("long").alias("documents"))
    highest = counts.groupBy(F.shiftright("pair", _B_BITS).alias("a")).agg(F.max("documents").alias("highest"))
    answers = (
        asked.select("chunk", "pair")
        .join(counts, "pair")
        .withColumn("a", F.shiftright("pair", _B_BITS))
        .join(F.broadcast(highest), "a")
        .select(F.col("chunk").alias("asked_by"), "pair", "documents", (F.col("documents") == F.col("highest")).cast("int").alias("best"))
    )
    rows = linked.where("NOT of_chunk").drop("of_chunk")
    return (
        rows.groupBy("chunk")
        .cogroup(answers.groupBy("asked_by"))
        .applyInArrow(
            _totals,
            "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string",
        )
    )
