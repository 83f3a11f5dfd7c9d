"""Removal of repeated byte strings by sorting suffixes.

Every byte covered by a string of `length` bytes that starts anywhere else too, in any
document, is removed.  Strings never cross documents.

Suffixes are sorted where they can meet, not all in one place.  Each start of a string has
an anchor: of the `anchor`-byte strings inside it, the one of smallest hash, leftmost if
tied.  Equal strings have equal anchors at equal places, so starts are dealt out by anchor.
Successive starts of one anchor are a run, whose bytes are passed on once.

* Anchors that occur once have no repeats; that needs hashes only.
* Runs of equal bytes are counted (combined before the shuffle): two or more are repeats
  throughout, however many there are.
* The different runs of an anchor are compared by their suffixes: a merge sort whose
  comparisons find the common extension of two suffixes by binary search over prefix
  hashes, so that each takes about log2(length) steps.  Neighbours that agree in `length`
  bytes are repeats; their bytes are compared as well, and a collision leads to a
  comparison of bytes alone.
* An anchor with more than `MOST_RUNS` different runs is not sorted in one task.  Its runs
  are dealt out anew by longer anchors, the last as long as the strings themselves, where
  every string is its own run and equal ones have been counted.

Defined results: a null text is empty; a text under `length` bytes has no repeats; rows
that repeat a text repeat its strings, with or without equal ids; a null id is carried along; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guardwork.llm.grouping import runs_of_groups
from guardwork.llm.shared import stored
from guardwork.llm.worker_memory import at_work
from guardwork.llm.words import BLOCK_BYTES, mixed, powers, prefix_hashes, range_hashes

#: Different runs of an anchor that are sorted in one task.
MOST_RUNS = 512
#: Anchor lengths for strings of `length` bytes, as parts of it; each deals out what the one before left.
ANCHORS = (0.32, 0.96, 1.0)
#: Starts of strings that are looked at together.
_PIECE = 1 << 20
_SORT_BYTES = 1 << 21
_PART_ROWS = 512
_SORT_RUNS = 512  # of successive anchors, sorted together
_PLACE_BITS = 24


class Runs:
    """Runs of starts in `data`: first start, starts, anchor's hash and place, hash of the bytes."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, length: int, anchor: int):
        sums = prefix_hashes(data)
        hashes = range_hashes(sums, np.arange(len(data) - anchor + 1), np.arange(anchor, len(data) + 1))
        place = np.arange(len(hashes), dtype=np.uint64)
        key = (hashes >> np.uint64(_PLACE_BITS)) << np.uint64(_PLACE_BITS) | place
        least = _window_minimum(key, length - anchor + 1)
        at = (least & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        # Of each text, the starts of strings that end within it.
        long = np.flatnonzero(lengths >= length)
        counts = lengths[long] - length + 1
        text = np.repeat(long, counts)
        start = np.repeat(starts[long] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(len(text))
        new = np.ones(len(start), bool)
        new[1:] = (text[1:] != text[:-1]) | (at[start[1:]] != at[start[:-1]])
        first = np.flatnonzero(new)
        self.text = text[first]
        self.start = start[first]
        self.starts = np.diff(np.append(first, len(start)))
        self.at = at[self.start] - self.start
        self.anchor = hashes[at[self.start]].view(np.int64)
        ends = self.start + self.starts - 1 + length
        self.content = mixed(range_hashes(sums, self.start, ends) + self.starts.astype(np.uint64)).view(np.int64)


def _window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` successive values, from running minima within blocks."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def _blocks(texts: list[bytes], length: int) -> Iterator[tuple[list[int], list[int], np.ndarray, np.ndarray, np.ndarray]]:
    """Some texts at a time: their indices, where each part begins in its text, and the bytes with
    starts and lengths.  A very long text comes in parts that overlap by length - 1 bytes."""
    index: list[int] = []
    begins: list[int] = []
    parts: list[bytes] = []
    size = 0

    def block():
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        return index, begins, np.frombuffer(b"".join(parts), np.uint8), starts, lengths

    for i, text in enumerate(texts):
        if len(text) < length:
            continue
        for begin in range(0, len(text) - length + 1, _PIECE):
            part = text[begin : begin + _PIECE + length - 1]
            if parts and size + len(part) > BLOCK_BYTES:
                yield block()
                index, begins, parts, size = [], [], [], 0
            index.append(i)
            begins.append(begin)
            parts.append(part)
            size += len(part)
    if parts:
        yield block()


def _bytes(column: pa.Array) -> list[bytes]:
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of few rows: texts and lists of runs are many times larger as Python's objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, _PART_ROWS):
            yield batch.slice(start, _PART_ROWS)


_RUN = "key_a long, key_b long, start int, starts int, at int, anchor long, content long"


def _runs(units: DataFrame, length: int, anchor: int) -> DataFrame:
    """The runs of all units (key_a, key_b, text)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("suffix_repeats")
        for batch in _parts(batches):
            for index, begins, data, starts, lengths in _blocks(_bytes(batch.column("text")), length):
                runs = Runs(data, starts, lengths, length, anchor)
                rows = pa.array(np.array(index)[runs.text])
                begin = runs.start - starts[runs.text] + np.array(begins)[runs.text]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key_a").take(rows),
                        batch.column("key_b").take(rows),
                        pa.array(begin.astype(np.int32)),
                        pa.array(runs.starts.astype(np.int32)),
                        pa.array(runs.at.astype(np.int32)),
                        pa.array(runs.anchor),
                        pa.array(runs.content),
                    ],
                    names=["key_a", "key_b", "start", "starts", "at", "anchor", "content"],
                )

    return units.select("key_a", "key_b", "text").mapInArrow(find, _RUN)


def _same_unit(left: str, right: str) -> F.Column:
    return F.col(f"{left}.key_a").eqNullSafe(F.col(f"{right}.key_a")) & (
        F.col(f"{left}.key_b") == F.col(f"{right}.key_b")
    )


def _with_bytes(units: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """anchor, content, copies, at, starts and bytes of runs, cut out of their units."""
    lists = (
        runs.groupBy("key_a", "key_b")
        .agg(F.collect_list(F.struct("start", "starts", "at", "anchor", "content", "copies")).alias("runs"))
        .hint("shuffle_hash")
    )
    joined = units.alias("u").join(lists.alias("r"), _same_unit("u", "r")).select("u.text", "r.runs")
    schema = "anchor long, content long, copies long, at int, starts int, bytes binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("suffix_repeats")
        for batch in _parts(batches):
            rows: list[tuple] = []
            size = 0
            for text, runs in zip(_bytes(batch.column("text")), batch.column("runs").to_pylist(), strict=True):
                for r in runs:
                    part = text[r["start"] : r["start"] + r["starts"] - 1 + length]
                    rows.append((r["anchor"], r["content"], r["copies"], r["at"], r["starts"], part))
                    size += len(part)
                if size > _SORT_BYTES:
                    yield _cut_batch(rows)
                    rows, size = [], 0
            if rows:
                yield _cut_batch(rows)

    return joined.mapInArrow(cut, schema)


def _cut_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    columns = [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["anchor", "content", "copies", "at", "starts", "bytes"])


class Suffixes:
    """Comparison of the suffixes of some bytes, up to `length` bytes each."""

    def __init__(self, data: np.ndarray, length: int):
        self.data = data
        self.length = length
        self.sums = prefix_hashes(data)
        self.down = powers(len(self.sums))[1]

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes a and b: the longest with equal hashes."""
        low = np.zeros(len(a), np.int64)
        step = 1 << (self.length.bit_length() - 1)
        base_a, base_b = self.sums[a], self.sums[b]
        down_a, down_b = self.down[a], self.down[b]
        while step:
            tried = low + step
            inside = tried <= self.length
            stop = np.minimum(tried, self.length)
            same = (self.sums[a + stop] - base_a) * down_a == (self.sums[b + stop] - base_b) * down_b
            low = np.where(inside & same, tried, low)
            step >>= 1
        return low

    def less(self, a: np.ndarray, b: np.ndarray, or_equal: bool) -> np.ndarray:
        common = self.extension(a, b)
        apart = common < self.length
        last = np.minimum(common, self.length - 1)
        below = self.data[a + last] < self.data[b + last]
        return np.where(apart, below, or_equal)

    def sorted_within(self, at: np.ndarray, sets: np.ndarray) -> np.ndarray:
        """The suffixes `at`, each set (numbers in ascending order) sorted by merging.

        All sets are merged together: blocks of 1, 2, 4, ... suffixes within their set.  The
        place of a suffix is its own plus the number of suffixes of the other block before it.
        """
        at = at.copy()
        n = len(at)
        first = np.searchsorted(sets, sets)
        last = np.searchsorted(sets, sets, side="right")
        largest = int((last - first).max(initial=0))
        width = 1
        while width < largest:
            place = np.arange(n) - first
            block = place // width
            is_left = block % 2 == 0
            other = np.where(is_left, block + 1, block - 1)
            low = np.minimum(first + other * width, last)
            high = np.minimum(low + width, last)
            bottom = low.copy()
            for side in (True, False):
                rows = np.flatnonzero((is_left == side) & (low < high))
                lo, hi = low[rows], high[rows]
                while len(rows):
                    middle = (lo + hi) // 2
                    # Equal suffixes keep their order, those of the left block first.
                    before = self.less(at[middle], at[rows], or_equal=not side)
                    lo, hi = np.where(before, middle + 1, lo), np.where(before, hi, middle)
                    done = lo >= hi
                    bottom[rows[done]] = lo[done]
                    rows, lo, hi = rows[~done], lo[~done], hi[~done]
            start = first + (block - block % 2) * width
            target = start + place % width + (bottom - low)
            moved = np.empty_like(at)
            moved[target] = at
            at = moved
            width *= 2
        return at


def repeated_starts(
    group: np.ndarray, at: np.ndarray, starts: np.ndarray, contents: list[bytes], length: int
) -> np.ndarray:
    """For the starts of all runs one after the other: does the string occur in another run too?

    group: the runs' anchor numbers; at: where the anchor is in the run.
    """
    sizes = np.fromiter(map(len, contents), np.int64, len(contents))
    base = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    data = np.frombuffer(b"".join(contents), np.uint8)
    run = np.repeat(np.arange(len(starts)), starts)
    offset = np.arange(len(run)) - np.repeat(np.cumsum(starts) - starts, starts)
    # Equal strings have their anchor at the same place, so only those are in one set.
    order = np.lexsort((at[run] - offset, group[run]))
    ahead = (at[run] - offset)[order]
    group_of = group[run][order]
    new = np.ones(len(order), bool)
    new[1:] = (group_of[1:] != group_of[:-1]) | (ahead[1:] != ahead[:-1])
    sets = np.cumsum(new) - 1
    shared = np.bincount(sets)[sets] > 1
    order, sets = order[shared], sets[shared]
    flags = np.zeros(len(run), bool)
    if not len(order):
        return flags
    position = base[run] + offset
    number = np.empty(len(data), np.int64)  # of the start at a position
    number[position] = np.arange(len(run))
    suffixes = Suffixes(data, length)
    found = suffixes.sorted_within(position[order], sets)
    a, b = found[:-1], found[1:]
    neighbours = np.flatnonzero(sets[:-1] == sets[1:])
    a, b = a[neighbours], b[neighbours]
    equal = suffixes.extension(a, b) >= length
    a, b = number[a[equal]], number[b[equal]]
    if not _bytes_agree(run, offset, base, contents, a, b, length):
        return _by_bytes(run, offset, contents, length)
    flags[a] = True
    flags[b] = True
    return flags


def _bytes_agree(run, offset, base, contents, a, b, length) -> bool:
    """Are the strings that start at a and b equal?  Successive starts of two runs are compared at once."""
    order = np.lexsort((offset[a], run[b], run[a]))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (
        (run[a[1:]] != run[a[:-1]])
        | (run[b[1:]] != run[b[:-1]])
        | (offset[a[1:]] != offset[a[:-1]] + 1)
        | (offset[b[1:]] != offset[b[:-1]] + 1)
    )
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(a))) - 1 + length
    for i, j, n in zip(a[first].tolist(), b[first].tolist(), size.tolist(), strict=True):
        x, y = offset[i], offset[j]
        if contents[run[i]][x : x + n] != contents[run[j]][y : y + n]:
            return False
    return True


def _by_bytes(run, offset, contents, length) -> np.ndarray:
    """The same without hashes, for the case that two strings' hashes collide."""
    strings = [contents[r][o : o + length] for r, o in zip(run.tolist(), offset.tolist(), strict=True)]
    seen = Counter(strings)
    return np.array([seen[s] > 1 for s in strings])


_FOUND = "anchor long, content long, stretches array<struct<low: int, high: int>>"


def _lots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of whole anchors, up to `_SORT_RUNS` besides the last anchor's: a batch holds many times more."""
    for whole, starts in runs_of_groups(batches, ["anchor"], _SORT_RUNS):
        first = 0
        while first < whole.num_rows:
            end = int(starts[min(np.searchsorted(starts, first + _SORT_RUNS), len(starts) - 1)])
            yield whole.slice(first, end - first)
            first = end


def _sorted_runs(cut: DataFrame, length: int) -> DataFrame:
    """Stretches low..high-1 of repeated starts in runs that occur once, a row for each run."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("suffix_repeats")
        for whole in _lots(batches):
            anchors, content, copies = (whole.column(c).to_numpy() for c in ("anchor", "content", "copies"))
            starts, at = (whole.column(c).to_numpy().astype(np.int64) for c in ("starts", "at"))
            # A unit that occurs twice has been cut twice.
            chosen = np.unique(np.stack((anchors, content)), axis=1, return_index=True)[1]
            chosen.sort()
            contents = whole.column("bytes").take(pa.array(chosen)).to_pylist()
            flags = repeated_starts(anchors[chosen], at[chosen], starts[chosen], contents, length)
            run = np.repeat(np.arange(len(chosen)), starts[chosen])
            flags &= (copies[chosen] == 1)[run]
            edge = np.ones(len(run) + 1, bool)
            edge[1:-1] = (run[1:] != run[:-1]) | (flags[1:] != flags[:-1])
            edges = np.flatnonzero(edge)
            low, high = edges[:-1], edges[1:]
            low, high = low[flags[low]], high[flags[low]]
            if len(low):
                origin = (np.cumsum(starts[chosen]) - starts[chosen])[run[low]]
                of_run, first = np.unique(run[low], return_index=True)
                stretches = pa.StructArray.from_arrays(
                    [pa.array((edge - origin).astype(np.int32)) for edge in (low, high)], names=["low", "high"]
                )
                offsets = pa.array(np.append(first, len(low)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchors[chosen[of_run]]),
                        pa.array(content[chosen[of_run]]),
                        pa.ListArray.from_arrays(offsets, stretches),
                    ],
                    names=["anchor", "content", "stretches"],
                )

    return cut.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(sort, _FOUND)


def repeated(units: DataFrame, length: int, level: int = 0) -> DataFrame:
    """key_a, key_b, stretches: the starts of repeated strings, a row for each run of a unit.

    units: key_a, key_b, text; units of equal keys have equal texts.
    """
    anchor = max(1, min(length, round(length * ANCHORS[level])))
    runs = stored(_runs(units, length, anchor), "runs")
    # Written, so that the join is of two shuffles, of which a hot anchor's can be split.
    twice = stored(runs.groupBy("anchor").count().where("count > 1").select("anchor"), "anchors-met")
    runs = stored(runs.join(twice, "anchor", "left_semi").select(*runs.columns), "runs-met")
    by_run = ["anchor", "content"]
    firsts = [F.first(c).alias(c) for c in ("key_a", "key_b", "start", "starts", "at")]
    distinct = stored(runs.groupBy(*by_run).agg(F.count(F.lit(1)).alias("copies"), *firsts), "runs-distinct")
    different = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("different")).where("different > 1")
    throughout = F.array(F.struct(F.lit(0).alias("low"), F.col("starts").alias("high")))
    found = distinct.where("copies > 1").select(*by_run, throughout.alias("stretches"))

    compared = distinct.join(different.where(F.col("different") <= MOST_RUNS), "anchor", "left_semi")
    found = found.union(_sorted_runs(_with_bytes(units, compared, length), length))
    crowded = different.where(F.col("different") > MOST_RUNS)
    if level + 1 < len(ANCHORS) and not crowded.isEmpty():
        cut = _with_bytes(units, distinct.join(crowded, "anchor", "left_semi"), length)
        cut = cut.select(F.col("anchor").alias("key_a"), F.col("content").alias("key_b"), F.col("bytes").alias("text"))
        parts = stored(cut.dropDuplicates(["key_a", "key_b"]), "runs-crowded")
        once = distinct.where("copies = 1").select(F.col("anchor").alias("key_a"), F.col("content").alias("key_b"))
        again = repeated(parts, length, level + 1).join(once, ["key_a", "key_b"], "left_semi")
        again = again.groupBy("key_a", "key_b").agg(F.flatten(F.collect_list("stretches")))
        found = found.union(again)

    def moved(stretch):
        return F.struct((F.col("start") + stretch.low).alias("low"), (F.col("start") + stretch.high).alias("high"))

    return runs.join(found, by_run).select("key_a", "key_b", F.transform("stretches", moved).alias("stretches"))


def merged_spans(stretches: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that strings starting at low..high-1 cover."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(stretches):
        end = high - 1 + length
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((low, end))
    return out


def remove_repeats(docs: DataFrame, length: int) -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (removed, from and to), kept (the other bytes)."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    units = docs.select(F.col("doc_id").cast("long").alias("key_a"), F.xxhash64(text).alias("key_b"), text.alias("text"))
    spans = (
        repeated(units, length)
        .groupBy("key_a", "key_b")
        .agg(F.array_distinct(F.flatten(F.collect_list("stretches"))).alias("stretches"))
        .hint("shuffle_hash")
    )
    joined = units.alias("u").join(spans.alias("r"), _same_unit("u", "r"), "left").select("u.key_a", "u.text", "r.stretches")
    schema = "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("suffix_repeats")
        for batch in _parts(batches):
            texts, removed, kept = _bytes(batch.column("text")), [], []
            for text, stretches in zip(texts, batch.column("stretches").to_pylist(), strict=True):
                spans = merged_spans([(s["low"], s["high"]) for s in stretches or ()], length)
                edges = [0, *(e for span in spans for e in span), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                removed.append([{"start": a, "end": b} for a, b in spans])
            sizes = pa.array(map(len, texts), pa.int64())
            columns = [batch.column("key_a"), sizes, pa.array(removed, spans_type), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "spans", "kept"])

    return joined.mapInArrow(remove, schema)


def repeats_report(docs: DataFrame, length: int) -> DataFrame:
    """Sizes and digest of what stays, per document, and that text (a letter cut in two is U+FFFD)."""
    return remove_repeats(docs, length).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        F.length("kept").cast("long").alias("n_kept"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
    )
