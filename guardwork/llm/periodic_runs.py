"""Periodic runs of words, found on a harmonic grid and collapsed to their first period.

A run is a stretch of words that repeats itself: words q apart are equal, q is the least such
distance, the stretch holds at least `repeats` periods and `words` words, and no neighbouring word
extends it.

For each period q the grid points 0, q, 2q, ... are compared with the next ones; over all q these
are n log n pairs.  A run of four periods or more holds at least three neighbouring grid points that
equal the next one, so only every third point of such a streak is looked at: its longest common
extensions (LCE) to both sides with the point q further give the run.

LCE.  Of all positions, those in a difference cover (a few residues modulo `MODULUS` whose
differences are all residues) are sampled, and only their suffixes are sorted: first by
`MODULUS` words, then by doubling.  Any two positions reach sampled ones together after fewer than
`MODULUS` words, which are compared one by one; from there on the least common prefix between
their ranks answers, by a sparse table.  Both are built only for documents in which a streak
was found, over the words and over the words backwards.

Defined results: words are the longest stretches without space, tab to carriage return; null,
empty and blank texts have no words, no runs and an empty collapsed text; a text without runs
comes back with its words joined by one space; words are compared exactly, as bytes; rows are
judged one by one, so repeated rows agree; other columns are kept, but for the two that are
written.  A document is held by one task; beside its words that takes some dozen bytes a word.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from guardwork.llm.words import text_bytes

#: Of the difference cover; a power of two.
MODULUS = 32
#: Grid pairs that are compared at once.
PAIRS = 1 << 18

RUN = T.StructType([T.StructField(name, T.LongType(), False) for name in ("start", "length", "period")])


@lru_cache(maxsize=4)
def difference_cover(modulus: int) -> tuple[np.ndarray, np.ndarray]:
    """Residues whose differences are all residues, and for each difference d a residue x of the
    cover such that x + d is in it as well.  Grown greedily by the residue that adds most differences."""
    cover, missing = [0], set(range(1, modulus))
    while missing:
        def new(x: int) -> int:
            return len(missing & {d % modulus for c in cover for d in (x - c, c - x)})

        best = max(range(modulus), key=lambda x: (new(x), -x))
        missing -= {d % modulus for c in cover for d in (best - c, c - best)}
        cover.append(best)
    anchor = np.array([next(x for x in cover if (x + d) % modulus in cover) for d in range(modulus)])
    return np.array(sorted(cover)), anchor


def _ranked(keys: np.ndarray) -> np.ndarray:
    """Ranks of the keys from 1 on; equal keys share one."""
    return np.unique(keys, return_inverse=True)[1].reshape(keys.shape).astype(np.int64) + 1


class CommonExtensions:
    """Longest common prefixes of the suffixes of a sequence of numbers from 0 on."""

    def __init__(self, words: np.ndarray, modulus: int = MODULUS):
        self.n, self.modulus = len(words), modulus
        cover, self.anchor = difference_cover(modulus)
        # Behind the end stand numbers that no word has, so that no match goes there.
        self.words = np.concatenate((words.astype(np.int64) + 1, np.zeros(modulus, np.int64)))
        sampled = np.zeros(modulus, bool)
        sampled[cover] = True
        at = np.flatnonzero(sampled[np.arange(self.n) % modulus])
        self.number = np.full(self.n + modulus, -1)  # of the sample at a position
        self.number[at] = np.arange(len(at))

        names = self.words[at[:, None] + np.arange(modulus)]
        while names.shape[1] > 1:
            names = _ranked(names[:, ::2] * (names.max(initial=0) + 1) + names[:, 1::2])
        levels, size = [names[:, 0]], modulus
        while len(at) and size < self.n and levels[-1].max() < len(at):
            levels.append(_ranked(levels[-1] * (len(at) + 1) + self._ranks(levels[-1], at + size)))
            size *= 2
        order = np.argsort(levels[-1])
        self.place = np.empty(len(at), np.int64)
        self.place[order] = np.arange(len(at))
        self.table = [self._neighbours(at[order], levels)]
        while 2 << len(self.table) - 1 <= len(self.table[0]):
            low, step = self.table[-1], 1 << len(self.table) - 1
            self.table.append(np.minimum(low[:-step], low[step:]))

    def _ranks(self, ranks: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ranks of the samples at the positions; 0 behind the end."""
        inside = at < self.n
        return np.where(inside, ranks[self.number[np.where(inside, at, 0)]], 0)

    def _neighbours(self, sorted_at: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefixes of each two neighbours among the sorted samples."""
        left, right = sorted_at[:-1], sorted_at[1:]
        found = np.zeros(len(left), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            a, b = self._ranks(levels[k], left + found), self._ranks(levels[k], right + found)
            found += np.where((a == b) & (a > 0), self.modulus << k, 0)
        return found + self._compared(left + found, right + found, np.full(len(left), self.modulus))

    def _compared(self, left: np.ndarray, right: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from both positions on, up to `most` (below the modulus), one by one."""
        found = np.zeros(len(left), np.int64)
        live = np.arange(len(left))
        for step in range(self.modulus):
            live = live[(most[live] > step)]
            live = live[np.maximum(left[live], right[live]) + step < self.n]
            live = live[self.words[left[live] + step] == self.words[right[live] + step]]
            if not len(live):
                break
            found[live] += 1
        return found

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """For each two different positions; n and beyond have no words."""
        wait = (self.anchor[(right - left) % self.modulus] - left) % self.modulus
        found = self._compared(left, right, wait)
        on = np.flatnonzero((found == wait) & (np.maximum(left, right) + wait < self.n))
        a = self.place[self.number[left[on] + wait[on]]]
        b = self.place[self.number[right[on] + wait[on]]]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(level):
            rows = level == k
            table = self.table[k]
            found[on[rows]] += np.minimum(table[low[rows]], table[high[rows] - (1 << k)])
        return found


class Runs(NamedTuple):
    starts: np.ndarray
    lengths: np.ndarray
    periods: np.ndarray


NO_RUNS = Runs(*[np.zeros(0, np.int64)] * 3)


def _grid(n: int, repeats: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Periods, points' numbers and points of all grid pairs, some at a time."""
    last = n // repeats
    first = 1
    while first <= last:
        periods = np.arange(first, min(last, first + max(1, PAIRS * first // n)) + 1)
        points = (n - 1) // periods  # pairs of a point and the next
        many = np.searchsorted(np.cumsum(points), PAIRS) + 1
        periods, points = periods[:many], points[:many]
        period = np.repeat(periods, points)
        number = np.arange(len(period)) - np.repeat(np.cumsum(points) - points, points)
        yield period, number, period * number
        first = int(periods[-1]) + 1


def find_runs(words: np.ndarray, repeats: int = 4, least: int = 6) -> Runs:
    """All runs of a sequence of numbers, by start, then period."""
    if repeats < 4:
        raise ValueError("the grid finds runs of four periods or more")
    n, extend, back = len(words), None, None
    found = [np.zeros((0, 3), np.int64)]
    for period, number, point in _grid(n, repeats):
        equal = words[point] == words[point + period]
        third = np.flatnonzero(equal[2:] & equal[1:-1] & equal[:-2] & (number[2:] >= 2)) + 2
        if not len(third):
            continue
        # Of each streak every third point: any run's points hold one of them.
        new = np.concatenate(([True], np.diff(third) > 1))
        streak = np.flatnonzero(new)[np.cumsum(new) - 1]
        third = third[(np.arange(len(third)) - streak) % 3 == 0]
        if extend is None:
            extend, back = CommonExtensions(words), CommonExtensions(words[::-1])
        x, q = point[third], period[third]
        # The last word of a prefix of k words is the word n - k of the words backwards.
        starts = x - back.of(n - x - q, n - x)
        ends = x + q + extend.of(x, x + q)
        long = ends - starts >= np.maximum(least, repeats * q)
        found.append(np.unique(np.stack([starts[long], ends[long], q[long]], 1), axis=0))
    rows = np.unique(np.concatenate(found), axis=0)
    if not len(rows):
        return NO_RUNS
    # A multiple of a run's period finds the same stretch; the least comes first.
    same = np.all(rows[1:, :2] == rows[:-1, :2], axis=1)
    rows = rows[np.concatenate(([True], ~same))]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    return Runs(rows[:, 0], rows[:, 1] - rows[:, 0], rows[:, 2])


def word_numbers(words: list[bytes]) -> np.ndarray:
    numbers = defaultdict(count().__next__)
    return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))


def kept_words(n: int, runs: Runs) -> np.ndarray:
    """Which words stay if each run is cut behind its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs.starts + runs.periods, 1)
    np.add.at(change, runs.starts + runs.lengths, -1)
    return np.cumsum(change[:n]) == 0


def collapse_runs(docs: DataFrame, repeats: int = 4, least: int = 6) -> DataFrame:
    """The documents with `runs` and `collapsed`, the text without what runs repeat."""
    kept = [f for f in docs.schema.fields if f.name not in ("runs", "collapsed")]
    schema = T.StructType(
        [*kept, T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(batch.schema.get_field_index("text")))
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            parts: list[Runs] = []
            collapsed: list[str] = []
            for text in texts:
                words = text.split()
                found = find_runs(word_numbers(words), repeats, least)
                if len(found.starts):
                    stays = kept_words(len(words), found).tolist()
                    words = [word for word, stay in zip(words, stays, strict=True) if stay]
                parts.append(found)
                collapsed.append(b" ".join(words).decode("utf-8", "replace"))
            offsets = np.concatenate(([0], np.cumsum([len(p.starts) for p in parts]))).astype(np.int32)
            values = [pa.array(np.concatenate([p[i] for p in parts])) for i in range(3)] if parts else [pa.array([], pa.int64())] * 3
            fields = [pa.field(f.name, pa.int64(), False) for f in RUN.fields]
            runs = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(values, fields=fields))
            yield pa.RecordBatch.from_arrays([*columns, runs, pa.array(collapsed, pa.string())], names=schema.names)

    return docs.mapInArrow(run, schema)
