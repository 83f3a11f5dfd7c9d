"""Quality rules: boosted trees over document statistics.

A short list of base rules rejects documents outright.  What they leave is judged by
gradient-boosted trees, fitted on labelled documents and flattened into numpy node arrays,
so that a whole block of documents walks down all trees at once.  For chosen features the
score may only fall as the feature rises.

Defined results: a null text counts as empty and fails the base rules, as does every text
under `MIN_WORDS` words; a null id is carried along; repeated rows are judged alike; an
empty table gives an empty result; without labels of both kinds the trees are empty and
the base rules decide alone.  Other columns are ignored by `quality_rules` and kept by
`quality_filter`.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guardwork.llm.worker_memory import at_work
from guardwork.llm.words import (
    CODE_POINT,
    Block,
    blocks,
    prefix_hashes,
    range_hashes,
    text_bytes,
    window_hashes,
    windows_within,
    word_hashes,
    words_of,
)

MIN_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5
#: Labelled documents that the trees are fitted on at most, the smallest hashes of their ids.
FIT_ROWS = 10_000
#: A document is kept if its odds to be good are at least these, in logarithms.
KEEP_LOG_ODDS = -1.0

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[list(b"0123456789")] = True
_UPPER = np.zeros(256, bool)
_UPPER[list(range(ord("A"), ord("Z") + 1))] = True

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Features of the trees, and the direction in which each may move the score (0: any).
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "symbols_per_word": -1,
    "dup_lines_per_line": -1,
    "repeat_share": -1,
    "digits_per_char": 0,
    "upper_per_char": 0,
    "distinct_words_per_word": 0,
    "stutters_per_word": -1,
}


class Node(NamedTuple):
    feature: int
    threshold: float
    left: int
    right: int
    value: float


class Forest(NamedTuple):
    """All trees in one set of node arrays; a leaf leads to itself."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row of x."""
        at = np.tile(self.roots, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            below = x[rows, self.feature[at]] <= self.threshold[at]
            at = np.where(below, self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)


def _per_text(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Sums of values by text index."""
    return np.bincount(at, weights=values, minlength=n).astype(np.int64)


def _in_texts(marked: np.ndarray, block: Block) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(marked)))
    return sums[block.starts + block.lengths] - sums[block.starts]


def _first_of_kind(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row: is it the first of its hash in its text, and does its text hold the hash twice?"""
    order = np.lexsort((hashes, text))
    same = (text[order[1:]] == text[order[:-1]]) & (hashes[order[1:]] == hashes[order[:-1]])
    first = np.ones(len(order), bool)
    first[order[1:]] = ~same  # the sort is stable, so the earliest comes first
    repeated = np.zeros(len(order), bool)
    repeated[order[1:]] = same
    repeated[order[:-1]] |= same
    return first, repeated


def block_statistics(block: Block) -> dict[str, np.ndarray]:
    """The statistics of each text of a block."""
    data, n = block.data, len(block.starts)
    words = words_of(block)
    hashes = word_hashes(data, words)
    code_points = np.concatenate(([0], np.cumsum(CODE_POINT[data])))
    chars = code_points[words.ends] - code_points[words.starts]

    starts = windows_within(words, WINDOW)
    _, repeated = _first_of_kind(words.text[starts], window_hashes(hashes, WINDOW)[starts])
    edges = np.zeros(len(words.starts) + WINDOW, np.int64)
    np.add.at(edges, starts[repeated], 1)
    np.add.at(edges, starts[repeated] + WINDOW, -1)
    covered = np.cumsum(edges)[: len(words.starts)] > 0

    # A line starts at a text's start and behind each \n; it ends at \n or at the text's end.
    is_end = data == 10
    is_end[block.starts + block.lengths] = True
    line_ends = np.flatnonzero(is_end)
    line_starts = np.concatenate(([0], line_ends[:-1] + 1))
    has_word = np.searchsorted(words.starts, line_ends) > np.searchsorted(words.starts, line_starts)
    line_starts, line_ends = line_starts[has_word], line_ends[has_word]
    line_text = np.searchsorted(block.starts, line_starts, side="right") - 1
    line_first, _ = _first_of_kind(line_text, range_hashes(prefix_hashes(data), line_starts, line_ends))

    word_first, _ = _first_of_kind(words.text, hashes)
    stutters = (hashes[1:] == hashes[:-1]) & (words.text[1:] == words.text[:-1])
    return {
        "n_words": np.diff(words.first),
        "word_chars": _per_text(chars, words.text, n),
        "n_symbols": _in_texts(_SYMBOL[data], block),
        "n_dup_lines": _per_text(~line_first, line_text, n),
        "n_repeat_words": _per_text(covered, words.text, n),
        "n_lines": np.bincount(line_text, minlength=n),
        "n_digits": _in_texts(_DIGIT[data], block),
        "n_upper": _in_texts(_UPPER[data], block),
        "n_distinct": _per_text(word_first, words.text, n),
        "n_stutters": _per_text(stutters, words.text[1:], n),
    }


def statistics_of(texts: list[bytes]) -> dict[str, np.ndarray]:
    parts = [block_statistics(block) for block in blocks(texts)]
    if not parts:
        parts = [block_statistics(next(blocks([b""])))]
        return {name: values[:0] for name, values in parts[0].items()}
    return {name: np.concatenate([part[name] for part in parts]) for name in parts[0]}


def features_of(s: dict[str, np.ndarray]) -> np.ndarray:
    words, chars = np.maximum(s["n_words"], 1), np.maximum(s["word_chars"], 1)
    return np.column_stack(
        [
            np.log1p(s["n_words"]),
            s["word_chars"] / words,
            s["n_symbols"] / words,
            s["n_dup_lines"] / np.maximum(s["n_lines"], 1),
            s["n_repeat_words"] / words,
            s["n_digits"] / chars,
            s["n_upper"] / chars,
            s["n_distinct"] / words,
            s["n_stutters"] / words,
        ]
    )


def base_failed(s: dict[str, np.ndarray]) -> np.ndarray:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > REPEAT_PERCENT * s["n_words"])


def grow_forest(
    x: np.ndarray,
    y: np.ndarray,
    monotonic: tuple[int, ...],
    trees: int = 40,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 32,
    penalty: float = 1.0,
    least: int = 3,
) -> Forest:
    """Boosts trees on the logistic loss, with splits at quantiles of each feature.

    Rare bad documents count as much as the good ones while the trees grow, and splits are tried at
    the quantiles of either kind; a leaf has `least` rows or more.  The odds of a document are
    then those among documents as frequent as in the sample.
    """
    rows = len(y)
    if rows == 0 or y.min() == y.max():
        leaf = np.zeros(1)
        return Forest(np.zeros(0, int), leaf.astype(int), leaf, leaf.astype(int), leaf.astype(int), leaf, 0, 0.0)
    steps = np.linspace(0, 1, bins + 1)
    kinds = [x[y == kind] for kind in (0, 1)]
    cuts = [np.unique(np.concatenate([np.quantile(k[:, f], steps) for k in kinds])) for f in range(x.shape[1])]
    place = np.column_stack([np.searchsorted(c, column) for c, column in zip(cuts, x.T, strict=True)])
    share = float(y.mean())
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    base = float(np.log(share / (1 - share)))
    score = np.zeros(rows)
    nodes: list[Node] = []
    roots = []

    def leaf_value(g: float, h: float, low: float, high: float) -> float:
        return min(max(-g / (h + penalty), low), high)

    def best_split(at: np.ndarray, g: np.ndarray, h: np.ndarray, low: float, high: float):
        best = (1e-9, -1, -1, 0.0)
        total_g, total_h = g[at].sum(), h[at].sum()
        for f, cut in enumerate(cuts):
            if not len(cut):
                continue
            left_g = np.cumsum(np.bincount(place[at, f], g[at], len(cut) + 1))[:-1]
            left_h = np.cumsum(np.bincount(place[at, f], h[at], len(cut) + 1))[:-1]
            left_n = np.cumsum(np.bincount(place[at, f], minlength=len(cut) + 1))[:-1]
            right_g, right_h = total_g - left_g, total_h - left_h
            gain = left_g**2 / (left_h + penalty) + right_g**2 / (right_h + penalty) - total_g**2 / (total_h + penalty)
            left = np.clip(-left_g / (left_h + penalty), low, high)
            right = np.clip(-right_g / (right_h + penalty), low, high)
            allowed = (left_n >= least) & (len(at) - left_n >= least)
            if monotonic[f]:
                allowed &= monotonic[f] * (right - left) >= 0
            gain = np.where(allowed, gain, -np.inf)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (float(gain[k]), f, k, float((left[k] + right[k]) / 2))
        return best

    def grow(at: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, low: float, high: float) -> int:
        """Appends the subtree over the rows `at`; returns its root."""
        me = len(nodes)
        value = leaf_value(g[at].sum(), h[at].sum(), low, high)
        nodes.append(Node(0, np.inf, me, me, rate * value))
        _, f, k, middle = best_split(at, g, h, low, high) if level < depth else (0, -1, -1, 0.0)
        if f < 0:
            score[at] += rate * value
            return me
        below = place[at, f] <= k
        # Both sides of a monotonic split keep to their side of the middle, however far down.
        left_range = right_range = (low, high)
        if monotonic[f] < 0:
            left_range, right_range = (middle, high), (low, middle)
        elif monotonic[f] > 0:
            left_range, right_range = (low, middle), (middle, high)
        left = grow(at[below], g, h, level + 1, *left_range)
        right = grow(at[~below], g, h, level + 1, *right_range)
        nodes[me] = Node(f, float(cuts[f][k]), left, right, 0.0)
        return me

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        roots.append(grow(np.arange(rows), weight * (p - y), weight * p * (1 - p), 0, -np.inf, np.inf))
    feature, threshold, left, right, value = (np.array(column) for column in zip(*nodes, strict=True))
    return Forest(np.array(roots), feature, threshold, left, right, value, depth, base)


def fit_forest(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Forest:
    """Fits the trees on `fit_rows` labelled documents at most (driver memory: some megabytes)."""
    chosen = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(fit_rows)
    )
    names = ["x" + str(i) for i in range(len(FEATURES))]
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType())] + [T.StructField(n, T.DoubleType()) for n in names]
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("quality_rules")
        for batch in batches:
            s = statistics_of(text_bytes(batch.column("text")))
            rows = np.flatnonzero(~base_failed(s))
            x = features_of(s)[rows]
            ids = batch.column("doc_id").take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([ids, *map(pa.array, x.T.copy())], names=["doc_id", *names])

    labelled = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(F.broadcast(chosen.select(F.col("doc_id").cast("long").alias("doc_id"))), "doc_id", "left_semi")
        .mapInArrow(measure, schema)
        .join(F.broadcast(chosen), "doc_id")
    )
    rows = np.array(sorted(tuple(row) for row in labelled.select("doc_id", *names, "quality").collect()), float)
    rows = rows.reshape(-1, len(names) + 2)
    return grow_forest(rows[:, 1:-1], rows[:, -1], tuple(FEATURES.values()))


def _judged(texts: list[bytes], forest: Forest, keep: float) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    s = statistics_of(texts)
    score = forest.score(features_of(s))
    return s, score, ~base_failed(s) & (score >= keep)


def quality_rules(docs: DataFrame, forest: Forest, keep: float = KEEP_LOG_ODDS) -> DataFrame:
    """One row per document: doc_id, the statistics, base_failed, log_odds, kept."""
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType)]
        + [T.StructField(name, T.LongType()) for name in STATISTICS]
        + [
            T.StructField("base_failed", T.BooleanType()),
            T.StructField("log_odds", T.DoubleType()),
            T.StructField("kept", T.BooleanType()),
        ]
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("quality_rules")
        for batch in batches:
            s, score, kept = _judged(text_bytes(batch.column("text")), forest, keep)
            columns = [batch.column("doc_id"), *(pa.array(s[name], pa.int64()) for name in STATISTICS)]
            columns += [pa.array(base_failed(s)), pa.array(score), pa.array(kept)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(judge, schema)


def quality_filter(docs: DataFrame, forest: Forest, keep: float = KEEP_LOG_ODDS) -> DataFrame:
    """The kept documents, with all their columns."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("quality_rules")
        for batch in batches:
            texts = text_bytes(batch.column(batch.schema.get_field_index("text")))
            yield batch.filter(pa.array(_judged(texts, forest, keep)[2]))

    return docs.mapInArrow(judge, docs.schema)
