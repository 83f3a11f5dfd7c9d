"""Quality by document and site, with hierarchical empirical Bayes.

A linear classifier over words and statistics gives each document's own evidence.  A host's
mean is shrunk toward the mean of all documents, and the mean of a path within the host
toward the host's; how much a group has to hold to speak for itself is estimated from the
spread between groups (method of moments).  The posterior odds of a document are its own
odds, moved by how far its path's posterior mean lies from the mean of all.

Groups are counted with partial sums; only the means and spreads over all groups (one row a
level) and the bounded fitting sample come to the driver.

Defined results: a null text is empty and is judged by its statistics; null hosts or paths
are a group of their own; a null id is carried along; repeated rows are judged alike;
without labels of both kinds the evidence is even (probability 0.5); an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guardwork.llm.quality_rules import FEATURES, features_of, statistics_of
from guardwork.llm.shared import stored
from guardwork.llm.words import blocks, text_bytes, word_hashes, words_of
from guardwork.llm.worker_memory import at_work

#: Labelled documents that the classifier is fitted on at most, the smallest hashes of their ids.
FIT_ROWS = 10_000
#: Words that the classifier weighs, those that tell the kinds apart best.
MOST_WORDS = 2_000
LEAST_DOCUMENTS = 3
LEAST_GAP = 4.0
#: Bounds of the documents' worth that a group's prior has.
LEAST_PRIOR, MOST_PRIOR = 1.0, 1e6
KEEP = 0.5
_EDGE = 1e-4  # probabilities stay this far from 0 and 1


class Evidence(NamedTuple):
    """A linear classifier: sorted word hashes and their weights, then those of the statistics."""

    words: np.ndarray
    word_weights: np.ndarray
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    base: float

    def log_odds(self, texts: list[bytes]) -> np.ndarray:
        x = (features_of(statistics_of(texts)) - self.centre) / self.spread
        total = self.base + x @ self.weights
        if len(self.words):
            for block in blocks(texts):
                words = words_of(block)
                text, at = known_words(block, words, self.words)
                n = len(block.starts)
                total[block.first : block.first + n] += np.bincount(text, self.word_weights[at], n)
        return total


def known_words(block, words, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and place in `known` of each text's distinct known words."""
    hashes = word_hashes(block.data, words, fold_case=True)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    found = known[at] == hashes
    pairs = np.unique(words.text[found].astype(np.int64) * len(known) + at[found])
    return pairs // len(known), pairs % len(known)


def distinct_words(texts: list[bytes]) -> list[np.ndarray]:
    out = []
    for block in blocks(texts):
        words = words_of(block)
        hashes = word_hashes(block.data, words, fold_case=True)
        out += [np.unique(hashes[a:b]) for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
    return out


def _gap(count, in_good, share: float):
    """Chi-square of a word's presence, from the expected counts; of numbers, or of columns."""
    return (in_good - count * share) ** 2 / (count * share * (1 - share))


def fit(texts: list[bytes], good: np.ndarray) -> Evidence:
    """The classifier of some texts at hand; `fit_evidence` gives the same from tables."""
    x = features_of(statistics_of(texts)) if texts else np.zeros((0, len(FEATURES)))
    if not len(good) or good.min() == good.max():
        return _solved(x, [], np.zeros(0, np.uint64), good)
    sets = distinct_words(texts)
    words, count = np.unique(np.concatenate(sets), return_counts=True)
    of_good, good_count = np.unique(np.concatenate([s for s, g in zip(sets, good, strict=True) if g]), return_counts=True)
    in_good = np.zeros(len(words))
    in_good[np.searchsorted(words, of_good)] = good_count
    share = good.mean()
    gap = _gap(count, in_good, share)
    # Words of good documents tell their length above all; what is weighed are words of bad ones.
    gap[(count < LEAST_DOCUMENTS) | (in_good >= count * share)] = -1
    chosen = np.sort(np.argsort(-gap, kind="stable")[:MOST_WORDS])
    words = words[chosen[gap[chosen] > LEAST_GAP]]
    return _solved(x, [places_of(s, words) for s in sets], words, good)


def places_of(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Places in `words` (sorted) of those hashes that are there."""
    at = np.searchsorted(words, hashes)
    at = at[at < len(words)] if len(words) else at[:0]
    return at[np.isin(words[at], hashes)] if len(at) else at


def _solved(x: np.ndarray, present: list[np.ndarray], words: np.ndarray, good: np.ndarray, steps: int = 300, penalty: float = 1e-3) -> Evidence:
    """Logistic regression by accelerated gradient steps over statistics and the words present."""
    centre = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
    spread = np.maximum(x.std(axis=0), 1e-6) if len(x) else np.ones(x.shape[1])
    none = np.zeros(0)
    if not len(good) or good.min() == good.max():
        return Evidence(none.astype(np.uint64), none, centre, spread, np.zeros(x.shape[1]), 0.0)
    share = good.mean()
    found = np.zeros((len(x), len(words)), np.float32)
    for i, at in enumerate(present):
        found[i, at] = 1
    z = np.column_stack((found, ((x - centre) / spread).astype(np.float32), np.ones(len(x), np.float32)))
    # Both kinds weigh the same, so that rare bad documents count.
    weight = (np.where(good, 0.5 / share, 0.5 / (1 - share)) / len(good)).astype(np.float32)
    rate = np.float32(4 / max(float(np.einsum("ij,ij->i", z, z) @ weight), 1e-9))
    w = ahead = np.zeros(z.shape[1], np.float32)
    for step in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ ahead, -30, 30)))
        new = ahead - rate * ((weight * (p - good)) @ z + np.float32(penalty / len(good)) * ahead)
        ahead = new + np.float32(step / (step + 3)) * (new - w)
        w = new
    n = len(words)
    base = float(w[-1] + np.log(share / (1 - share)))
    return Evidence(words, w[:n].astype(float), centre, spread, w[n:-1].astype(float), base)


_X = [f"x{i}" for i in range(len(FEATURES))]
_MEASURED = f"doc_id long, good boolean, {', '.join(f'{x} double' for x in _X)}, words array<long>"


def _measured(sample: DataFrame) -> DataFrame:
    """doc_id, good, the features and the hashes of the distinct words of labelled texts."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("site_quality")
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            x = features_of(statistics_of(texts))
            words = pa.array([s.view(np.int64) for s in distinct_words(texts)], pa.list_(pa.int64()))
            columns = [batch.column("doc_id"), batch.column("good"), *map(pa.array, x.T.copy()), words]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "good", *_X, "words"])

    return sample.select("doc_id", "good", "text").mapInArrow(measure, _MEASURED)


def fit_evidence(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Evidence:
    """Fits on `fit_rows` labelled documents at most; good ones are of quality and not toxic.

    Texts stay in tasks: what comes to the driver are `MOST_WORDS` words, and for each document
    its statistics and which of these words it has.
    """
    chosen = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(F.expr("quality = 1 AND coalesce(toxic, 0) = 0")).alias("good"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(fit_rows)
    )
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    measured = stored(_measured(sample), "labelled-words")
    share = measured.agg(F.avg(F.col("good").cast("double"))).first()[0] or 0.0
    words = np.zeros(0, np.uint64)
    if 0 < share < 1:
        n, in_good = F.col("n").cast("double"), F.col("in_good").cast("double")
        counts = (
            measured.select("good", F.explode("words").alias("word"))
            .groupBy("word")
            .agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("in_good"))
            .where((F.col("n") >= LEAST_DOCUMENTS) & (in_good < n * share))
            .withColumn("gap", _gap(n, in_good, share))
            .where(F.col("gap") > LEAST_GAP)
        )
        best = counts.orderBy(F.desc("gap"), "word").limit(MOST_WORDS).select("word").collect()
        words = np.sort(np.array([r.word for r in best], np.int64).view(np.uint64))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("site_quality")
        for batch in batches:
            found = [places_of(np.array(s.as_py(), np.int64).view(np.uint64), words) for s in batch.column("words")]
            columns = [*batch.columns[:-1], pa.array(found, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "present"])

    schema = _MEASURED.replace("words array<long>", "present array<int>")
    rows = sorted(measured.mapInArrow(place, schema).collect())
    x = np.array([r[2:-1] for r in rows], float).reshape(-1, len(_X))
    return _solved(x, [np.array(r.present, int) for r in rows], words, np.array([r.good for r in rows], bool))


def scored(docs: DataFrame, evidence: Evidence, host: str, path: str) -> DataFrame:
    """doc_id, host, path and log_odds, the document's own evidence."""
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("host", T.StringType()),
            T.StructField("path", T.StringType()),
            T.StructField("log_odds", T.DoubleType()),
        ]
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("site_quality")
        for batch in batches:
            odds = pa.array(evidence.log_odds(text_bytes(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "host", "path")), odds], names=schema.names)

    columns = [F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path")]
    return docs.select("doc_id", *columns, "text").mapInArrow(score, schema)


def _logit(p: F.Column) -> F.Column:
    p = F.greatest(F.lit(_EDGE), F.least(F.lit(1 - _EDGE), p))
    return F.log(p / (1 - p))


def _prior_worth(groups: DataFrame, parent: str) -> float:
    """Documents that the parent's mean is worth in a group's, by the method of moments.

    groups: n, total, squares (sums of p and p^2) and the parent's mean.  Between groups the
    means spread by the variance between them and the share of that within; what is left over
    tells how much of a group's mean is its own.
    """
    mean = F.col("total") / F.col("n")
    within = F.sum(F.col("squares") - F.col("total") * mean)
    row = groups.agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("groups"),
        within.alias("within"),
        F.sum(F.col("n") * (mean - F.col(parent)) ** 2).alias("between"),
        F.sum(F.col("n") * F.col("n")).alias("nn"),
    ).first()
    if not row.n or row.n <= row.groups or row.groups < 2:
        return MOST_PRIOR
    noise = row.within / (row.n - row.groups)
    own = (row.between - noise * (row.groups - 1)) / (row.n - row.nn / row.n)
    return MOST_PRIOR if own <= 0 else float(min(max(noise / own, LEAST_PRIOR), MOST_PRIOR))


def site_means(documents: DataFrame) -> DataFrame:
    """host, path, host_mean, path_mean and all_mean from documents' log_odds."""
    p = 1 / (1 + F.exp(-F.col("log_odds")))
    paths = stored(
        documents.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum(p).alias("total"), F.sum(p * p).alias("squares")),
        "paths",
    )
    all_row = paths.agg(F.sum("total") / F.sum("n")).first()
    all_mean = float(all_row[0]) if all_row[0] is not None else 0.5
    hosts = paths.groupBy("host").agg(*(F.sum(c).alias(c) for c in ("n", "total", "squares"))).withColumn("all_mean", F.lit(all_mean))
    worth = _prior_worth(hosts, "all_mean")
    of_host = Window.partitionBy("host")
    n, total = F.sum("n").over(of_host), F.sum("total").over(of_host)
    paths = paths.withColumn("all_mean", F.lit(all_mean)).withColumn(
        "host_mean", (total + worth * F.col("all_mean")) / (n + worth)
    )
    worth = _prior_worth(paths, "host_mean")
    return paths.select(
        "host",
        "path",
        "all_mean",
        "host_mean",
        ((F.col("total") + worth * F.col("host_mean")) / (F.col("n") + worth)).alias("path_mean"),
    )


def site_quality(docs: DataFrame, evidence: Evidence, host: str, path: str, keep: float = KEEP) -> DataFrame:
    """One row per document: doc_id, p_document, host_mean, path_mean, p_good, kept."""
    documents = stored(scored(docs, evidence, host, path), "evidence")
    d, s = documents.alias("d"), site_means(documents).alias("s")
    same = F.col("d.host").eqNullSafe(F.col("s.host")) & F.col("d.path").eqNullSafe(F.col("s.path"))
    shift = _logit(F.col("s.path_mean")) - _logit(F.col("s.all_mean"))
    return (
        d.join(s, same)
        .withColumn("p_document", 1 / (1 + F.exp(-F.col("log_odds"))))
        .withColumn("p_good", 1 / (1 + F.exp(-(F.col("log_odds") + shift))))
        .select("doc_id", "p_document", "host_mean", "path_mean", "p_good", (F.col("p_good") >= keep).alias("kept"))
    )
