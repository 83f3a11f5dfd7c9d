"""Exact top-k by inner product with M-trees, searched best first.

Vectors are whole numbers.  With one more component, sqrt(M^2 - |x|^2), all vectors have
the length M of the longest, and the largest inner products with a query are the smallest
distances to it; so an index for distances serves.

Vectors are dealt out to cells around a few pivots, and cells to shards of `SHARD_ROWS`
vectors.  Each shard is an M-tree in pages: a node knows its centre, its covering radius
and its distance to its parent's centre; a leaf keeps its entries in order of their
distance to its centre.  A query goes first to the shard that promises most, and then, with
the k-th score found there as its bound, to the shards that can still hold a better one.
Within a tree the node that promises most is opened first, and the triangle inequality over
stored distances rules out children and entries before anything is computed.

Ties go to the smaller id.  Defined results: rows without an id, and vectors that are null
or hold null or non-finite components, take no part; only vectors of one dimension are
compared; rows with the query's own id are no candidates, other repeated rows are candidates
each; a repeated query row is one query; fewer candidates than k give fewer rows; an empty
table gives an empty result; other columns are ignored.  Scores are exact whole numbers: as
long as the longest vector's square is below 2^52 they are summed in doubles, beyond that as
64-bit whole numbers.  From `LONGEST` on scores would not fit these, and the search is refused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guardwork.llm.shared import stored

SHARD_ROWS = 8192
#: Queries that one copy of a shard answers, on average.
QUERY_ROWS = 2048
#: Queries that are answered together.
QUERY_BLOCK = 1024
#: Of those, queries that are compared with one range of a leaf's entries.
TOGETHER = 64
MOST_PIVOTS = 1024
PAGE = 512
FANOUT = 8
MOST_LEVELS = 60
_SLACK = 1e-6  # of a distance, for rounding
_SLACK_LONGEST = 1e-7  # of the longest vector: what differences of large squares lose
#: Squares of vectors below which scores are exact in doubles, and beyond which none is a long.
EXACT = 1 << 52
LONGEST = 1 << 62


def _floor(x: Column) -> Column:
    """Rounded down; what no long holds becomes the largest, which `top_k` refuses."""
    most = float(1 << 62)
    return F.floor(F.greatest(F.lit(-most), F.least(F.lit(most), x)))


def whole_vectors(rows: DataFrame, scale: int) -> DataFrame:
    """id and v, floor(scale * x) for each component x of usable vectors."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        rows.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("embedding"))
        .where(F.col("id").isNotNull() & F.col("embedding").isNotNull() & usable)
        .select("id", F.transform("embedding", lambda x: _floor(x * scale)).alias("v"))
    )


def _matrix(column: pa.Array, kind: type = np.float64) -> np.ndarray:
    """The lists of a column, all of one length, as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _below(score):
    """A double that no score of at least this one, as a double, is below."""
    size = F.abs(score) if isinstance(score, Column) else np.abs(score)
    return score - size * 2.0**-50


def _by_dimension(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix for each dimension."""
    sizes = batch.column(column).value_lengths().to_numpy()
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, _matrix(batch.column(column).take(pa.array(rows)))


class Space:
    """Distances between vectors lengthened to the longest, and from queries to them."""

    def __init__(self, longest: float):
        self.longest = longest  # squared length
        self.in_doubles = longest < EXACT
        self.least = _SLACK_LONGEST * longest**0.5

    def slack(self, distance: np.ndarray) -> np.ndarray:
        return _SLACK * (1 + np.abs(distance)) + self.least

    def extra(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.longest - (x * x).sum(axis=1), 0.0))

    def lengthened(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack((x, self.extra(x)))

    @staticmethod
    def query(q: np.ndarray) -> np.ndarray:
        return np.column_stack((q, np.zeros(len(q))))

    @staticmethod
    def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Between all rows of a and of b."""
        squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
        return np.sqrt(np.maximum(squares, 0.0))

    def most_score(self, query_square: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """Of a vector at that distance or farther: the inner product is no larger."""
        distance = np.maximum(0.0, distance - self.slack(distance))
        return (query_square + self.longest - distance * distance) / 2

    def reach(self, query_square: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Vectors of that score or more are no farther."""
        distance = np.sqrt(np.maximum(0.0, query_square + self.longest - 2 * score))
        return distance + self.slack(distance)


class Node:
    """A page: children, or entries (row numbers in order of their distance to the centre)."""

    __slots__ = ("centre", "radius", "to_parent", "number", "children", "child_to_parent", "rows", "to_centre")

    def __init__(self, centre: np.ndarray, radius: float, to_parent: float, number: int):
        self.number = number
        self.centre, self.radius, self.to_parent = centre, radius, to_parent
        self.children: list[Node] = []
        self.rows = self.to_centre = self.child_to_parent = None


class MetricTree:
    """vectors: whole numbers as doubles if scores are exact in these, or else as longs."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, space: Space):
        self.ids, self.vectors, self.space = ids, vectors, space
        vectors = vectors.astype(np.float64, copy=False)
        self.points = space.lengthened(vectors)
        self.nodes: list[Node] = []  # by number, the root first
        self.root = self._page(np.arange(len(ids)), self.points[0], 0.0)

    def _page(self, rows: np.ndarray, centre: np.ndarray, to_parent: float, level: int = 0) -> Node:
        distance = self.space.distances(centre[None, :], self.points[rows])[0]
        node = Node(centre, float(distance.max()), to_parent, len(self.nodes))
        self.nodes.append(node)
        centres = self._far_apart(rows) if len(rows) > PAGE and level < MOST_LEVELS else []
        if len(centres) < 2:  # small enough, deep enough, or all of them equal
            order = np.argsort(distance, kind="stable")
            node.rows, node.to_centre = rows[order], distance[order]
            return node
        nearest = self.space.distances(self.points[rows], self.points[centres]).argmin(axis=1)
        for k, c in enumerate(centres):
            away = self.space.distances(centre[None, :], self.points[c][None, :])[0, 0]
            node.children.append(self._page(rows[nearest == k], self.points[c], float(away), level + 1))
        node.child_to_parent = np.array([child.to_parent for child in node.children])
        return node

    def _far_apart(self, rows: np.ndarray) -> list[int]:
        """Rows that serve as centres, each the farthest from those before it; all differ."""
        chosen = [int(rows[0])]
        nearest = self.space.distances(self.points[rows], self.points[chosen])[:, 0]
        while len(chosen) < FANOUT:
            at = int(nearest.argmax())
            if nearest[at] <= self.space.slack(np.zeros(1))[0]:
                break
            chosen.append(int(rows[at]))
            nearest = np.minimum(nearest, self.space.distances(self.points[rows], self.points[chosen[-1:]])[:, 0])
        return chosen

    def search(self, own: np.ndarray, queries: np.ndarray, k: int, bounds: np.ndarray):
        """Query number, id and score of the k best of each query that reach its bound.

        Every query has a frontier of nodes.  It opens the one that promises it most, and goes
        on until none promises more than the k-th score that it has found.  Queries that open
        the same node are answered together.
        """
        numbers = queries.astype(np.float64, copy=False)
        squares = (numbers * numbers).sum(axis=1)
        points = self.space.query(numbers)
        bounds = bounds.copy()
        # For each query and node the most that it promises (-inf: not in the frontier) and the
        # query's distance to its centre.
        most, away = np.full((len(queries), len(self.nodes)), -np.inf), np.zeros((len(queries), len(self.nodes)))
        away[:, 0] = self.space.distances(points, self.root.centre[None, :])[:, 0]
        most[:, 0] = self.space.most_score(squares, away[:, 0] - self.root.radius)
        who, ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, queries.dtype)
        waiting = np.arange(len(queries))
        while len(waiting):
            best = most[waiting].argmax(axis=1)
            going = most[waiting, best] >= np.maximum(bounds[waiting], np.finfo(float).min)
            waiting, best = waiting[going], best[going]
            found = []
            for at in np.unique(best):
                node, asking = self.nodes[at], waiting[best == at]
                most[asking, at] = -np.inf
                if node.children:
                    self._expand(node, asking, away[asking, at], points, squares, bounds, most, away)
                else:
                    found += self._entries(node, asking, away[asking, at], own, queries, squares, bounds)
            if not found:
                continue
            who, ids, scores = (np.concatenate(parts) for parts in zip((who, ids, scores), *found, strict=True))
            order = np.lexsort((ids, -scores, who))
            who, ids, scores = who[order], ids[order], scores[order]
            rank = np.arange(len(who)) - np.searchsorted(who, who)
            full = who[rank == k - 1]
            bounds[full] = np.maximum(bounds[full], _below(scores[rank == k - 1].astype(np.float64)))
            who, ids, scores = who[rank < k], ids[rank < k], scores[rank < k]
        return who, ids, scores

    def _expand(self, node: Node, asking: np.ndarray, distance: np.ndarray, points, squares, bounds, most, away) -> None:
        """Puts the children that can reach a query's bound into its frontier."""
        reach = self.space.reach(squares[asking], bounds[asking])
        for child, to_parent in zip(node.children, node.child_to_parent, strict=True):
            # What the stored distances alone rule out is not computed.
            some = asking[np.abs(distance - to_parent) - child.radius <= reach]
            if len(some):
                to_child = self.space.distances(points[some], child.centre[None, :])[:, 0]
                promise = self.space.most_score(squares[some], to_child - child.radius)
                most[some, child.number] = np.where(promise >= bounds[some], promise, -np.inf)
                away[some, child.number] = to_child

    def _entries(self, leaf: Node, asking: np.ndarray, away: np.ndarray, own, queries, squares, bounds):
        """Query number, id and score of a leaf's entries that reach the bounds of those asking.

        Queries of like ranges of stored distances are answered together, so that one far query
        does not widen the range of the others."""
        reach = self.space.reach(squares[asking], bounds[asking])
        low = np.searchsorted(leaf.to_centre, away - reach)
        high = np.searchsorted(leaf.to_centre, away + reach, side="right")
        order = np.lexsort((high, low))
        order = order[low[order] < high[order]]
        for start in range(0, len(order), TOGETHER):
            group = order[start : start + TOGETHER]
            rows = leaf.rows[low[group].min() : high[group].max()]
            some = asking[group]
            score = queries[some] @ self.vectors[rows].T
            q, e = np.nonzero((score >= bounds[some][:, None]) & (self.ids[rows] != own[some][:, None]))
            yield some[q], self.ids[rows[e]], score[q, e]


_ENTRY = "shard long, copy long, is_query int, id long, v array<long>, bound double"
_HIT = "query_id long, id long, score long"


def _searched(shards: DataFrame, routed: DataFrame, k: int, longest: float) -> DataFrame:
    """Hits of the routed queries (shard, id, v, bound) in their shards (shard, id, v).

    A shard is copied for each `QUERY_ROWS` queries that it gets, so many queries of one shard
    are many tasks; a task holds one shard's vectors and answers queries as they come.
    """
    copies = routed.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).alias("copies"))
    vectors = (
        shards.join(copies, "shard")
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        .select("shard", "copy", F.lit(0).alias("is_query"), "id", "v", F.lit(0.0).alias("bound"))
    )
    queries = routed.join(copies, "shard").select(
        "shard", F.pmod(F.xxhash64("id"), F.col("copies")).alias("copy"), F.lit(1).alias("is_query"), "id", "v", "bound"
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, tree, held, at = Space(longest), None, [], None
        kind = np.float64 if space.in_doubles else np.int64
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("shard", "copy", "is_query")]
            new = np.zeros(batch.num_rows + 1, bool)
            new[[0, -1]] = True
            for column in columns:
                new[1:-1] |= column[1:] != column[:-1]
            edges = np.flatnonzero(new)
            edges = np.unique(np.concatenate((edges, np.arange(0, batch.num_rows, QUERY_BLOCK))))
            for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                shard, copy, is_query = (column[low] for column in columns)
                part = batch.slice(low, high - low)
                ids, vectors = part.column("id").to_numpy(), _matrix(part.column("v"), kind)
                if (shard, copy) != at:
                    at, tree, held = (shard, copy), None, []
                if not is_query:
                    held.append((ids, vectors))
                    continue
                if tree is None:
                    tree = MetricTree(*map(np.concatenate, zip(*held, strict=True)), space)
                who, found, score = tree.search(ids, vectors, k, part.column("bound").to_numpy())
                hits = (ids[who], found, score.astype(np.int64))
                yield pa.RecordBatch.from_arrays(list(map(pa.array, hits)), names=["query_id", "id", "score"])

    keys = ["shard", "copy"]
    return (
        vectors.union(queries)
        .repartition(*keys)
        .sortWithinPartitions(*keys, "is_query", "id")
        .mapInArrow(search, _HIT)
    )


def _celled(vectors: DataFrame, pivots: dict[int, np.ndarray], space: Space) -> DataFrame:
    """Adds cell, the nearest pivot of the vector's dimension (by number), and the distance to it."""
    numbers = _pivot_numbers(pivots)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, away = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for rows, x in _by_dimension(batch, "v"):
                at = x.shape[1]
                if at in pivots:
                    distance = space.distances(space.lengthened(x), space.lengthened(pivots[at]))
                    cell[rows] = numbers[at] + distance.argmin(axis=1)
                    away[rows] = distance.min(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell), pa.array(away)], names=[*batch.schema.names, "cell", "away"]
            )

    return vectors.mapInArrow(deal, "id long, v array<long>, cell long, away double")


def _pivot_numbers(pivots: dict[int, np.ndarray]) -> dict[int, int]:
    numbers, n = {}, 0
    for dimension in sorted(pivots):
        numbers[dimension] = n
        n += len(pivots[dimension])
    return numbers


def _routed(queries: DataFrame, directory: list[tuple[int, int, float]], pivots: dict[int, np.ndarray], space: Space, first: bool) -> DataFrame:
    """shard, id, v, bound: the most promising shard (first), or the others that can reach the bound.

    directory: shard, cell and radius of each.
    """
    numbers = _pivot_numbers(pivots)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, cells = np.array([d[0] for d in directory]), np.array([d[1] for d in directory])
        radius = np.array([d[2] for d in directory])
        for batch in batches:
            bounds = batch.column("bound").to_numpy()
            for rows, q in _by_dimension(batch, "v"):
                at = q.shape[1]
                if at not in pivots:
                    continue
                mine = np.flatnonzero((cells >= numbers[at]) & (cells < numbers[at] + len(pivots[at])))
                distance = space.distances(space.query(q), space.lengthened(pivots[at]))[:, cells[mine] - numbers[at]]
                least = np.maximum(distance - radius[mine] - space.slack(distance), 0.0)
                most = ((q * q).sum(axis=1)[:, None] + space.longest - least * least) / 2
                best = most.argmax(axis=1)
                if first:
                    pairs = np.column_stack((np.arange(len(rows)), best))
                else:
                    open_ = most >= bounds[rows][:, None]
                    open_[np.arange(len(rows)), best] = False
                    pairs = np.argwhere(open_)
                for part in np.array_split(pairs, max(1, len(pairs) // 10_000)):
                    chosen = pa.array(rows[part[:, 0]])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(shards[mine[part[:, 1]]]),
                            *(batch.column(c).take(chosen) for c in ("id", "v", "bound")),
                        ],
                        names=["shard", "id", "v", "bound"],
                    )

    return queries.select("id", "v", "bound").mapInArrow(route, "shard long, id long, v array<long>, bound double")


def top_k(rows: DataFrame, queries: DataFrame, k: int, scale: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows with the largest inner products for each query.

    rows and queries: vec_id, embedding; vectors become floor(scale * x).
    """
    vectors = stored(whole_vectors(rows, scale), "vectors")
    asked = whole_vectors(queries, scale).dropDuplicates(["id", "v"])
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, longest = vectors.agg(F.count(F.lit(1)), F.max(square)).first()
    asked_longest = asked.agg(F.max(square)).first()[0]
    if max(longest or 0, asked_longest or 0) >= LONGEST:
        raise ValueError("scores need vectors whose square, after scaling, is below 2^62")
    space = Space(float(max(longest or 0, asked_longest or 0)))

    wanted = max(1, min(MOST_PIVOTS, round(n**0.5 / 8)))
    pivots: dict[int, np.ndarray] = {}
    for row in vectors.orderBy(F.xxhash64("id"), "id").limit(wanted).collect():
        pivots.setdefault(len(row.v), []).append(row.v)
    missing = vectors.groupBy(F.size("v").alias("d")).agg(F.first("v").alias("v")).collect()  # a row per dimension
    pivots = {row.d: np.array(pivots.get(row.d, [row.v]), np.float64) for row in missing if row.d > 0}

    celled = stored(_celled(vectors.where(F.size("v") > 0), pivots, space), "cells")
    parts = celled.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / SHARD_ROWS).alias("parts"))
    # At most MOST_PIVOTS cells (and one per dimension): a table of fixed size.
    sharded = celled.join(F.broadcast(parts), "cell").withColumn(
        "shard", F.col("cell") * (1 << 32) + F.pmod(F.xxhash64("id"), F.col("parts"))
    )
    directory = [tuple(r) for r in sharded.groupBy("shard", "cell").agg(F.max("away")).collect()]
    shards = sharded.select("shard", "id", "v")

    start = asked.withColumn("bound", F.lit(float("-inf")))
    near = stored(_searched(shards, _routed(start, directory, pivots, space, first=True), k, space.longest), "hits")
    bounds = near.groupBy("query_id").agg(
        F.when(F.count(F.lit(1)) >= k, _below(F.min("score").cast("double"))).alias("bound"), F.count(F.lit(1)).alias("hits")
    )
    bounded = (
        asked.join(bounds.withColumnRenamed("query_id", "id"), "id", "left")
        .withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
        .select("id", "v", "bound")
    )
    further = _searched(shards, _routed(bounded, directory, pivots, space, first=False), k, space.longest)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return (
        near.union(further)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias("vec_id"), "score")
    )
