"""Near-duplicates: b-bit MinHash signatures, joined by Hamming distance through many indexes.

A document is the set of its distinct shingles.  Equal sets are one class, which is worked
on once.  A class's signature has `CHUNKS` x `CHUNK` symbols of 16 bits.  Two signatures
that differ in at most 2 * CHUNKS - 1 symbols have a chunk with one error at most
(pigeonhole), so each chunk is entered once for each place that may be wrong, with that
place left out: every such pair meets under some key.  A pair of similarity 0.8 misses
every key with a probability of 2 in a million.

Under a key no pairs are listed.  First every class is compared with the smallest one there
(a star), and exact links make components.  Then only keys where further components meet
are looked at again: their classes are compared in tiles of bounded size, each pair under
its first common key only, and only across components.  So no link between components is
lost, and a group of many copies costs little more than its size.

Every link is confirmed on the full sets, 100 * intersection >= 80 * union.

Defined results: a text without words (or null) has the empty set and is linked with
nothing; rows without an id are their own component (null) and are kept; repeated rows have
equal results; classes that share their smallest id count as one; an empty table gives an
empty result; other columns are ignored by `near_duplicates`.  `without_near_duplicates`
keeps one row of each group with all its columns: rows without an id are compared as if
they had large ones, and of rows with one id and equal sets one stays.  Rows of one id with
different sets, and texts without words, all stay as `near_duplicates` tells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guardwork.llm.grouping import runs_of_groups
from guardwork.llm.shared import stored
from guardwork.llm.worker_memory import at_work
from guardwork.llm.words import blocks, mixed, text_bytes, window_hashes, word_hashes, words_of

CHUNKS = 10
CHUNK = 5
SYMBOLS = CHUNKS * CHUNK
PERCENT = 80
#: Signatures that differ in more symbols belong to less similar sets (but for 1 in 10 million).
MOST_ERRORS = 29
#: Classes of a tile; two tiles meet in a task.
TILE = 1024
#: Pairs of a star that a task compares with its centre, about.
STAR = 512
_SMALL = 64  # groups handed to Python together

_random = np.random.default_rng(30)
_XOR = _random.integers(0, 1 << 63, SYMBOLS, np.uint64)
_TIMES = _random.integers(0, 1 << 63, SYMBOLS, np.uint64) | np.uint64(1)
_KEY_SALT = _random.integers(0, 1 << 63, (CHUNKS, CHUNK), np.uint64)
_SET_SALT = _random.integers(0, 1 << 63, 2, np.uint64)


def shingle_sets(texts: list[bytes], size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For some texts at a time: index of the first, the distinct shingles of all in order, and
    where each text's begin (with the end of the last)."""
    for block in blocks(texts):
        words = words_of(block)
        hashes = word_hashes(block.data, words, fold_case=True)
        counts = np.diff(words.first)
        shingles = window_hashes(hashes, size)
        inside = words.text[: len(shingles)] == words.text[size - 1 :] if len(shingles) else np.zeros(0, bool)
        text, values = words.text[: len(shingles)][inside], shingles[inside]
        # A text of fewer words has one shingle, the whole of it; its length keeps it apart.
        few = np.flatnonzero((counts > 0) & (counts < size))
        whole = [int(window_hashes(hashes[words.first[t] : words.first[t + 1]], int(counts[t]))[0]) for t in few]
        text = np.concatenate((text, few))
        values = np.concatenate((values, mixed(np.array(whole, np.uint64) ^ counts[few].astype(np.uint64))))
        order = np.lexsort((values, text))
        text, values = text[order], values[order]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (values[1:] != values[:-1])
        text, values = text[new], values[new]
        yield block.first, values, np.searchsorted(text, np.arange(len(block.starts) + 1))


def signatures(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Signature symbols (uint16) of each of the non-empty sets values[starts[i]:starts[i+1]]."""
    out = np.empty((len(starts), SYMBOLS), np.uint16)
    for k in range(SYMBOLS):
        least = np.minimum.reduceat((values ^ _XOR[k]) * _TIMES[k], starts)
        out[:, k] = (mixed(least) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def index_keys(symbols: np.ndarray) -> np.ndarray:
    """Keys (int64) of signatures: for each chunk and each place left out in it."""
    chunks = symbols.reshape(len(symbols), CHUNKS, CHUNK).astype(np.uint64)
    keys = np.empty((len(symbols), CHUNKS, CHUNK), np.uint64)
    for out in range(CHUNK):
        packed = np.zeros((len(symbols), CHUNKS), np.uint64)
        for place in range(CHUNK):
            if place != out:
                packed = packed << np.uint64(16) | chunks[:, :, place]
        keys[:, :, out] = mixed(packed ^ _KEY_SALT[:, out])
    return keys.reshape(len(symbols), SYMBOLS).view(np.int64)


_SIGNED = "doc_id long, n_shingles long, set_a long, set_b long, signature binary"


def _signed(docs: DataFrame, size: int, more: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, the set's 128-bit name, its signature and more columns (long) of docs."""
    schema = ", ".join((_SIGNED, *(f"{c} long" for c in more)))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("near_duplicates")
        for batch in batches:
            n = batch.num_rows
            counts, names = np.zeros(n, np.int64), np.zeros((2, n), np.uint64)
            signed: list[bytes | None] = [None] * n
            for first, values, starts in shingle_sets(text_bytes(batch.column("text")), size):
                sizes = np.diff(starts)
                counts[first : first + len(sizes)] = sizes
                filled = np.flatnonzero(sizes)
                if len(filled):
                    at = starts[:-1][filled]
                    for i in range(2):
                        names[i, first + filled] = np.add.reduceat(mixed(values ^ _SET_SALT[i]), at)
                    for t, symbols in zip(filled.tolist(), signatures(values, at), strict=True):
                        signed[first + t] = symbols.tobytes()
            columns = [batch.column("doc_id"), counts, *names.view(np.int64), pa.array(signed, pa.binary())]
            columns += [batch.column(c) for c in more]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=[c.split()[0] for c in schema.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *more).mapInArrow(sign, schema)


def _keyed(classes: DataFrame) -> DataFrame:
    """key and node of each entry in the indexes."""

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("near_duplicates")
        for batch in batches:
            if batch.num_rows:
                symbols = _symbols(batch.column("signature"))
                keys = index_keys(symbols).reshape(-1)
                nodes = np.repeat(batch.column("node").to_numpy(), SYMBOLS)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(nodes)], names=["key", "node"])

    return classes.select("node", "signature").mapInArrow(enter, "key long, node long")


def _symbols(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, SYMBOLS)


def _sets(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """node and its full set, for the nodes alone."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("near_duplicates")
        for batch in batches:
            ids = batch.column("doc_id")
            for first, values, starts in shingle_sets(text_bytes(batch.column("text")), size):
                sets = [values[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(sets)), pa.array(sets, pa.binary())], names=["node", "members"]
                )

    wanted = nodes.withColumnRenamed("node", "doc_id").hint("shuffle_hash")
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id", "left_semi")
    return found.mapInArrow(collect, "node long, members binary")


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * intersection >= 80 * union, of sorted distinct values."""
    both = np.concatenate((a, b))
    both.sort()
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * shared >= PERCENT * (len(both) - shared)


def _could_be(n: F.Column, m: F.Column) -> F.Column:
    """Sizes that allow the similarity."""
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


def _confirmed(stars: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of stars that are links; part divides the pairs of a.

    The set of a is sent once for each part, and the sets of its pairs follow it.
    """
    centres = stars.select("a", "part").distinct().select("a", "part", F.col("a").alias("node"))
    rows = stars.select("a", "part", F.col("b").alias("node")).unionByName(centres).join(sets, "node")
    first = F.col("node") != F.col("a")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("near_duplicates")
        centre = np.zeros(0, np.uint64)
        for batch in batches:
            linked = []
            columns = (batch.column("a").to_pylist(), batch.column("node").to_pylist(), batch.column("members"))
            for a, node, members in zip(*columns, strict=True):
                found = np.frombuffer(members.as_buffer(), np.uint64)
                if a == node:
                    centre = found
                linked.append(a != node and similar(centre, found))
            chosen = batch.select(["a", "node"]).filter(pa.array(linked, pa.bool_()))
            yield pa.RecordBatch.from_arrays(chosen.columns, names=["a", "b"])

    ordered = rows.repartition("a", "part").sortWithinPartitions("a", "part", first)
    return ordered.select("a", "node", "members").mapInArrow(compare, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node that has a link (a, b).

    Labels take the smallest label around them and then the label of that label, until none
    changes; each round's labels are written.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(both.where("a <> b").distinct(), "links")
    labels = stored(
        edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("component")), "labels"
    )
    while True:
        around = (
            edges.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        nearer = labels.join(around, "node").select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("label")
        )
        # A label is a node with a label of its own.
        of_label = labels.select(F.col("node").alias("label"), F.col("component").alias("further"))
        new = stored(
            nearer.join(of_label, "label").select("node", "before", F.least("label", "further").alias("component")),
            "labels",
        )
        changed = not new.where("before <> component").isEmpty()
        labels = new.select("node", "component")
        if not changed:
            return labels


def _labelled(nodes: DataFrame, labels: DataFrame, column: str = "node") -> DataFrame:
    """Adds component; a node without a link is its own."""
    labels = labels.withColumnRenamed("node", column)
    return nodes.join(labels, column, "left").withColumn("component", F.coalesce("component", F.col(column)))


_TILED = "key long, low int, high int, node long, component long, tile int, n long, signature binary"
_TILE_KEYS = ["key", "low", "high"]


def _open_tiles(entries: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows for the keys where classes of further components meet, once for each pair of tiles.

    entries: key, leader, node.  The leader has been compared with all the others.  Its own
    component, as a rule most of a group of copies, fills the first tiles of a key; they meet
    the tiles of the others but not each other.
    """
    labelled = _labelled(entries, labels).withColumn("leads", F.col("node") == F.col("leader")).drop("leader")
    of_component = labelled.groupBy("key", "component").agg(
        F.count(F.when(~F.col("leads"), 1)).alias("n_nodes"), F.max("leads").alias("is_main")
    )
    open_keys = (
        of_component.groupBy("key")
        .agg(
            F.max(F.when(F.col("is_main"), F.col("component"))).alias("main"),
            F.count_if(F.col("n_nodes") > 0).alias("components"),
            *(
                F.ceil(F.coalesce(F.sum(F.when(which, F.col("n_nodes"))), F.lit(0)) / TILE).cast("int").alias(name)
                for name, which in (("mains", F.col("is_main")), ("others", ~F.col("is_main")))
            ),
        )
        .where("components > 1")
        .select("key", "main", "mains", "others")
    )
    rest = labelled.where("NOT leads").drop("leads")
    is_main = F.col("component") == F.col("main")
    within = F.when(is_main, F.col("mains")).otherwise(F.col("others"))
    first = F.when(is_main, F.lit(0)).otherwise(F.col("mains"))
    meets_from = F.when(is_main, F.col("mains")).otherwise(F.lit(0))
    return (
        rest.join(open_keys, "key")
        .withColumn("tile", (first + F.pmod(F.xxhash64("node"), within)).cast("int"))
        .withColumn("other", F.explode(F.sequence(meets_from, F.col("mains") + F.col("others") - 1)))
        .join(classes.select("node", "n", "signature"), "node")
        .select(
            "key",
            F.least("tile", "other").alias("low"),
            F.greatest("tile", "other").alias("high"),
            "node",
            "component",
            "tile",
            "n",
            "signature",
        )
    )


def pairs_to_compare(group: pa.Table) -> np.ndarray:
    """Index pairs of a tile pair's rows that are compared here: of different components and
    sizes that fit, near by signature, and not met under an earlier key."""
    symbols = _symbols(group.column("signature").combine_chunks())
    component, n, tile = (group.column(c).to_numpy() for c in ("component", "n", "tile"))
    across = component[:, None] != component
    across &= 100 * np.minimum(n[:, None], n) >= PERCENT * np.maximum(n[:, None], n)
    if group.column("low")[0] != group.column("high")[0]:
        across &= tile[:, None] != tile
    rows, columns = np.nonzero(np.triu(across, 1))
    if not len(rows):
        return np.zeros((0, 2), np.int64)
    keys = index_keys(symbols)
    here = int(np.flatnonzero((keys == group.column("key")[0].as_py()).all(axis=0))[0])
    for k in range(here):
        new = keys[rows, k] != keys[columns, k]
        rows, columns = rows[new], columns[new]
    near = np.zeros(len(rows), np.int64)
    for k in range(SYMBOLS):
        near += symbols[rows, k] != symbols[columns, k]
    order = np.argsort(near, kind="stable")
    order = order[near[order] <= MOST_ERRORS]
    return np.column_stack((rows[order], columns[order]))


def _each_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    for whole, starts in runs_of_groups(batches, _TILE_KEYS, _SMALL):
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            yield whole.slice(a, b - a)


def _worth_comparing(tiles: DataFrame) -> DataFrame:
    """The rows of tiles that have a pair to compare."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("near_duplicates")
        for group in _each_group(batches):
            chosen = np.unique(pairs_to_compare(group))
            if len(chosen):
                yield from group.take(pa.array(chosen)).combine_chunks().to_batches()

    return _together(tiles).mapInArrow(choose, _TILED)


def _together(tiles: DataFrame) -> DataFrame:
    return tiles.repartition(*_TILE_KEYS).sortWithinPartitions(*_TILE_KEYS)


def _links_in_tiles(tiles: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between components, as few for each tile pair as join them."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("near_duplicates")
        for group in _each_group(batches):
            component = group.column("component").to_pylist()
            sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in group.column("members")]
            above: dict[int, int] = {}

            def top(c: int, above=above) -> int:
                while c in above:
                    c = above[c]
                return c

            links = []
            for i, j in pairs_to_compare(group).tolist():
                a, b = top(component[i]), top(component[j])
                if a != b and similar(sets[i], sets[j]):
                    above[max(a, b)] = min(a, b)
                    links.append({"a": component[i], "b": component[j]})
            if links:
                yield pa.RecordBatch.from_pylist(links)

    return _together(tiles.join(sets, "node").select(*[c.split()[0] for c in _TILED.split(", ")], "members")).mapInArrow(
        compare, "a long, b long"
    )


def near_duplicates(docs: DataFrame, size: int) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept; shingles of `size` words."""
    return _grouped(docs, size).select("doc_id", "n_shingles", "component_id", "kept")


def _grouped(docs: DataFrame, size: int, more: tuple[str, ...] = ()) -> DataFrame:
    """The rows of `near_duplicates` with the set's name and more columns (long) of docs."""
    signed = stored(_signed(docs, size, more), "signatures")
    classes = stored(
        signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("set_a", "set_b")
        .agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature")),
        "classes",
    )
    entries = _keyed(classes)
    leaders = entries.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("last"))
    entries = stored(entries.join(leaders.where("leader <> last"), "key").select("key", "leader", "node"), "entries")
    sets = stored(_sets(docs, entries.select("node").distinct(), size), "sets")

    sizes = classes.select("node", "n")
    pairs = entries.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    parts = F.ceil(F.count(F.lit(1)) / STAR).alias("parts")
    centres = pairs.groupBy("a").agg(parts).join(sizes.select(F.col("node").alias("a"), F.col("n").alias("n_a")), "a")
    stars = (
        pairs.join(centres, "a")
        .join(sizes.select(F.col("node").alias("b"), F.col("n").alias("n_b")), "b")
        .where(_could_be(F.col("n_a"), F.col("n_b")))
        .select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"))
    )
    labels = components(_confirmed(stored(stars, "stars"), sets))

    tiles = stored(_worth_comparing(_open_tiles(entries, labels, classes)), "tiles")
    if not tiles.isEmpty():
        joined = components(_links_in_tiles(tiles, sets)).withColumnRenamed("component", "joined")
        every = classes.select("node")
        labels = (
            _labelled(every, labels)
            .join(joined.withColumnRenamed("node", "component"), "component", "left")
            .select("node", F.coalesce("joined", "component").alias("component"))
        )

    named = _labelled(classes.select("set_a", "set_b", "node"), labels).select("set_a", "set_b", "component")
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return (
        signed.select("doc_id", "n_shingles", "set_a", "set_b", *more)
        .join(named, ["set_a", "set_b"], "left")
        .withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")))
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
        .withColumn("kept", kept)
    )


_ROW = ("row_a", "row_b")


def _without_maps(docs: DataFrame) -> list[str]:
    """The columns that can be hashed."""
    return [f.name for f in docs.schema if "map<" not in f.dataType.simpleString()]


def without_near_duplicates(docs: DataFrame, size: int) -> DataFrame:
    """One row of each group, of the smallest id, with all its columns."""
    columns = [F.col(f"`{c}`") for c in _without_maps(docs)]
    keys = [F.xxhash64(F.lit(i), *columns).alias(c) for i, c in enumerate(_ROW)]
    # Ids of rows that have none, behind all others: equal texts get equal ones.
    own = F.shiftrightunsigned(F.xxhash64("text"), 2) + F.lit(1 << 62)
    known = docs.select(F.coalesce(F.col("doc_id").cast("long"), own).alias("doc_id"), "text", *keys)
    kept = _grouped(known, size, _ROW).where("kept")
    one = ["doc_id", "set_a", "set_b"]
    chosen = (
        kept.where("n_shingles > 0")
        .groupBy(*one, *_ROW)
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*one)
        .agg(F.min(F.struct(*_ROW, "n")).alias("row"))
        .select("row.*")
    )
    wordless = kept.where("n_shingles = 0").select(*_ROW, F.lit(1).cast("long").alias("n")).distinct()
    chosen = stored(chosen.unionByName(wordless), "kept-rows")
    rows = docs.select(F.struct("*").alias("doc"), *keys)
    out = rows.join(chosen.where("n = 1"), list(_ROW), "left_semi")
    repeated = chosen.where("n > 1")
    if not repeated.isEmpty():  # equal rows, which no key tells apart
        out = out.unionByName(rows.join(repeated, list(_ROW), "left_semi").dropDuplicates(list(_ROW)))
    return out.select("doc.*")
