"""Mixing sources to target weights by weighted fair queueing.

Each source queues its documents in shuffled order, up to `MOST_EPOCHS` times over.  A
document's virtual finish time is the source's words up to and with it, divided by the
source's target.  The mix takes documents by finish time over all sources until the total
budget is used up, so every source stops near its target.

No source is gathered in one task: running sums are formed within slices of the shuffled
order and joined by the slices' totals.  The copies are then sorted by finish time over all
partitions; the partitions' totals tell which one holds the end, and a running sum within it
where.  Ties are divided too, as the sort's key is unique.  Targets are worked out from a
row for each source in one task, so there may be `MOST_SOURCES` of them.

Defined results: a null text has no words and a null source is the last one; documents
without words are in the queue and take nothing; rows equal in id, source and size are
taken alike; a table without words, or an empty one, gives targets of 0; other columns are
ignored by `mix` and kept by `mixed_documents`.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from guardwork.llm.shared import stored

#: A source's target is at most this many times its words.
MOST_EPOCHS = 3
#: The weights of the sources in order of their names, repeating.
WEIGHTS = (1, 2, 3)
#: Rows that a slice of the shuffled order holds on average.
SLICE_ROWS = 64
MOST_SLICE_BITS = 20
MOST_SOURCES = 1_000_000


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source and size: the number of words, 0 for no text."""
    return docs.select(
        "doc_id",
        "source",
        F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
    )


def source_targets(totals: DataFrame) -> DataFrame:
    """source, source_size and target, from (source, source_size).

    Without bounds each target is level * weight.  A source whose bound lies below that gives
    its excess to the others, which raises the level; sources are bounded in order of bound
    over weight, so running sums in that order hold the level for every possible number of
    bounded sources.  The level rises up to the first row that bounds no further source, whose
    level is the right one, and falls behind it.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    ratio = Window.partitionBy(F.lit(0)).orderBy("at", F.col("source").asc_nulls_last())
    earlier = ratio.rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("order") % len(WEIGHTS) + 1).cast("int"))
    level = (F.col("all_size") - F.coalesce(F.sum("bound").over(earlier), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))
    )
    return (
        totals.withColumn("order", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("bound", MOST_EPOCHS * F.col("source_size"))
        .withColumn("at", F.col("bound") / F.col("weight"))
        .withColumn("all_size", F.sum("source_size").over(everything))
        .withColumn("level", level)
        .withColumn("free", F.when(F.col("at") >= F.col("level"), F.col("level")))
        .withColumn("free", F.max("free").over(everything))
        .select(
            "source",
            "source_size",
            F.least(F.col("bound").cast("double"), F.coalesce("free", F.lit(0.0)) * F.col("weight")).alias("target"),
        )
    )


def queued(items: DataFrame, rows: int, seed: int) -> DataFrame:
    """Adds target, source_size, source_order, place (in the shuffled order) and the words `before`.

    items: doc_id, source, size, n (equal rows).  The slice is the head of the shuffle hash.
    """
    bits = min(MOST_SLICE_BITS, max(0, math.ceil(math.log2(max(1, rows) / SLICE_ROWS))))
    place = F.xxhash64(F.lit(seed), "doc_id", "source", "size")
    items = items.withColumn("place", place).withColumn(
        "slice", (F.shiftrightunsigned("place", 64 - bits) if bits else F.lit(0)).cast("long")
    )
    slices = items.groupBy("source", "slice").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    totals = slices.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(totals)
    order = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        slices.withColumn("slice_start", F.coalesce(F.sum("words").over(order), F.lit(0)))
        .alias("s")
        .join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")))
        .select("s.source", "s.slice", "s.slice_start", "t.source_size", "t.target")
    )
    within = (
        Window.partitionBy("source", "slice")
        .orderBy("place", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        items.withColumn("before", F.coalesce(F.sum(F.col("size") * F.col("n")).over(within), F.lit(0)))
        .alias("i")
        .join(
            slices.alias("s"),
            F.col("i.source").eqNullSafe(F.col("s.source")) & (F.col("i.slice") == F.col("s.slice")),
        )
        .select(
            "i.doc_id",
            "i.source",
            "i.size",
            "i.n",
            "i.place",
            (F.col("i.before") + F.col("s.slice_start")).alias("before"),
            "s.source_size",
            "s.target",
        )
    )


def _finish(epoch) -> F.Column:
    """Virtual finish time of a document's copy of that epoch (from 0)."""
    words = epoch * F.col("source_size") + F.col("before") + F.col("size") * F.col("n")
    return F.when(F.col("target") > 0, words / F.col("target")).otherwise(F.lit(0.0))


def copies_in_queue(queue: DataFrame) -> DataFrame:
    """A row for each copy: epoch, finish (virtual finish time) and its words."""
    return (
        queue.withColumn("epoch", F.explode(F.array(*map(F.lit, range(MOST_EPOCHS)))))
        .withColumn("finish", _finish(F.col("epoch")))
        .withColumn("words", F.col("size") * F.col("n"))
    )


_ORDER = ("finish", "source", "epoch", "place", "doc_id", "size")


def sorted_copies(queue: DataFrame) -> DataFrame:
    """All copies, range-sorted over the partitions, with the number of their partition."""
    parts = int(queue.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copies = copies_in_queue(queue).select(*_ORDER, "words")
    ordered = copies.repartitionByRange(parts, *_ORDER).sortWithinPartitions(*_ORDER)
    return stored(ordered.withColumn("part", F.spark_partition_id()), "mix-order")


def mix_end(queue: DataFrame):
    """The last copy that the mix takes, as a row of the columns that order the mix; None if all."""
    copies = sorted_copies(queue)
    totals = dict(copies.groupBy("part").agg(F.sum("words")).collect())  # a row for each partition
    budget = queue.agg(F.sum(F.col("size") * F.col("n"))).first()[0] or 0
    total = 0
    for at in sorted(totals):
        if total + totals[at] > budget:
            break
        total += totals[at]
    else:
        return None  # everything fits
    running = F.sum("words").over(Window.partitionBy("part").orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, 0))
    inside = copies.where(F.col("part") == at).withColumn("running", running).where(F.col("running") <= budget - total)
    # If the partition's first copy is too large already, the end is the last one before it.
    for rows in (inside, copies.where(F.col("part") < at)):
        end = rows.orderBy(*(F.col(c).desc() for c in _ORDER)).select(*_ORDER).first()
        if end is not None:
            return end
    return (-1.0, None, -1, 0, None, 0)  # before all copies


def mix_queue(docs: DataFrame, seed: int) -> DataFrame:
    """The queue of all sources, written down: equal rows are one, n times."""
    items = stored(
        sized(docs).groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-items"
    )
    rows, sources = items.agg(F.count(F.lit(1)), F.approx_count_distinct("source")).first()
    if sources > MOST_SOURCES:
        raise ValueError(f"about {sources} sources; {MOST_SOURCES} at most can be mixed")
    return stored(queued(items, rows, seed), "mix-queue")


def mix(docs: DataFrame, seed: int = 7) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    queue = mix_queue(docs, seed)
    return _expanded(_taken(queue, mix_end(queue)))


def _taken(queue: DataFrame, end) -> DataFrame:
    """Adds copies: how many epochs of each document come no later than the end."""

    def comes(epoch: int):
        if end is None:
            return F.lit(1)
        key = F.struct(
            _finish(F.lit(epoch)).alias("a"),
            F.col("source").alias("b"),
            F.lit(epoch).alias("c"),
            F.col("place").alias("d"),
            F.col("doc_id").alias("e"),
            F.col("size").alias("f"),
        )
        kinds = dict(queue.dtypes)
        types = ("double", kinds["source"], "int", "bigint", kinds["doc_id"], "bigint")
        last = F.struct(*(F.lit(v).cast(t).alias(n) for v, t, n in zip(end, types, "abcdef", strict=True)))
        return (key <= last).cast("int")

    return queue.withColumn("copies", sum((comes(e) for e in range(1, MOST_EPOCHS)), comes(0)))


def _expanded(taken: DataFrame) -> DataFrame:
    """One row for each of n equal rows."""
    return taken.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mix_order(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The mix itself, sorted over all partitions: doc_id, source, size, epoch, finish."""
    queue = mix_queue(docs, seed)
    taken = _taken(queue, mix_end(queue))
    return (
        copies_in_queue(taken)
        .where("epoch < copies")
        .orderBy(*_ORDER)
        .withColumn("row", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
        .select("doc_id", "source", "size", "epoch", "finish")
    )


def mixed_documents(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The documents of the mix with all their columns, each as often as the mix takes it."""
    queue = mix_queue(docs, seed)
    taken = _taken(queue, mix_end(queue)).where("copies > 0")
    size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    d, t = docs.alias("d"), taken.select("doc_id", "source", "size", "copies").alias("t")
    joined = d.join(
        t,
        F.col("d.doc_id").eqNullSafe(F.col("t.doc_id"))
        & F.col("d.source").eqNullSafe(F.col("t.source"))
        & (size == F.col("t.size")),
    )
    whole = F.struct(*(F.col(f"d.`{c}`").alias(c) for c in docs.columns))
    return joined.select(F.explode(F.array_repeat(whole, F.col("t.copies").cast("int"))).alias("doc")).select("doc.*")
