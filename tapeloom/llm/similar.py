"""Links between items that are sets of hashes: buckets, blocks, exact Jaccard, components.

Items are 64-bit ids of different sets, so copies are one item. Members of a bucket or of a
component are dealt to blocks by a hash, and two blocks meet in one group of rows; a hot bucket
is then many groups of bounded size, spread over tasks. Nothing is emitted per pair: a group
yields counts per item and a spanning forest of its links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.frames import released, stored

#: Items per block on average, and hashes of their sets; a group holds two blocks.
BLOCK = 1024
BLOCK_HASHES = 1 << 20
#: Pairs compared in one numpy call.
PAIRS = 1 << 18


def least_matches(hashes: int, threshold: float, tolerance: float, step: int) -> np.ndarray:
    """Entry n: the fewest equal MinHash values among the first n that keep a pair.

    With a uniform prior on the similarity, its posterior probability of being at least t,
    after m of n equal values, is the chance of at most m successes in n + 1 trials with
    success t. A pair goes once that is below the tolerance; it is looked at every `step`.
    """
    exact = Fraction(str(threshold))
    out = np.zeros(hashes + 1, dtype=np.int64)
    limit = Fraction(str(tolerance))
    for n in range(step, hashes + 1, step):
        total = Fraction(0)
        for m in range(n + 1):
            total += comb(n + 1, m) * exact**m * (1 - exact) ** (n + 1 - m)
            if total >= limit:
                out[n] = m
                break
    return out


def in_blocks(rows: DataFrame, key: str, item: str, blocks: Column) -> DataFrame:
    """Rows of a group cut into `blocks`, once for each pair of blocks that the item's block is in.

    `half` is 0 in the lower block of a pair and 1 in the upper one; the pair of a block with
    itself has half 0 only, and `same` is true in it. `meet` is the hash that brings a pair of
    blocks together.
    """
    own = F.pmod(F.xxhash64(F.lit(11), item), F.col("_blocks")).cast("int")
    out = rows.withColumn("_blocks", F.ceil(blocks).cast("int")).withColumn("_own", own)
    out = out.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
    return (
        out.withColumn("meet", F.xxhash64(F.col(key), low, high))
        .withColumn("half", F.when((low != high) & (F.col("_own") == high), 1).otherwise(0))
        .withColumn("same", low == high)
        .drop("_blocks", "_own", "_other")
    )


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by `key`: many groups a table, none cut."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy(zero_copy_only=False)
        last = np.searchsorted(values, values[-1], side="left")
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = [batch.slice(last)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def over_groups(
    rows: DataFrame, function: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """Bring rows with the same `meet` together and hand whole groups to the function."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in grouped(batches, "meet"):
            yield from function(part.combine_chunks())

    dealt = rows.repartition("meet").sortWithinPartitions("meet", "half")
    return dealt.mapInArrow(lambda batches: released(run(batches)), schema)


def fixed(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    """Binary values of one size each as rows of an array."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(array):
        return np.empty((0, 0), dtype=kind)
    raw = b"".join(array.to_pylist())
    return np.frombuffer(raw, dtype=kind).reshape(len(array), -1)


def edges_of(meet: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.flatnonzero(meet[1:] != meet[:-1]) + 1, [len(meet)]))


def pairs_of(meet: np.ndarray, half: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs to compare, in runs of about PAIRS: of one block, or across two."""
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    total = 0
    edges = edges_of(meet)
    for start, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
        border = start + int(np.searchsorted(half[start:end], 1))
        width = max(1, PAIRS // (end - start))
        for at in range(start, border, width):
            stop = min(at + width, border)
            first = at + 1 if border == end else border
            a = np.repeat(np.arange(at, stop), end - first)
            b = np.tile(np.arange(first, end), stop - at)
            if border == end:
                a, b = a[b > a], b[b > a]
            left.append(a)
            right.append(b)
            total += len(a)
            if total >= PAIRS:
                yield np.concatenate(left), np.concatenate(right)
                left, right, total = [], [], 0
    if total:
        yield np.concatenate(left), np.concatenate(right)


def forest(items: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(item, root): the smallest item that each linked one reaches over the links (a, b)."""
    nodes, ends = np.unique(np.concatenate((items[a], items[b])), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    away = label != np.arange(len(nodes))
    return nodes[away], nodes[label[away]]


def buckets(bands: DataFrame) -> DataFrame:
    """(bucket, item, members) of the buckets that hold two items or more."""
    sizes = bands.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1")
    return bands.join(sizes, "bucket")


def likely(rows: DataFrame, hashes: int, threshold: float, tolerance: float, step: int = 8) -> DataFrame:
    """(item, root) over the pairs of a group whose MinHash values keep them likely enough.

    `rows`: bucket, item, members, sketch (the lowest byte of each MinHash value: unequal
    values agree in it by chance once in 256 times, which only keeps a few pairs more). Values
    are compared step by step; a pair is dropped as soon as its posterior falls below the
    tolerance.
    """
    least = least_matches(hashes, threshold, tolerance, step)

    def prune(part: pa.Table) -> Iterator[pa.RecordBatch]:
        meet, half, items = (part.column(c).to_numpy() for c in ("meet", "half", "item"))
        values = fixed(part.column("sketch"), "u1")
        for a, b in pairs_of(meet, half):
            matches = np.zeros(len(a), dtype=np.int64)
            for n in range(0, hashes, step):
                end = min(n + step, hashes)
                matches += (values[a, n:end] == values[b, n:end]).sum(axis=1)
                keep = matches >= least[end]
                a, b, matches = a[keep], b[keep], matches[keep]
                if not len(a):
                    break
            if len(a):
                item, root = forest(items, a, b)
                yield pa.record_batch([pa.array(item), pa.array(root)], names=["item", "root"])

    blocks = F.col("members") / BLOCK
    dealt = in_blocks(rows, "bucket", "item", blocks).select("meet", "half", "item", "sketch")
    return over_groups(dealt, prune, "item bigint, root bigint").distinct()


def shared_counts(sets: list[np.ndarray], border: int) -> np.ndarray:
    """Sizes of the intersections of sets before the border with those from it on (0: all with all)."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, at, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = n[at] > 1
    owner, at = owner[often], at[often]
    rank = np.cumsum(n > 1) - 1
    at = rank[at]
    low = slice(0, border or len(sets))
    high = slice(border, len(sets))
    out = np.zeros((low.stop, len(sets) - border), dtype=np.float32)
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    width = 4096
    for start in range(0, int(rank[-1]) + 1 if len(rank) else 0, width):
        here = slice(*np.searchsorted(at, (start, start + width)))
        marks = np.zeros((len(sets), width), dtype=np.float32)
        marks[owner[here], at[here] - start] = 1
        out += marks[low] @ marks[high].T
    return out.astype(np.int64)


def exact(rows: DataFrame, threshold: float) -> DataFrame:
    """(item, links, root) from all pairs inside a component, by exact Jaccard of their sets.

    `rows`: component, item, members, total (hashes of all members' sets), copies, hashes
    (64-bit, different, of one item). Links count the copies of the other side. A row is what one group found of an item; sum over them.
    """
    ratio = Fraction(str(threshold))

    def verify(part: pa.Table) -> Iterator[pa.RecordBatch]:
        meet, half, items, copies = (
            part.column(c).to_numpy() for c in ("meet", "half", "item", "copies")
        )
        raw, same = part.column("hashes"), part.column("same").to_numpy()
        edges = edges_of(meet)
        for start, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if end - start < 2:
                continue
            # A repeated row of a document has brought its set twice.
            once = np.unique(np.column_stack((half[start:end], items[start:end])), axis=0, return_index=True)[1]
            once += start
            border = int(np.searchsorted(half[once], 1))
            # Two blocks of which one is empty have no pairs; each meets itself elsewhere.
            if len(once) < 2 or not (same[start] or 0 < border < len(once)):
                continue
            border %= len(once)
            sets = [np.frombuffer(raw[int(r)].as_buffer(), dtype="<u8") for r in once]
            both = shared_counts(sets, border)
            sizes = np.array([len(s) for s in sets])
            union = sizes[: both.shape[0], None] + sizes[None, border:] - both
            linked = both * ratio.denominator >= union * ratio.numerator
            if not border:
                linked = np.triu(linked, 1)
            a, b = np.nonzero(linked)
            if not len(a):
                continue
            b = b + border
            weight, own = copies[once], items[once]
            links = np.bincount(a, weight[b], len(once)) + np.bincount(b, weight[a], len(once))
            item, root = forest(own, a, b)
            roots = dict(zip(item.tolist(), root.tolist()))
            some = np.flatnonzero(links)
            yield pa.record_batch(
                [pa.array(own[some]), pa.array(links[some].astype(np.int64)),
                 pa.array([roots.get(i, i) for i in own[some].tolist()], pa.int64())],
                names=["item", "links", "root"],
            )

    blocks = F.greatest(F.col("members") / BLOCK, F.col("total") / BLOCK_HASHES)
    dealt = in_blocks(rows, "component", "item", blocks).select(
        "meet", "half", "same", "item", "copies", "hashes"
    )
    return over_groups(dealt, verify, "item bigint, links bigint, root bigint")


def components(edges: DataFrame) -> DataFrame:
    """(item, component): the smallest item of each connected component of (item, root) edges.

    Large-star and small-star in turn until the edges are stars: each turn is two aggregations
    over a number of rows that never grows, written out so that no lineage builds up.
    """
    stars = stored(edges.filter("item <> root").select("item", "root").distinct(), "links")
    before = None
    while True:
        size = stars.agg(F.count("*"), F.sum(F.expr("xxhash64(item, root) % 1000000007"))).first()
        if tuple(size) == before or not size[0]:
            break
        before = tuple(size)
        # Large star: neighbours above a node go to the smallest neighbour, itself included.
        both = stars.unionByName(stars.select(F.col("root").alias("item"), F.col("item").alias("root")))
        low = both.groupBy("item").agg(F.least(F.min("root"), F.col("item")).alias("low"))
        large = (
            both.join(low, "item").filter("root > item")
            .select(F.col("root").alias("item"), F.col("low").alias("root")).distinct()
        )
        # Small star: a node and its neighbours below go to the smallest of them.
        low = large.groupBy("item").agg(F.min("root").alias("low"))
        small = large.join(low, "item").select(
            F.explode(F.array(F.struct("item", F.col("low").alias("root")),
                              F.struct(F.col("root").alias("item"), F.col("low").alias("root")))).alias("e")
        ).select("e.item", "e.root").filter("item <> root").distinct()
        stars = stored(small, "links")
    roots = stars.select(F.col("root").alias("item"), F.col("root").alias("component")).distinct()
    return stars.select("item", F.col("root").alias("component")).unionByName(roots)
