"""Prefix trie of conversations from sorted neighbours.

Conversations are sorted by their turns, so every node of the trie is a run of neighbours, and
its branching ones come out of union-find over the neighbours' common prefixes: edges are taken
in descending depth, and each merge of components makes a node of that depth. A partition of
the sorted order builds its own forest. Nodes that reach neither end of the partition are
done; the others, which lie on the paths of its first and last conversation, are contracted to
sums per prefix and merged with those of the other partitions and of the edges between them.

All that a node reports are sums over its conversations and over the edges between them. With
B(e) the bytes of the first e turns, a node at depth d saves the sum of B(common depth) over
its edges, less B(d - 1) for each of them. Turns are compared by 128-bit hashes. A task holds
8 bytes a turn of its share, and the hashes of two conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tapeloom.llm.frames import arrow_map, pick, stored, table

#: A conversation takes its first h turns from the one with the next lower multiple of this id.
FAMILY, MOST_SHARED = 5, 9
NOBODY = hashlib.sha256(b"").hexdigest()
ROOT = b""


def ordered(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, keys, sizes): hashes and text bytes of each conversation's turns, in order.

    Equal turns of a conversation go by their hashes; repeated rows are turns of their own.
    """
    rows = pick(conversations, conv_id=conv_id, turn=turn, role=role, text=text).filter("conv_id IS NOT NULL")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # The role's length keeps the two apart.
    key = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    turns = rows.select("conv_id", F.struct("turn", key.alias("key"), F.octet_length(text).cast("long").alias("size")).alias("t"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("own")).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("own.key").alias("keys"), F.col("own.size").alias("sizes")
    )


def rebuilt(own: DataFrame) -> DataFrame:
    """Each conversation c with its first h turns taken from conversation c - c % 5.

    h is crc32 of the decimal id, modulo 9; `%` takes the sign of c. Fewer turns give all of
    them, no such conversation none; the own turns follow from number h + 1 on.
    """
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED
    heads = own.filter(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("base"),
        F.slice("keys", 1, MOST_SHARED).alias("head_keys"), F.slice("sizes", 1, MOST_SHARED).alias("head_sizes"),
    )
    met = own.withColumn("h", shared.cast("int")).withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY)
    met = met.join(heads, "base", "left")

    def joined(name: str) -> Column:
        head = F.slice(F.coalesce(f"head_{name}", F.slice(name, 1, 0)), F.lit(1), F.col("h"))
        rest = F.slice(name, F.col("h") + 1, F.greatest(F.size(name) - F.col("h"), F.lit(0)))
        return F.concat(head, rest).alias(name)

    return met.select("conv_id", joined("keys"), joined("sizes"))


def distinct_paths(paths: DataFrame) -> DataFrame:
    """(keys, sizes, copies, conv_id, ends): different sequences, with the smallest id of their
    conversations and the SHA-256 of all their ids."""
    print_ = F.aggregate("keys", F.unhex(F.lit("")), lambda acc, key: F.unhex(F.md5(F.concat(acc, key))))
    named = stored(paths.withColumn("print", print_), "trie-paths")
    counts = named.groupBy("print").agg(F.count("*").alias("copies"), F.min("conv_id").alias("conv_id"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sorted by print and id: a group of any size passes through one running hash.
        held, digest, out = None, None, []
        for batch in batches:
            for print_, conv in zip(batch.column("print").to_pylist(), batch.column("conv_id").to_pylist()):
                if print_ != held:
                    if digest:
                        out.append((held, digest.hexdigest()))
                    held, digest = print_, hashlib.sha256(b"%d" % conv)
                else:
                    digest.update(b",%d" % conv)
            yield rows_of(out)
            out = []
        if digest:
            yield rows_of([(held, digest.hexdigest())])

    def rows_of(out: list[tuple[bytes, str]]) -> pa.RecordBatch:
        prints, ends = zip(*out) if out else ((), ())
        return pa.record_batch([pa.array(prints, pa.binary()), pa.array(ends, pa.string())], names=["print", "ends"])

    ids = named.select("print", "conv_id").repartition("print").sortWithinPartitions("print", "conv_id")
    ends = ids.mapInArrow(digests, "print binary, ends string")
    shown = counts.join(named.select("conv_id", "keys", "sizes"), "conv_id").join(ends, "print")
    return stored(shown.select("keys", "sizes", "copies", "conv_id", "ends"), "trie-sequences")


def common(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    unlike = np.flatnonzero(a[:n] != b[:n])
    return int(unlike[0]) if len(unlike) else n


def prints_of(keys: np.ndarray) -> list[bytes]:
    """A hash of every prefix, the empty one first."""
    out = [ROOT]
    for key in keys:
        out.append(hashlib.md5(out[-1] + bytes(key)).digest())
    return out


class Forest:
    """The trie of a partition's different sequences, in sorted order."""

    def __init__(self) -> None:
        self.lengths: list[int] = []
        self.common: list[int] = []
        self.copies: list[int] = []
        self.convs: list[int] = []
        self.ends: list[str] = []
        self.bytes: list[np.ndarray] = []
        self.first = self.last = np.empty(0, dtype="V16")

    def add(self, keys: np.ndarray, sizes: np.ndarray, copies: int, conv: int, ends: str) -> None:
        if not self.lengths:
            self.first = keys
        self.common.append(common(self.last, keys) if self.lengths else 0)
        self.lengths.append(len(keys))
        self.copies.append(copies)
        self.convs.append(conv)
        self.ends.append(ends)
        self.bytes.append(np.concatenate(([0], np.cumsum(sizes))))
        self.last = keys

    def grow(self) -> None:
        """Union-find over the edges, deepest first; nodes 0 .. n - 1 are the sequences."""
        n = len(self.lengths)
        nodes = max(2 * n - 1, 1)
        self.depth = np.zeros(nodes, dtype=np.int64)
        self.parent = np.full(nodes, -1, dtype=np.int64)
        self.low, self.high = np.arange(nodes), np.arange(nodes)
        self.least = np.zeros(nodes, dtype=np.int64)
        self.members = np.zeros(nodes, dtype=np.int64)
        self.shared = np.zeros(nodes, dtype=np.int64)
        self.leaves = np.zeros(nodes, dtype=np.int64)
        self.merges = np.zeros(nodes, dtype=np.int64)
        self.depth[:n], self.least[:n], self.members[:n] = self.lengths, self.convs, self.copies
        self.shared[:n] = [(c - 1) * int(b[-1]) for c, b in zip(self.copies, self.bytes)]
        # A sequence that the next one continues is no leaf; the last one is, as far as known here.
        following = np.append(self.common[1:], -1)
        self.leaves[:n] = following < self.depth[:n]
        leader = np.arange(n)
        top = np.arange(n)

        def find(at: int) -> int:
            while leader[at] != at:
                leader[at] = leader[leader[at]]
                at = leader[at]
            return at

        self.n = n
        edges = np.array(self.common[1:], dtype=np.int64)
        for edge in np.argsort(-edges, kind="stable").tolist():
            depth = int(edges[edge])
            left, right = find(edge), find(edge + 1)
            a, b = int(top[left]), int(top[right])
            # From left to right within a depth, only the left part can be a node of this depth.
            if a >= n and self.depth[a] == depth:
                node = a
            else:
                node, self.n = self.n, self.n + 1
                self.depth[node], self.low[node], self.parent[a] = depth, self.low[a], node
                for values in (self.least, self.members, self.shared, self.leaves):
                    values[node] = values[a]
            self.parent[b] = node
            self.high[node] = self.high[b]
            self.least[node] = min(self.least[node], self.least[b])
            for values in (self.members, self.shared, self.leaves):
                values[node] += values[b]
            self.shared[node] += int(self.bytes[edge + 1][depth])
            self.merges[node] += 1
            leader[right] = left
            top[left] = node

    def rows(self) -> Iterator[pa.RecordBatch]:
        """Finished nodes, open ones as sums per prefix, and the two ends of the partition."""
        self.grow()
        n, last = self.n, len(self.lengths) - 1
        depth, parent, low, high = (v[:n] for v in (self.depth, self.parent, self.low, self.high))
        lengths, ends = np.array(self.lengths), np.array(self.ends)
        above = np.where(parent >= 0, depth[parent], -1)
        is_open = (low == 0) | (high == last)
        ended = lengths[low] == depth
        first, final = prints_of(self.first), prints_of(self.last)
        offset = np.cumsum(lengths + 1) - lengths - 1
        flat = np.concatenate(self.bytes)

        def levels(nodes: np.ndarray) -> tuple[np.ndarray, ...]:
            """(node, depth) of every trie node that these stand for."""
            counts = depth[nodes] - above[nodes]
            of = np.repeat(nodes, counts)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
            return of, above[of] + 1 + nth

        def batch(of: np.ndarray, at: np.ndarray, kind: str, **own: list) -> pa.RecordBatch:
            ends_here = ended[of] & (at == depth[of])
            base = np.where(at > 0, flat[offset[low[of]] + np.maximum(at - 1, 0)], 0)
            columns = {
                "kind": [kind] * len(of), "depth": at, "conv_id": self.least[of], "n_convs": self.members[of],
                "shared": self.shared[of], "base": base, "merges": np.where(at == depth[of], self.merges[of], 0),
                "ended": ends_here.astype(np.int64), "n_leaves": self.leaves[of],
                "ends": np.where(ends_here, ends[low[of]], NOBODY), **own,
            }
            return whole(columns, len(of))

        closed = np.flatnonzero(~is_open)
        for some in np.array_split(closed, max(1, len(closed) // 4096)):
            of, at = levels(some)
            over = parent[of]
            top = at - 1 == above[of]
            outside = top & is_open[over]
            conv = np.where(top, self.least[over], self.least[of])
            prints = [
                (first if low[p] == 0 else final)[int(d) - 1] if o else None
                for p, d, o in zip(over.tolist(), at.tolist(), outside.tolist())
            ]
            yield batch(of, at, "node", parent_conv_id=pa.array(conv, mask=outside), parent=prints)
        of, at = levels(np.flatnonzero(is_open))
        on = [(first if low[v] == 0 else final) for v in of.tolist()]
        yield batch(
            of, at, "part", print=[p[d] for p, d in zip(on, at.tolist())],
            parent=[p[d - 1] if d else None for p, d in zip(on, at.tolist())],
        )
        ends_of = {
            "kind": ["ends"], "first": [[bytes(k) for k in self.first]],
            "last": [[bytes(k) for k in self.last]], "bytes": [self.bytes[-1].tolist()],
        }
        yield whole(ends_of, 1)


SCHEMA = (
    "kind string, depth bigint, conv_id bigint, n_convs bigint, shared bigint, base bigint, merges bigint, "
    "ended bigint, n_leaves bigint, ends string, parent_conv_id bigint, print binary, parent binary, "
    "first array<binary>, last array<binary>, bytes array<bigint>"
)
_ARROW = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary(),
          "array<binary>": pa.list_(pa.binary()), "array<bigint>": pa.list_(pa.int64())}


def whole(columns: dict, n: int) -> pa.RecordBatch:
    """A batch of SCHEMA; columns not given are null."""
    fields = [field.split() for field in SCHEMA.split(", ")]
    arrays = []
    for name, kind in fields:
        values = columns.get(name)
        if values is None:
            arrays.append(pa.nulls(n, _ARROW[kind]))
        elif isinstance(values, pa.Array):
            arrays.append(values)
        else:
            arrays.append(pa.array(values.tolist() if isinstance(values, np.ndarray) else values, _ARROW[kind]))
    return pa.record_batch(arrays, names=[name for name, _ in fields])


def key_rows(column: pa.ListArray) -> list[np.ndarray]:
    """The 16-byte hashes of each row."""
    raw = np.frombuffer(b"".join(column.flatten().to_pylist()), dtype="V16")
    return np.split(raw, np.cumsum(np.diff(column.offsets.to_numpy()))[:-1])


def planted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The forest of one partition of sorted sequences."""
    forest = Forest()
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = key_rows(batch.column("keys"))
        sizes = batch.column("sizes")
        sizes = np.split(sizes.flatten().to_numpy(), np.cumsum(np.diff(sizes.offsets.to_numpy()))[:-1])
        rest = (batch.column(c).to_pylist() for c in ("copies", "conv_id", "ends"))
        for row in zip(keys, sizes, *rest):
            forest.add(*row)
    if forest.lengths:
        yield from forest.rows()


def joints(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """What the edge between two partitions adds to the nodes on both sides of it."""
    for row in batch.to_pylist():
        last, after = (np.frombuffer(b"".join(row[c]), dtype="V16") for c in ("last", "after"))
        at = common(last, after)
        prints, sums = prints_of(last[:at]), row["bytes"]
        depths = list(range(at + 1))
        yield whole(
            {
                "kind": ["part"] * len(depths), "depth": depths, "n_convs": [0] * len(depths),
                "shared": [sums[at]] * len(depths), "base": [sums[max(d - 1, 0)] for d in depths],
                "merges": [int(d == at) for d in depths], "ended": [0] * len(depths),
                # A last sequence that the next partition goes on with was no leaf.
                "n_leaves": [-int(at == len(last))] * len(depths), "ends": [NOBODY] * len(depths),
                "print": prints, "parent": [None, *prints[:-1]],
            },
            len(depths),
        )


def trie(paths: DataFrame) -> DataFrame:
    """The nodes of the trie of (conv_id, keys, sizes)."""
    sequences = distinct_paths(paths)
    sorted_ = sequences.repartitionByRange("keys").sortWithinPartitions("keys")
    built = stored(sorted_.mapInArrow(planted, SCHEMA), "trie-forests")

    # One row a partition.
    following = F.lead("first").over(Window.orderBy("first"))
    between = built.filter("kind = 'ends'").select("last", "bytes", "first").withColumn("after", following)
    between = arrow_map(between.filter("after IS NOT NULL").select("last", "bytes", "after"), joints, SCHEMA)
    open_ = built.filter("kind = 'part'").unionByName(between)
    real_end = F.when(F.col("ended") == 1, F.col("ends"))
    merged = stored(
        open_.groupBy("print").agg(
            F.max("depth").alias("depth"), F.max("parent").alias("parent"), F.min("conv_id").alias("conv_id"),
            *[F.sum(c).alias(c) for c in ("n_convs", "shared", "merges", "n_leaves")],
            F.max("base").alias("base"), F.max("ended").alias("ended"),
            F.coalesce(F.max(real_end), F.lit(NOBODY)).alias("ends"),
        ),
        "trie-merged",
    )
    known = merged.select(F.col("print").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    done = built.filter("kind = 'node'")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "merges", "ended", "n_leaves", "shared", "base", "ends"]
    parts = [
        done.filter("parent IS NULL").select(*columns),
        done.filter("parent IS NOT NULL").drop("parent_conv_id").join(known, "parent").select(*columns),
        merged.join(known, "parent", "left").select(*columns),
    ]
    nodes = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs",
        (F.col("merges") + 1 - F.col("ended")).alias("n_children"),
        "n_leaves",
        (F.col("shared") - (F.col("n_convs") - 1) * F.col("base")).alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )


def prefix_trie(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    rebuild: bool = False,
) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    A row for every different sequence of first turns, the empty one included, named by the
    smallest conversation that starts with it. Turns are ordered by number, null first, then by
    hash; a null role or text is an empty one; rows without a conversation id take no part; a
    repeated row is a turn of its own. `rebuild` first gives conversations shared beginnings
    (`rebuilt`). An empty table gives no rows, not even a root.
    """
    own = ordered(conversations, conv_id, turn, role, text)
    return trie(rebuilt(stored(own, "trie-turns")) if rebuild else own)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"), rebuild=True)


ORACLE = """
WITH RECURSIVE turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn,
         md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
  SELECT conv_id, k, strlen(text) AS bytes,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS pos FROM turns
), crc(conv_id, s, bit, c) AS (
  SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR), 0, CAST(4294967295 AS BIGINT) FROM placed
  UNION ALL
  SELECT conv_id, s, bit + 1, CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END
  FROM (SELECT *, CASE WHEN bit % 8 = 0 THEN xor(c, ord(s[bit // 8 + 1])) ELSE c END AS x
        FROM crc WHERE bit < 8 * length(s))
), h AS (
  SELECT conv_id, xor(c, 4294967295) % 9 AS h FROM crc WHERE bit = 8 * length(s)
), rebuilt AS (
  SELECT h.conv_id, pos, k, bytes FROM h JOIN placed AS p ON p.conv_id = h.conv_id - h.conv_id % 5 WHERE pos <= h
  UNION ALL
  SELECT h.conv_id, pos, k, bytes FROM h JOIN placed AS p ON p.conv_id = h.conv_id WHERE pos > h
), numbered AS (
  SELECT conv_id, row_number() OVER w AS d, bytes, md5(array_to_string(list(k) OVER w, '')) AS p
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
), prefixes AS (
  SELECT conv_id, 0 AS d, 0 AS bytes, '' AS p FROM h UNION ALL SELECT conv_id, d, bytes, p FROM numbered
), linked AS (
  SELECT *, lag(p) OVER w AS above, lead(p) OVER w IS NULL AS is_end
  FROM prefixes WINDOW w AS (PARTITION BY conv_id ORDER BY d)
), nodes AS (
  SELECT d, p, above, min(conv_id) AS conv_id, count(*) AS n, any_value(bytes) AS bytes,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends
  FROM linked GROUP BY d, p, above
), children AS (
  SELECT d - 1 AS d, above AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), every AS (
  SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children USING (d, p)
), below AS (
  SELECT a.d, a.p, CAST(sum((v.n - 1) * v.bytes) AS BIGINT) AS saved,
         count(*) FILTER (v.n_children = 0) AS n_leaves
  FROM every AS v JOIN prefixes AS a ON a.conv_id = v.conv_id AND a.d <= v.d GROUP BY ALL
)
SELECT e.conv_id, CAST(e.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, e.n AS n_convs, e.n_children,
       n_leaves, saved AS saved_tokens, e.ends AS ends_sha256
FROM every AS e JOIN below USING (d, p) LEFT JOIN every AS up ON up.d = e.d - 1 AND up.p = e.above
"""
