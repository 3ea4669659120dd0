"""Near-duplicate documents by MinHash with tensored banding.

Table keys are pairs of groups out of two small collections: with GROUPS groups of HALF values
in each, every one of the GROUPS * GROUPS pairs of groups is a table of 2 * HALF values, for
2 * GROUPS * HALF MinHash values in all instead of 2 * HALF * GROUPS**2. Two documents share a
table if they agree in a group of either collection: a pair at the threshold of 0.85 is missed
with a chance of 1.5e-4, one at 0.9 with 4e-6, one at 0.95 with 2e-9; copies are never.

Candidates are verified on the full sets. Every member of a bucket is first compared with one
smallest member of its buckets; buckets whose members hang together by verified links are then
done, and only members of different components of a bucket are compared with each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm import hashing, similar
from tapeloom.llm.bitsliced import bitmap_of
from tapeloom.llm.frames import FILTER_BITS, arrow_map, chunks, parted, pick, stored, table

SHINGLE = 5
THRESHOLD = 0.85
GROUPS, HALF = 10, 3
#: Posterior chance of reaching the threshold below which a pair is not looked up in full.
TOLERANCE = 1e-6
BLOCK = 2 << 20
#: Edges of one root that a task compares; a root with more is copied.
HOT = 1024


def text_sets(texts: list[str | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingle set of each text, A-Z lower-cased: all hashes, and how many each has."""
    hashes, counts = hashing.words([(t or "").encode().lower() for t in texts])
    return hashing.unique_sets(*hashing.shingles(hashes, counts, size))


def signed(rows: DataFrame, size: int, hashes: int) -> DataFrame:
    """(doc_id, text_key, item, shingles, signature) of every document; item 0 has no words."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start, end in chunks(batch, "text", BLOCK):
            part = batch.slice(start, end - start)
            sets, counts = text_sets(part.column("text").to_pylist(), size)
            values = hashing.minhashes(sets, counts, hashes)
            yield pa.record_batch(
                [part.column("doc_id"), part.column("text_key"), pa.array(hashing.set_ids(sets, counts)),
                 pa.array(counts), pa.array([v.tobytes() for v in values], pa.binary())],
                names=["doc_id", "text_key", "item", "shingles", "signature"],
            )

    return arrow_map(
        rows, of, f"doc_id {kind}, text_key bigint, item bigint, shingles bigint, signature binary"
    )


def group_keys(signatures: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """(items, groups): the keys of the groups of either collection."""
    left, right = (hashing.band_keys(values, half).view(np.uint64) for values in np.hsplit(signatures, 2))
    return left, hashing.mixed(right)


def table_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """(items, left groups, right groups): the keys of all pairs of a left and a right group."""
    return hashing.mixed(left[:, :, None] * hashing.BASE + right[:, None, :])


def marked(keys: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    place = (keys & np.uint64(FILTER_BITS - 1)).astype(np.int64)
    return (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def grouped(items: DataFrame, half: int) -> DataFrame:
    """(bucket) of every group of either collection."""

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys = np.hstack(group_keys(similar.fixed(batch.column("signature"), "<u4"), half))
        yield pa.record_batch([pa.array(keys.reshape(-1).view(np.int64))], names=["bucket"])

    return arrow_map(items.select("signature"), of, "bucket bigint")


def tensored(items: DataFrame, half: int, groups: np.ndarray, tables: np.ndarray | None = None) -> DataFrame:
    """(bucket, item) for every table whose two groups may be shared, by a bitmap of groups.

    With a bitmap of `tables` too, only those that are in it.
    """
    shared = items.sparkSession.sparkContext.broadcast((groups, tables))

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        groups, tables = shared.value
        left, right = group_keys(similar.fixed(batch.column("signature"), "<u4"), half)
        row, i, j = np.nonzero(marked(left, groups)[:, :, None] & marked(right, groups)[:, None, :])
        keys = table_keys(left, right)[row, i, j]
        item = batch.column("item").to_numpy()[row]
        if tables is not None:
            some = marked(keys, tables)
            keys, item = keys[some], item[some]
        yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(item)], names=["bucket", "item"])

    return arrow_map(items.select("item", "signature"), of, "bucket bigint, item bigint")


def crowded(items: DataFrame, half: int) -> DataFrame:
    """(bucket, item, members, root) of the buckets of two items or more, equal ones once.

    A document that shares no left or no right group shares no table: groups are counted first,
    a fifth as many as tables or less, and only pairs of shared groups become keys.
    """
    alike = grouped(items, half).groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    groups = bitmap_of(stored(alike.select("bucket"), "shared-groups"), "bucket")
    sizes = tensored(items, half, groups).groupBy("bucket").agg(
        F.count("*").alias("members"), F.min("item").alias("root"), F.bit_xor(F.xxhash64("item")).alias("print")
    ).filter("members > 1")
    # Close documents meet in most tables: of buckets with the same members one is enough.
    sizes = stored(
        sizes.groupBy("members", "root", "print").agg(F.min("bucket").alias("bucket")).drop("print"), "crowded"
    )
    return tensored(items, half, groups, bitmap_of(sizes, "bucket")).join(sizes, "bucket")


def sketched(items: DataFrame) -> DataFrame:
    """(item, shingles, sketch): the lowest byte of each MinHash value."""

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        values = similar.fixed(batch.column("signature"), "<u4").astype(np.uint8)
        yield pa.record_batch(
            [batch.column("item"), batch.column("shingles"), pa.array([v.tobytes() for v in values], pa.binary())],
            names=["item", "shingles", "sketch"],
        )

    rows = items.select("item", "shingles", "signature")
    return arrow_map(rows, of, "item bigint, shingles bigint, sketch binary")


def sets_of(named: DataFrame, rows: DataFrame, size: int) -> DataFrame:
    """(item, hashes): the full set of every item of `named` (item, text_key)."""
    near, _ = parted(rows.select("text_key", "text"), "text_key", named, "tensored")
    # Copies of a text are dropped before and after the shuffle that the join needs anyway.
    texts = near.dropDuplicates(["text_key"]).join(named.hint("merge"), "text_key")

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start, end in chunks(batch, "text", BLOCK):
            part = batch.slice(start, end - start)
            sets, counts = text_sets(part.column("text").to_pylist(), size)
            # Another text with the same key is not the one that was asked for.
            own = hashing.set_ids(sets, counts) == part.column("item").to_numpy()
            ends = np.cumsum(counts)
            raw = [sets[b - n : b].tobytes() for b, n in zip(ends.tolist(), counts.tolist())]
            yield pa.record_batch(
                [part.column("item"), pa.array(raw, pa.binary())], names=["item", "hashes"]
            ).filter(pa.array(own))

    return arrow_map(texts.select("item", "text"), of, "item bigint, hashes binary")


def with_both(edges: DataFrame, values: DataFrame) -> DataFrame:
    """Edges (item, root) with the values of both ends, those of the root as `root_...`.

    A root of very many edges goes to as many tasks as it has HOT edges, one copy to each.
    """
    hot = edges.groupBy("root").agg(F.count("*").alias("n")).filter(F.col("n") > HOT)
    hot = hot.select("root", F.ceil(F.col("n") / HOT).cast("int").alias("salts"))
    salts = F.coalesce("salts", F.lit(1))
    names = {c: f"root_{c}" for c in values.columns if c != "item"}
    roots = edges.select("root").distinct().join(hot, "root", "left")
    roots = roots.join(values.withColumnRenamed("item", "root"), "root").withColumnsRenamed(names)
    roots = roots.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    salted = edges.join(hot, "root", "left").withColumn("salt", F.pmod(F.xxhash64("item"), salts).cast("int"))
    return salted.drop("salts").join(values, "item").join(roots, ["root", "salt"])


def worth_a_look(edges: DataFrame, sketches: DataFrame, threshold: float, least: int) -> DataFrame:
    """Edges whose sizes allow the threshold and whose sketches agree in `least` values or more."""
    ratio = Fraction(str(threshold))

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        a, b = (similar.fixed(batch.column(c), "u1") for c in ("sketch", "root_sketch"))
        n, m = (batch.column(c).to_numpy() for c in ("shingles", "root_shingles"))
        keep = ((a == b).sum(axis=1) >= least) & sizes_allow(n, m, ratio)
        yield batch.select(["item", "root"]).filter(pa.array(keep))

    both = with_both(edges, sketches).select("item", "root", "shingles", "root_shingles", "sketch", "root_sketch")
    return arrow_map(both, of, "item bigint, root bigint")


def sizes_allow(n: np.ndarray, m: np.ndarray, ratio: Fraction) -> np.ndarray:
    return np.minimum(n, m) * ratio.denominator >= np.maximum(n, m) * ratio.numerator


def verified(edges: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The edges whose full sets reach the threshold."""
    ratio = Fraction(str(threshold))

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keep = []
        for one, other in zip(batch.column("hashes"), batch.column("root_hashes")):
            a, b = (np.frombuffer(x.as_buffer(), dtype="<u8") for x in (one, other))
            at = np.searchsorted(b, a)
            both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
            keep.append(both * ratio.denominator >= (len(a) + len(b) - both) * ratio.numerator)
        yield batch.select(["item", "root"]).filter(pa.array(keep, pa.bool_()))

    both = with_both(edges, sets).select("item", "root", "hashes", "root_hashes")
    return arrow_map(both, of, "item bigint, root bigint")


def across(rows: DataFrame, threshold: float, least: int) -> DataFrame:
    """(item, root): a forest over the likely pairs of a bucket that no component holds yet.

    `rows`: bucket, item, members, component, shingles, sketch.
    """
    ratio = Fraction(str(threshold))

    def prune(part: pa.Table) -> Iterator[pa.RecordBatch]:
        meet, half, items, component, n = (
            part.column(c).to_numpy() for c in ("meet", "half", "item", "component", "shingles")
        )
        values = similar.fixed(part.column("sketch"), "u1")
        for a, b in similar.pairs_of(meet, half):
            keep = (component[a] != component[b]) & sizes_allow(n[a], n[b], ratio)
            a, b = a[keep], b[keep]
            keep = (values[a] == values[b]).sum(axis=1) >= least
            if keep.any():
                item, root = similar.forest(items, a[keep], b[keep])
                yield pa.record_batch([pa.array(item), pa.array(root)], names=["item", "root"])

    dealt = similar.in_blocks(rows, "bucket", "item", F.col("members") / similar.BLOCK)
    dealt = dealt.select("meet", "half", "item", "component", "shingles", "sketch")
    return similar.over_groups(dealt, prune, "item bigint, root bigint").distinct()


def near_duplicates(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    size: int = SHINGLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    groups: int = GROUPS,
    half: int = HALF,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row.

    A link joins two documents whose sets of `size`-word shingles (A-Z lower-cased) have a
    Jaccard similarity of `threshold` or more. `component_id` is the smallest id that links
    lead to, the own one included, and null where no id is known; `kept` says that it is the
    row's own id (repeated rows alike). A text of fewer than `size` words is one shingle; a null,
    empty or blank one has none and is linked with nothing. An empty table gives no rows.
    """
    n_hashes = 2 * groups * half
    least = int(similar.least_matches(n_hashes, threshold, TOLERANCE, n_hashes)[-1])
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("text_key", F.xxhash64("text"))
    signatures = stored(signed(rows, size, n_hashes), "tensored-signatures")
    items = stored(
        signatures.filter("item <> 0").groupBy("item").agg(
            F.min("doc_id").alias("first_id"), F.min("text_key").alias("text_key"),
            F.first("shingles").alias("shingles"), F.first("signature").alias("signature"),
        ),
        "tensored-items",
    )
    buckets = stored(crowded(items, half), "tensored-buckets")
    members = items.join(buckets.select("item").distinct(), "item", "left_semi")
    sketches = stored(sketched(members), "tensored-sketches")

    stars = buckets.filter("item <> root").select("item", "root").distinct()
    # One look a member: what other buckets' roots would link is found between components.
    stars = worth_a_look(stars, sketches, threshold, least).groupBy("item").agg(F.min("root").alias("root"))
    stars = stored(stars, "tensored-stars")
    ends = stars.select("item").unionByName(stars.select(F.col("root").alias("item"))).distinct()
    named = items.select("item", "text_key")
    sets = stored(sets_of(named.join(ends, "item", "left_semi"), rows, size), "tensored-sets")
    links = stored(verified(stars, sets, threshold), "tensored-links")

    # Buckets that verified links do not hold together.
    one = similar.components(links).select("item", "component")
    placed = stored(
        buckets.join(one, "item", "left").withColumn("component", F.coalesce("component", "item")), "tensored-placed"
    )
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = mixed.filter("low <> high").select("bucket")
    rest = placed.join(mixed, "bucket", "left_semi").join(sketches, "item")
    likely = similar.components(across(rest, threshold, least))
    sized = likely.join(items.select("item", "text_key", "shingles"), "item")
    totals = sized.groupBy("component").agg(F.count("*").alias("members"), F.sum("shingles").alias("total"))
    sized = stored(sized.join(totals, "component"), "tensored-rest")
    whole = sets_of(sized.select("item", "text_key"), rows, size).join(sized, "item").withColumn(
        "copies", F.lit(1).cast("bigint")
    )
    found = similar.exact(whole, threshold).select("item", "root")

    classes = similar.components(links.unionByName(found))
    smallest = classes.join(items.select("item", "first_id"), "item").groupBy("component").agg(
        F.min("first_id").alias("smallest")
    )
    linked = classes.join(smallest, "component").select("item", "smallest")
    known = items.join(linked, "item", "left").select("item", F.coalesce("smallest", "first_id").alias("least_id"))
    own = F.when(F.col("item") == 0, F.col("doc_id")).otherwise(F.col("least_id"))
    return (
        signatures.select("doc_id", "item", "shingles").join(known, "item", "left")
        .select("doc_id", F.col("shingles").alias("n_shingles"), own.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def op13_tensored_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id AS id, [x for x in string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\t\n\v\f\r ]+') if x <> ''] AS ws
  FROM documents
), shingles AS (
  SELECT DISTINCT id, unnest(
    CASE WHEN len(ws) >= 5 THEN [array_to_string(ws[i : i + 4], ' ') for i in range(1, len(ws) - 3)]
         WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle
  FROM words
), sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id),
shared AS (
  SELECT a.id AS x, b.id AS y, count(*) AS common
  FROM shingles AS a JOIN shingles AS b ON a.shingle = b.shingle AND a.id < b.id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM shared JOIN sizes AS a ON a.id = x JOIN sizes AS b ON b.id = y
  WHERE 100 * common >= 85 * (a.n + b.n - common)
), either AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached(id, low) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT y, low FROM reached JOIN either ON x = id WHERE low < y
), least AS (SELECT id, min(low) AS low FROM reached GROUP BY id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, low AS component_id, low = d.doc_id AS kept
FROM documents AS d JOIN least ON least.id = d.doc_id LEFT JOIN sizes ON sizes.id = d.doc_id
"""
