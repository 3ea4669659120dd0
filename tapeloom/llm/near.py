"""N-gram Jaccard join of documents with Bayesian pruning of candidate pairs.

A document is its set of word shingles; documents with equal sets are copies and one item.
Candidates share a band of MinHash values: with 29 bands of 3 values a pair at the threshold
of 0.8 meets in none with a chance below 1e-8. Of a candidate pair the MinHash values are
compared step by step, and it is dropped as soon as the posterior probability of reaching the
threshold falls below the tolerance. What is left falls into components, and inside each all
pairs are verified exactly on the sets, in blocks, so every link is found and counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm import hashing, similar
from tapeloom.llm.frames import arrow_map, chunks, pick, stored, table

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 29, 3
TOLERANCE = 1e-6
BLOCK = 2 << 20


def text_sets(texts: list[str | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingle set of each text: all hashes, and how many each has."""
    hashes, counts = hashing.words([(t or "").encode() for t in texts])
    return hashing.unique_sets(*hashing.shingles(hashes, counts, size))


def signed(rows: DataFrame, size: int, bands: int, band_rows: int) -> DataFrame:
    """(doc_id, text_key, item, shingles, signature) of every document; item 0 has no words."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start, end in chunks(batch, "text", BLOCK):
            part = batch.slice(start, end - start)
            sets, counts = text_sets(part.column("text").to_pylist(), size)
            values = hashing.minhashes(sets, counts, bands * band_rows)
            yield pa.record_batch(
                [part.column("doc_id"), part.column("text_key"), pa.array(hashing.set_ids(sets, counts)),
                 pa.array(counts), pa.array([v.tobytes() for v in values], pa.binary())],
                names=["doc_id", "text_key", "item", "shingles", "signature"],
            )

    return arrow_map(
        rows, of, f"doc_id {kind}, text_key bigint, item bigint, shingles bigint, signature binary"
    )


def banded(items: DataFrame, band_rows: int) -> DataFrame:
    """(bucket, item) for every band of an item's signature."""

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys = hashing.band_keys(similar.fixed(batch.column("signature"), "<u4"), band_rows)
        item = np.repeat(batch.column("item").to_numpy(), keys.shape[1])
        yield pa.record_batch([pa.array(keys.reshape(-1)), pa.array(item)], names=["bucket", "item"])

    return arrow_map(items.select("item", "signature"), of, "bucket bigint, item bigint")


def sketched(items: DataFrame) -> DataFrame:
    """(item, sketch): the lowest byte of each MinHash value."""

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        values = similar.fixed(batch.column("signature"), "<u4").astype(np.uint8)
        yield pa.record_batch(
            [batch.column("item"), pa.array([v.tobytes() for v in values], pa.binary())], names=["item", "sketch"]
        )

    return arrow_map(items.select("item", "signature"), of, "item bigint, sketch binary")


def near_duplicates(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    size: int = SHINGLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    bands: int = BANDS,
    band_rows: int = ROWS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """(doc_id, class_id, n_links) for every row.

    A link joins two documents whose sets of `size`-word shingles have a Jaccard similarity of
    `threshold` or more; copies are links. `class_id` is the smallest id that links lead to,
    the own id without links, and null only where no id is known; `n_links` counts a row's
    links, to copies and repeated rows too. A null, empty or blank text has no words, no
    links, and its own id as class. A text of fewer than `size` words is one shingle.
    """
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("text_key", F.xxhash64("text"))
    signatures = stored(signed(rows, size, bands, band_rows), "signatures")
    items = stored(
        signatures.filter("item <> 0").groupBy("item").agg(
            F.count("*").alias("copies"),
            F.min("doc_id").alias("first_id"),
            F.min(F.struct("text_key", "doc_id")).alias("shown"),
            F.first("shingles").alias("shingles"),
            F.first("signature").alias("signature"),
        ),
        "items",
    )
    crowded = similar.buckets(banded(items, band_rows)).join(sketched(items), "item")
    candidates = similar.components(
        similar.likely(crowded, bands * band_rows, threshold, tolerance)
    )
    found = stored(similar.exact(with_sets(candidates, items, rows, size), threshold), "verified")
    classes = similar.components(found.select("item", "root"))
    links = found.groupBy("item").agg(F.sum("links").alias("links"))
    named = classes.join(items.select("item", "first_id"), "item")
    smallest = named.groupBy("component").agg(F.min("first_id").alias("smallest"))
    linked = classes.join(smallest, "component").join(links, "item").select("item", "smallest", "links")
    known = items.join(linked, "item", "left").select(
        "item",
        F.coalesce("smallest", "first_id").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    return signatures.select("doc_id", "item").join(known, "item", "left").select(
        "doc_id",
        F.when(F.col("item") == 0, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
    )


def with_sets(candidates: DataFrame, items: DataFrame, rows: DataFrame, size: int) -> DataFrame:
    """(component, members, total, item, copies, hashes): one document's set per candidate item."""
    named = candidates.join(items.select("item", "copies", "shown", "shingles"), "item")
    sizes = named.groupBy("component").agg(F.count("*").alias("members"), F.sum("shingles").alias("total"))
    wanted = stored(
        named.join(sizes, "component").select(
            "component", "members", "total", "item", "copies",
            F.col("shown.text_key").alias("text_key"), F.col("shown.doc_id").alias("own_id")),
        "wanted",
    )
    # One plan at every size: the texts are dealt by their hash.
    texts = rows.hint("merge").join(
        wanted, (rows["text_key"] == wanted["text_key"]) & rows["doc_id"].eqNullSafe(wanted["own_id"])
    ).select("component", "members", "total", "item", "copies", "text")

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start, end in chunks(batch, "text", BLOCK):
            part = batch.slice(start, end - start)
            sets, counts = text_sets(part.column("text").to_pylist(), size)
            # Another text with the same key is not the one that was asked for.
            own = hashing.set_ids(sets, counts) == part.column("item").to_numpy()
            ends = np.cumsum(counts)
            raw = [sets[b - n : b].tobytes() for b, n in zip(ends.tolist(), counts.tolist())]
            yield pa.record_batch(
                [*(part.column(c) for c in ("component", "members", "total", "item", "copies")),
                 pa.array(raw, pa.binary())],
                names=["component", "members", "total", "item", "copies", "hashes"],
            ).filter(pa.array(own))

    return arrow_map(
        texts, of,
        "component bigint, members bigint, total bigint, item bigint, copies bigint, hashes binary",
    )


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


#: Words, shingles, and for numbered texts (id, text) the reachable smaller ids over links.
LINKS_SQL = r"""
words AS (
  SELECT id, [x for x in string_split_regex(text, '[\t\n\v\f\r ]+') if x <> ''] AS ws FROM texts
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
  WHERE common * 5 >= 4 * (a.n + b.n - common)
), either AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached(id, low) AS (
  SELECT id, id FROM texts
  UNION SELECT y, low FROM reached JOIN either ON x = id WHERE low < y
)"""

ORACLE = f"""
WITH RECURSIVE texts AS (SELECT doc_id AS id, text FROM documents), {LINKS_SQL},
counted AS (SELECT x AS id, count(*) AS n FROM either GROUP BY x)
SELECT texts.id AS doc_id, min(low) AS class_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_links
FROM texts JOIN reached USING (id) LEFT JOIN counted USING (id) GROUP BY texts.id
"""
