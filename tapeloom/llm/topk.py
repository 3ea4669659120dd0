"""Exact top-k inner products by MaxScore.

A vector's terms are its components, and a shard keeps them column by column: the postings of
a term. For a query, a term's bound is the most it can add in the shard. Terms in ascending
order of bound are non-essential as long as their bounds together do not reach the query's
threshold, its k-th best score so far: a vector without an essential part cannot compete.
Essential postings are traversed for all vectors of a block; the other terms are probed, the
largest bounds first, only while a vector's score plus the bounds left can still reach the
threshold. Shards are merged by score, ties by the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tapeloom.llm.frames import pick, stored, table

SCALE = 256
TOP = 5
#: Queries sent along with one pass over all vectors, and vectors scored at once.
QUERIES = 4096
VECTORS = 4096
LOWEST = np.iinfo(np.int64).min


def usable(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, terms): integer components of the vectors that take part."""
    rows = pick(vectors, vec_id=id_col, embedding=vector_col)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.filter(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull()).filter(finite).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("terms"),
    )


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as rows; terms past a vector's end are zero, as a missing posting is."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), max(width, int(sizes.max(initial=0)))), dtype=np.float64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = values
    return out[:, :width]


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best different ids, each with its best score; ties to the smaller id."""
    order = np.lexsort((ids, -scores))
    first = np.sort(np.unique(ids[order], return_index=True)[1])[:k]
    return ids[order][first], scores[order][first]


class Shard:
    """Running top k of every query over the vectors that a task has seen."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int):
        self.query_ids, self.queries, self.k = query_ids, queries, k
        self.ids = [np.empty(0, dtype=np.int64) for _ in query_ids]
        self.scores = [np.empty(0, dtype=np.int64) for _ in query_ids]

    def add(self, ids: np.ndarray, postings: np.ndarray) -> None:
        """`postings`: one row per term, one column per vector."""
        high, low = postings.max(axis=1), postings.min(axis=1)
        different = len(np.unique(ids)) == len(ids)
        for at, query in enumerate(self.queries):
            bounds = np.maximum(0, np.maximum(query * high, query * low))
            order = np.argsort(-bounds, kind="stable")
            left = np.append(np.cumsum(bounds[order][::-1])[::-1], 0)
            full = len(self.scores[at]) >= self.k
            threshold = self.scores[at][-1] if full else LOWEST
            # Non-essential: the tail of terms whose bounds cannot reach the threshold alone.
            essential = int(np.searchsorted(-left, -threshold, side="right")) if full else len(order)
            essential = min(max(essential, 1), len(order))
            first = order[:essential]
            score = query[first] @ postings[first]
            alive = np.arange(len(ids))
            for place in range(essential, len(order), 8):
                keep = score + left[place] >= threshold
                alive, score = alive[keep], score[keep]
                if not len(alive):
                    break
                probed = order[place : place + 8]
                score = score + query[probed] @ postings[np.ix_(probed, alive)]
            keep = (score >= threshold) & (ids[alive] != self.query_ids[at])
            if keep.any():
                alive, score = alive[keep], score[keep].astype(np.int64)
                if different and len(alive) > 4 * self.k:
                    # Ties at the border stay until the ids are compared.
                    border = np.partition(score, -self.k)[-self.k]
                    alive, score = alive[score >= border], score[score >= border]
                self.ids[at], self.scores[at] = best_of(
                    np.concatenate((self.ids[at], ids[alive])),
                    np.concatenate((self.scores[at], score)), self.k,
                )


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = TOP,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = SCALE,
    queries_at_once: int = QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best other vectors by inner product.

    Components are floor(scale * x), scores exact integers (below 2**53). Vectors that are
    null, have a null id, or hold a null, NaN or infinite component take no part; a component
    that one of two vectors lacks counts as 0. A vector is not its own candidate, nor is a
    repeated row with its id; rows of one id give one result of it, the best. Queries go to
    the vectors in blocks of `queries_at_once`, one pass over the vectors for each block.
    """
    spark = vectors.sparkSession
    candidates = usable(vectors, id_col, vector_col, scale)
    asked = usable(queries, id_col, vector_col, scale).dropDuplicates(["vec_id"])
    asked = stored(asked.repartitionByRange("vec_id").sortWithinPartitions("vec_id"), "queries")
    schema = "query_id bigint, vec_id bigint, score bigint"
    found = None
    for block in query_blocks(asked, queries_at_once):
        width = max(len(terms) for _, terms in block)
        ids = np.array([i for i, _ in block], dtype=np.int64)
        terms = np.zeros((len(block), max(width, 1)))
        for row, (_, values) in enumerate(block):
            terms[row, : len(values)] = values
        # Bounded: queries_at_once vectors.
        shared = spark.sparkContext.broadcast((ids, terms))

        def shard(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            query_ids, queries_ = shared.value
            own = Shard(query_ids, queries_, k)
            for batch in batches:
                for start in range(0, batch.num_rows, VECTORS):
                    part = batch.slice(start, VECTORS)
                    rows = matrix(part.column("terms"), queries_.shape[1])
                    own.add(part.column("vec_id").to_numpy(), np.ascontiguousarray(rows.T))
            sizes = [len(i) for i in own.ids]
            yield pa.record_batch(
                [pa.array(np.repeat(query_ids, sizes)), pa.array(np.concatenate(own.ids)),
                 pa.array(np.concatenate(own.scores))],
                names=["query_id", "vec_id", "score"],
            )

        part = candidates.mapInArrow(shard, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], schema)
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        merged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def query_blocks(asked: DataFrame, size: int) -> Iterator[list]:
    """The queries in blocks of `size` rows; one block is on the driver at a time."""
    block: list = []
    for row in asked.toLocalIterator():
        block.append((row["vec_id"], row["terms"]))
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def op5_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"))


ORACLE = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) for x in embedding] AS t
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.t, v.t) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
