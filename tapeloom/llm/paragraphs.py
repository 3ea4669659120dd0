"""Substring dedup by paragraphs: MinHash banding, exact Jaccard, removal by components.

A paragraph is a line of `min_words` words or more. Shorter lines, which clean texts share too,
stay; passages that lie inside different lines are cut by their sentences (`passages`).
Paragraphs with the same shingle set are one item; items that
share a band of MinHash values are candidates, and inside the candidates' components all pairs
are verified exactly on their sets. Of each component of verified links only the first
paragraph stays, by document id and place; the others are cut out of their texts.

12 bands of 3 values let a pair at the threshold of 0.8 meet with a chance above 0.999; equal
paragraphs always meet. A set of fewer than four shingles cannot be within 0.8 of another one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from fractions import Fraction
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm import hashing, passages, similar
from tapeloom.llm.frames import arrow_map, chunks, parted, pick, stored, table
from tapeloom.llm.near import LINKS_SQL, SHINGLE, THRESHOLD, banded

BANDS, ROWS = 12, 3
BLOCK = 1 << 20


def lines(texts: list[str | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """All paragraphs of the texts, the text and the place of each."""
    parts = [(t or "").encode().split(b"\n") for t in texts]
    counts = np.array([len(p) for p in parts], dtype=np.int64)
    owner = np.repeat(np.arange(len(parts)), counts)
    place = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return [line for part in parts for line in part], owner, place


def signed(rows: DataFrame, size: int, min_words: int, bands: int, band_rows: int) -> DataFrame:
    """(doc_id, text_key, place, item, shingles, signature) of paragraphs of `min_words` or more."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start, end in chunks(batch, "text", BLOCK):
            part = batch.slice(start, end - start)
            raws, owner, place = lines(part.column("text").to_pylist())
            hashes, counts = hashing.words(raws)
            long = counts >= min_words
            hashes = hashes[np.repeat(long, counts)]
            sets, n = hashing.unique_sets(*hashing.shingles(hashes, counts[long], size))
            values = hashing.minhashes(sets, n, bands * band_rows)
            owner = pa.array(owner[long])
            yield pa.record_batch(
                [part.column("doc_id").take(owner), part.column("text_key").take(owner),
                 pa.array(place[long].astype(np.int32)), pa.array(hashing.set_ids(sets, n)),
                 pa.array(n.astype(np.int32)), pa.array([v.tobytes() for v in values], pa.binary())],
                names=["doc_id", "text_key", "place", "item", "shingles", "signature"],
            )

    return arrow_map(
        rows, of,
        f"doc_id {kind}, text_key bigint, place int, item bigint, shingles int, signature binary",
    )


def with_sets(candidates: DataFrame, items: DataFrame, rows: DataFrame, size: int) -> DataFrame:
    """(component, members, total, item, copies, hashes): one paragraph's set per candidate item."""
    named = candidates.join(items.select("item", "first", "shingles"), "item")
    sizes = named.groupBy("component").agg(F.count("*").alias("members"), F.sum("shingles").alias("total"))
    named = named.join(sizes, "component")
    wanted = stored(
        named.groupBy(F.col("first.text_key").alias("text_key"), F.col("first.doc_id").alias("own_id"))
        .agg(F.collect_list(F.struct(F.col("first.place").alias("place"), "item", "component", "members", "total"))
             .alias("places")),
        "wanted",
    )
    # One plan at every size: the texts are dealt by their hash.
    texts = rows.hint("merge").join(
        wanted, (rows["text_key"] == wanted["text_key"]) & rows["doc_id"].eqNullSafe(wanted["own_id"])
    ).select("text", "places")
    # The lines are picked out here, so that only they go to the workers.
    picked = texts.select(F.split("text", "\n").alias("lines"), F.explode("places").alias("p")).select(
        F.element_at("lines", F.col("p.place") + 1).alias("line"), "p.item", "p.component", "p.members", "p.total"
    )

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start, end in chunks(batch, "line", BLOCK):
            part = batch.slice(start, end - start)
            hashes, counts = hashing.words([t.encode() for t in part.column("line").to_pylist()])
            sets, n = hashing.unique_sets(*hashing.shingles(hashes, counts, size))
            own = hashing.set_ids(sets, n) == part.column("item").to_numpy()
            ends = np.cumsum(n)
            raw = [sets[b - k : b].tobytes() for b, k in zip(ends.tolist(), n.tolist())]
            yield pa.record_batch(
                [*(part.column(c) for c in ("component", "members", "total", "item")),
                 pa.array(np.ones(len(part), dtype=np.int64)), pa.array(raw, pa.binary())],
                names=["component", "members", "total", "item", "copies", "hashes"],
            ).filter(pa.array(own))

    return arrow_map(
        picked, of,
        "component bigint, members bigint, total bigint, item bigint, copies bigint, hashes binary",
    )


def repeated_paragraphs(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    size: int = SHINGLE,
    min_words: int = passages.MIN_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    bands: int = BANDS,
    band_rows: int = ROWS,
) -> DataFrame:
    """(doc_id, text_key, removed): places of the paragraphs to cut, for rows that have any.

    A paragraph goes if it equals an earlier one, or if verified links of similarity
    `threshold` lead to an earlier one; earlier is a smaller (document id, text hash, place),
    null ids first. Paragraphs of fewer than `min_words` words stay.
    """
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("text_key", F.xxhash64("text"))
    members = stored(signed(rows, size, min_words, bands, band_rows), "paragraphs")
    place = F.struct("doc_id", "text_key", "place")
    items = stored(
        members.groupBy("item").agg(
            F.count("*").alias("copies"), F.min(place).alias("first"),
            F.first("shingles").alias("shingles"), F.first("signature").alias("signature"),
        ),
        "items",
    )
    # Below this many shingles no different set reaches the threshold.
    ratio = Fraction(str(threshold))
    least = ceil(ratio / (1 - ratio)) if ratio < 1 else 1 << 30
    bands_of = banded(items.filter(F.col("shingles") >= least), band_rows)
    lowest = (
        bands_of.groupBy("bucket").agg(F.count("*").alias("n"), F.min("item").alias("root")).filter("n > 1")
    )
    colliding = bands_of.join(lowest, "bucket").filter("item <> root").select("item", "root").distinct()
    candidates = similar.components(colliding)
    found = similar.exact(with_sets(candidates, items, rows, size), threshold)
    classes = similar.components(found.select("item", "root"))
    short = items.select("item", "copies", "first")
    groups = short.join(classes, "item", "left").filter("copies > 1 OR component IS NOT NULL")
    groups = groups.withColumn("component", F.coalesce("component", "item"))
    first = groups.groupBy("component").agg(F.min("first").alias("kept"))
    kept = stored(groups.join(first, "component").select("item", "kept"), "kept")
    gone = members.select("doc_id", "text_key", "place", "item").join(kept, "item").filter(
        ~place.eqNullSafe(F.struct("kept.doc_id", "kept.text_key", "kept.place"))
    )
    return gone.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("place")).alias("removed"))


def cut_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, text_key, text, places, n_cut, n_passages) of the texts with repeats.

    `text` is what stays; `places` lists the lines that went as whole paragraphs, `n_cut`
    counts all lines that lost words, `n_passages` the repeated passages a text holds, first
    places included.
    """
    min_words = options.get("min_words", passages.MIN_WORDS)
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("text_key", F.xxhash64("text"))
    key = ["doc_id", "text_key"]
    lines_gone = stored(repeated_paragraphs(docs, id_col=id_col, text_col=text_col, **options), "lines-gone")
    words_gone = stored(passages.repeated_passages(rows, min_words), "words-gone")
    both = lines_gone.select(*key).unionByName(words_gone.select(*key)).distinct()
    for other in (lines_gone, words_gone):
        named = other.withColumnsRenamed({c: f"own_{c}" for c in key})
        same = (F.col("text_key") == F.col("own_text_key")) & F.col("doc_id").eqNullSafe(F.col("own_doc_id"))
        both = both.join(named, same, "left").drop(*[f"own_{c}" for c in key])
    wanted = both.withColumnsRenamed({c: f"own_{c}" for c in key})
    # One plan at every size: the texts are dealt by their hash. Repeated rows are cut once.
    near = parted(rows, "text_key", both, "cut-texts")[0].hint("merge").join(
        wanted, (F.col("text_key") == F.col("own_text_key")) & F.col("doc_id").eqNullSafe(F.col("own_doc_id"))
    ).select(*key, "text", "removed", "cut", F.coalesce("n_passages", F.lit(0)).alias("n_passages"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start, end in chunks(batch, "text", BLOCK):
            part = batch.slice(start, end - start)
            given = zip(*(part.column(c).to_pylist() for c in ("text", "removed", "cut")))
            found = [passages.without_words(*one) for one in given]
            yield pa.record_batch(
                [part.column("doc_id"), part.column("text_key"), pa.array([t for t, _ in found], pa.string()),
                 part.column("removed"), pa.array([n for _, n in found], pa.int64()), part.column("n_passages")],
                names=["doc_id", "text_key", "text", "places", "n_cut", "n_passages"],
            )

    schema = f"doc_id {kind}, text_key bigint, text string, places array<int>, n_cut bigint, n_passages bigint"
    return arrow_map(near, of, schema).dropDuplicates(key)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """All rows and columns of `docs`, the text without its repeats, and `n_passages`, `n_cut`, `places`.

    Texts without repeats, null ones included, come back as they were, with counts of 0 and a
    null list. Columns of those three names are replaced. Rows with the same id and text count
    as one row. An empty table gives an empty result.
    """
    new = {"text": "_cut_text", "places": "_cut_places", "n_cut": "_cut_lines", "n_passages": "_cut_passages",
           "doc_id": "_cut_id", "text_key": "_cut_key"}
    tag = uuid.uuid4().hex[:8]
    new = {c: f"{name}_{tag}" for c, name in new.items()}
    cut = cut_texts(docs, id_col, text_col, **options).withColumnsRenamed(new)
    text, number = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")
    kept = docs.drop(*[c for c in ("n_passages", "n_cut", "places") if c not in (id_col, text_col)])
    joined = kept.hint("merge").join(
        cut, (F.xxhash64(text) == F.col(new["text_key"])) & number.eqNullSafe(F.col(new["doc_id"])), "left"
    )
    hit = F.col(new["text_key"]).isNotNull()
    columns = [
        F.when(hit, F.col(new["text"])).otherwise(text).alias(text_col) if c == text_col else F.col(f"`{c}`")
        for c in kept.columns
    ]
    return joined.select(
        *columns,
        F.coalesce(new["n_passages"], F.lit(0)).cast("bigint").alias("n_passages"),
        F.coalesce(new["n_cut"], F.lit(0)).cast("bigint").alias("n_cut"),
        F.col(new["places"]).alias("places"),
    )


def op9_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.size(F.split("text", "\n")).alias("n"))
    cut = without_repeats(docs)
    return cut.select(
        "doc_id",
        "n_passages",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_paragraphs"),
        F.col("n_cut").alias("n_removed"),
        F.array_join(F.coalesce("places", F.array().cast("array<int>")).cast("array<string>"), ",").alias("removed"),
        "text",
    )


ORACLE = rf"""
WITH RECURSIVE split AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
lines AS (
  SELECT doc_id, place, ls[place + 1] AS line, row_number() OVER (ORDER BY doc_id, place) AS id
  FROM split, unnest(range(0, len(ls))) AS r(place)
), texts AS (
  SELECT id, line AS text FROM lines
  WHERE len([x for x in string_split_regex(line, '[	

 ]+') if x <> '']) >= {passages.MIN_WORDS}
), {{LINKS}},
gone AS (SELECT id FROM reached GROUP BY id HAVING min(low) < id),
tokens AS (
  SELECT doc_id, place, id, unnest(t) AS token, generate_subscripts(t, 1) AS i, len(t) AS n
  FROM (SELECT *, regexp_extract_all(line, '[^	
 ]+[	
 ]*') AS t FROM lines)
), numbered AS (
  SELECT *, regexp_extract(token, '^[^	
 ]+') AS w,
         row_number() OVER (PARTITION BY doc_id ORDER BY place, i) AS g FROM tokens
), stops AS (
  SELECT *, CASE WHEN regexp_matches(w, '[.!?]$') THEN 1 ELSE 0 END AS stop FROM numbered
), ends AS (
  SELECT *, CASE WHEN i = n OR (stop = 1 AND coalesce(max(stop) OVER (
    PARTITION BY id ORDER BY i ROWS BETWEEN {passages.QUIET} PRECEDING AND 1 PRECEDING), 0) = 0) THEN 1 ELSE 0 END AS is_end
  FROM stops
), placed AS (
  SELECT *, coalesce(sum(is_end) OVER (
    PARTITION BY doc_id ORDER BY g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM ends
), sentences AS (
  SELECT doc_id, s, string_agg(w, ' ' ORDER BY g) AS said, count(*) AS n FROM placed GROUP BY doc_id, s
), again AS (
  SELECT *, s - row_number() OVER (PARTITION BY doc_id ORDER BY s) AS run FROM sentences
  WHERE said IN (SELECT said FROM sentences GROUP BY said HAVING count(*) > 1)
), long AS (
  SELECT * FROM (SELECT *, sum(n) OVER (PARTITION BY doc_id, run) AS words FROM again) WHERE words >= {passages.MIN_WORDS}
), passages AS (
  SELECT *, row_number() OVER (PARTITION BY said ORDER BY doc_id, s) AS nth FROM long
), held AS (SELECT doc_id, count(DISTINCT run) AS n_passages FROM passages GROUP BY doc_id),
cut AS (
  SELECT t.id, count(*) AS n_cut, any_value(t.n) AS n FROM placed AS t JOIN passages AS p USING (doc_id, s)
  WHERE nth > 1 GROUP BY t.id
), kept_words AS (
  SELECT t.id, string_agg(token, '' ORDER BY i) AS kept FROM placed AS t LEFT JOIN passages AS p USING (doc_id, s)
  WHERE nth IS NULL OR nth = 1 GROUP BY t.id
), done AS (
  SELECT l.doc_id, l.place, gone.id IS NOT NULL AS is_gone, cut.id IS NOT NULL AS is_cut,
         CASE WHEN gone.id IS NOT NULL OR cut.n_cut = cut.n THEN NULL
              WHEN cut.id IS NULL THEN line ELSE regexp_extract(line, '^[	
 ]*') || kept END AS line
  FROM lines AS l LEFT JOIN gone USING (id) LEFT JOIN cut USING (id) LEFT JOIN kept_words USING (id)
)
SELECT doc_id, coalesce(any_value(n_passages), 0) AS n_passages,
       count(*) AS n_paragraphs, count(*) FILTER (is_gone OR is_cut) AS n_removed,
       coalesce(string_agg(CAST(place AS VARCHAR), ',' ORDER BY place) FILTER (is_gone), '') AS removed,
       coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (line IS NOT NULL), '') AS text
FROM done LEFT JOIN held USING (doc_id) GROUP BY doc_id
""".replace("{LINKS}", LINKS_SQL)
