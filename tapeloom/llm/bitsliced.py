"""Ranked lexical search over bit-sliced Bloom signatures.

A document's signature is a Bloom filter of its terms; a term that occurs t times is entered
once for every level of LEVELS up to t. Documents with signatures of one width form a shard,
stored bit by bit: a slice is one bit of all its documents. The slices of a term and level,
and-ed, are a bitmap of the documents that may hold the term that often; it never misses one.
Sums of such bitmaps, weighted by what a term and a level can add to a score, are upper bounds
of all scores of a shard. Exact scores of the documents with the best bounds give each item a
threshold, and every document whose bound reaches it is scored exactly from its text.

Terms are compared by 64-bit hashes: two of V different terms share one with a chance of about
V * V / 2**65.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.pandas.types import to_arrow_type

from tapeloom.llm import hashing
from tapeloom.llm.frames import FILTER_BITS, arrow_map, chunks, parted, pick, stored, table

TOP = 10
#: Occurrences that a term is entered for; beyond the last one only the document's length bounds it.
LEVELS = np.array([1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 64, 128], dtype=np.int64)
#: Hashes of an entry, bits of a signature per entry (then up to a power of two), its widths.
HASHES, BITS_PER_ENTRY = 5, 16
NARROWEST, WIDEST = 1 << 8, 1 << 20
#: Bits of a shard, and documents in it at most.
SHARD_BITS, SHARD_DOCS = 1 << 22, 4096
#: Documents with the best bounds that are scored for a threshold, in places of the result.
SEEDS = 4
#: Copies of a block of items, so that no task meets all shards of a block.
SALTS = 16
#: Item terms in a block of items, on average; bound cells computed in one numpy call.
BLOCK_TERMS = 8192
CELLS = 1 << 21
TEXT_BLOCK = 2 << 20
#: Term counts that a task holds before it passes them on.
HELD_TERMS = 1 << 20

#: Bytes of terms, which are letters and digits of ASCII and all beyond it.
TERM_BYTES = np.zeros(256, dtype=bool)
TERM_BYTES[48:58] = TERM_BYTES[65:91] = TERM_BYTES[97:123] = TERM_BYTES[128:] = True


def terms(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of the texts in order, and how many each text has."""
    hashes: list[np.ndarray] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    for row, text in enumerate(texts):
        for part in hashing.cut((text or "").encode().lower()):
            raw = np.frombuffer(part, dtype=np.uint8)
            inside = np.zeros(len(raw) + 2, dtype=bool)
            inside[1:-1] = TERM_BYTES[raw]
            edges = np.flatnonzero(inside[1:] != inside[:-1])
            if len(edges):
                hashes.append(hashing.span_hashes(hashing.prefix_sums(raw), edges[0::2], edges[1::2]))
                counts[row] += len(edges) // 2
    return (np.concatenate(hashes) if hashes else np.empty(0, np.uint64)), counts


def counted(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, occurrences), by text and then by term."""
    owner = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return owner[at], hashes[at], np.diff(np.append(at, len(hashes)))


def entries(term: np.ndarray, level: np.ndarray | int) -> np.ndarray:
    """What is hashed into a signature for a term and a level."""
    return hashing.mixed(term + np.uint64(1 + 2 * 0x1F0A2BE71) * np.asarray(level, dtype=np.uint64))


def places(entry: np.ndarray, width: int) -> np.ndarray:
    """(entries, HASHES) bits of a signature of `width` bits."""
    step = (entry >> np.uint64(32)) | np.uint64(1)
    nth = np.arange(HASHES, dtype=np.uint64)
    return ((entry[:, None] + step[:, None] * nth) & np.uint64(width - 1)).astype(np.int64)


def widths(n_entries: np.ndarray) -> np.ndarray:
    wanted = np.ceil(np.log2(np.maximum(n_entries * BITS_PER_ENTRY, 1))).astype(np.int64)
    return np.clip(1 << np.minimum(wanted, 40), NARROWEST, WIDEST)


class Shards:
    """Documents of a task on their way into shards, by the width of their signatures."""

    def __init__(self) -> None:
        self.waiting: dict[int, list[tuple]] = {}

    def add(self, width: int, doc: tuple) -> dict | None:
        """`doc`: id, text key, length, entries. A shard, once it is full."""
        docs = self.waiting.setdefault(width, [])
        docs.append(doc)
        if len(docs) >= max(8, min(SHARD_DOCS, SHARD_BITS // width)):
            return self.sealed(width)
        return None

    def sealed(self, width: int) -> dict:
        docs = self.waiting.pop(width)
        at = np.repeat(np.arange(len(docs)), [len(d[3]) for d in docs])
        bits = np.zeros((width, len(docs)), dtype=bool)
        bits[places(np.concatenate([d[3] for d in docs]), width), at[:, None]] = True
        return {
            "kind": "shard", "width": width, "ids": [d[0] for d in docs], "keys": [d[1] for d in docs],
            "lengths": [d[2] for d in docs], "slices": np.packbits(bits, axis=1).tobytes(),
        }


def index(rows: DataFrame, wanted: np.ndarray) -> DataFrame:
    """Shards of signatures, counts of the wanted terms, and the corpus's size, in one pass.

    `rows`: doc_id, text, text_key. `wanted`: a bitmap of FILTER_BITS bits that terms must be
    in to be counted. Kinds of rows: `shard`; `term` (a term, documents that hold it); `size`
    (documents with terms, their terms). Counts are partial, sums over rows are whole.
    """
    id_type = rows.schema["doc_id"].dataType.simpleString()
    id_arrow = to_arrow_type(rows.schema["doc_id"].dataType)
    schema = (
        f"kind string, width int, ids array<{id_type}>, keys array<bigint>, lengths array<bigint>, "
        "slices binary, term bigint, n bigint, total bigint"
    )
    shared = rows.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, shards = shared.value, Shards()
        arrow_schema = pa.schema([
            ("kind", pa.string()), ("width", pa.int32()), ("ids", pa.list_(id_arrow)),
            ("keys", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("slices", pa.binary()),
            ("term", pa.int64()), ("n", pa.int64()), ("total", pa.int64()),
        ])

        def out(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, schema=arrow_schema)

        def term_rows() -> pa.RecordBatch:
            return pa.record_batch(
                [pa.array(["term"] * len(known)), *(pa.nulls(len(known), f.type) for f in list(arrow_schema)[1:6]),
                 pa.array(known.view(np.int64)), pa.array(holders), pa.nulls(len(known), pa.int64())],
                schema=arrow_schema,
            )

        known, holders = np.empty(0, np.uint64), np.empty(0, np.int64)
        n_docs = n_terms = 0
        for batch in batches:
            for start, end in chunks(batch, "text", TEXT_BLOCK):
                part = batch.slice(start, end - start)
                hashes, counts = terms(part.column("text").to_pylist())
                owner, term, often = counted(hashes, counts)
                n_docs += int((counts > 0).sum())
                n_terms += int(counts.sum())
                place = (term & np.uint64(FILTER_BITS - 1)).astype(np.int64)
                asked = term[(bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1]
                both, at = np.unique(np.concatenate((known, asked)), return_inverse=True)
                holders = np.bincount(at, np.concatenate((holders, np.ones(len(asked)))), len(both)).astype(np.int64)
                known = both
                if len(known) > HELD_TERMS:
                    yield term_rows()
                    known, holders = np.empty(0, np.uint64), np.empty(0, np.int64)
                n_levels = np.searchsorted(LEVELS, often, side="right")
                all_owners = np.repeat(owner, n_levels)
                nth = np.arange(len(all_owners)) - np.repeat(np.cumsum(n_levels) - n_levels, n_levels)
                all_entries = entries(np.repeat(term, n_levels), nth)
                edges = np.searchsorted(all_owners, np.arange(len(counts) + 1))
                ids, keys = part.column("doc_id").to_pylist(), part.column("text_key").to_pylist()
                width = widths(np.diff(edges)).tolist()
                for row in np.flatnonzero(counts).tolist():
                    doc = (ids[row], keys[row], int(counts[row]), all_entries[edges[row] : edges[row + 1]].copy())
                    full = shards.add(width[row], doc)
                    if full:
                        yield out([full])
        for width in list(shards.waiting):
            yield out([shards.sealed(width)])
        if len(known):
            yield term_rows()
        yield out([{"kind": "size", "n": n_docs, "total": n_terms}])

    return rows.mapInArrow(run, schema)


def bitmap_of(values: DataFrame, column: str) -> np.ndarray:
    """A bitmap of the low bits of a long column; of fixed size, whatever the number of rows."""
    place = F.col(column).bitwiseAND(F.lit(FILTER_BITS - 1)) + 1
    marks = values.select(place.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")
    )
    out = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for bucket, bits in marks.collect():  # FILTER_BITS / 32768 rows at most
        out[(bucket - 1) * 4096 : bucket * 4096] = np.frombuffer(bits, dtype=np.uint8)
    return out


def parts_of_score(often: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """What `often` occurrences are worth per weight, in a document of that spread m."""
    return (1_000_000_000 * often) // (1000 * often + 8 * spread)


def spread_of(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 10 + (90 * lengths * n_docs) // n_terms


class Block:
    """A block of items: their (item, term) pairs in order of the items."""

    def __init__(self, items: list[dict]):
        sizes = [len(i["terms"]) for i in items]
        self.first = np.cumsum(sizes) - sizes
        self.term = np.array([t for i in items for t in i["terms"]], dtype=np.int64).view(np.uint64)
        self.weight = np.array([w for i in items for w in i["weights"]], dtype=np.int64)
        self.owner = np.repeat(np.arange(len(items)), sizes)
        self.n = len(items)

    def bounds(self, width: int, lengths: np.ndarray, slices: bytes, n_docs: int, n_terms: int) -> np.ndarray:
        """(items, documents of the shard): no score is higher."""
        n = len(lengths)
        bits = np.frombuffer(slices, dtype=np.uint8).reshape(width, -1)
        spread = spread_of(lengths, n_docs, n_terms)
        top = np.append(LEVELS[1:] - 1, np.iinfo(np.int64).max)
        out = np.zeros((self.n, n), dtype=np.int64)
        step = max(1, CELLS // max(n, 1))
        for start in range(0, len(self.term), step):
            term, weight = self.term[start : start + step], self.weight[start : start + step]
            owner, alive, before = self.owner[start : start + step], None, 0
            for level in range(len(LEVELS)):
                if not len(term):
                    break
                at = places(entries(term, level), width)
                held = bits[at[:, 0]]
                for nth in range(1, HASHES):
                    held = held & bits[at[:, nth]]
                # A term that occurs often is there for all lower levels too.
                held = held if alive is None else held & alive
                some = held.any(axis=1)
                term, weight, owner, alive = term[some], weight[some], owner[some], held[some]
                if not len(term):
                    break
                worth = parts_of_score(np.minimum(top[level], lengths), spread)
                found = np.unpackbits(alive, axis=1, count=n).astype(np.int64) * weight[:, None]
                edges = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
                out[owner[edges]] += np.add.reduceat(found, edges, axis=0) * (worth - before)
                before = worth
        return out


def bounded(
    shards: DataFrame, blocks: DataFrame, n_blocks: int, n_docs: int, n_terms: int,
    chosen: Callable[[], BestBounds | NotExcluded], schema: str,
) -> DataFrame:
    """Every shard meets every block of items; `chosen()` makes a task's choice by the bounds.

    Blocks of items are a small table that Spark broadcasts below its own limit and else deals,
    in SALTS copies, to the shards' tasks.
    """
    salted = blocks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = shards.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    spread = spread.withColumn("salt", F.pmod(F.xxhash64(F.element_at("keys", 1), "width"), F.lit(SALTS)))
    met = spread.join(salted, ["block", "salt"])
    extra = [c for c in blocks.columns if c not in ("block", "items")]
    met = met.select("block", "width", "ids", "keys", "lengths", "slices", "items", *extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, Block] = {}
        choose = chosen()
        for batch in batches:
            for row in range(batch.num_rows):
                one = {c: batch.column(c)[row] for c in batch.schema.names}
                number = one["block"].as_py()
                if number not in known:
                    known[number] = Block(one["items"].as_py())
                lengths = np.array(one["lengths"].as_py(), dtype=np.int64)
                block = known[number]
                bounds = block.bounds(one["width"].as_py(), lengths, one["slices"].as_buffer(), n_docs, n_terms)
                yield from choose.add(number, bounds, one)
        yield from choose.rest()

    return met.mapInArrow(run, schema)


class BestBounds:
    """A task's documents with the k best bounds for each item."""

    def __init__(self, k: int, id_type: pa.DataType):
        self.k, self.id_type = k, id_type
        self.best: dict[tuple[int, int], list[tuple]] = {}

    def add(self, block: int, bounds: np.ndarray, row: dict) -> Iterator[pa.RecordBatch]:
        ids, keys = row["ids"].as_py(), row["keys"].as_py()
        k = min(self.k, bounds.shape[1])
        top = np.argpartition(-bounds, k - 1, axis=1)[:, :k]
        for at in range(len(bounds)):
            values = bounds[at, top[at]]
            held = self.best.setdefault((block, at), [])
            least = held[-1][0] if len(held) == self.k else 0
            new = [(int(v), ids[d], keys[d]) for v, d in zip(values, top[at]) if v > least]
            if new:
                held += new
                held.sort(key=lambda one: -one[0])
                del held[self.k :]
        return iter(())

    def rest(self) -> Iterator[pa.RecordBatch]:
        found = [(b, at, *one) for (b, at), held in self.best.items() for one in held]
        if found:
            block, at, bound, ids, keys = zip(*found)
            yield pa.record_batch(
                [pa.array(block, pa.int32()), pa.array(at, pa.int32()), pa.array(bound, pa.int64()),
                 pa.array(ids, self.id_type), pa.array(keys, pa.int64())],
                names=["block", "at", "bound", "doc_id", "text_key"],
            )


class NotExcluded:
    """All documents whose bound reaches the item's threshold."""

    def __init__(self, id_type: pa.DataType):
        self.id_type = id_type

    def add(self, block: int, bounds: np.ndarray, row: dict) -> Iterator[pa.RecordBatch]:
        least = np.ones(len(bounds), dtype=np.int64)
        for one in row["least"].as_py():
            least[one["at"]] = max(1, one["score"])
        at, doc = np.nonzero(bounds >= least[:, None])
        if len(at):
            ids = row["ids"].values.take(pa.array(doc))
            yield pa.record_batch(
                [pa.array(np.full(len(at), block, dtype=np.int32)), pa.array(at.astype(np.int32)),
                 ids.cast(self.id_type), row["keys"].values.take(pa.array(doc))],
                names=["block", "at", "doc_id", "text_key"],
            )

    def rest(self) -> Iterator[pa.RecordBatch]:
        return iter(())


def rescored(pairs: DataFrame, rows: DataFrame, blocks: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """(block, at, doc_id, score): exact scores of the pairs, for every row a document has."""
    wanted = stored(
        pairs.select("block", "at", "doc_id", "text_key").distinct()
        .groupBy("block", "doc_id", "text_key").agg(F.collect_list("at").alias("asked")),
        "search-pairs",
    ).withColumnsRenamed({"doc_id": "own_id", "text_key": "own_key"})
    near, _ = parted(rows, "text_key", wanted.select(F.col("own_key").alias("text_key")), "search")
    texts = near.join(
        wanted, (near["text_key"] == wanted["own_key"]) & near["doc_id"].eqNullSafe(wanted["own_id"])
    ).select("block", "asked", "doc_id", "text")
    # Only the asked items of a block, at most a block's, go along with a text.
    asked = texts.join(blocks.select("block", "items"), "block").select(
        "block", "doc_id", "text", "asked",
        F.transform("asked", lambda at: F.element_at("items", at + 1)).alias("items"),
    )

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start, end in chunks(batch, "text", TEXT_BLOCK):
            part = batch.slice(start, end - start)
            hashes, counts = terms(part.column("text").to_pylist())
            owner, term, often = counted(hashes, counts)
            edges = np.searchsorted(owner, np.arange(len(counts) + 1))
            spread = spread_of(counts, n_docs, n_terms)
            scores, n_asked = [], []
            for row, items in enumerate(part.column("items").to_pylist()):
                own, tf = term[edges[row] : edges[row + 1]], often[edges[row] : edges[row + 1]]
                worth = parts_of_score(tf, spread[row])
                for item in items:
                    sought = np.array(item["terms"], dtype=np.int64).view(np.uint64)
                    at = np.minimum(np.searchsorted(own, sought), max(len(own) - 1, 0))
                    hit = own[at] == sought if len(own) else np.zeros(len(sought), dtype=bool)
                    scores.append(int((np.array(item["weights"], dtype=np.int64)[hit] * worth[at[hit]]).sum()))
                n_asked.append(len(items))
            again = pa.array(np.repeat(np.arange(len(part)), n_asked))
            yield pa.record_batch(
                [part.column("block").take(again), part.column("asked").flatten(),
                 part.column("doc_id").take(again), pa.array(scores, pa.int64())],
                names=["block", "at", "doc_id", "score"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return arrow_map(asked, of, f"block int, at int, doc_id {kind}, score bigint")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best rows of `docs`, scores above 0.

    Rows of one item id are one item with the terms of all of them, a null id included. Every
    row of `docs` is a document, repeated rows and rows without an id too; equal scores go by
    ascending id, null first. A null or empty text has no terms: such a document is never
    found and counts for nothing, such an item finds nothing. Empty tables give no rows.
    """
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("text_key", F.xxhash64("text"))
    id_arrow = to_arrow_type(rows.schema["doc_id"].dataType)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    asked = stored(item_terms(pick(items, item_id=item_id_col, text=item_text_col)), "search-terms")

    built = stored(index(rows, bitmap_of(asked, "term")), "search-index")
    size = built.filter("kind = 'size'").agg(F.sum("n"), F.sum("total")).first()
    n_docs, n_terms = size[0] or 0, size[1] or 1
    holders = built.filter("kind = 'term'").groupBy("term").agg(F.sum("n").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
    weighted = asked.join(holders, "term").select("item_id", "term", weight.cast("long").alias("weight"))
    weighted = stored(weighted.filter("weight > 0"), "search-weights")
    n_blocks = max(1, -(-weighted.count() // BLOCK_TERMS))
    blocks = stored(
        weighted.groupBy("item_id").agg(F.collect_list(F.struct("term", "weight")).alias("own"))
        .select(
            F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)).cast("int").alias("block"),
            F.struct("item_id", F.col("own.term").alias("terms"), F.col("own.weight").alias("weights")).alias("item"),
        )
        .groupBy("block").agg(F.collect_list("item").alias("items")),
        "search-blocks",
    )
    shards = built.filter("kind = 'shard'")

    bests = bounded(
        shards, blocks, n_blocks, n_docs, n_terms, lambda: BestBounds(SEEDS * k, id_arrow),
        f"block int, at int, bound bigint, doc_id {id_type}, text_key bigint",
    )
    by_bound = Window.partitionBy("block", "at").orderBy(F.desc("bound"), "doc_id", "text_key")
    first = bests.withColumn("nth", F.row_number().over(by_bound)).filter(F.col("nth") <= SEEDS * k)
    by_score = Window.partitionBy("block", "at").orderBy(F.desc("score"), "doc_id")
    reached = (
        rescored(first, rows, blocks, n_docs, n_terms)
        .withColumn("nth", F.row_number().over(by_score)).filter(F.col("nth") == k)
        .groupBy("block").agg(F.collect_list(F.struct("at", "score")).alias("least"))
    )
    with_least = stored(
        blocks.join(reached, "block", "left")
        .withColumn("least", F.coalesce("least", F.array().cast("array<struct<at:int,score:bigint>>"))),
        "search-thresholds",
    )
    left = bounded(
        shards, with_least, n_blocks, n_docs, n_terms, lambda: NotExcluded(id_arrow),
        f"block int, at int, doc_id {id_type}, text_key bigint",
    )
    scores = rescored(left, rows, blocks, n_docs, n_terms).filter("score > 0")
    ranked = scores.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)
    named = blocks.select("block", F.posexplode("items").alias("at", "item")).select("block", "at", "item.item_id")
    return ranked.join(named, ["block", "at"]).select("item_id", "rank", "doc_id", "score")


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term) once each."""
    kind = items.schema["item_id"].dataType.simpleString()

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start, end in chunks(batch, "text", TEXT_BLOCK):
            part = batch.slice(start, end - start)
            owner, term, _ = counted(*terms(part.column("text").to_pylist()))
            yield pa.record_batch(
                [part.column("item_id").take(pa.array(owner)), pa.array(term.view(np.int64))],
                names=["item_id", "term"],
            )

    return arrow_map(items, of, f"item_id {kind}, term bigint").distinct()


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = rf"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '{_TERMS}')) AS term FROM documents
), tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
len AS (SELECT doc_id, sum(tf) AS n FROM tf GROUP BY doc_id),
size AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS nt FROM len),
spread AS (SELECT doc_id, 10 + CAST((90 * CAST(n AS BIGINT) * nd) // nt AS BIGINT) AS m FROM len, size),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERMS}')) AS term FROM benchmark),
df AS (SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM asked) GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * nd + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, size),
s AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN w USING (term) JOIN tf USING (term) JOIN spread USING (doc_id) GROUP BY ALL
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM s WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
