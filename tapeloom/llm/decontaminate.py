"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

Items and texts are sequences of normalised words. A window of a text leaks an item of n words
if some stretch around it is within floor(share x n) word edits of the item. The CGK walk
reads a sequence with a pointer that stays or moves on by a random bit of (step, word), and
emits the word under it, which maps edit distance to Hamming distance. Each repetition has
its own walk and samples a few steps; a window whose sampled words equal an item's is a
candidate, and candidates are verified exactly by bit-parallel approximate matching.

Within its edits an item keeps some run of words whole, so only windows are embedded that
would put such a run of an item where the text has it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm import hashing
from tapeloom.llm.frames import arrow_map, chunks, pick, table

SHARE = 0.2
REPEATS = 32
SAMPLED = 4
RUN = 3
MIN_WORDS = 5
ITEMS = 20_000
BLOCK = 1 << 20
PAD = np.uint64(0x5851F42D4C957F2D)
NOT_WORD = re.compile(rb"[^0-9a-z\x80-\xff]+")


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts (lower case, ASCII punctuation and blanks apart)."""
    raws = [NOT_WORD.sub(b" ", t.lower().encode()) for t in texts]
    return hashing.words(raws)


def edits(n: int, share: float) -> int:
    return int(n * share + 1e-9)


def kept_run(n: int, share: float) -> int:
    """Words that stay together somewhere, whatever the allowed edits; at most RUN."""
    k = edits(n, share)
    return min(RUN, max(1, (n - k) // (k + 1)))


def walk(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, repeat: int, steps: int) -> np.ndarray:
    """One key per window: the hash of the words that the sampled steps of a walk emit."""
    draw = hashing.mixed(
        np.arange(1, steps + 1, dtype=np.uint64) * hashing.BASE + np.uint64(repeat + 1) * hashing.INVERSE
    )
    sampled = set(np.argsort(draw)[: min(SAMPLED, steps)].tolist())
    key = np.full(len(starts), np.uint64(repeat + 1), dtype=np.uint64)
    at = starts.copy()
    for step in range(max(sampled) + 1):
        inside = at < ends
        word = np.where(inside, words[np.minimum(at, len(words) - 1)], PAD)
        if step in sampled:
            key = (key + word) * hashing.BASE
            key ^= key >> np.uint64(31)
        at += ((word * (draw[step] | np.uint64(1))) >> np.uint64(63)).astype(np.int64)
    return key


@dataclass
class Items:
    """One block of benchmark items, ready for lookups; its size is bounded by the caller."""

    ids: list
    words: list[np.ndarray]
    share: float

    def __post_init__(self) -> None:
        #: Per class of lengths: steps of a walk, per run length sorted runs and their places,
        #: per repetition sorted keys and their items.
        self.classes = []
        sizes = np.array([len(w) for w in self.words])
        low = MIN_WORDS
        while len(sizes) and low <= sizes.max():
            members = np.flatnonzero((sizes >= low) & (sizes < low * 2))
            if len(members):
                self.classes.append(self.prepared(members, max(SAMPLED, int(low * 1.6))))
            low *= 2

    def prepared(self, members: np.ndarray, steps: int) -> tuple:
        runs: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for item in members.tolist():
            words = self.words[item]
            n = kept_run(len(words), self.share)
            counts = np.array([len(words)])
            hashes, found = hashing.shingles(words, counts, n)
            runs.setdefault(n, []).append((hashes, np.arange(int(found[0]))))
        tables = {}
        for n, parts in runs.items():
            pairs = np.unique(
                np.column_stack([np.concatenate([p[i].astype(np.uint64) for p in parts]) for i in (0, 1)]), axis=0
            )
            hashes, first = np.unique(pairs[:, 0], return_index=True)
            bits = np.zeros(1 << 20, dtype=bool)
            bits[(hashes >> np.uint64(44)).astype(np.int64)] = True
            tables[n] = (hashes, np.append(first, len(pairs)), pairs[:, 1].astype(np.int64), bits)
        joined = np.concatenate([self.words[m] for m in members])
        ends = np.cumsum([len(self.words[m]) for m in members])
        starts = ends - np.array([len(self.words[m]) for m in members])
        keys = []
        for repeat in range(REPEATS):
            own = walk(joined, starts, ends, repeat, steps)
            order = np.argsort(own, kind="stable")
            keys.append((own[order], members[order]))
        return steps, tables, keys

    def windows(self, words: np.ndarray, counts: np.ndarray, tables: dict) -> np.ndarray:
        """Starts that would put a run of an item where the text has it."""
        ends = np.cumsum(counts)
        found = []
        for n, (hashes, first, places, bits) in tables.items():
            runs, n_out = hashing.shingles(words, counts, n)
            at = np.arange(len(runs)) + np.repeat(ends - counts - (np.cumsum(n_out) - n_out), n_out)
            maybe = np.flatnonzero(bits[(runs >> np.uint64(44)).astype(np.int64)])
            rank = np.minimum(np.searchsorted(hashes, runs[maybe]), len(hashes) - 1)
            hit = hashes[rank] == runs[maybe]
            maybe, rank = maybe[hit], rank[hit]
            sizes = first[rank + 1] - first[rank]
            own = np.repeat(np.arange(len(maybe)), sizes)
            nth = np.arange(len(own)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            begin = (ends - counts)[np.searchsorted(ends, at[maybe], side="right")]
            start = at[maybe][own] - places[np.repeat(first[rank], sizes) + nth]
            found.append(np.maximum(start, begin[own]))
        return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)

    def candidates(self, words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window start, item) pairs whose sampled words agree in some repetition."""
        ends = np.cumsum(counts)
        out: list[np.ndarray] = []
        for steps, tables, keys in self.classes:
            starts = self.windows(words, counts, tables)
            if not len(starts):
                continue
            own_end = ends[np.searchsorted(ends, starts, side="right")]
            for repeat, (sorted_keys, members) in enumerate(keys):
                key = walk(words, starts, own_end, repeat, steps)
                low = np.searchsorted(sorted_keys, key, side="left")
                n = np.searchsorted(sorted_keys, key, side="right") - low
                some = np.flatnonzero(n)
                if len(some):
                    own = np.repeat(some, n[some])
                    nth = np.arange(len(own)) - np.repeat(np.cumsum(n[some]) - n[some], n[some])
                    out.append(np.column_stack((starts[own], members[low[own] + nth])))
        if not out:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        pairs = np.unique(np.concatenate(out), axis=0)
        return pairs[:, 0], pairs[:, 1]

    def masks(self, item: int) -> dict[int, int]:
        out: dict[int, int] = {}
        for place, word in enumerate(self.words[item].tolist()):
            out[word] = out.get(word, 0) | 1 << place
        return out


def best_end(masks: dict[int, int], n: int, region: list[int]) -> tuple[int, int]:
    """(fewest edits, where it ends) of n words against any stretch of the region (Myers)."""
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score, best, where = full, 0, n, n, 0
    for at, word in enumerate(region):
        same = masks.get(word, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        right = down | ~(diagonal | up) & full
        left = up & diagonal
        if right & top:
            score += 1
        elif left & top:
            score -= 1
        right = (right << 1) & full
        left = (left << 1) & full
        up = left | ~(diagonal | right) & full
        down = right & diagonal
        if score < best:
            best, where = score, at + 1
    return best, where


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    share: float = SHARE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    items_at_once: int = ITEMS,
) -> DataFrame:
    """(doc_id, item_id, distance, last_word): each document's closest stretch to a leaked item.

    Words are compared in lower case and without ASCII punctuation. `distance` is the number
    of word edits, at most floor(share x words of the item); `last_word` counts the words up to
    the stretch's end. Null texts, items of fewer than five words, and null item ids leak
    nothing; repeated rows and items give a row each. The benchmark is sent along in
    blocks of `items_at_once`, one pass over the documents for each block. A repetition finds
    a window by chance; their number is set for a recall above 0.99 at half the allowed edits.
    """
    spark = docs.sparkSession
    rows = pick(docs, doc_id=id_col, text=text_col).filter("text IS NOT NULL")
    asked = pick(benchmark, item_id=item_col, text=item_text_col).filter("item_id IS NOT NULL AND text IS NOT NULL")
    kinds = [f.dataType.simpleString() for f in (rows.schema["doc_id"], asked.schema["item_id"])]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, distance int, last_word bigint"
    found = None
    for block in item_blocks(asked, items_at_once):
        part = arrow_map(rows, searcher(spark.sparkContext.broadcast(prepared(block, share))), schema)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], schema)


def prepared(block: list[tuple], share: float) -> Items:
    hashes, counts = words_of([text for _, text in block])
    ends = np.cumsum(counts)
    words = [hashes[e - n : e] for e, n in zip(ends.tolist(), counts.tolist())]
    long = [i for i, w in enumerate(words) if len(w) >= MIN_WORDS]
    return Items([block[i][0] for i in long], [words[i] for i in long], share)


def item_blocks(asked: DataFrame, size: int) -> Iterator[list[tuple]]:
    """The items in blocks of `size`; one block is on the driver at a time."""
    block: list[tuple] = []
    for row in asked.toLocalIterator():
        block.append((row["item_id"], row["text"]))
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def searcher(shared):
    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        for start, end in chunks(batch, "text", BLOCK):
            texts = batch.column("text")[start:end].to_pylist()
            words, counts = words_of(texts)
            if not len(words):
                continue
            ends = np.cumsum(counts)
            best: dict[tuple[int, int], tuple[int, int]] = {}
            masks: dict[int, dict[int, int]] = {}
            for at, item in zip(*(c.tolist() for c in items.candidates(words, counts))):
                n = len(items.words[item])
                k = edits(n, items.share)
                row = int(np.searchsorted(ends, at, side="right"))
                begin, stop = int(ends[row] - counts[row]), int(ends[row])
                low, high = max(begin, at - k), min(stop, at + n + k)
                if item not in masks:
                    masks[item] = items.masks(item)
                distance, where = best_end(masks[item], n, words[low:high].tolist())
                if distance <= k:
                    now = (distance, low + where - begin)
                    best[row, item] = min(best.get((row, item), now), now)
            if best:
                keys = list(best)
                yield pa.record_batch(
                    [batch.column("doc_id")[start:end].take(pa.array([r for r, _ in keys], pa.int64())),
                     pa.array([items.ids[i] for _, i in keys]),
                     pa.array([best[key][0] for key in keys], pa.int32()),
                     pa.array([best[key][1] for key in keys], pa.int64())],
                    names=["doc_id", "item_id", "distance", "last_word"],
                )

    return of


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
