"""Removal of every byte covered by a long string that also occurs elsewhere.

Every window of `length` bytes is named by its anchor: the 128-byte gram in it with the least
hash, the leftmost on a tie. Equal windows have equal anchors at equal places, so windows meet
only with windows of the same anchor gram; anchors are some hundred bytes apart, and each
stands for a run of consecutive windows. A run whose whole stretch occurs again is repeated as
a whole. What is left, one stretch of each different kind, is cut into blocks of windows that
share a core; blocks whose core occurs once are done. Of the others a short mark stands for
the core, and the strings go to shards, whose Burrows-Wheeler transforms are merged by
iterative interleave refinement (`bwt`): suffixes that are still together at the depth of a
window are a repeated interval.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm import bwt, hashing, similar
from tapeloom.llm.frames import arrow_map, chunks, parted, pick, stored, table

LENGTH = 400
GRAM = 128
#: Windows per block; a block's windows share all but so many bytes.
SPREAD = 64
#: Bytes that stand for a block's core, and bytes of a window with them.
MARK = 9
DEPTH = SPREAD - 1 + MARK
#: Bytes whose hashes are in memory at once, and bytes of one merge.
BLOCK = (1 << 20) - 8192
MERGE = 1 << 18
#: Blocks with more members than this are compared window by window, as counts.
CROWD = 2048
LOW = np.uint64((1 << 20) - 1)


def stretches(raw: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor in joined texts that end at `ends`: (first, last, anchor)."""
    n_starts = len(raw) - length + 1
    if n_starts <= 0:
        return (np.empty(0, np.int64),) * 3
    sums = hashing.prefix_sums(raw)
    at = np.arange(len(raw) - gram + 1)
    grams = hashing.span_hashes(sums, at, at + gram)
    least = (grams & ~LOW) | at.astype(np.uint64)
    width, done = length - gram + 1, 1
    while done * 2 <= width:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    if width > done:
        least = np.minimum(least[: n_starts], least[width - done : width - done + n_starts])
    anchor = (least[:n_starts] & LOW).astype(np.int64)
    starts = np.arange(n_starts)
    own_end = ends[np.searchsorted(ends, starts, side="right")]
    whole = starts + length <= own_end
    first = whole.copy()
    first[1:] &= (anchor[1:] != anchor[:-1]) | ~whole[:-1]
    last = whole.copy()
    last[:-1] &= (anchor[1:] != anchor[:-1]) | ~whole[1:]
    first, last = np.flatnonzero(first), np.flatnonzero(last)
    return first, last, anchor[first]


def runs_of(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """(doc_id, text_key, key, low, high, whole, anchors) for every different run of a text.

    `key` hashes the anchor's gram, the windows start `low` to `high` bytes before the anchor,
    and `whole` hashes all bytes they cover. `anchors` are all places of the run in the text: a
    period of few bytes is one row, however often it comes.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()

    def found(raws: list[bytes], owners: list[int], offsets: list[int]) -> list[np.ndarray]:
        ends = np.cumsum([len(r) for r in raws])
        raw = np.frombuffer(b"".join(raws), dtype=np.uint8)
        first, last, anchor = stretches(raw, ends, length, gram)
        if not len(first):
            return []
        sums = hashing.prefix_sums(raw)
        text = np.searchsorted(ends, first, side="right")
        shift = (np.array(offsets) - (ends - [len(r) for r in raws]))[text]
        return [
            np.array(owners)[text], anchor + shift, hashing.span_hashes(sums, anchor, anchor + gram).view(np.int64),
            anchor - last, anchor - first, hashing.span_hashes(sums, first, last + length).view(np.int64),
        ]

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start, end in chunks(batch, "text", BLOCK):
            part = batch.slice(start, end - start)
            held: list[tuple[bytes, int, int]] = []
            out: list[list[np.ndarray]] = []
            for row, text in enumerate(part.column("text").to_pylist()):
                raw = (text or "").encode()
                if len(raw) < length:
                    continue
                if len(raw) <= BLOCK:
                    held.append((raw, row, 0))
                    continue
                for at in range(0, len(raw) - length + 1, BLOCK - length):
                    out.append(found([raw[at : at + BLOCK - 1]], [row], [at]))
            if held:
                out.append(found(*(list(x) for x in zip(*held))))
            columns = [np.concatenate(c) for c in zip(*(o for o in out if o))]
            if columns:
                owner, anchors, *same = columns
                order = np.lexsort((anchors, *same, owner))
                same = [c[order] for c in (owner, *same)]
                first = np.concatenate(([True], np.any([c[1:] != c[:-1] for c in same], axis=0)))
                owner = pa.array(same[0][first])
                edges = np.append(np.flatnonzero(first), len(order)).astype(np.int32)
                yield pa.record_batch(
                    [part.column("doc_id").take(owner), part.column("text_key").take(owner),
                     *(pa.array(c[first].astype(np.int64)) for c in same[1:]),
                     pa.ListArray.from_arrays(pa.array(edges), pa.array(anchors[order].astype(np.int64)))],
                    names=["doc_id", "text_key", "key", "low", "high", "whole", "anchors"],
                )

    return arrow_map(
        rows, of,
        f"doc_id {kind}, text_key bigint, key bigint, low bigint, high bigint, whole bigint, anchors array<bigint>",
    )


def blocks_of(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(unit, kind, base, raw): of each listed stretch, its blocks of up to SPREAD windows.

    `unit` hashes the anchor gram, the block's place and the core that all its windows share.
    `raw` has a mark of the core in its place, so a window is DEPTH bytes of it: two are equal
    if their windows are. `kind` is the stretch, and the window that starts at raw[i:] starts
    `base` - i bytes before the anchor.
    """

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start, end in chunks(batch, "text", 4 * BLOCK):
            part = batch.slice(start, end - start)
            for text, kinds in zip(part.column("text").to_pylist(), part.column("kinds").to_pylist()):
                raw = text.encode()
                view = np.frombuffer(raw, dtype=np.uint8)
                units, names, bases, cuts = [], [], [], []
                for kind in kinds:
                    anchor, low, high = kind["anchor"], kind["low"], kind["high"]
                    left = anchor - high
                    around = view[left : anchor - low + length]
                    sums = hashing.prefix_sums(around)
                    for block in range(low // SPREAD, high // SPREAD + 1):
                        most = min(high, block * SPREAD + SPREAD - 1)
                        fewest = max(low, block * SPREAD)
                        # In the stretch's own places; the anchor is at `high`.
                        core = np.array([high - block * SPREAD])
                        edge = core + length - SPREAD + 1
                        shared = hashing.span_hashes(sums, core, edge)[0]
                        units.append((kind["key"], block, shared))
                        names.append(kind["kind"])
                        bases.append(most)
                        start = anchor - block * SPREAD
                        end = start + length - SPREAD + 1
                        cuts.append(raw[anchor - most : start] + mark(int(shared)) + raw[end : anchor - fewest + length])
                keys, places, cores = (np.array(c) for c in zip(*units))
                unit = hashing.mixed(
                    hashing.mixed(keys.astype(np.int64).view(np.uint64) + places.astype(np.uint64) * hashing.BASE)
                    ^ cores.astype(np.uint64)
                )
                yield pa.record_batch(
                    [pa.array(unit.view(np.int64)), pa.array(names, pa.int64()), pa.array(bases, pa.int64()),
                     pa.array(cuts, pa.binary())],
                    names=["unit", "kind", "base", "raw"],
                )

    return arrow_map(texts, of, "unit bigint, kind bigint, base bigint, raw binary")


def mark(core: int) -> bytes:
    """63 bits of a hash in MARK bytes below 128."""
    return bytes(core >> 7 * place & 127 for place in range(MARK))


def repeated_windows(blocks: DataFrame) -> DataFrame:
    """(kind, least, most): windows that occur again, in ranges of bytes before the anchor."""
    sizes = blocks.groupBy("unit").agg(F.count("*").alias("members")).filter("members > 1")
    several = blocks.join(sizes, "unit")

    def merge(part: pa.Table) -> Iterator[pa.RecordBatch]:
        units = part.column("meet").to_numpy()
        kinds, bases = (part.column(c).to_numpy() for c in ("kind", "base"))
        raws = part.column("raw").combine_chunks().to_pylist()
        edges = similar.edges_of(units).tolist()
        sizes = np.cumsum([0, *map(len, raws)])
        start = 0
        for at in range(1, len(edges)):
            if at < len(edges) - 1 and sizes[edges[at + 1]] - sizes[edges[start]] <= MERGE:
                continue
            rows = range(edges[start], edges[at])
            start = at
            own = [raws[r] for r in rows]
            string, offset = bwt.repeated(own[0::2], own[1::2], DEPTH)
            if len(string):
                order = np.lexsort((offset, string))
                string, offset = string[order], offset[order]
                cut = np.flatnonzero((string[1:] != string[:-1]) | (offset[1:] != offset[:-1] + 1)) + 1
                first, last = np.concatenate(([0], cut)), np.concatenate((cut, [len(string)])) - 1
                row = np.array(rows)[string[first]]
                yield pa.record_batch(
                    [pa.array(kinds[row]), pa.array(bases[row] - offset[last]), pa.array(bases[row] - offset[first])],
                    names=["kind", "least", "most"],
                )

    few = several.filter(F.col("members") <= CROWD).select(
        F.col("unit").alias("meet"), F.lit(0).alias("half"), "kind", "base", "raw"
    )
    merged = similar.over_groups(few, merge, "kind bigint, least bigint, most bigint")

    # A block as common as a licence text: every window counts for itself, whoever holds it.
    many = several.filter(F.col("members") > CROWD).withColumn(
        "at", F.explode(F.sequence(F.lit(1), F.octet_length("raw") - (DEPTH - 1)))
    ).select("unit", "kind", (F.col("base") - F.col("at") + 1).alias("before"),
             F.sha2(F.substring("raw", F.col("at"), F.lit(DEPTH)), 256).alias("window"))
    again = many.groupBy("unit", "before", "window").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    single = many.join(again, ["unit", "before", "window"]).select(
        "kind", F.col("before").alias("least"), F.col("before").alias("most")
    )
    return merged.unionByName(single)


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, text_key, spans): starts and ends, in bytes, of strings that occur again.

    Spans may overlap. Rows with equal id and text share the spans of both.
    """
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("text_key", F.xxhash64("text"))
    # The runs are made twice, which is cheaper than to keep them; few have a repeated anchor.
    runs = runs_of(rows, length, gram)
    again = runs.groupBy("key").agg(F.sum(F.size("anchors")).alias("n")).filter("n > 1").drop("n")
    again = stored(again, "repeated-keys")
    runs = stored(parted(runs, "key", again, "keys")[0].join(again, "key"), "repeated-anchors")
    same = ["key", "low", "high", "whole"]
    kinds = runs.groupBy(*same).agg(
        F.sum(F.size("anchors")).alias("n"),
        F.min(F.struct("text_key", "doc_id", F.col("anchors")[0].alias("anchor"))).alias("shown"),
    )
    kinds = stored(kinds.withColumn("kind", F.xxhash64(*same)), "kinds")
    mixed = kinds.groupBy("key").agg(F.count("*").alias("different")).filter("different > 1").drop("different")
    # Stored, as the ranges below: a gram of very many different stretches can be split.
    mixed = stored(mixed, "mixed")
    wanted = kinds.join(mixed, "key").groupBy(
        F.col("shown.text_key").alias("own_key"), F.col("shown.doc_id").alias("own_id")
    ).agg(F.collect_list(F.struct("kind", "key", "low", "high", F.col("shown.anchor").alias("anchor"))).alias("kinds"))
    wanted = stored(wanted, "wanted")
    # One plan at every size: the texts are dealt by their hash.
    texts = parted(rows, "text_key", wanted.select(F.col("own_key").alias("text_key")), "wanted")[0]
    texts = texts.alias("r").hint("merge").join(
        wanted, (F.col("r.text_key") == F.col("own_key")) & F.col("r.doc_id").eqNullSafe(F.col("own_id"))
    ).select("text", "kinds")
    # Rows that repeat would bring their blocks twice.
    blocks = stored(
        blocks_of(texts, length, gram).dropDuplicates(["unit", "kind"]), "blocks"
    )
    whole = kinds.filter("n > 1").select("kind", F.col("low").alias("least"), F.col("high").alias("most"))
    ranges = repeated_windows(blocks).unionByName(whole).groupBy("kind").agg(
        F.collect_list(F.struct("least", "most")).alias("ranges")
    )
    # Stored, so that a kind that very many texts hold can be split among tasks in the join.
    ranges = stored(ranges, "ranges")
    named = runs.select("doc_id", "text_key", "anchors", F.xxhash64(*same).alias("kind"))
    spans = F.transform(
        "anchors",
        lambda a: F.transform("ranges", lambda r: F.struct((a - r.most).alias("start"), (a - r.least + length).alias("end"))),
    )
    return named.join(ranges, "kind").select("doc_id", "text_key", F.flatten(spans).alias("spans")).groupBy(
        "doc_id", "text_key"
    ).agg(F.flatten(F.collect_list("spans")).alias("spans"))


def without_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, kept, n_bytes, n_removed, n_spans) for every row; `kept` is binary.

    Strings are judged on the input; each byte that a repeated string of `length` bytes covers
    goes, in all its places. Matches do not cross documents. A null text is empty; a text
    shorter than `length` stays whole. Repeated rows repeat each other's text. What is kept
    are bytes, as a cut may fall inside a character.
    """
    spans = stored(repeated_spans(docs, length, gram, id_col, text_col), "spans")
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("text_key", F.xxhash64("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    # Only texts that may have spans are shuffled to meet them.
    some, none = parted(rows, "text_key", spans, "spans")
    joined = some.alias("r").hint("merge").join(
        spans.alias("s"),
        (F.col("r.text_key") == F.col("s.text_key")) & F.col("r.doc_id").eqNullSafe(F.col("s.doc_id")),
        "left",
    ).select("r.doc_id", "r.text", "s.spans")
    whole = none.select("doc_id", "text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))
    joined = joined.unionByName(whole)

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start, end in chunks(batch, "text", 4 * BLOCK):
            part = batch.slice(start, end - start)
            kept, removed, n_spans, sizes = [], [], [], []
            for text, found in zip(part.column("text").to_pylist(), part.column("spans")):
                raw = (text or "").encode()
                sizes.append(len(raw))
                if not found.is_valid or not raw:
                    kept.append(raw)
                    removed.append(0)
                    n_spans.append(0)
                    continue
                values = found.values
                change = np.zeros(len(raw) + 1, dtype=np.int64)
                np.add.at(change, values.field("start").to_numpy(), 1)
                np.add.at(change, values.field("end").to_numpy(), -1)
                gone = np.cumsum(change[:-1]) > 0
                kept.append(np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes())
                removed.append(int(gone.sum()))
                n_spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
            yield pa.record_batch(
                [part.column("doc_id"), pa.array(kept, pa.binary()),
                 *(pa.array(c, pa.int64()) for c in (sizes, removed, n_spans))],
                names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"],
            )

    return arrow_map(
        joined, cut, f"doc_id {kind}, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint"
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digests, and the text that is left; U+FFFD stands for characters that a cut went through."""
    cut = without_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
    )
