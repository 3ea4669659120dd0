"""Repeated passages inside lines: runs of whole sentences that other places have too.

A line that two texts share is a paragraph (`paragraphs`); a passage that was put between other
words is none. Its sentences are: a sentence ends with its line, or with a word in `.`, `!` or `?`
unless one of the three words before it in the line ends so too, as a sentence of a word or
two says nothing. A passage is a longest run of sentences of one text that all occur elsewhere, with
`min_words` words or more together; a run of fewer words is no passage, however often its
sentences occur. Of each sentence the first place in a passage stays, by document id, text hash
and place.

Sentences are counted by 64-bit hashes. A fixed-size bitmap of the repeated ones leads a second
look at the texts to the runs worth verifying, and only their sentences are joined and grouped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tapeloom.llm import hashing
from tapeloom.llm.bitsliced import bitmap_of
from tapeloom.llm.frames import FILTER_BITS, arrow_map, chunks, stored

#: Words of a passage. One of 50 words, cut off anywhere, has half of them in whole sentences.
MIN_WORDS = 25
#: Words after a sentence's end that start no new one.
QUIET = 3
BLOCK = 1 << 20
_TOKEN = re.compile(r"[^\t\v\f\r ]+[\t\v\f\r ]*")
STOPS = np.zeros(256, dtype=bool)
STOPS[[33, 46, 63]] = True


def words(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of a text, and whether a sentence ends with it."""
    hashes, stops, lines = [np.empty(0, np.uint64)], [np.empty(0, bool)], [np.empty(0, np.int64)]
    line = 0
    for part in hashing.cut((text or "").encode()):
        raw = np.frombuffer(part, dtype=np.uint8)
        inside = np.zeros(len(raw) + 2, dtype=bool)
        inside[1:-1] = ~hashing.SPACES[raw]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[0::2], edges[1::2]
        if len(starts):
            feeds = np.cumsum(raw == 10)
            hashes.append(hashing.span_hashes(hashing.prefix_sums(raw), starts, ends))
            stops.append(STOPS[raw[ends - 1]])
            lines.append(feeds[starts] + line)
        line += part.count(b"\n")
    hashes, stop, line_of = (np.concatenate(c) for c in (hashes, stops, lines))
    near = np.zeros(len(stop), dtype=bool)
    for back in range(1, min(QUIET, len(stop)) + 1):
        near[back:] |= stop[:-back] & (line_of[:-back] == line_of[back:])
    last = np.append(line_of[1:] != line_of[:-1], True)[: len(stop)]
    return hashes, last | (stop & ~near)


def sentences(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each sentence of a text, and the number of the word after it."""
    hashes, stops = words(text)
    ends = np.flatnonzero(stops) + 1
    if not len(ends):
        return np.empty(0, np.uint64), ends
    power, inverse = hashing.powers(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashing.mixed(hashes) * power[: len(hashes)], out=sums[1:])
    starts = np.concatenate(([0], ends[:-1]))
    return hashing.mixed((sums[ends] - sums[starts]) * inverse[starts]), ends


def runs(repeated: np.ndarray, ends: np.ndarray, min_words: int) -> np.ndarray:
    """Which sentences are in a run of repeated ones of `min_words` words or more."""
    sizes = np.diff(ends, prepend=0)
    edges = np.flatnonzero(np.diff(np.concatenate(([0], repeated, [0]))))
    out = np.zeros(len(repeated), dtype=bool)
    for start, end in zip(edges[0::2], edges[1::2]):
        out[start:end] = sizes[start:end].sum() >= min_words
    return out


def repeated_passages(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_key, n_passages, cut): of the texts that hold a repeated passage.

    `rows`: doc_id, text, text_key. `cut` lists the word ranges (start and the word after the
    end, from 0) of sentences that do not stay, and is empty for a text that has only first
    places. Rows with one id and text count as one. Null and blank texts have no sentences.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()

    def all_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start, end in chunks(batch, "text", BLOCK):
            part = batch.slice(start, end - start)
            found = [sentences(text)[0] for text in part.column("text").to_pylist()]
            sizes = [len(f) for f in found]
            row = np.repeat(part.column("row").to_numpy().view(np.uint64), sizes)
            nth = np.concatenate([np.arange(n, dtype=np.uint64) for n in sizes])
            place = hashing.mixed(row + nth * hashing.BASE)
            yield pa.record_batch(
                [pa.array(np.concatenate(found).view(np.int64)), pa.array(place.view(np.int64))],
                names=["sentence", "place"],
            )

    # A repeated row of a document is no other place: it has the same hash.
    numbered = rows.select("text", F.xxhash64("doc_id", F.col("doc_id").isNull(), "text_key").alias("row"))
    places = arrow_map(numbered, all_of, "sentence bigint, place bigint").groupBy("sentence")
    repeated = places.agg(F.min("place").alias("low"), F.max("place").alias("high")).filter("low <> high")
    repeated = stored(repeated.select("sentence"), "sentences")
    bitmap = rows.sparkSession.sparkContext.broadcast(bitmap_of(repeated, "sentence"))

    def likely(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start, end in chunks(batch, "text", BLOCK):
            part = batch.slice(start, end - start)
            owner, columns = [], []
            for row, text in enumerate(part.column("text").to_pylist()):
                found, ends = sentences(text)
                place = (found & np.uint64(FILTER_BITS - 1)).astype(np.int64)
                hit = (bitmap.value[place >> 3] >> (place & 7).astype(np.uint8)) & 1
                nth = np.flatnonzero(runs(hit.astype(np.int8), ends, min_words))
                if len(nth):
                    starts = np.concatenate(([0], ends[:-1]))
                    owner.append(np.full(len(nth), row))
                    columns.append((nth, found[nth].view(np.int64), starts[nth], ends[nth]))
            if not owner:
                continue
            at = pa.array(np.concatenate(owner))
            nth, found, starts, ends = (pa.array(np.concatenate(c)) for c in zip(*columns))
            yield pa.record_batch(
                [part.column("doc_id").take(at), part.column("text_key").take(at), nth, found, starts, ends],
                names=["doc_id", "text_key", "nth", "sentence", "start", "stop"],
            )

    looked = arrow_map(
        rows, likely, f"doc_id {kind}, text_key bigint, nth bigint, sentence bigint, start bigint, stop bigint"
    ).distinct()
    # What the bitmap let through by chance goes here.
    kept = stored(looked, "sentence-places").join(repeated, "sentence", "left_semi")
    text = Window.partitionBy("doc_id", "text_key")
    run = F.col("nth") - F.row_number().over(text.orderBy("nth"))
    runs_of = kept.withColumn("run", run)
    long = F.sum(F.col("stop") - F.col("start")).over(Window.partitionBy("doc_id", "text_key", "run")) >= min_words
    passages = stored(runs_of.withColumn("long", long).filter("long").drop("long"), "passages")
    place = F.struct("doc_id", "text_key", "nth")
    first = passages.groupBy("sentence").agg(F.min(place).alias("first"))
    ranges = F.when(~place.eqNullSafe(F.col("first")), F.struct("start", "stop"))
    return passages.join(first, "sentence").groupBy("doc_id", "text_key").agg(
        F.countDistinct("run").alias("n_passages"), F.sort_array(F.collect_list(ranges)).alias("cut")
    )


def without_words(text: str, places: list[int] | None, ranges: list[dict] | None) -> tuple[str, int]:
    """The text without the lines at `places` and the words in `ranges`, and how many lines lost words.

    A word goes with the white space behind it; a line all of whose words go, goes as a whole.
    """
    gone_lines = set(places or ())
    lines = text.split("\n")
    cut = np.zeros(max((r["stop"] for r in ranges or ()), default=0) + 1, dtype=bool)
    for one in ranges or ():
        cut[one["start"] : one["stop"]] = True
    out: list[str] = []
    at = lost = 0
    for number, line in enumerate(lines):
        parts = tokens(line)
        here = cut[at : at + len(parts) - 1]
        at += len(parts) - 1
        if number in gone_lines:
            lost += 1
        elif not here.any():
            out.append(line)
        else:
            lost += 1
            gone = set(np.flatnonzero(here).tolist())
            if len(gone) < len(parts) - 1:
                out.append(parts[0] + "".join(p for n, p in enumerate(parts[1:]) if n not in gone))
    return "\n".join(out), lost


def tokens(line: str) -> list[str]:
    """Leading white space, then each word with the white space behind it."""
    parts = _TOKEN.findall(line)
    lead = line[: len(line) - sum(map(len, parts))]
    return [lead, *parts]
