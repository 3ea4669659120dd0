"""Language identification with interpolated Kneser-Ney character models.

One model per language; all models share sorted arrays of n-gram hashes, one array per order,
with a column per language for the discounted probability and the back-off weight. A text is
given to the language with the lowest cross-entropy per character. Its score is the softmax
of the negative cross-entropies at a temperature fitted on rows kept out of the counts, and
`accepted` tells whether its cross-entropy is within what those rows show for its length.

Training reads at most `per_language` rows of each language, chosen by hash; scoring reads
every text whole.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm.frames import arrow_map, chunks, pick, remainder, table

UNKNOWN = "und"
ORDER = 4
DISCOUNT = 0.75
PER_LANGUAGE = 1500
TRAINING_CHARS = 20_000
REJECT_SHARE = 0.001
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Texts of one numpy call; long ones are cut with an overlap of the model's order.
BLOCK = 1 << 20


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Code point -> lower-case code point of letters (and marks), blank for all else."""
    out = np.full(0x110000, 32, dtype=np.uint32)
    for point in range(0x110000):
        if not 0xD800 <= point < 0xE000 and unicodedata.category(chr(point))[0] in "LM":
            out[point] = ord(chr(point).lower()[0])
    return out


def symbols(text: str) -> np.ndarray:
    """Lower-case letters with single blanks between and around the words."""
    points = letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    blank = points == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    out = points[keep]
    if not len(out) or (out == 32).all():
        return np.empty(0, dtype=np.uint32)
    return np.concatenate(([32], out[int(out[0] == 32) :], [32] * int(out[-1] != 32))).astype(np.uint32)


def grams(points: np.ndarray, order: int) -> np.ndarray:
    """Hash of the `order` symbols that end at each position from `order` - 1 on."""
    n = len(points) - order + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    for at in range(order):
        out = (out + points[at : at + n].astype(np.uint64) + np.uint64(1)) * MIX
        out ^= out >> np.uint64(29)
    return out


@dataclass
class Model:
    """Sorted hashes per order; `gram[k]` and `weight[k]` have one column per language."""

    languages: list[str]
    order: int
    hashes: list[np.ndarray]
    gram: list[np.ndarray]
    contexts: list[np.ndarray]
    weight: list[np.ndarray]
    uniform: np.ndarray
    temperature: float
    limits: np.ndarray
    edges: np.ndarray

    def log2(self, windows: np.ndarray) -> np.ndarray:
        """log2 p(last symbol | the ones before) of each row of `order` symbols, by language."""
        p = np.broadcast_to(self.uniform, (len(windows), len(self.languages)))
        for k in range(1, self.order + 1):
            tail = windows[:, self.order - k :]
            if k == 1:
                weight = self.weight[0][np.zeros(len(windows), dtype=np.int64)]
            else:
                weight = looked_up(self.contexts[k - 1], self.weight[k - 1], hashed(tail[:, :-1]), 1.0)
            p = looked_up(self.hashes[k - 1], self.gram[k - 1], hashed(tail), 0.0) + weight * p
        return np.log2(p)

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character by language, and the number of characters scored."""
        total = np.zeros((len(texts), len(self.languages)))
        sizes = np.zeros(len(texts), dtype=np.int64)
        held: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        room = 0

        def flush() -> None:
            nonlocal room
            if not held:
                return
            windows = np.concatenate(held)
            codes = hashed(windows)
            _, first, inverse = np.unique(codes, return_index=True, return_inverse=True)
            bits = self.log2(windows[first])
            owner = np.concatenate(owners)
            for language in range(len(self.languages)):
                total[:, language] -= np.bincount(
                    owner, bits[inverse, language], minlength=len(texts)
                )
            held.clear()
            owners.clear()
            room = 0

        for row, text in enumerate(texts):
            points = symbols(text)
            if not len(points):
                continue
            points = np.concatenate((np.full(self.order - 1, 32, dtype=np.uint32), points[1:]))
            sizes[row] = len(points) - self.order + 1
            windows = np.lib.stride_tricks.sliding_window_view(points, self.order)
            for at in range(0, len(windows), BLOCK):
                part = windows[at : at + BLOCK]
                held.append(part)
                owners.append(np.full(len(part), row, dtype=np.int64))
                room += len(part)
                if room >= BLOCK:
                    flush()
        flush()
        return total / np.maximum(sizes, 1)[:, None], sizes


def hashed(windows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(windows), dtype=np.uint64)
    for at in range(windows.shape[1]):
        out = (out + windows[:, at].astype(np.uint64) + np.uint64(1)) * MIX
        out ^= out >> np.uint64(29)
    return out


def looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    """Rows of `values` at the wanted hashes of a sorted array."""
    if not len(keys):
        return np.full((len(wanted), values.shape[1]), default)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where((keys[at] == wanted)[:, None], values[at], default)


def counted(texts: DataFrame, order: int) -> DataFrame:
    """(lang, gram, n): how often each window of `order` symbols occurs, summed by Spark."""

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        langs = np.asarray(batch.column("lang").to_pylist(), dtype=object)
        texts = batch.column("text").to_pylist()
        for lang in sorted(set(langs)):
            parts = []
            for text in (t for t, own in zip(texts, langs) if own == lang):
                points = symbols(text)
                if len(points):
                    points = np.concatenate((np.full(order - 1, 32, dtype=np.uint32), points[1:]))
                    parts.append(np.lib.stride_tricks.sliding_window_view(points, order))
            if not parts:
                continue
            windows, n = np.unique(np.concatenate(parts), axis=0, return_counts=True)
            raw = np.ascontiguousarray(windows.astype("<u4"))
            yield pa.record_batch(
                [pa.array([lang] * len(n)),
                 pa.array([row.tobytes() for row in raw], pa.binary()), pa.array(n, pa.int64())],
                names=["lang", "gram", "n"],
            )

    return (
        arrow_map(texts, count, "lang string, gram binary, n bigint")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )


def smoothed(counts: list[tuple[str, np.ndarray, np.ndarray]], order: int) -> Model:
    """Interpolated Kneser-Ney from windows of the highest order: lower orders count contexts."""
    languages = [lang for lang, _, _ in counts]
    gram_parts: list[list] = [[] for _ in range(order)]
    context_parts: list[list] = [[] for _ in range(order)]
    uniform = np.zeros(len(languages))
    for column, (_, windows, n) in enumerate(counts):
        windows, n = windows.astype(np.uint32), n.astype(np.float64)
        uniform[column] = 1.0 / (len(np.unique(windows[:, -1])) + 1)
        for k in range(order, 0, -1):
            if k < order:
                # A shorter gram counts the different symbols seen before it.
                windows = np.unique(windows, axis=0)[:, 1:]
                windows, n = np.unique(windows, axis=0, return_counts=True)
                n = n.astype(np.float64)
            contexts, own = np.unique(windows[:, :-1], axis=0, return_inverse=True)
            own = own.reshape(-1)
            total = np.bincount(own, n, minlength=len(contexts))
            kinds = np.bincount(own, minlength=len(contexts))
            gram_parts[k - 1].append((column, hashed(windows), (n - np.minimum(n, DISCOUNT)) / total[own]))
            context_parts[k - 1].append((column, hashed(contexts), DISCOUNT * kinds / total))
    hashes, gram = merged(gram_parts, len(languages), 0.0)
    contexts, weight = merged(context_parts, len(languages), 1.0)
    return Model(languages, order, hashes, gram, contexts, weight, uniform, 0.1,
                 np.full((1, len(languages)), np.inf), np.empty(0))


def merged(parts: list[list], width: int, default: float) -> tuple[list, list]:
    keys_by_order, values_by_order = [], []
    for order in parts:
        keys = np.unique(np.concatenate([h for _, h, _ in order]))
        values = np.full((len(keys), width), default)
        for column, hashes, value in order:
            values[np.searchsorted(keys, hashes), column] = value
        keys_by_order.append(keys)
        values_by_order.append(values)
    return keys_by_order, values_by_order


def calibrated(model: Model, texts: list[str], langs: list[str]) -> Model:
    """Temperature by likelihood, and the highest usual cross-entropy by length and language."""
    known = [(t, model.languages.index(g)) for t, g in zip(texts, langs) if g in model.languages]
    if not known:
        return model
    own = np.array([g for _, g in known])
    entropy, sizes = model.entropies([t for t, _ in known])
    usable = sizes > 0
    entropy, sizes, own = entropy[usable], sizes[usable], own[usable]
    if not len(own):
        return model
    best = (np.inf, model.temperature)
    for temperature in np.geomspace(0.01, 2, 24):
        p = softmax(-entropy / temperature)[np.arange(len(own)), own]
        best = min(best, (-np.log(np.maximum(p, 1e-9)).mean(), temperature))
    model.temperature = float(best[1])
    model.edges = np.array([20, 100, 1000])
    bucket = np.searchsorted(model.edges, sizes)
    model.limits = np.full((len(model.edges) + 1, len(model.languages)), np.inf)
    mine = entropy[np.arange(len(own)), own]
    right = entropy.argmin(axis=1) == own
    # A length or language with few rows takes the limit of its length, or of all rows.
    for b in range(len(model.edges) + 1):
        for g in range(len(model.languages)):
            for rows in ((bucket == b) & (own == g), bucket == b, bucket >= 0):
                seen = mine[rows & right]
                if len(seen) >= 20:
                    model.limits[b, g] = np.quantile(seen, 1 - REJECT_SHARE) + seen.std()
                    break
    return model


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(
    docs: DataFrame,
    usable: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    order: int = ORDER,
    per_language: int = PER_LANGUAGE,
    max_chars: int = TRAINING_CHARS,
) -> Model | None:
    """The models of the languages named in `lang_col`; None if there is no labelled text.

    Of each language, about `per_language` rows are read, by the hash of their id (all, if there
    are fewer), of a longer text the first `max_chars` characters; a quarter of them calibrates.
    What comes to the driver is bounded by these two parameters and the number of languages.
    """
    rows = pick(docs, doc_id=id_col, text=text_col, lang=lang_col)
    if usable is not None:
        rows = rows.filter(usable)
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    share = F.create_map(*[F.lit(v) for g, n in sizes.items() for v in (g, min(1.0, per_language / n))])
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "text"), F.lit(1_000_003)) / 1_000_003
    read = F.substring("text", 1, max_chars).alias("text")
    sample = rows.select("lang", read, draw.alias("draw"), F.element_at(share, F.col("lang")).alias("share"))
    sample = sample.filter("draw < share")
    fit = sample.filter("draw < share * 0.75").select("lang", "text")
    grouped: dict[str, list] = {}
    for row in counted(fit, order).toLocalIterator():
        grouped.setdefault(row["lang"], []).append((bytes(row["gram"]), row["n"]))
    if not grouped:
        return None
    counts = []
    for lang in sorted(grouped):
        pairs = sorted(grouped[lang])
        windows = np.frombuffer(b"".join(g for g, _ in pairs), dtype="<u4").reshape(-1, order)
        counts.append((lang, windows, np.array([n for _, n in pairs])))
    model = smoothed(counts, order)
    held = sample.filter("draw >= share * 0.75").select("lang", "text").collect()
    return calibrated(model, [r["text"] for r in held], [r["lang"] for r in held])


def identify(
    docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, lang_pred, score, bits, accepted) for every row.

    A null text, a text without letters, or a missing model gives `und`, score 0, no bits and
    not accepted; repeated rows each get their result, ties go to the first language by name.
    The model is as large as its training sample allows and is broadcast.
    """
    rows = pick(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for start, end in chunks(batch, "text", BLOCK):
            texts = [t or "" for t in batch.column("text")[start:end].to_pylist()]
            if own is None:
                sizes, entropy = np.zeros(len(texts), dtype=np.int64), np.zeros((len(texts), 1))
            else:
                entropy, sizes = own.entropies(texts)
            some = sizes > 0
            best = entropy.argmin(axis=1)
            low = entropy[np.arange(len(best)), best]
            names = [own.languages[b] if s else UNKNOWN for b, s in zip(best, some)]
            if own is None:
                probability, inside = np.zeros(len(texts)), some
            else:
                probability = softmax(-entropy / own.temperature).max(axis=1)
                inside = low <= own.limits[np.searchsorted(own.edges, sizes), best]
            yield pa.record_batch(
                [batch.column("doc_id")[start:end], pa.array(names, pa.string()),
                 pa.array(np.where(some, probability, 0.0)),
                 pa.array(low, mask=~some), pa.array(some & inside)],
                names=["doc_id", "lang_pred", "score", "bits", "accepted"],
            )

    return arrow_map(
        rows, score, f"doc_id {kind}, lang_pred string, score double, bits double, accepted boolean"
    )


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, remainder(F.col("doc_id"), 3) != 1)
    return identify(docs, model).select(
        "doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"),
        "lang_pred", "score", "bits", "accepted",
    )
