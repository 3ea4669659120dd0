"""Quality classifier by compression with two dictionaries.

A zstandard dictionary is trained from good and another from bad labelled texts. Of each text
the two compressed sizes are taken; their difference, normalised by the text's size and, as the
logarithm of their quotient, by the compressed sizes, is turned into a probability by a logistic
curve fitted on labelled texts that no dictionary has seen. Nothing but the difference enters
the curve; it bends at zero, as good and bad texts do not spread alike around it.

Training reads at most `per_label` labelled rows of each label, the first by the hash of their
id; scoring reads every text whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm.frames import arrow_map, chunks, pick, remainder, table

PER_LABEL = 6000
TRAINING_CHARS = 20_000
DICTIONARY_BYTES = 1 << 19
LEVEL = 3
THRESHOLD = 0.3
BLOCK = 4 << 20


@dataclass(frozen=True)
class Model:
    """Dictionaries of bad and good texts (empty: none), and the curve's parameters."""

    bad: bytes
    good: bytes
    centre: tuple[float, ...]
    scale: tuple[float, ...]
    slope: tuple[float, ...]
    bias: float


@lru_cache(maxsize=4)
def compressors(bad: bytes, good: bytes) -> list[zstandard.ZstdCompressor]:
    out = []
    for raw in (bad, good):
        known = zstandard.ZstdCompressionDict(raw) if raw else None
        if known:
            known.precompute_compress(level=LEVEL)
        out.append(
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=known, write_content_size=False, write_dict_id=False
            )
        )
    return out


def features(texts: list[str], bad: bytes, good: bytes) -> np.ndarray:
    by_bad, by_good = compressors(bad, good)
    """Of each text the difference of its compressed sizes, normalised in two ways, and its absolute values."""
    sizes = np.empty((len(texts), 3))
    for row, text in enumerate(texts):
        raw = text.encode()
        sizes[row] = len(raw), len(by_bad.compress(raw)), len(by_good.compress(raw))
    n, size_bad, size_good = np.maximum(sizes, 1).T
    by_size, by_quotient = (size_bad - size_good) / n, np.log(size_bad / size_good)
    return np.column_stack((by_size, by_quotient, np.abs(by_size), np.abs(by_quotient)))


def fitted(x: np.ndarray, y: np.ndarray) -> tuple:
    """Logistic regression by Newton steps with a light ridge, halved until the loss falls."""
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack(((x - centre) / scale, np.ones(len(x))))
    w = np.zeros(z.shape[1])
    ridge = np.full(len(w), 1e-2)
    ridge[-1] = 1e-6

    def loss(w: np.ndarray) -> float:
        at = z @ w
        return float((np.logaddexp(0, at) - y * at).sum() + (ridge * w * w).sum() / 2)

    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + ridge * w
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(ridge), gradient)
        part, now = 1.0, loss(w)
        while part > 1e-6 and loss(w - part * step) > now:
            part /= 2
        w = w - part * step
    return tuple(centre), tuple(scale), tuple(w[:-1]), float(w[-1])


def dictionary(texts: list[str]) -> bytes:
    """A trained dictionary; with too little text, none."""
    samples = [raw for raw in (t.encode() for t in texts) if len(raw) >= 8]
    total = sum(map(len, samples))
    size = min(DICTIONARY_BYTES, total // 4)
    if len(samples) < 8 or size < 1024:
        return b""
    try:
        return zstandard.train_dictionary(size, samples, k=200, d=8).as_bytes()
    except zstandard.ZstdError:  # the samples are too much alike
        return b""


def train(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    per_label: int = PER_LABEL,
    max_chars: int = TRAINING_CHARS,
) -> Model:
    """Dictionaries and curve from the labelled rows that `usable` (on doc_id) allows.

    Labels other than 0 and 1, null ids and null texts teach nothing; a text over `max_chars`
    characters teaches by its beginning. The sample is bounded by 2 x `per_label` rows of
    `max_chars` characters: of the rows that share an id the least text is read, a label given
    twice counts once. With one label only, or none, the curve is constant: the share of good
    ones, or 0.5.
    """
    marks = pick(labels, doc_id=id_col, label=label_col).filter("label IN (0, 1) AND doc_id IS NOT NULL")
    if usable is not None:
        marks = marks.filter(usable)
    draw = F.xxhash64(F.col("doc_id").cast("string"))
    marks = marks.select("doc_id", F.col("label").cast("int").alias("label")).distinct()
    first = [
        marks.filter(F.col("label") == q).orderBy(draw, "doc_id").limit(per_label) for q in (0, 1)
    ]
    texts = pick(docs, doc_id=id_col, text=text_col).filter("text IS NOT NULL")
    # The broadcast side has 2 x per_label rows at most.
    rows = (
        texts.withColumn("text", F.substring("text", 1, max_chars))
        .join(F.broadcast(first[0].unionByName(first[1])), "doc_id")
        .groupBy("doc_id", "label").agg(F.min("text").alias("text"))
        .select("text", "label", (F.pmod(draw, F.lit(3)) == 0).alias("held"))
        .collect()
    )
    rows = sorted((r["label"], r["held"], r["text"]) for r in rows)
    bad = dictionary([t for q, held, t in rows if q == 0 and not held])
    good = dictionary([t for q, held, t in rows if q == 1 and not held])
    y = np.array([q for q, held, _ in rows if held], dtype=float)
    if len(set(y)) < 2 or not bad or not good:
        share = float(np.clip(np.mean([q for q, _, _ in rows]), 0.01, 0.99)) if rows else 0.5
        width = features([""], b"", b"").shape[1]
        return Model(bad, good, (0.0,) * width, (1.0,) * width, (0.0,) * width, float(np.log(share / (1 - share))))
    x = features([t for _, held, t in rows if held], bad, good)
    return Model(bad, good, *fitted(x, y))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, score, gap, *keep) for every row; `gap` is the normalised size difference.

    A null text is the empty text, which has the score of its (zero) size. Repeated rows each
    get their result. `keep` names columns to pass through.
    """
    rows = pick(docs, doc_id=id_col, text=text_col, **{f"keep_{k}": k for k in keep})
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    shared = docs.sparkSession.sparkContext.broadcast(model)
    extra = [f"keep_{k}" for k in keep]

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for start, end in chunks(batch, "text", BLOCK):
            part = batch.slice(start, end - start)
            x = features([t or "" for t in part.column("text").to_pylist()], m.bad, m.good)
            z = (x - np.array(m.centre)) / np.array(m.scale)
            p = 1 / (1 + np.exp(-np.clip(z @ np.array(m.slope) + m.bias, -30, 30)))
            yield pa.record_batch(
                [part.column("doc_id"), pa.array(p), pa.array(x[:, 0]), *(part.column(k) for k in extra)],
                names=["doc_id", "score", "gap", *extra],
            )

    more = "".join(f", `{k}` {kinds[k]}" for k in extra)
    out = arrow_map(rows, of, f"doc_id {kinds['doc_id']}, score double, gap double{more}")
    return out.withColumnsRenamed({f"keep_{k}": k for k in keep})


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"), remainder(F.col("doc_id"), 5) != 0)
    return score(docs, model).select(
        "doc_id",
        (remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "gap",
    )
