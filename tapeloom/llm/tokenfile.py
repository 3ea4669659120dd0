"""Token ids as flat binary files with 64-bit document offsets, to be memory-mapped.

A folder holds, per part, `tokens-NNNNN.bin` (unsigned 16-bit ids, 32-bit if the vocabulary
needs it), `offsets-NNNNN.bin` (int64, one more than documents, counted from the part's first
id) and `docs-NNNNN.bin` (int64 document ids), all little-endian, and one `index.json` with
the parts in order and their bases: the prefix sums of their documents and ids. The files
hold the documents in ascending id order over all parts.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm import bpe
from tapeloom.llm.frames import pick, table
from tapeloom.session import work_dir

END_ID = 2
NULL_ID = np.iinfo(np.int64).min



def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """A folder on any file system pyarrow reaches; a plain path is a local or mounted one."""
    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def write(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int | None = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    files: int | None = None,
) -> dict:
    """Encode and write all documents; returns the index, which is also written.

    Documents are sorted by id (null first, kept as the smallest int64), equal ids by text; a
    null text is empty. `end_id` is appended to every document. Each task writes its files
    under names of its own attempt and then renames them, so a lost or repeated task leaves
    one whole set; the bases come from the parts' counts alone, one line per part.
    """
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    order = F.col("doc_id").asc_nulls_first()
    dealt = rows.repartitionByRange(files, order) if files else rows.repartitionByRange(order)
    where, base = opened(folder)
    where.create_dir(base, recursive=True)
    wide = bpe.codec(tokenizer).vocab_size > 1 << 16 or (end_id or 0) >= 1 << 16
    kind = "<u4" if wide else "<u2"

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_file = bpe.codec(tokenizer)
        number = TaskContext.get().partitionId()
        store, root = opened(folder)
        attempt = uuid.uuid4().hex
        names = [f"{kind_}-{number:05d}.bin" for kind_ in ("tokens", "offsets", "docs")]
        at = n_docs = 0
        suffix = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        streams = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if streams is None:
                streams = [store.open_output_stream(f"{root}/_{attempt}-{n}") for n in names]
                streams[1].write(np.zeros(1, "<i8").tobytes())
            ids = np.asarray(pa.compute.fill_null(batch.column("doc_id"), NULL_ID), dtype="<i8")
            texts = batch.column("text")
            for start in range(0, batch.num_rows, 500):
                packed = [with_file.encode(t or "") + suffix for t in texts[start : start + 500].to_pylist()]
                sizes = np.array([len(p) // 4 for p in packed], dtype="<i8")
                streams[0].write(np.frombuffer(b"".join(packed), "<u4").astype(kind).tobytes())
                streams[1].write((at + np.cumsum(sizes)).astype("<i8").tobytes())
                at += int(sizes.sum())
            streams[2].write(ids.tobytes())
            n_docs += batch.num_rows
        if streams is None:
            return
        for stream, name in zip(streams, names):
            stream.close()
            store.move(f"{root}/_{attempt}-{name}", f"{root}/{name}")
        yield pa.RecordBatch.from_pylist([{"part": number, "n_docs": n_docs, "n_tokens": at}])

    # Equal ids in one part sort by text, so that a repeated task writes the same bytes.
    parts = dealt.sortWithinPartitions(order, F.col("text").asc_nulls_first()).mapInArrow(
        part, "part bigint, n_docs bigint, n_tokens bigint"
    )
    counts = sorted((r["part"], r["n_docs"], r["n_tokens"]) for r in parts.collect())
    bases = list(accumulate((c[2] for c in counts), initial=0))
    firsts = list(accumulate((c[1] for c in counts), initial=0))
    index = {
        "dtype": kind,
        "end_id": end_id,
        "n_docs": firsts[-1],
        "n_tokens": bases[-1],
        "parts": [
            {"part": p, "n_docs": d, "n_tokens": t, "doc_base": first, "base": start}
            for (p, d, t), first, start in zip(counts, firsts, bases)
        ],
    }
    with where.open_output_stream(f"{base}/index.json") as out:
        out.write(json.dumps(index).encode())
    return index


def mapped(store: fs.FileSystem, path: str, kind: str) -> np.ndarray:
    """The file as an array: memory-mapped where it is a file here, read otherwise."""
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype=kind, mode="r") if store.get_file_info(path).size else np.empty(0, kind)
    with store.open_input_file(path) as file:
        return np.frombuffer(file.read_buffer(), dtype=kind)


def read(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of each document in the folder's files.

    `start` counts all ids before the document, `ids_crc32` is taken over the ids as unsigned
    32-bit integers, and `ids` holds them. A folder of an empty table has no rows.
    """
    where, base = opened(folder)
    with where.open_input_stream(f"{base}/index.json") as file:
        index = json.loads(file.read())
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    if not index["parts"]:
        return spark.createDataFrame([], schema)
    parts = spark.createDataFrame(
        [(p["part"], p["base"]) for p in index["parts"]], "part bigint, base bigint"
    ).repartition(len(index["parts"]))
    kind = index["dtype"]

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opened(folder)
        for row in (r for batch in batches for r in batch.to_pylist()):
            number, first = row["part"], row["base"]
            tokens = mapped(store, f"{root}/tokens-{number:05d}.bin", kind)
            offsets = mapped(store, f"{root}/offsets-{number:05d}.bin", "<i8")
            ids = mapped(store, f"{root}/docs-{number:05d}.bin", "<i8")
            for start in range(0, len(ids), 500):
                own = ids[start : start + 500]
                edges = offsets[start : start + len(own) + 1].tolist()
                packed = [tokens[a:b].astype("<u4").tobytes() for a, b in zip(edges, edges[1:])]
                columns = [
                    pa.array(own.astype(np.int64), mask=own == NULL_ID),
                    pa.array(first + np.array(edges[:-1], dtype=np.int64)),
                    pa.array(np.diff(np.array(edges, dtype=np.int64))),
                    pa.array([zlib.crc32(p) for p in packed], pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(packed, pa.binary()))
                    names.append("ids")
                yield pa.record_batch(columns, names=names)

    return parts.mapInArrow(documents, schema)


def op10_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "token-files")
    write(table(spark, sf_dir, "documents"), folder, bpe.default_tokenizer())
    return read(spark, folder, with_ids=False)
