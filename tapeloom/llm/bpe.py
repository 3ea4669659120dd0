"""BPE encoding and decoding by tree concatenation.

A text falls into pieces (pre-tokens) that never merge with each other. A piece without any
break that is longer than a leaf is cut into leaves, which are encoded on their own; two
neighbours are joined by re-encoding a window of tokens around the
seam, which doubles until its first token is the left side's and its last token the right
side's. Every neighbouring pair of the result is then a pair of some valid encoding, which
for BPE merges means that the whole is the one encoding of the joined text.

Documents of `long_chars` and more are cut into rows first, so that their parts, and the
leaves of an unbroken run, are encoded by different tasks and joined pairwise in rounds.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import unicodedata
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tapeloom.llm.frames import arrow_map, pick, stored

#: The split pattern of byte-level BPE (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

LEAF = 512
LONG_CHARS = 1 << 20
#: Below this code point all engines agree, from CHARTED on no character is looked at.
FAMILIAR, CHARTED = 0x530, 0x32400
NO_SPECIALS: frozenset[str] = frozenset()


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, extra = [""] * 256, 0
    for byte in range(256):
        if byte in plain:
            table[byte] = chr(byte)
        else:
            table[byte] = chr(256 + extra)
            extra += 1
    return table


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Codec:
    """One tokenizer file of the tokenizers library (byte-level BPE), or any other through it."""

    def __init__(self, path: str, leaf: int = LEAF):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.path, self.leaf = path, leaf
        self.added = {token["content"]: token["id"] for token in spec["added_tokens"]}
        pre, model = spec["pre_tokenizer"] or {}, spec["model"]
        self.vocab_size = len(set(model["vocab"].values()) | set(self.added.values()))
        self.byte_level = (
            spec["normalizer"] is None
            and pre.get("type") == "ByteLevel"
            and not pre.get("add_prefix_space")
            and pre.get("use_regex", True)
            and model["type"] == "BPE"
            and not model.get("dropout")
            and not any(
                token["lstrip"] or token["rstrip"] or token["single_word"] or token["normalized"]
                for token in spec["added_tokens"]
            )
        )
        self._foreign: re.Pattern | None = None
        if not self.byte_level:
            return
        self.symbols = byte_symbols()
        symbols = {symbol: byte for byte, symbol in enumerate(self.symbols)}
        self.token_bytes = [b""] * (1 + max([*model["vocab"].values(), *self.added.values()]))
        for token, number in model["vocab"].items():
            self.token_bytes[number] = bytes(symbols[symbol] for symbol in token)
        ranks = {self.token_bytes[number]: number for number in model["vocab"].values()}
        self.ranked = ids_follow_merges(model, ranks)
        for token, number in self.added.items():
            self.token_bytes[number] = token.encode()
        self.pieces = regex.compile(PATTERN).findall
        self.split_added = (
            re.compile("|".join(sorted(map(re.escape, self.added), key=len, reverse=True)))
            if self.added
            else None
        )

    # A worker that only decodes needs neither of the two encoders.

    @cached_property
    def library(self) -> Tokenizer:
        made = Tokenizer.from_file(self.path)
        made.no_truncation()
        made.no_padding()
        return made

    @cached_property
    def quick(self) -> tiktoken.Encoding | None:
        if not self.ranked:
            return None
        added = set(self.added.values())
        ranks = {raw: number for number, raw in enumerate(self.token_bytes) if raw and number not in added}
        return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def buffer(self):
        return self.quick._core_bpe.encode_to_tiktoken_buffer

    # Encoding

    def merge(self, raw: bytes) -> list[int]:
        """The BPE encoding of bytes that are one piece."""
        if self.quick:
            return self.quick._encode_single_piece(raw)
        return [t.id for t in self.library.model.tokenize("".join(self.symbols[b] for b in raw))]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two encoded neighbours of one piece."""
        if not left or not right:
            return left or right
        width = 2
        while True:
            head, tail = left[-width:], right[:width]
            window = self.merge(b"".join(self.token_bytes[i] for i in [*head, *tail]))
            left_agrees = len(head) == len(left) or window[0] == head[0]
            right_agrees = len(tail) == len(right) or window[-1] == tail[-1]
            if left_agrees and right_agrees:
                return [*left[: len(left) - len(head)], *window, *right[len(tail) :]]
            width *= 2

    def tree(self, raw: bytes) -> list[int]:
        """Leaves are encoded on their own; neighbours are joined pairwise, level by level."""
        level = [self.merge(raw[at : at + self.leaf]) for at in range(0, len(raw), self.leaf)]
        while len(level) > 1:
            joined = [self.join(*level[at : at + 2]) for at in range(0, len(level) - 1, 2)]
            level = joined + level[len(joined) * 2 :]
        return level[0] if level else []

    def piece(self, text: str) -> list[int]:
        raw = text.encode()
        return self.merge(raw) if len(raw) <= self.leaf else self.tree(raw)

    def foreign(self) -> re.Pattern:
        """Characters that the library's tables of letters and numbers may see differently.

        The library knows an older Unicode than the pattern's engines; texts with a character
        that it classes otherwise, or that is not yet assigned here, are left to the library.
        """
        if self._foreign is None:
            out = [chr(p) for p in range(0xD800, 0xE000)]
            for start in range(FAMILIAR, CHARTED, 4096):
                points = [p for p in range(start, min(start + 4096, CHARTED)) if not 0xD800 <= p < 0xE000]
                text = "".join(f"a{chr(p)}x1{chr(p)}x.{chr(p)}x" for p in points)
                begins = np.zeros(len(text) + 1, dtype=bool)
                begins[[span[0] for _, span in self.library.pre_tokenizer.pre_tokenize_str(text)]] = True
                ours = np.zeros(len(text) + 1, dtype=bool)
                ours[np.cumsum([0, *map(len, self.pieces(text))])] = True
                odd = (begins[:-1] != ours[:-1]).reshape(-1, 9).any(axis=1)
                out += [chr(p) for p, o in zip(points, odd) if o or unicodedata.category(chr(p)) == "Cn"]
            self._foreign = re.compile("[" + "".join(map(re.escape, out)) + chr(CHARTED) + "-\U0010ffff]")
        return self._foreign

    def ordinary(self, text: str) -> bytes:
        """Packed ids of a text without added tokens."""
        if max(text) >= chr(FAMILIAR) and self.foreign().search(text):
            return pack(self.library.encode(text, add_special_tokens=False).ids)
        if self.quick and not unbroken(text, self.leaf):
            return bytes(self.buffer(text, NO_SPECIALS))
        return pack([i for piece in self.pieces(text) for i in self.piece(piece)])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if not self.byte_level:
            return pack(self.library.encode(text, add_special_tokens=False).ids)
        if self.split_added is None or not any(token in text for token in self.added):
            return self.ordinary(text)
        out, at = [], 0
        for found in self.split_added.finditer(text):
            if found.start() > at:
                out.append(self.ordinary(text[at : found.start()]))
            out.append(pack([self.added[found.group()]]))
            at = found.end()
        if at < len(text):
            out.append(self.ordinary(text[at:]))
        return b"".join(out)

    # Decoding

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, dtype="<u4").tolist()
        if not self.byte_level:
            return self.library.decode(ids, skip_special_tokens=False)
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")

    # Rows of one long document

    def rows(self, text: str, size: int) -> Iterator[tuple[int, int, bytes, str]]:
        """(seq, leaf, bytes, text): stretches of whole pieces, and leaves of a long piece.

        A stretch ends before a blank that stands between two non-blanks, or, inside an
        unbroken run, at a border between pre-tokens.
        """
        if max(text) >= chr(FAMILIAR) and self.foreign().search(text):
            yield 0, -1, b"", text
            return
        seq, parts = 0, [text]
        if self.split_added is not None and any(token in text for token in self.added):
            parts = re.split(f"({self.split_added.pattern})", text)
        for part in parts:
            if len(part) <= size or part in self.added:
                if part:
                    yield seq, -1, b"", part
                    seq += 1
                continue
            for piece in gathered(self.pieces(part), size):
                if len(piece) > size and len(self.pieces(piece)) == 1:
                    raw = piece.encode()
                    for leaf, at in enumerate(range(0, len(raw), size)):
                        yield seq, leaf, raw[at : at + size], ""
                else:
                    yield seq, -2, b"", piece
                seq += 1


def unbroken(text: str, limit: int) -> bool:
    """Whether more than `limit` bytes follow each other without a blank."""
    if len(text) * 4 <= limit:
        return False
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    blanks = np.concatenate(([-1], np.flatnonzero(raw == 32), [len(raw)]))
    return bool(np.diff(blanks).max() > limit)


def gathered(pieces: list[str], size: int) -> Iterator[str]:
    """Pieces put together up to `size`, cut only where the right part splits the same alone."""
    held: list[str] = []
    total = 0
    for at, piece in enumerate(pieces):
        alone = len(piece) > size
        before = pieces[at - 1] if at else ""
        safe = before and not before[-1].isspace()
        if held and alone and not safe:
            # Blanks before a long piece split differently once they stand at an end.
            ends = len(held)
            while ends and held[ends - 1].isspace():
                ends -= 1
            if ends:
                yield "".join(held[:ends])
            yield from held[ends:]
            held, total = [], 0
        elif held and (alone or (total + len(piece) > size and safe)):
            yield "".join(held)
            held, total = [], 0
        if alone:
            yield piece
            continue
        held.append(piece)
        total += len(piece)
    if held:
        yield "".join(held)


def ids_follow_merges(model: dict, ranks: dict[bytes, int]) -> bool:
    """Whether merging by the ids of results is merging by the order of the merges."""
    symbols = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
    last = -1
    for merge in model["merges"]:
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        number = ranks.get(bytes(symbols[s] for s in left + right), -1)
        if number <= last:
            return False
        last = number
    merged = len(model["merges"]) + 256
    return sys.byteorder == "little" and len(ranks) == merged and not model.get("ignore_merges")


@lru_cache(maxsize=4)
def codec(path: str, leaf: int = LEAF) -> Codec:
    return Codec(path, leaf)


def encode(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    long_chars: int = LONG_CHARS,
    leaf: int = LEAF,
) -> DataFrame:
    """(doc_id, ids, n_tokens): ids as little-endian unsigned 32-bit integers, one row per row.

    A null text is the empty text and has no ids; special tokens in a text become their id, as
    the library does; none are added. Rows that repeat, also with the same id, each get their
    result; a null id stays null. `tokenizer` is a path that all executors can read.
    """
    rows = pick(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    short = rows.filter(F.col("text").isNull() | (F.length("text") < long_chars))
    rest = rows.filter(F.length("text") >= long_chars)

    def whole(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        with_file = codec(tokenizer, leaf)
        ids, texts = batch.column("doc_id"), batch.column("text")
        for at in range(0, batch.num_rows, 500):
            part = [t or "" for t in texts[at : at + 500].to_pylist()]
            out = [with_file.encode(t) for t in part]
            yield pa.record_batch(
                [
                    ids[at : at + 500],
                    pa.array(out, pa.binary()),
                    pa.array([len(o) // 4 for o in out], pa.int64()),
                ],
                names=["doc_id", "ids", "n_tokens"],
            )

    schema = f"doc_id {kind}, ids binary, n_tokens bigint"
    return arrow_map(short, whole, schema).unionByName(
        encode_long(rest, tokenizer, schema, max(long_chars // 16, 16), leaf)
    )


def encode_long(
    rows: DataFrame, tokenizer: str, schema: str, size: int, leaf: int
) -> DataFrame:
    """Long documents: parts as rows, leaves of unbroken runs joined in rounds of pairs."""
    longest = rows.agg(F.max(F.octet_length("text"))).first()[0]
    if longest is None:
        return rows.sparkSession.createDataFrame([], schema)
    kind = schema.split(",")[0].removeprefix("doc_id ")

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        with_file = codec(tokenizer, leaf)
        for key, number, text in zip(*(batch.column(c).to_pylist() for c in ("key", "doc_id", "text"))):
            for seq, at, raw, part in with_file.rows(text, size):
                yield pa.RecordBatch.from_pylist(
                    [{"key": key, "doc_id": number, "seq": seq, "leaf": at, "raw": raw, "part": part}],
                    schema=pa.schema(
                        [("key", pa.int64()), ("doc_id", batch.schema.field("doc_id").type),
                         ("seq", pa.int64()), ("leaf", pa.int64()), ("raw", pa.binary()),
                         ("part", pa.string())]
                    ),
                )

    def leaves(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        with_file = codec(tokenizer, leaf)
        out = []
        for at, raw, part in zip(*(batch.column(c).to_pylist() for c in ("leaf", "raw", "part"))):
            if at >= 0:
                out.append(pack(with_file.tree(raw)))
            elif at == -1:
                out.append(with_file.encode(part))
            else:
                out.append(with_file.ordinary(part))
        yield pa.record_batch(
            [*(batch.column(c) for c in ("key", "doc_id", "seq")),
             pa.compute.max_element_wise(batch.column("leaf"), 0), pa.array(out, pa.binary())],
            names=["key", "doc_id", "seq", "leaf", "ids"],
        )

    def pair(group: pa.Table) -> pa.Table:
        with_file = codec(tokenizer, leaf)
        sides = [np.frombuffer(r["ids"], "<u4").tolist()
                 for r in sorted(group.to_pylist(), key=lambda r: r["leaf"])]
        ids = sides[0] if len(sides) == 1 else with_file.join(sides[0], sides[1])
        first = group.slice(0, 1)
        return first.set_column(3, "leaf", pa.compute.divide(first.column("leaf"), 2)).set_column(
            4, "ids", pa.array([pack(ids)], pa.binary())
        )

    # The key tells apart rows that share an id; it is fixed before anything is cut.
    keyed = stored(rows.withColumn("key", F.monotonically_increasing_id()), "bpe-long")
    part = f"key bigint, doc_id {kind}, seq bigint, leaf bigint"
    parts = arrow_map(keyed, cut, f"{part}, raw binary, part string")
    encoded = arrow_map(parts.repartition("key", "seq", "leaf"), leaves, f"{part}, ids binary")
    encoded = stored(encoded, "bpe-leaves")
    for _ in range(max(0, (-(-longest // size) - 1).bit_length())):
        encoded = (
            encoded.groupBy("key", "doc_id", "seq", F.floor(F.col("leaf") / 2).alias("half"))
            .applyInArrow(pair, f"{part}, ids binary")
        )
        encoded = stored(encoded, "bpe-round")
    whole = encoded.groupBy("key", "doc_id").agg(
        F.array_sort(F.collect_list(F.struct("seq", "ids"))).alias("parts")
    )
    ids = F.expr("unhex(array_join(transform(parts, p -> hex(p.ids)), ''))")
    return whole.select("doc_id", ids.alias("ids")).withColumn(
        "n_tokens", (F.octet_length("ids") / 4).cast("bigint")
    )


def decode(
    encoded: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids", keep: tuple[str, ...] = ()
) -> DataFrame:
    """(doc_id, text, *keep) from packed ids; null ids are no ids, and give the empty text."""
    names = {"doc_id": id_col, "ids": ids_col} | {name: name for name in keep}
    rows = pick(encoded, **names)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def whole(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        with_file = codec(tokenizer)
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            texts = [with_file.decode(ids or b"") for ids in part.column("ids").to_pylist()]
            yield pa.record_batch(
                [part.column("doc_id"), pa.array(texts, pa.string()), *(part.column(k) for k in keep)],
                names=["doc_id", "text", *keep],
            )

    more = "".join(f", `{name}` {kinds[name]}" for name in keep)
    return arrow_map(rows, whole, f"doc_id {kinds['doc_id']}, text string{more}")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_bpe(spark, sf_dir: str) -> DataFrame:
    from tapeloom.llm.frames import table

    path = default_tokenizer()
    encoded = encode(table(spark, sf_dir, "documents"), path).withColumn(
        "ids_sha256", F.sha2("ids", 256)
    )
    decoded = decode(encoded, path, keep=("n_tokens", "ids_sha256"))
    return decoded.select(
        "doc_id",
        "n_tokens",
        "ids_sha256",
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
