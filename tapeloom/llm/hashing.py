"""Hashes of words, shingles and sets for many texts at once, in numpy.

A word is a longest run of bytes other than ASCII white space. A shingle is `size` words in a
row; a text with fewer words, but at least one, has all its words as its only shingle.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

BASE = np.uint64(0x9FB21C651E98DF25)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: Bytes per numpy call; a longer text is cut between words.
BLOCK = 1 << 20
SPACES = np.zeros(256, dtype=bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64's finisher: all bits of the result depend on all bits of x."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def byte_values() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2**64; kept up to a block."""
    if len(_powers[0]) < n:
        size = max(n, BLOCK + 4096)
        grown = []
        for base in (BASE, INVERSE):
            factors = np.full(size, base, dtype=np.uint64)
            factors[0] = 1
            grown.append(np.multiply.accumulate(factors))
        if size > 4 * BLOCK:
            return grown[0][:n], grown[1][:n]
        _powers[:] = grown
    return _powers[0][:n], _powers[1][:n]


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    """S with hash(raw[a:b]) = mixed((S[b] - S[a]) * inverse power a)."""
    power, _ = powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(byte_values()[raw] * power[: len(raw)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, inverse = powers(len(sums))
    return mixed((sums[ends] - sums[starts]) * inverse[starts])


def words(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in order, and how many each text has."""
    hashes: list[np.ndarray] = []
    counts = np.zeros(len(raws), dtype=np.int64)
    held: list[bytes] = []
    owners: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if not held:
            return
        raw = np.frombuffer(b"\n".join(held) + b"\n", dtype=np.uint8)
        space = SPACES[raw]
        change = np.flatnonzero(space[1:] != space[:-1]) + 1
        if not space[0]:
            change = np.concatenate(([0], change))
        starts, ends = change[0::2], change[1::2]
        hashes.append(span_hashes(prefix_sums(raw), starts, ends))
        edges = np.cumsum([len(part) + 1 for part in held])
        per_part = np.diff(np.searchsorted(starts, edges), prepend=0)
        np.add.at(counts, owners, per_part)
        held.clear()
        owners.clear()
        size = 0

    for row, raw in enumerate(raws):
        for part in cut(raw):
            if size + len(part) > BLOCK:
                flush()
            held.append(part)
            owners.append(row)
            size += len(part) + 1
    flush()
    return (np.concatenate(hashes) if hashes else np.empty(0, np.uint64)), counts


def cut(raw: bytes) -> list[bytes]:
    """A long text in parts of about a block, cut at white space."""
    if len(raw) <= BLOCK:
        return [raw]
    parts, at = [], 0
    while at < len(raw):
        end = at + BLOCK
        while end < len(raw):
            near = np.flatnonzero(SPACES[np.frombuffer(raw, np.uint8, min(4096, len(raw) - end), end)])
            if len(near):
                end += int(near[0])
                break
            end += 4096
        parts.append(raw[at:end])
        at = end
    return parts


def shingles(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts in order, and how many each text has."""
    n_out = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.repeat(np.cumsum(counts) - counts, n_out)
    nth = np.arange(int(n_out.sum())) - np.repeat(np.cumsum(n_out) - n_out, n_out)
    at = first + nth
    left = np.repeat(np.minimum(counts, size), n_out)
    out = np.zeros(len(at), dtype=np.uint64)
    for k in range(size):
        here = k < left
        word = hashes[np.minimum(at + k, max(len(hashes) - 1, 0))] if len(hashes) else out
        out = np.where(here, mixed(out * BASE + word + np.uint64(k + 1)), out)
    return out, n_out


def unique_sets(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's different hashes in ascending order, and how many there are."""
    owner = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    keep = np.ones(len(hashes), dtype=bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[keep], np.bincount(owner[keep], minlength=len(counts))


def set_ids(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One 64-bit id per set (of ascending hashes); 0 for the empty set."""
    ids = np.zeros(len(counts), dtype=np.uint64)
    some = counts > 0
    if some.any():
        starts = (np.cumsum(counts) - counts)[some]
        sums = np.add.reduceat(mixed(hashes * BASE + np.uint64(7)), starts)
        turned = np.add.reduceat(mixed(hashes ^ BASE) * np.uint64(3), starts)
        ids[some] = mixed(sums ^ mixed(turned + counts[some].astype(np.uint64)))
    return ids.view(np.int64)


def minhashes(hashes: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """(texts, k) unsigned 32-bit MinHash values; the largest value for the empty set."""
    out = np.full((len(counts), k), np.iinfo(np.uint32).max, dtype=np.uint32)
    some = counts > 0
    if not some.any():
        return out
    starts = (np.cumsum(counts) - counts)[some]
    factors = mixed(np.arange(1, k + 1, dtype=np.uint64) * BASE) | np.uint64(1)
    offsets = mixed(np.arange(1, k + 1, dtype=np.uint64) * INVERSE)
    for at in range(k):
        value = ((hashes * factors[at] + offsets[at]) >> np.uint64(32)).astype(np.uint32)
        out[some, at] = np.minimum.reduceat(value, starts)
    return out


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """(texts, bands) hash of each band's `rows` values and its number."""
    bands = signatures.shape[1] // rows
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * INVERSE, (len(signatures), bands))
    for at in range(rows):
        out = mixed(out * BASE + signatures[:, at : bands * rows : rows].astype(np.uint64))
    return out.view(np.int64)
