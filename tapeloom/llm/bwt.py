"""Burrows-Wheeler transforms of shards of strings, merged by interleave refinement.

Each string ends in a sentinel that is smaller than all bytes and differs from every other
one. A shard's transform is built alone. Two are merged without sorting their suffixes again:
the interleave, which says of every merged place which shard its suffix comes from, starts as
all of one shard before all of the other, and each round deals its places stably by the bytes
before the suffix, `step` at a time (one would do; eight take an eighth of the rounds). After
h rounds the order is right for the first h steps; a border that appears in the next round
between two places tells their common prefix. Places without a border at `depth` bytes are
repeated intervals: suffixes that share that many bytes.
"""

from __future__ import annotations

import numpy as np


def joined(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All strings with their sentinels (0; bytes are one up), and the place of each sentinel."""
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    # No byte of UTF-8 is 255, so that one up still fits.
    raw = np.frombuffer(b"\0".join([*strings, b""]), dtype=np.uint8) + np.uint8(1)
    ends = np.cumsum(sizes + 1) - 1
    raw[ends] = 0
    return raw, ends


def suffixes(raw: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes in order of their first `depth` bytes and more, by doubling."""
    n = len(raw)
    rank = raw.astype(np.int64) + len(ends)
    rank[ends] = np.arange(len(ends))  # sentinels differ, in the order of their strings
    done = 1
    while True:
        next_rank = np.full(n, -1, dtype=np.int64)
        next_rank[: max(n - done, 0)] = rank[done:]
        both = rank * (int(rank.max()) + 2) + next_rank + 1
        order = np.argsort(both, kind="stable")
        ordered = both[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        done *= 2
        if done >= depth or rank[order[-1]] == n - 1:
            return order


def transform(strings: list[bytes], depth: int, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per suffix, in order: the `step` bytes before it as a number, the string whose sentinel
    is among them (-1: none), and where the suffix starts."""
    raw, ends = joined(strings)
    order = suffixes(raw, ends, depth)
    packed = np.zeros(len(raw), dtype=np.uint64)
    crossed = np.full(len(raw), -1, dtype=np.int64)
    for back in range(step, 0, -1):
        symbol = raw[(order - back) % len(raw)]
        # Nothing counts after a sentinel: it is the last symbol of its suffix.
        live = crossed < 0
        packed = packed * np.uint64(256) + np.where(live, symbol, 0).astype(np.uint64)
        met = live & (symbol == 0)
        crossed[met] = np.searchsorted(ends, (order[met] - back) % len(raw))
    return packed, crossed, order


def codes(left: tuple, right: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of the bytes before the suffixes; each that holds a sentinel has a rank of its own."""
    packed = np.concatenate((left[0], right[0]))
    crossed = np.concatenate((left[1], right[1]))
    side = np.zeros(len(packed), dtype=np.int8)
    side[len(left[0]) :] = 1
    order = np.lexsort((crossed, np.where(crossed < 0, 0, side), packed))
    fresh = np.ones(len(order), dtype=bool)
    ordered, own = packed[order], crossed[order]
    fresh[1:] = (ordered[1:] != ordered[:-1]) | (own[1:] >= 0)
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.cumsum(fresh) - 1
    rank = rank.astype(np.uint16 if fresh.sum() <= 1 << 16 else np.int32)
    return rank[: len(left[0])], rank[len(left[0]) :]


def merge(left: np.ndarray, right: np.ndarray, depth: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """(interleave, common) of two transforms, by the codes of the bytes before their suffixes.

    interleave: False where the left shard's next suffix stands, True for the right one's.
    common: the bytes shared with the place before, rounded down to `step`, `depth` at most.
    """
    n = len(left) + len(right)
    interleave = np.zeros(n, dtype=bool)
    interleave[len(left) :] = True
    common = np.full(n, depth, dtype=np.int64)
    common[0] = 0
    group = np.zeros(n, dtype=np.int32)
    before = np.empty(n, dtype=left.dtype)
    for done in range(0, depth, step):
        before[~interleave] = left
        before[interleave] = right
        order = np.argsort(before, kind="stable")
        symbol, group = before[order], group[order]
        border = np.empty(n, dtype=bool)
        border[0] = True
        border[1:] = (symbol[1:] != symbol[:-1]) | (group[1:] != group[:-1])
        interleave = interleave[order]
        common[border & (common == depth)] = done
        group = np.cumsum(border, dtype=np.int32)
        if group[-1] == n:
            break
    return interleave, common


def repeated(left: list[bytes], right: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(string, offset) of the suffixes that share `depth` bytes with another one.

    `left` and `right` are the strings of two shards; strings are numbered as they were dealt,
    left[0], right[0], left[1], ...
    """
    if not left and not right:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if not left or not right:
        # One shard alone: merge its halves.
        strings = left or right
        if len(strings) < 2:
            strings = [*strings, b""]
        string, offset = repeated(strings[0::2], strings[1::2], depth)
        return string * 2 + (0 if left else 1), offset
    step = next(k for k in (8, 4, 2, 1) if depth % k == 0)
    sides = [transform(left, depth, step), transform(right, depth, step)]
    interleave, common = merge(*codes(*sides), depth, step)
    start = np.empty(len(interleave), dtype=np.int64)
    start[~interleave], start[interleave] = sides[0][2], sides[1][2]
    together = common >= depth
    together[:-1] |= together[1:]
    string = np.empty(len(start), dtype=np.int64)
    offset = np.empty(len(start), dtype=np.int64)
    for side, (strings, mask) in enumerate(((left, ~interleave), (right, interleave))):
        ends = np.cumsum([len(s) + 1 for s in strings])
        own = np.searchsorted(ends, start[mask], side="right")
        string[mask] = own * 2 + side
        offset[mask] = start[mask] - (ends - np.diff(ends, prepend=0))[own]
    return string[together], offset[together]
