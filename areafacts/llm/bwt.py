"""Burrows-Wheeler transforms of string collections, and their merge by refining an interleave; numpy only.

Strings are closed by two end symbols and read in circles; a transform has, for every rotation in sorted order, the two
symbols before it. Two transforms need no sorting to be merged: the interleave (which collection each rotation of the
merged order comes from) is refined from the order by 2 k symbols to that by 2 k + 2, by dealing its entries stably by
the two symbols before them. Where neighbours part in a round, their common prefix ends there; after the last round,
what has not parted is an interval of equal prefixes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Transform:
    """``before``: the two symbols before each rotation, sorted; ``at``: which character each rotation starts with."""

    before: np.ndarray
    at: np.ndarray


def closed(text: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Strings with two end symbols each (0); for each symbol the start of its string and the string's closed size."""
    size = sizes + 2
    out = np.zeros(int(size.sum()), np.uint8)
    place = np.arange(len(text)) + 2 * np.repeat(np.arange(len(sizes)), sizes)
    out[place] = text
    return out, np.repeat(np.cumsum(size) - size, size), np.repeat(size, size)


def _after(start: np.ndarray, size: np.ndarray, n: int) -> np.ndarray:
    """Place ``n`` symbols on, in circles."""
    if len(size) and abs(n) <= size.min():  # one turn at most, no division
        place = np.arange(n, n + len(start))
        return place - size * (place >= start + size) if n >= 0 else place + size * (place < start)
    return start + (np.arange(len(start)) - start + n) % size


def transform(text: np.ndarray, sizes: np.ndarray, depth: int) -> Transform:
    """Of strings (concatenated bytes and sizes), sorted by at least ``depth + 2`` symbols."""
    symbols, start, size = closed(text, sizes)
    key = np.zeros(len(symbols), np.uint64)
    for i in range(8):
        key = key << np.uint64(8) | symbols[_after(start, size, i)]
    known = 8
    order = np.argsort(key)
    while known < depth + 2:
        rank = np.empty(len(key), np.uint64)
        ordered = key[order]
        rank[order] = np.cumsum(np.concatenate([[False], ordered[1:] != ordered[:-1]])) if len(key) else 0
        key = rank << np.uint64(32) | rank[_after(start, size, known)]
        known *= 2
        order = np.argsort(key)
    two = symbols[_after(start, size, -2)].astype(np.uint16) << 8 | symbols[_after(start, size, -1)]
    return Transform(two[order], order)


def merge(parts: list[Transform], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(collection, rotation, interval) in merged order: ``rotation`` is its place in the collection, and neighbours
    with the same first ``depth`` symbols (an even number) have the same interval.

    An entry of the interleave is kept as its place in its own collection's order. Going two symbols back leads from
    the n-th rotation with two certain symbols before it to the n-th that starts with them, in the same collection.
    """
    sizes = np.array([len(p.before) for p in parts], np.int64)
    base = np.cumsum(sizes) - sizes
    back = np.empty(int(sizes.sum()), np.int32)
    for p, at in zip(parts, base.tolist()):
        back[at + np.argsort(p.before, kind="stable")] = np.arange(at, at + len(p.before))
    before = np.concatenate([p.before for p in parts])
    entry, interval = np.arange(len(back), dtype=np.int32), np.zeros(len(back), np.int32)
    for _ in range(depth // 2):
        symbols = before[entry]
        dealt = np.argsort(symbols, kind="stable")
        symbols, old = symbols[dealt], interval[dealt]
        entry = back[entry[dealt]]
        parted = np.empty(len(entry), bool)
        parted[:1] = True
        parted[1:] = (symbols[1:] != symbols[:-1]) | (old[1:] != old[:-1])
        np.cumsum(parted, out=interval)
    source = np.repeat(np.arange(len(parts)), sizes)[entry]
    return source, np.concatenate([p.at for p in parts])[entry], interval
