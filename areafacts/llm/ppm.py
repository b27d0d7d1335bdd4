"""Prediction by partial matching over bytes: a context trie with escapes and symbol exclusion; numpy only.

A symbol is a byte of UTF-8 text or END, a value that UTF-8 never has; END also stands before a text's start. The trie
holds contexts of up to ORDER bytes with the whole distribution of each, ``Counted`` any number of them with what was
counted only. A context's count of a symbol, with one count for escaping per different symbol seen, gives its
probability; the escape's share goes to the next shorter context's distribution without the symbols seen here.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ORDER = 4
# Contexts of 2 bytes and more that make up less than 1/NODES of all positions are left out: none, unless it is set lower.
NODES = 1 << 62
END = 0xFF
_PAD = bytes([END]) * ORDER


def laid_out(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, each with ORDER ends before and one after; positions to predict; each text's first of them."""
    data = np.frombuffer(b"".join([_PAD + t + _PAD[:1] for t in rows]), np.uint8)
    sizes = np.array([len(t) + 1 for t in rows], np.int64)
    first = np.cumsum(sizes) - sizes
    at = np.arange(int(sizes.sum())) + np.repeat(ORDER * np.arange(1, len(rows) + 1), sizes)
    return data, at, first


def grams(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Each different context of ORDER bytes with the symbol after it, as one number, and how often it came up."""
    data, at, _ = laid_out(rows)
    key = keyed(data, at)
    key.sort()
    return summed(key, None)


def keyed(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Context of ORDER bytes and symbol at each position, as one number."""
    key = np.zeros(len(at), np.uint64)
    for back in range(ORDER, -1, -1):
        key <<= np.uint64(8)
        key |= data[at - back]
    return key


def summed(key: np.ndarray, count: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Different keys of a sorted array, with their counts added."""
    if not len(key):
        return key, np.zeros(0, np.int64)
    heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    if count is None:
        return key[heads], np.diff(np.append(heads, len(key)))
    return key[heads], np.add.reduceat(count, heads)


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    key = np.concatenate([np.zeros(0, np.uint64), *[k for k, _ in parts]])
    count = np.concatenate([np.zeros(0, np.int64), *[c for _, c in parts]])
    order = np.argsort(key, kind="stable")
    return summed(key[order], count[order])


def shortened(key: np.ndarray, count: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The same counts for contexts of ``order`` bytes."""
    return merged([(key & np.uint64(2 ** (8 * order + 8) - 1), count)])


def frequent(key: np.ndarray, count: np.ndarray, least: int) -> np.ndarray:
    """Which entries belong to a context with at least ``least`` positions; sorted keys."""
    heads = np.flatnonzero(np.diff(key >> np.uint64(8), prepend=np.uint64(2**63)))
    total = np.add.reduceat(count, heads) if len(key) else np.zeros(0, np.int64)
    return np.repeat(total >= least, np.diff(np.append(heads, len(key))))


@dataclass
class Trie:
    """``logp``: [node * 256 + symbol], base 10; ``child``: for each length, where the node of a context one byte longer is.

    Node 0 is the empty context, 1 to 256 are the contexts of one byte; child[i][node * 256 + byte before] of length
    i + 1 is a node of length i + 2, or -1.
    """

    logp: np.ndarray
    child: list[np.ndarray]
    starts: list[int]
    first: np.ndarray  # [byte before, symbol]: probabilities of the contexts of one byte

    @classmethod
    def of(cls, levels: list[tuple[np.ndarray, np.ndarray]]) -> Trie:
        """From the counts of each length of context, 0 to ORDER."""
        before, contexts = np.full((1, 256), 1 / 256), [np.zeros(1, np.uint64)]
        tables, children, starts = [_blended(before, *_dense(np.zeros(1, np.uint64), *levels[0]))], [], [0, 1]
        contexts.append(np.arange(256, dtype=np.uint64))
        tables.append(_blended(tables[0].repeat(256, axis=0), *_dense(contexts[1], *levels[1])))
        starts.append(257)
        for length in range(2, len(levels)):
            key, count = levels[length]
            own = np.unique(key >> np.uint64(8))
            parent = np.searchsorted(contexts[-1], own & np.uint64(2 ** (8 * length - 8) - 1))
            child = np.full(len(contexts[-1]) * 256, -1, np.int32)
            child[parent * 256 + (own >> np.uint64(8 * length - 8)).astype(np.int64)] = np.arange(len(own)) + starts[-1]
            children.append(child)
            tables.append(_blended(tables[-1][parent], *_dense(own, key, count)))
            contexts.append(own)
            starts.append(starts[-1] + len(own))
        return cls(np.log10(np.concatenate(tables)).astype(np.float32).reshape(-1), children, starts, tables[1])

    def score(self, rows: list[bytes]) -> np.ndarray:
        """log10 probability of each text with its end."""
        if not rows:
            return np.zeros(0)
        data, at, first, node, _ = self.reached(rows)
        return np.add.reduceat(self.of_symbols(node, data[at]), first)

    def of_symbols(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        return self.logp[node.astype(np.int64) * 256 + symbol].astype(np.float64)

    def reached(self, rows: list[bytes]) -> tuple[np.ndarray, ...]:
        """What ``laid_out`` gives, the node of each position, and whether it is the one of all ORDER bytes."""
        data, at, first = laid_out(rows)
        node = data[at - 1].astype(np.int32) + 1
        live = np.arange(len(at))
        for length, child in enumerate(self.child, 2):
            deeper = child[(node[live] - self.starts[length - 1]) * 256 + data[at[live] - length]]
            on = deeper >= 0
            live = live[on]
            node[live] = deeper[on]
        whole = np.zeros(len(at), bool)
        whole[live] = True
        return data, at, first, node, whole


class Counted:
    """Probabilities after contexts of ORDER bytes, from all counts of those that share their last two bytes.

    A symbol seen after a context was seen after the shorter ones, too: what a context leaves to a shorter one follows
    from the symbols it has seen, and no distribution is spelled out.
    """

    def __init__(self, key: np.ndarray, count: np.ndarray, first: np.ndarray, least: int = 1):
        self.first, self.levels = first, []
        for length in range(2, ORDER + 1):
            own, n = shortened(key, count, length)
            kept = frequent(own, n, least)
            own, n = own[kept], n[kept]
            if not len(own):
                break
            heads = np.flatnonzero(np.concatenate([[True], np.diff(own >> np.uint64(8)) != 0]))
            different = np.diff(np.append(heads, len(own)))
            total = np.add.reduceat(n, heads)
            escape = np.where(different == 256, 0.0, different / (total + different))
            rest = 1 - np.add.reduceat(self.probability(own), heads)
            onward = escape / np.where(rest > 0, rest, 1)
            seen = np.repeat((1 - escape) / total, different) * n
            self.levels.append((own, seen, own[heads] >> np.uint64(8), onward))

    def probability(self, key: np.ndarray) -> np.ndarray:
        """Of the symbol after the context, both in ``key`` as ``grams`` has them."""
        p = self.first[(key >> np.uint64(8) & np.uint64(255)).astype(np.int64), (key & np.uint64(255)).astype(np.int64)]
        for length, (own, seen, contexts, onward) in enumerate(self.levels, 2):
            mine = key & np.uint64(2 ** (8 * length + 8) - 1)
            at = np.minimum(np.searchsorted(own, mine), len(own) - 1)
            of = np.minimum(np.searchsorted(contexts, mine >> np.uint64(8)), len(contexts) - 1)
            p = np.where(own[at] == mine, seen[at], np.where(contexts[of] == mine >> np.uint64(8), onward[of] * p, p))
        return p


def _dense(contexts: np.ndarray, key: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    counts = np.zeros((len(contexts), 256))
    counts[np.searchsorted(contexts, key >> np.uint64(8)), (key & np.uint64(255)).astype(np.int64)] = count
    return (counts,)


def _blended(shorter: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Probabilities of contexts from their counts and their shorter contexts' probabilities."""
    seen = counts > 0
    different = seen.sum(axis=1, keepdims=True)
    total = counts.sum(axis=1, keepdims=True)
    others = np.where(seen, 0, shorter)
    rest = others.sum(axis=1, keepdims=True)
    # without counts all mass escapes, with every symbol seen none does
    escape = np.where(total == 0, 1.0, np.where(different == 256, 0.0, different / np.maximum(total + different, 1)))
    return np.where(seen, (1 - escape) * counts / np.maximum(total, 1), escape * others / np.where(rest > 0, rest, 1))
