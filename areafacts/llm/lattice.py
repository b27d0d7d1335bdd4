"""Lattices of the ways to cut text into pieces, for many units of text at once; numpy only.

A unit is a stretch that no piece crosses (a word with the spaces before it), so a text's lattice is the chain of its
units' lattices and a segmentation's probability is the product over its units. The forward sums give every node the
probabilities of the pieces that end there; walks from a unit's end to its start draw segmentations exactly.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACE = "▁"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BITS = 18  # of the piece table, several times the pieces


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(key: np.ndarray, count: int | np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) that depend on key and count only."""
    with np.errstate(over="ignore"):
        bits = (key ^ np.uint64(0xD1B54A32D192ED03) * np.asarray(count, np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        bits ^= bits >> np.uint64(32)
        bits *= np.uint64(0x94D049BB133111EB)
    out = (bits >> np.uint64(12)).astype(np.float64)
    out += 0.5
    out *= 2.0**-52
    return out


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


@dataclass
class Vocabulary:
    """Pieces by id with log probabilities; ids of the 256 byte pieces; hashed pieces for lookup."""

    pieces: list[str]
    logp: np.ndarray
    byte_ids: np.ndarray
    hashes: np.ndarray  # open addressing: 0 is a free place
    ids: np.ndarray
    longest: int
    lone: bytes

    @classmethod
    def load(cls, model_file: str, alpha: float) -> Vocabulary:
        """Pieces of a SentencePiece model. A BPE model has ranks instead of probabilities: Zipf's law makes them some."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = model.vocab_size()
        pieces = [model.id_to_piece(i) for i in range(size)]
        byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        score = np.array([model.get_score(i) for i in range(size)])
        if score[plain].max() <= 0 and (score[plain] == np.round(score[plain])).all():
            rank = np.minimum(np.where(score > -size * 2, -score, 0), size) + 10
            logp = -np.log(rank) - np.log((1 / rank[plain]).sum())
        else:
            logp = score.copy()
        logp[byte_ids] = logp[plain].min() - 1
        return cls.of({pieces[i]: i for i in plain}, alpha * logp, pieces, byte_ids)

    @classmethod
    def of(cls, lookup: dict[str, int], logp: np.ndarray, pieces: list[str], byte_ids: np.ndarray) -> Vocabulary:
        if any(SPACE in p.lstrip(SPACE) for p in lookup):
            raise ValueError("a piece goes on after a space; units cannot be cut before spaces")
        with np.errstate(over="ignore"):
            hashes = np.array([_hash(codes(p)) for p in lookup], np.uint64)
        table, ids = np.zeros((1 << _BITS) + len(lookup), np.uint64), np.full((1 << _BITS) + len(lookup), -1)
        for h, at, i in zip(hashes, _slot(hashes).tolist(), lookup.values()):
            while table[at]:
                at += 1
            table[at], ids[at] = h, i
        # a character of no longer piece is a unit of its own, if it is white space: lines end units
        lone = "".join(c for c in "\n\r\t" if not any(c in p and len(p) > 1 for p in lookup)).encode()
        return cls(pieces, logp, byte_ids, table, ids, max(map(len, lookup)), lone)

    def cut(self, texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
        """Units of all texts, and how many each text has.

        Like in the models, a text gets a space before it, and the space's own sign is read as a space. A unit starts
        with the text, with the first of some spaces, and before and after a lone character.
        """
        rows = [(" " + t.replace(SPACE, " ")).encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        sizes = np.array([len(r) for r in rows], np.int64)
        joined = b"".join(rows)
        data = np.frombuffer(joined, np.uint8)
        space, alone = data == 32, np.isin(data, np.frombuffer(self.lone, np.uint8))
        start = alone.copy()
        start[1:] |= alone[:-1] | (space[1:] & ~space[:-1])
        begin = np.cumsum(sizes) - sizes
        start[begin[sizes > 0]] = True
        at = np.flatnonzero(start)
        offsets = np.append(at, len(data)).astype(np.int64)
        units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(joined)])
        return units.dictionary_encode(), np.searchsorted(at, begin + sizes) - np.searchsorted(at, begin)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the hashes that are a piece's, and the pieces' ids."""
        at = _slot(hashes)
        there = self.hashes[at]
        used = np.flatnonzero(there)
        rows, at = used, at[used]
        same = there[used] == hashes[used]
        places, ids = [rows[same]], [self.ids[at[same]]]
        rows, at = rows[~same], at[~same] + 1
        while len(rows):
            there = self.hashes[at]
            same = there == hashes[rows]
            places.append(rows[same])
            ids.append(self.ids[at[same]])
            on = ~same & (there != 0)
            rows, at = rows[on], at[on] + 1
        return np.concatenate(places), np.concatenate(ids)


def _hash(points: np.ndarray) -> np.uint64:
    h = np.uint64(0)
    for c in points:
        h = h * _BASE + c + np.uint64(1)
    return h


def _slot(hashes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (hashes * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - _BITS)).view(np.int64)


class Lattice:
    """Edges of all units, sorted by the node they end in, with the probability of each among those that end there.

    Nodes are numbered through: unit u with n characters has n + 1, from ``first[u]`` to ``last[u]``. An edge is a piece,
    or, where no piece has a character, that character's bytes (piece -1).
    """

    def __init__(self, units: list[str], vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        sizes = np.array([len(u) for u in units], np.int64)
        ends = np.cumsum(sizes)
        text = codes("".join(units))
        unit = np.repeat(np.arange(len(units)), sizes)
        self.first = ends - sizes + np.arange(len(units))
        self.last = self.first + sizes
        left = ends[unit] - np.arange(len(text))  # characters from here to the unit's end
        node = np.arange(len(text)) + unit
        starts, stops, found = [], [], []
        at, h = np.arange(len(text)), np.zeros(len(text), np.uint64)
        covered = np.zeros(len(text), bool)
        text += np.uint64(1)
        with np.errstate(over="ignore"):
            for n in range(1, vocabulary.longest + 1):
                if n > 1:
                    keep = np.flatnonzero(left[at] >= n)
                    at, h = at[keep], h[keep]
                if not len(at):
                    break
                h *= _BASE
                h += text[at + (n - 1)]
                hit, ids = vocabulary.find(h)
                start = node[at[hit]]
                if n == 1:
                    covered[at[hit]] = True
                starts.append(start)
                stops.append(start + n)
                found.append(ids)
        text -= np.uint64(1)
        bare = np.flatnonzero(~covered)
        self.bare = {int(s): chr(int(c)).encode("utf-8", "surrogatepass") for s, c in zip(node[bare], text[bare])}
        in_bytes = np.array([len(self.bare[int(s)]) for s in node[bare]], np.int64)
        of_one = self.vocabulary.logp[self.vocabulary.byte_ids[0]]
        none = np.empty(0, np.int64)
        # the longest first within a node: mostly the likeliest, so that a draw mostly stops at its first edge
        ids = np.concatenate([none, *found[::-1]])
        start = np.concatenate([none, *starts[::-1], node[bare]])
        stop = np.concatenate([none, *stops[::-1], node[bare] + 1])
        piece = np.concatenate([ids, np.full(len(bare), -1)])
        weight = np.concatenate([vocabulary.logp[ids], of_one * in_bytes])
        order = np.argsort(stop, kind="stable")
        self.start, self.piece, stop, weight = start[order].astype(np.int32), piece[order].astype(np.int32), stop[order], weight[order]
        self._normalize(stop, weight, np.concatenate([none, stop - np.repeat(self.first, sizes + 1)[stop]]))

    def _normalize(self, stop: np.ndarray, weight: np.ndarray, depth: np.ndarray) -> None:
        """Forward sums node by node of all units together, then each edge's share of the node it ends in."""
        total = np.zeros(int(self.last[-1]) + 1 if len(self.last) else 0)
        by_depth = np.argsort(depth.astype(np.int16) if len(depth) and depth.max() < 2**15 else depth, kind="stable")
        bounds = np.flatnonzero(np.diff(depth[by_depth], prepend=-1))
        for a, b in zip(bounds, np.append(bounds[1:], len(depth))):
            e = by_depth[a:b]
            value, node = total[self.start[e]] + weight[e], stop[e]
            heads = np.flatnonzero(np.diff(node, prepend=-1))
            top = np.maximum.reduceat(value, heads)
            spread = np.repeat(top, np.diff(np.append(heads, len(e))))
            total[node[heads]] = top + np.log(np.add.reduceat(np.exp(value - spread), heads))
        self.logp = total[self.start] + weight - total[stop]
        p = np.exp(self.logp)
        heads = np.flatnonzero(np.diff(stop, prepend=-1))
        size = np.diff(np.append(heads, len(stop)))
        self.edges = np.zeros((len(total), 2), np.int32)  # of each node: from, to
        self.edges[stop[heads]] = np.stack([heads, heads + size], axis=1)
        running = np.cumsum(p)
        self.cumulative = running - np.repeat(running[heads] - p[heads], size)
        self.cumulative[heads + size - 1] = 2.0

    def walk(self, units: np.ndarray, key: np.ndarray):
        """One drawn segmentation of each unit: edges in text order, their number, and log probabilities."""
        node, lane, begin = self.last[units], np.arange(len(units)), self.first[units]
        chosen, who, logp, n = [], [], np.zeros(len(units)), np.zeros(len(units), np.int64)
        step, from_ = 0, np.ascontiguousarray(self.edges[:, 0])
        while len(lane):
            step += 1
            u = uniform(key, step)
            e = from_[node]
            more = np.flatnonzero(self.cumulative[e] < u)
            while len(more):
                e[more] += 1
                more = more[self.cumulative[e[more]] < u[more]]
            chosen.append(e)
            who.append(lane)
            logp[lane] += self.logp[e]
            n[lane] = step
            node = self.start[e]
            on = np.flatnonzero(node != begin)
            node, lane, begin, key = node[on], lane[on], begin[on], key[on]
        end = np.cumsum(n)
        edges = np.empty(end[-1] if len(end) else 0, np.int32)
        for i, (e, who_) in enumerate(zip(chosen, who)):
            edges[end[who_] - 1 - i] = e
        return edges, n, logp

    def other(self, unit: int, excluded: list[tuple[int, ...]], key: int):
        """One drawn segmentation of a unit that is none of ``excluded``; edges in text order and log probability."""
        left, node, path, logp = [e[::-1] for e in excluded], int(self.last[unit]), [], 0.0
        draws = iter(uniform(np.uint64(key), np.arange(1, node - int(self.first[unit]) + 1)).tolist())
        while node != self.first[unit]:
            a, b = self.edges[node].tolist()
            mass = np.exp(self.logp[a:b]).tolist()
            for e in left:
                mass[e[0] - a] -= math.exp(sum(self.logp[j] for j in e))
            mass = [max(m, 0.0) for m in mass]
            rest, e = next(draws) * sum(mass), 0
            while rest > mass[e] and any(mass[e + 1 :]):
                rest -= mass[e]
                e += 1
            while not mass[e] and any(mass[e + 1 :]):
                e += 1
            e += a
            path.append(e)
            logp += float(self.logp[e])
            left = [x[1:] for x in left if x[0] == e and len(x) > 1]
            node = int(self.start[e])
        return tuple(path[::-1]), logp

    def ids(self, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of edges, and how many each edge has (bytes of a character that is no piece)."""
        piece = self.piece[edges]
        n = np.ones(len(edges), np.int64)
        if not (piece < 0).any():
            return piece, n
        spelled = {i: self.vocabulary.byte_ids[list(self.bare[int(self.start[edges[i]])])] for i in np.flatnonzero(piece < 0)}
        n[list(spelled)] = [len(s) for s in spelled.values()]
        out, at = np.repeat(piece, n), np.cumsum(n) - n
        for i, s in spelled.items():
            out[at[i] : at[i] + len(s)] = s
        return out, n


class Numbers(dict):
    """Numbers in the order of first sight."""

    def __missing__(self, unit: str | bytes) -> int:
        self[unit] = n = len(self)
        return n


class Known:
    """The lattices of units that came up more than once, up to ``most`` of them, kept from batch to batch.

    A batch's new units are numbered on after them, in the same arrays; those that came up again are the first of the
    new ones and stay, the others are overwritten by the next batch.
    """

    BY_UNIT, BY_NODE, BY_EDGE = ("first", "last"), ("edges",), ("start", "piece", "logp", "cumulative")

    def __init__(self, vocabulary: Vocabulary, most: int = 100_000):
        self.vocabulary, self.most = vocabulary, most
        self.index = Numbers()
        empty = Lattice([], vocabulary)
        self.room = {name: getattr(empty, name) for name in (*self.BY_UNIT, *self.BY_NODE, *self.BY_EDGE)}
        self.nodes = self.edges = 0
        self.bare: dict[int, bytes] = {}

    def _put(self, name: str, at: int, values: np.ndarray) -> np.ndarray:
        """The array ``name`` up to and with ``values``, which go to ``at``."""
        old = self.room[name]
        if at + len(values) > len(old):
            self.room[name] = np.zeros((max(at + len(values), len(old) * 3 // 2), *old.shape[1:]), old.dtype)
            self.room[name][:at] = old[:at]
        self.room[name][at : at + len(values)] = values
        return self.room[name][: at + len(values)]

    def _with(self, fresh: Lattice) -> Lattice:
        both = object.__new__(Lattice)
        both.vocabulary, units = self.vocabulary, len(self.index)
        both.bare = self.bare | {i + self.nodes: b for i, b in fresh.bare.items()}
        for name in self.BY_UNIT:
            setattr(both, name, self._put(name, units, getattr(fresh, name) + self.nodes))
        both.edges = self._put("edges", self.nodes, fresh.edges + np.int32(self.edges))
        both.start = self._put("start", self.edges, fresh.start + np.int32(self.nodes))
        for name in self.BY_EDGE[1:]:
            setattr(both, name, self._put(name, self.edges, getattr(fresh, name)))
        return both

    def of(self, texts: list[str]) -> tuple[list[np.ndarray], Lattice]:
        """The texts' units as numbers in a lattice that holds them all; it serves until the next call."""
        n, index = len(self.index), self.index
        units, each = self.vocabulary.cut(texts)
        number_of = np.fromiter(map(index.__getitem__, units.dictionary.to_pylist()), np.int64, len(units.dictionary))
        ids = number_of[units.indices.to_numpy()]
        new = list(index)[n:]
        # new units by how often they came up: those that stay are the first of them
        count = np.bincount(ids, minlength=len(index))[n:]
        order = np.argsort(-count, kind="stable")
        number = np.arange(len(index))
        number[n + order] = n + np.arange(len(order))
        for unit in new:
            del index[unit]
        shown = [new[i].decode("utf-8", "surrogatepass").replace(" ", SPACE) for i in order]
        fresh = Lattice(shown, self.vocabulary)
        lattice = self._with(fresh)
        again = int((count > 1).sum())
        if again and n + again <= self.most:
            for i in order[:again]:
                index[new[i]] = len(index)
            nodes = int(fresh.last[again - 1]) + 1
            self.bare |= {i + self.nodes: b for i, b in fresh.bare.items() if i < nodes}
            self.edges += int(fresh.edges[nodes - 1, 1])
            self.nodes += nodes
        return np.split(number[ids], np.cumsum(each)[:-1]) if texts else [], lattice
