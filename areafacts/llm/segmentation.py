"""Sampled segmentations of whole texts with a SentencePiece vocabulary, and decoding.

``encode`` gives each text ``k`` distinct segmentations, drawn without replacement by the Gumbel top-k method as a best
first (A*) search over the perturbed lattice of the text. An agenda entry is a set of segmentations that share their
units up to some place and differ from known ones there; its priority is the largest perturbed log probability in the
set, which is a Gumbel variable of the set's total probability, truncated at its parent's. The best entry is completed by
an exact draw, and the sets that branch off its path enter the agenda. Branches are only drawn where the path's
probability so far is above exp(-60): beyond, a branch would be among the best with a probability below 1e-24.

The score of inclusion is log(1 - exp(-exp(log p - t))), where t is the best perturbed value that was not taken; it is 0
if all segmentations were. All random numbers are functions of the seed, the row key and the place in the text, so the
result does not depend on partitions, batches or retries. Completions of a batch of texts are drawn together, in numpy.

Defined cases: null and empty text have one segmentation without pieces. Fewer segmentations than k are all given.
Decoding a segmentation gives the text, with the sign that stands for spaces read as a space. Rows with the same key and
text get the same segmentations. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from areafacts.llm.common import batch
from areafacts.llm.lattice import SPACE, Known, Lattice, Vocabulary, uniform

SEED = 3
# Characters of text whose lattices a task holds at once (one text more, if it is longer).
AT_ONCE = 800_000
REACH = 60.0
MASK = 2**64 - 1


def _truncated(mu: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel variables of locations ``mu`` that are at most ``bound``."""
    return mu - np.log(np.exp(np.minimum(mu - bound, 700)) - np.log(u))


def _stream(row: int, sample: int, purpose: int) -> int:
    """The key of the random numbers that a row's sample needs for one purpose."""
    x = (row & MASK) ^ (SEED << 40)
    for part in (sample, purpose):
        x = ((x ^ (x >> 29)) * 0xBF58476D1CE4E5B9 + part * 0x9E3779B97F4A7C15) & MASK
    return (x ^ (x >> 32)) * 0x94D049BB133111EB & MASK


def _reached(logp: np.ndarray) -> np.ndarray:
    """Log probability before each unit, as far as it is above -REACH."""
    size = 64
    while True:
        before = np.cumsum(logp[:size]) - logp[:size]
        if size >= len(logp) or before[-1] <= -REACH:
            return before[: int(np.searchsorted(-before, REACH))]
        size *= 4


class Path:
    """A segmentation of one text: edges, edges of each unit, log probabilities of the units, perturbed value."""

    def __init__(self, edges: np.ndarray, n: np.ndarray, logp: np.ndarray, value: float):
        self.edges, self.n, self.logp, self.value = edges, n, logp, value

    def until(self, unit: int) -> int:
        return int(self.n[:unit].sum())


class Search:
    """The agenda of one text."""

    def __init__(self, key: int, units: np.ndarray, lattice: Lattice, k: int):
        self.key, self.units, self.lattice, self.k = key, units, lattice, k
        self.agenda: list[tuple] = []
        self.taken: list[Path] = []

    def accept(self, path: Path, branch: int, excluded: list[tuple[int, ...]]) -> None:
        """``path`` is the best of the set that leaves its parent at unit ``branch``, where ``excluded`` was known."""
        sample = len(self.taken)
        self.taken.append(path)
        before = _reached(path.logp)[branch:]
        if not len(before):
            return
        rest = -np.expm1(path.logp[branch : branch + len(before)])
        if excluded:
            start = path.until(branch)
            own = tuple(path.edges[start : start + path.n[branch]].tolist())
            rest[0] = 1 - sum(float(np.exp(self.lattice.logp[list(e)].sum())) for e in [*excluded, own])
        live = np.flatnonzero(rest > 1e-9)
        if not len(live):
            return
        u = uniform(np.uint64(_stream(self.key, sample, 2)), live + branch)
        values = _truncated(before[live] + np.log(rest[live]), path.value, u)
        # of this path's branches no more than the best that are still to be taken, and one for the threshold, can matter
        for i in np.argsort(-values, kind="stable")[: self.k - len(self.taken) + 1].tolist():
            t = int(live[i])
            heapq.heappush(self.agenda, (-float(values[i]), sample, t + branch, excluded if t == 0 else []))


def _complete(searches: list[Search], picks: list[tuple | None], lattice: Lattice, sample: int) -> None:
    """Completes each search's entry (the whole lattice, if there is none yet): all remaining units are drawn together."""
    places, heads = [], []
    for search, pick in zip(searches, picks):
        if pick is None:
            heads.append(None)
            places.append(0)
            continue
        value, parent, t, excluded = pick
        path = search.taken[parent]
        start = path.until(t)
        known = [*excluded, tuple(path.edges[start : start + path.n[t]].tolist())]
        heads.append((t, known, lattice.other(int(search.units[t]), known, _stream(search.key, sample, 3)), path, start))
        places.append(t + 1)
    units = np.concatenate([s.units[p:] for s, p in zip(searches, places)])
    sizes = np.array([len(s.units) - p for s, p in zip(searches, places)])
    unit_at = np.concatenate([[0], np.cumsum(sizes)])
    place = np.arange(len(units)) - np.repeat(unit_at[:-1] - np.array(places), sizes)
    stream = np.repeat(np.array([_stream(s.key, sample, 1) for s in searches], np.uint64), sizes)
    with np.errstate(over="ignore"):
        edges, n, logp = lattice.walk(units, stream + place.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    edge_at = np.concatenate([[0], np.cumsum(n)])
    for i, (search, pick, head) in enumerate(zip(searches, picks, heads)):
        a, b = unit_at[i], unit_at[i + 1]
        mine = (edges[edge_at[a] : edge_at[b]], n[a:b], logp[a:b])
        if head is None:
            u = uniform(np.array([_stream(search.key, 0, 4)], np.uint64), 1)
            search.accept(Path(*mine, float(-np.log(-np.log(u[0])))), 0, [])
            continue
        t, known, (new, new_logp), path, start = head
        whole = Path(
            np.concatenate([path.edges[:start], np.array(new, np.int32), mine[0]]),
            np.concatenate([path.n[:t], [len(new)], mine[1]]),
            np.concatenate([path.logp[:t], [new_logp], mine[2]]),
            -pick[0],
        )
        search.accept(whole, t, known)


def top_k(keys: list[int], texts: list[str], k: int, known: Known) -> list[list[tuple[np.ndarray, float, float]]]:
    """For each text its segmentations, best perturbed value first: piece ids, log probability, log inclusion score."""
    units, lattice = known.of(texts)
    searches = [Search(key, u, lattice, k) for key, u in zip(keys, units)]
    live = [s for s in searches if len(s.units)]
    if live:
        _complete(live, [None] * len(live), lattice, 0)
    for sample in range(1, k):
        live = [s for s in live if s.agenda]
        if live:
            _complete(live, [heapq.heappop(s.agenda) for s in live], lattice, sample)
    paths = [path for s in searches for path in s.taken]
    ids, n = lattice.ids(np.concatenate([np.empty(0, np.int32), *[path.edges for path in paths]]))
    ends = np.cumsum(n)
    out, at, start = [], 0, 0
    for s in searches:
        found = []
        for path in s.taken:
            at += len(path.edges)
            end = int(ends[at - 1]) if at else 0
            logp = float(path.logp.sum())
            gap = logp + s.agenda[0][0] if s.agenda else np.inf
            included = gap if gap < -30 else float(np.log(-np.expm1(-np.exp(min(gap, 700)))))
            found.append((ids[start:end], logp, included))
            start = end
        out.append(found or [(np.empty(0, np.int64), 0.0, 0.0)])
    return out


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    for b in batches:
        ids, texts, size = [], [], 0
        for i, t in zip(b.column("id").to_pylist(), b.column("text").to_pylist()):
            t = t or ""
            if ids and size + len(t) > AT_ONCE:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(t)
            size += len(t)
        if ids:
            yield ids, texts


def decoded(vocabulary: Vocabulary) -> list[bytes]:
    """Bytes of every piece."""
    table = [p.replace(SPACE, " ").encode() for p in vocabulary.pieces]
    for b, i in enumerate(vocabulary.byte_ids):
        table[i] = bytes([b])
    return table


def restored(table: list[bytes], ids: list[int]) -> bytes:
    """The text of piece ids, in UTF-8; the space that was put before it goes."""
    return b"".join(map(table.__getitem__, ids)).removeprefix(b" ")


def gives_back(table: pa.Array, flat: np.ndarray, sizes: list[int], texts: list[bytes]) -> list[bool]:
    """Whether each run of pieces decodes to its text; the pieces of all runs are looked up and joined in Arrow."""
    joined = table.take(pa.array(flat, pa.int32()))
    _, offsets, data = joined.buffers()
    if data is None:
        return [not t for t in texts]
    ends = np.frombuffer(offsets, np.int32)[np.concatenate([[0], np.cumsum(sizes)])].tolist()
    whole = memoryview(data)
    return [bytes(whole[a:b]).removeprefix(b" ") == t for a, b, t in zip(ends, ends[1:], texts)]


def restore(table: list[bytes], ids: list[int]) -> str:
    return restored(table, ids).decode("utf-8", "replace")


SAMPLES = "doc_id long, sample int, log_probability double, log_inclusion double, n_pieces long, pieces array<int>, round_trip boolean"


def encode(
    docs: DataFrame, model_file: str, k: int = 2, alpha: float = 0.5, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``k`` sampled segmentations of every text: one row for each, ``sample`` from 1 in the order they were drawn.

    ``round_trip`` tells whether decoding gives the text back. ``alpha`` scales the pieces' log probabilities: lower is
    more even. The vocabulary is read on the driver and sent to the tasks; its size is the model's.
    """
    rows = docs.select(docs[f"`{id_column}`"].cast("long").alias("id"), docs[f"`{text_column}`"].alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model_file, alpha))
    out = pa.schema(
        [("doc_id", pa.int64()), ("sample", pa.int32()), ("log_probability", pa.float64()), ("log_inclusion", pa.float64())]
        + [("n_pieces", pa.int64()), ("pieces", pa.list_(pa.int32())), ("round_trip", pa.bool_())]
    )

    def take(batches):
        known = Known(shared.value)
        table = pa.array(decoded(shared.value), pa.binary())
        for ids, texts in _gathered(batches):
            found = top_k([0 if i is None else i for i in ids], texts, k, known)
            flat = [(i, n + 1, *sample) for i, samples in zip(ids, found) for n, sample in enumerate(samples)]
            read = [t.replace(SPACE, " ").encode("utf-8", "surrogatepass") for t in texts]
            sizes = [len(s[2]) for s in flat]
            together = np.concatenate([s[2] for s in flat]).astype(np.int32)
            same = gives_back(table, together, sizes, [t for t, samples in zip(read, found) for _ in samples])
            pieces = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), pa.array(together))
            yield batch(out, [s[0] for s in flat], [s[1] for s in flat], [s[3] for s in flat], [s[4] for s in flat], sizes, pieces, same)

    return rows.mapInArrow(take, SAMPLES)


def decode(rows: DataFrame, model_file: str, id_column: str = "doc_id", pieces_column: str = "pieces") -> DataFrame:
    """(doc_id, text) of piece ids; null and empty lists are empty texts, null or unknown ids are left out."""
    picked = rows.select(rows[f"`{id_column}`"].cast("long").alias("id"), rows[f"`{pieces_column}`"].cast("array<int>").alias("pieces"))
    shared = rows.sparkSession.sparkContext.broadcast(Vocabulary.load(model_file, 1.0))
    out = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def take(batches):
        table = decoded(shared.value)
        for b in batches:
            for start in range(0, b.num_rows, 256):
                part = b.slice(start, 256)
                known = [[i for i in p or [] if i is not None and 0 <= i < len(table)] for p in part.column("pieces").to_pylist()]
                yield batch(out, part.column("id"), [restore(table, ids) for ids in known])

    return picked.mapInArrow(take, "doc_id long, text string")
