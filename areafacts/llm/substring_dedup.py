"""Removal of repeated passages: every byte covered by a string of LENGTH bytes that also starts in an earlier document.

Exact, whatever the length of a repetition and wherever it starts, and never held in one place:

1. Texts are packed into shards of bounded size (a longer text is a shard of its own).
2. Of the 24-byte strings in a window of LENGTH bytes, the one with the smallest hash is the window's anchor. Equal
   windows have equal anchors, so they meet if anchors do. Shards send their anchors' hashes to buckets and get back one
   bit for each: whether another document has it. Everything else in the corpus is done with after this.
3. Shards send, for the anchors that others have, the stretches of text around them (contexts) to the anchors' buckets,
   equal ones once, with their earliest document.
4. In a bucket, a context that all its anchor's senders agree on is decided at once. Where contexts differ, windows whose
   64-bit hash no other has are equal to none. The stretches of the others make Burrows-Wheeler transforms, one for a run
   of shards and at most PARTS, so that transforms do not get smaller and more with the corpus; these are merged by
   refining their interleave round by round, two symbols a round, up to LENGTH symbols (see ``bwt``). Neighbours that have
   not parted by then are an interval of equal windows, and the earliest document of an interval decides on its windows.
   One bit per window goes back.
5. Shards mark what their windows cover.

An anchor that HOT or more contexts have (a passage that a third of all documents share, with different text around it)
would make a bucket as large as the corpus. Its windows are sent one by one instead, under a 128-bit hash, equal ones
once a shard, to buckets of their own hash: exact up to hash collisions, which at 10^14 windows have a probability of
10^-10. Shards and answers are written to the shared folder by the hash of the shard, so texts are never shuffled; the
messages between are functions of them, so a lost task sends the same again.

Defined cases: null text is empty. Texts shorter than LENGTH keep everything. "Earlier" is a smaller id; a null id is
later than every other. Rows of one id are one document: they do not remove each other's text, and each is returned.
Repetitions within a document stay. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areafacts import scratch
from areafacts.llm import bwt
from areafacts.llm.common import batch, runs, texts
from areafacts.llm.lattice import Numbers

# Every shard writes to every bucket: messages fall with the square of this, and a shard fits a task many times over.
SHARD = 4_000_000
ANCHOR = 24
HOT = 2048
# Symbols whose transforms are merged at once; the contexts of one anchor stay together.
MERGED = 250_000
# So many transforms are merged, of runs of shards.
PARTS = 8
# A bucket has about what so many shards have, up to BUCKETS of them.
SHARDS_A_BUCKET = 4
BUCKETS = 4096
BROADCAST = 64 << 20
# Bytes of a shard that are hashed at once: what that takes stays in a core's cache.
BLOCK = 1 << 17
NO_ID = np.iinfo(np.int64).max

_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
# Random values for the bytes, so that the rolling hashes see no structure of the alphabet.
_BYTES = np.random.default_rng(17).integers(0, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def rolling(data: np.ndarray, n: int, which: int = 0) -> np.ndarray:
    """A 64-bit hash of the ``n`` bytes from each place on, by doubling."""
    if len(data) < n:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        have, width, power = _BYTES[which][data], 1, _ODD[which]
        out, done = None, 0
        while True:
            if n & width:
                if out is None:
                    out = have
                else:
                    m = len(data) - done - width + 1
                    out = out[:m] * power + have[done : done + m]
                done += width
            if done == n:
                break
            m = len(data) - 2 * width + 1
            have = have[:m] * power + have[width : width + m]
            power, width = power * power, 2 * width
    return mixed(out)


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[: len(x) - have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :])


def anchor_size(length: int) -> int:
    """Short anchors are found in many texts by chance, long ones are many: at most half a window."""
    return min(ANCHOR, length // 2)


def short(hashes: np.ndarray) -> bytes:
    """The upper six bytes of sorted hashes: two anchors that share them are compared in vain, no more.

    Steps from hash to hash, all their first bytes, then all second ones: the upper bytes of steps are zeros, which the
    shuffle's compression takes out.
    """
    steps = np.diff(hashes >> np.uint64(16), prepend=np.uint64(0))
    return steps.view(np.uint8).reshape(-1, 8)[:, :6].T.tobytes()


def lengthened(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(6, len(data) // 6).T
    return np.cumsum(out.view(np.uint64)[:, 0], dtype=np.uint64) << np.uint64(16)


def pressed(sizes: np.ndarray, least: np.ndarray, contexts: list[bytes], press: zstandard.ZstdCompressor) -> bytes:
    """Sizes, earliest documents and bytes of contexts, compressed; the numbers byte by byte, as most bytes repeat."""
    planes = [x.view(np.uint8).reshape(len(sizes), -1).T.tobytes() for x in (sizes.astype(np.uint32), least)]
    return press.compress(b"".join([*planes, *contexts]))


def expanded(data: bytes, n: int, expand: zstandard.ZstdDecompressor) -> tuple[np.ndarray, np.ndarray, bytes]:
    """What :func:`pressed` got, of ``n`` contexts."""
    whole = expand.decompress(data)
    sizes, least = (
        np.ascontiguousarray(np.frombuffer(whole[a * n : b * n], np.uint8).reshape(b - a, n).T).view(kind)[:, 0]
        for a, b, kind in ((0, 4, np.uint32), (4, 12, np.int64))
    )
    return sizes.astype(np.int64), least, whole[12 * n :]


class Shard:
    """Texts of some documents: bytes, sizes, ids."""

    def __init__(self, row: dict):
        data = zstandard.ZstdDecompressor().decompress(row["text"], max_output_size=max(row["n_bytes"], 1))
        self.raw, self.data = data, np.frombuffer(data, np.uint8)
        self.sizes, self.ids = np.frombuffer(row["sizes"], np.int64), np.frombuffer(row["ids"], np.int64)
        self.ends = np.cumsum(self.sizes)

    def anchored(self, length: int):
        """Runs of windows with the same anchor: first window, number of windows, hash of the anchor, document's id."""
        size = anchor_size(length)
        whole = np.ones(len(self.data), bool)  # whether a window that starts here ends in the same text
        for end, n in zip(self.ends.tolist(), self.sizes.tolist()):
            whole[end - min(n, length - 1) : end] = False
        starts, anchors, hashes = [], [], []
        last = -1
        for at in range(0, len(self.data), BLOCK):
            window = np.flatnonzero(whole[at : at + BLOCK])
            if not len(window):
                continue
            found = rolling(self.data[at : at + BLOCK + length - 1], size)
            # smallest hash, then leftmost: both depend on the window's bytes only
            key = found & np.uint64(0xFFFFFFFF00000000) | np.arange(len(found), dtype=np.uint64)
            anchor = (sliding_min(key, length - size + 1)[window] & np.uint64(0xFFFFFFFF)).astype(np.int64)
            first = runs(anchor)
            if anchor[0] + at == last:  # the run goes on from the block before
                first = first[1:]
            last = int(anchor[-1]) + at
            starts.append(window[first] + at)
            anchors.append(anchor[first] + at)
            # the smallest of many hashes are small: mixed anew, they spread over all buckets
            hashes.append(mixed(found[anchor[first]]))
        if not starts:
            none = np.empty(0, np.int64)
            return none, none, np.empty(0, np.uint64), none
        start = np.concatenate(starts)
        # windows are counted, not places: those between two texts are none
        before = np.concatenate([[0], np.cumsum(whole)])
        count = np.diff(np.append(before[start], before[-1]))
        return start, count, np.concatenate(hashes), self.ids[np.searchsorted(self.ends, start, side="right")]


SHARDS = pa.schema([("shard", pa.int64()), ("ids", pa.binary()), ("sizes", pa.binary()), ("text", pa.binary()), ("n_bytes", pa.int64())])
SHARDS_SQL = "shard long, ids binary, sizes binary, text binary, n_bytes long"


def pack(docs: DataFrame, shard_bytes: int = SHARD) -> DataFrame:
    """Rows (id, text) as compressed shards of about ``shard_bytes``; one row each."""

    def take(batches):
        task, number, rows, size = TaskContext.get().partitionId(), 0, [], 0

        def shard():
            data = zstandard.ZstdCompressor(level=1).compress(b"".join([t for _, t in rows]))
            sizes = np.array([len(t) for _, t in rows], np.int64)
            ids = np.array([NO_ID if i is None else i for i, _ in rows], np.int64)
            return batch(SHARDS, [(task << 32) + number], [ids.tobytes()], [sizes.tobytes()], [data], [int(sizes.sum())])

        for b in batches:
            for row in zip(b.column("id").to_pylist(), texts(b.column("text"))):
                if rows and size + len(row[1]) > shard_bytes:
                    yield shard()
                    number, rows, size = number + 1, [], 0
                rows.append(row)
                size += len(row[1])
        if rows:
            yield shard()

    return docs.mapInArrow(take, SHARDS_SQL)


MESSAGE = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("shard", pa.int64())] + [(f"b{i}", pa.binary()) for i in range(4)])
MESSAGE_SQL = "kind int, bucket int, shard long, b0 binary, b1 binary, b2 binary, b3 binary"
ANCHORS, CONTEXTS, WINDOWS, PLAN = range(4)


def _message(kind: int, bucket: int, shard: int, *parts: bytes) -> tuple:
    return (kind, bucket, shard, *parts, *[b""] * (4 - len(parts)))


def _sent(messages: Iterator[tuple], most: int = 256, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Messages as record batches."""
    waiting, size = [], 0
    for message in messages:
        waiting.append(message)
        size += sum(map(len, message[3:]))
        if len(waiting) == most or size > most_bytes:
            yield batch(MESSAGE, *zip(*waiting))
            waiting, size = [], 0
    if waiting:
        yield batch(MESSAGE, *zip(*waiting))


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of hashes: sorted hashes are in the order of their buckets."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _stretches(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    heads = runs(bucket)
    for a, b in zip(heads, np.append(heads[1:], len(bucket))):
        yield int(bucket[a]), slice(int(a), int(b))


def _rows(batches: Iterator[pa.RecordBatch], at_once: int = 1) -> Iterator[dict]:
    for b in batches:
        for i in range(0, b.num_rows, at_once):
            yield from b.slice(i, at_once).to_pylist()


def _distinct_anchors(hashes: np.ndarray, ids: np.ndarray):
    """Different hashes, sorted; each row's place among them; how many rows have it; whether several documents do."""
    order = np.argsort(hashes, kind="stable")
    heads = runs(hashes[order])
    count = np.diff(np.append(heads, len(order)))
    place = np.empty(len(order), np.int64)
    place[order] = np.repeat(np.arange(len(heads)), count)
    low, high = (f.reduceat(ids[order], heads) if len(heads) else ids for f in (np.minimum, np.maximum))
    return hashes[order][heads], place, count, low != high


def _send_anchors(length: int, buckets: int):
    def send(batches):
        for row in _rows(batches):
            _, _, hashes, ids = Shard(row).anchored(length)
            hashes, _, count, several = _distinct_anchors(hashes, ids)
            marked = (np.minimum(count, 127) | several.astype(np.int64) << 7).astype(np.uint8)
            for bucket, mine in _stretches(_bucket(hashes, buckets)):
                yield _message(ANCHORS, bucket, row["shard"], short(hashes[mine]), marked[mine].tobytes())

    return lambda batches: _sent(send(batches))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], list[dict]]]:
    """All rows of a kind and bucket, which come sorted."""
    key, rows = None, []
    for r in _rows(batches, 64):
        if (r["kind"], r["bucket"]) != key:
            if rows:
                yield key, rows
            key, rows = (r["kind"], r["bucket"]), []
        rows.append(r)
    if rows:
        yield key, rows


def _compare_anchors(hot: int):
    """For each anchor sent: whether another document has it, and whether it is hot."""

    def compare(batches):
        for (_, bucket), rows in _groups(batches):
            parts = [lengthened(r["b0"]) for r in rows]
            hashes, marked = np.concatenate(parts), np.concatenate([np.frombuffer(r["b1"], np.uint8) for r in rows])
            order = np.argsort(hashes, kind="stable")
            heads = runs(hashes[order])
            senders = np.diff(np.append(heads, len(order)))
            count = np.add.reduceat((marked[order] & 127).astype(np.int64), heads)
            shared = (senders > 1) | (np.maximum.reduceat(marked[order], heads) > 127)
            state = np.empty((2, len(order)), bool)
            state[0, order] = np.repeat(shared, senders)
            state[1, order] = np.repeat(shared & (count >= hot), senders)
            ends = np.cumsum([len(p) for p in parts])
            for r, end, part in zip(rows, ends, parts):
                mine = state[:, end - len(part) : end]
                yield _message(ANCHORS, bucket, r["shard"], np.packbits(mine[0]).tobytes(), np.packbits(mine[1]).tobytes())

    return lambda batches: _sent(compare(batches))


def _by_shard(rows: DataFrame, purpose: str, files: int) -> DataFrame:
    """``rows`` computed once, as a table in the shared folder hashed by shard: two such tables meet without a shuffle."""
    path = scratch.folder(rows.sparkSession, purpose)
    name = f"areafacts_{purpose}_{path.rsplit('-', 1)[-1]}"
    rows.write.bucketBy(files, "shard").option("path", path).saveAsTable(name)
    return rows.sparkSession.table(name)


def _with_answers(shards: DataFrame, rows: DataFrame, how: str, files: int) -> DataFrame:
    """Shards with what came back for them (``answers``, in the order it was sent).

    Answers are bits and run lengths, a few hundredths of the text. Up to BROADCAST bytes they go to the shards; beyond,
    both are read by the hash of the shard they were stored by, so the text stays where it is.
    """
    answers = rows.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("kind", "bucket", "b0", "b1", "b2", "b3"))).alias("answers"))
    answers = _by_shard(answers, "answers", files)
    size = F.aggregate("answers", F.lit(0).cast("long"), lambda n, a: n + sum(F.length(a[f"b{i}"]) for i in range(4)))
    small = (answers.agg(F.sum(size)).first()[0] or 0) <= BROADCAST
    return shards.join(F.broadcast(answers) if small else answers, "shard", how)


def _aligned(bits: np.ndarray) -> np.ndarray:
    return -(-bits // 8) * 8


def _steps(count: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count, one after the other."""
    return np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)


def _send_contexts(length: int, buckets: int):
    def send(batches):
        press = zstandard.ZstdCompressor(level=3)
        for row in _rows(batches):
            shard = Shard(row)
            start, count, hashes, ids = shard.anchored(length)
            distinct, place, _, _ = _distinct_anchors(hashes, ids)
            state = np.zeros((2, len(distinct)), bool)
            answers = {a["bucket"]: (a["b0"], a["b1"]) for a in row["answers"]}
            for bucket, mine in _stretches(_bucket(distinct, buckets)):
                n = mine.stop - mine.start
                for i in (0, 1):
                    state[i, mine] = np.unpackbits(np.frombuffer(answers[bucket][i], np.uint8), count=n)
            shared, hot = state[0][place], state[1][place]
            plan, bit = [], 0

            cold = np.flatnonzero(shared & ~hot)
            cold = cold[np.argsort(hashes[cold], kind="stable")]
            if len(cold):
                begin, n, anchor, own = start[cold], count[cold], hashes[cold], ids[cold]
                end, offset, later = begin + n - 1 + length, np.empty(len(cold), np.int64), np.empty(len(cold), bool)
                for bucket, mine in _stretches(_bucket(anchor, buckets)):
                    # equal contexts have equal anchors, so they meet here and numbers by first sight are in the order of the hashes
                    index = Numbers()
                    number = np.array([index[shard.raw[a:b]] for a, b in zip(begin[mine].tolist(), end[mine].tolist())], np.int64)
                    least, of = np.full(len(index), NO_ID), np.empty(len(index), np.uint64)
                    np.minimum.at(least, number, own[mine])
                    of[number] = anchor[mine]
                    contexts = list(index)
                    sizes = np.array([len(c) for c in contexts], np.int64)
                    yield _message(CONTEXTS, bucket, row["shard"], short(of), pressed(sizes, least, contexts, press))
                    windows = sizes - length + 1
                    offset[mine] = (bit + np.cumsum(windows) - windows)[number]
                    later[mine] = own[mine] > least[number]
                    bit += int(_aligned(windows.sum()))
                plan.append((begin, n, offset, later))

            warm = np.flatnonzero(shared & hot)
            if len(warm):
                window = np.repeat(start[warm], count[warm]) + _steps(count[warm])
                own = np.repeat(ids[warm], count[warm])
                one, two = rolling(shard.data, length)[window], rolling(shard.data, length, 1)[window]
                order = np.lexsort((two, one))
                heads = np.flatnonzero(np.concatenate([[True], (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])]))
                number = np.empty(len(order), np.int64)
                number[order] = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(order))))
                least = np.minimum.reduceat(own[order], heads)
                one_, two_, offset = one[order][heads], two[order][heads], np.empty(len(heads), np.int64)
                for bucket, mine in _stretches(_bucket(one_, buckets)):
                    yield _message(WINDOWS, bucket, row["shard"], one_[mine].tobytes(), two_[mine].tobytes(), least[mine].tobytes())
                    offset[mine] = bit + np.arange(mine.stop - mine.start)
                    bit += int(_aligned(np.int64(mine.stop - mine.start)))
                plan.append((window, np.ones(len(window), np.uint16), offset[number], own > least[number]))
                del one, two, order, number, own, least, one_, two_, offset

            if plan:
                columns = [np.concatenate(c) for c in zip(*plan)]
                order = np.argsort(columns[0], kind="stable")
                squeeze = zstandard.ZstdCompressor(level=1).compress
                kinds = (np.int64, np.uint16, np.int64, np.uint8)
                stepped = [np.diff(c[order].astype(np.int64), prepend=0) if i in (0, 2) else c[order].astype(k) for i, (c, k) in enumerate(zip(columns, kinds))]
                yield _message(PLAN, row["shard"] % buckets, row["shard"], *[squeeze(c.tobytes()) for c in stepped])

    return lambda batches: _sent(send(batches))


def _earliest(text: np.ndarray, sizes: np.ndarray, sender: np.ndarray, least: np.ndarray, length: int) -> np.ndarray:
    """The earliest document of each window of each stretch (bytes after each other in ``text``), among all stretches.

    Runs of senders make at most PARTS transforms of about one size, however many senders there are; these are merged.
    """
    windows, begin = sizes - length + 1, np.cumsum(sizes) - sizes
    order = np.argsort(sender, kind="stable")
    symbols = np.cumsum(sizes[order] + 2)
    heads = runs(sender[order])
    heads = heads[runs((symbols[heads] - symbols[0]) * PARTS // symbols[-1])]
    parts, context, offset = [], [], []
    for a, b in zip(heads, np.append(heads[1:], len(order))):
        mine = order[a:b]
        parts.append(bwt.transform(text[np.repeat(begin[mine], sizes[mine]) + _steps(sizes[mine])], sizes[mine], length))
        context.append(np.repeat(mine, sizes[mine] + 2))
        offset.append(_steps(sizes[mine] + 2))
    source, rotation, interval = bwt.merge(parts, length)
    base = np.cumsum([0] + [len(p.at) for p in parts])[:-1]
    at = base[source] + rotation
    context, offset = np.concatenate(context)[at], np.concatenate(offset)[at]
    whole = offset < windows[context]  # rotations that run over a string's end are no windows
    context, offset, interval = context[whole], offset[whole], interval[whole]
    heads = runs(interval)
    out = np.empty(int(windows.sum()), np.int64)
    out[(np.cumsum(windows) - windows)[context] + offset] = np.repeat(np.minimum.reduceat(least[context], heads), np.diff(np.append(heads, len(interval))))
    return out


def _met(text: np.ndarray, sizes: np.ndarray, length: int) -> np.ndarray:
    """For each window of the contexts in ``text``: whether another has the same hash. Others have no equal here."""
    windows = sizes - length + 1
    hashes = rolling(text, length)[np.repeat(np.cumsum(sizes) - sizes, windows) + _steps(windows)]
    order = np.argsort(hashes)
    same = hashes[order][1:] == hashes[order][:-1]
    out = np.zeros(len(hashes), bool)
    out[order[1:][same]] = out[order[:-1][same]] = True
    return out


def _several(contexts: list[bytes], anchor: np.ndarray, by: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The earliest documents of the windows of contexts whose anchor has others; where each context's windows are there.

    Windows with no equal are told by their hashes; what is left of the contexts is merged, anchors whole.
    """
    sizes = np.array([len(c) for c in contexts], np.int64)
    windows = sizes - length + 1
    order = np.argsort(anchor, kind="stable")
    heads = runs(anchor[order])
    count = np.diff(np.append(heads, len(order)))
    order, count = order[np.repeat(count > 1, count)], count[count > 1]
    base = np.full(len(contexts), -1)
    base[order] = np.cumsum(windows[order]) - windows[order]
    out = np.repeat(first[order], windows[order])
    ends = np.cumsum(count)
    # a group of contexts is cut after the anchor that fills it
    upto = np.cumsum(sizes[order] + 2)[ends - 1] if len(ends) else ends
    stretches, waiting = [], 0

    def merge():
        text, at, size, sender, least = (np.concatenate(x) for x in zip(*stretches))
        count = size - length + 1
        out[np.repeat(at, count) + _steps(count)] = _earliest(text, size, sender, least, length)

    for a, b in _cuts(upto, MERGED):
        mine = order[ends[a] - count[a] : ends[b - 1]]
        text, size = np.frombuffer(b"".join([contexts[i] for i in mine]), np.uint8), sizes[mine]
        met = _met(text, size, length)
        # stretches of windows that are met, none across two contexts
        of = np.repeat(np.arange(len(mine)), windows[mine])
        here = np.flatnonzero(met)
        if not len(here):
            continue
        starts = runs(here - np.arange(len(here)) + of[here] * (len(met) + 1))
        n = np.diff(np.append(starts, len(here)))
        start = here[starts]
        of = of[start]
        size_ = n + length - 1
        # the byte a window starts with: each context before it has length - 1 more bytes than windows
        where = start + of * (length - 1)
        stretches.append((text[np.repeat(where, size_) + _steps(size_)], base[mine[0]] + start, size_, by[mine][of], first[mine][of]))
        waiting += int(size_.sum()) + 2 * len(size_)
        if waiting > MERGED:
            merge()
            stretches, waiting = [], 0
    if stretches:
        merge()
    return out, base


def _cuts(upto: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of items with running sum ``upto``, each closed by the item that takes it over ``most``."""
    a, n = 0, len(upto)
    while a < n:
        b = min(int(np.searchsorted(upto, (upto[a - 1] if a else 0) + most, side="right")) + 1, n)
        yield a, b
        a = b


def _compare_contexts(rows: list[dict], length: int) -> list[np.ndarray]:
    """For each row's contexts in order, for each window: whether an earlier document than the sender's has it."""
    index, expand = Numbers(), zstandard.ZstdDecompressor()
    anchors, numbers, sent = [], [], []
    for r in rows:
        anchors.append(lengthened(r["b0"]))
        sizes, own, text = expanded(r["b1"], len(anchors[-1]), expand)
        ends = np.cumsum(sizes)
        numbers.append(np.array([index[text[a:b]] for a, b in zip((ends - sizes).tolist(), ends.tolist())], np.int64))
        sent.append(own)
    number, anchor, own = np.concatenate(numbers), np.concatenate(anchors), np.concatenate(sent)
    sender = np.repeat(np.arange(len(rows)), [len(n) for n in numbers])
    contexts = list(index)
    first = np.full(len(contexts), NO_ID)
    np.minimum.at(first, number, own)
    of = np.empty(len(contexts), np.uint64)
    of[number] = anchor
    by = np.empty(len(contexts), np.int64)
    by[number[::-1]] = sender[::-1]  # the first to send it

    earliest, base = _several(contexts, of, by, first, length)
    windows = (np.array([len(c) for c in contexts], np.int64) - length + 1)[number]
    begin = np.cumsum(windows) - windows
    bits = np.repeat(first[number] < own, windows)
    open_ = np.flatnonzero(base[number] >= 0)
    for i in range(0, len(open_), 1 << 15):
        some = open_[i : i + (1 << 15)]
        n, step = windows[some], _steps(windows[some])
        bits[np.repeat(begin[some], n) + step] = earliest[np.repeat(base[number[some]], n) + step] < np.repeat(own[some], n)
    return np.split(bits, np.append(begin, len(bits))[np.cumsum([len(n) for n in numbers])[:-1]])


def _compare_windows(rows: list[dict]) -> list[np.ndarray]:
    one, two, own = (np.concatenate([np.frombuffer(r[c], t) for r in rows]) for c, t in (("b0", np.uint64), ("b1", np.uint64), ("b2", np.int64)))
    order = np.lexsort((two, one))
    heads = np.flatnonzero(np.concatenate([[True], (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])]))
    first = np.empty(len(order), np.int64)
    first[order] = np.repeat(np.minimum.reduceat(own[order], heads), np.diff(np.append(heads, len(order))))
    return np.split(first < own, np.cumsum([len(r["b0"]) // 8 for r in rows])[:-1])


def _decide(length: int):
    def decide(batches):
        for (kind, bucket), rows in _groups(batches):
            if kind == PLAN:  # what a shard needs to apply the answers goes back with them
                yield from ((kind, bucket, r["shard"], r["b0"], r["b1"], r["b2"], r["b3"]) for r in rows)
                continue
            found = _compare_contexts(rows, length) if kind == CONTEXTS else _compare_windows(rows)
            for r, bits in zip(rows, found):
                yield _message(kind, bucket, r["shard"], np.packbits(bits).tobytes())

    return lambda batches: _sent(decide(batches))


RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())]
)
RESULT_SQL = "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"


def _covered(row: dict, n: int, length: int) -> np.ndarray:
    """Which bytes of a shard a removed window covers."""
    if not row["answers"]:
        return np.zeros(n, bool)
    *decided, plan = row["answers"]  # by kind: the plan is the last
    bits = np.unpackbits(np.frombuffer(b"".join([a["b0"] for a in decided]), np.uint8)).astype(bool)
    expand = zstandard.ZstdDecompressor().decompress
    start, count, offset, later = (np.frombuffer(expand(plan[c]), t) for c, t in zip(("b0", "b1", "b2", "b3"), (np.int64, np.uint16, np.int64, np.uint8)))
    start, offset, count = np.cumsum(start), np.cumsum(offset), count.astype(np.int64)
    step = _steps(count)
    removed = bits[np.repeat(offset, count) + step] | np.repeat(later.astype(bool), count)
    at = (np.repeat(start, count) + step)[removed]
    change = np.bincount(at, minlength=n + 1) - np.bincount(at + length, minlength=n + 1)
    return np.cumsum(change[:n]) > 0


def _apply(length: int):
    def apply(batches):
        for row in _rows(batches):
            shard = Shard(row)
            covered = _covered(row, len(shard.data), length)
            inner = np.ones(len(covered), bool)
            begin = shard.ends - shard.sizes
            inner[begin[begin < len(covered)]] = False
            starts = np.flatnonzero(covered & ~(np.concatenate([[False], covered[:-1]]) & inner))
            last = np.ones(len(covered), bool)
            last[begin[(begin > 0)] - 1] = False
            ends = np.flatnonzero(covered & ~(np.concatenate([covered[1:], [False]]) & last)) + 1
            of = np.searchsorted(shard.ends, starts, side="right")
            spans = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(of, np.arange(len(begin) + 1)).astype(np.int32)),
                pa.StructArray.from_arrays([pa.array(starts - begin[of]), pa.array(ends - begin[of])], names=["start", "end"]),
            )
            kept, upto = shard.data[~covered].tobytes(), np.concatenate([[0], np.cumsum(~covered)])
            texts_ = [kept[a:b] for a, b in zip(upto[begin].tolist(), upto[shard.ends].tolist())]
            ids = pa.array(shard.ids, mask=shard.ids == NO_ID)
            whole = batch(RESULT, ids, shard.sizes, spans, texts_)
            for start in range(0, whole.num_rows, 1000):
                yield whole.slice(start, 1000)

    return apply


def dedup(docs: DataFrame, length: int = 50, id_column: str = "doc_id", text_column: str = "text", shard_bytes: int = SHARD, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, spans (removed bytes), kept (the rest): one row per row of ``docs``. ``length`` is even, 8 at least."""
    if length % 2 or length < 8:
        raise ValueError("the length is even, 8 at least")
    rows = docs.select(docs[f"`{id_column}`"].cast("long").alias("id"), docs[f"`{text_column}`"].alias("text"))
    files = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = _by_shard(pack(rows, shard_bytes), "shards", files)
    buckets = min(max(16, -(-shards.count() // SHARDS_A_BUCKET)), BUCKETS)

    def met(sent: DataFrame) -> DataFrame:
        return sent.repartition("kind", "bucket").sortWithinPartitions("kind", "bucket", "shard")

    anchors = shards.mapInArrow(_send_anchors(length, buckets), MESSAGE_SQL)
    known = met(anchors).mapInArrow(_compare_anchors(hot), MESSAGE_SQL)
    sent = _with_answers(shards, known, "inner", files).mapInArrow(_send_contexts(length, buckets), MESSAGE_SQL)
    back = met(sent).mapInArrow(_decide(length), MESSAGE_SQL)
    return _with_answers(shards, back, "left", files).mapInArrow(_apply(length), RESULT_SQL)
