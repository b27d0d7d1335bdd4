"""Language-model scores of whole texts: prediction by partial matching, and word counts beside it.

One pass over the training documents gathers, per task, the counts of byte contexts with their next byte and of words.
Both are merged by hashed bucket, so that memory is a bucket's share however large the corpus is; what the tasks send is
one row per bucket and task, and grows with the corpus. Contexts with the same last two bytes share a bucket, so that a
bucket has a context with all its shorter ones (those of one byte are broadcast). Contexts that make up 1/SHARED of all
positions (at most SHARED of each length) reach the driver, are made into probability tables and broadcast.

Scoring is a second pass. A position whose context of ORDER bytes has a table takes its code length from it. Words that
make up 1/HOT of all training words (HOT words at most) are broadcast with their counts. For all other positions and
words each batch of texts sends what it needs, with places and frequencies, to the buckets where the counts are, and
gets back one sum per text and bucket. So no word, however frequent, is a hot key, no word or context is left out, and no
vocabulary is held whole; buckets of contexts are uneven, as pairs of bytes are. That pass is written to the shared folder before it is read twice: a lost executor cannot make
its parts differ.

Defined cases: null text is empty; its only token is the end. Without training documents every score is that of an
untrained model (uniform bytes), train_tokens is 0 and the word score that of N = V = 0. Repeated rows are each scored
(and learned from). A null id counts as empty text for the fold. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areafacts.llm import ppm
from areafacts.llm.common import batch, stored, texts
from areafacts.llm.lattice import Numbers

# Bytes of text that a task works on at once (one text more, if it is longer), and counts it holds before it sends them.
AT_ONCE = 4_000_000
HELD = 2_000_000
HOT = 1 << 14
SHARED = 1 << 14
# More buckets would make a task's rows too many and too small; a bucket is held by one task at a time.
BUCKETS = 4096

GATHERED = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("n", pa.int64())])
GATHERED_SQL = "kind int, bucket int, keys binary, counts binary, n long"
# Kinds: contexts of 0, 1 and ORDER bytes, then words, then the number of documents.
WORDS, DOCUMENTS = ppm.ORDER + 1, ppm.ORDER + 2


@dataclass
class Model:
    trie: ppm.Trie | None
    vocabulary: DataFrame | None  # (bucket, words, counts)
    buckets: int
    tokens: int = 0
    distinct: int = 0
    ends: int = 0
    hot: dict[bytes, int] = field(default_factory=dict)
    contexts: DataFrame | None = None  # (kind, bucket, keys, counts)
    first: np.ndarray | None = None
    least: int = 1

    def log10(self, count):
        return np.log10((count + 0.1) / (self.tokens + 0.1 * (self.distinct + 1)))


def _chunks(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """Lower-cased texts with the other columns' values, about AT_ONCE bytes at a time."""
    rows, size = [], 0
    for b in batches:
        for row in zip(texts(b.column("text")), *[b.column(c).to_pylist() for c in columns]):
            if rows and size + len(row[0]) > AT_ONCE:
                yield tuple(zip(*rows))
                rows, size = [], 0
            rows.append((row[0].lower(), *row[1:]))
            size += len(row[0])
    if rows:
        yield tuple(zip(*rows))


def _bucket(word: bytes, buckets: int) -> int:
    return xxhash.xxh64_intdigest(word) % buckets


def _word_rows(words: dict[bytes, int], buckets: int) -> Iterator[pa.RecordBatch]:
    of = np.fromiter((_bucket(w, buckets) for w in words), np.int64, len(words))
    listed, counts = list(words), np.fromiter(words.values(), np.int64, len(words))
    order = np.argsort(of, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
        if len(part):
            yield batch(GATHERED, [WORDS], [of[part[0]]], [b" ".join([listed[i] for i in part])], [counts[part].tobytes()], [counts[part].sum()])


def _gram_bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    """By the last two bytes of the context."""
    return ((key >> np.uint64(8) & np.uint64(0xFFFF)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(buckets)


def _gram_rows(key: np.ndarray, count: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    for order in (ppm.ORDER, 1, 0):
        key, count = (key, count) if order == ppm.ORDER else ppm.shortened(key, count, order)
        of = _gram_bucket(key, buckets)
        by = np.argsort(of, kind="stable")
        for mine in np.split(by, np.flatnonzero(np.diff(of[by])) + 1):
            if len(mine):
                yield batch(GATHERED, [order], [int(of[mine[0]])], [key[mine].tobytes()], [count[mine].tobytes()], [count[mine].sum()])


def _gather(buckets: int):
    def gather(batches):
        held, size, words, n = [], 0, Counter(), 0
        for (rows,) in _chunks(batches):
            n += len(rows)
            held.append(ppm.grams(list(rows)))
            size += len(held[-1][0])
            if size > HELD:
                held = [ppm.merged(held)]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield from _gram_rows(*held[0], buckets)
                    held, size = [], 0
            for text in rows:
                words.update(text.split())
            if len(words) > HELD:
                yield from _word_rows(words, buckets)
                words = Counter()
        yield from _gram_rows(*ppm.merged(held), buckets)
        yield from _word_rows(words, buckets)
        yield batch(GATHERED, [DOCUMENTS], [0], [b""], [b""], [n])

    return gather


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], Iterator[dict]]]:
    """Rows, which come sorted by kind and bucket, one group after the other; a group's rows are read as they come."""
    rows = (r for b in batches for r in b.to_pylist())
    row = next(rows, None)
    while row is not None:
        key = (row["kind"], row["bucket"])

        def group():
            nonlocal row
            while row is not None and (row["kind"], row["bucket"]) == key:
                now = row
                yield now
                row = next(rows, None)

        yield key, group()
        while row is not None and (row["kind"], row["bucket"]) == key:
            row = next(rows, None)


def _merge_words(batches):
    for (_, bucket), rows in _by_bucket(batches):
        total: dict[bytes, int] = {}
        for r in rows:
            for w, n in zip(r["keys"].split(b" "), np.frombuffer(r["counts"], np.int64).tolist()):
                total[w] = total.get(w, 0) + n
        counts = np.fromiter(total.values(), np.int64, len(total))
        yield batch(GATHERED, [WORDS], [bucket], [b" ".join(total)], [counts.tobytes()], [len(total)])


def _merge_grams(batches):
    for (order, bucket), rows in _by_bucket(batches):
        parts, size = [], 0
        for r in rows:
            parts.append((np.frombuffer(r["keys"], np.uint64), np.frombuffer(r["counts"], np.int64)))
            size += len(parts[-1][0])
            if size > HELD and len(parts) > 8:
                parts = [ppm.merged(parts)]
                size = len(parts[0][0])
        key, count = ppm.merged(parts)
        if len(key):
            yield batch(GATHERED, [order], [bucket], [key.tobytes()], [count.tobytes()], [len(key)])


def _shared_grams(least: int):
    """Contexts of 0 and 1 bytes, and those of more that have ``least`` positions."""

    def shared(batches):
        for b in batches:
            for r in b.to_pylist():
                if r["kind"] < ppm.ORDER:
                    yield batch(GATHERED, *[[r[f.name]] for f in GATHERED])
                    continue
                key, count = np.frombuffer(r["keys"], np.uint64), np.frombuffer(r["counts"], np.int64)
                for order in range(ppm.ORDER, 1, -1):
                    key, count = ppm.shortened(key, count, order)
                    kept = ppm.frequent(key, count, least)
                    if kept.any():
                        yield batch(GATHERED, [order], [r["bucket"]], [key[kept].tobytes()], [count[kept].tobytes()], [0])

    return shared


def _grouped(rows: DataFrame) -> DataFrame:
    return rows.repartition("kind", "bucket").sortWithinPartitions("kind", "bucket")


def learn(docs: DataFrame, learnable: Column, text_column: str = "text") -> Model:
    """A model of the rows of ``docs`` where ``learnable`` holds."""
    rows = docs.where(learnable).select(docs[f"`{text_column}`"].alias("text"))
    buckets = min(max(16, rows.rdd.getNumPartitions()), BUCKETS)  # a bucket is about what a task has
    gathered = stored(rows.mapInArrow(_gather(buckets), GATHERED_SQL), "gathered")
    sums = {r["kind"]: r["n"] for r in gathered.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    ends = sums.get(DOCUMENTS, 0) or 0
    tokens = (sums.get(WORDS, 0) or 0) + ends
    positions = sums.get(ppm.ORDER, 0) or 0

    words = gathered.where(F.col("kind") == WORDS)
    vocabulary = stored(_grouped(words).mapInArrow(_merge_words, GATHERED_SQL), "vocabulary")
    distinct = (vocabulary.agg(F.sum("n")).first()[0] or 0) + (ends > 0)
    least = max(1, math.ceil(tokens / HOT))
    pair = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def hot(batches):
        for b in batches:
            for r in b.to_pylist():
                counts = np.frombuffer(r["counts"], np.int64)
                at = np.flatnonzero(counts >= least)
                listed = r["keys"].split(b" ") if len(at) else []
                yield batch(pair, [listed[i] for i in at], counts[at])

    frequent = {bytes(r["word"]): r["n"] for r in vocabulary.mapInArrow(hot, "word binary, n long").collect()}  # HOT words at most

    parts: list[list] = [[] for _ in range(ppm.ORDER + 1)]
    contexts = stored(_grouped(gathered.where(F.col("kind") <= ppm.ORDER)).mapInArrow(_merge_grams, GATHERED_SQL), "contexts")
    often = max(1, math.ceil(positions / min(ppm.NODES, SHARED)))
    for r in contexts.mapInArrow(_shared_grams(often), GATHERED_SQL).collect():  # SHARED contexts of each length at most
        parts[r["kind"]].append((np.frombuffer(r["keys"], np.uint64), np.frombuffer(r["counts"], np.int64)))
    trie = ppm.Trie.of([ppm.merged(p) for p in parts])
    contexts = contexts.where(F.col("kind") == ppm.ORDER)
    least = max(1, math.ceil(positions / ppm.NODES))
    return Model(trie, vocabulary, buckets, tokens, distinct, ends, frequent, contexts, trie.first, least)


PARTS = pa.schema(
    [("kind", pa.int32()), ("bucket", pa.int32()), ("batch", pa.int64()), ("n", pa.int64())]
    + [(c, pa.binary()) for c in ("keys", "counts", "places", "times")]
    + [("ids", pa.list_(pa.int64())), ("scores", pa.list_(pa.float64()))]
    + [(c, pa.list_(pa.int64())) for c in ("tokens", "known")]
    + [("base", pa.list_(pa.float64()))]
)
PARTS_SQL = (
    "kind int, bucket int, batch long, n long, keys binary, counts binary, places binary, times binary, "
    "ids array<long>, scores array<double>, tokens array<long>, known array<long>, base array<double>"
)
VOCABULARY, PLACES, TEXTS, SUMS, CONTEXTS, GRAMS = range(6)


def _part(**values) -> pa.RecordBatch:
    return batch(PARTS, *[[values.get(f.name)] for f in PARTS])


def _narrow(values: np.ndarray) -> bytes:
    """The smallest unsigned type that holds the values, and they."""
    kind = np.min_scalar_type(int(values.max()) if len(values) else 0)
    return kind.char.encode() + values.astype(kind).tobytes()


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.dtype(data[:1].decode()), offset=1).astype(np.int64)


def _packed(key: np.ndarray) -> bytes:
    """The bytes of each place together: sorted keys have long runs of equal ones."""
    return key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : ppm.ORDER + 1].T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(ppm.ORDER + 1, -1)
    return sum(p.astype(np.uint64) << np.uint64(8 * i) for i, p in enumerate(planes))


def _gram_places(key: np.ndarray, place: np.ndarray, n: int, buckets: int, at: int) -> Iterator[pa.RecordBatch]:
    """What a batch's texts need of each bucket: contexts with symbols, the texts that have them, how often."""
    own, which = np.unique(key, return_inverse=True)
    pair, times = ppm.summed(np.sort(which * n + place), None)
    which, place = pair // n, pair % n
    each = np.bincount(which, minlength=len(own))
    start = np.cumsum(each) - each
    of = _gram_bucket(own, buckets)
    by = np.argsort(of, kind="stable")
    for mine in np.split(by, np.flatnonzero(np.diff(of[by])) + 1):
        if len(mine):
            size = each[mine]
            pairs = np.arange(size.sum()) + np.repeat(start[mine] - (np.cumsum(size) - size), size)
            yield _part(
                kind=GRAMS, bucket=int(of[mine[0]]), batch=at, n=n, keys=_packed(own[mine]),
                counts=_narrow(size), places=_narrow(place[pairs]), times=_narrow(times[pairs]),
            )


def _score(shared):
    def score(batches):
        model, task, number = shared.value, TaskContext.get().partitionId(), 0
        hot = {w: model.log10(n) for w, n in model.hot.items()}
        for rows, ids in _chunks(batches, "id"):
            index = Numbers()
            words = [np.fromiter(map(index.__getitem__, t.split()), np.int64) for t in rows]
            sizes = np.array([len(w) for w in words], np.int64)
            key = np.repeat(np.arange(len(rows)), sizes) + np.concatenate(words) * len(rows)
            key, times = ppm.summed(np.sort(key), None)
            word, place = key // len(rows), key % len(rows)
            listed = list(index)
            value = np.array([hot.get(w, np.nan) for w in listed])[word] if listed else np.zeros(0)
            here = ~np.isnan(value)
            base = np.bincount(place[here], value[here] * times[here], len(rows)) + model.log10(model.ends)
            known = np.bincount(place[here], times[here], len(rows)).astype(np.int64) + (model.ends > 0)
            at, number = (task << 32) + number, number + 1
            data, positions, first, node, whole = model.trie.reached(list(rows))
            scores = np.add.reduceat(np.where(whole, model.trie.of_symbols(node, data[positions]), 0.0), first)
            others = np.flatnonzero(~whole)
            owner = np.searchsorted(first, others, side="right") - 1
            yield from _gram_places(ppm.keyed(data, positions[others]), owner, len(rows), model.buckets, at)
            yield _part(
                kind=TEXTS, bucket=-1, batch=at, n=len(rows), ids=list(ids), scores=scores,
                tokens=sizes + 1, known=known, base=base,
            )
            word, place, times = word[~here], place[~here], times[~here]
            heads = np.flatnonzero(np.diff(word, prepend=-1))
            of = np.array([_bucket(listed[w], model.buckets) for w in word[heads]], np.int64)
            each = np.diff(np.append(heads, len(word)))
            for b in np.unique(of):
                mine = np.flatnonzero(of == b)
                pairs = np.flatnonzero(np.repeat(of == b, each))
                yield _part(
                    kind=PLACES, bucket=int(b), batch=at, n=len(rows), keys=b" ".join([listed[w] for w in word[heads[mine]]]),
                    counts=_narrow(each[mine]), places=_narrow(place[pairs]), times=_narrow(times[pairs]),
                )

    return score


def _look_up(shared):
    """A bucket's vocabulary, then the places of its words, its contexts, theirs: a sum for each batch of texts."""

    def look_up(batches):
        model, nothing = shared.value, ppm.Counted(*ppm.merged([]), shared.value.first)
        bucket, counts, contexts = None, {}, nothing
        for b in batches:
            for r in b.to_pylist():
                if r["bucket"] != bucket:
                    bucket, counts, contexts = r["bucket"], {}, nothing
                if r["kind"] == CONTEXTS:
                    counts = {}
                    key, count = np.frombuffer(r["keys"], np.uint64), np.frombuffer(r["counts"], np.int64)
                    contexts = ppm.Counted(key, count, model.first, model.least)
                    continue
                if r["kind"] == GRAMS:
                    each, place, times = _wide(r["counts"]), _wide(r["places"]), _wide(r["times"])
                    value = np.repeat(np.log10(contexts.probability(_unpacked(r["keys"]))), each) * times
                    yield _part(kind=SUMS, bucket=-1, batch=r["batch"], n=r["n"], scores=np.bincount(place, value, r["n"]))
                    continue
                if r["kind"] == VOCABULARY:
                    counts |= zip(r["keys"].split(b" "), np.frombuffer(r["counts"], np.int64).tolist())
                    continue
                found = np.array([counts.get(w, 0) for w in r["keys"].split(b" ")], np.int64)
                each, place, times = _wide(r["counts"]), _wide(r["places"]), _wide(r["times"])
                value = np.repeat(model.log10(found), each) * times
                known = np.bincount(place, np.repeat(found > 0, each) * times, r["n"]).astype(np.int64)
                yield _part(kind=SUMS, bucket=-1, batch=r["batch"], n=r["n"], known=known, base=np.bincount(place, value, r["n"]))

    return look_up


RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64())]
    + [("base_score", pa.float64()), ("score", pa.float64())]
)
RESULT_SQL = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _put_together(tokens: int):
    """A batch's texts, then the sums that came back for it."""

    def finish(texts_, known, base, scores):
        n = len(texts_["ids"])
        return batch(RESULT, texts_["ids"], texts_["tokens"], known, np.full(n, tokens), base, scores)

    def put_together(batches):
        texts_, known, base, scores = None, None, None, None
        for b in batches:
            for r in b.to_pylist():
                if r["kind"] == TEXTS:
                    if texts_ is not None:
                        yield finish(texts_, known, base, scores)
                    texts_, known, base, scores = r, np.array(r["known"], np.int64), np.array(r["base"]), np.array(r["scores"])
                elif r["scores"] is not None:
                    scores = scores + np.array(r["scores"])
                else:
                    known, base = known + np.array(r["known"], np.int64), base + np.array(r["base"])
        if texts_ is not None:
            yield finish(texts_, known, base, scores)

    return put_together


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score: one row per row of ``docs``."""
    spark = docs.sparkSession
    light = Model(model.trie, None, model.buckets, model.tokens, model.distinct, model.ends, model.hot)
    shared = spark.sparkContext.broadcast(light)
    rows = docs.select(docs[f"`{id_column}`"].cast("long").alias("id"), docs[f"`{text_column}`"].alias("text"))
    parts = stored(rows.mapInArrow(_score(shared), PARTS_SQL), "parts")
    places = parts.where(F.col("kind").isin(PLACES, GRAMS))
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in parts.schema.fields]
    vocabulary, contexts = (
        df.select(F.lit(kind).alias("kind"), "bucket", F.lit(0).cast("long").alias("batch"), "n", "keys", "counts", *nothing[6:])
        for df, kind in ((model.vocabulary, VOCABULARY), (model.contexts, CONTEXTS))
    )
    small = spark.sparkContext.broadcast(
        Model(None, None, 0, model.tokens, model.distinct, model.ends, first=model.first, least=model.least)
    )
    sums = (
        vocabulary.unionByName(contexts).unionByName(places).repartition("bucket").sortWithinPartitions("bucket", "kind").mapInArrow(_look_up(small), PARTS_SQL)
    )
    both = parts.where(F.col("kind") == TEXTS).select("kind", "batch", "ids", "scores", "tokens", "known", "base").unionByName(
        sums.select("kind", "batch", "known", "base", "scores"), allowMissingColumns=True
    )
    return both.repartition("batch").sortWithinPartitions("batch", "kind").mapInArrow(_put_together(model.tokens), RESULT_SQL)
