"""Toxic spans and document scores by a linear-chain conditional random field.

Labels are of documents, so token labels are derived first: over all labelled training documents the toxic and the
other documents that hold a word, or a word with a certain beginning (inflected words share no more than their stem),
are counted; a word of a toxic document is a toxic token if its odds or a beginning's are high. Listed are the words and
beginnings that SUPPORT of the toxic documents hold, whatever their odds, and of all others, however rare, those whose odds
are high and significant. The field is trained on a bounded sample of token windows (SAMPLE documents of each label, WINDOWS windows
each); its features are the word, its ends, its odds, and those of its neighbours. Whole texts are tagged in chains of
CHAIN tokens. Forward-backward marginals are aggregated (largest, sum, share) to a document score by a logistic
regression on the same sample; tokens with a marginal of a half or more are the offending spans.

Counting is pre-aggregated per task, tagging is a narrow pass. Broadcast: the weights (2^16), the listed words (the LISTED
most frequent; with more, the texts' words are joined to the others), and up to BROADCAST labels; with more labels, the
texts are shuffled to them once.

Defined cases: null text is empty; an empty text has the score of a text without a suspicious token. Several labels of a
document count as toxic if one is; null labels and labels without a document are ignored. If one of the two labels does
not occur, every score is the share of toxic labels (0 without labels). Repeated rows are each scored. Extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import ChainMap
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areafacts.llm import crf
from areafacts.llm.common import batch, smallest, stored, texts

SUPPORT = 0.02
# Log odds that make a word of a toxic document a toxic token, counting PRIOR documents more in the usual proportion.
ODDS = 2.5
PRIOR = 5.0
# What a rare key needs besides: LEAST toxic documents, and a log-likelihood ratio (G) of four standard deviations.
LEAST = 2
SIGNIFICANT = 16.0
# Keys that are broadcast (tens of megabytes).
LISTED = 500_000
STEMS = (3, 4, 5, 6)
# Bounds of the training sample.
SAMPLE = 1000
WINDOWS = 4
CHAIN = 64
ROUNDS = 60
WEIGHTS = 1 << 16
SEED = 5
CACHED = 400_000
# Labelled documents up to which the labels are sent to the texts (tens of megabytes), not the texts shuffled to them.
BROADCAST = 1_000_000

# Letters in lower case; other ASCII, which no word holds, as space: offsets stay the same.
PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 or b == 39 else 32 for b in range(256)
)


def tokens(text: bytes) -> list[bytes]:
    return text.translate(PLAIN).split()


def keys(word: bytes) -> list[bytes]:
    """The word and its beginnings of STEMS bytes, which are marked."""
    return [word, *[word[:n] + b"*" for n in STEMS if len(word) > n]]


def level(word: bytes, odds: Mapping[bytes, float]) -> float | None:
    """The highest odds of a word's keys."""
    return max((odds[k] for k in keys(word) if k in odds), default=None)


@dataclass
class Model:
    prior: float
    odds: dict[bytes, float] = field(default_factory=dict)
    field: crf.Field | None = None
    pooling: np.ndarray | None = None
    rare: DataFrame | None = None  # (word, odds): listed keys that are not in ``odds``

    def words(self) -> Words:
        return Words(self)


def word_features(word: bytes, odds: Mapping[bytes, float]) -> tuple[list[int], list[int], list[int]]:
    """Hashed features of a word for itself, for the token after it and for the token before it."""
    known = level(word, odds)
    odd = b"none" if known is None else b"%d" % round(min(max(known, -4), 8))

    def number(*parts: bytes) -> int:
        return xxhash.xxh64_intdigest(b"\0".join(parts), SEED) % WEIGHTS

    own = [number(b"w", word), number(b"p", word[:4]), number(b"s", word[-3:]), number(b"o", odd), number(b"bias")]
    return own, [number(b"-w", word), number(b"-o", odd)], [number(b"+w", word), number(b"+o", odd)]


class Words(dict):
    """word -> row of ``scores`` (own, for the token after, for the token before); filled as words are met."""

    def __init__(self, model: Model):
        self.model, self.rows = model, []
        self.odds: Mapping[bytes, float] = model.odds
        self.weights = model.field.weights.tolist() if model.field else []

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self.rows)
        self.rows.append([sum([self.weights[i] for i in f]) for f in word_features(word, self.odds)])
        return found

    def take_in(self, own: pa.Array) -> None:
        """Odds that come with the next documents; a word's come with every document that holds it."""
        if own.null_count < len(own):
            self.odds = _more(self.model.odds, own)

    def chains(self, docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores and live positions [time, chain] of all documents' chains, and each chain's document."""
        if len(self) > CACHED:
            self.clear()
            self.rows = []
        lengths = np.array([len(d) for d in docs])
        ids = np.array([i for d in docs for i in map(self.__getitem__, d)], np.int64)
        table = np.array(self.rows or [[0.0, 0.0, 0.0]])
        scores = table[ids, 0]
        first = np.zeros(len(ids) + 1, bool)
        first[np.concatenate([[0], np.cumsum(lengths)])] = True
        inner = ~first[1:-1] if len(ids) else np.empty(0, bool)
        scores[1:] += table[ids[:-1], 1] * inner
        scores[:-1] += table[ids[1:], 2] * inner
        n_chains = -(-lengths // CHAIN)
        of = np.repeat(np.arange(len(docs)), n_chains)
        within = np.arange(len(of)) - np.repeat(np.cumsum(n_chains) - n_chains, n_chains)
        start = np.repeat(np.cumsum(lengths) - lengths, n_chains) + within * CHAIN
        size = np.minimum(CHAIN, lengths[of] - within * CHAIN)
        at = np.arange(CHAIN)[:, None]
        live = at < size
        return np.where(live, scores[np.minimum(start + at, max(len(ids) - 1, 0))], 0) if len(of) else np.zeros((CHAIN, 0)), live, of


def tag(words: Words, docs: list[list[bytes]]) -> list[np.ndarray]:
    """Marginals of every token of every document."""
    scores, live, of = words.chains(docs)
    p = crf.marginals(scores, live, words.model.field.pairs).T[live.T]
    return np.split(p, np.cumsum([len(d) for d in docs])[:-1]) if docs else []


def pooled(p: np.ndarray) -> list[float]:
    """What the document score is made of: largest marginal (log odds), expected toxic tokens, their share."""
    if not len(p):
        return [1.0, -8.0, 0.0, 0.0]
    top = min(max(float(p.max()), 1e-6), 1 - 1e-6)
    total = float(p.sum())
    return [1.0, max(math.log(top / (1 - top)), -8.0), math.log1p(total), total / len(p)]


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton steps with a ridge; both labels weigh the same."""
    w = np.zeros(x.shape[1])
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
    ridge = np.diag([0.01, 1.0, 1.0, 1.0])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (share * (p - y)) + ridge @ w
        w -= np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + ridge, grad)
    return w


def document_labels(labels: DataFrame, id_column: str, toxic_column: str) -> DataFrame:
    rows = labels.select(labels[f"`{id_column}`"].cast("long").alias("id"), labels[f"`{toxic_column}`"].cast("int").alias("toxic"))
    return rows.where("id is not null and toxic in (0, 1)").groupBy("id").agg(F.max("toxic").alias("toxic"))


def _held_by(rows: DataFrame) -> DataFrame:
    """(word, n, other): toxic and other documents that hold a key, counted in the tasks first."""
    out = pa.schema([("word", pa.binary()), ("n", pa.int64()), ("other", pa.int64())])

    def count(batches):
        held: tuple[dict[bytes, int], dict[bytes, int]] = ({}, {})

        def sent():
            other, toxic = held
            yield batch(out, list(toxic), list(toxic.values()), [0] * len(toxic))
            yield batch(out, list(other), [0] * len(other), list(other.values()))
            other.clear()
            toxic.clear()

        for b in batches:
            for text, toxic in zip(texts(b.column("text")), b.column("toxic").to_pylist()):
                counts = held[toxic]
                for k in {k for w in set(tokens(text)) for k in keys(w)}:
                    counts[k] = counts.get(k, 0) + 1
                if len(held[0]) + len(held[1]) > CACHED:
                    yield from sent()
        yield from sent()

    found = rows.select("text", "toxic").mapInArrow(count, "word binary, n long, other long")
    return found.groupBy("word").agg(F.sum("n").alias("n"), F.sum("other").alias("other"))


def word_odds(rows: DataFrame, n_toxic: int, n_other: int) -> tuple[dict[bytes, float], DataFrame | None]:
    """Log odds of the listed keys, counted over all rows (text, toxic): the most frequent, and a table of the others."""
    share = n_toxic / (n_toxic + n_other)
    usual = math.log(share / (1 - share))
    n, other = F.col("n"), F.col("other")
    odds = F.log((n + PRIOR * share) / (other + PRIOR * (1 - share))) - usual
    ratio = 2 * (n * F.log(n / ((n + other) * share)) + F.when(other > 0, other * F.log(other / ((n + other) * (1 - share)))).otherwise(0.0))
    common = n >= max(LEAST, math.ceil(SUPPORT * n_toxic))
    held = _held_by(rows).where(n >= LEAST).withColumn("odds", odds)
    listed = stored(held.where(common | ((F.col("odds") >= ODDS) & (ratio >= SIGNIFICANT))).select("word", "n", "odds"), "listed")
    so_far, least = 0, 0
    for r in sorted(listed.groupBy("n").count().collect(), reverse=True):  # different counts: their sum bounds them
        so_far += r["count"]
        if so_far > LISTED:
            least = r["n"] + 1
            break
    sent = {bytes(r["word"]): r["odds"] for r in listed.where(n >= least).collect()}
    return sent, listed.where(n < least).select("word", "odds") if least else None


OWN = "array<struct<word:binary,odds:double>>"


def _with_own(rows: DataFrame, odds: dict[bytes, float], rare: DataFrame | None) -> DataFrame:
    """``rows`` with ``own``: the odds of a text's keys that are in ``rare``."""
    if rare is None:
        return rows.withColumn("own", F.lit(None).cast(OWN))
    shared = rows.sparkSession.sparkContext.broadcast(odds)
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "numbered")
    out = pa.schema([("row", pa.int64()), ("word", pa.binary())])

    def held(batches):
        sent = shared.value
        for b in batches:
            for row, text in zip(b.column("row").to_pylist(), texts(b.column("text"))):
                found = [k for k in {k for w in set(tokens(text)) for k in keys(w)} if k not in sent]
                yield batch(out, [row] * len(found), found)

    found = rows.select("row", "text").mapInArrow(held, "row long, word binary").join(rare, "word")
    own = found.groupBy("row").agg(F.collect_list(F.struct("word", "odds")).alias("own"))
    return rows.join(own, "row", "left").drop("row")


def _more(odds: dict[bytes, float], own: pa.Array) -> Mapping[bytes, float]:
    return ChainMap({r["word"]: r["odds"] for listed in own.to_pylist() for r in listed or ()}, odds)


def is_bad(word: bytes, odds: Mapping[bytes, float]) -> bool:
    found = level(word, odds)
    return found is not None and found >= ODDS


def _windows(rows: DataFrame, odds: Mapping[bytes, float]) -> DataFrame:
    """(toxic, tokens): the chains of each document with most toxic tokens, and some others."""
    out = pa.schema([("toxic", pa.int32()), ("tokens", pa.list_(pa.binary()))])
    shared = rows.sparkSession.sparkContext.broadcast(odds)

    def take(batches):
        for b in batches:
            odds = _more(shared.value, b.column("own"))
            for text, toxic in zip(texts(b.column("text")), b.column("toxic").to_pylist()):
                words = tokens(text)
                chains = [words[i : i + CHAIN] for i in range(0, len(words), CHAIN)]
                mixed = sorted(chains, key=lambda c: xxhash.xxh64_intdigest(b" ".join(c), SEED))
                worst = sorted(mixed, key=lambda c: -sum(is_bad(w, odds) for w in c))
                kept = worst[: WINDOWS // 2] + mixed[: WINDOWS - WINDOWS // 2]
                yield batch(out, [toxic] * len(kept), kept)

    return rows.select("text", "toxic", "own").mapInArrow(take, "toxic int, tokens array<binary>")


def learn(
    docs: DataFrame,
    labels: DataFrame,
    learnable: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    toxic_column: str = "toxic",
) -> Model:
    """A model from the labels of the rows of ``docs`` where ``learnable`` holds."""
    spark = docs.sparkSession
    of_docs = document_labels(labels, id_column, toxic_column)
    rows = docs.where(learnable).select(docs[f"`{id_column}`"].cast("long").alias("id"), docs[f"`{text_column}`"].alias("text"))
    if of_docs.count() <= BROADCAST:
        of_docs = F.broadcast(of_docs)
    rows = stored(rows.join(of_docs, "id"), "labelled")  # texts are shuffled here only, and only for more labels
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_toxic, n_other = n.get(1, 0), n.get(0, 0)
    prior = n_toxic / max(n_toxic + n_other, 1)
    if not n_toxic or not n_other:
        return Model(prior)
    odds, rare = word_odds(rows, n_toxic, n_other)

    ranked = rows.select("id", "toxic", F.xxhash64(F.lit(SEED), "id").alias("rank")).distinct()
    ids = smallest(ranked, "toxic", ["rank", "id"], SAMPLE).select("id").collect()
    chosen = spark.createDataFrame([(r["id"],) for r in ids], "id long").hint("broadcast")  # 2 * SAMPLE ids
    sample = _with_own(rows.join(chosen, "id").dropDuplicates(["id"]).select("text", "toxic"), odds, rare)
    chains = sorted((r["toxic"], [bytes(w) for w in r["tokens"]]) for r in _windows(sample, odds).collect())
    own = sample.select(F.explode("own").alias("own")).select("own.*").distinct().collect() if rare is not None else []
    known = ChainMap({bytes(r["word"]): r["odds"] for r in own}, odds)  # of 2 * SAMPLE documents at most
    model = Model(prior, odds, _fit([c for _, c in chains], [t for t, _ in chains], known))

    shared = spark.sparkContext.broadcast(model)

    def pool(batches):
        for b in batches:
            words = shared.value.words()
            words.take_in(b.column("own"))
            p = tag(words, [tokens(t) for t in texts(b.column("text"))])
            values = [pooled(x) for x in p]
            yield batch(pooled_schema, b.column("toxic"), values)

    pooled_schema = pa.schema([("toxic", pa.int32()), ("x", pa.list_(pa.float64()))])
    found = sorted((r["toxic"], r["x"]) for r in sample.mapInArrow(pool, "toxic int, x array<double>").collect())
    pooling = _logistic(np.array([x for _, x in found]), np.array([y for y, _ in found], float))
    return replace(model, pooling=pooling, rare=rare)


def _fit(chains: list[list[bytes]], toxic: list[int], odds: Mapping[bytes, float]) -> crf.Field:
    cached = {w: word_features(w, odds) for w in {w for c in chains for w in c} | {b""}}
    edge, bad = cached[b""], {w for w in cached if is_bad(w, odds)}
    numbers = np.zeros((CHAIN, len(chains), 9), np.int32)
    live, labels = np.zeros((CHAIN, len(chains)), bool), np.zeros((CHAIN, len(chains)), int)
    unused = xxhash.xxh64_intdigest(b"edge", SEED) % WEIGHTS
    for i, chain in enumerate(chains):
        for t, w in enumerate(chain):
            before = cached[chain[t - 1]][1] if t else [unused] * len(edge[1])
            after = cached[chain[t + 1]][2] if t + 1 < len(chain) else [unused] * len(edge[2])
            numbers[t, i] = cached[w][0] + before + after
            live[t, i], labels[t, i] = True, toxic[i] == 1 and w in bad
    fitted = crf.train(numbers, live, labels, WEIGHTS, ROUNDS, 0.2, 1e-5)
    fitted.weights[unused] = 0.0
    return fitted


def _offsets(text: bytes, flagged: np.ndarray) -> str:
    """start:end (code points) of the flagged tokens, neighbours joined."""
    plain = np.frombuffer(text.translate(PLAIN), np.uint8)
    word = np.concatenate([[False], plain != 32, [False]])
    starts, ends = np.flatnonzero(word[1:] & ~word[:-1]), np.flatnonzero(word[:-1] & ~word[1:])
    point = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    at = np.flatnonzero(flagged)
    heads = at[np.concatenate([[True], at[1:] != at[:-1] + 1])]
    tails = at[np.concatenate([at[1:] != at[:-1] + 1, [True]])]
    return ",".join(f"{point[starts[a]]}:{point[ends[b]]}" for a, b in zip(heads, tails))


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, score, predicted, toxic_spans: one row per row of ``docs``."""
    rows = docs.select(docs[f"`{id_column}`"].cast("long").alias("id"), docs[f"`{text_column}`"].alias("text"))
    rows = _with_own(rows, model.odds, model.rare)
    shared = docs.sparkSession.sparkContext.broadcast(replace(model, rare=None))
    out = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32()), ("toxic_spans", pa.string())])

    def take(batches):
        words = shared.value.words()
        for b in batches:
            for start in range(0, b.num_rows, 256):
                part = b.slice(start, 256)
                data = texts(part.column("text"))
                if words.model.pooling is None:
                    prior = words.model.prior
                    yield batch(out, part.column("id"), [prior] * len(data), [int(prior >= 0.5)] * len(data), [""] * len(data))
                    continue
                words.take_in(part.column("own"))
                p = tag(words, [tokens(t) for t in data])
                odds = np.array([pooled(x) for x in p]) @ words.model.pooling
                scores = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
                spans = [_offsets(t, x >= 0.5) if len(x) and x.max() >= 0.5 else "" for t, x in zip(data, p)]
                yield batch(out, part.column("id"), scores, (scores >= 0.5).astype(np.int32), spans)

    return rows.mapInArrow(take, "doc_id long, score double, predicted int, toxic_spans string")
