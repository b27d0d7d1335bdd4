"""Language identification by a recurrent network over bytes.

The network (see ``gru``) is trained on the driver from a bounded sample: SAMPLE different texts of each language, chosen
by the hash of the text, one stretch of STRETCH characters each, cut into windows. Every document is then labelled whole:
its bytes are cut into windows of WINDOW bytes, every position gets label probabilities, and the mean over all positions
is the document's. Labelling is one narrow pass; windows of many documents are stepped together, so memory is bounded by
LANES windows however long a text is. The broadcast network has 512 * 3 * HIDDEN numbers and a few more.

Defined cases: null text and text without a letter is ``und`` with score 0; so is every text if no row has a language to
learn. Repeated rows are each labelled. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areafacts.llm import gru
from areafacts.llm.common import batch, smallest, texts

UNKNOWN = "und"
# Bounds of the training sample, for each language.
SAMPLE = 300
STRETCH = 400
WINDOW = 64
LANES = 4096
HIDDEN = 8
ROUNDS = 400
SEED = 11


@dataclass
class Model:
    languages: list[str]
    network: gru.Network | None


def learn(
    docs: DataFrame, learnable: Column, text_column: str = "text", lang_column: str = "lang", sample: int = SAMPLE, rounds: int = ROUNDS
) -> Model:
    """A network for the languages of the rows where ``learnable`` holds and both text and language are given."""
    text, lang = docs[f"`{text_column}`"], docs[f"`{lang_column}`"]
    rank = F.xxhash64(F.lit(SEED), text)
    start = F.pmod(rank, F.greatest(F.length(text) - STRETCH, F.lit(1))) + 1
    rows = docs.where(learnable & text.rlike(r"\p{L}") & lang.isNotNull()).select(
        lang.alias("lang"), rank.alias("rank"), F.substring(text, start.cast("int"), F.lit(STRETCH)).alias("stretch")
    )
    chosen = smallest(rows.distinct(), "lang", ["rank", "stretch"], sample).collect()
    chosen = sorted((r["lang"], r["rank"], r["stretch"]) for r in chosen)
    languages = sorted({r[0] for r in chosen})
    if len(languages) < 2:
        return Model(languages, None)
    windows, labels = [], []
    for name, _, stretch in chosen:
        data = stretch.encode()
        windows += [data[i : i + WINDOW] for i in range(0, len(data), WINDOW)]
        labels += [languages.index(name)] * -(-len(data) // WINDOW)
    # every language weighs the same, however much text its sample has
    each = np.bincount(labels, minlength=len(languages))
    rng = np.random.default_rng(SEED)
    order = np.concatenate([rng.choice(np.flatnonzero(np.array(labels) == k), each.max()) for k in range(len(languages))])
    network = gru.train([windows[i] for i in order], np.array(labels)[order], len(languages), HIDDEN, rounds, 96, 0.03, SEED)
    return Model(languages, network)


def _cut(rows: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """(document, bytes [time, lane], live or None) of all windows of some documents; at most LANES windows at once."""
    tails: list[tuple[int, bytes]] = []
    whole: list[tuple[int, bytes]] = []
    waiting = 0

    def stack(parts):
        of = np.concatenate([np.full(len(p) // WINDOW, i) for i, p in parts])
        data = np.frombuffer(b"".join(p for _, p in parts), np.uint8).reshape(-1, WINDOW)
        return of, np.ascontiguousarray(data.T), None

    for i, data in enumerate(rows):
        end = len(data) // WINDOW * WINDOW
        if end < len(data):
            tails.append((i, data[end:]))
        for start in range(0, end, LANES * WINDOW):
            part = data[start : min(end, start + LANES * WINDOW)]
            if waiting + len(part) > LANES * WINDOW:
                yield stack(whole)
                whole, waiting = [], 0
            whole.append((i, part))
            waiting += len(part)
    if whole:
        yield stack(whole)
    for start in range(0, len(tails), LANES):
        part = tails[start : start + LANES]
        yield (np.array([i for i, _ in part]), *gru.padded([t for _, t in part]))


def pooled(network: gru.Network, rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """[document, label] sums over all positions of probabilities, and of positions that carry the label."""
    n_labels = network.parameters["W"].shape[1]
    total, carried = np.zeros((len(rows), n_labels)), np.zeros((len(rows), n_labels))
    for of, window, live in _cut(rows):
        p = gru.probabilities(network, window, live)
        top = p == p.max(axis=2, keepdims=True)
        if live is not None:
            p, top = p * live[:, :, None], top * live[:, :, None]
        np.add.at(total, of, p.sum(axis=0))
        np.add.at(carried, of, top.sum(axis=0))
    return total, carried


def _labelled(model: Model, rows: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Language, score, positions and share of positions of each text; empty stands for text without a letter."""
    sizes = np.array([len(t) for t in rows], np.int64)
    if model.network is None:
        names = [model.languages[0] if model.languages and n else UNKNOWN for n in sizes]
        known = np.array([float(name != UNKNOWN) for name in names])
        return names, known, sizes, known
    total, carried = pooled(model.network, rows)
    best, at, n = total.argmax(axis=1), np.arange(len(rows)), np.maximum(sizes, 1)
    names = [model.languages[k] if size else UNKNOWN for k, size in zip(best, sizes)]
    return names, np.clip(total[at, best] / n, 0, 1), sizes, np.clip(carried[at, best] / n, 0, 1)


def _readable(text: Column) -> Column:
    return F.when(F.coalesce(text.rlike(r"\p{L}"), F.lit(False)), text)


def label(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, n_positions, label_share: one row per row of ``docs``."""
    rows = docs.select(docs[f"`{id_column}`"].cast("long").alias("id"), _readable(docs[f"`{text_column}`"]).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = pa.schema(
        [("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("n_positions", pa.int64()), ("label_share", pa.float64())]
    )

    def take(batches):
        for b in batches:
            for start in range(0, b.num_rows, 512):
                part = b.slice(start, 512)
                yield batch(out, part.column("id"), *_labelled(shared.value, texts(part.column("text"))))

    return rows.mapInArrow(take, "doc_id long, lang_pred string, score double, n_positions long, label_share double")


def accepted(docs: DataFrame, model: Model, least: float, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is known with a score of ``least`` or more, unchanged and not shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    whole = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")  # so that no name can clash
    rows = docs.select(whole, _readable(docs[f"`{text_column}`"]).alias("readable"))

    def take(batches):
        for b in batches:
            for start in range(0, b.num_rows, 512):
                part = b.slice(start, 512)
                names, score, _, _ = _labelled(shared.value, texts(part.column("readable")))
                keep = [name != UNKNOWN and s >= least for name, s in zip(names, score)]
                yield part.drop_columns(["readable"]).filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(take, rows.drop("readable").schema).select("row.*")
