"""SimHash near-duplicates, found through tables of distances to reference fingerprints.

A fingerprint's 64 bits are cut into eight segments. Eight reference fingerprints (Walsh functions of the bit position)
give each segment eight Hamming distances; the 8 x 8 table is the fingerprint's row. For two fingerprints the
triangle inequality holds in every segment: the largest difference of a segment's coordinates is at most the number of
differing bits there. So fingerprints within ``d`` bits

* have identical coordinates in at least 8 - d segments: rows meet under a key made of that many segments' coordinates
  (28 keys a fingerprint for d = 2), and
* have segment-wise largest coordinate differences that sum to at most ``d``: other pairs that met are discarded
  without a comparison of bits.

Survivors are verified bit by bit. The references determine a segment (their matrix is invertible), so a group under a
key holds at most 2^(8 d) different fingerprints, whatever the data; exact copies are one fingerprint and never meet.
Within a group only a spanning forest of the links is sent on.

Defined cases: null text and text without a word have fingerprint zero and link like any other. Fewer words than a
shingle are one shingle. A null id is a row of its own that gets its class's smallest id; repeated rows are each
returned. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areafacts.llm.common import picked, runs, stored, texts
from areafacts.llm.components import components

SEED = 42
SEGMENTS = 8
BLOCK = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_blocks(text: bytes, size: int = BLOCK) -> Iterator[list[bytes]]:
    """The words of a text of any length, those of about ``size`` bytes at a time."""
    start = 0
    while start < len(text):
        end = min(start + size, len(text))
        if end < len(text):
            cut = _SPACE.search(text, end)
            end = cut.start() if cut else len(text)
        yield text[start:end].split()
        start = end


def shingle_digests(words: list[bytes], n: int) -> np.ndarray:
    """XXH64 of every run of ``n`` words, as rows of eight bytes, most significant first."""
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    digest = xxhash.xxh64_digest
    found = [digest(joined[a:b], SEED) for a, b in zip((ends - lengths).tolist(), ends[n - 1 :].tolist())]
    return np.frombuffer(b"".join(found), np.uint8).reshape(-1, 8)


def fingerprint(text: bytes, n: int) -> int:
    """Bits set in over half of the shingles' hashes; signed."""
    ones, total, tail = np.zeros(64, np.int64), 0, []
    for words in word_blocks(text.lower()):
        words = tail + words
        if len(words) >= n:
            digests = shingle_digests(words, n)
            for i in range(0, len(digests), 4096):
                ones += np.unpackbits(digests[i : i + 4096], axis=1).sum(axis=0, dtype=np.uint16)
            total += len(digests)
        tail = words[-(n - 1) :] if n > 1 else []
    if not total:
        if not tail:
            return 0
        ones, total = np.unpackbits(shingle_digests([b" ".join(tail)], 1), axis=1)[0].astype(np.int64), 1
    return int(np.packbits(2 * ones > total).view(">i8")[0])


def fingerprints(docs: DataFrame, n: int) -> DataFrame:
    """The columns of ``docs`` with the fingerprint ``fp`` in place of ``text``, which comes last."""
    schema = T.StructType([f for f in docs.schema.fields if f.name != "text"]).add("fp", "long")

    def take(batches):
        for b in batches:
            for start in range(0, b.num_rows, 256):
                part = b.slice(start, 256)
                fp = pa.array([fingerprint(t, n) for t in texts(part.column("text"))], pa.int64())
                yield part.drop_columns(["text"]).append_column("fp", fp)

    return docs.mapInArrow(take, schema)


def reference_distances() -> np.ndarray:
    """[value of a segment, reference] -> Hamming distance, for the Walsh functions of three bits."""
    parity = [[bin(i & b).count("1") % 2 for b in range(8)] for i in range(8)]
    bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
    return np.array([[(row != p).sum() for p in np.array(parity)] for row in bits], np.uint8)


DISTANCES = reference_distances()
# A segment's eight coordinates (0 to 8) as one number.
PACKED = (DISTANCES.astype(np.uint64) << (4 * np.arange(8, dtype=np.uint64))).sum(axis=1, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def meeting_keys(fp: np.ndarray, d: int) -> np.ndarray:
    """[choice of ``d`` segments left out, fingerprint] -> key of the other segments' coordinates."""
    segments = fp.view(np.uint8).reshape(-1, SEGMENTS)
    odd = np.random.default_rng(SEED).integers(0, 2**63, SEGMENTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    parts = _mixed(PACKED[segments] + odd) * odd
    whole = parts.sum(axis=1, dtype=np.uint64)
    choices = combinations(range(SEGMENTS), d)
    return np.stack([_mixed(whole - parts[:, c].sum(axis=1, dtype=np.uint64) + np.uint64(i)) for i, c in enumerate(map(list, choices))])


def close_pairs(key: np.ndarray, fp: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs under one key within ``d`` bits; sorted by key and first coordinate, ``fp`` distinct in a key."""
    table = DISTANCES[fp.view(np.uint8).reshape(-1, SEGMENTS)]
    first = table[:, :, 0].sum(axis=1).astype(np.int16)
    order = np.lexsort((first, key))
    key, fp, table, first = key[order], fp[order], table[order], first[order]
    left, right, at = [], [], np.arange(len(key))
    for step in range(1, len(key)):
        at = at[at + step < len(key)]
        at = at[(key[at] == key[at + step]) & (first[at + step] - first[at] <= d)]
        if not len(at):
            break
        for i in range(0, len(at), 1 << 16):
            a = at[i : i + (1 << 16)]
            b = a + step
            apart = np.abs(table[a].astype(np.int8) - table[b].astype(np.int8)).max(axis=2).sum(axis=1)
            a, b = a[apart <= d], b[apart <= d]
            same = np.bitwise_count((fp[a] ^ fp[b]).view(np.uint64)) <= d
            left.append(order[a[same]])
            right.append(order[b[same]])
    none = np.empty(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest position that each of ``n`` positions reaches."""
    label = np.arange(n)
    while True:
        before = label.copy()
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if (label == before).all():
            return label


def links(distinct: DataFrame, d: int) -> DataFrame:
    """(a, b): enough links between different fingerprints to connect all within ``d`` bits. ``distinct``: (fp)."""
    keyed = pa.schema([("key", pa.int64()), ("fp", pa.int64())])
    linked = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def deal(batches):
        for b in batches:
            fp = b.column("fp").to_numpy()
            for key in meeting_keys(fp, d):
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(fp)], schema=keyed)

    def join(key, fp):
        a, b = close_pairs(key, fp, d)
        root = forest(len(fp), a, b)
        linked_rows = np.flatnonzero(root != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(fp[linked_rows]), pa.array(fp[root[linked_rows]])], schema=linked)

    def meet(batches):
        key, fp = np.empty(0, np.int64), np.empty(0, np.int64)
        for b in batches:  # sorted by key: the last group may go on in the next batch
            key, fp = np.concatenate([key, b.column("key").to_numpy()]), np.concatenate([fp, b.column("fp").to_numpy()])
            starts = runs(key)
            if not len(starts) or starts[-1] == 0:
                continue
            cut = starts[-1]
            yield join(key[:cut], fp[:cut])
            key, fp = key[cut:], fp[cut:]
        if len(key):
            yield join(key, fp)

    dealt = distinct.select("fp").mapInArrow(deal, "key long, fp long")
    return dealt.repartition("key").sortWithinPartitions("key").mapInArrow(meet, "a long, b long")


def rooted(distinct: DataFrame, d: int) -> DataFrame:
    """``distinct`` with the smallest fingerprint that each one reaches, ``root``."""
    if not d:
        return distinct.withColumn("root", F.col("fp"))
    found = components(links(distinct, d)).withColumnRenamed("node", "fp").withColumnRenamed("root", "found")
    return distinct.join(found, "fp", "left").withColumn("root", F.coalesce("found", "fp")).drop("found")


def classes(fps: DataFrame, d: int) -> DataFrame:
    """(fp, component): each distinct fingerprint of (id, fp) with the smallest id it reaches."""
    found = rooted(stored(fps.groupBy("fp").agg(F.min("id").alias("least")), "distinct"), d)
    least = found.groupBy("root").agg(F.min("least").alias("component"))
    return found.join(least, "root").select("fp", "component")


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 3, max_distance: int = 2
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest id reachable): one row per row of ``docs``."""
    rows = picked(docs, id=id_column, text=text_column).withColumn("id", F.col("id").cast("long"))
    fps = stored(fingerprints(rows.select("id", "text"), shingle), "fingerprints")
    found = fps.join(classes(fps, max_distance), "fp")
    return found.select(
        F.col("id").alias("doc_id"), hex_digits(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id")
    )


def one_of_each(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 3, max_distance: int = 2
) -> DataFrame:
    """One row of each group, unchanged: that of the smallest id (null last; then by the text's hash).

    Texts are shuffled once, by id and hash, with exact repetitions of a row dropped in the tasks before.
    """
    text = docs[f"`{text_column}`"]
    rows = docs.select(  # a row in a struct, so that no name can clash
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        docs[f"`{id_column}`"].cast("long").alias("id"),
        F.xxhash64(text).alias("hash"),
        text.alias("text"),
    )
    named = rows.select(F.struct(F.col("id").isNull(), "id", "hash").alias("row"), "text")
    fps = stored(fingerprints(named, shingle), "fingerprints")
    distinct = stored(fps.groupBy("fp").agg(F.min("row").alias("row")), "distinct")
    first = rooted(distinct, max_distance).groupBy("root").agg(F.min("row").alias("row"))
    kept = first.select(F.col("row.id").alias("kept"), F.col("row.hash").alias("kept_hash"))
    once = rows.drop("text").dropDuplicates(["id", "hash"])
    same = F.col("id").eqNullSafe(F.col("kept")) & (F.col("hash") == F.col("kept_hash"))
    return once.join(kept, same, "left_semi").select("row.*")
