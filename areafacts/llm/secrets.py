"""Secrets in whole texts: three fixed patterns, and strings that compression finds novel.

The patterns give the base spans. The method adds spans: a candidate is a run of key characters near a word of a
sensitive context, on either side of it on its line, on the next line where a line ends in a sign that opens a value, or
in the body of a private key. What is made of words is none. Its novelty is its marginal size: a zstandard frame of the surrounding text with the
candidate less the frame without it, both primed with a dictionary of common identifiers and the text before. Names,
paths and words that the dictionary or the surroundings know compress away; random keys do not. A candidate whose
marginal bytes reach a share of the bytes that a random string of its alphabet needs is reported.

Everything happens within a row: one narrow pass, no shuffle. Texts of any length are scanned whole; the compressor
only sees a window around each candidate.

Defined cases: null text is empty and has no span. Offsets count code points, ends exclusive. Repeated rows are each
scanned. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Sequence

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from areafacts.llm.common import batch, picked

KINDS = ("assign", "access", "hex", "novel")

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
# A run shorter than the least length fails, and nothing within it can pass: only long runs need a match.
ACCESS_LONG = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX_LONG = re.compile(r"[0-9a-f]{24,}")

SENSITIVE = re.compile(
    r"passw(?:or)?d|passphrase|pass(?![a-z0-9])|secret|token|api[ _-]?key|access[ _-]?key|private[ _-]?key|credential"
    r"|auth(?:orization)?(?![a-z0-9])|bearer",
    re.IGNORECASE | re.ASCII,
)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
# Lines "name: value" may come first; then lines that hold nothing else.
KEY_BODY = re.compile(
    r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY[A-Z ]*-----(?:[ \t]*\r?\n[A-Za-z-]+: [^\n]*)*"
    r"((?:[ \t]*\r?\n[ \t]*[A-Za-z0-9+/=]*+(?=[ \t]*(?:\r?\n|\Z|-)))*)"
)
KEY_LINE = re.compile(r"[A-Za-z0-9+/=]{4,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]*")
# Line ends after which a value may stand on the next line.
OPENS = frozenset(":=([{\\|>,\"'")
CAMEL = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
CONSONANTS = re.compile(r"[b-df-hj-np-tv-xz]{5,}")

# Names that code and configuration use around keys; the priming dictionary.
IDENTIFIERS = (
    "password passwd passphrase secret token api_key apikey access_key secret_key private_key public_key client_id "
    "client_secret credential credentials authorization bearer basic oauth session cookie username user login account "
    "config configuration settings environment variable default example placeholder changeme undefined null none true "
    "false string integer boolean function return import export const static final public private protected class "
    "request response header content application json https http localhost server client database connection host port "
    "region bucket endpoint service version release build debug info warning error value name key id path file "
    "directory timestamp expires issued audience scope grant_type refresh_token access_token id_token csrf_token"
).split()

NOVELTY = 0.8
WINDOW = 256
SAME_LINE = 64
# zstandard codes literals by frequency from about this many on.
ENTROPY_CODED = 64


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), m.end(), "access") for m in ACCESS_LONG.finditer(text)]
    return found + [(m.start(), m.end(), "hex") for m in HEX_LONG.finditer(text)]


def alphabet_bits(candidate: str) -> float:
    """Bits a character of a random string over the candidate's kind of alphabet."""
    if re.fullmatch(r"[0-9]+", candidate):
        return math.log2(10)
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", candidate):
        return 4.0
    if re.fullmatch(r"[0-9a-z_=-]+|[0-9A-Z_=-]+", candidate):
        return math.log2(36)
    return 6.0


def random_bytes(candidate: str) -> float:
    """Compressed bytes of a random string of this length and alphabet: below 64 bytes, literals are stored as they are."""
    return len(candidate) * (1.0 if len(candidate) < ENTROPY_CODED else alphabet_bits(candidate) / 8)


def marginal_bytes(before: str, candidate: str, after: str, identifiers: bytes) -> int:
    """Compressed bytes that the candidate adds to its surroundings."""
    primed = zstandard.ZstdCompressionDict(
        identifiers + (before + "\n" + after).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT
    )
    squeeze = zstandard.ZstdCompressor(dict_data=primed, write_checksum=False, write_content_size=False).compress
    return len(squeeze((before[-SAME_LINE:] + candidate).encode())) - len(squeeze(before[-SAME_LINE:].encode()))


def is_words(candidate: str) -> bool:
    """Letters and at most one digit that read as words: few changes of case and, in one piece, vowels as words have."""
    letters = [c for c in candidate.lower() if c.isalpha()]
    if not letters or sum(c.isdigit() for c in candidate) >= 2:
        return False
    if len(letters) < 4 * len(CAMEL.findall(candidate)):
        return False
    if re.search(r"[A-Za-z][^A-Za-z]+[A-Za-z]", candidate):
        return True
    vowels = sum(c in "aeiouy" for c in letters)
    return vowels >= 0.28 * len(letters) and sum(map(len, CONSONANTS.findall("".join(letters)))) <= 0.25 * len(letters)


def _limit(text: str, start: int) -> int:
    """Where the context of a word that ends at ``start`` ends."""
    at, limit = start, start + SAME_LINE
    while (end := text.find("\n", at, limit)) >= 0 and text[max(start - 1, end - SAME_LINE) : end].rstrip(" \t\r")[-1:] in OPENS:
        at = end + 1
    return end if end >= 0 else limit


def _before(text: str, word_start: int, done: int) -> list[tuple[int, int]]:
    """Candidates that end before a word, on its line."""
    start = max(done, word_start - SAME_LINE, 0)
    start = max(start, text.rfind("\n", start, word_start) + 1)
    found = []
    while start < word_start:
        end = RUN.match(text, start, word_start).end()
        if end == word_start:
            break  # the word is a part of it
        if end > start:
            while start > done and RUN.fullmatch(text, start - 1, start):
                start -= 1
            if CANDIDATE.fullmatch(text, start, end):
                found.append((start, end))
        start = end + 1
    return found


def novel_spans(text: str, identifiers: bytes, novelty: float = NOVELTY) -> list[tuple[int, int, str]]:
    found, done = [], 0

    def measure(start: int, end: int) -> None:
        candidate = text[start:end]
        if not is_words(candidate):
            size = marginal_bytes(text[max(0, start - WINDOW) : start], candidate, text[end : end + WINDOW], identifiers)
            if size >= novelty * random_bytes(candidate):
                found.append((start, end, "novel"))

    bodies = list(KEY_BODY.finditer(text))[::-1]
    for word in SENSITIVE.finditer(text):
        for start, end in _before(text, word.start(), done):
            measure(start, end)
            done = end
        if bodies and bodies[-1].start() <= word.start():
            start, end = bodies.pop().span(1)
            for m in KEY_LINE.finditer(text, max(start, done), end):
                measure(*m.span())
            done = max(done, end)
        limit = _limit(text, word.end())
        at = max(word.end(), done)
        while (m := CANDIDATE.search(text, at, max(at, limit) + 4096)) and m.start() < limit:
            if m.end() == max(at, limit) + 4096:
                m = CANDIDATE.match(text, m.start())
            at = done = m.end()
            measure(*m.span())
    return found


def in_order(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in in_order(spans))


def scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    identifiers: Sequence[str] = IDENTIFIERS,
    novelty: float = NOVELTY,
) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_novel: one row per row of ``docs``."""
    names = " ".join(identifiers).encode()
    out = pa.schema(
        [("doc_id", pa.int64())]
        + [(c, pa.int64()) for c in ("n_assign", "n_access", "n_hex")]
        + [("base_sha256", pa.string()), ("spans", pa.string()), ("n_novel", pa.int64())]
    )

    def take(batches):
        for b in batches:
            for start in range(0, b.num_rows, 256):
                part, rows = b.slice(start, 256), []
                for text in part.column("text").to_pylist():
                    base = base_spans(text or "")
                    added = novel_spans(text or "", names, novelty)
                    kinds = [s[2] for s in base]
                    digest = hashlib.sha256(written(base).encode()).hexdigest()
                    rows.append((*(kinds.count(k) for k in KINDS[:3]), digest, written(base + added), len(added)))
                yield batch(out, part.column("id"), *zip(*rows))

    rows = picked(docs, id=id_column, text=text_column)
    return rows.select(rows.id.cast("long").alias("id"), "text").mapInArrow(
        take, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long"
    )


def redacted(text: str, spans: list[tuple[int, int, str]], sign: str) -> str:
    """The text with each stretch that spans cover replaced by one sign."""
    parts, at, open_until = [], 0, -1
    for start, end, _ in sorted(spans):
        if start > open_until:
            parts += [text[at:start], sign]
        at = open_until = max(open_until, end)
    return "".join([*parts, text[at:]])


def redact(
    docs: DataFrame,
    text_column: str = "text",
    size_column: str | None = None,
    sign: str = "<secret>",
    identifiers: Sequence[str] = IDENTIFIERS,
    novelty: float = NOVELTY,
) -> DataFrame:
    """``docs`` with every span replaced by ``sign``; rows without a span are unchanged. ``size_column``, if given, is
    set to the new number of characters where a text changed."""
    names = " ".join(identifiers).encode()
    place, size_place = (docs.columns.index(c) if c is not None else None for c in (text_column, size_column))

    def take(batches):
        for b in batches:
            for start in range(0, b.num_rows, 256):
                part = b.slice(start, 256)
                old = part.column(place).to_pylist()
                new = []
                for text in old:
                    spans = base_spans(text) + novel_spans(text, names, novelty) if text else []
                    new.append(redacted(text, spans, sign) if spans else text)
                if size_place is not None:
                    sizes = part.column(size_place)
                    values = [s if n is o or n == o else len(n) for s, n, o in zip(sizes.to_pylist(), new, old)]
                    part = part.set_column(size_place, part.schema.field(size_place), pa.array(values, sizes.type))
                yield part.set_column(place, part.schema.field(place), pa.array(new, part.schema.field(place).type))

    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # whatever the columns are called
    return numbered.mapInArrow(take, numbered.schema).toDF(*docs.columns)
