"""Secrets in texts: fixed patterns, and windows of high Shannon entropy that no allow-list explains.

Patterns (``BASE``) give the kinds assign, access and hex: leftmost matches that do not overlap
within a kind, without those that are too short. A span is a whole match.

Entropy. For each class of characters (``CLASSES``) the candidates are the maximal runs of its
characters that are at least a window long. A window slides over a candidate; its counts per
character change by the one that enters and the one that leaves, and with them the sum of
c log2 c, kept in integers, so the entropy is exact at every place. Windows with at least the bits
of their class, a letter and a digit are hits; overlapping hits are one span, of kind
entropy_<class>. A hit is dropped if its whole candidate matches the allow-list (identifiers, paths,
dates, runs of the alphabet, placeholders), or if the span lies within a span of a pattern or of an
earlier class. Patterns are never dropped.

Texts are read as bytes in chunks; all candidates of a chunk slide at once, in numpy. Long
candidates are cut into overlapping pieces whose windows are together the windows of the whole, so
memory depends on the chunk (or the longest text) alone. There is no shuffle.

Defined results: a null or empty text has no spans; every row of the input, repeated or with a null
id, gives one row; other columns are kept as they are. Places are code points, ends exclusive;
spans are in order of start, then of kind, then of end. An empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm import text as tx

ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
BASE = ("assign", "access", "hex")


@dataclass(frozen=True)
class CharClass:
    """Characters, the width of the window and the bits per character from which it is a hit."""

    name: str
    characters: bytes
    window: int
    bits: float


_DIGITS, _LOWER, _UPPER = b"0123456789", bytes(range(97, 123)), bytes(range(65, 91))
CLASSES = (
    CharClass("hex", _DIGITS + b"abcdefABCDEF", 24, 3.0),
    CharClass("base64", _DIGITS + _LOWER + _UPPER + b"+/_=-", 20, 3.75),
)
# Candidates that are no secrets whatever their entropy.
ALLOWED = (
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",  # identifiers
    r"[+/_=-]*([A-Za-z]+|[0-9]+)([+/_=-]+([A-Za-z]+|[0-9]+))*[+/_=-]*",  # words and numbers, joined
    r".*(?i:example|placeholder|changeme|xxxxxx|redacted).*",
)
# Ascending neighbours (abc, 123) from which on a candidate counts as a run of the alphabet, in tenths.
ALPHABET_TENTHS = 5
PIECE = 512
_SCALE = 1 << 24
_KIND = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def runs(member: np.ndarray, start: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the runs of true bytes, which end with their text, of at least ``least``."""
    inner = start[1:-1]
    first, last = member.copy(), member.copy()
    first[1:] &= ~member[:-1]
    last[:-1] &= ~member[1:]
    inner = inner[(inner > 0) & (inner < len(member))]
    first[inner] |= member[inner]
    last[inner - 1] |= member[inner - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    long = end - begin >= least
    return begin[long], end[long]


def _c_log_c(window: int) -> np.ndarray:
    c = np.arange(window + 1)
    return np.rint(c * np.log2(np.maximum(c, 1)) * _SCALE).astype(np.int64)


def most_sum(window: int, bits: float) -> int:
    """The largest sum of scaled c log2 c at which a window still has ``bits`` per character."""
    return int(np.floor((np.log2(window) - bits) * window * _SCALE + window))


def hits(code: np.ndarray, begin: np.ndarray, end: np.ndarray, window: int, bits: float, characters: int) -> np.ndarray:
    """Begins of all windows within the given runs that have at least ``bits`` per character."""
    # Pieces overlap by a window less one, so each window is in exactly one of them.
    pieces = np.maximum(1, -(-(end - begin - window + 1) // PIECE))
    run = np.repeat(np.arange(len(begin)), pieces)
    nth = np.arange(len(run)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    at = begin[run] + nth * PIECE
    size = np.minimum(end[run] - at, PIECE + window - 1)
    order = np.argsort(-size, kind="stable")
    at, size = at[order], size[order]
    gain, most = _c_log_c(window), most_sum(window, bits)
    counts = np.zeros((len(at), characters), np.int16)
    total = np.zeros(len(at), np.int64)
    active = np.searchsorted(-size, -np.arange(size.max(initial=0)), side="left")
    found = [np.zeros(0, np.int64)]
    for t, n in enumerate(active):
        rows = np.arange(n)
        if t >= window:
            gone = code[at[:n] + t - window]
            had = counts[rows, gone]
            total[:n] += gain[had - 1] - gain[had]
            counts[rows, gone] -= 1
        new = code[at[:n] + t]
        had = counts[rows, new]
        total[:n] += gain[had + 1] - gain[had]
        counts[rows, new] += 1
        if t >= window - 1:
            found.append(at[:n][total[:n] <= most] + t - window + 1)
    return np.sort(np.concatenate(found))


def is_allowed(candidate: bytes, allowed: Sequence[re.Pattern]) -> bool:
    word = candidate.decode("ascii")
    if any(p.fullmatch(word) for p in allowed):
        return True
    step = np.diff(np.frombuffer(candidate, np.uint8).astype(np.int16))
    return 10 * int((step == 1).sum()) >= ALPHABET_TENTHS * len(step)


def _patterns(chunk: tx.Chunk) -> list[tuple[int, int, int, int]]:
    """(text, kind, begin, end) of all pattern matches, in bytes of the chunk."""
    data, start, out = chunk.data, chunk.start, []
    hex_digit = np.zeros(256, bool)
    hex_digit[list(b"0123456789abcdef")] = True
    begin, end = runs(hex_digit[data], start, HEX_LEAST)
    own = np.searchsorted(start, begin, side="right") - 1
    out += [(int(i), 2, int(b), int(e)) for i, b, e in zip(own, begin, end, strict=True)]
    whole = data.tobytes()

    def search(places: np.ndarray, pattern: re.Pattern, kind: int, group: int, least: int) -> None:
        for i in np.unique(np.searchsorted(start, places, side="right") - 1):
            for m in pattern.finditer(whole[start[i] : start[i + 1]]):
                if m.end(group) - m.start(group) >= least:
                    out.append((int(i), kind, int(start[i]) + m.start(), int(start[i]) + m.end()))

    # Only texts with a sign whose last character before it, spaces aside, can end a key.
    sign = np.flatnonzero((data == ord(":")) | (data == ord("=")))
    if len(sign):
        full = np.flatnonzero(data != 0x20)
        before = full[np.maximum(np.searchsorted(full, sign) - 1, 0)]
        ends = np.zeros(256, bool)
        ends[list(b"dtnyDTNY\"'")] = True
        search(sign[ends[data[before]]], ASSIGN, 0, 2, ASSIGN_LEAST)
    places, at = [], whole.find(b"AKIA")
    while at >= 0:
        places.append(at)
        at = whole.find(b"AKIA", at + 4)
    search(np.array(places, np.int64), ACCESS, 1, 0, ACCESS_LEAST)
    return out


def _windows(chunk: tx.Chunk, found: list, classes: Sequence[CharClass], allowed: Sequence[re.Pattern]) -> None:
    """Add the spans of high entropy to ``found``."""
    data, start = chunk.data, chunk.start
    for kind, of in enumerate(classes, len(BASE)):
        place = np.full(256, -1, np.int64)
        place[list(of.characters)] = np.arange(len(of.characters))
        begin, end = runs(place[data] >= 0, start, of.window)
        if not len(begin):
            continue
        digit = np.cumsum(np.append(0, (data >= 48) & (data <= 57)))
        letter = np.cumsum(np.append(0, ((data | 32) >= 97) & ((data | 32) <= 122)))
        # A window needs a letter and a digit, so only runs that have both slide.
        both = (digit[end] > digit[begin]) & (letter[end] > letter[begin])
        begin, end = begin[both], end[both]
        hit = hits(place[data], begin, end, of.window, of.bits, len(of.characters))
        hit = hit[(digit[hit + of.window] > digit[hit]) & (letter[hit + of.window] > letter[hit])]
        if not len(hit):
            continue
        run = np.searchsorted(begin, hit, side="right") - 1
        new = np.append(True, (hit[1:] > hit[:-1] + of.window) | (run[1:] != run[:-1]))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(hit)) - 1
        known: dict[int, bool] = {}
        covered = {}
        for i, _, b, e in found:
            covered.setdefault(i, []).append((b, e))
        for f, z in zip(first, last, strict=True):
            b, e, r = int(hit[f]), int(hit[z]) + of.window, int(run[f])
            i = int(np.searchsorted(start, b, side="right")) - 1
            if any(x <= b and e <= y for x, y in covered.get(i, ())):
                continue
            if r not in known:
                known[r] = is_allowed(data[begin[r] : end[r]].tobytes(), allowed)
            if not known[r]:
                found.append((i, kind, b, e))


def _scan(column: pa.Array, classes: Sequence[CharClass], allowed: Sequence[re.Pattern]) -> pa.Array:
    names = [*BASE, *(f"entropy_{c.name}" for c in classes)]
    parts = []
    for chunk in tx.chunks(column):
        found = _patterns(chunk)
        _windows(chunk, found, classes, allowed)
        found.sort(key=lambda s: (s[0], s[2], s[1], s[3]))
        rows = np.array(found, np.int64).reshape(-1, 4)
        begins_character = np.append(0, np.cumsum((chunk.data & 0xC0) != 0x80)) if len(rows) else np.zeros(1, np.int64)
        origin = begins_character[chunk.start[rows[:, 0]]] if len(rows) else rows[:, 0]
        spans = pa.StructArray.from_arrays(
            [pa.array([names[k] for k in rows[:, 1]], pa.string()), *(pa.array(begins_character[rows[:, c]] - origin, pa.int64()) for c in (2, 3))],
            ["kind", "start", "end"],
        )
        per_text = np.bincount(rows[:, 0], minlength=len(chunk))
        parts.append(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(per_text)), pa.int32()), spans))
    return pa.concat_arrays(parts)


def find_secrets(
    docs: DataFrame, text_col: str = "text", classes: Sequence[CharClass] = CLASSES, allowed: Sequence[str] = ALLOWED, out: str = "spans"
) -> DataFrame:
    """Add the spans of secrets as an array of (kind, start, end)."""
    patterns = [re.compile(p, re.S) for p in allowed]

    @F.arrow_udf("array<struct<kind: string, start: bigint, end: bigint>>")
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield _scan(column, classes, patterns)

    return docs.withColumn(out, scan(F.col(text_col)))


def written(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kinds(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))
