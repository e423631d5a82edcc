"""Quality rules with cross-document line frequency.

A first reading takes the lines of each text as hashes, a second one its word counts, symbols,
repeated lines and repeated three-word windows. A line is normalised by folding A-Z and by single spaces between words,
and hashed to 64 bits. Within a host, a line's frequency is the number of distinct documents that
hold it; documents with the same lines count once, so copies of one page make nothing boilerplate.
Lines in more than ``min_docs`` of them are removed: the second reading rebuilds the texts without
them, and a document of which too little is left is depleted.

The limit does not depend on the host's size, unless a caller sets ``max_share``: then it is
``max(min_docs, max_share * distinct documents)``. Frequencies are counted over all documents, in
two aggregations that combine before they shuffle: a line that a third of all documents hold is
one row per task.

Defined results: null or empty text has no words and fails the base rules. A null host is a host
of its own. Repeated rows are judged alike. Empty tables give empty tables. Other input columns
are not read; outputs are the named columns only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm import text as tx
from riskframe.llm.common import small_side, store

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# A side of at most this many (host, line) rows is broadcast; more are joined by shuffle.

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[[ord(c) for c in SYMBOLS]] = 1
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SCHEMA = ", ".join(f"{c} bigint" for c in _COUNTS) + ", content bigint, line array<bigint>, line_words array<int>"


def _repeat_words(words: tx.Words, texts: int) -> np.ndarray:
    """Per text, words covered by three-word windows that occur twice or more in it."""
    h, n = words.hash, len(words.hash)
    if n < 3:
        return np.zeros(texts, np.int64)
    inside = words.text[2:] == words.text[:-2]
    key = tx.mix(h[:-2]) * np.uint64(3) + tx.mix(h[1:-1] ^ np.uint64(1)) * np.uint64(5) + tx.mix(h[2:] ^ np.uint64(2))
    key = tx.mix(key ^ tx.mix(words.text[:-2].astype(np.uint64)))[inside]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(inside)[twice]
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[at + k] = True
    return np.bincount(words.text[covered], minlength=texts)


def _line_rows(chunk: tx.Chunk, words: tx.Words) -> dict[str, np.ndarray]:
    """The lines that hold a word: text, raw hash, normalised hash and word count of each."""
    breaks = np.flatnonzero(chunk.data == 0x0A)
    size = np.diff(chunk.start)
    begin = np.sort(np.concatenate([chunk.start[:-1][size > 0], breaks + 1]))
    begin = np.unique(begin[begin < len(chunk.data)])
    # A line ends at its \n, or where its text ends; the next line of a text begins after its \n.
    end = np.append(begin[1:], len(chunk.data))
    end = end - ((end > begin) & (chunk.data[end - 1] == 0x0A)) if len(begin) else end
    of_word = np.searchsorted(begin, words.begin, side="right") - 1
    count = np.bincount(of_word, minlength=len(begin))
    full = count > 0
    folded = tx.words(chunk).hash
    return {
        "text": np.searchsorted(chunk.start, begin[full], side="right") - 1,
        "begin": begin[full],
        "end": end[full],
        "raw": tx.range_hash(chunk, begin[full], end[full]),
        "hash": tx.sequence_hash(folded, count[full]),
        "words": count[full],
    }


def _measure(chunk: tx.Chunk) -> list[pa.Array]:
    n = len(chunk)
    words = tx.words(chunk, lower=False)
    size = np.diff(chunk.start)
    in_word = ~tx.SPACE[chunk.data] & ((chunk.data & 0xC0) != 0x80)
    lines = _line_rows(chunk, words)
    per_text = np.bincount(lines["text"], minlength=n)
    # Equal lines of one text share a key; distinct keys are counted through their first line.
    first = np.unique(tx.mix(lines["raw"] ^ tx.mix(lines["text"].astype(np.uint64))), return_index=True)[1]
    distinct = np.bincount(lines["text"][first], minlength=n)
    at = pa.array(np.concatenate([[0], np.cumsum(per_text)]).astype(np.int32))
    counts = [
        words.per_text,
        tx.sum_by(in_word.astype(np.int64), size).astype(np.int64),
        tx.sum_by(_SYMBOL[chunk.data], size).astype(np.int64),
        per_text - distinct,
        _repeat_words(words, n),
        tx.sequence_hash(lines["hash"], per_text).view(np.int64),
    ]
    return [pa.array(c, pa.int64()) for c in counts] + [
        pa.ListArray.from_arrays(at, pa.array(lines["hash"].view(np.int64))),
        pa.ListArray.from_arrays(at, pa.array(lines["words"].astype(np.int32))),
    ]


def measure(text: Column) -> Column:
    """The counts of a text, a hash of its line sequence, and its lines in order."""
    names = [*_COUNTS, "content", "line", "line_words"]

    @F.arrow_udf(_SCHEMA)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.concat_arrays([pa.StructArray.from_arrays(_measure(c), names) for c in tx.chunks(column)])

    return run(text)


def _without(chunk: tx.Chunk, dead: list[list[int] | None]) -> list[bytes]:
    """Each text without its lines whose hash is in its list; the other lines stay byte by byte."""
    lines = _line_rows(chunk, tx.words(chunk, lower=False))
    gone, hashes = [set(d or ()) for d in dead], lines["hash"].view(np.int64).tolist()
    pieces = [[] for _ in dead]
    drops = [False] * len(dead)
    at = chunk.start[:-1].tolist()
    for i, h, begin, end in zip(lines["text"].tolist(), hashes, lines["begin"].tolist(), lines["end"].tolist(), strict=True):
        if h in gone[i]:
            stop = int(chunk.start[i + 1])
            pieces[i].append(chunk.data[at[i] : begin].tobytes())
            drops[i] = end == stop  # the last line has no \n; that of the line before it goes
            at[i] = min(end + 1, stop)
    out = []
    for i, own in enumerate(pieces):
        left = b"".join(own) + chunk.data[at[i] : chunk.start[i + 1]].tobytes()
        out.append(left[:-1] if drops[i] and left else left)
    return out


def without_lines(text: Column, dead: Column) -> Column:
    """A struct (text, n_words): the text without the lines whose hashes are in ``dead``, and its words."""

    @F.arrow_udf("text string, n_words bigint")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for column, lists in batches:
            texts, counts = [pa.array([], pa.string())], [np.zeros(0, np.int64)]
            for chunk in tx.chunks(column):
                left = pa.array(_without(chunk, lists[chunk.first : chunk.first + len(chunk)].to_pylist()), pa.binary())
                texts.append(left.cast(pa.string()))
                counts += [tx.words(c).per_text for c in tx.chunks(texts[-1])]
            yield pa.StructArray.from_arrays(
                [pa.concat_arrays(texts), pa.array(np.concatenate(counts), pa.int64())], ["text", "n_words"]
            )

    return run(text, dead)


def base_failed(min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> Column:
    n = F.col("n_words")
    return (n < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * n)


def frequent_lines(measured: DataFrame, min_docs: int = 10, max_share: float = 0.0) -> DataFrame:
    """(host, line, n_docs) above the host's limit, from rows (host, content, line)."""
    distinct = measured.select("host", "content", F.explode(F.array_distinct("line")).alias("line")).distinct()
    per_line = distinct.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs"))
    # Lines that no host can allow go before the join.
    candidates = per_line.where(F.col("n_docs") > min_docs)
    if not max_share:
        return candidates
    per_host = measured.select("host", "content").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    limit = F.greatest(F.lit(float(min_docs)), F.col("host_docs") * max_share)
    return candidates.join(per_host, "host").where(F.col("n_docs") > limit).select("host", "line", "n_docs")


def clean_texts(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    host_col: str = "source",
    min_docs: int = 10,
    max_share: float = 0.0,
    min_left: float = 0.3,
) -> DataFrame:
    """Per row: id, ``cleaned`` (the text without its host's frequent lines), the counts of the text,
    ``n_removed_words``, ``base_failed``, ``depleted`` and ``kept``.

    Lines are counted in a first reading; a second one rebuilds the texts. Which lines a text loses
    depends on its host and its lines only, so those two are the key and texts are not stored.
    """
    host = F.coalesce(F.concat(F.lit("h:"), F.col(host_col).cast("string")), F.lit("none"))
    text = F.col(text_col)
    read = docs.select(F.col(id_col).alias("id"), host.alias("host"), text.alias("text"), measure(text).alias("m"))
    measured = store(read.select("host", "m.content", "m.line"), "lines")
    frequent = store(frequent_lines(measured, min_docs, max_share).select("host", "line"), "frequent-lines")
    lines = measured.select("host", "content", F.explode("line").alias("line"))
    dead = store(
        lines.join(small_side(frequent, F.length("host") + 32), ["host", "line"])
        .groupBy("host", "content")
        .agg(F.collect_set("line").alias("dead")),
        "removed-lines",
    )
    found = read.select("id", "host", "text", *[f"m.{c}" for c in [*_COUNTS, "content"]])
    found = found.join(small_side(dead, F.length("host") + 8 * F.size("dead") + 64), ["host", "content"], "left")
    # Only texts that lose a line are rebuilt.
    loses = F.col("dead").isNotNull()
    found = found.withColumn("left", without_lines(F.when(loses, F.col("text")), F.col("dead")))
    left = F.when(loses, F.col("left.n_words")).otherwise(F.col("n_words"))
    return (
        found.withColumn("n_removed_words", F.col("n_words") - left)
        .withColumn("cleaned", F.when(loses, F.col("left.text")).otherwise(F.col("text")))
        .withColumns({"base_failed": base_failed(), "depleted": left / F.greatest(F.col("n_words"), F.lit(1)) < min_left})
        # A text without words has nothing to lose.
        .withColumn("depleted", F.col("depleted") & (F.col("n_removed_words") > 0))
        .withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))
        .select(F.col("id").alias(id_col), "cleaned", *_COUNTS, "n_removed_words", "base_failed", "depleted", "kept")
    )


def apply_rules(docs: DataFrame, **options) -> DataFrame:
    """The measures of ``clean_texts``, which takes the options, with a digest of the cleaned text."""
    cleaned = clean_texts(docs, **options)
    digest = F.sha2(F.col("cleaned").cast("binary"), 256).alias("cleaned_sha256")
    return cleaned.select("*", digest).drop("cleaned")
