"""BPE encoding and decoding with a minimal acyclic transducer for frequent words.

The words of all texts are counted, and the most frequent ones (``max_words``) are compiled into a
minimal acyclic automaton: equal suffixes share states, edges carry numbers whose sum along a
word is its rank, and the rank selects the word's ids. The automaton is a flat binary file in the
shared folder; Spark hands it to the executors, where workers memory-map it and look up all new
words of a chunk at once. Words outside the lexicon are merged exactly, pair by pair in rank
order, so the lexicon decides speed and never results.

Text is prepared as the vocabulary file prescribes: special tokens are cut out first; the rest is
put in NFC, lower-cased character by character, and split into contractions, runs of letters,
single digits and runs of other characters; white space is dropped. Decoding joins token strings
by spaces.

Defined results: null or empty text gives an empty id list, decoded as the empty string; a null
id list decodes to the empty string. An empty table gives an empty table. Extra columns pass
through; a column of the output's name is replaced.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.common import discard, release_memory, store
from riskframe.session import shared_dir

WORD_END = "</w>"
COUNTED_AT_ONCE = 200_000
CACHED_WORDS = 100_000
CHUNK_CHARS = 1 << 19
LONGEST_WORD = 100
# Frequencies from here on are one class: so frequent words are few.
HIGHEST_COUNT = 1_000_000
SHORT_WORD = 40
ID_BITS = 24
NEW_ID = (1 << ID_BITS) - 1
NO_MERGE = 1 << 62


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def _category_class(name: str, last: int) -> str:
    """A character class of all code points up to ``last`` with a Unicode general category."""
    every = "".join(map(chr, range(last + 1)))
    return "".join(f"\\U{m.start():08x}-\\U{m.end() - 1:08x}" for m in regex.finditer(rf"\p{{{name}}}+", every))


# White space as the vocabulary's pattern means it (the Unicode property).
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def word_pattern(last: int = sys.maxunicode) -> re.Pattern:
    """Contractions, runs of letters, single digits, runs of anything else but white space.

    For texts of code points up to ``last``; short classes are searched faster.
    """
    letters, digits = _category_class("L", last), _category_class("N", last)
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^{_WHITE}{letters}{digits}]+")


_BEYOND = re.compile("[\U00010000-\U0010ffff]")


@dataclass
class Vocabulary:
    """Token strings by id, merges as rows (left id, right id, merged id) in rank order, special tokens."""

    tokens: list[str]
    merges: np.ndarray
    special: dict[str, int]

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """From a tokenizer file in JSON with a BPE model that marks word ends."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, special = spec["model"]["vocab"], {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = [""] * (max([*vocab.values(), *special.values()]) + 1)
        for token, i in (vocab | special).items():
            tokens[i] = token
        merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in spec["model"]["merges"]]
        return cls(tokens, np.array(merges, np.int32), special)


class Merger:
    """Splits texts into words and merges one word exactly."""

    def __init__(self, vocabulary: Vocabulary):
        first = {t: i for i, t in reversed(list(enumerate(vocabulary.tokens)))}
        letters = _byte_letters()
        self.inner = [first[c] for c in letters]
        self.last = [first[c + WORD_END] for c in letters]
        rows = vocabulary.merges.tolist()
        # Rank and merged id of a pair in one number that orders by rank.
        self.ranks = {(a, b): rank << ID_BITS | new for rank, (a, b, new) in reversed(list(enumerate(rows)))}
        self.special = vocabulary.special
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.ascii_pattern, self.pattern, self.wide_pattern = word_pattern(0x7F), word_pattern(0xFFFF), word_pattern()

    def words(self, text: str) -> list[str]:
        """The words of a text in order; special tokens stand for themselves, after a NUL."""
        if not self.special or not any(s in text for s in self.special):
            return self.plain(text)
        out = []
        for i, part in enumerate(self.split.split(text)):
            out += ["\0" + part] if i % 2 else self.plain(part)
        return out

    def plain(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii_pattern.findall(text.lower())
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return (self.wide_pattern if _BEYOND.search(text) else self.pattern).findall(text)

    def merge(self, word: str) -> list[int]:
        """Ids of one word: of all adjacent pairs the lowest rank is merged first, leftmost first."""
        if word[:1] == "\0" and word[1:] in self.special:
            return [self.special[word[1:]]]
        data = word.encode("utf-8", "surrogatepass")
        inner = self.inner
        ids = [inner[b] for b in data]
        ids[-1] = self.last[data[-1]]
        return self._merge_short(ids) if len(ids) <= SHORT_WORD else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        """The lowest of all pairs each time; a merge changes the two pairs beside it."""
        get = self.ranks.get
        found = [get(pair, NO_MERGE) for pair in zip(ids, ids[1:])]  # noqa: B905
        while found:
            best = min(found)
            if best == NO_MERGE:
                break
            i = found.index(best)
            ids[i : i + 2] = [best & NEW_ID]
            del found[i]
            if i:
                found[i - 1] = get((ids[i - 1], ids[i]), NO_MERGE)
            if i < len(found):
                found[i] = get((ids[i], ids[i + 1]), NO_MERGE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a queue of pairs and links between neighbours: n log n for any length."""
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks, queue = self.ranks, []
        for i in range(n - 1):
            found = ranks.get((ids[i], ids[i + 1]))
            if found is not None:
                queue.append((found >> ID_BITS, i, ids[i], ids[i + 1], found & NEW_ID))
        heapq.heapify(queue)
        while queue:
            _, i, left, right, new = heapq.heappop(queue)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j] = new, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                found = ranks.get((new, ids[after[j]]))
                if found is not None:
                    heapq.heappush(queue, (found >> ID_BITS, i, new, ids[after[j]], found & NEW_ID))
            if before[i] >= 0:
                h = before[i]
                found = ranks.get((ids[h], new))
                if found is not None:
                    heapq.heappush(queue, (found >> ID_BITS, h, ids[h], new, found & NEW_ID))
        return [i for i in ids if i >= 0]


class Lexicon:
    """A minimal acyclic transducer from words (UTF-8) to id lists, as flat arrays.

    ``key`` holds state * 256 + byte of every edge in order, ``to`` the next state and ``skip`` the
    words that precede those through the edge; the sum of ``skip`` along a word is its rank.
    """

    ARRAYS = (("key", np.int64), ("to", np.int32), ("skip", np.int32), ("final", np.int8), ("at", np.int64), ("ids", np.int32))

    def __init__(self, **arrays: np.ndarray):
        self.__dict__.update(arrays)

    @classmethod
    def compile(cls, entries: dict[bytes, Sequence[int]]) -> Lexicon:
        """Words are added in order; a finished suffix is replaced by an equal one already stored."""
        stored: dict[tuple, int] = {}
        states: list[tuple[bool, tuple]] = []
        open_path: list[list] = [[False, []]]  # final, [(byte, state)] of the last word's states

        def close(depth: int) -> None:
            while len(open_path) > depth:
                final, edges = open_path.pop()
                shape = (final, tuple(edges))
                if shape not in stored:
                    stored[shape] = len(states)
                    states.append(shape)
                if open_path:
                    open_path[-1][1].append((last[len(open_path) - 1], stored[shape]))

        last = b""
        for word in sorted(entries):
            same = 0
            while same < min(len(last), len(word)) and last[same] == word[same]:
                same += 1
            close(same + 1)
            open_path += [[False, []] for _ in range(len(word) - same)]
            open_path[-1][0] = True
            last = word
        close(1)
        final, edges = open_path[0]
        states.append((final, tuple(edges)))
        start = len(states) - 1
        # States only lead to earlier ones, so one pass counts the words below each.
        below = np.zeros(len(states), np.int64)
        rows = []
        number = lambda s: start - s  # noqa: E731  the start state becomes 0
        for s, (accepts, out) in enumerate(states):
            count = int(accepts)
            for byte, to in out:
                rows.append((number(s) * 256 + byte, number(to), count))
                count += below[to]
            below[s] = count
        rows.sort()
        table = np.array(rows or np.zeros((0, 3)), np.int64).reshape(-1, 3)
        sizes = [len(entries[w]) for w in sorted(entries)]
        return cls(
            key=np.append(table[:, 0], np.iinfo(np.int64).max),
            to=np.append(table[:, 1], 0).astype(np.int32),
            skip=np.append(table[:, 2], 0).astype(np.int32),
            final=np.array([a for a, _ in reversed(states)], np.int8),
            at=np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
            ids=np.array([i for w in sorted(entries) for i in entries[w]], np.int32),
        )

    def to_bytes(self) -> bytes:
        arrays = [np.ascontiguousarray(getattr(self, n), t) for n, t in self.ARRAYS]
        head = np.array([len(a) for a in arrays], np.int64)
        return b"".join([head.tobytes(), *(a.tobytes() + b"\0" * (-a.nbytes % 8) for a in arrays)])

    @classmethod
    def map(cls, path: str) -> Lexicon:
        """Memory-map a file written by ``to_bytes``; workers of a machine share its pages."""
        raw = np.memmap(path, np.uint8, "r")
        sizes, at, arrays = raw[: 8 * len(cls.ARRAYS)].view(np.int64), 8 * len(cls.ARRAYS), {}
        for (name, kind), n in zip(cls.ARRAYS, sizes.tolist(), strict=True):
            width = n * np.dtype(kind).itemsize
            arrays[name] = raw[at : at + width].view(kind).view(np.ndarray)
            at += width + -width % 8
        return cls(**arrays)

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """The rank of each word, -1 for words that are not in the lexicon; all words step together."""
        n = len(words)
        size = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        begin = np.cumsum(size) - size
        state, rank = np.zeros(n, np.int64), np.zeros(n, np.int64)
        active = np.arange(n)
        for depth in range(int(size.max(initial=0))):
            active = active[size[active] > depth]
            key = state[active] * 256 + data[begin[active] + depth]
            edge = np.searchsorted(self.key, key)
            known = self.key[edge] == key
            rank[active[~known]] = -1
            active, edge = active[known], edge[known]
            if not len(active):
                break
            state[active] = self.to[edge]
            rank[active] += self.skip[edge]
        rank[(rank >= 0) & (self.final[state] == 0)] = -1
        return rank


def _runs(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions first, first + 1, ... of runs of ``size`` entries, one run after the other."""
    end = np.cumsum(size)
    return np.arange(end[-1] if len(end) else 0) - np.repeat(end - size - first, size)


_lexicons: dict[str, Lexicon] = {}


class _Slots(dict):
    """Numbers for words, given when a word is first looked up."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class _Encoder:
    """A worker's words seen so far: each has a slot, slots point into one array of ids."""

    def __init__(self, vocabulary: Vocabulary, file: str):
        self.merger = Merger(vocabulary)
        if file not in _lexicons:
            _lexicons[file] = Lexicon.map(SparkFiles.get(file))
        self.lexicon = _lexicons[file]
        self.forget()

    def forget(self) -> None:
        self.slots = _Slots()
        self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def learn(self, words: list[str]) -> None:
        rank = self.lexicon.ranks([w.encode("utf-8", "surrogatepass") for w in words])
        hit = rank >= 0
        first = self.lexicon.at[rank[hit]]
        size = np.zeros(len(words), np.int64)
        size[hit] = self.lexicon.at[rank[hit] + 1] - first
        merged = [self.merger.merge(words[i]) for i in np.flatnonzero(~hit).tolist()]
        size[~hit] = [len(m) for m in merged]
        begin = np.cumsum(size) - size
        ids = np.zeros(int(size.sum()), np.int32)
        ids[_runs(begin[hit], size[hit])] = self.lexicon.ids[_runs(first, size[hit])]
        ids[_runs(begin[~hit], size[~hit])] = np.fromiter(chain.from_iterable(merged), np.int32, int(size[~hit].sum()))
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, texts: list[str | None]) -> pa.Array:
        words = [self.merger.words(t) if t else [] for t in texts]
        if len(self.slots) > CACHED_WORDS:
            self.forget()
        per_text = np.array([len(w) for w in words], np.int64)
        slots = np.fromiter(map(self.slots.__getitem__, chain.from_iterable(words)), np.int64, int(per_text.sum()))
        if self.slots.new:
            self.learn(self.slots.new)
            self.slots.new = []
        size = self.size[slots]
        flat = self.ids[_runs((np.cumsum(self.size) - self.size)[slots], size)]
        ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(per_text)])]
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat, pa.int32()))

    def encode_column(self, column: pa.Array) -> pa.Array:
        parts = [self.encode(texts) for texts in _slices(column)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))


def _slices(column: pa.Array) -> Iterator[list[str | None]]:
    """The texts of a column, some CHUNK_CHARS bytes at a time."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(column):
        done = ends[at - 1] if at else 0
        stop = max(int(np.searchsorted(ends, done + CHUNK_CHARS)), at + 1)
        yield column[at:stop].to_pylist()
        at = stop


def word_counts(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text") -> DataFrame:
    """(word, n) over all texts; tasks add up their own words before the shuffle."""

    def run(batches):
        merger, seen = Merger(vocabulary), Counter()

        def rows():
            out = pa.RecordBatch.from_pydict(
                {"word": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())}
            )
            seen.clear()
            return out

        for batch in batches:
            for texts in _slices(batch.column(0)):
                for text in texts:
                    if text:
                        seen.update(merger.words(text))
                if len(seen) > COUNTED_AT_ONCE:
                    yield rows()
        yield rows()
        release_memory()

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(
    docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", max_words: int = 150_000, min_count: int = 2
) -> str:
    """Compile the most frequent words of all texts; returns the file's name on every executor.

    Words enter by frequency as long as all words of a frequency fit into ``max_words``, which is
    read off the number of words per frequency: no words are sorted, and ties enter together.
    """
    counts = word_counts(docs, vocabulary, text_col).where((F.col("n") >= min_count) & (F.length("word") <= LONGEST_WORD))
    counts = store(counts, "word-counts")
    per_count = counts.groupBy(F.least("n", F.lit(HIGHEST_COUNT)).alias("n")).agg(F.count(F.lit(1)).alias("words"))
    least, room = None, max_words
    for n, words in sorted(map(tuple, per_count.collect()), reverse=True):  # one row per frequency
        room -= words
        if room < 0:
            break
        least = n
    frequent = counts.where(F.col("n") >= least) if least else counts.where("false")
    merger = Merger(vocabulary)
    entries = {r.word.encode(): merger.merge(r.word) for r in frequent.select("word").collect()}  # max_words at most
    discard(counts)
    return _publish(docs.sparkSession, Lexicon.compile(entries).to_bytes())


def _publish(spark: SparkSession, data: bytes) -> str:
    """Write a file to the shared folder and let Spark hand it to every executor."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    jvm, context = spark.sparkContext._jvm, spark.sparkContext
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    fs = path.getFileSystem(context._jsc.hadoopConfiguration())
    out = fs.create(path)
    out.write(data)
    out.close()
    context.addFile(fs.makeQualified(path).toString())
    return name


def encode(text: Column, vocabulary: Vocabulary, lexicon: str) -> Column:
    """The ids of a text column as array<int>; whole texts, no special tokens added."""

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _Encoder(vocabulary, lexicon)
        for column in batches:
            yield encoder.encode_column(column)
        del encoder
        release_memory()

    return run(text)


def encode_and_decode(text: Column, vocabulary: Vocabulary, lexicon: str) -> Column:
    """A struct (ids, decoded): both directions in one worker."""

    @F.arrow_udf("ids array<int>, decoded string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, tokens = _Encoder(vocabulary, lexicon), pa.array(vocabulary.tokens, pa.string())
        for column in batches:
            # A slice at a time: ids and strings of a whole Arrow batch are never in memory together.
            for texts in _slices(column):
                ids = encoder.encode(texts)
                yield pa.StructArray.from_arrays([ids, _decoded(ids, tokens)], ["ids", "decoded"])
        del encoder, tokens
        release_memory()

    return run(text)


def _decoded(column: pa.Array, tokens: pa.Array) -> pa.Array:
    strings = tokens.take(column.flatten())
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    at = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(at, strings), " ")


def decode(ids: Column, vocabulary: Vocabulary) -> Column:
    """The text of an id list: its token strings joined by spaces, special tokens included."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = pa.array(vocabulary.tokens, pa.string())
        for column in batches:
            yield _decoded(column, tokens)

    return run(ids)


def encode_docs(docs: DataFrame, vocabulary: Vocabulary, lexicon: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids``."""
    return docs.withColumn("ids", encode(F.col(text_col), vocabulary, lexicon))


def encode_and_decode_docs(docs: DataFrame, vocabulary: Vocabulary, lexicon: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids`` and ``decoded``."""
    both = docs.withColumn("__both", encode_and_decode(F.col(text_col), vocabulary, lexicon))
    return both.withColumns({"ids": F.col("__both.ids"), "decoded": F.col("__both.decoded")}).drop("__both")


def decode_docs(docs: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``decoded``."""
    return docs.withColumn("decoded", decode(F.col(ids_col), vocabulary))
