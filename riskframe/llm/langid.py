"""Language identification with averaged hashed subword embeddings.

Every run of two to four bytes of the lower-cased text that has white space only at its ends is a
subword. Subwords are hashed to rows of an embedding table, a text is the mean of its rows, and a
linear softmax over that mean gives the languages. Embeddings and softmax are trained together by
stochastic gradient descent in numpy on a bounded sample (with rows of every language); a temperature
(at least 1: scores are only softened) is fitted on rows of that sample that the descent never saw.

Rejection. A softmax is sure of itself far from anything it was trained on, so two limits hold, both
calibrated on the same unseen rows, for a stated share of them: the least score, and the largest
share of subwords of three and four bytes that the training rows of the predicted language never
had. Words with digits do not count for that share unless the text has hardly others, and short
texts get two standard deviations of slack.

Defined results: null text, or text without a letter: language ``und``, score 0, rejected. An empty
training sample: ``und`` everywhere. Rows with a null language never train. Ties go to the
language first in alphabetical order. Input columns pass through; clashing names of the outputs
are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm import text as tx
from riskframe.llm.common import class_sample, release_memory

SIZES = (2, 3, 4)
UNKNOWN = "und"
_GAP = np.uint8(0x20)
# Subwords are remembered in this many places per language.
MEMORY = 1 << 20
# Below this share of all subwords, those of words without digits are too few to judge by.
PLAIN_SHARE = 0.2
SLACK = 2.0
_PLAIN = np.zeros(256, bool)
_PLAIN[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100), 0x20]] = True


@dataclass
class LanguageModel:
    """``logits`` (buckets x languages) is embeddings times softmax weights."""

    languages: list[str]
    logits: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0
    seen: np.ndarray | None = None  # languages x (MEMORY + 1) flags
    most_unseen: float = 1.0

    def is_strange(self, found: np.ndarray, plain: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Whether too many subwords are new; columns of ``found``: unseen plain ones, plain ones, unseen, all."""
        few = plain < PLAIN_SHARE * own
        n = np.where(few, own, plain)
        unseen = np.where(few, found[:, 1], found[:, 0])
        limit = self.most_unseen
        return unseen > limit * n + SLACK * np.sqrt(limit * (1 - limit) * n)

    def scores(self, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
        z = (sums / np.maximum(counts, 1)[:, None] + self.bias) / self.temperature
        z -= z.max(axis=1, keepdims=True)
        e = np.exp(z)
        return e / e.sum(axis=1, keepdims=True)


def subwords(chunk: tx.Chunk, buckets: int) -> list[np.ndarray]:
    """Per size: the bucket of the subword at every byte; ``buckets`` where none starts."""
    data = tx.LOWER[chunk.data]
    space = tx.SPACE[data]
    data[space] = _GAP
    crossing = np.zeros(len(data) + 1, bool)
    crossing[chunk.start[1:]] = True  # a text ends before this byte
    out = []
    for n, h in tx.grams(data, SIZES):
        m = len(h)
        bad = np.zeros(m, bool)
        for k in range(1, n):
            bad |= crossing[k : k + m]
            if k < n - 1:
                bad |= space[k : k + m]
        if n == 2:
            bad |= space[:m] & space[1:]
        index = np.full(len(data), buckets, np.int32)
        index[:m] = h % np.uint32(buckets)
        index[:m][bad] = buckets
        out.append(index)
    return out + [np.full(len(data), buckets, np.int32)] * (len(SIZES) - len(out))


def _memory_places(chunk: tx.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Places of the subwords of three and four bytes at every byte (MEMORY where none starts), one row
    per size, and which are plain: of letters, in words without digits."""
    places = np.stack(subwords(chunk, MEMORY)[1:3])
    data = tx.LOWER[chunk.data]
    space = tx.SPACE[data]
    words = tx.words(chunk)
    digits = np.append(0, np.cumsum((data >= 48) & (data <= 57)))
    has = digits[words.end] > digits[words.begin]
    depth = np.zeros(len(data) + 1, np.int32)
    depth[words.begin[has]] += 1
    depth[words.end[has]] -= 1
    fine = (_PLAIN[data] | space) & (np.cumsum(depth)[:-1] == 0)
    plain = places < MEMORY
    for row, n in zip(plain, SIZES[1:], strict=True):
        for k in range(n):
            row[: len(row) - k] &= fine[k:]
    return places, plain


def _unseen(chunk: tx.Chunk, seen: np.ndarray, language: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: unseen subwords (plain, all), plain ones and all, for the given languages."""
    places, plain = _memory_places(chunk)
    size = np.diff(chunk.start)
    new = ~seen[np.repeat(language, size)[None, :], places] & (places < MEMORY)

    def total(flags: np.ndarray) -> np.ndarray:
        return tx.sum_by(flags.sum(axis=0).astype(np.float64), size)

    return np.stack([total(new & plain), total(new)], axis=1), total(plain), total(places < MEMORY)


def _squeezed(kinds: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending numbers and their counts (to 255), small enough to send thousands of lists to the driver."""
    steps = np.diff(kinds, prepend=0).astype(np.uint32)
    return zlib.compress(steps.tobytes() + np.minimum(times, 255).astype(np.uint8).tobytes(), 1)


def _stretched(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(data)
    n = len(raw) // 5
    return np.cumsum(np.frombuffer(raw, np.uint32, n).astype(np.int64)), np.frombuffer(raw, np.uint8, n, 4 * n).astype(np.int64)


def _sample_features(buckets: int):
    """Rows (id, label, at, value, memory): the mean bucket vector of each text, sparse, and its
    remembered subwords with their counts."""

    def run(batches):
        for batch in batches:
            index, value, memory = [], [], []
            for chunk in tx.chunks(batch.column("text")):
                found = subwords(chunk, buckets)
                places, plain = _memory_places(chunk)
                # A place and its flag in one number, each kind once with its count.
                marked = places.astype(np.int64) * 2 + plain
                for i in range(len(chunk)):
                    own = [f[chunk.start[i] : chunk.start[i + 1]] for f in found]
                    n = np.bincount(np.concatenate([*own, [buckets]]), minlength=buckets + 1)[:-1]
                    index.append(np.flatnonzero(n).astype(np.uint16).tobytes())
                    value.append((n[n > 0] / max(n.sum(), 1)).astype(np.float32).tobytes())
                    mine = marked[:, chunk.start[i] : chunk.start[i + 1]].ravel()
                    kinds, times = np.unique(mine[mine < 2 * MEMORY], return_counts=True)
                    memory.append(_squeezed(kinds, times))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("label"),
                    pa.array(index, pa.binary()),
                    pa.array(value, pa.binary()),
                    pa.array(memory, pa.binary()),
                ],
                ["id", "label", "at", "value", "memory"],
            )

    return run


def _descend(x, y, rows, classes, dims, epochs, rate, seed, batch=32):
    """Train on the given rows of ``x``; only batches are copied."""
    rng = np.random.default_rng(seed)
    table = (rng.standard_normal((x.shape[1], dims)) / np.sqrt(dims)).astype(np.float32)
    weights = np.zeros((dims, classes), np.float32)
    bias = np.zeros(classes, np.float32)
    truth = np.eye(classes, dtype=np.float32)[y]
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = rng.permutation(rows)
        for at in range(0, len(order), batch):
            own = order[at : at + batch]
            xb = x[own]
            mean = xb @ table
            z = mean @ weights + bias
            z -= z.max(axis=1, keepdims=True)
            p = np.exp(z)
            g = (p / p.sum(axis=1, keepdims=True) - truth[own]) / len(own)
            back = g @ weights.T
            weights -= step * (mean.T @ g)
            bias -= step * g.sum(axis=0)
            seen = np.flatnonzero(xb.any(axis=0))
            table[seen] -= step * (xb[:, seen].T @ back)
    return table @ weights, bias


def train(
    docs: DataFrame,
    text_col: str = "text",
    label_col: str = "lang",
    id_col: str = "doc_id",
    max_rows: int = 2000,
    buckets: int = 8192,
    dims: int = 16,
    epochs: int = 30,
    rate: float = 20.0,
    calibration_share: float = 0.25,
    reject_share: float = 0.002,
    least_rows: int = 100,
    seed: int = 17,
) -> LanguageModel:
    """Fit on at most ``max_rows`` labelled rows of ``docs``, up to ``least_rows`` of every language
    first; ``buckets`` up to 65,536.

    At most ``reject_share`` of the rightly predicted calibration rows score below the threshold, and
    at most that share has more unseen subwords than the limit.
    """
    usable = docs.where(F.col(label_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    sample = class_sample(usable, id_col, label_col, text_col, max_rows, least_rows, seed)
    rows = (
        sample.select(
            F.col(id_col).cast("string").alias("id"),
            F.col(label_col).cast("string").alias("label"),
            F.col(text_col).alias("text"),
        )
        .mapInArrow(_sample_features(buckets), "id string, label string, at binary, value binary, memory binary")
        .collect()  # max_rows sparse vectors
    )
    rows.sort(key=lambda r: r.id)
    languages = sorted({r.label for r in rows})
    if not languages:
        return LanguageModel([], np.zeros((buckets, 0)), np.zeros(0))
    x = np.zeros((len(rows), buckets), np.float32)
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r.at, np.uint16)] = np.frombuffer(r.value, np.float32)
    y = np.array([languages.index(r.label) for r in rows])
    memory = [r.memory for r in rows]
    del rows
    rng = np.random.default_rng(seed)
    apart = rng.random(len(y)) < calibration_share
    if apart.all() or not apart.any():
        apart[:] = False
    logits, bias = _descend(x, y, np.flatnonzero(~apart), len(languages), dims, epochs, rate, seed)
    model = LanguageModel(languages, logits.astype(np.float32), bias.astype(np.float64))
    model.seen = np.zeros((len(languages), MEMORY + 1), bool)
    for i in np.flatnonzero(~apart):
        model.seen[y[i], _stretched(memory[i])[0] >> 1] = True
    own = np.flatnonzero(apart) if apart.any() else np.arange(len(y))
    xc, yc = x[own], y[own]
    sums, ones = xc @ model.logits, np.ones(len(xc))

    def loss(t: float) -> float:
        model.temperature = t
        return -np.log(model.scores(sums, ones)[np.arange(len(yc)), yc] + 1e-12).mean()

    model.temperature = min(np.geomspace(1, 10, 40), key=loss)
    p = model.scores(sums, ones)
    right = np.flatnonzero(p.argmax(axis=1) == yc)
    if len(right):
        model.threshold = float(np.quantile(p.max(axis=1)[right], reject_share))
        shares = []
        for i in right:
            kinds, times = _stretched(memory[own[i]])
            new = ~model.seen[yc[i], kinds >> 1]
            plain = (kinds & 1) * times
            use = plain if plain.sum() >= PLAIN_SHARE * times.sum() else times
            shares.append((new * use).sum() / max(use.sum(), 1))
        model.most_unseen = float(np.quantile(shares, 1 - reject_share))
    return model


def prediction(model: LanguageModel, text: Column) -> Column:
    """A struct (lettered, found (lang, score, strange)) for a text column; whole texts are read."""
    buckets = len(model.logits)
    per_class = [np.append(model.logits[:, c], np.float32(0)) for c in range(len(model.languages))]
    languages = pa.array(model.languages, pa.string())

    @F.arrow_udf("lang string, score double, strange boolean")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            best, score, strange = [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0, bool)]
            for chunk in tx.chunks(column):
                found, size = subwords(chunk, buckets), np.diff(chunk.start)
                sums = np.stack([tx.sum_by(sum(t[f] for f in found), size) for t in per_class], axis=1)
                counts = tx.sum_by(sum((f < buckets).astype(np.float32) for f in found), size)
                p = model.scores(sums, counts)
                best.append(p.argmax(axis=1))
                score.append(p.max(axis=1))
                strange.append(model.is_strange(*_unseen(chunk, model.seen, best[-1])))
            columns = [languages.take(pa.array(np.concatenate(best))), *(pa.array(np.concatenate(c)) for c in (score, strange))]
            yield pa.StructArray.from_arrays(columns, ["lang", "score", "strange"])
        release_memory()

    lettered = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    if not model.languages:
        lettered, found = F.lit(False), F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"), F.lit(True).alias("strange"))
    else:
        found = predict(text)
    return F.struct(lettered.alias("lettered"), found.alias("found"))


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (calibrated, 0 to 1) and ``rejected``."""
    raw = docs.withColumn("__prediction", prediction(model, F.col(text_col)))
    lettered = F.col("__prediction.lettered")
    score = F.when(lettered, F.col("__prediction.found.score")).otherwise(F.lit(0.0))
    return raw.withColumns(
        {
            "lang_pred": F.when(lettered, F.col("__prediction.found.lang")).otherwise(F.lit(UNKNOWN)),
            "score": score,
            "rejected": ~lettered | F.col("__prediction.found.strange") | (score < model.threshold),
        }
    ).drop("__prediction")


def keep_identified(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, columns unchanged."""
    p = prediction(model, F.col(text_col))
    return docs.where(p["lettered"] & ~p["found"]["strange"] & (p["found"]["score"] >= model.threshold))
