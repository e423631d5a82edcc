"""Document quality by attention-based multiple-instance learning.

A text is a bag of passages of ``PASSAGE_WORDS`` words. Every passage is encoded as a vector of
character-class shares, repetition and length figures and hashed word shares, and goes through a
learned tanh layer. Gated attention, w . (tanh(V h) * sigmoid(U h)) with a softmax over the bag,
weighs the passages; the weighted sum of their representations is scored by a logistic unit. Only
document labels are needed: the gradient finds the passages that decide them.

Training takes a bounded sample of labelled rows (``max_rows`` texts, longer ones with passages of
``TRAINING_CHARACTERS`` in all, a bound on training alone); scoring reads every passage of every text.

Defined results: null or empty text is a bag with one all-zero passage and gets the score of that
bag. Without labelled rows of both classes every score is the share of label 1 (0.5 without any).
Repeated rows are scored alike. Input columns pass through; a clashing ``score`` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm import text as tx
from riskframe.llm.common import class_sample
from riskframe.llm.common import passages as sample_passages

PASSAGE_WORDS = 64
WORD_BUCKETS = 32
TRAINING_CHARACTERS = 200_000

# Classes of bytes: 0 other, then the groups below, then letters, digits, space and non-ASCII.
_GROUPS = ["#", "*", "$", "%", "&", "|", "<>", "!", "?", ".", ",", ";:", "'\"`", "()[]{}", "-_=+", "/\\@~^", "\n"]
_LOWER, _UPPER, _DIGIT, _SPACE, _HIGH = range(len(_GROUPS) + 1, len(_GROUPS) + 6)
CLASSES = _HIGH + 1
_CLASS = np.zeros(256, np.int64)
_CLASS[tx.SPACE] = _SPACE
_CLASS[ord("a") : ord("z") + 1] = _LOWER
_CLASS[ord("A") : ord("Z") + 1] = _UPPER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[128:] = _HIGH
for _i, _group in enumerate(_GROUPS):
    _CLASS[[ord(c) for c in _group]] = _i + 1
FEATURES = CLASSES + 5 + WORD_BUCKETS


def passages(chunk: tx.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages of a chunk, and the number of passages of each text (1 at least)."""
    words = tx.words(chunk)
    per_text = np.maximum(-(-words.per_text // PASSAGE_WORDS), 1)
    first_passage = np.concatenate([[0], np.cumsum(per_text)])
    first_word = np.concatenate([[0], np.cumsum(words.per_text)])
    n = int(first_passage[-1])
    x = np.zeros((n, FEATURES), np.float32)
    rank = np.arange(len(words.begin)) - first_word[words.text]
    own = first_passage[words.text] + rank // PASSAGE_WORDS
    # The passage of a byte: that of the last word begun in its text, else the text's first.
    mark = np.zeros(len(chunk.data), np.int64)
    starts = chunk.start[:-1][np.diff(chunk.start) > 0]
    mark[starts] = first_passage[:-1][np.diff(chunk.start) > 0]
    mark[words.begin] = own
    of_byte = np.maximum.accumulate(mark)
    classes = np.bincount(of_byte * CLASSES + _CLASS[chunk.data], minlength=n * CLASSES).reshape(n, CLASSES)
    size = np.maximum(classes.sum(axis=1), 1)
    x[:, :CLASSES] = np.sqrt(classes / size[:, None])
    count = np.bincount(own, minlength=n)
    some = np.maximum(count, 1)
    key = np.sort((own.astype(np.uint64) << np.uint64(40)) | (words.hash >> np.uint64(24)))
    distinct = key[np.append(key[1:] != key[:-1], True)[: len(key)]] >> np.uint64(40)
    x[:, CLASSES] = np.bincount(distinct.astype(np.int64), minlength=n) / some
    same = np.zeros(len(own), bool)
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (own[1:] == own[:-1])
    x[:, CLASSES + 1] = np.bincount(own[same], minlength=n) / some
    x[:, CLASSES + 2] = np.log1p(size / some) / 4
    x[:, CLASSES + 3] = count / PASSAGE_WORDS
    x[:, CLASSES + 4] = np.bincount(own, (words.end - words.begin) > 15, minlength=n) / some
    bucket = (words.hash % np.uint64(WORD_BUCKETS)).astype(np.int64)
    shares = np.bincount(own * WORD_BUCKETS + bucket, minlength=n * WORD_BUCKETS).reshape(n, WORD_BUCKETS)
    x[:, CLASSES + 5 :] = np.sqrt(shares / some[:, None])
    return x, per_text


@dataclass
class Weights:
    """Encoder (We, be), attention (V, U, w), scorer (c, b); inputs are (x - shift) * scale."""

    shift: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray]
    constant: float | None = None

    def forward(self, x: np.ndarray, per_text: np.ndarray) -> dict[str, np.ndarray]:
        p, bag = self.p, np.repeat(np.arange(len(per_text)), per_text)
        at = np.concatenate([[0], np.cumsum(per_text)[:-1]])
        x = (x - self.shift) * self.scale
        h = np.tanh(x @ p["We"] + p["be"])
        tv, su = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (tv * su) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, at)[bag])
        a = e / np.add.reduceat(e, at)[bag]
        z = np.add.reduceat(a[:, None] * h, at, axis=0)
        s = 1 / (1 + np.exp(-(z @ p["c"] + p["b"])))
        return {"x": x, "h": h, "tv": tv, "su": su, "a": a, "z": z, "s": s, "bag": bag, "at": at}

    def score(self, x: np.ndarray, per_text: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(per_text), self.constant)
        return self.forward(x.astype(np.float64), per_text)["s"]

    def gradient(self, x: np.ndarray, per_text: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss; one backward pass through scorer, attention and encoder."""
        p, f = self.p, self.forward(x, per_text)
        bag, at = f["bag"], f["at"]
        ds = (f["s"] - y) / len(y)
        dz = ds[:, None] * p["c"]
        da = (dz[bag] * f["h"]).sum(axis=1)
        de = f["a"] * (da - np.add.reduceat(f["a"] * da, at)[bag])
        dg = de[:, None] * p["w"]
        dv = dg * f["su"] * (1 - f["tv"] ** 2)
        du = dg * f["tv"] * f["su"] * (1 - f["su"])
        dh = f["a"][:, None] * dz[bag] + dv @ p["V"].T + du @ p["U"].T
        dx = dh * (1 - f["h"] ** 2)
        return {
            "We": f["x"].T @ dx, "be": dx.sum(axis=0), "V": f["h"].T @ dv, "U": f["h"].T @ du,
            "w": (f["tv"] * f["su"]).T @ de, "c": f["z"].T @ ds, "b": ds.sum(),
        }


def _bags(batches):
    for batch in batches:
        rows, counts = [], []
        for chunk in tx.chunks(batch.column("text")):
            x, per_text = passages(chunk)
            at = np.concatenate([[0], np.cumsum(per_text)])
            rows += [x[at[i] : at[i + 1]].tobytes() for i in range(len(chunk))]
            counts.append(per_text)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("label"), pa.array(rows, pa.binary())], ["id", "label", "x"]
        )


def train(
    labelled: DataFrame,
    text_col: str = "text",
    label_col: str = "quality",
    id_col: str = "doc_id",
    max_rows: int = 3000,
    least_rows: int = 300,
    hidden: int = 24,
    attention: int = 16,
    epochs: int = 25,
    rate: float = 0.01,
    seed: int = 17,
) -> Weights:
    """Fit on at most ``max_rows`` rows of ``labelled`` (text and a label 0 or 1), up to ``least_rows``
    of either label first."""
    usable = labelled.where(F.col(label_col).isin(0, 1) & F.col(text_col).isNotNull())
    sample = class_sample(usable, id_col, label_col, text_col, max_rows, least_rows, seed).select(
        F.col(id_col).cast("string").alias("id"),
        F.col(label_col).cast("int").alias("label"),
        sample_passages(F.col(text_col), TRAINING_CHARACTERS).alias("text"),
    )
    # max_rows bags of bounded size
    rows = sorted(sample.mapInArrow(_bags, "id string, label int, x binary").collect(), key=lambda r: r.id)
    y = np.array([r.label for r in rows], float)
    zero = np.zeros(FEATURES)
    if len(set(y)) < 2:
        return Weights(zero, zero, {}, float(y.mean()) if len(y) else 0.5)
    bags = [np.frombuffer(r.x, np.float32).astype(float).reshape(-1, FEATURES) for r in rows]
    every = np.vstack(bags)
    rng = np.random.default_rng(seed)

    def draw(*shape):
        return rng.standard_normal(shape) / np.sqrt(shape[0])

    model = Weights(
        every.mean(axis=0),
        1 / (every.std(axis=0) + 0.05),
        {
            "We": draw(FEATURES, hidden), "be": np.zeros(hidden), "V": draw(hidden, attention),
            "U": draw(hidden, attention), "w": draw(attention), "c": draw(hidden), "b": np.array(0.0),
        },
    )
    first = {k: np.zeros_like(v) for k, v in model.p.items()}
    second = {k: np.zeros_like(v) for k, v in model.p.items()}
    t = 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for i in range(0, len(bags), 64):
            own = order[i : i + 64]
            g = model.gradient(np.vstack([bags[k] for k in own]), np.array([len(bags[k]) for k in own]), y[own])
            t += 1
            for k, v in model.p.items():
                grad = g[k] + 1e-4 * v
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad**2
                step = rate * (1 - epoch / epochs)
                model.p[k] = v - step * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    return model


def score(model: Weights, text: Column) -> Column:
    """The probability of label 1 for a text column; every passage of the whole text counts."""

    @F.arrow_udf("double")
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            out = [np.zeros(0)]
            for chunk in tx.chunks(column):
                out.append(model.score(*passages(chunk)))
            # Twelve digits: how texts are dealt to chunks does not show.
            yield pa.array(np.round(np.concatenate(out), 12), pa.float64())

    return apply(text)


def score_quality(docs: DataFrame, model: Weights, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 from ``threshold`` on)."""
    scored = docs.withColumn("score", score(model, F.col(text_col)))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
