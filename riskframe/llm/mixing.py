"""Soft-membership mixing of documents to target domain weights.

A softmax classifier over hashed word presence, trained on a labelled table, gives every document
posteriors p_ij over domains. Rates x_i (how often document i is used) within bounds are fitted so
that expected tokens per domain, A x with A x = sum_i x_i t_i p_i, meet the targets b in least squares:

    minimise |A x - b|^2 / (2 RIDGE) + sum_i t_i (x_i - 1)^2 / 2   (all tokens together are 1)

The second part, small against the first, picks the rates closest to 1 among all that fit. Descent is
by lazily projected gradients: a step moves every rate by p_i . s with the same vector s, and rates are
the projection of 1 minus the sum of all steps so far,

    x_i = min(upper_i, max(lower_i, 1 - p_i . steps)),

so a pass over the rows needs that one sum, returns a few sums per domain, and no state is written
between passes. A step is the gradient scaled by the Gram matrix of the rows that are not at a bound;
each pass tries the step with several dampings at once and keeps the best. The problem is convex, so the
solution is reached when the gradient A x - b - RIDGE * steps vanishes (``Mix.gradient``); the
descent stops there, and ``Mix.converged`` says so.

Domains named in ``keep`` must not be thinned: they alone set the total, the weights of the others
are upper limits, a document whose likeliest domain is kept has a rate from 1 to ``MOST``, and any
other one of at most 1. Rates are nonnegative always. Targets can be out of reach for two reasons: kept
documents hold more tokens of a limited domain than its limit allows, or a kept domain is to grow
while the posteriors of its documents are mixed. ``Mix`` then has the nearest totals, the residual of
every domain, and in ``exceeded`` the domains whose limit is passed.

Defined results: null or empty text has 0 tokens and the prior posteriors of an empty bag. Without
labelled rows, posteriors are equal; a single domain has posterior 1. An empty table gives an
empty table. Repeated rows get equal rates. Extra input columns pass through; outputs replace
columns of the same name.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm import text as tx
from riskframe.llm.common import class_sample, passages, release_memory

BUCKETS = 1 << 17
# Longer texts take part in training with passages of this many characters in all.
TRAINING_CHARACTERS = 200_000
# The weight of rates near 1 against targets; part by which a limit may be passed.
RIDGE, EXCESS = 1e-5, 0.001
# Steps tried in one pass: damped by these parts of the current damping, which adapts.
DAMPINGS = (0.0, 1.0, 30.0, 1000.0)
# The most uses of a document of a kept domain.
MOST = 4.0


@dataclass
class DomainModel:
    """Softmax weights (buckets x domains) over the presence of hashed words."""

    domains: list[str]
    weights: np.ndarray
    bias: np.ndarray


@dataclass
class Mix:
    """The sum of all steps, and per domain the target and the expected total, in tokens."""

    domains: list[str]
    targets: dict[str, float]
    totals: dict[str, float] = field(default_factory=dict)
    steps: list[float] = field(default_factory=list)
    keep: list[int] = field(default_factory=list)  # places of the kept domains
    passes: int = 0
    gradient: float = 0.0  # largest component at the solution, in shares of all tokens
    converged: bool = True

    @property
    def residuals(self) -> dict[str, float]:
        """Expected total less target."""
        return {d: self.totals[d] - t for d, t in self.targets.items()}

    @property
    def exceeded(self) -> list[str]:
        """Domains that are limited (not kept, where some are) and get over EXCESS more than their limit."""
        limited = [d for j, d in enumerate(self.domains) if self.keep and j not in self.keep]
        return [d for d in limited if self.totals[d] > self.targets[d] * (1 + EXCESS) + 1]


def _present(chunk: tx.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the distinct words of each text, how many, and the words of each text."""
    words = tx.words(chunk)
    bucket = words.hash % np.uint64(BUCKETS)
    key = np.sort((words.text.astype(np.uint64) << np.uint64(17)) | bucket)
    key = key[np.append(key[1:] != key[:-1], True)[: len(key)]]
    per_text = np.bincount((key >> np.uint64(17)).astype(np.int64), minlength=len(chunk))
    return (key & np.uint64(BUCKETS - 1)).astype(np.int32), per_text, words.per_text


def _logits(index: np.ndarray, per_text: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    columns = [tx.sum_by(weights[index, c], per_text) for c in range(weights.shape[1])]
    z = np.stack(columns, axis=1) / np.sqrt(np.maximum(per_text, 1))[:, None] + bias
    return z - z.max(axis=1, keepdims=True)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z)
    return e / e.sum(axis=1, keepdims=True)


def _sample_rows(batches):
    for batch in batches:
        rows = []
        for chunk in tx.chunks(batch.column("text")):
            index, per_text, _ = _present(chunk)
            at = np.concatenate([[0], np.cumsum(per_text)])
            rows += [index[at[i] : at[i + 1]].tobytes() for i in range(len(chunk))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("domain"), pa.array(rows, pa.binary())], ["id", "domain", "at"]
        )


def train(
    labelled: DataFrame,
    text_col: str = "text",
    domain_col: str = "domain",
    id_col: str = "doc_id",
    max_rows: int = 6000,
    least_rows: int = 500,
    epochs: int = 60,
    rate: float = 0.05,
    decay: float = 1e-4,
    seed: int = 17,
) -> DomainModel:
    """Fit on at most ``max_rows`` labelled rows, up to ``least_rows`` of every domain first."""
    usable = labelled.where(F.col(text_col).isNotNull())
    rows = (
        class_sample(usable, id_col, domain_col, text_col, max_rows, least_rows, seed)
        .select(
            F.col(id_col).cast("string").alias("id"),
            F.col(domain_col).cast("string").alias("domain"),
            passages(F.col(text_col), TRAINING_CHARACTERS).alias("text"),
        )
        .mapInArrow(_sample_rows, "id string, domain string, at binary")
        .collect()  # max_rows lists of distinct words
    )
    rows.sort(key=lambda r: r.id)
    domains = sorted({r.domain for r in rows})
    n = max(len(domains), 1)
    weights, bias = np.zeros((BUCKETS, n)), np.zeros(n)
    if len(domains) < 2:
        return DomainModel(domains, weights.astype(np.float32), bias)
    bags = [np.frombuffer(r.at, np.int32) for r in rows]
    index, per_text = np.concatenate(bags), np.array([len(b) for b in bags])
    scale = 1 / np.sqrt(np.maximum(per_text, 1))
    truth = np.eye(n)[[domains.index(r.domain) for r in rows]]
    moments = [np.zeros_like(weights), np.zeros_like(weights)]
    for t in range(1, epochs + 1):
        g = (_softmax(_logits(index, per_text, weights, bias)) - truth) / len(rows)
        bias -= 2.0 * g.sum(axis=0)
        spread = np.repeat(g * scale[:, None], per_text, axis=0)
        grad = np.stack([np.bincount(index, spread[:, c], BUCKETS) for c in range(n)], axis=1) + decay * weights
        moments[0] = 0.9 * moments[0] + 0.1 * grad
        moments[1] = 0.99 * moments[1] + 0.01 * grad**2
        weights -= rate * (moments[0] / (1 - 0.9**t)) / (np.sqrt(moments[1] / (1 - 0.99**t)) + 1e-6)
    return DomainModel(domains, weights.astype(np.float32), bias)


def posteriors(model: DomainModel, text: Column) -> Column:
    """A struct (tokens, p): the words of a text and its posteriors in the order of ``domains``."""

    @F.arrow_udf("tokens bigint, p array<double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            tokens, p = [], []
            for chunk in tx.chunks(column):
                index, per_text, n_words = _present(chunk)
                tokens.append(n_words)
                p.append(_softmax(_logits(index, per_text, model.weights, model.bias)))
            flat = np.concatenate(p).ravel()
            size = len(model.bias)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, size, dtype=np.int32)), pa.array(flat))
            yield pa.StructArray.from_arrays([pa.array(np.concatenate(tokens), pa.int64()), lists], ["tokens", "p"])
        release_memory()

    return run(text)


def _kept(p: Sequence[Column], keep: Sequence[int]) -> Column:
    """Whether a kept domain is the likeliest."""
    clean = F.lit(True)
    for j in set(range(len(p))) - set(keep):
        clean = clean & (F.greatest(*[p[k] for k in keep], F.lit(0.0)) >= p[j])
    return clean


def _bounded(p: Sequence[Column], keep: Sequence[int], free: Column) -> tuple[Column, Column]:
    """A rate within its bounds, and whether it is inside of them."""
    if not keep:
        return F.greatest(F.lit(0.0), free), free > 0
    kept = _kept(p, keep)
    low, high = F.when(kept, 1.0).otherwise(0.0), F.when(kept, MOST).otherwise(1.0)
    return F.least(high, F.greatest(low, free)), (free > low) & (free < high)


def rate_of(mix: Mix, p: Sequence[Column]) -> Column:
    """The rate of a row from its posteriors."""
    if not mix.steps:
        return F.lit(1.0)
    return _bounded(p, mix.keep, 1 - sum(pj * float(v) for pj, v in zip(p, mix.steps, strict=True)))[0]


def fit(
    rows: DataFrame,
    domains: Sequence[str],
    weights: Mapping[str, float],
    repeats: float = 1.0,
    keep: Sequence[str] = (),
    max_passes: int = 40,
    tolerance: float = 1e-9,
) -> Mix:
    """Fit rates for stored rows (tokens, p), one short pass per step.

    ``weights`` are wanted shares. The total is the largest at which no domain of ``keep`` has to be
    used more than ``repeats`` times its supply; the others are used up to their share of that total,
    and no more than once where their supply is shorter. If the model knows no domain of ``keep``,
    nothing is thinned. Without ``keep``, every wanted domain with supply bounds the total.
    """
    n = len(domains)
    if not n:
        return Mix([], {})
    t, p = F.col("tokens").cast("double"), [F.col("p")[j] for j in range(n)]

    def sums(*columns: Column) -> np.ndarray:
        first = rows.agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(f"c{i}") for i, c in enumerate(columns)]).first()
        return np.array(list(first), float)

    supply = sums(*[t * c for c in p])
    everything = supply.sum()
    share = np.array([max(weights.get(d, 0.0), 0.0) for d in domains])
    named = dict(zip(domains, supply.tolist(), strict=True))
    if everything == 0 or share.sum() == 0:
        return Mix(list(domains), named, named)
    share /= share.sum()
    wanted = (share > 0) & (supply > 0)
    kept = np.array([d in keep for d in domains])
    if keep and not (wanted & kept).any():
        return Mix(list(domains), named, named)
    bound = wanted & kept if keep else wanted
    total = repeats * (supply[bound] / share[bound]).min()
    tokens = np.where(kept, share * total, np.minimum(share * total, supply)) if keep else share * total
    target = tokens / everything
    mix = Mix(list(domains), dict(zip(domains, tokens.tolist(), strict=True)), keep=np.flatnonzero(kept).tolist())
    pairs = [(i, j) for i in range(n) for j in range(i, n)]
    w = t / float(everything)

    def measured(trials: Sequence[np.ndarray]) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """Dual objective, totals and Gram matrix of the rows inside their bounds, at each point."""
        columns = []
        for point in trials:
            free = 1 - sum(c * float(v) for c, v in zip(p, point, strict=True))
            x, inside = _bounded(p, mix.keep, free)
            # The gain of a row: -(p . point) x - (x - 1)^2 / 2 at its best x.
            columns.append(w * ((free - 1) * x - (x - 1) * (x - 1) / 2))
            columns += [w * c * x for c in p]
            columns += [F.when(inside, w * p[i] * p[j]).otherwise(0.0) for i, j in pairs]
        found = sums(*columns).reshape(len(trials), -1)
        out = []
        for point, row in zip(trials, found, strict=True):
            gram = np.zeros((n, n))
            for (i, j), v in zip(pairs, row[1 + n :], strict=True):
                gram[i, j] = gram[j, i] = v
            objective = row[0] + point @ target + RIDGE / 2 * point @ point
            out.append((objective, row[1 : 1 + n], gram))
        return out

    point, damping = np.zeros(n), 1e-2
    objective, reached, gram = measured([point])[0]
    while True:
        # Ten digits: the order in which tasks add up does not show.
        gradient = np.round(reached - target, 10) - RIDGE * point
        mix.passes, mix.gradient = mix.passes + 1, float(np.abs(gradient).max())
        mix.converged = mix.gradient <= tolerance
        if mix.converged or mix.passes >= max_passes:
            break
        tried = [d * damping for d in DAMPINGS]
        trials = [point + np.linalg.solve(gram + (RIDGE + d) * np.eye(n), gradient) for d in tried]
        found = measured(trials)
        best = min(range(len(trials)), key=lambda k: found[k][0])
        if found[best][0] < objective:
            damping = max(tried[best], damping / 30 if best == 0 else 0) / 3
            point, (objective, reached, gram) = trials[best], found[best]
        elif damping > 1e6:  # no digit is left to gain
            mix.converged = mix.gradient <= 1e-6
            break
        else:
            damping *= 1e4
    mix.steps = [float(v) for v in point]
    mix.totals = dict(zip(domains, (reached * everything).tolist(), strict=True))
    if not mix.converged:
        warnings.warn(f"mixing stopped after {mix.passes} passes at a gradient of {mix.gradient:.1e}", stacklevel=2)
    if mix.exceeded:
        warnings.warn(f"limits out of reach: {', '.join(mix.exceeded)}", stacklevel=2)
    return mix


def copies(rate: Column, id_col: str, seed: int = 17) -> Column:
    """A whole number of uses with expectation ``rate``, the same for a given id in every run."""
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(rate + draw).cast("int")
