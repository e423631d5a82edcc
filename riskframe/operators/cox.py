"""Cox proportional hazards by Newton's method with Efron ties and an L2 penalty.

Objective: partial log-likelihood - n * penalizer / 2 * |beta|^2 (n rows), on
standardised features. Every step is one grouped aggregate per distinct time; the
driver solves a d x d system.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.ordering import prefix_sum
from riskframe.session import cut_lineage

# Per-time sums of this many times fit the driver; beyond, they stay distributed.
MAX_TIMES_ON_DRIVER = 2_000
# A task flushes its partial sums beyond this many distinct times.
HELD_TIMES = 4_096
DIRECT_TIES = 10_000


@dataclass
class CoxModel:
    features: list[str]
    beta: np.ndarray
    covariance: np.ndarray
    log_likelihood: float
    gradient_norm: float
    iterations: int

    def coefficients(self) -> dict[str, float]:
        return dict(zip(self.features, map(float, self.beta)))

    def table(self, spark: SparkSession, z: float = 1.96) -> DataFrame:
        """One row per feature, the largest coefficient first: coefficient, hazard ratio, standard
        error, 95 % interval and rank."""
        se = np.sqrt(np.diag(self.covariance))
        order = sorted(range(len(self.features)), key=lambda i: (-self.beta[i], self.features[i]))
        rows = [
            (f, float(b), float(math.exp(b)), float(s), float(b - z * s), float(b + z * s), rank)
            for rank, (f, b, s) in enumerate(((self.features[i], self.beta[i], se[i]) for i in order), 1)
        ]
        return spark.createDataFrame(
            rows,
            "feature string, coef double, hazard_ratio double, se double, "
            "lower_95 double, upper_95 double, rank int",
        )


def _digamma(x: float) -> float:
    out = 0.0
    while x < 8:
        out -= 1 / x
        x += 1
    f = 1 / (x * x)
    return out + math.log(x) - 0.5 / x - f * (1 / 12 - f * (1 / 120 - f / 252))


def _trigamma(x: float) -> float:
    out = 0.0
    while x < 8:
        out += 1 / (x * x)
        x += 1
    f = 1 / (x * x)
    return out + 1 / x + f / 2 + f / x * (1 / 6 - f * (1 / 30 - f / 42))


def tie_sums(d: int, s: float, e: float) -> tuple[float, ...]:
    """Over l = 0..d-1 with u = l/d and den = s - u*e: the sums of log den, 1/den, u/den,
    1/den^2, u/den^2 and u^2/den^2. Many ties use closed forms instead of a loop."""
    if d <= DIRECT_TIES:
        u = np.arange(d) / d
        den = s - u * e
        inv = 1 / den
        return (
            float(np.log(den).sum()),
            float(inv.sum()),
            float((u * inv).sum()),
            float((inv * inv).sum()),
            float((u * inv * inv).sum()),
            float((u * u * inv * inv).sum()),
        )
    if e < 0.5 * s:
        # Smooth on [0, 1]: Simpson integral plus the end-point correction of the sum.
        u = np.linspace(0, 1, 2049)
        den = s - u * e

        def total(f):
            weights = np.ones_like(u)
            weights[1:-1:2], weights[2:-1:2] = 4, 2
            integral = float((weights * f).sum()) / (3 * 2048)
            return d * integral - (float(f[-1]) - float(f[0])) / 2

        return tuple(
            total(f)
            for f in (np.log(den), 1 / den, u / den, den**-2, u * den**-2, u * u * den**-2)
        )
    x, scale = s * d / e, d / e
    h1 = scale * (_digamma(x + 1) - _digamma(x - d + 1))
    h2 = scale * scale * (_trigamma(x - d + 1) - _trigamma(x + 1))
    logs = d * math.log(e / d) + math.lgamma(x + 1) - math.lgamma(x - d + 1)
    return (
        logs,
        h1,
        (s * h1 - d) / e,
        h2,
        (s * h2 - h1) / e,
        (s * s * h2 - 2 * s * h1 + d) / (e * e),
    )


def _pairs(p: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each entry of the upper triangle."""
    return np.triu_indices(p)


def _contributions(d: np.ndarray, at_risk: np.ndarray, events: np.ndarray, p: int) -> np.ndarray:
    """Sum over times of [log-likelihood part, gradient part, information part].

    Rows are times; columns are sums of w, w*z_j and w*z_j*z_k, over rows at risk and
    over events at that time.
    """
    jj, kk = _pairs(p)
    out = np.zeros(1 + p + len(jj))
    for n, r, e in zip(d, at_risk, events):
        if n <= 0:
            continue
        a, b = r[1 : 1 + p], e[1 : 1 + p]
        logs, h1, m1, h2, k1, k2 = tie_sums(int(n), float(r[0]), float(e[0]))
        out[0] -= logs
        out[1 : 1 + p] -= a * h1 - b * m1
        out[1 + p :] += (
            r[1 + p :] * h1
            - e[1 + p :] * m1
            - a[jj] * a[kk] * h2
            + (a[jj] * b[kk] + b[jj] * a[kk]) * k1
            - b[jj] * b[kk] * k2
        )
    return out


def _per_time(rows: DataFrame, features: Sequence[str], beta: np.ndarray, shift: float) -> DataFrame:
    """Long table (t, pos, v) of per-time sums: pos 0 is the number of events, then the
    sums over all rows, then the sums over events.

    Tasks add up their rows per time before anything is shuffled.
    """
    features = list(features)
    jj, kk = _pairs(len(features))

    def sums(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        z, e = batch[features].to_numpy(), batch["event"].to_numpy(dtype=float)
        w = np.exp(z @ beta - shift)[:, None]
        full = np.hstack([np.ones((len(z), 1)), z, z[:, jj] * z[:, kk]]) * w
        return merge(
            batch["t"].to_numpy(), np.hstack([e[:, None], full, full * e[:, None]])
        )

    def merge(t: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(t, kind="stable")
        times, starts = np.unique(t[order], return_index=True)
        return times, np.add.reduceat(v[order], starts, axis=0)

    def partial(batches):
        held = None
        for batch in batches:
            if batch.empty:
                continue
            new = sums(batch)
            held = new if held is None else merge(
                np.concatenate([held[0], new[0]]), np.vstack([held[1], new[1]])
            )
            if len(held[0]) > HELD_TIMES:
                yield pd.DataFrame({"t": held[0], "v": list(held[1])})
                held = None
        if held is not None:
            yield pd.DataFrame({"t": held[0], "v": list(held[1])})

    return (
        rows.mapInPandas(partial, "t double, v array<double>")
        .select("t", F.posexplode("v").alias("pos", "v"))
        .groupBy("t", "pos")
        .agg(F.sum("v").alias("v"))
    )


def _evaluate(rows, features, beta, shift, on_driver: bool) -> np.ndarray:
    p = len(features)
    width = 1 + p + p * (p + 1) // 2
    long = _per_time(rows, features, beta, shift)
    if on_driver:
        table = long.toPandas().pivot(index="t", columns="pos", values="v")
        v = table.sort_index(ascending=False).to_numpy()
        return _contributions(v[:, 0], v[:, 1 : 1 + width].cumsum(axis=0), v[:, 1 + width :], p)
    # One running sum per position, latest time first; then back to one row per time.
    running = prefix_sum(long, "t", {"upto": "v"}, ["pos"], descending=True)
    per_time = running.groupBy("t").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("pos", "v", "upto"))),
            lambda r: F.when(r["pos"].between(1, width), r["upto"]).otherwise(r["v"]),
        ).alias("v")
    )

    def partial(frames):
        total = np.zeros(width)
        for frame in frames:
            if not frame.empty:
                v = np.vstack(frame["v"])
                total += _contributions(v[:, 0], v[:, 1 : 1 + width], v[:, 1 + width :], p)
        yield pd.DataFrame({"pos": range(width), "v": total})

    parts = per_time.mapInPandas(partial, "pos int, v double").groupBy("pos").agg(F.sum("v"))
    return np.array([r[1] for r in sorted(parts.collect())])


def fit_cox(
    df: DataFrame,
    duration: str,
    event: str,
    features: Sequence[str],
    penalizer: float = 0.1,
    max_iterations: int = 20,
    tolerance: float = 1e-7,
    max_times_on_driver: int = MAX_TIMES_ON_DRIVER,
) -> CoxModel:
    """Fit on standardised ``features``. The input is written once and read per step."""
    features = list(features)
    p = len(features)
    rows = cut_lineage(
        df.select(
            F.col(duration).cast("double").alias("t"),
            F.col(event).cast("int").alias("event"),
            *[F.col(f).cast("double").alias(f) for f in features],
        ),
        "cox",
    )
    start = rows.agg(
        F.count(F.lit(1)),
        F.count_distinct("t"),
        *[F.sum(F.when(F.col("event") == 1, F.col(f))) for f in features],
        *[F.max(F.abs(f)) for f in features],
    ).first()
    n, n_times = start[0], start[1]
    event_sum = np.array([v or 0.0 for v in start[2 : 2 + p]])
    widest = np.array([v or 0.0 for v in start[2 + p :]])
    on_driver = n_times <= max_times_on_driver

    def at(beta: np.ndarray):
        # exp() stays in range unless the predictor can get huge; then shift by its maximum.
        shift = 0.0
        if float(np.abs(beta) @ widest) > 300:
            lp = sum((F.col(f) * F.lit(float(b)) for f, b in zip(features, beta)), F.lit(0.0))
            shift = rows.agg(F.max(lp)).first()[0]
        v = _evaluate(rows, features, beta, shift, on_driver)
        # Undo the shift in the log-likelihood: d events at each time carry it once each.
        events = 0.0 if shift == 0 else rows.agg(F.sum("event")).first()[0]
        ll = float(beta @ event_sum) + v[0] - shift * events
        ll -= n * penalizer / 2 * float(beta @ beta)
        gradient = event_sum + v[1 : 1 + p] - n * penalizer * beta
        information = np.zeros((p, p))
        jj, kk = _pairs(p)
        information[jj, kk] = information[kk, jj] = v[1 + p :]
        return ll, gradient, information + n * penalizer * np.eye(p)

    beta = np.zeros(p)
    ll, gradient, information = at(beta)
    done = 0
    for done in range(1, max_iterations + 1):
        step = np.linalg.solve(information, gradient)
        scale = 1.0
        while True:
            trial = at(beta + scale * step)
            if trial[0] >= ll - 1e-9 * abs(ll) or scale < 1e-4:
                break
            scale /= 2
        beta = beta + scale * step
        ll, gradient, information = trial
        if float(np.abs(scale * step).max()) < tolerance:
            break
    return CoxModel(
        features, beta, np.linalg.inv(information), ll, float(np.abs(gradient).max()) / n, done
    )
