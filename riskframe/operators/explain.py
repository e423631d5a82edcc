"""Attributions: how much each feature moves a row's prediction."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.operators.boosting import Ensemble
from riskframe.operators.models import PlattModel

# Tables of Shapley values by pattern: for leaves of up to so many features, so many patterns at once.
TABLE_FEATURES, TABLE_CELLS = 8, 1 << 16
# Rows that share those tables, and the least that a task is made for.
ROWS_AT_ONCE, ROWS_OF_TASK = 16_384, 1_024


def linear_attribution(
    df: DataFrame, coefficients: Mapping[str, float]
) -> dict[str, Column]:
    """beta * (x - mean of x) per feature; sums to prediction minus mean prediction."""
    means = df.agg(*[F.avg(c).alias(c) for c in coefficients]).first()
    return {c: F.lit(float(b)) * (F.col(c) - F.lit(means[c])) for c, b in coefficients.items()}


def top_factors(attributions: Mapping[str, Column], k: int = 3) -> Column:
    """The k features of largest absolute attribution: array of
    {feature, shap_value, impact}; ties by name."""
    entries = F.array(
        *[
            F.struct((-F.abs(v)).alias("key"), F.lit(f).alias("feature"), v.alias("shap_value"))
            for f, v in attributions.items()
        ]
    )
    return F.transform(
        F.slice(F.array_sort(entries), 1, k),
        lambda e: F.struct(
            e["feature"].alias("feature"),
            e["shap_value"].alias("shap_value"),
            F.when(e["shap_value"] > 0, "increases_risk")
            .otherwise("decreases_risk")
            .alias("impact"),
        ),
    )


def mean_absolute(df: DataFrame, attributions: Mapping[str, Column]) -> DataFrame:
    """Mean |attribution| per feature, one row each."""
    wide = df.agg(*[F.avg(F.abs(v)).alias(f) for f, v in attributions.items()])
    rows = [
        F.struct(F.lit(f).alias("feature"), F.col(f).alias("mean_abs")) for f in attributions
    ]
    return wide.select(F.inline(F.array(*rows)))


@dataclass
class Leaf:
    """One path of a tree: per feature on it, the interval (low, high] a row must fall in
    and the share of training rows that does."""

    value: float
    features: list[int]
    low: list[float]
    high: list[float]
    share: list[float]


def tree_leaves(model: Ensemble) -> list[Leaf]:
    """All paths of the ensemble (as many as the model has leaves, whatever the data)."""
    leaves: list[Leaf] = []
    for start in model.start.tolist():
        stack = [(start, {})]
        while stack:
            node, path = stack.pop()
            f = int(model.feature[node])
            if f < 0:
                names = sorted(path)
                low, high, share = ([path[n][i] for n in names] for i in range(3))
                leaves.append(Leaf(float(model.value[node]), names, low, high, share))
                continue
            cut = float(model.threshold[node])
            low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
            sides = ((model.left, (low, min(high, cut))), (model.right, (max(low, cut), high)))
            for children, bounds in sides:
                child = start + int(children[node])
                part = float(model.rows[child] / model.rows[node])
                stack.append((child, {**path, f: (*bounds, share * part)}))
    return leaves


def _shapley(share: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Shapley values of the product over path features (the last axis) of 1 if known and inside, 0 if
    known and outside, training share if unknown.

    The weights of coalitions by size are Beta integrals, so a feature's value is (inside - share) times
    the integral over u in [0, 1] of the product of share * (1 - u) + inside * u over the others: a
    polynomial, which Gauss-Legendre sums exactly.
    """
    m = share.shape[-1]
    nodes, weights = np.polynomial.legendre.leggauss(m // 2 + 1)
    total = 0.0
    for u, w in zip((nodes + 1) / 2, weights / 2):
        part = share * (1 - u) + inside * u
        before, after = np.ones_like(part), np.ones_like(part)
        before[..., 1:] = np.cumprod(part[..., :-1], axis=-1)
        after[..., :-1] = np.cumprod(part[..., :0:-1], axis=-1)[..., ::-1]
        total = total + w * before * after
    return (inside - share) * total


def _leaf_attribution(leaf: Leaf, x: np.ndarray, out: np.ndarray) -> None:
    """Adds the leaf's Shapley values for all rows of ``x`` to ``out``."""
    if not leaf.features:
        return
    at = x[:, leaf.features]
    inside = ((at > np.array(leaf.low)) & (at <= np.array(leaf.high))).astype(float)
    out[:, leaf.features] += leaf.value * _shapley(np.array(leaf.share), inside)


@dataclass
class _Paths:
    """Leaves with the same number of features: arrays of a row per leaf and a column per feature.

    Bounds are places among the cuts of the feature, so that rows are compared as small numbers."""

    value: np.ndarray
    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray


def _packed(leaves: Sequence[Leaf], columns: int) -> tuple[list[np.ndarray], list[_Paths]]:
    """The cuts of each column, and the leaves by number of features."""
    found: list[set] = [set() for _ in range(columns)]
    sizes: dict[int, list[Leaf]] = {}
    for leaf in leaves:
        for f, low, high in zip(leaf.features, leaf.low, leaf.high):
            found[f].update((low, high))
        if leaf.features:
            sizes.setdefault(len(leaf.features), []).append(leaf)
    cuts = [np.array(sorted(v for v in some if np.isfinite(v))) for some in found]
    packed = []
    for _, group in sorted(sizes.items()):
        features = np.array([leaf.features for leaf in group])
        low, high = np.array([leaf.low for leaf in group]), np.array([leaf.high for leaf in group])
        for f, c in enumerate(cuts):
            own = features == f
            # A row's place is the number of cuts below it: over low from there on, up to high until there.
            low[own] = np.where(np.isfinite(low[own]), np.searchsorted(c, low[own]) + 1, 0)
            high[own] = np.where(np.isfinite(high[own]), np.searchsorted(c, high[own]), len(c))
        packed.append(_Paths(np.array([leaf.value for leaf in group]), features, low.astype(int), high.astype(int), np.array([leaf.share for leaf in group])))
    return cuts, packed


def _placed(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Per column the number of cuts below each value; one beyond all for values that no interval holds."""
    kind = np.uint8 if max(map(len, cuts), default=0) < 255 else np.int32
    return np.stack([np.where(np.isnan(v) | (v == -np.inf), len(c) + 1, np.searchsorted(c, v)).astype(kind) for v, c in zip(x.T, cuts, strict=True)])


def _add_paths(paths: _Paths, places: np.ndarray, out: np.ndarray) -> None:
    """Adds the Shapley values of all leaves to ``out``, a row per column.

    Rows differ only in which features of a leaf they are inside of: up to TABLE_FEATURES of them, values
    are worked out once per leaf and such pattern, and rows look theirs up."""
    m = paths.features.shape[1]
    patterns = (np.arange(2**m)[:, None] >> np.arange(m) & 1).astype(float) if m <= TABLE_FEATURES else None
    step = max(TABLE_CELLS // 2**m, 1)
    for start in range(0, len(paths.value), step):
        end = min(start + step, len(paths.value))
        if patterns is not None:
            tables = paths.value[start:end, None, None] * _shapley(paths.share[start:end, None, :], patterns[None])
            tables = np.ascontiguousarray(tables.transpose(0, 2, 1))
        for i in range(start, end):
            columns = paths.features[i].tolist()
            inside = [(places[f] >= lo) & (places[f] <= hi) for f, lo, hi in zip(columns, paths.low[i].tolist(), paths.high[i].tolist())]
            if patterns is None:
                out[columns] += paths.value[i] * _shapley(paths.share[i], np.stack(inside, axis=1).astype(float)).T
                continue
            code = inside[0].view(np.uint8)
            for j in range(1, m):
                code = code | inside[j].view(np.uint8) << j
            code = code.astype(np.intp)
            for f, values in zip(columns, tables[i - start]):
                out[f] += values[code]


def base_margin(leaves: Sequence[Leaf]) -> float:
    """Expected margin over the training rows' path shares."""
    return float(sum(leaf.value * float(np.prod(leaf.share)) for leaf in leaves))


def tree_attribution(
    df: DataFrame, model: Ensemble, cols: Sequence[str], id_col: str
) -> DataFrame:
    """Path-dependent Shapley values of the boosted margin for every row: ``id``, one
    column per feature, ``base``. Row values plus base equal the margin."""
    return _attribution(df, tree_leaves(model), cols, id_col)


def calibrated_attribution(df: DataFrame, model: PlattModel, cols: Sequence[str], id_col: str) -> DataFrame:
    """The same for the mean of a calibrated model's margins over its folds.

    A fold's margin is slope times its booster's raw margin plus an intercept. Shapley values are
    additive, so the leaves of all folds, scaled by slope over folds, explain the mean.
    """
    n = len(model.folds)
    leaves = [
        replace(leaf, value=leaf.value * slope / n)
        for fold, slope, _ in model.folds
        for leaf in tree_leaves(fold)
    ]
    return _attribution(df, leaves, cols, id_col)


def _attribution(df: DataFrame, leaves: list[Leaf], cols: Sequence[str], id_col: str) -> DataFrame:
    cols = list(cols)
    shared = df.sparkSession.sparkContext.broadcast(_packed(leaves, len(cols)))
    base = base_margin(leaves)

    def explained(held: list[pd.DataFrame]) -> pd.DataFrame:
        batch = pd.concat(held)
        cuts, packed = shared.value
        places = _placed(batch[cols].to_numpy(dtype=float), cuts)
        phi = np.zeros((len(cols), len(batch)))
        for paths in packed:
            _add_paths(paths, places, phi)
        out = pd.DataFrame(phi.T, columns=cols)
        out.insert(0, "id", batch["id"].to_numpy())
        out["base"] = base
        return out

    def explain(batches):
        held = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= ROWS_AT_ONCE:
                yield explained(held)
                held = []
        if held:
            yield explained(held)

    data = df.select(F.col(id_col).alias("id"), *[F.col(c).cast("double").alias(c) for c in cols])
    id_type = dict(data.dtypes)["id"]
    fields = ", ".join(f"{c} double" for c in cols)
    # A row takes thousands of leaves, so few rows are work for all cores.
    rows, cores = data.count(), df.sparkSession.sparkContext.defaultParallelism
    spread = data.repartition(max(-(-rows // ROWS_AT_ONCE), min(cores, -(-rows // ROWS_OF_TASK)), 1))
    return spread.mapInPandas(explain, f"id {id_type}, {fields}, base double")
