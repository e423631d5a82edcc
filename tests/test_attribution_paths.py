from itertools import permutations

import numpy as np
import pytest

from riskframe.operators import boosting, explain

COLS = ["a", "b", "c"]


def by_orders(leaf, row):
    """Mean gain of each feature over all orders in which features get known."""
    out, orders = np.zeros(len(row)), list(permutations(range(len(leaf.features))))
    inside = [float(lo < row[f] <= hi) for f, lo, hi in zip(leaf.features, leaf.low, leaf.high)]
    for order in orders:
        known = list(leaf.share)
        for j in order:
            before = np.prod(known)
            known[j] = inside[j]
            out[leaf.features[j]] += leaf.value * (np.prod(known) - before) / len(orders)
    return out


@pytest.mark.parametrize("table", [explain.TABLE_FEATURES, 2])
def test_packed_leaves_give_shapley_values(table, monkeypatch):
    monkeypatch.setattr(explain, "TABLE_FEATURES", table)  # 2: longer paths are worked out row by row
    monkeypatch.setattr(explain, "TABLE_CELLS", 16)
    rng = np.random.default_rng(5)
    leaves = []
    for _ in range(25):
        m = int(rng.integers(0, 6))
        low = [float(v) if rng.random() < 0.6 else -np.inf for v in rng.integers(-2, 1, m)]
        high = [float(v) if rng.random() < 0.6 else np.inf for v in rng.integers(1, 4, m)]
        leaves.append(explain.Leaf(float(rng.normal()), sorted(rng.choice(6, m, replace=False).tolist()), low, high, rng.random(m).tolist()))
    x = rng.integers(-3, 5, (40, 6)).astype(float)
    x[rng.random(x.shape) < 0.05] = np.nan
    cuts, packed = explain._packed(leaves, 6)
    got = np.zeros((6, len(x)))
    for paths in packed:
        explain._add_paths(paths, explain._placed(x, cuts), got)
    assert np.allclose(got.T, [sum(by_orders(leaf, row) for leaf in leaves) for row in x], atol=1e-12)


def test_rows_of_one_partition_are_explained_by_several_tasks(spark):
    df = spark.range(6000).selectExpr("id", "id % 97 / 97 as a", "id % 31 / 31 as b", "id % 7 / 7 as c", "cast(id % 97 + id % 7 > 60 as double) as label").coalesce(1)
    model = boosting.fit(df, COLS, "id", boosting.with_options(trees=3, depth=3, patience=None))[0]
    phi = explain.tree_attribution(df, model, COLS, "id")
    assert phi.rdd.getNumPartitions() > 1
    got = phi.join(df.select("id", boosting.margin_of(model).alias("m")), "id").toPandas()
    assert len(got) == 6000 and np.allclose(got[[*COLS, "base"]].sum(axis=1), got.m, atol=1e-9)


def test_time_does_not_follow_rows_times_the_cube_of_path_lengths():
    """A leaf's patterns are worked out once: 4,000 leaves of six features at 2,000 rows in seconds."""
    import time

    rng = np.random.default_rng(1)
    leaves = [explain.Leaf(1.0, list(range(6)), rng.random(6).tolist(), [2.0] * 6, rng.random(6).tolist()) for _ in range(4000)]
    for leaf in leaves:
        leaf.low = np.round(leaf.low, 1).tolist()
    x = rng.random((2000, 6))
    cuts, packed = explain._packed(leaves, 6)
    start, got = time.thread_time(), np.zeros((6, len(x)))
    for paths in packed:
        explain._add_paths(paths, explain._placed(x, cuts), got)
    fast, start = time.thread_time() - start, time.thread_time()
    want = np.zeros_like(x)
    for leaf in leaves[:200]:
        explain._leaf_attribution(leaf, x, want)
    slow = (time.thread_time() - start) * 20
    assert fast < slow / 2
