import heapq

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import boosting as b
from riskframe.sources.model_store import ModelStore, SchemaMismatch

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 3))
    y = (x[:, 0] + x[:, 0] * x[:, 1] + 0.3 * rng.normal(size=600) > 0.4).astype(int)
    x[rng.random((600, 3)) < 0.03] = np.nan
    made = [(i, float(t), *[None if np.isnan(v) else float(v) for v in r], bool(i % 5 == 0)) for i, (t, r) in enumerate(zip(y, x, strict=True))]
    return spark.createDataFrame(made, "id long, label double, a double, b double, c double, holdout boolean").repartition(3).cache()


def grown(x, y, w, edges, options, depth):
    """A tree by plain recursion over all bins of all columns; leaf values by row."""
    g, h = w * (0.5 - y), w * 0.25
    bins = b.binned(x, edges)
    out = np.zeros(len(y))

    def score(rows):
        return g[rows].sum() ** 2 / (h[rows].sum() + options.penalty)

    def split(rows, level):
        best = None
        for f in range(x.shape[1]):
            for cut in range(len(edges[f])):
                left, right = rows[bins[rows, f] <= cut], rows[bins[rows, f] > cut]
                if min(len(left), len(right)) >= options.min_rows:
                    gain = score(left) + score(right) - score(rows)
                    if best is None or gain > best[0] + 1e-9:
                        best = gain, left, right
        return best if best and best[0] > 1e-9 and level < depth else None

    heap, leaves = [], []

    def push(rows, level):
        found = split(rows, level)
        if found is None:
            leaves.append(rows)
        else:
            heapq.heappush(heap, (-found[0], rows[0], level, rows, found))

    push(np.arange(len(y)), 0)
    while heap and len(leaves) + len(heap) < (options.max_leaves or 10**9):
        _, _, level, _, (_, left, right) = heapq.heappop(heap)
        push(left, level + 1)
        push(right, level + 1)
    for rows in leaves + [e[3] for e in heap]:
        out[rows] = -options.rate * g[rows].sum() / (h[rows].sum() + options.penalty)
    return out


@pytest.mark.parametrize("max_leaves", [None, 5])
def test_the_first_tree_equals_plain_recursion(rows, max_leaves):
    options = b.with_options(trees=1, depth=3, row_share=1.0, column_share=1.0, min_rows=10, max_leaves=max_leaves, patience=None)
    df = rows.drop("holdout").withColumn("weight", F.when(F.col("label") == 1, 2.0).otherwise(1.0))
    model = b.fit(df, COLS, "id", options)[0]
    assert model.trees == 1
    table = df.select("id", "label", "weight", *COLS, b.margin_of(model).alias("m")).orderBy("id").toPandas()
    x = table[COLS].to_numpy(float)
    want = grown(x, table.label.to_numpy(), table.weight.to_numpy(), b.bin_edges(df, COLS, "id"), options, 3)
    assert np.allclose(table.m, want, atol=1e-9)
    assert max_leaves is None or (model.feature < 0).sum() == max_leaves


def test_500_trees_run_and_stop_early(rows):
    options = b.with_options(trees=500, depth=3, patience=10, min_rows=5, rate=0.2)
    model = b.fit(rows, COLS, "id", options)[0]
    assert 0 < model.trees < 500 and model.trees == int(np.argmax(model.metric)) and len(model.metric) >= model.trees + 10
    test = rows.where("holdout").withColumn("p", b.probability_of(model)).toPandas()
    good, bad = test[test.label == 1].p, test[test.label == 0].p
    assert np.mean(good.to_numpy()[:, None] > bad.to_numpy()) > 0.9


def test_margins_do_not_depend_on_refreshing_or_on_partitions(rows, monkeypatch):
    options = b.with_options(trees=7, depth=2, patience=None)
    first = b.fit(rows, COLS, "id", options)[0]
    monkeypatch.setattr(b, "REFRESH", 2)
    second = b.fit(rows.repartition(5, "c"), COLS, "id", options)[0]
    assert first.trees == second.trees == 7 and np.array_equal(first.feature, second.feature)
    assert np.allclose(first.value, second.value)


def test_holdout_and_own_fold_are_not_learnt_from(rows):
    options = b.with_options(trees=3, depth=2, row_share=1.0, patience=None)
    folded = rows.withColumn("fold", (F.col("id") % 2).cast("int"))
    models = b.fit(folded, COLS, "id", options, folds=2)
    for k, model in enumerate(models):
        learnt = folded.where(f"fold <> {k} and not holdout")
        assert model.rows[0] == learnt.count()
        alone = b.fit(learnt.drop("fold", "holdout"), COLS, "id", options)
        # The same trees but for bin ends, which come from all rows.
        assert alone[0].trees == model.trees and alone[0].rows[0] == model.rows[0]


def test_ap_of_buckets_equals_the_definition():
    rng = np.random.default_rng(1)
    score, y = rng.integers(0, b.SCORE_BUCKETS, 500), rng.random(500) < 0.3
    sums = np.stack([np.bincount(score, v, b.SCORE_BUCKETS) for v in (y * 1.0, 1.0 - y)])
    want = sum((y[score == s].sum() / y.sum()) * y[score >= s].mean() for s in np.unique(score))
    assert b._metric(sums, "ap") == pytest.approx(want)
    assert b._metric(np.zeros((2, 8)), "ap") is None and b._metric(np.array([1.0, 4.0]), "logloss") == -0.25


def test_models_are_stored_and_read_in_versions(spark, rows, tmp_path):
    model = b.fit(rows, COLS, "id", b.with_options(trees=2, depth=2))[0]
    store = ModelStore(spark, str(tmp_path))
    assert store.load("m", COLS) is None and store.versions("m") == []
    assert store.save("m", model, COLS) == 1 and store.save("m", {"mean": [1.0, (2, "x")]}, COLS) == 2
    again = ModelStore(spark, str(tmp_path)).load("m", COLS, version=1)
    a, c = (rows.select("id", b.margin_of(m).alias("m")).orderBy("id").collect() for m in (model, again))
    assert a == c and again.cols == COLS
    assert store.load("m", COLS) == {"mean": [1.0, (2, "x")]}
    with pytest.raises(SchemaMismatch):
        store.load("m", ["other"])
    assert store.load_or_fit("m", COLS, lambda: pytest.fail("fitted again")) is not None


def test_a_taken_version_number_is_not_overwritten(spark, tmp_path, monkeypatch):
    store = ModelStore(spark, str(tmp_path))
    store.save("m", [1], COLS)
    seen = iter([[], store.versions("m")])
    monkeypatch.setattr(store, "versions", lambda name: next(seen))
    assert store.save("m", [2], COLS) == 2
    monkeypatch.undo()
    assert (store.load("m", COLS, 1), store.load("m", COLS)) == ([1], [2])


def test_classes_of_other_packages_are_not_made(spark, tmp_path):
    from riskframe.sources.model_store import from_plain

    with pytest.raises(ValueError):
        from_plain({"__kind__": "subprocess:Popen", "args": ["x"]})
