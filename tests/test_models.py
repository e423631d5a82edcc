import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import boosting, curves, explain, fraud, models, rfm


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(400):
        y = int(i % 8 == 0)
        x = rng.normal(size=4) + 1.5 * y * np.array([1, 1, 0, 0])
        rows.append((i, y, *map(float, x)))
    return spark.createDataFrame(rows, "id long, y int, a double, b double, c double, d double").cache()


COLS = list("abcd")


def test_boosted_model_beats_the_base_rate_and_is_reproducible(spark, labelled):
    model = models.fit_gbt(labelled, COLS, "id", "y", trees=5, depth=3)
    scored = models.score_with(model, labelled)
    ap = curves.average_precision(scored, "p", "y").first()[0]
    assert ap > 2 / 8
    again = models.fit_gbt(labelled.repartition(3), COLS, "id", "y", trees=5, depth=3)
    a = {r["id"]: r["p"] for r in scored.collect()}
    b = {r["id"]: r["p"] for r in models.score_with(again, labelled).collect()}
    assert a == pytest.approx(b)
    table = models.feature_importance(model, spark).orderBy("rank").collect()
    assert table[0]["feature"] in ("a", "b") and len(table) == 4


def test_tree_attributions_add_up_to_the_margin(spark, labelled):
    model = models.fit_gbt(labelled, COLS, "id", "y", trees=4, depth=3)
    phi = explain.tree_attribution(labelled, model, COLS, "id")
    margins = labelled.select("id", boosting.margin_of(model).alias("m"))
    rows = phi.join(margins, "id").collect()
    assert len(rows) == 400
    for r in rows:
        assert r["base"] + sum(r[c] for c in COLS) == pytest.approx(r["m"], abs=1e-9)


def test_leaf_attribution_matches_enumerated_coalitions():
    from itertools import combinations
    from math import factorial

    leaf = explain.Leaf(2.0, [0, 1, 2], [0.0, -np.inf, 1.0], [np.inf, 0.0, 5.0], [0.3, 0.6, 0.5])
    x = np.array([[1.0, -1.0, 0.0], [-1.0, -1.0, 2.0]])
    got = np.zeros_like(x)
    explain._leaf_attribution(leaf, x, got)

    def value(row, known):
        out = leaf.value
        for f, lo, hi, share in zip(leaf.features, leaf.low, leaf.high, leaf.share):
            out *= float(lo < row[f] <= hi) if f in known else share
        return out

    for i, row in enumerate(x):
        for f in range(3):
            others = [j for j in range(3) if j != f]
            want = 0.0
            for size in range(3):
                for s in combinations(others, size):
                    w = factorial(size) * factorial(2 - size) / factorial(3)
                    want += w * (value(row, {*s, f}) - value(row, set(s)))
            assert got[i, f] == pytest.approx(want)


def test_top_factors_sort_by_size_then_name(spark):
    df = spark.createDataFrame([(1.0, -3.0, 3.0, 0.5)], "a double, b double, c double, d double")
    top = df.select(explain.top_factors({c: F.col(c) for c in COLS}).alias("f")).first()["f"]
    assert [(t["feature"], t["impact"]) for t in top] == [
        ("b", "decreases_risk"), ("c", "increases_risk"), ("a", "increases_risk"),
    ]


def test_linear_attributions_sum_to_the_gap_from_the_mean(spark, labelled):
    weights = {"a": 2.0, "b": -1.0}
    phi = explain.linear_attribution(labelled, weights)
    total = labelled.agg(F.avg(sum(phi.values(), F.lit(0.0)))).first()[0]
    assert total == pytest.approx(0.0, abs=1e-9)


def test_reconstruction_error_matches_numpy_and_flags_outliers(spark, labelled):
    normal = labelled.where("y = 0")
    model = models.fit_reconstruction(normal, COLS, 2)
    got = {r["id"]: r["reconstruction_error"] for r in fraud.with_error(labelled, model).collect()}
    rows = labelled.orderBy("id").collect()
    x = np.array([[r[c] for c in COLS] for r in rows])
    z = (x - np.array(model.mean)) / np.array(model.std)
    w = model.axes.T
    want = ((z - z @ w @ w.T) ** 2).mean(axis=1)
    assert [got[r["id"]] for r in rows] == pytest.approx(list(want))
    assert np.allclose(model.axes @ model.axes.T, np.eye(2))
    cut = fraud.anomaly_threshold(fraud.with_error(labelled, model), "reconstruction_error", "y")
    legit = [e for r, e in zip(rows, want) if r["y"] == 0]
    assert cut == pytest.approx(np.quantile(legit, 0.95))


def test_best_of_several_starts_is_no_worse(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), *map(float, rng.normal(size=3) + 5 * (i % 5))) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, recency double, frequency double, monetary double")
    _, one = models.fit_kmeans(df, rfm.RFM, 5, starts=1)
    centroids, best = models.fit_kmeans(df, rfm.RFM, 5, starts=3)
    assert best <= one + 1e-9
    placed = rfm.assign_nearest(df, rfm.RFM, centroids)
    assert rfm.inertia(placed).first()[0] == pytest.approx(best, rel=1e-6)


def test_calibrated_probabilities_are_probabilities(spark, labelled):
    model = models.fit_platt(labelled, COLS, "id", "y", folds=2, trees=2, depth=2, row_share=1.0)
    scored = model.score(labelled)
    low, high, n = scored.agg(F.min("pd"), F.max("pd"), F.count("pd")).first()
    assert 0 <= low <= high <= 1 and n == 400 and scored.columns == [*labelled.columns, "pd"]


def test_training_table_keeps_synthetic_rows_out_of_the_holdout(spark, labelled):
    table = fraud.training_table(labelled, "id", "y", COLS, ratio=0.5)
    assert table.where("holdout and row_id like '%-%'").count() == 0
    assert table.where("row_id like '%-%'").count() > 0
    assert table.where("row_id not like '%-%'").count() == 400


def test_calibrated_factors_cover_all_folds(spark, labelled):
    model = models.fit_platt(labelled, COLS, "id", "y", folds=3, trees=2, depth=2, row_share=1.0)
    phi = explain.calibrated_attribution(labelled, model, COLS, "id").collect()
    mean = dict.fromkeys((r["id"] for r in phi), 0.0)
    for fold, slope, _ in model.folds:
        for r in labelled.select("id", boosting.margin_of(fold).alias("m")).collect():
            mean[r["id"]] += slope * r["m"] / 3
    for r in phi:
        assert abs(sum(r[c] for c in COLS) + r["base"] - mean[r["id"]]) < 1e-9
