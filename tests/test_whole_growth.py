import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import boosting as b
from riskframe.operators import models

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    share = lambda k, n: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(n)) / n
    df = spark.range(900).select(
        "id", share(1, 97).alias("a"), F.when(F.col("id") % 17 != 0, share(2, 7)).alias("b"), share(3, 31).alias("c"), share(4, 1000).alias("noise")
    )
    label = (F.col("a") + F.coalesce("b", F.lit(0.2)) * F.col("c") + 0.5 * F.col("noise") > 1).cast("double")
    return df.withColumns({"label": label, "fold": (F.col("id") % 3).cast("int"), "holdout": F.col("id") % 5 == 0}).repartition(3, "id").cache()


@pytest.mark.parametrize("metric", ["logloss", "ap"])
def test_a_task_per_model_and_passes_grow_the_same_trees(rows, metric):
    options = b.with_options(trees=12, depth=4, max_leaves=9, min_rows=8, rate=0.3, patience=4, metric=metric)
    for whole, passes in zip(b.fit(rows, COLS, "id", options, 3), b.fit(rows, COLS, "id", options, 3, whole_bytes=0), strict=True):
        assert whole.trees == passes.trees > 0
        for c in ("start", "feature", "threshold", "left", "right", "rows"):
            assert np.array_equal(getattr(whole, c), getattr(passes, c))
        assert np.allclose(whole.value, passes.value, rtol=1e-12) and np.allclose(whole.metric, passes.metric, rtol=1e-9)


def test_jobs_of_a_small_table_do_not_grow_with_trees_and_levels(spark, rows):
    def jobs(trees, depth):
        group = f"trees-{trees}"
        spark.sparkContext.setJobGroup(group, group)
        b.fit(rows, COLS, "id", b.with_options(trees=trees, depth=depth, patience=None), 3)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(20, 4) <= jobs(2, 1) + 2


def test_margins_follow_each_row_and_null_is_lowest(rows):
    model = b.fit(rows, COLS, "id", b.with_options(trees=5, depth=3, patience=None))[0]
    x = np.array([[v, w, u] for v in (np.nan, -1.0, 0.3, 0.9) for w in (np.nan, 0.4, 2.0) for u in (0.1, np.nan, np.inf)])
    want = []
    for row in np.where(np.isnan(x), -np.inf, x):
        total = 0.0
        for s in model.start:
            n = s
            while model.feature[n] >= 0:
                n = s + (model.left if row[model.feature[n]] <= model.threshold[n] else model.right)[n]
            total += model.value[n]
        want.append(total)
    assert np.array_equal(model.margin(x), want) and len(model.margin(x[:0])) == 0


def test_each_row_is_calibrated_on_the_model_of_its_fold(rows):
    folds = b.fit(rows, COLS, "id", b.with_options(trees=4, depth=3, patience=None), 3)
    for r in rows.select("fold", b.margin_of_fold(folds, "fold").alias("m"), *[b.margin_of(f).alias(f"m{k}") for k, f in enumerate(folds)]).collect():
        assert r.m == r[f"m{r.fold}"]
    fitted = models.fit_platt(rows, COLS, "id", "label", folds=3, trees=4, depth=3, patience=None)
    assert len(fitted.folds) == 3 and all(slope > 0 for _, slope, _ in fitted.folds)
