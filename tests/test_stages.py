import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from riskframe.operators import rfm, stages


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    made = []
    for i in range(300):
        y = int(i % 6 == 0)
        x = rng.normal(size=3) + 1.2 * y
        made.append((i, y, *map(float, x), float(rng.exponential(20) / (1 + y) + 0.1)))
    return spark.createDataFrame(made, "id long, y int, a double, b double, c double, t double").cache()


def scores(model, df, cols):
    return {r["id"]: tuple(r[c] for c in cols) for r in model.transform(df).select("id", *cols).collect()}


COLS = ["a", "b", "c"]
SMALL = {"trees": 6, "depth": 2, "patience": 5}


def pipelines():
    amount = SQLTransformer(statement="SELECT *, a + b AS sum_ab FROM __THIS__")
    wide = [*COLS, "sum_ab"]
    fraud = [
        amount,
        stages.ReconstructionEstimator(inputCols=wide, labelCol="y", outputCol="error", options={"k": 2}),
        stages.BoostedEstimator(inputCols=[*wide, "error"], labelCol="y", outputCol="fraud", options=SMALL),
    ]
    credit = [stages.PlattEstimator(inputCols=COLS, labelCol="y", outputCol="pd", options=SMALL | {"folds": 2})]
    retail = [
        SQLTransformer(statement="SELECT *, a AS recency, b AS frequency, c AS monetary FROM __THIS__"),
        stages.SegmentEstimator(inputCols=list(rfm.RFM), outputCol="segment", options={"k": 3, "starts": 2}),
    ]
    loans = [stages.CoxEstimator(inputCols=COLS, labelCol="y", durationCol="t", outputCol="hazard")]
    return {
        "fraud": (fraud, ["error", "fraud"]), "credit": (credit, ["pd"]), "retail": (retail, ["segment", "recency"]), "loans": (loans, ["hazard"]),
    }


@pytest.mark.parametrize("domain", ["fraud", "credit", "retail", "loans"])
def test_a_pipeline_is_saved_and_loaded_with_the_same_scores(spark, rows, tmp_path, domain):
    parts, cols = pipelines()[domain]
    Pipeline(stages=parts).write().save(f"{tmp_path}/unfitted")
    again = Pipeline.load(f"{tmp_path}/unfitted")
    assert [s.uid for s in again.getStages()] == [s.uid for s in parts]
    model = again.fit(rows)
    model.write().save(f"{tmp_path}/fitted")
    want = scores(model, rows, cols)
    other = spark.newSession()
    loaded = PipelineModel.load(f"{tmp_path}/fitted")
    got = scores(loaded, other.createDataFrame(rows.collect(), rows.schema), cols)
    assert len(got) == 300 and got.keys() == want.keys()
    assert np.allclose([got[i] for i in want], list(want.values()))
    assert all(v is not None for row in got.values() for v in row)


def test_columns_of_the_input_stay(spark, rows):
    fitted = stages.SegmentEstimator(inputCols=["a", "b"], outputCol="cluster", options={"k": 2, "starts": 1}).fit(rows)
    out = fitted.transform(rows)
    assert out.columns == [*rows.columns, "sq_dist", "cluster"] or set(out.columns) == {*rows.columns, "sq_dist", "cluster"}
    assert out.select(rows.columns).exceptAll(rows).isEmpty()


def test_the_hazard_of_a_riskier_row_is_higher(spark, rows):
    fitted = stages.CoxEstimator(inputCols=COLS, labelCol="y", durationCol="t", outputCol="hazard").fit(rows)
    means = {r["y"]: r["m"] for r in fitted.transform(rows).groupBy("y").agg(F.avg("hazard").alias("m")).collect()}
    assert means[1] > means[0] > 0
