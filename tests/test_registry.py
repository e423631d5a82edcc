import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
import check  # noqa: E402
from riskframe.plans import registry  # noqa: E402

SF = "/root/testdata/sf0.001"
ROWS_ONLY = {
    "baseline_models", "cox_fit", "credit_gbt", "credit_scores", "feature_importance", "fraud_gbt",
    "fraud_scores", "kmeans_segments", "platt_calibration", "project_2d", "reconstruction_error",
    "segment_customers", "survival_by_grade", "tree_attribution",
}
# A spread over all areas; tools/check.py runs every query.
SPREAD = [
    "rfm_features", "segment_label", "credit_features", "payload_explode", "loan_features",
    "c_index_ties", "loan_scores", "smote_rows", "stratified_split", "model_comparison",
    "describe_by_class", "stream_summary",
]


def test_every_query_has_sql_unless_it_is_a_fitted_model():
    assert set(registry.QUERIES) - set(registry.ORACLES) == ROWS_ONLY
    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship_query_returns_customers(spark):
    assert entry.entry(spark).count() > 0


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


@pytest.mark.parametrize("name", SPREAD)
def test_query_equals_its_sql(spark, con, name):
    status, n, note = check.compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name])
    assert status == "ok" and n > 0, note
