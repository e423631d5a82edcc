import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskframe.operators import credit, curves, impute, loans, metrics, quality, rfm
from riskframe.sources.schemas import TRANSACTION_FEATURES

APPLICANT = dict(
    applicant_id="A001", utilization=0.15, age=45, late_30_59=0, debt_ratio=0.35,
    monthly_income=6500.0, open_lines=8, late_90=0, real_estate=1, late_60_89=0, dependents=2,
)
APPLICANT_TYPES = (
    "applicant_id string, utilization double, age int, late_30_59 int, debt_ratio double, "
    "monthly_income double, open_lines int, late_90 int, real_estate int, late_60_89 int, dependents int"
)
LOAN = dict(
    loan_id="L001", loan_amnt=15000.0, int_rate=13.99, grade="C", emp_length_years=5.0,
    annual_inc=65000.0, dti=18.5, fico_range_low=690.0, open_acc=10, revol_util=45.0,
    total_acc=25, inq_last_6mths=1, pub_rec=0, term_months=36,
)
LOAN_TYPES = (
    "loan_id string, loan_amnt double, int_rate double, grade string, emp_length_years double, "
    "annual_inc double, dti double, fico_range_low double, open_acc int, revol_util double, "
    "total_acc int, inq_last_6mths int, pub_rec int, term_months int"
)


def frame(spark, base, types, changes):
    names = [t.split()[0] for t in types.split(", ")]
    return spark.createDataFrame([tuple({**base, **c}[n] for n in names) for c in changes], types)


def broken(spark, df, rules):
    return [set(r["violations"]) for r in quality.with_violations(df, rules).collect()]


def test_applicant_rules(spark):
    df = frame(
        spark, APPLICANT, APPLICANT_TYPES,
        [{}, {"age": 0}, {"age": 17}, {"utilization": 1.5}, {"monthly_income": None}, {"late_90": -1},
         {"monthly_income": float("nan")}],
    )
    assert broken(spark, df, quality.applicant_rules()) == [
        set(), {"age"}, {"age"}, {"utilization"}, {"monthly_income"}, {"late_90"}, {"monthly_income"},
    ]
    valid, rejected = quality.split_valid(df, quality.applicant_rules())
    assert valid.count() == 1 and rejected.count() == 6 and "violations" not in valid.columns


def test_loan_rules(spark):
    df = frame(
        spark, LOAN, LOAN_TYPES,
        [{}, {"grade": "Z"}, {"term_months": 48}, {"dti": 150.0}, {"fico_range_low": 900.0}, {"int_rate": 0.0}],
    )
    assert broken(spark, df, quality.loan_rules()) == [
        set(), {"grade"}, {"term_months"}, {"dti"}, {"fico_range_low"}, {"int_rate"},
    ]


def test_transaction_and_customer_rules(spark):
    cols = TRANSACTION_FEATURES
    rows = [[0.0] * 30, [float("nan")] + [0.0] * 29, [0.0] * 29 + [-1.0], [float("inf")] + [0.0] * 29]
    df = spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"{c} double" for c in cols))
    assert broken(spark, df, quality.transaction_rules(cols)) == [
        set(), {"time_s"}, {"amount_negative"}, {"time_s"},
    ]
    customers = spark.createDataFrame(
        [(30.0, 5.0, 200.0), (-1.0, 5.0, 200.0), (float("nan"), 5.0, 200.0)],
        "recency double, frequency double, monetary double",
    )
    assert broken(spark, customers, quality.customer_rules()) == [set(), {"recency"}, {"recency"}]


def test_table_rules_and_required_columns(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "id string")
    assert [tuple(r) for r in quality.duplicate_ids(df, "id").collect()] == [("a", 2)]
    check = quality.table_check(df, "id", max_rows=2).first()
    assert check["not_empty"] and not check["unique_ids"] and not check["within_cap"]
    with pytest.raises(quality.SchemaError, match="Amount, Time"):
        quality.require_columns(df, ["Time", "Amount", "id"])


def test_group_median_falls_back_to_the_imputed_column(spark):
    rows = [(1, 20, 10.0), (2, 20, 30.0), (3, 20, None), (4, 50, None), (5, 30, 100.0)]
    df = spark.createDataFrame(rows, "id int, g int, x double")
    got = {r["id"]: r["x"] for r in impute.impute_group_median(df, "x", "g").collect()}
    # Column after the group step: 10, 30, 20, 100; its median is 25.
    assert got == {1: 10.0, 2: 30.0, 3: 20.0, 4: 25.0, 5: 100.0}


def test_sentinel_98_goes_and_96_is_capped(spark):
    df = frame(spark, APPLICANT, APPLICANT_TYPES, [{"late_90": 98}, {"late_90": 96}, {"age": 101}])
    got = [r["late_90"] for r in credit.clean_applicants(df).collect()]
    assert got == [0, 10]


def test_quantile_trim_drops_missing_values(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(None,), (float("nan"),)], "x double")
    assert impute.keep_up_to_quantile(df, "x", 0.99).count() == 100


def test_fitted_cuts_and_rules_push_down_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("cast(id as double) x", "cast(id % 90 as int) age").write.parquet(path)
    df = impute.keep_up_to_quantile(spark.read.parquet(path), "x", 0.99)
    valid, _ = quality.split_valid(df, {"age": quality.within("age", 18, 80)})
    plan = valid._jdf.queryExecution().toString()
    assert "LessThanOrEqual(x,989.01)" in plan and "GreaterThanOrEqual(age,18)" in plan


def test_value_order_and_labels(spark):
    centres = [(0, 0, 1.0), (0, 0, 5.0), (0, 0, -2.0)]
    assert rfm.value_order(centres) == [1, 0, 2]
    df = spark.createDataFrame([(0,), (4,), (7,)], "k int")
    label = rfm.label_of(F.col("k"))
    got = [tuple(r) for r in df.select(label, rfm.is_high_value(label)).collect()]
    assert got == [("Champions", True), ("Lost", False), ("Cluster 7", False)]


def test_one_row_scores_thirty_percent(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "recency double, frequency double, monetary double")
    assert rfm.rfm_score(df).first()["rfm_score"] == pytest.approx(0.3)
    frozen = rfm.rfm_score(df, {"recency": (0, 1), "frequency": (0, 2), "monetary": (0, 3)})
    assert frozen.first()["rfm_score"] == pytest.approx(0.7, abs=1e-6)


def test_zero_spread_divides_by_one(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert [r["x"] for r in rfm.robust_scale(df, ["x"]).collect()] == [0.0, 0.0]
    assert [r["x"] for r in rfm.standardize(df, ["x"]).collect()] == [0.0, 0.0]


def test_silhouettes_match_brute_force_across_tiles(spark):
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(0, 1, (40, 3)), rng.normal(4, 1, (20, 3)), [[50, 50, 50]]])
    k = [0] * 40 + [1] * 20 + [2]
    df = spark.createDataFrame(
        [(i, c, *map(float, r)) for i, (c, r) in enumerate(zip(k, x))],
        "id int, cluster_id int, recency double, frequency double, monetary double",
    )

    def brute(power):
        total = 0.0
        for i in range(61):
            d = ((x - x[i]) ** 2).sum(axis=1) ** (power / 2)
            own = [j for j in range(61) if k[j] == k[i] and j != i]
            if not own:
                continue
            a = d[own].mean()
            b = min(d[[j for j in range(61) if k[j] == c]].mean() for c in set(k) - {k[i]})
            total += (b - a) / max(a, b)
        return total / 61

    exact = rfm.silhouette_exact(df, "id", rfm.RFM, rows_per_tile=16).first()["silhouette"]
    assert exact == pytest.approx(brute(1))
    assert rfm.silhouette_exact(df, "id", rfm.RFM, rows_per_tile=16).select("n").first()["n"] == 61
    assert rfm.silhouette_squared(df, "id", rfm.RFM).first()["silhouette"] == pytest.approx(brute(2))


def test_grade_lookup_and_unknown_grade(spark):
    df = spark.createDataFrame([("A",), ("G",), ("Z",), (None,)], "g string")
    assert [r[0] for r in df.select(loans.grade_code(F.col("g"))).collect()] == [1, 7, None, None]


@pytest.fixture(scope="module")
def scores(spark):
    rows = [(1, 0.9), (1, 0.8), (0, 0.8), (1, 0.4), (0, 0.4), (0, 0.1), (0, 0.1)]
    return spark.createDataFrame(rows, "y int, p double")


def test_curve_numbers_by_hand(spark, scores):
    assert curves.average_precision(scores, "p", "y").first()[0] == pytest.approx(
        1 / 3 * 1 + 1 / 3 * 2 / 3 + 1 / 3 * 3 / 5
    )
    pairs = [(a, b) for ya, a in scores.collect() if ya for yb, b in scores.collect() if not yb]
    want = sum((a > b) + (a == b) / 2 for a, b in pairs) / len(pairs)
    assert curves.roc_auc(scores, "p", "y").first()[0] == pytest.approx(want)
    assert curves.ks_statistic(scores, "p", "y").first()[0] == pytest.approx(
        max(1 / 3, 2 / 3 - 1 / 4, 1 - 2 / 4)
    )
    best = curves.best_threshold(scores, "p", "y").first()
    assert best["threshold"] == 0.4 and best["f1"] == pytest.approx(0.75, abs=1e-6)


def test_undefined_ratios_are_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, flag int")
    report = {r["class"]: r for r in metrics.classification_report(df, "y", "flag").collect()}
    assert report["1"]["precision"] == report["1"]["recall"] == report["1"]["f1"] == 0.0
    cells = metrics.confusion_matrix(df, "y", "flag").collect()
    assert sorted((r["actual"], r["predicted"], r["n"]) for r in cells) == [
        (0, 0, 2), (0, 1, 0), (1, 0, 0), (1, 1, 0),
    ]


def test_results_do_not_depend_on_row_order(spark, scores):
    a = curves.pr_curve(scores.repartition(1), "p", "y").orderBy("threshold").collect()
    b = curves.pr_curve(scores.orderBy(F.rand(1)).repartition(5), "p", "y").orderBy("threshold").collect()
    assert a == b


def test_money_is_summed_at_full_precision(spark):
    from datetime import datetime

    lines = [("c", "i", datetime(2024, 1, 1), 1.0, p) for p in (0.004, 0.004, 0.004, 0.001)]
    clean = spark.createDataFrame(lines, "customer_id string, invoice string, invoice_ts timestamp, quantity double, price double")
    clean = clean.withColumn("total_price", F.col("quantity") * F.col("price"))
    assert rfm.rfm_table(clean).first()["monetary"] == 0.013


def test_correlations_are_pairwise_over_known_values(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(1e6, 1.0, (300, 4))
    x[:, 2] = x[:, 0] * 2 + 5
    x[:, 3] = 7.0
    x[rng.random((300, 4)) < 0.2] = np.nan
    x[:5, 0] = np.nan
    rows = [[None if np.isnan(v) and i % 2 else float(v) for v in r] for i, r in enumerate(x)]
    cols = list("abcd")
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(5)
    want = pd.DataFrame(x, columns=cols).corr()
    for r in metrics.correlations(df, cols).collect():
        if "d" in (r["a"], r["b"]):
            assert r["corr"] is None
        else:
            assert r["corr"] == pytest.approx(want.loc[r["a"], r["b"]], abs=1e-9)
