import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskframe.operators import cox, survival


def make(spark, n=400, seed=2, hot=True):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2))
    t = np.round(rng.exponential(np.exp(-0.5 * x[:, 0])) * 10 + 0.1, 1)
    if hot:
        t[: n // 3] = 6.0  # a third of the rows end at one time
    e = (rng.random(n) < 0.6).astype(int)
    rows = [(i, float(a), int(b), float(c), float(d)) for i, (a, b, (c, d)) in enumerate(zip(t, e, x))]
    return spark.createDataFrame(rows, "id int, t double, e int, a double, b double")


def test_kaplan_meier_by_hand(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 0), (2.0, 1), (3.0, 1)], "t double, e int")
    got = {r["t"]: r for r in survival.kaplan_meier(df, "t", "e").collect()}
    assert [got[t]["at_risk"] for t in (1.0, 2.0, 3.0)] == [4, 3, 1]
    assert [got[t]["s"] for t in (1.0, 2.0, 3.0)] == pytest.approx([0.75, 0.5, 0.0])
    assert got[1.0]["s_low"] < 0.75 < got[1.0]["s_high"]
    curve = survival.kaplan_meier(df, "t", "e")
    assert survival.median_survival(curve).first()["median_t"] == 2.0
    above = curve.where("t < 2")
    assert survival.median_survival(above).first()["median_t"] is None


def test_concordance_by_hand(spark):
    # Equal times: an event counts as shorter than a censored row, two events do not compare.
    rows = [(1.0, 1, 5.0), (2.0, 1, 3.0), (2.0, 0, 3.0), (2.0, 1, 9.0), (3.0, 0, 1.0)]
    df = spark.createDataFrame(rows, "t double, e int, r double")
    got = survival.concordance(df, "t", "e", "r").first()
    comparable = concordant = tied = 0
    for ti, ei, ri in rows:
        for tj, ej, rj in rows:
            if ei and (ti < tj or (ti == tj and not ej)):
                comparable += 1
                concordant += ri > rj
                tied += ri == rj
    assert (got["comparable"], got["concordant"], got["tied"]) == (comparable, concordant, tied)


def test_concordance_matches_pairs_on_skewed_data(spark):
    df = make(spark).withColumn("r", F.round("a", 1))
    got = survival.concordance(df, "t", "e", "r").first()
    rows = [(r["t"], r["e"], r["r"]) for r in df.collect()]
    want = [0, 0, 0]
    for ti, ei, ri in rows:
        for tj, ej, rj in rows:
            if ei and (ti < tj or (ti == tj and not ej)):
                want[0] += 1
                want[1] += ri > rj
                want[2] += ri == rj
    assert [got["comparable"], got["concordant"], got["tied"]] == want


@pytest.mark.parametrize("d, s, e", [(50, 90.0, 20.0), (50, 30.0, 29.0), (400, 1000.0, 10.0)])
def test_tie_sums_closed_forms(monkeypatch, d, s, e):
    direct = cox.tie_sums(d, s, e)
    monkeypatch.setattr(cox, "DIRECT_TIES", 0)
    assert cox.tie_sums(d, s, e) == pytest.approx(direct, rel=2e-3 if d < 100 else 1e-4)


def efron(beta, t, e, x):
    """Textbook log partial likelihood with Efron ties."""
    lp = x @ beta
    total = 0.0
    for u in np.unique(t[e == 1]):
        dead = (t == u) & (e == 1)
        risk, ties = np.exp(lp[t >= u]).sum(), np.exp(lp[dead]).sum()
        d = dead.sum()
        total += lp[dead].sum() - sum(math.log(risk - l / d * ties) for l in range(d))
    return total


def test_cox_fit_is_the_penalised_maximum_on_both_paths(spark):
    df = make(spark, 240)
    model = cox.fit_cox(df, "t", "e", ["a", "b"], penalizer=0.1)
    spread = cox.fit_cox(df, "t", "e", ["a", "b"], penalizer=0.1, max_times_on_driver=0)
    assert model.gradient_norm < 1e-6 and spread.gradient_norm < 1e-6
    assert spread.beta == pytest.approx(model.beta, abs=1e-8)
    rows = df.toPandas()
    t, e, x = rows["t"].to_numpy(), rows["e"].to_numpy(), rows[["a", "b"]].to_numpy()

    def objective(b):
        return efron(b, t, e, x) - len(t) * 0.1 / 2 * float(b @ b)

    best = objective(model.beta)
    assert best == pytest.approx(model.log_likelihood)
    for step in np.vstack([np.eye(2), -np.eye(2)]) * 1e-3:
        assert objective(model.beta + step) < best
    table = model.table(spark).collect()
    assert all(r["lower_95"] < r["coef"] < r["upper_95"] for r in table)


def test_scored_curves_fall_and_order_by_hazard(spark):
    df = make(spark)
    rows = survival.partial_hazard(df, {"a": 0.7, "b": 0.0})
    base = survival.baseline_hazard(rows, "t", "e")
    curve = base.orderBy("t").collect()
    assert all(a["s0"] >= b["s0"] for a, b in zip(curve, curve[1:]))
    scored = survival.score_loans(rows, base).orderBy("hazard_ratio").collect()
    assert all(r["s_12m"] >= r["s_24m"] >= r["s_36m"] for r in scored)
    assert all(a["s_12m"] >= b["s_12m"] for a, b in zip(scored, scored[1:]))


def test_interpolation_is_linear_and_clamped(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (3.0,), (9.0,), (None,)], "x double")
    curve = spark.createDataFrame([(3.0, 0.5), (1.0, 0.9)], "t double, s double")
    got = {r["x"]: r["s"] for r in survival.interpolate_at(curve, df, "x").collect()}
    assert got.pop(None) is None and got == pytest.approx({0.0: 0.9, 1.0: 0.9, 2.0: 0.7, 3.0: 0.5, 9.0: 0.5})
    nothing = survival.interpolate_at(curve.where("false"), df, "x").collect()
    assert len(nothing) == 6 and all(r["s"] is None for r in nothing)


def test_a_curve_of_many_times_is_read_like_numpy(spark):
    rng = np.random.default_rng(8)
    t = np.sort(rng.choice(10**7, 300_000, replace=False)) / 10.0
    s = np.exp(-np.cumsum(rng.random(300_000)) / 1e5)
    at = np.concatenate([rng.uniform(-10, 1e6 + 10, 3000), t[:50], np.repeat(t[77], 2000)])
    curve = spark.createDataFrame(pd.DataFrame({"t": t, "s": s})).repartition(6)
    df = spark.createDataFrame(pd.DataFrame({"x": at}))
    got = survival.interpolate_at(curve, df, "x").toPandas()
    assert len(got) == len(at) and np.allclose(got.s, np.interp(got.x, t, s), atol=1e-12)


def test_median_is_the_first_crossing(spark):
    base = spark.createDataFrame([(1.0, 0.1), (2.0, 0.1), (3.0, 0.5), (4.0, 1.0)], "t double, h0 double")
    df = spark.createDataFrame([(0.5,), (1.0,), (2.0,), (10.0,)], "hazard_ratio double")
    got = {r["hazard_ratio"]: r["median_months"] for r in survival.score_loans(df, base).collect()}
    assert got == {0.5: None, 1.0: 4.0, 2.0: 3.0, 10.0: 1.0}
