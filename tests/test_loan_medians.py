import math
import random
import re

from riskframe.operators import ordering, survival


def test_median_months_of_many_hazards_come_from_running_frames(spark, monkeypatch):
    sides, real = [], ordering.join_checked
    monkeypatch.setattr(ordering, "join_checked", lambda df, side, *a, **k: sides.append(side) or real(df, side, *a, **k))
    rng = random.Random(8)
    hazards = [None, 1e-9, 50.0] + [rng.lognormvariate(0, 1) for _ in range(400)]
    steps = [(float(t), h) for t, h in zip(range(1, 61), [0.0, 0.0] + sorted(round(rng.random() * 2, 1) for _ in range(58)), strict=True)]
    df = spark.createDataFrame(list(enumerate(hazards)), "loan_id long, hazard_ratio double")
    scored = survival.score_loans(df, spark.createDataFrame(steps, "t double, h0 double"))
    plan = sides[0]._jdf.queryExecution().optimizedPlan().toString()
    frames = re.findall(r"windowspecdefinition\(_b#\w+, _v#\w+ \w+ NULLS \w+, specifiedwindowframe\(RowFrame, ([^,]*), ([^)]*)", plan)
    assert frames and all("unboundedfollowing" not in end for _, end in frames)
    got = {r.loan_id: r for r in scored.collect()}
    assert len(got) == len(hazards)
    for i, h in enumerate(hazards):
        if h is None:
            assert got[i].median_months is None
            continue
        assert got[i].median_months == min((t for t, h0 in steps if h0 >= math.log(2) / h), default=None)
        assert math.isclose(got[i].s_12m, math.exp(-steps[11][1] * h), rel_tol=1e-12)
