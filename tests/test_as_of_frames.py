import random
import re

from riskframe.operators import ordering


def test_carried_points_come_from_running_frames(spark, monkeypatch):
    """A frame that ends with its bucket is worked out anew for every row: time follows the square of a bucket."""
    sides, real = [], ordering.join_checked
    monkeypatch.setattr(ordering, "join_checked", lambda df, side, *a, **k: sides.append(side) or real(df, side, *a, **k))
    rng = random.Random(4)
    asked = [None, float("nan"), -5.0, 99.0] + [rng.uniform(-1, 20) for _ in range(300)] + [float(rng.randint(0, 19)) for _ in range(60)]
    points = [(float(k), f"p{k}") for k in range(0, 20, 3)]
    df = spark.createDataFrame(list(enumerate(asked)), "id long, at double")
    placed = ordering.as_of(df, "at", spark.createDataFrame(points, "k double, name string"), "k", ["name"])
    frames = re.findall(r"windowspecdefinition\(_b#\w+, _v#\w+ \w+ NULLS \w+, specifiedwindowframe\(RowFrame, ([^,]*), ([^)]*)", sides[0]._jdf.queryExecution().optimizedPlan().toString())
    assert frames and all("unboundedfollowing" not in end for _, end in frames)
    got = {r.id: (r.before and tuple(r.before), r.after and tuple(r.after)) for r in placed.collect()}
    assert len(got) == len(asked)
    for i, v in enumerate(asked):
        known = v is not None and v == v
        before = max((p for p in points if known and p[0] <= v), default=None)
        after = min((p for p in points if known and p[0] >= v), default=None)
        assert got[i] == (before, after), v
