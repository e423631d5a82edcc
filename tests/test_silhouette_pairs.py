import numpy as np
import pytest

from riskframe.operators import rfm, tiles

COLS = ["a", "b"]


def brute(rows):
    x, c = np.array([r[2:] for r in rows]), np.array([r[1] for r in rows])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    values = []
    for i, own in enumerate(c):
        n = (c == own).sum()
        a = d[i, c == own].sum() / max(n - 1, 1)
        b = min(d[i, c == k].mean() for k in set(c) - {own})
        values.append(0.0 if n == 1 else (b - a) / max(a, b))
    return float(np.mean(values))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(6)
    made = [(i, int(rng.choice([2, 3, 7])), *map(float, rng.normal(size=2) * rng.lognormal(0, 2))) for i in range(700)]
    return [*made, (700, 9, 0.5, 0.5), *[(701 + i, 2, 1.0, 1.0) for i in range(40)]]  # one alone, equal points


@pytest.mark.parametrize("rows_per_tile", [65_536, 100, 350])
def test_silhouette_equals_all_pairs(spark, rows, rows_per_tile):
    df = spark.createDataFrame(rows, "id long, cluster_id int, a double, b double")
    got = rfm.silhouette_exact(df, "id", COLS, rows_per_tile).first()
    assert got.n == len(rows) and abs(got.silhouette - brute(rows)) < 1e-12


def test_a_distance_is_taken_once_for_both_of_its_ends(spark, rows, monkeypatch):
    """Rows move once per tile, not once per tile and side, and no row leaves a task once per tile and cluster."""
    df = spark.createDataFrame(rows, "id long, cluster_id int, a double, b double")
    plan = rfm.silhouette_exact(df, "id", COLS, 100)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsIn" not in plan
    x = np.array([r[2:] for r in rows])
    codes = np.sort(np.array([r[1] for r in rows]) % 4)
    d = np.sqrt(((x[:300, None] - x[None, 300:]) ** 2).sum(axis=2))
    a, b = np.sort(codes[:300]), np.sort(codes[300:])
    monkeypatch.setattr(tiles, "CACHE_ROWS", 7)
    monkeypatch.setattr(tiles, "CACHE_COLUMNS", 11)
    left, right = tiles.paired_distance_sums((x[:300], a), (x[300:], b), clusters=4)
    for k in range(4):
        assert np.allclose(left[:, k], d[:, b == k].sum(axis=1)) and np.allclose(right[:, k], d[a == k].sum(axis=0))


def test_rows_without_a_cluster_count_for_no_one(spark, rows):
    df = spark.createDataFrame([*rows, (5000, None, 3.0, 3.0)], "id long, cluster_id int, a double, b double")
    got = rfm.silhouette_exact(df, "id", COLS, 100).first()
    assert got.n == len(rows) + 1 and abs(got.silhouette - brute(rows)) < 1e-12
    empty = rfm.silhouette_exact(df.where("id < 0"), "id", COLS).first()
    assert empty.n == 0 and empty.silhouette is None
