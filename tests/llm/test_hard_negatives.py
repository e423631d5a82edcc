import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from riskframe.llm import hard_negatives, queries

SCHEMA = "vec_id bigint, embedding array<float>, label int, score string, q int, home string"


def brute(rows):
    """(anchor, positive, rank, negative, positive score, negative score) by definition."""
    kept = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        q = [int(np.floor(256.0 * float(np.float32(x)))) for x in v]
        kept[i] = min(kept.get(i, (label, q)), (label, q))
    out = set()
    for a, (label, q) in kept.items():
        if a % 100:
            continue
        scores = sorted((-sum(x * y for x, y in zip(q, w, strict=False)), i) for i, (_, w) in kept.items() if i != a)
        own = [(i, -s) for s, i in scores if kept[i][0] == label][:5]
        for p, best in own:
            fit = [(i, -s) for s, i in scores if kept[i][0] != label and 80 * best <= -100 * s <= 100 * best]
            out |= {(a, p, r, n, best, s) for r, (n, s) in enumerate(fit[:5], 1)}
    return out


def table(spark, rows):
    odd = [(i, None if v is None else [None if x is None else float(x) for x in v], label, "x", 1, "y") for i, v, label in rows]
    return spark.createDataFrame(odd, SCHEMA)


def clustered(seed, number, dims=12):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, dims))
    rows = []
    for i in range(number):
        v = centres[i % 6] + 0.4 * rng.standard_normal(dims)
        rows.append((i, np.float32(v / np.linalg.norm(v)).tolist(), int(rng.integers(0, 5))))
    return rows


def odd_rows():
    """Ties, zero and opposite vectors, other lengths, nulls, repeated ids and a label with one row."""
    rng = random.Random(2)
    rows = [(i, [round(rng.uniform(-1, 1), 1) for _ in range(3)], rng.randrange(3)) for i in range(0, 400, 3)]
    rows += [(i, [0.5, 0.5, 0.5], i % 4) for i in range(500, 640)]
    rows += [(700, [0.0, 0.0, 0.0], 1), (800, [-0.5, -0.5, -0.5], 2), (900, [0.3], 1), (1000, [1.0, 0.0, 0.0, 2.0], 77)]
    rows += [(None, [0.5, 0.5, 0.5], 1), (1100, None, 1), (1200, [0.5, None, 0.5], 1), (1300, [float("nan")] * 3, 1)]
    rows += [(1400, [float("inf"), 0.0, 0.0], 1), (1500, [0.5, 0.5, 0.5], None), (600, [0.9, 0.1, 0.5], 3), (600, [0.9, 0.1, 0.5], 3)]
    return rows


@pytest.mark.parametrize("rows", [clustered(1, 1500), odd_rows()], ids=["clustered", "odd"])
def test_mined_rows_equal_brute_force(spark, tmp_path, rows):
    table(spark, rows).repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries.op12_hard_negatives(spark, str(tmp_path)).collect()
    assert {(r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in found} == brute(rows)
    assert len(found) == len(brute(rows))


def test_several_passes_and_small_blocks(spark, tmp_path, monkeypatch):
    rows = clustered(3, 900)
    monkeypatch.setattr(hard_negatives, "PASS_BYTES", 1000)
    monkeypatch.setattr(hard_negatives, "REFERENCES", 3)
    table(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries.op12_hard_negatives(spark, str(tmp_path)).collect()
    assert {(r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in found} == brute(rows)


def test_bounds_hold_every_score():
    rng = np.random.default_rng(4)
    for dims in (1, 2, 3, 64):
        a, b, refs = (np.floor(256 * rng.standard_normal((n, dims))) for n in (40, 300, 5))
        a[0] = 0
        b[:3], b[3] = a[1:4], -a[1]
        unit = refs / np.maximum(np.linalg.norm(refs, axis=1, keepdims=True), 1e-300)

        def angles(x, unit=unit):
            norm = np.linalg.norm(x, axis=1)
            return np.arccos(np.clip(x @ unit.T / np.maximum(norm, 1e-300)[:, None], -1, 1)), norm

        (ta, na), (tb, nb) = angles(a), angles(b)
        lower, upper = hard_negatives.bounds(*hard_negatives.interval(ta, ta, tb, tb), np.outer(na, nb), np.outer(na, nb))
        scores = a @ b.T
        assert (lower <= scores).all() and (scores <= upper).all()
        low, high = hard_negatives.interval(ta.min(0)[None], ta.max(0)[None], tb.min(0)[None], tb.max(0)[None])
        lower, upper = hard_negatives.bounds(low, high, na.min() * nb.min(), na.max() * nb.max())
        assert lower[0, 0] <= scores.min() and scores.max() <= upper[0, 0]


def test_clustered_rows_are_mostly_ruled_out():
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((8, 32))
    x = np.repeat(centres, 100, axis=0) + 0.05 * rng.standard_normal((800, 32))
    x = np.floor(256 * x / np.linalg.norm(x, axis=1, keepdims=True))
    norm, unit = np.linalg.norm(x, axis=1), x[::100] / np.linalg.norm(x[::100], axis=1, keepdims=True)
    t = np.arccos(np.clip(x @ unit.T / norm[:, None], -1, 1))
    _, upper = hard_negatives.bounds(*hard_negatives.interval(t, t, t, t), np.outer(norm, norm), np.outer(norm, norm))
    fifth = np.sort(x @ x.T, axis=1)[:, -6]
    assert (upper >= fifth[:, None]).mean() < 0.2


def test_wide_products_stay_exact():
    a = np.array([[2**31 - 1, -(2**30)]], np.int64)
    assert hard_negatives._products(a, a).tolist() == [[(2**31 - 1) ** 2 + 2**60]]


def test_empty_table(spark, tmp_path):
    table(spark, [(1, [1.0], 1)]).where(F.lit(False)).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert queries.op12_hard_negatives(spark, str(tmp_path)).count() == 0
