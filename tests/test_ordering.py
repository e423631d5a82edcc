import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import ordering, sampling, tiles


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one value; group 'hot' holds most rows."""
    rng = np.random.default_rng(7)
    x = np.where(rng.random(6000) < 0.34, 5.0, np.round(rng.normal(0, 50, 6000), 3))
    g = np.where(rng.random(6000) < 0.7, "hot", "cold")
    rows = [(i, str(k), float(v), 1 if v > 3 else 0) for i, (k, v) in enumerate(zip(g, x))]
    rows += [(6000, "hot", None, 0), (6001, "hot", float("nan"), 0)]
    return spark.createDataFrame(rows, "id long, g string, x double, y int").repartition(8).cache()


@pytest.mark.parametrize("cells", [0, 20, 10**9])
def test_quantiles_match_numpy_however_often_cells_are_cut(spark, skewed, cells):
    probs = [0.0, 0.01, 0.25, 0.5, 0.95, 0.99, 1.0]
    data = skewed.dropna().where(~F.isnan("x")).toPandas()
    whole = ordering.exact_quantiles(skewed, ["x"], probs, cell_rows=cells).collect()
    assert whole[0]["n"] == len(data)
    assert whole[0]["q"] == pytest.approx(list(np.quantile(data["x"], probs)))
    for r in ordering.exact_quantiles(skewed, ["x"], probs, ["g"], cell_rows=cells).collect():
        part = data[data["g"] == r["g"]]["x"]
        assert r["n"] == len(part)
        assert r["q"] == pytest.approx(list(np.quantile(part, probs)))


def test_quantiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert ordering.quantile_values(df, ["x"], [0.5]) == {"x": [None]}
    assert ordering.exact_quantiles(df, ["x"], [0.5], cell_rows=0).count() == 0


@pytest.mark.parametrize("cells", [0, 10**9])
def test_quantiles_of_wild_values_and_null_groups(spark, cells):
    rng = np.random.default_rng(9)
    signs, powers = rng.choice([-1.0, 1.0], 400), rng.uniform(-290, 290, 400)
    x = [*(signs * 10.0**powers), 0.0, -0.0, 5e-324, 1.7e308, -1.7e308, float("inf"), float("-inf")]
    y = [*map(float, rng.integers(-5, 5, len(x) - 1)), None]
    g = [None if i % 3 == 0 else str(i % 3) for i in range(len(x))]
    df = spark.createDataFrame(list(zip(g, map(float, x), y, strict=True)), "g string, x double, y double").repartition(4)
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    found = {(r["g"], r["series"]): (r["n"], r["q"]) for r in ordering.exact_quantiles(df, ["x", "y"], probs, ["g"], cell_rows=cells).collect()}
    assert len(found) == 6
    for (group, series), (n, q) in found.items():
        own = sorted(v for v, k in zip(x if series == "x" else y, g, strict=True) if k == group and v is not None)
        assert n == len(own)
        for p, got in zip(probs, q, strict=True):
            low, high = own[int(p * (n - 1))], own[-int(-p * (n - 1) // 1)]
            share = p * (n - 1) - int(p * (n - 1))
            assert got == (low if low == high else pytest.approx(low + (high - low) * share, nan_ok=True))


@pytest.mark.parametrize("rows", [0, 10**9])
@pytest.mark.parametrize("descending", [False, True])
def test_prefix_sums_match_pandas_on_both_paths(spark, skewed, rows, descending):
    counts = (
        skewed.where(F.col("x").isNotNull() & ~F.isnan("x"))
        .groupBy("g", "x")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    got = ordering.prefix_sum(
        counts, "x", {"upto": "n"}, ["g"], descending, window_rows=rows
    ).toPandas()
    want = counts.toPandas().sort_values("x", ascending=not descending)
    want["upto"] = want.groupby("g")["n"].cumsum()
    want["upto_total"] = want.groupby("g")["n"].transform("sum")
    merged = got.merge(want, on=["g", "x"], suffixes=("", "_w"))
    assert len(merged) == len(want) == len(got)
    assert (merged["upto"] == merged["upto_w"]).all()
    assert (merged["upto_total"] == merged["upto_total_w"]).all()


def test_approximate_quantiles_have_the_same_layout(spark, skewed):
    exact = ordering.exact_quantiles(skewed, ["x"], [0.5], ["g"])
    approx = ordering.approx_quantiles(skewed, ["x"], [0.5], ["g"])
    assert exact.columns == approx.columns and approx.count() == 2


def test_samples_have_exact_sizes_whatever_the_layout(spark, skewed):
    one = sampling.sample_rows(skewed.repartition(1), "id", 500)
    many = sampling.sample_rows(skewed.repartition(13), "id", 500)
    a, b = ({r["id"] for r in d.select("id").collect()} for d in (one, many))
    assert len(a) == 500 and a == b
    assert sampling.sample_rows(skewed, "id", 10**6).count() == skewed.count()


def test_stratified_split_is_exact_per_class(spark, skewed):
    split = sampling.stratified_split(skewed, "id", "y")
    sizes = {(r["y"], r["split"]): r["count"] for r in split.groupBy("y", "split").count().collect()}
    for y in (0, 1):
        n = sizes[(y, "train")] + sizes[(y, "test")]
        assert sizes[(y, "test")] == int(n * 0.2 + 0.5)
    assert split.columns == [*skewed.columns, "split"]


def test_hash_split_is_close_to_the_share(spark, skewed):
    share = sampling.hash_split(skewed, "id").where("split = 'test'").count() / skewed.count()
    assert abs(share - 0.2) < 0.03


def test_neighbours_across_tiles_match_brute_force(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(90, 4)), 1)
    x[60:] = x[0]  # a third of the rows are copies of one point
    df = spark.createDataFrame(
        [(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double, d double"
    )
    got = {}
    for r in tiles.nearest_neighbours(df, "id", list("abcd"), 5, rows_per_tile=20).collect():
        got.setdefault(r["id"], {})[r["rank"]] = r["neighbour"]
    assert tiles.nearest_neighbours(df, "id", list("abcd"), 5, rows_per_tile=20).count() == 450
    for i in range(90):
        d = ((x - x[i]) ** 2).sum(axis=1)
        order = [j for j in sorted(range(90), key=lambda j: (d[j], j)) if j != i][:5]
        assert [got[i][k] for k in range(1, 6)] == order


def test_clustered_rows_visit_few_tiles(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(30, 3)) * 100
    x = np.round(centres[rng.integers(0, 30, 2400)] + rng.normal(size=(2400, 3)), 2)
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double")
    report = {}
    found = tiles.nearest_neighbours(df, "id", list("abc"), 4, rows_per_tile=25, report=report).toPandas()
    assert report["all"] > 1000 and report["visited"] < report["all"] / 10
    got = found.sort_values(["id", "rank"]).neighbour.to_numpy().reshape(2400, 4)
    for i in range(2400):
        d = ((x - x[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        assert got[i].tolist() == np.lexsort((np.arange(2400), d))[:4].tolist()


def test_neighbours_of_odd_tables(spark):
    schema = "id long, a double, b double"
    rows = [(1, 0.0, 0.0), (2, -0.0, 0.0), (3, 0.0, 0.0), (4, None, 1.0), (5, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, schema)
    got = {(r["id"], r["rank"]): (r["neighbour"], r["dist"]) for r in tiles.nearest_neighbours(df, "id", ["a", "b"], 5).collect()}
    assert got == {(1, 1): (2, 0.0), (1, 2): (3, 0.0), (2, 1): (1, 0.0), (2, 2): (3, 0.0), (3, 1): (1, 0.0), (3, 2): (2, 0.0)}
    assert tiles.nearest_neighbours(df.where("id = 4"), "id", ["a", "b"], 5).count() == 0
    assert tiles.nearest_neighbours(df.where("id = 1"), "id", ["a", "b"], 5).count() == 0


def test_oversampling_reaches_the_ratio_between_real_neighbours(spark):
    rng = np.random.default_rng(5)
    rows = [(i, int(i < 7), *map(float, rng.normal(size=2))) for i in range(207)]
    df = spark.createDataFrame(rows, "id long, y int, a double, b double")
    made = sampling.smote(df, "id", "y", ["a", "b"], ratio=0.5, k=3).collect()
    assert len(made) == 100 - 7
    base = {r[0]: r for r in rows if r[1]}
    shares = {}
    for r in made:
        shares[r["id"]] = shares.get(r["id"], 0) + 1
        p, q = base[r["id"]], base[r["neighbour"]]
        for c, i in (("a", 2), ("b", 3)):
            assert min(p[i], q[i]) - 1e-9 <= r[c] <= max(p[i], q[i]) + 1e-9
    assert set(shares.values()) == {13, 14}
    assert sampling.smote(df, "id", "y", ["a", "b"], ratio=0.01).count() == 0


@pytest.mark.parametrize("n", [0, 1, 5, 63, 64, 65, 500])
@pytest.mark.parametrize("inclusive", [False, True])
def test_lookup_among_cuts(spark, n, inclusive):
    cuts = [i * 1.5 - 20 for i in range(n)]
    probes = [-1e9, -20.0, -19.0, 0.0, 1.0, 10.0, 74.5, 1e9]
    df = spark.createDataFrame([(v,) for v in probes], "x double")
    got = [r[0] for r in df.select(ordering.count_below("x", cuts, inclusive)).collect()]
    side = "right" if inclusive else "left"
    assert got == list(np.searchsorted(cuts, probes, side=side))
