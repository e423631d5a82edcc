import numpy as np
import pytest
from data import documents, empty
from pyspark.sql import functions as F
from riskframe.llm import langid, mixing, quality_mil
from riskframe.llm.common import class_sample, held_out, passages

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_language_on_held_out_rows(docs):
    model = langid.train(docs.where(~held_out()), max_rows=600)
    found = langid.identify(docs.where(held_out()), model).select("lang", "lang_pred", "score", "rejected").toPandas()
    assert (found.lang == found.lang_pred).mean() > 0.97
    assert found.score.between(0, 1).all() and found.rejected.mean() < 0.02


@pytest.mark.parametrize("held", ["de", "en", "es", "fr"])
def test_a_language_kept_from_training_is_rejected(spark, held):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang")
    model = langid.train(docs.where(~held_out() & (F.col("lang") != held)))
    found = langid.identify(docs.where(held_out() & F.col("text").rlike(r"\p{L}")), model)
    shares = {r.held: r.share for r in found.groupBy((F.col("lang") == held).alias("held")).agg(F.avg(F.col("rejected").cast("int")).alias("share")).collect()}
    assert shares[True] > 0.9 and shares[False] < 0.01


def test_junk_is_rejected(spark, docs):
    model = langid.train(docs.where(~held_out()))
    junk = ["Съешь же ещё этих мягких французских булок", "これは日本語の文章です。", "qxzv kjwq zzxp wvkq jjqx " * 4, "9f3c2b7a8d " * 9]
    df = spark.createDataFrame(list(enumerate(junk)), "doc_id bigint, text string")
    assert all(r.rejected for r in langid.identify(df, model).collect())


def test_samples_hold_every_class_and_are_the_same_every_time(spark):
    rows = [(i, f"text {i}", "rare" if i % 500 == 0 else "common") for i in range(5000)]
    rows += [(i, f"other {i}", "rare") for i in range(0, 5000, 250)] + [(None, "x", "rare"), (9999, None, "null text"), (9998, "x", None)]
    found = []
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(parts)
        found.append({(r.doc_id, r.text, r.lang) for r in class_sample(df, "doc_id", "lang", "text", 60, 8).collect()})
    assert found[0] == found[1] and len(found[0]) == 60
    assert sum(r[2] == "rare" for r in found[0]) >= 8 and sum(r[2] == "null text" for r in found[0]) == 1


def test_passages_of_long_texts(spark):
    long = "".join(f"{i:05d}" for i in range(2000))
    df = spark.createDataFrame([(long,), ("short",), (None,)], "text string")
    got = [r[0] for r in df.select(passages(F.col("text"), 800)).collect()]
    assert got[0] == " ".join(long[1250 * k : 1250 * k + 100] for k in range(8)) and got[1:] == ["short", None]


def test_language_of_odd_rows(spark, docs):
    model = langid.train(docs, max_rows=200)
    found = langid.identify(documents(spark), model)
    rows = found.select("doc_id", "lang_pred", "score", "rejected").collect()
    assert len(rows) == 12
    for r in rows:
        assert (r.lang_pred == "und") == (r.doc_id in (3, 4, 5, 6)) and (r.lang_pred != "und" or (r.score == 0 and r.rejected))
    kept = langid.keep_identified(documents(spark), model)
    assert kept.columns == documents(spark).columns and {3, 4, 5, 6}.isdisjoint(r.doc_id for r in kept.collect())
    assert langid.identify(empty(spark), model).count() == 0
    untrained = langid.train(empty(spark))
    assert {r.lang_pred for r in langid.identify(documents(spark), untrained).collect()} == {"und"}


def test_quality_on_held_out_rows(docs, labels):
    labelled = docs.join(labels.select("doc_id", "quality"), "doc_id")
    model = quality_mil.train(labelled.where(~held_out()))
    found = quality_mil.score_quality(labelled.where(held_out()), model).toPandas()
    good, bad = found[found.quality == 1].score, found[found.quality == 0].score
    assert np.mean(good.to_numpy()[:, None] > bad.to_numpy()[None, :]) > 0.95
    assert (found.predicted == (found.score >= 0.3)).all()


def test_quality_gradient_matches_differences():
    rng = np.random.default_rng(0)
    f, h, a = 5, 4, 3
    p = {
        "We": rng.normal(size=(f, h)), "be": rng.normal(size=h), "V": rng.normal(size=(h, a)), "U": rng.normal(size=(h, a)),
        "w": rng.normal(size=a), "c": rng.normal(size=h), "b": np.array(0.3),
    }
    model = quality_mil.Weights(np.zeros(f), np.ones(f), p)
    x, per_text, y = rng.normal(size=(9, f)), np.array([2, 1, 6]), np.array([1.0, 0, 1])

    def loss():
        s = model.forward(x, per_text)["s"]
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).mean()

    grad = model.gradient(x, per_text, y)
    for k in p:
        flat = p[k].reshape(-1) if p[k].ndim else None
        for i in range(flat.size if flat is not None else 1):
            old = p[k].copy()
            steps = []
            for d in (1e-5, -1e-5):
                new = old.copy()
                new.reshape(-1)[i] += d
                p[k] = new
                steps.append(loss())
            p[k] = old
            assert np.isclose((steps[0] - steps[1]) / 2e-5, np.asarray(grad[k]).reshape(-1)[i], atol=1e-6)


def test_quality_of_odd_rows(spark, docs, labels):
    model = quality_mil.train(docs.join(labels, "doc_id"), max_rows=200, epochs=5)
    rows = quality_mil.score_quality(documents(spark), model).collect()
    assert len(rows) == 12 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (3, 4)}) == 1
    assert quality_mil.score_quality(empty(spark), model).count() == 0
    one_class = quality_mil.train(documents(spark).withColumn("quality", F.lit(1)))
    assert {r.score for r in quality_mil.score_quality(documents(spark), one_class).collect()} == {1.0}


def test_attention_scores_the_whole_text(spark, docs, labels):
    """The order of passages does not matter, the last one counts like the first."""
    model = quality_mil.train(docs.join(labels, "doc_id"), max_rows=300, epochs=5)
    clean, junk = "the and of to in that is was for it " * 13, "%%% $$$ ### &&& " * 32
    df = spark.createDataFrame([(0, clean + junk), (1, junk + clean), (2, clean)], "doc_id int, text string")
    s = {r.doc_id: r.score for r in quality_mil.score_quality(df, model).collect()}
    assert abs(s[0] - s[1]) < 0.2 and s[2] != s[0]


def mixed_rows(spark, seed, n=1500):
    rng = np.random.default_rng(seed)
    p, t = rng.dirichlet([0.4, 0.3, 0.3], n), rng.integers(0, 900, n).astype(float)
    rows = spark.createDataFrame([(int(a), [float(v) for v in q]) for a, q in zip(t, p, strict=True)], "tokens bigint, p array<double>")
    return rows.repartition(5), t, p


def test_mixing_meets_targets_and_stays_nonnegative(spark):
    rows, t, p = mixed_rows(spark, 1)
    mix = mixing.fit(rows, ["a", "b", "c"], {"a": 0.7, "b": 0.25, "c": 0.05})
    rate = mixing.rate_of(mix, [F.col("p")[j] for j in range(3)])
    got = rows.withColumn("x", rate).agg(F.min("x"), *[F.sum(F.col("tokens") * F.col("p")[j] * F.col("x")) for j in range(3)]).first()
    assert got[0] >= 0 and mix.converged and not mix.exceeded
    assert np.allclose(np.array(got[1:]) / sum(got[1:]), [0.7, 0.25, 0.05], atol=2e-4)
    assert np.allclose(list(mix.totals.values()), got[1:]) and max(map(abs, mix.residuals.values())) < 1e-4 * t.sum()


@pytest.mark.parametrize("keep, weights", [((), {"a": 0.5, "b": 0.3, "c": 0.2}), (("a",), {"a": 0.96, "b": 0.03, "c": 0.01}), (("a",), {"a": 0.5, "b": 0.3, "c": 0.2})])
def test_mixing_equals_a_dense_bounded_solver(spark, keep, weights):
    """Projected gradients on all rates at once, with no scaling and many steps, reach no lower objective."""
    rows, t, p = mixed_rows(spark, 2)
    mix = mixing.fit(rows, ["a", "b", "c"], weights, repeats=1.05, keep=keep)
    assert mix.converged and mix.gradient <= 1e-6
    w, target = t / t.sum(), np.array(list(mix.targets.values())) / t.sum()
    likeliest = p[:, 0] >= p[:, 1:].max(axis=1)
    low = np.where(likeliest, 1.0, 0.0) if keep else np.zeros(len(t))
    high = np.where(likeliest, mixing.MOST, 1.0) if keep else np.full(len(t), np.inf)

    def off(x):
        return (w * x) @ p - target

    x, y, k = np.ones(len(t)), np.ones(len(t)), 1.0
    step = 1 / np.linalg.norm((w[:, None] * p).T @ p, 2)
    for _ in range(20_000):
        new = np.clip(y - step * (p @ off(y)), low, high)
        after = (1 + np.sqrt(1 + 4 * k * k)) / 2
        x, y, k = new, new + (k - 1) / after * (new - x), after
    found = np.array(list(mix.totals.values())) / t.sum() - target
    assert np.abs(found).max() <= np.abs(off(x)).max() + 2e-5 and abs((found**2).sum() - (off(x) ** 2).sum()) < 1e-6
    exact = [r.x for r in rows.select(mixing.rate_of(mix, [F.col("p")[j] for j in range(3)]).alias("x")).collect()]
    assert min(exact) >= 0 and (not keep or max(exact) <= mixing.MOST)


def test_a_limit_out_of_reach_is_named(spark):
    rows = spark.createDataFrame([(100, [0.6, 0.4])] * 50 + [(100, [0.1, 0.9])] * 5, "tokens bigint, p array<double>")
    with pytest.warns(UserWarning, match="bad"):
        mix = mixing.fit(rows, ["good", "bad"], {"good": 0.99, "bad": 0.01}, keep=("good",))
    assert mix.exceeded == ["bad"] and mix.converged and mix.residuals["bad"] > 0


def test_mixing_odd_rows(spark, docs, labels):
    domain = F.when(F.col("quality") == 1, "good").otherwise("low").alias("domain")
    model = mixing.train(docs.join(labels.select("doc_id", domain), "doc_id"), max_rows=200, epochs=10)
    m = documents(spark).select("doc_id", mixing.posteriors(model, F.col("text")).alias("m")).select("doc_id", "m.*")
    rows = m.collect()
    assert len(rows) == 12 and all(abs(sum(r.p) - 1) < 1e-9 for r in rows) and {r.tokens for r in rows if r.doc_id in (3, 4, 5)} == {0}
    fitted = mixing.fit(m, model.domains, {"good": 1.0, "low": 0.2})
    assert all(r.x >= 0 for r in m.withColumn("x", mixing.rate_of(fitted, [F.col("p")[j] for j in range(2)])).collect())
    nothing = mixing.fit(m.where("false"), model.domains, {"good": 1.0})
    assert nothing.steps == []
    assert mixing.train(empty(spark).withColumn("domain", F.lit("x"))).domains == []


def test_copies_follow_the_rate(spark):
    df = spark.range(20_000).select("id", mixing.copies(F.lit(1.3), "id").alias("n"))
    assert abs(df.agg(F.avg("n")).first()[0] - 1.3) < 0.02
