import itertools
import random

import corpus_pipeline
import numpy as np
import pytest
from riskframe.llm import partenum
from test_sets_and_rules import brute_components, near_texts

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("percent", [80, 85])
def test_sets_that_share_few_features_share_no_signature(percent):
    rng = np.random.default_rng(3)
    common = rng.integers(0, 1 << 63, 60).astype(np.uint64)
    sets = [np.concatenate([rng.choice(common, 12, replace=False), rng.integers(0, 1 << 63, 900).astype(np.uint64)]) for _ in range(60)]
    sig, who = partenum.signatures(np.concatenate(sets), np.array([len(s) for s in sets]), percent)
    of = [set(sig[who == i]) for i in range(len(sets))]
    assert sum(bool(a & b) for a, b in itertools.combinations(of, 2)) <= 2
    # One signature more than the features in which the set and the largest partner differ.
    most = (100 - percent) * (912 + 91200 // percent) // (100 + percent)
    assert max(map(len, of)) <= 2 * (most + 1)


@pytest.mark.parametrize("percent", [80, 85])
def test_linked_sets_of_different_sizes_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    for size in [*range(4, 60), 75, 110, 160, 233, 338, 490, 710, 1500]:
        for _ in range(12):
            inside = rng.integers(0, 1 << 63, size).astype(np.uint64)
            room = size * (100 - percent) // percent  # the union may have as many more
            left = rng.integers(0, room + 1)
            new = rng.integers(0, 1 << 63, room).astype(np.uint64)
            a, b = np.append(inside, new[:left]), np.append(inside, new[left:])
            if not room:
                continue
            sig, who = partenum.signatures(np.concatenate([a, b]), np.array([len(a), len(b)]), percent)
            assert set(sig[who == 0]) & set(sig[who == 1]), (size, left, room)


def test_stage_equals_brute_force_at_five_words(spark):
    rows = near_texts(4)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()}
    assert kept == {root for _, root in brute_components(rows, 80, 5).values()}


def test_sketches_never_exceed_the_difference(spark):
    rng = random.Random(8)
    base = [f"w{rng.randrange(5000)}" for _ in range(2500)]
    edited = list(base)
    for at in rng.sample(range(2500), 60):
        edited[at] = "changed"
    other = [f"w{rng.randrange(5000)}" for _ in range(2500)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate([base, edited, other])], "id bigint, text string")
    known = docs.select("id", partenum._describe(docs.text, 5, 80).alias("d")).select("id", "d.*")
    join = partenum._Join(known, 5, 80)
    pairs = join.info("a").crossJoin(join.info("b")).where("a < b")
    folded = join.info("a", folded=True).crossJoin(join.info("b", folded=True)).where("a < b")
    left = {(r.a, r.b) for r in pairs.where(partenum._near("a", "b", 80)).collect()}
    assert left == {(0, 1)}  # 512 bits would leave the unrelated pairs of this size too
    assert (0, 1) in {(r.a, r.b) for r in folded.where(partenum._near("a", "b", 80, partenum.FOLDED_LONGS)).collect()}
