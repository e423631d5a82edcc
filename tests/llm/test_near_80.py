import random

import corpus_pipeline
import numpy as np
import pytest
from riskframe.llm import partenum
from test_sets_and_rules import brute_components, near_texts

SF = "/root/testdata/sf0.001"


def brute_stage(rows, monkeypatch):
    import test_sets_and_rules as sets

    monkeypatch.setattr(sets.grams, "__defaults__", (5,))
    return {root for _, root in brute_components(rows, 80).values()}


@pytest.mark.parametrize("seed", [1, 2])
def test_stage_keeps_one_of_each_component_at_five_words_and_80_percent(spark, seed, monkeypatch):
    rng = random.Random(seed)
    rows = near_texts(seed)
    for size in (4, 5, 6, 9):  # sets of 4 to 9 that differ by one n-gram
        words = [f"s{seed}x{size}x{i}" for i in range(size + 5)]
        rows += [(len(rows), " ".join(words[: size + 4])), (len(rows) + 1, " ".join(words))]
        rng.shuffle(words)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()}
    assert kept == brute_stage(rows, monkeypatch)


def test_linked_sets_share_a_signature_at_80_percent():
    rng = np.random.default_rng(5)
    assert (partenum.smallest(80), partenum.smallest(85), partenum.smallest(90)) == (4, 6, 9)
    for size in [4, 5, 6, 7, 9, 13, 33, 150, 700]:
        for _ in range(30):
            a = rng.integers(0, 1 << 63, size).astype(np.uint64)
            drop, add = rng.integers(0, size // 5 + 1), rng.integers(0, size // 4 + 1)
            b = np.concatenate([a[drop:], rng.integers(0, 1 << 63, add).astype(np.uint64)])
            sig, who = partenum.signatures(np.concatenate([a, b]), np.array([len(a), len(b)]), 80)
            if 100 * (size - drop) >= 80 * (size + add) and drop + add:
                assert set(sig[who == 0]) & set(sig[who == 1]), (size, drop, add)
