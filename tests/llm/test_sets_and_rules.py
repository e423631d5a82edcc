import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from data import documents, empty
from riskframe.llm import line_rules, partenum, sharding
from riskframe.llm import text as tx
from riskframe.llm.components import components

WORD = re.compile("[^\x20\x09-\x0d]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, n=4):
    words = WORD.findall((text or "").translate(FOLD))
    if not words:
        return frozenset()
    return frozenset(zip(*[words[k:] for k in range(n)], strict=False)) or frozenset([tuple(words)])


def brute_components(rows, percent, n=4):
    sets = {i: grams(t, n) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_texts(seed, groups=12, copies=14):
    """Chains of edited texts around the limit, short texts, and a passage that many share."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = rng.choices(vocabulary, k=40)
    texts = []
    for g in range(groups):
        base = rng.choices(vocabulary, k=rng.choice([6, 9, 15, 40, 120, 400]))
        if g % 3 == 0:
            base = passage + base[:20]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(words) // 25))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words))
            if rng.random() < 0.5:
                base = words
    return list(enumerate(texts))


@pytest.mark.parametrize("seed, bucket_rows", [(1, 512), (2, 4)])
def test_jaccard_components_equal_brute_force(spark, seed, bucket_rows):
    rows = near_texts(seed)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = partenum.jaccard_components(df, bucket_rows=bucket_rows, pivot_rounds=1).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(rows, 85)


def test_linked_sets_share_a_signature_at_every_size():
    rng = np.random.default_rng(5)
    for size in [6, 7, 8, 9, 13, 20, 33, 60, 150, 700, 3000]:
        for _ in range(30):
            a = rng.integers(0, 1 << 63, size).astype(np.uint64)
            drop, add = rng.integers(0, size // 6 + 1), rng.integers(0, size // 6 + 1)
            b = np.concatenate([a[drop:], rng.integers(0, 1 << 63, add).astype(np.uint64)])
            same = size - drop
            sig, who = partenum.signatures(np.concatenate([a, b]), np.array([len(a), len(b)]), 85)
            if 100 * same >= 85 * (len(a) + len(b) - same) and max(len(a), len(b)) >= partenum.SMALLEST and drop + add:
                assert set(sig[who == 0]) & set(sig[who == 1]), (size, drop, add)


def test_jaccard_odd_rows(spark):
    found = [tuple(r) for r in partenum.jaccard_components(documents(spark)).collect()]
    assert len(found) == 12
    by_id = {r[0]: r for r in found}
    assert by_id[1] == (1, grams_size(0), 0, 0) and by_id[3] == (3, 0, 3, 3) and by_id[7] == (7, 1, 7, 7)
    assert by_id[None][1:] == (2, None, None)
    assert partenum.jaccard_components(empty(spark)).count() == 0


def grams_size(i):
    from data import TEXTS

    return len(grams(TEXTS[i]))


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(5, i) for i in range(200, 230)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert found == {i: 100 for i in range(100, 141)} | {i: 5 for i in range(200, 230)} | {5: 5}


def base_counts(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum((text or "").count(c) for c in line_rules.SYMBOLS)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def folded(text):
    return [tuple(WORD.findall(line.translate(FOLD))) for line in text.split("\n")]


def test_line_rules_counts_and_frequency(spark):
    rng = random.Random(3)
    filler = lambda n: " ".join(rng.choices([f"x{i}" for i in range(5000)], k=n))
    rows = [(i, f"Accept   Cookies now\n{filler(60)}\nacCept cookies NOW \n{filler(5)}", "a") for i in range(30)]
    rows += [(100 + i, f"{filler(60)}\nun été à   côté # $", "b") for i in range(30)]
    rows += [(200 + i, "Accept cookies now\n" + "one two three four five six seven " * 9, "a") for i in range(5)]
    boiler = " ".join(f"b{i}" for i in range(60))
    rows += [(300 + i, f"{boiler}\n{filler(4)}", "a") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    found = {r.doc_id: r for r in line_rules.apply_rules(df, min_docs=10, max_share=0.1).collect()}
    holders = Counter()
    contents = {(host, tuple(f for f in folded(text) if f)) for _, text, host in rows}
    for host, content in contents:
        holders.update((host, line) for line in set(content))
    hosts = Counter(host for host, _ in contents)
    for i, text, host in rows:
        assert tuple(found[i][c] for c in line_rules._COUNTS) == base_counts(text)
        gone = [f for f in folded(text) if holders[host, f] > max(10, 0.1 * hosts[host])]
        assert found[i].n_removed_words == sum(map(len, gone))
    assert found[0].n_removed_words == 6 and found[0].kept
    assert found[100].n_removed_words == 7 and found[100].kept  # a no-break space is a word of its own
    assert found[200].base_failed and not found[200].kept
    assert found[300].depleted and not found[300].kept and not found[300].base_failed


def test_copies_of_one_page_are_one_document(spark):
    page = "\n".join(" ".join(f"p{i}x{j}" for j in range(20)) for i in range(5))
    df = spark.createDataFrame([(i, page, "a") for i in range(40)], "doc_id bigint, text string, source string")
    assert line_rules.apply_rules(df).where("kept").count() == 40


def test_line_rules_odd_rows(spark):
    found = line_rules.apply_rules(documents(spark)).collect()
    assert len(found) == 12 and all(r.kept is not None for r in found)
    assert {r.doc_id for r in found if r.n_words == 0} == {3, 4, 5}
    assert line_rules.apply_rules(empty(spark)).count() == 0


def test_shards_are_contiguous_and_balanced(spark):
    rng = random.Random(4)
    rows = [(i, "copy" if i % 3 == 0 else "é" * rng.randint(0, 300)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    found = sharding.shard_by_bytes(df, ranges=11).collect()
    for r in found:
        text = dict(rows)[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text) + 1, zlib.crc32(text), "bytes", None)
    total = sum(r.size for r in found)
    for s in range(8):
        own = [r for r in found if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / 8) <= 601
    ordered = sorted(found, key=lambda r: (r.shard, r.slot))
    keys = [(r.text_crc32, r.doc_id) for r in ordered]
    assert keys == sorted(keys)


def test_shards_of_odd_rows(spark):
    found = sharding.shard_by_bytes(documents(spark)).collect()
    assert len(found) == 12 and {r.size for r in found if r.doc_id in (3, 4)} == {1}
    assert sharding.shard_by_bytes(empty(spark)).count() == 0


def test_words_of_chunks():
    column = pa.array(["Ab c\x0bd", None, "", " x", " tail "])
    for size in (1, 1 << 20):
        got = [w for c in tx.chunks(column, size) for w in tx.words(c).per_text.tolist()]
        assert got == [3, 0, 0, 1, 1]
    one, two = (tx.words(next(tx.chunks(pa.array([t])))).hash.tolist() for t in ("ab CD ab", "xx cd"))
    assert one[0] == one[2] and one[1] == two[1] and one[0] != one[1]
