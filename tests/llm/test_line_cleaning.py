import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F
from riskframe.llm import line_rules
from test_sets_and_rules import FOLD, WORD


def test_a_repeated_passage_goes_on_small_and_large_hosts_alike(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    for host_docs in (100, 100_000):
        own = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.md5(F.concat_ws("-", "id", i))), " ")
        text = F.when(F.col("id") < 11, F.concat(F.lit(f"{passage}\n"), own)).otherwise(own)
        docs = spark.range(host_docs).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("a").alias("source"))
        found = line_rules.apply_rules(docs).where("n_removed_words > 0").collect()
        assert {(r.doc_id, r.n_removed_words, r.depleted) for r in found} == {(i, 60, True) for i in range(11)}


def test_cleaned_texts_equal_brute_force(spark):
    rng = random.Random(7)
    common = ["Accept   Cookies now", "log IN", "été à côté", "x"]
    rows = []
    for i in range(120):
        lines = [" ".join(rng.choices([f"w{k}" for k in range(4000)], k=rng.randint(1, 30))) for _ in range(4)]
        lines += rng.choices([*common, common[0].upper(), "", "  "], k=4)
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines) + rng.choice(["", "\n"]), rng.choice(["a", "b", None])))
    rows += [(200, "", "a"), (201, None, "a"), (202, "log IN", "a"), (203, "log IN\n", "a"), (204, "\nlog IN", "a")]

    def fold(line):
        return tuple(WORD.findall(line.translate(FOLD)))

    holders = defaultdict(set)
    for _, text, host in rows:
        folded = tuple(f for f in map(fold, (text or "").split("\n")) if f)
        for f in folded:
            holders[host, f].add(folded)
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    found = {r.doc_id: r for r in line_rules.clean_texts(df).collect()}
    digests = {r.doc_id: r.cleaned_sha256 for r in line_rules.apply_rules(df).collect()}
    changed = 0
    for i, text, host in rows:
        want = text and "\n".join(x for x in text.split("\n") if not (fold(x) and len(holders[host, fold(x)]) > 10))
        assert found[i].cleaned == want, i
        left, all_words = len(WORD.findall(want or "")), len(WORD.findall(text or ""))
        assert found[i].n_removed_words == all_words - left
        assert found[i].depleted == (all_words > 0 and left < 0.3 * all_words)
        assert digests[i] == (None if want is None else hashlib.sha256(want.encode()).hexdigest())
        changed += want != text
    assert changed > 50
