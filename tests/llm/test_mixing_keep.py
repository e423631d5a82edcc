import random

import corpus_pipeline
import pytest


@pytest.mark.parametrize("rare", [0, 1, 6])
def test_every_clean_document_survives_a_corpus_with_few_toxic_rows(spark, tmp_path, rare):
    rng = random.Random(rare)
    words = {d: [f"{d}{i}" for i in range(300)] for d in ("good", "low", "toxic")}
    shared = [f"any{i}" for i in range(100)]
    rows, labels = [], []
    for i in range(600):
        domain = "toxic" if i < rare else "low" if i < 2 * rare else "good"
        text = " ".join(rng.choices(words[domain], k=30) + rng.choices(shared, k=30))
        rows.append((i, text, domain))
        labels.append((i, int(domain != "low"), int(domain == "toxic")))
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, domain string")
    mixed = corpus_pipeline.mix_domains(spark, docs, str(tmp_path))
    counts = {(r.doc_id, r.domain): r["count"] for r in mixed.groupBy("doc_id", "domain").count().collect()}
    assert {i for i, d in counts if d == "good"} == set(range(2 * rare, 600))
    assert all(n == 1 for (_, d), n in counts.items() if d != "good")
