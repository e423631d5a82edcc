import corpus_pipeline
from data import documents, empty
from test_sets_and_rules import brute_components

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    for (name, stage), number in zip(corpus_pipeline.STAGES, (8, 9, 6, 4, 3), strict=True):
        before, docs = docs, stage(spark, docs, SF).cache()
        if number != 3:
            assert docs.columns == before.columns, name
        if number == 8:
            lettered = [r for r in rows if r.text and any(c.isalpha() for c in r.text)]
            assert 0.97 * len(lettered) <= docs.count() <= len(lettered)
        if number == 9:
            found = brute_components([(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()], 80, 5)
            assert {r.doc_id for r in docs.select("doc_id").collect()} == {root for _, root in found.values()}
        if number == 6:
            assert docs.count() == before.count() and docs.exceptAll(before).count() > 0
    assert docs.columns == ["doc_id", "lang", "source", "ids", "decoded"] and docs.count() > 0


def test_stages_survive_odd_and_empty_tables(spark):
    for make in (documents, empty):
        docs = make(spark)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF).cache()
        assert docs.where("doc_id in (3, 4, 5, 6)").count() == 0


def test_repeated_rows_of_a_document_stay_once(spark):
    docs = documents(spark)
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF)
    assert kept.where("doc_id = 0").count() == 1 and kept.where("doc_id = 1").count() == 0
    assert kept.where("doc_id is null").count() == 1 and kept.columns == docs.columns


def test_run_applies_all_stages(spark):
    found = corpus_pipeline.run(spark, SF)
    assert found.count() > 0 and found.where("size(ids) = 0").count() == 0
