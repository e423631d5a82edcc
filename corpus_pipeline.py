"""Documents to token ids in five stages; every stage works on all rows its predecessor kept.

1. language ID (op 8): fits on labelled languages, drops documents that the model rejects;
2. n-gram Jaccard join (op 9), on sets of five words from a similarity of 0.8 on: of each
   component the document with the smallest id stays;
3. PII (op 6): replaces personal data by keyed pseudonyms;
4. mixing (op 4): fits rates to the target shares of domains and uses each document as many times
   as its rate says; a document that is used more than once occurs as that many rows;
5. BPE (op 3): encodes and decodes every remaining text.

Stages 1 to 4 return the columns of ``documents``. Null ids are of no component and stay; null and
empty texts have no letter and go in stage 1. Each stage starts with what the one before
left in memory and in shuffle files given back; fits do so again before their model is used. Stages are fitted models, a similarity join over
hashes and a tokeniser, which SQL cannot express; tests compare them with brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import bpe_lexicon, langid, mixing, partenum, pii, queries
from riskframe.llm.common import free_finished, held_out, store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

NEAR_WORDS, NEAR_PERCENT = 5, 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    free_finished(spark)
    model = langid.train(docs.where(~held_out()))
    free_finished(spark)
    return langid.keep_identified(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    free_finished(spark)
    found = partenum.jaccard_components(docs, n=NEAR_WORDS, percent=NEAR_PERCENT)
    extra = store(found.where("component_id <> doc_id").select("doc_id").distinct(), "near-copies")
    small = extra.count() <= partenum.BROADCAST_IDS
    kept = docs.join(F.broadcast(extra) if small else extra, "doc_id", "left_anti").select(docs.columns)
    # Rows that share an id are one document; texts are only shuffled for it where there are any.
    ids = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    if ids.where(F.col("rows") > 1).isEmpty():
        return kept
    return kept.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(kept.where("doc_id is null"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    free_finished(spark)
    done = pii.pseudonymise(docs, queries.PII_KEY)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        done = done.withColumn("n_chars", F.char_length("text").cast(kind))
    return done.select(docs.columns)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    free_finished(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = queries.mixing_model(docs, labels)
    free_finished(spark)
    read = docs.withColumn("__mix", mixing.posteriors(model, F.col("text")))
    rows = store(read.select("__mix.*"), "mix")
    mix = mixing.fit(rows, model.domains, queries.MIX_WEIGHTS, queries.MIX_REPEATS, keep=queries.MIX_KEEP)
    free_finished(spark)
    rate = mixing.rate_of(mix, [F.col("__mix.p")[j] for j in range(len(model.domains))])
    uses = F.explode(F.array_repeat(F.lit(0), mixing.copies(rate, "doc_id")))
    return read.select(*docs.columns, uses.alias("__use")).select(docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    free_finished(spark)
    words = queries.vocabulary()
    lexicon = bpe_lexicon.build_lexicon(docs, words)
    free_finished(spark)
    both = bpe_lexicon.encode_and_decode_docs(docs.select("doc_id", "lang", "source", "text"), words, lexicon)
    return both.select("doc_id", "lang", "source", "ids", "decoded")


STAGES: list[tuple[str, Stage]] = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_copies),
    ("PII", replace_personal_data),
    ("mixing sources to target weights", mix_domains),
    ("BPE encoding and decoding", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name.split()[0].lower()}")
    return docs


ORACLE_SQL: str | None = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
