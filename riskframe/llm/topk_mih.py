"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector becomes the code of its signs. Codes are cut into m segments; two codes at Hamming
distance d differ by at most d // m on some segment. The search radius grows: step r probes every
segment at distance exactly r. After it every code at distance up to m * r + m - 1 has been seen,
so a query is done when its k-th verified distance is at most that; only open queries go on.

Equal codes are one entry that carries its number of rows and its k + 1 smallest ids, so a code
shared by a third of all rows is one row; queries with equal codes are one search as well. Each
step is a join of probes and index on (segment, value), and a candidate is verified by the distance
of whole codes; only the k + 1 best ids of each query are kept between steps. Distances and ids
decide the order, so ties are settled the same way everywhere.

Defined results: null vectors, and vectors of another length than the longest, are not indexed and
find nothing. A query does not find its own id; repeated ids count once per code. With fewer than
k others all are returned. Empty tables give empty tables. Only id and vector are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import discard, store

WORD = 32  # bits of a code word


def code_words(vector: Column, bits: int) -> Column:
    """The signs of ``bits`` components as an array of 32-bit words (in longs); 1 is not negative."""

    def word(first: int) -> Column:
        part = F.slice(vector, first + 1, WORD)
        return F.aggregate(part, F.lit(0).cast("bigint"), lambda a, x: a * 2 + F.when(x >= 0, 1).otherwise(0))

    return F.array(*[word(i) for i in range(0, bits, WORD)])


def _segments(bits: int, rows: int) -> int:
    """Segments of 8 bits for few rows and 16 bits for many, near log2(rows)."""
    return bits // (16 if rows >= 1 << 13 else 8)


def segment(code: Column, j: int, width: int) -> Column:
    """Segment ``j`` of a code; words hold whole segments, the first in the highest bits."""
    per_word = WORD // width
    return F.shiftright(code[j // per_word], (per_word - 1 - j % per_word) * width).bitwiseAND((1 << width) - 1)


def distance(a: Column, b: Column, words: int) -> Column:
    return sum(F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(words)).cast("int")


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, neighbor_id, distance): the k nearest other rows by (distance, id)."""
    first = vectors.agg(F.max(F.size(vector_col)).alias("d")).first()
    bits = first.d if first.d and first.d > 0 else 0
    padded = -(-max(bits, 1) // WORD) * WORD  # the bits added are 0 in every code
    words = padded // WORD

    def coded(df: DataFrame) -> DataFrame:
        usable = df.where(F.col(id_col).isNotNull() & (F.size(vector_col) == bits) & ~F.exists(vector_col, F.isnull))
        zeros = F.array_repeat(F.lit(-1.0), padded - bits)
        vector = F.concat(F.transform(vector_col, lambda x: x.cast("double")), zeros)
        return usable.select(F.col(id_col).cast("bigint").alias("id"), code_words(vector, padded).alias("code"))

    # The k + 1 smallest ids of a code: first within 64 shares of its rows, then among those.
    rows = coded(vectors).distinct()
    shares = rows.withColumn("share", F.pmod(F.xxhash64("id"), F.lit(64)))
    for by in (["code", "share"], ["code"]):
        place = F.row_number().over(Window.partitionBy(*by).orderBy("id"))
        shares = shares.withColumn("place", place).where(F.col("place") <= k + 1).drop("place")
    entries = store(shares.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "codes")
    n = entries.count()
    asked = store(coded(queries).distinct(), "queries")
    m = _segments(padded, n)
    width = padded // m

    pieces = F.array(*[segment(F.col("code"), j, width) for j in range(m)])
    index = store(entries.select("code", "ids", F.posexplode(pieces).alias("j", "value")), "index")
    pair = "array<struct<distance:int,id:bigint>>"
    none = F.array().cast(pair)
    state = store(asked.select("code").distinct().withColumn("best", none), "open")
    finished = []
    for r in range(width + 1):
        if state.isEmpty():
            break
        # One constant, however many masks there are.
        masks = ",".join(str(v) for v in range(1 << width) if v.bit_count() == r)
        masks = F.split(F.lit(masks), ",").cast("array<bigint>")
        own = F.array(*[segment(F.col("code"), j, width) for j in range(m)])
        probes = state.select(F.col("code").alias("query"), F.posexplode(own).alias("j", "own"))
        flipped = F.explode(F.transform(masks, lambda v: v.bitwiseXOR(F.col("own"))))
        # Spark's estimate of the probes does not count the masks, so it must not broadcast them.
        met = probes.select("query", "j", flipped.alias("value")).join(index.hint("merge"), ["j", "value"])
        # A pair is taken once, at the first of its segments that are nearest: not where another
        # segment is nearer (an earlier step saw it), nor where an earlier one is as near.
        gaps = F.array(
            *[F.bit_count(segment(F.col("query"), i, width).bitwiseXOR(segment(F.col("code"), i, width))) for i in range(m)]
        )
        met = met.where((F.array_min(gaps) == r) & (F.array_position(gaps, r) == F.col("j") + 1))
        met = met.select("query", distance(F.col("query"), F.col("code"), words).alias("distance"), F.explode("ids").alias("id"))
        lists = _nearest(met, k + 1).groupBy("query").agg(F.collect_list(F.struct("distance", "id")).alias("found"))
        merged = F.slice(F.sort_array(F.concat("best", F.coalesce("found", none))), 1, k + 1)
        covered = m * r + m - 1
        full = F.coalesce(F.try_element_at("best", F.lit(k + 1))["distance"] <= covered, F.lit(False))
        after = state.join(lists, F.col("code") == F.col("query"), "left").select("code", merged.alias("best"))
        after = store(after.withColumn("done", full | F.lit(r == width)), "searched")
        discard(state)
        finished.append(after.where("done").select("code", "best"))
        state = store(after.where("not done").select("code", "best"), "open")
    best = state if not finished else reduce(DataFrame.unionByName, finished)
    found = asked.join(best, "code").select("id", F.explode("best").alias("b")).where("b.id <> id")
    place = F.row_number().over(Window.partitionBy("id").orderBy("b.distance", "b.id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select(
        F.col("id").alias("query_id"), "rank", F.col("b.id").alias("neighbor_id"), F.col("b.distance").alias("distance")
    )


def _nearest(met: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query").orderBy("distance", "id"))
    return met.withColumn("place", place).where(F.col("place") <= k)
