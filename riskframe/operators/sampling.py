"""Seeded splits, samples and minority oversampling.

Every random choice comes from md5 of ids, so results depend neither on row order nor
on the number of partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.operators.ordering import (
    hash_cutoff,
    hash_cutoff_value,
    hash_fraction,
    row_hash,
)
from riskframe.operators.tiles import nearest_neighbours
from riskframe.session import cut_lineage, join_checked


def stratified_split(
    df: DataFrame, id_col: str, label: str, test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Adds ``split`` ('train'/'test'); each class gives exactly round(share * n) test rows."""
    cut = hash_cutoff(df, id_col, seed, F.round(F.col("n") * F.lit(test_share)), [label])
    in_test = F.coalesce(row_hash(id_col, seed) <= F.col("cutoff"), F.lit(False))
    return (
        join_checked(df, cut, [label], "left")
        .withColumn("split", F.when(in_test, "test").otherwise("train"))
        .drop("cutoff")
        .select(*df.columns, "split")
    )


def hash_split(df: DataFrame, id_col: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """The same with approximate sizes and no shuffle."""
    in_test = hash_fraction(id_col, seed) < int(round(test_share * 10000))
    return df.withColumn("split", F.when(in_test, "test").otherwise("train"))


def sample_rows(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all rows when there are fewer), uniform without replacement."""
    cut = hash_cutoff_value(df, id_col, seed, F.least(F.col("n"), F.lit(n)))
    return df.where(row_hash(id_col, seed) <= cut)


def holdout_flag(id_col: str, share: float = 0.15, seed: int = 42) -> Column:
    """True for the rows held out for early stopping."""
    return hash_fraction(id_col, seed) < int(round(share * 10000))


def synthetic_total(n_majority: int, n_minority: int, ratio: float) -> int:
    """Rows to add so that minority : majority reaches ``ratio``; never negative."""
    return max(int(n_majority * ratio - n_minority), 0)


def smote(
    df: DataFrame,
    id_col: str,
    label: str,
    cols: Sequence[str],
    ratio: float = 0.1,
    k: int = 5,
    seed: int = 42,
    rows_per_tile: int = 2048,
) -> DataFrame:
    """Synthetic minority rows: ``id`` of the base row, ``i`` its running number,
    ``neighbour`` and the interpolated ``cols``.

    Base rows share the wanted total evenly (the remainder goes to the lowest hashes);
    neighbour and position on the line come from md5 of (id, i).
    """
    cols = list(cols)
    minority = cut_lineage(df.where(F.col(label) == 1).select(F.col(id_col).alias("id"), *cols), "minority")
    n_maj, n_min = df.agg(
        F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)
    ).first()
    each, rest = divmod(synthetic_total(n_maj, n_min, ratio), max(n_min, 1))
    extra = hash_cutoff_value(minority, "id", seed, F.lit(rest))
    share = F.lit(each) + (row_hash("id", seed) <= extra).cast("int")
    # Two steps, so that a few base rows with huge shares still spread over tasks.
    step = 10000
    slots = (
        minority.select("id", share.cast("long").alias("_share"))
        .where("_share > 0")
        .select("id", "_share", F.explode(F.expr(f"sequence(0L, (_share - 1) div {step})")).alias("_c"))
        .repartition("id", "_c")
        .select(
            "id",
            F.explode(
                F.expr(f"sequence(_c * {step} + 1, least((_c + 1) * {step}, _share))")
            ).alias("i"),
        )
    )
    near = nearest_neighbours(minority, "id", cols, k, rows_per_tile)
    near = cut_lineage(near.select("id", "rank", "neighbour"), "neighbours")
    found = near.groupBy("id").agg(F.max("rank").alias("_k"))
    pick_hash = F.md5(
        F.concat_ws(":", F.col("id").cast("string"), F.col("i").cast("string"), F.lit(str(seed)))
    )

    def digits(start: int) -> Column:
        return F.conv(F.substring("_m", start, 8), 16, 10).cast("long")

    chosen = (
        join_checked(slots, found, ["id"])
        .withColumn("_m", pick_hash)
        .select(
            "id",
            "i",
            (digits(1) % F.col("_k") + 1).cast("int").alias("rank"),
            (digits(9) / F.lit(4294967296.0)).alias("_u"),
        )
    )
    chosen = join_checked(chosen, near, ["id", "rank"])
    base = minority.select("id", F.struct(*cols).alias("_x"))
    other = minority.select(F.col("id").alias("neighbour"), F.struct(*cols).alias("_y"))
    # A few base rows may have huge shares: small sides are broadcast, else Spark splits hot ids.
    return (
        join_checked(join_checked(chosen, base, ["id"]), other, ["neighbour"])
        .select(
            "id",
            "i",
            "neighbour",
            *[
                (F.col("_x")[c] + F.col("_u") * (F.col("_y")[c] - F.col("_x")[c])).alias(c)
                for c in cols
            ],
        )
    )


def oversample(
    df: DataFrame, id_col: str, label: str, cols: Sequence[str], **options
) -> DataFrame:
    """Original rows plus synthetic minority rows: ``synthetic``, ``label``, ``cols``."""
    made = smote(df, id_col, label, cols, **options)
    return df.select(label, *cols, F.lit(False).alias("synthetic")).unionByName(
        made.select(F.lit(1).cast(df.schema[label].dataType).alias(label), *cols,
                    F.lit(True).alias("synthetic"))
    )
