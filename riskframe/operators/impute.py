"""Missing values and outliers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.parse import nan_to_null
from riskframe.functions.scores import clip
from riskframe.operators.ordering import exact_quantiles, quantile_values
from riskframe.session import join_checked


def sentinel_to_null(df: DataFrame, cols: Sequence[str], value: float) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit(value)) for c in cols})


def medians(df: DataFrame, cols: Sequence[str]) -> dict[str, Column]:
    """Exact median per column as literals."""
    found = quantile_values(df, cols, [0.5])
    return {c: F.lit(q[0]).cast("double") for c, q in found.items()}


def impute_global_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    m = medians(df, cols)
    return df.withColumns(
        {c: F.coalesce(nan_to_null(F.col(c).cast("double")), m[c]) for c in cols}
    )


def impute_group_median(
    df: DataFrame, col: str, group: str, fallback: bool = True
) -> DataFrame:
    """Median of the row's group; where a whole group is empty, the median of the
    column as imputed so far.

    The group medians are an aggregate joined back, not a window, so a hot group is
    never sorted in one task.
    """
    value = nan_to_null(F.col(col).cast("double"))
    by_group = exact_quantiles(df.select(group, col), [col], [0.5], [group]).select(
        group, F.col("q")[0].alias("_median")
    )
    filled = join_checked(df, by_group, [group], "left").withColumn(
        col, F.coalesce(value, F.col("_median"))
    )
    filled = filled.drop("_median").select(*df.columns)
    if not fallback:
        return filled
    return impute_global_median(filled, [col])


def clip_columns(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: clip(F.col(c), lo, hi) for c, (lo, hi) in bounds.items()})


def winsorize(df: DataFrame, cols: Sequence[str], low: float, high: float) -> DataFrame:
    """Clip each column to its own exact quantiles."""
    found = quantile_values(df, cols, [low, high])
    return clip_columns(df, {c: (lo, hi) for c, (lo, hi) in found.items() if lo is not None})


def keep_up_to_quantile(df: DataFrame, col: str, q: float) -> DataFrame:
    """Rows at or below the column's own exact quantile; missing values drop out (null
    compares to null, NaN is above every number). The plain comparison pushes down."""
    cut = F.lit(quantile_values(df, [col], [q])[col][0]).cast("double")
    return df.where(F.col(col) <= cut)
