"""Credit applicants: cleaning, derived features and the score scale."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.scores import (
    clip,
    credit_decision,
    credit_grade,
    credit_score,
    utilization_bucket,
)
from riskframe.operators.impute import (
    clip_columns,
    impute_global_median,
    impute_group_median,
    sentinel_to_null,
)

LATE = ["late_30_59", "late_60_89", "late_90"]

# Bounds after cleaning.
CLIP_RULES = {
    "utilization": (0.0, 1.0),
    "debt_ratio": (0.0, 10.0),
    "monthly_income": (0.0, 50000.0),
    "late_30_59": (0, 10),
    "late_60_89": (0, 10),
    "late_90": (0, 10),
}

FEATURES = [
    "utilization",
    "age",
    "late_30_59",
    "debt_ratio",
    "monthly_income",
    "open_lines",
    "late_90",
    "real_estate",
    "late_60_89",
    "dependents",
    "total_late",
    "debt_to_income",
    "utilization_category",
]


def valid_age(df: DataFrame) -> DataFrame:
    return df.drop("_c0", "Unnamed: 0").where((F.col("age") > 0) & (F.col("age") <= 100))


def with_age_group(df: DataFrame) -> DataFrame:
    return df.withColumn("age_group", (F.floor(F.col("age") / 10) * 10).cast("int"))


def clean_applicants(df: DataFrame) -> DataFrame:
    """Age filter, 98 to null, income by decade median then overall median, dependents
    by median, late counts by 0, fixed bounds. The order is part of the result."""
    known = sentinel_to_null(valid_age(df), LATE, 98)
    income = impute_group_median(with_age_group(known), "monthly_income", "age_group")
    filled = impute_global_median(income, ["dependents"]).na.fill(0, LATE)
    return clip_columns(filled.drop("age_group"), CLIP_RULES)


def credit_features(clean: DataFrame) -> DataFrame:
    return clean.withColumns(
        {
            "total_late": F.col("late_30_59") + F.col("late_60_89") + F.col("late_90"),
            "debt_to_income": clip(
                F.col("debt_ratio") / (F.col("monthly_income") + F.lit(1e-9)), 0.0, 100.0
            ),
            "utilization_category": utilization_bucket(F.col("utilization")),
        }
    )


def score_scale(df: DataFrame, pd_col: str) -> DataFrame:
    """Adds score, grade, decision and the approval flag."""
    return (
        df.withColumn("score", credit_score(F.col(pd_col)))
        .withColumn("risk_grade", credit_grade(F.col("score")))
        .withColumn("recommendation", credit_decision(F.col("score")))
        .withColumn("is_approved", F.col("recommendation") == "APPROVE")
    )
