"""Card fraud: reconstruction error, enriched training table and scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.scores import at_or_above, fraud_label
from riskframe.operators import boosting, models
from riskframe.operators.curves import best_threshold
from riskframe.operators.ordering import quantile_values
from riskframe.operators.quality import split_valid, transaction_rules
from riskframe.operators.sampling import smote
from riskframe.session import cut_lineage


def valid_transactions(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return split_valid(df, transaction_rules(features))[0]


def with_error(df: DataFrame, model: models.ReconstructionModel) -> DataFrame:
    return df.withColumn("reconstruction_error", model.error())


def anomaly_threshold(scored: DataFrame, error: str, label: str, q: float = 0.95) -> float:
    """Exact quantile of the error over normal rows."""
    return quantile_values(scored.where(F.col(label) == 0), [error], [q])[error][0]


def training_table(
    train: DataFrame,
    id_col: str,
    label: str,
    cols: Sequence[str],
    ratio: float = 0.1,
    seed: int = 42,
) -> DataFrame:
    """Original rows plus synthetic minority rows, with text ids; synthetic rows carry
    ``holdout`` false because the hold-out is drawn from original rows only."""
    from riskframe.operators.sampling import holdout_flag

    own = train.select(
        F.col(id_col).cast("string").alias("row_id"),
        F.col(label).cast("double").alias("label"),
        holdout_flag(id_col, 0.15, seed).alias("holdout"),
        *cols,
    )
    base = train.where((F.col(label) == 0) | ~holdout_flag(id_col, 0.15, seed))
    made = smote(base, id_col, label, cols, ratio=ratio, seed=seed).select(
        F.concat_ws("-", F.col("id").cast("string"), F.col("i").cast("string")).alias("row_id"),
        F.lit(1.0).alias("label"),
        F.lit(False).alias("holdout"),
        *cols,
    )
    return own.unionByName(made)


def fit_classifier(
    train: DataFrame, id_col: str, label: str, cols: Sequence[str], ratio: float = 0.1,
    seed: int = 42, **options,
) -> boosting.Ensemble:
    """Boosted trees on the oversampled, class-weighted table."""
    table = training_table(train, id_col, label, cols, ratio, seed)
    weighted = models.with_class_weight(cut_lineage(table, "smote"), "label")
    stored = models.stable_order(weighted, "row_id", "fraud")
    return boosting.fit(stored, cols, "row_id", boosting.with_options(seed=seed, **options))[0]


def score_transactions(
    df: DataFrame,
    reconstruction: models.ReconstructionModel,
    classifier: boosting.Ensemble,
    threshold: float,
) -> DataFrame:
    """Error, probability, flag and label in one projection."""
    scored = models.score_with(classifier, with_error(df, reconstruction), "fraud_probability")
    return scored.withColumn(
        "is_fraud", at_or_above(F.col("fraud_probability"), threshold).cast("boolean")
    ).withColumn("risk_label", fraud_label(F.col("fraud_probability")))


def chosen_threshold(scored: DataFrame, score: str, label: str) -> float:
    return best_threshold(scored, score, label).first()["threshold"]
