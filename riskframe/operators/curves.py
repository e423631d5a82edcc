"""Threshold curves of a binary score and the numbers read off them.

Scores are first aggregated per distinct value; running counts come from
``prefix_sum``, so no task sorts the whole table. ``by`` evaluates many models or
groups in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.operators.ordering import prefix_sum
from riskframe.session import cut_lineage


def score_counts(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score at or above which rows are flagged: tp, n and the totals."""
    counts = df.groupBy(*by, F.col(score).cast("double").alias("threshold")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.count(F.lit(1)).alias("cnt")
    )
    return prefix_sum(
        counts, "threshold", {"tp": "pos", "flagged": "cnt"}, by, descending=True
    )


def _ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))


def pr_curve(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    counts = score_counts(df, score, label, by)
    return counts.select(
        *by,
        "threshold",
        "pos",
        "tp",
        "flagged",
        "tp_total",
        "flagged_total",
        _ratio(F.col("tp"), F.col("flagged")).alias("precision"),
        _ratio(F.col("tp"), F.col("tp_total")).alias("recall"),
    )


def roc_curve(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Every distinct score; collinear points are kept."""
    counts = score_counts(df, score, label, by)
    fp = F.col("flagged") - F.col("tp")
    negatives = F.col("flagged_total") - F.col("tp_total")
    return counts.select(
        *by,
        "threshold",
        _ratio(fp, negatives).alias("fpr"),
        _ratio(F.col("tp"), F.col("tp_total")).alias("tpr"),
    )


def average_precision(
    df: DataFrame, score: str, label: str, by: Sequence[str] = (), curve: DataFrame | None = None
) -> DataFrame:
    """Sum of recall step times precision; ``curve`` is a PR curve computed before."""
    curve = pr_curve(df, score, label, by) if curve is None else curve
    step = _ratio(F.col("pos"), F.col("tp_total"))
    return curve.groupBy(*by).agg(F.sum(step * F.col("precision")).alias("average_precision"))


def roc_auc(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Probability that a positive outranks a negative, ties one half."""
    counts = score_counts(df, score, label, by)
    neg_here = (F.col("cnt") - F.col("pos")).cast("double")
    above = F.col("tp") - F.col("pos") + F.col("pos") / F.lit(2.0)
    pairs = F.max("tp_total").cast("double") * F.max(
        F.col("flagged_total") - F.col("tp_total")
    ).cast("double")
    return counts.groupBy(*by).agg((F.sum(neg_here * above) / pairs).alias("roc_auc"))


def ks_statistic(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    return (
        roc_curve(df, score, label, by)
        .groupBy(*by)
        .agg(F.max(F.col("tpr") - F.col("fpr")).alias("ks"))
    )


def _f1(precision: Column, recall: Column) -> Column:
    return F.lit(2.0) * precision * recall / (precision + recall + F.lit(1e-8))


def best_threshold(
    df: DataFrame, score: str, label: str, by: Sequence[str] = (), curve: DataFrame | None = None
) -> DataFrame:
    """Threshold of the highest F1, the smallest one on ties, with its counts."""
    curve = pr_curve(df, score, label, by) if curve is None else curve
    curve = curve.withColumn("f1", _f1(F.col("precision"), F.col("recall")))
    fields = ["f1", "threshold", "precision", "recall", "tp", "flagged", "tp_total", "flagged_total"]
    best = F.max_by(
        F.struct(*fields), F.struct(F.col("f1"), (-F.col("threshold")).alias("t"))
    ).alias("b")
    return curve.groupBy(*by).agg(best).select(*by, "b.*")


def threshold_gain(df: DataFrame, score: str, label: str, at: float = 0.5) -> DataFrame:
    """F1 at a fixed threshold and at the best one, with the gain."""
    flag = F.col(score) >= at
    fixed = df.agg(
        F.count_if(flag & (F.col(label) == 1)).alias("tp"),
        F.count_if(flag).alias("flagged"),
        F.count_if(F.col(label) == 1).alias("pos"),
    ).select(
        _ratio(F.lit(2) * F.col("tp"), F.col("flagged") + F.col("pos")).alias("f")
    )
    best = best_threshold(df, score, label)
    best_f1 = _ratio(F.lit(2) * F.col("tp"), F.col("flagged") + F.col("tp_total"))
    return best.select(
        fixed.scalar().alias("f1_fixed"), best_f1.alias("f1_best"), F.col("threshold")
    ).withColumn("gain", F.col("f1_best") - F.col("f1_fixed"))


def model_comparison(df: DataFrame, scores: Sequence[str], label: str) -> DataFrame:
    """One row per score column at its own best threshold."""
    long = df.select(
        label,
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("model"), F.col(c).cast("double").alias("score"))
                    for c in scores
                ]
            )
        ),
    )
    curve = cut_lineage(pr_curve(long, "score", label, ["model"]), "curve")
    ap = average_precision(long, "score", label, ["model"], curve)
    best = best_threshold(long, "score", label, ["model"], curve)
    return best.join(ap, "model").select(
        "model",
        "average_precision",
        "recall",
        "precision",
        "f1",
        (F.col("tp_total") - F.col("tp")).alias("fn"),
        (F.col("flagged") - F.col("tp")).alias("fp"),
        "threshold",
    )


def ecdf(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Share of rows at or below each distinct value."""
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).cast("double").alias("value"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    return prefix_sum(counts, "value", {"upto": "cnt"}, by).select(
        *by, "value", (F.col("upto") / F.col("upto_total")).alias("share")
    )


def calibration_curve(df: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    from riskframe.functions.scores import calibration_bin

    return df.groupBy(calibration_bin(F.col(score), bins).alias("bin")).agg(
        F.avg(label).alias("fraction_positive"),
        F.avg(score).alias("mean_predicted"),
        F.count(F.lit(1)).alias("n"),
    )
