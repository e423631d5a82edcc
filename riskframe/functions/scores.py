"""Column functions for business scales, flags and bins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the business rules.
CREDIT_GRADES = [(800, "A"), (650, "B"), (500, "C"), (350, "D")]
CREDIT_DECISIONS = [(650, "APPROVE"), (400, "REVIEW")]
LOAN_TIERS = [(0.05, "LOW"), (0.15, "MEDIUM"), (0.30, "HIGH")]
FRAUD_LABELS = [(0.90, "HIGH"), (0.50, "MEDIUM")]
AGE_BANDS = [
    (18, 30, "18-30"),
    (30, 40, "31-40"),
    (40, 50, "41-50"),
    (50, 60, "51-60"),
    (60, 70, "61-70"),
    (70, 100, "71+"),
]
HIGH_VALUE_SEGMENTS = ["Champions", "Loyal Customers"]


def clip(c: Column, low: float, high: float) -> Column:
    """Bound to [low, high]; null stays null."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def _ladder(value: Column, steps, at_least: bool, otherwise: str) -> Column:
    out = None
    for bound, label in steps:
        hit = (value >= bound) if at_least else (value < bound)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(F.when(value.isNotNull(), otherwise))


def credit_score(pd: Column) -> Column:
    """Probability of default to 0..1000, truncated."""
    return F.floor(clip((F.lit(1.0) - pd) * 1000, 0.0, 1000.0)).cast("int")


def credit_grade(score: Column) -> Column:
    return _ladder(score, CREDIT_GRADES, True, "E")


def credit_decision(score: Column) -> Column:
    return _ladder(score, CREDIT_DECISIONS, True, "DENY")


def loan_tier(pd_12m: Column) -> Column:
    return _ladder(pd_12m, LOAN_TIERS, False, "VERY_HIGH")


def fraud_label(probability: Column) -> Column:
    return _ladder(probability, FRAUD_LABELS, True, "LOW")


def utilization_bucket(utilization: Column) -> Column:
    return F.floor(clip(utilization * 5, 0.0, 4.0)).cast("int")


def age_band(age: Column) -> Column:
    """Right-closed bands; ages outside every band (18 included) give null."""
    out = None
    for low, high, label in AGE_BANDS:
        hit = (age > low) & (age <= high)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out


def at_or_above(score: Column, threshold: Column | float) -> Column:
    return (score >= threshold).cast("int")


def outcome(label: Column, flag: Column) -> Column:
    """TP, FP, FN or TN from two 0/1 columns."""
    return (
        F.when((label == 1) & (flag == 1), "TP")
        .when((label == 0) & (flag == 1), "FP")
        .when((label == 1) & (flag == 0), "FN")
        .when((label == 0) & (flag == 0), "TN")
    )


def calibration_bin(p: Column, bins: int) -> Column:
    """0-based uniform bin over [0, 1], right-closed; 0 belongs to the first."""
    return (F.greatest(F.ceil(p * bins), F.lit(1)) - 1).cast("int")


def histogram_bin(x: Column, low: float, high: float, bins: int) -> Column:
    """0-based left-closed bin, the last one closed; null outside [low, high]."""
    width = (high - low) / bins
    index = F.least(F.floor((x - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
    return F.when((x >= low) & (x <= high), index.cast("int"))
