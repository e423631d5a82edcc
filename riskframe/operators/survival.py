"""Survival analysis on (duration, event) tables.

Everything that needs an order over time or risk is built on ``prefix_sum`` over rows
aggregated per distinct value.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from riskframe.functions.scores import loan_tier
from riskframe.operators.ordering import as_of, prefix_sum
from riskframe.session import cut_lineage, join_checked

# Published coefficients on standardised features; the others are 0.
PUBLISHED_COX = {
    "int_rate": 0.19,
    "grade_encoded": 0.18,
    "inq_last_6mths": 0.06,
    "fico_range_low": -0.08,
    "annual_inc": -0.06,
    "emp_length_years": -0.02,
}


def kaplan_meier(
    df: DataFrame, duration: str, event: str, by: Sequence[str] = (), z: float = 1.96
) -> DataFrame:
    """Per distinct time: deaths, at risk, S(t) and the log-log confidence band."""
    per_time = df.groupBy(*by, F.col(duration).cast("double").alias("t")).agg(
        F.sum(F.col(event).cast("long")).alias("d"), F.count(F.lit(1)).alias("cnt")
    )
    at_risk = prefix_sum(per_time, "t", {"upto": "cnt"}, by).withColumn(
        "at_risk", F.col("upto_total") - F.col("upto") + F.col("cnt")
    )
    n, d = F.col("at_risk").cast("double"), F.col("d").cast("double")
    everyone = F.col("d") == F.col("at_risk")
    terms = at_risk.select(
        *by,
        "t",
        "d",
        "at_risk",
        F.when(everyone, F.lit(0.0)).otherwise(F.ln(1 - d / n)).alias("log_step"),
        F.when(everyone, F.lit(0.0)).otherwise(d / (n * (n - d))).alias("var_step"),
    )
    summed = prefix_sum(terms, "t", {"log_s": "log_step", "var": "var_step"}, by)
    # Everyone at risk dies only at the very last time, where S drops to 0.
    s = F.when(everyone, F.lit(0.0)).otherwise(F.exp("log_s"))
    spread = F.when(
        (F.col("log_s") < 0) & ~everyone, F.lit(z) * F.sqrt("var") / F.col("log_s")
    )
    return summed.select(
        *by,
        "t",
        "d",
        "at_risk",
        s.alias("s"),
        F.coalesce(F.exp(F.col("log_s") * F.exp(-spread)), s).alias("s_low"),
        F.coalesce(F.exp(F.col("log_s") * F.exp(spread)), s).alias("s_high"),
    )


def median_survival(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """First time with S(t) <= 0.5, null when the curve stays above. The margin covers the
    rounding of a product computed as a sum of logarithms."""
    reached = F.col("s") <= 0.5 + 1e-12
    return curve.groupBy(*by).agg(F.min(F.when(reached, F.col("t"))).alias("median_t"))


def interpolate_at(curve: DataFrame, df: DataFrame, at: str, out: str = "s", t: str = "t", s: str = "s") -> DataFrame:
    """Adds ``out``: the curve (a table of times ``t`` and values ``s``) read at column ``at``, linear
    between its steps and constant beyond them."""
    placed = as_of(df, at, curve, t, [s])
    left, right = F.coalesce("before", "after"), F.coalesce("after", "before")
    t0, s0, t1, s1 = left[t], left[s], right[t], right[s]
    inside = s0 + (s1 - s0) * (F.col(at).cast("double") - t0) / (t1 - t0)
    value = F.when(t0 == t1, s0).when(t0 < t1, inside)
    return placed.withColumn(out, value).select(*[c for c in df.columns if c != out], out)


def concordance(df: DataFrame, duration: str, event: str, risk: str) -> DataFrame:
    """C-index as one row: comparable, concordant and tied pairs, and the index.

    A pair is comparable when the shorter time is an event, or times are equal and
    exactly one row is an event (that one counts as shorter). Higher risk should mean
    shorter time; equal risk counts one half.

    Pairs are counted, never formed: two different dense time ranks first differ in
    exactly one highest bit b, so each pair t_i < t_j appears once, in the group
    (b, rank >> (b+1)) with i on side 0 and j on side 1. Inside a group a running count
    over risk answers how many partners each event beats. Equal times form one extra
    group per time.
    """
    cells = cut_lineage(
        df.groupBy(
            F.col(duration).cast("double").alias("t"), F.col(risk).cast("double").alias("risk")
        ).agg(
            F.sum(F.col(event).cast("long")).alias("events"),
            F.count(F.lit(1)).alias("n"),
        ),
        "concordance",
    )
    times = cells.groupBy("t").agg(F.lit(1).alias("one"))
    ranks = prefix_sum(times, "t", {"rank": "one"}).select("t", (F.col("rank") - 1).alias("rank"))
    ranked = join_checked(cells, ranks, ["t"])
    bits = max((times.count() - 1).bit_length(), 1)
    none = F.lit(0).cast("long")

    def bit_of(b: Column) -> Column:
        return F.call_function("shiftright", F.col("rank"), b) % 2

    by_bit = (
        ranked.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(bits - 1))))
        .withColumn("side", bit_of(F.col("b")))
        .select(
            "b",
            F.call_function("shiftright", F.col("rank"), F.col("b") + 1).alias("g"),
            "risk",
            F.when(F.col("side") == 0, F.col("events")).otherwise(none).alias("asking"),
            F.when(F.col("side") == 1, F.col("n")).otherwise(none).alias("partners"),
        )
    )
    same_time = ranked.select(
        F.lit(-1).alias("b"),
        F.col("rank").alias("g"),
        "risk",
        F.col("events").alias("asking"),
        (F.col("n") - F.col("events")).alias("partners"),
    )
    grouped = (
        by_bit.unionByName(same_time)
        .groupBy("b", "g", "risk")
        .agg(F.sum("asking").alias("asking"), F.sum("partners").alias("partners"))
    )
    counted = prefix_sum(grouped, "risk", {"upto": "partners"}, ["b", "g"])
    beaten = F.col("upto") - F.col("partners")
    pairs = counted.agg(
        F.sum(F.col("asking") * F.col("upto_total")).alias("comparable"),
        F.sum(F.col("asking") * beaten).alias("concordant"),
        F.sum(F.col("asking") * F.col("partners")).alias("tied"),
    )
    return pairs.withColumn(
        "c_index",
        F.when(
            F.col("comparable") > 0,
            (F.col("concordant") + F.col("tied") / F.lit(2.0)) / F.col("comparable"),
        ),
    )


def linear_predictor(coefficients: Mapping[str, float]) -> Column:
    """Sum of coefficient times (standardised) column."""
    return sum((F.col(c) * F.lit(float(b)) for c, b in coefficients.items()), F.lit(0.0))


def partial_hazard(df: DataFrame, coefficients: Mapping[str, float]) -> DataFrame:
    """Adds ``hazard_ratio`` = exp(beta . x) for standardised columns."""
    return df.withColumn("hazard_ratio", F.exp(linear_predictor(coefficients)))


def baseline_hazard(
    df: DataFrame, duration: str, event: str, hazard: str = "hazard_ratio"
) -> DataFrame:
    """Breslow estimate per distinct time: at-risk hazard sum, H0(t) and S0(t)."""
    per_time = df.groupBy(F.col(duration).cast("double").alias("t")).agg(
        F.sum(F.col(event).cast("long")).alias("d"), F.sum(hazard).alias("ph")
    )
    at_risk = prefix_sum(per_time, "t", {"risk_sum": "ph"}, descending=True).withColumn(
        "step", F.col("d") / F.col("risk_sum")
    )
    return prefix_sum(at_risk, "t", {"h0": "step"}).select(
        "t", "d", "risk_sum", "h0", F.exp(-F.col("h0")).alias("s0")
    )


def survival_at(near: Row, hazard: Column, at: float) -> Column:
    """S(at|x) = exp(-H0 x hazard), linear between the steps of the curve. The steps next
    to ``at`` are the same for every row, so they are constants."""
    left, right = near[f"l_{at}"], near[f"r_{at}"]
    if left is None and right is None:
        return F.lit(None).cast("double")
    if left is None or right is None or left[0] == right[0]:
        only = left or right
        return F.exp(F.lit(-only[1]) * hazard)
    s0, s1 = F.exp(F.lit(-left[1]) * hazard), F.exp(F.lit(-right[1]) * hazard)
    return s0 + (s1 - s0) * F.lit(float(at) - left[0]) / F.lit(right[0] - left[0])


def score_loans(df: DataFrame, baseline: DataFrame, horizons=(12, 24, 36)) -> DataFrame:
    """S at the horizons, median time, PD at the first horizon and the tier.

    ``df`` holds ``hazard_ratio``; ``baseline`` is the table of :func:`baseline_hazard`, of any size.
    """
    curve = cut_lineage(baseline.select(F.col("t").cast("double").alias("t"), "h0"), "baseline")
    hazard, step = F.col("hazard_ratio"), F.struct("t", "h0")
    # One row: the steps next to each horizon.
    near = curve.agg(
        *[F.max(F.when(F.col("t") <= h, step)).alias(f"l_{h}") for h in horizons],
        *[F.min(F.when(F.col("t") >= h, step)).alias(f"r_{h}") for h in horizons],
    ).first()
    first = min(horizons)
    # S(t|x) <= 1/2 from the first step on where H0 >= ln 2 / hazard. Steps without events
    # repeat H0; only the first of equal values can be the crossing.
    levels = curve.groupBy("h0").agg(F.min("t").alias("step"))
    needed = as_of(df.withColumn("_need", F.lit(math.log(2)) / hazard), "_need", levels, "h0", ["step"])
    return (
        needed.withColumns({f"s_{h}m": survival_at(near, hazard, h) for h in horizons})
        .withColumn("median_months", F.col("after.step"))
        .withColumn(f"pd_{first}m", 1 - F.col(f"s_{first}m"))
        .withColumn("risk_tier", loan_tier(F.col(f"pd_{first}m")))
        .withColumn("is_low_risk", F.col("risk_tier") == "LOW")
        .drop("_need", "before", "after")
    )


def naive_survival_brier(
    df: DataFrame, survival: str, duration: str, event: str, t: float
) -> DataFrame:
    """Mean squared gap to "no default by t"; rows censored before t count as survivors."""
    alive = F.when((F.col(event) == 1) & (F.col(duration) <= t), F.lit(0.0)).otherwise(F.lit(1.0))
    gap = F.col(survival) - alive
    return df.agg(F.avg(gap * gap).alias("brier"))
