"""Evaluation and description tables that need only mergeable aggregates (and exact
quantiles where a quantile is asked for)."""

from __future__ import annotations

from collections.abc import Sequence


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.parse import nan_to_null
from riskframe.functions.scores import age_band, histogram_bin, outcome
from riskframe.operators.ordering import exact_quantiles
from riskframe.session import join_checked


def _long(wide: DataFrame, name: str, entries: Sequence[tuple[str, list[Column]]], keep=()) -> DataFrame:
    """A wide one-row-per-group table to one row per entry, without a shuffle."""
    rows = [F.struct(F.lit(label).alias(name), *cols) for label, cols in entries]
    return wide.select(*keep, F.inline(F.array(*rows)))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    # One row per class from here on.
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return counts.withColumn("share", F.col("n") / total)


def imbalance(df: DataFrame, label: str) -> DataFrame:
    pos, neg = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    return df.agg(
        pos.alias("n_pos"),
        neg.alias("n_neg"),
        F.avg(label).alias("positive_rate"),
        (neg / pos).alias("neg_pos_ratio"),
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (classes * n_c), and neg/pos for the positive class."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    all_classes = Window.partitionBy(F.lit(0))
    total, classes = F.sum("n").over(all_classes), F.count(F.lit(1)).over(all_classes)
    negatives = F.sum(F.when(F.col("label") == 0, F.col("n"))).over(all_classes)
    return counts.select(
        "label",
        "n",
        (total / (classes * F.col("n"))).alias("balanced_weight"),
        F.when(F.col("label") == 1, negatives / F.col("n")).otherwise(F.lit(1.0)).alias("pos_weight"),
    )


def with_class_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Balanced weight per row for a 0/1 label."""
    n, pos = df.agg(F.count(F.lit(1)), F.count_if(F.col(label) == 1)).first()
    own = F.when(F.col(label) == 1, F.lit(pos)).otherwise(F.lit(n - pos))
    return df.withColumn(name, F.lit(n) / (2 * own))


def fairness_by_band(
    df: DataFrame, score: str, label: str, age: str = "age", threshold: float = 0.35
) -> DataFrame:
    """Approval rate (score below threshold), default rate and size per age band."""
    flag = (F.col(score) >= threshold).cast("int")
    return (
        df.withColumn("age_band", age_band(F.col(age)))
        .where(F.col("age_band").isNotNull())
        .groupBy("age_band")
        .agg(
            (1 - F.avg(flag)).alias("approval_rate"),
            F.avg(label).alias("default_rate"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def describe(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """count, mean, std, min, quartiles and max, one row per (by, column)."""
    cols, by = list(cols), list(by)
    clean = df.select(*by, *[nan_to_null(F.col(c).cast("double")).alias(c) for c in cols])
    wide = clean.groupBy(*by).agg(
        *[
            F.struct(
                F.count(c).alias("n"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).alias("min"),
                F.max(c).alias("max"),
            ).alias(c)
            for c in cols
        ]
    )
    moments = _long(wide, "series", [(c, [F.col(c).alias("m")]) for c in cols], by)
    q = exact_quantiles(clean, cols, [0.25, 0.5, 0.75], by).drop("n")
    return moments.join(q, [*by, "series"], "left").select(
        *by,
        "series",
        "m.n",
        "m.mean",
        "m.std",
        "m.min",
        F.col("q")[0].alias("q25"),
        F.col("q")[1].alias("q50"),
        F.col("q")[2].alias("q75"),
        "m.max",
    )


def mean_differences(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """|mean of class 1 - mean of class 0| per column, ranked."""
    means = df.agg(
        *[
            F.struct(
                F.avg(F.when(F.col(label) == 1, F.col(c))).alias("m1"),
                F.avg(F.when(F.col(label) == 0, F.col(c))).alias("m0"),
            ).alias(c)
            for c in cols
        ]
    )
    table = _long(means, "feature", [(c, [F.col(c).alias("m")]) for c in cols])
    rank = F.row_number().over(
        Window.partitionBy(F.lit(0)).orderBy(F.col("abs_diff").desc(), "feature")
    )
    return table.select(
        "feature", F.abs(F.col("m.m1") - F.col("m.m0")).alias("abs_diff")
    ).withColumn("rank", rank)


def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Lower triangle of the Pearson matrix, one row per pair, over the rows in which both are known.

    Tasks add up four matrices of their rows, shifted by rough means: products, and under the mask of
    known values counts, sums and squares of one column where the other is known. A matrix is one row
    per pair, so what is summed over tasks stays small.
    """
    cols = list(cols)
    data = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    rough = data.agg(*[F.avg(nan_to_null(F.col(c))).alias(c) for c in cols]).first()
    shift = np.array([m or 0.0 for m in rough], float)
    k = len(cols)

    def products(batches):
        total = np.zeros((4, k, k))
        for batch in batches:
            x = batch.to_numpy(dtype=float) - shift
            known = ~np.isnan(x)
            x[~known] = 0.0
            known = known.astype(float)
            total += np.stack([x.T @ x, known.T @ known, x.T @ known, (x * x).T @ known])
        i, j = np.divmod(np.arange(k * k), k)
        yield pd.DataFrame({"i": i, "j": j, **{c: m.ravel() for c, m in zip("pnsq", total)}})

    parts = data.mapInPandas(products, "i int, j int, p double, n double, s double, q double")
    sums = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in "pnsq"])
    p, n, s, q = np.zeros((4, k, k))
    # One row per pair of columns.
    for r in sums.collect():
        p[r.i, r.j], n[r.i, r.j], s[r.i, r.j], q[r.i, r.j] = r.p, r.n, r.s, r.q
    n = np.maximum(n, 1)
    centred = p - s * s.T / n
    squares = np.maximum(q - s * s / n, 0.0)
    scale = np.sqrt(squares * squares.T)
    rows = [(cols[i], cols[j], float(centred[i, j] / scale[i, j]) if scale[i, j] else None) for i in range(k) for j in range(i)]
    return df.sparkSession.createDataFrame(rows, "a string, b string, corr double")


def label_summary(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def density_histogram(
    df: DataFrame, value: str, low: float, high: float, bins: int, by: Sequence[str] = ()
) -> DataFrame:
    """Counts and densities over uniform bins, empty bins included; rows outside the
    range count nowhere."""
    by = list(by)
    counts = (
        df.withColumn("bin", histogram_bin(F.col(value), low, high, bins))
        .where(F.col("bin").isNotNull())
        .groupBy(*by, "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # One row per group: the counts of all its bins as a map of at most `bins` entries.
    groups = counts.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("filled"),
        F.sum("n").alias("total"),
    )
    width = (high - low) / bins
    return groups.select(
        *by, "filled", "total", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    ).select(
        *by,
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("left_edge"),
        F.coalesce(F.try_element_at("filled", F.col("bin")), F.lit(0)).alias("n"),
        (
            F.coalesce(F.try_element_at("filled", F.col("bin")), F.lit(0))
            / (F.col("total") * F.lit(width))
        ).alias("density"),
    )


def box_stats(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Quartiles, whiskers (last values within 1.5 IQR) and the number of outliers."""
    by = list(by)
    q = exact_quantiles(df, [value], [0.25, 0.5, 0.75], by).select(
        *by,
        F.col("q")[0].alias("q25"),
        F.col("q")[1].alias("q50"),
        F.col("q")[2].alias("q75"),
    )
    fence = F.lit(1.5) * (F.col("q75") - F.col("q25"))
    rows = df.select(*by, nan_to_null(F.col(value).cast("double")).alias("x"))
    if by:
        rows = join_checked(rows, q, by)
    else:
        rows = rows.withColumns({c: F.lit(v) for c, v in q.first().asDict().items()})
    inside = (F.col("x") >= F.col("q25") - fence) & (F.col("x") <= F.col("q75") + fence)
    return rows.groupBy(*by, "q25", "q50", "q75").agg(
        F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )


def _cells(df: DataFrame, label: str, flag: str) -> DataFrame:
    kind = outcome(F.col(label), F.col(flag))
    return df.agg(*[F.count_if(kind == k).alias(k.lower()) for k in ("TP", "FP", "FN", "TN")])


def confusion_matrix(df: DataFrame, label: str, flag: str) -> DataFrame:
    """All four cells, empty ones included."""
    rows = [
        F.struct(
            F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(k).alias("n")
        )
        for a, p, k in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
    ]
    return (
        _cells(df, label, flag)
        .select(F.inline(F.array(*rows)))
        .withColumn("log_n", F.log1p(F.col("n").cast("double")))
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def classification_report(df: DataFrame, label: str, flag: str) -> DataFrame:
    """Precision, recall, F1 and support per class with the usual averages."""
    c = _cells(df, label, flag)
    tp, fp, fn, tn = (F.col(k).cast("double") for k in ("tp", "fp", "fn", "tn"))

    def scores(hit, wrong, missed):
        return F.struct(
            _ratio(hit, hit + wrong).alias("precision"),
            _ratio(hit, hit + missed).alias("recall"),
            _ratio(2 * hit, 2 * hit + wrong + missed).alias("f1"),
            (hit + missed).alias("support"),
        )

    both = c.select(
        scores(tn, fn, fp).alias("c0"),
        scores(tp, fp, fn).alias("c1"),
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
    )
    n = F.col("c0.support") + F.col("c1.support")

    def average(metric: str, weighted: bool) -> Column:
        a, b = F.col(f"c0.{metric}"), F.col(f"c1.{metric}")
        if not weighted:
            return (a + b) / 2
        return _ratio(a * F.col("c0.support") + b * F.col("c1.support"), n)

    def row(name, p, r, f, support):
        return F.struct(
            F.lit(name).alias("class"),
            p.alias("precision"),
            r.alias("recall"),
            f.alias("f1"),
            support.cast("long").alias("support"),
        )

    null = F.lit(None).cast("double")
    rows = [
        row(k, *(F.col(f"c{k}.{m}") for m in ("precision", "recall", "f1", "support")))
        for k in ("0", "1")
    ]
    rows.append(row("accuracy", null, null, F.col("accuracy"), n))
    for name, weighted in (("macro avg", False), ("weighted avg", True)):
        rows.append(row(name, *(average(m, weighted) for m in ("precision", "recall", "f1")), n))
    return both.select(F.inline(F.array(*rows)))


def brier_score(df: DataFrame, score: str, label: str) -> DataFrame:
    gap = F.col(score) - F.col(label)
    return df.agg(F.avg(gap * gap).alias("brier"))


def outcome_profile(df: DataFrame, label: str, flag: str, values: Sequence[str]) -> DataFrame:
    """Size, mean and population deviation of each value per TP/FP/FN/TN."""
    kind = outcome(F.col(label), F.col(flag)).alias("outcome")
    return df.groupBy(kind).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(v).alias(f"{v}_mean") for v in values],
        *[F.stddev_pop(v).alias(f"{v}_std") for v in values],
    )


def centroid_distance(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """Root mean square distance of standardised rows to the class-0 centroid."""
    from riskframe.operators.rfm import standardize

    scaled = standardize(df, cols)
    centre = (
        scaled.where(F.col(label) == 0)
        .agg(*[F.avg(c).alias(c) for c in cols])
        .first()
    )
    gaps = [F.col(c) - F.lit(centre[c]) for c in cols]
    squares = sum((g * g for g in gaps), F.lit(0.0))
    per_class = (
        scaled.withColumn("distance", F.sqrt(squares / len(cols)))
        .groupBy(F.col(label).alias("label"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("distance").alias("mean_distance"),
            F.stddev_pop("distance").alias("std_distance"),
        )
    )
    base = F.max(F.when(F.col("label") == 0, F.col("mean_distance"))).over(
        Window.partitionBy(F.lit(0))
    )
    return per_class.withColumn("ratio", F.col("mean_distance") / base)


def error_cost(
    df: DataFrame, label: str, flag: str, cost_fn: float = 100.0, cost_fp: float = 5.0
) -> DataFrame:
    """Cost of misses and false alarms against flagging nothing."""
    return (
        _cells(df, label, flag)
        .select(
            "fn",
            "fp",
            (F.col("fn") * F.lit(cost_fn) + F.col("fp") * F.lit(cost_fp)).alias("cost"),
            ((F.col("tp") + F.col("fn")) * F.lit(cost_fn)).alias("cost_without_model"),
        )
        .withColumn("saving", F.col("cost_without_model") - F.col("cost"))
        .withColumn(
            "saving_pct",
            F.when(
                F.col("cost_without_model") != 0,
                F.col("saving") / F.col("cost_without_model") * 100,
            ),
        )
    )
