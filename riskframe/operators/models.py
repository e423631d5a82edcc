"""Model fits: clusters, projections, boosted trees, baselines and calibration."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.operators import boosting
from riskframe.operators.metrics import with_class_weight
from riskframe.operators.ordering import hash_fraction
from riskframe.operators.sampling import holdout_flag
from riskframe.session import cut_lineage


ROWS_PER_PARTITION = 50_000


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)


# --- clusters and projections -------------------------------------------------------


def fit_kmeans(
    scaled: DataFrame, cols: Sequence[str], k: int = 5, starts: int = 10, seed: int = 42
) -> tuple[list[list[float]], float]:
    """Centroids and cost of the best of several starts. The input is written once."""
    table = cut_lineage(assemble(scaled, cols).select("features"), "kmeans")
    best = None
    for i in range(starts):
        model = KMeans(k=k, seed=seed + i, featuresCol="features").fit(table)
        cost = model.summary.trainingCost
        if best is None or cost < best[1]:
            best = ([[float(v) for v in c] for c in model.clusterCenters()], float(cost))
    return best


def project_2d(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Adds ``x`` and ``y``: the first two principal components, signs fixed so that the
    largest loading is positive."""
    loadings = principal_axes(df if fit_on is None else fit_on, cols, 2)
    axes = [
        sum((F.col(c) * F.lit(float(w)) for c, w in zip(cols, axis)), F.lit(0.0))
        for axis in loadings
    ]
    return df.withColumns({"x": axes[0], "y": axes[1]})


def principal_axes(df: DataFrame, cols: Sequence[str], k: int) -> np.ndarray:
    """k x d matrix of unit loadings."""
    model = PCA(k=k, inputCol="features", outputCol="pc").fit(assemble(df, cols))
    axes = model.pc.toArray().T
    signs = np.sign(axes[np.arange(k), np.abs(axes).argmax(axis=1)])
    return axes * signs[:, None]


@dataclass
class ReconstructionModel:
    """Rank-k linear reconstruction of standardised columns, fitted on normal rows."""

    cols: list[str]
    mean: list[float]
    std: list[float]
    axes: np.ndarray

    def error(self) -> Column:
        """Mean squared reconstruction error, as column arithmetic.

        The axes are orthonormal: |z - WW'z|^2 = |z|^2 - |W'z|^2.
        """
        z = [
            (F.col(c) - F.lit(m)) / F.lit(s) for c, m, s in zip(self.cols, self.mean, self.std)
        ]
        total = sum((v * v for v in z), F.lit(0.0))
        for axis in self.axes:
            p = sum((v * F.lit(float(w)) for v, w in zip(z, axis)), F.lit(0.0))
            total = total - p * p
        return F.greatest(total / len(self.cols), F.lit(0.0))


def fit_reconstruction(normal: DataFrame, cols: Sequence[str], k: int = 8) -> ReconstructionModel:
    cols = list(cols)
    stats = normal.agg(
        *[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]
    ).first()
    mean = [float(stats[f"m_{c}"]) for c in cols]
    std = [float(stats[f"s_{c}"]) or 1.0 for c in cols]
    z = normal.select(*[((F.col(c) - F.lit(m)) / F.lit(s)).alias(c) for c, m, s in zip(cols, mean, std)])
    return ReconstructionModel(cols, mean, std, principal_axes(z, cols, k))


# --- boosted trees ------------------------------------------------------------------


def stable_order(df: DataFrame, id_col: str, name: str) -> DataFrame:
    """A written table whose partitions do not depend on the input's layout: MLlib's
    row sampling and the order of sums depend on it. Partitions grow with the rows; small tables take
    few, because every tree level is a job over all of them."""
    wanted = -(-max(df.count(), 1) // ROWS_PER_PARTITION)
    return cut_lineage(df.repartition(wanted, id_col).sortWithinPartitions(id_col), name)


def fit_gbt(
    train: DataFrame, cols: Sequence[str], id_col: str, label: str, seed: int = 42, **options
) -> boosting.Ensemble:
    """Weighted boosted trees with a hashed hold-out for early stopping."""
    flagged = train.withColumn("holdout", holdout_flag(id_col, 0.15, seed))
    table = stable_order(
        with_class_weight(flagged, label).withColumn("label", F.col(label).cast("double")),
        id_col,
        "gbt",
    )
    return boosting.fit(table, cols, id_col, boosting.with_options(seed=seed, **options))[0]


def positive_probability(name: str = "probability") -> Column:
    return vector_to_array(name)[1]


def score_with(model: PipelineModel | boosting.Ensemble, df: DataFrame, name: str = "p") -> DataFrame:
    """Adds the positive-class probability and drops MLlib's working columns."""
    if isinstance(model, boosting.Ensemble):
        return df.withColumn(name, boosting.probability_of(model))
    return (
        model.transform(df)
        .withColumn(name, positive_probability())
        .drop("features", "rawPrediction", "probability", "prediction")
    )


def feature_importance(model: boosting.Ensemble, spark: SparkSession) -> DataFrame:
    """Share of all gain per feature, ranked (one row per feature)."""
    rows = [(c, float(v)) for c, v in zip(model.cols, model.importance())]
    table = spark.createDataFrame(rows, "feature string, importance double")
    rank = F.row_number().over(
        Window.partitionBy(F.lit(0)).orderBy(F.col("importance").desc(), "feature")
    )
    return table.withColumn("rank", rank)


def fit_baselines(
    train: DataFrame,
    cols: Sequence[str],
    id_col: str,
    label: str,
    seed: int = 42,
    forest_trees: int = 200,
    gbt_trees: int = 300,
) -> dict[str, PipelineModel | boosting.Ensemble]:
    """Balanced logistic regression, balanced forest and boosted trees on one table."""
    table = stable_order(
        with_class_weight(train, label).withColumn("label", F.col(label).cast("double")),
        id_col,
        "baselines",
    )
    common = dict(featuresCol="features", labelCol="label", weightCol="weight")
    estimators = {
        "logistic": LogisticRegression(maxIter=100, **common),
        "forest": RandomForestClassifier(numTrees=forest_trees, seed=seed, **common),
    }
    assembler = VectorAssembler(inputCols=list(cols), outputCol="features")
    fitted = {name: Pipeline(stages=[assembler, e]).fit(table) for name, e in estimators.items()}
    whole = boosting.with_options(trees=gbt_trees, seed=seed, row_share=1.0, column_share=1.0, patience=None)
    return fitted | {"boosted": boosting.fit(table, cols, id_col, whole)[0]}


# --- calibration --------------------------------------------------------------------


@dataclass
class PlattModel:
    """Per fold: a boosted model and the slope and intercept on its margin."""

    folds: list[tuple[boosting.Ensemble, float, float]]

    def score(self, df: DataFrame, name: str = "pd") -> DataFrame:
        """Adds the mean calibrated probability over the folds."""
        mean = sum((self.fold_score(i) for i in range(len(self.folds))), F.lit(0.0)) / len(self.folds)
        return df.withColumn(name, mean)

    def fold_score(self, i: int) -> Column:
        model, slope, intercept = self.folds[i]
        return 1 / (1 + F.exp(-(boosting.margin_of(model) * F.lit(slope) + F.lit(intercept))))


def fit_platt(
    df: DataFrame,
    cols: Sequence[str],
    id_col: str,
    label: str,
    folds: int = 5,
    seed: int = 42,
    **options,
) -> PlattModel:
    """Each fold's model is fitted on the other folds and calibrated on its own rows; the models of all
    folds grow in the same passes."""
    table = stable_order(
        df.select(id_col, *cols, F.col(label).cast("double").alias("label"))
        .withColumn("fold", (hash_fraction(id_col, seed) % folds).cast("int"))
        .withColumn("holdout", holdout_flag(id_col, 0.15, seed + 1)),
        id_col,
        "platt",
    )
    models = boosting.fit(table, cols, id_col, boosting.with_options(seed=seed, **options), folds)
    own = cut_lineage(table.select("fold", "label", boosting.margin_of_fold(models, "fold").alias("m")), "margins")

    def calibrated(k: int) -> tuple[boosting.Ensemble, float, float]:
        margins = own.where(F.col("fold") == k).select("label", array_to_vector(F.array("m")).alias("v"))
        lr = LogisticRegression(featuresCol="v", labelCol="label", maxIter=50).fit(margins)
        return models[k], float(lr.coefficients[0]), float(lr.intercept)

    # Some dozens of short jobs each, which leave most cores idle one after the other.
    with ThreadPoolExecutor(folds) as pool:
        return PlattModel(list(pool.map(calibrated, range(folds))))
