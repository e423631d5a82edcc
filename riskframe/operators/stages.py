"""The fits of this library as stages of a Spark ``Pipeline``.

Every estimator has its columns and options as ``Params``; every model writes its fitted value with its
metadata, so a ``Pipeline`` or ``PipelineModel`` of these stages, mixed with Spark's own, is saved and
loaded like any other. ``options`` holds the keyword arguments of the fit as JSON.

| Domain | Estimator | Adds |
|---|---|---|
| fraud | ``ReconstructionEstimator`` | reconstruction error |
| fraud, credit | ``BoostedEstimator`` | probability |
| credit | ``PlattEstimator`` | calibrated probability |
| retail | ``SegmentEstimator`` | cluster, ordered by value, and squared distance |
| loans | ``CoxEstimator`` | hazard ratio |
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Any

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators import boosting, cox, models, rfm
from riskframe.operators.ordering import quantile_values
from riskframe.session import cut_lineage
from riskframe.sources.model_store import from_plain, to_plain


class _Columns(HasInputCols, HasLabelCol, HasOutputCol):
    idCol = Param(Params._dummy(), "idCol", "column that names a row, unique and not null", typeConverter=TypeConverters.toString)
    durationCol = Param(Params._dummy(), "durationCol", "column of times, for survival models", typeConverter=TypeConverters.toString)
    options = Param(Params._dummy(), "options", "keyword arguments of the fit, as JSON", typeConverter=TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(idCol="id", durationCol="duration", options="{}", outputCol="p")

    def wanted(self) -> dict[str, Any]:
        return json.loads(self.getOrDefault(self.options))


class _Fit(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """An estimator whose fit gives one plain value; ``model_class`` applies it."""

    model_class: type

    @keyword_only
    def __init__(self, *, inputCols=None, labelCol=None, outputCol=None, idCol=None, durationCol=None, options=None):
        super().__init__()
        given = {k: v for k, v in self._input_kwargs.items() if v is not None}
        if isinstance(given.get("options"), dict):
            given["options"] = json.dumps(given["options"])
        self._set(**given)

    def value_of(self, df: DataFrame) -> Any:
        raise NotImplementedError

    def _fit(self, dataset: DataFrame) -> Model:
        return self._copyValues(self.model_class(self.value_of(dataset)))


class _Writer(MLWriter):
    def __init__(self, model: _Fitted):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sc, extraMetadata={"fitted": to_plain(self.model.value)})


class _Reader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> _Fitted:
        metadata = DefaultParamsReader.loadMetadata(path, self.sc)
        model = self.kind(from_plain(metadata["fitted"]))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class _Fitted(Model, _Columns, MLReadable, MLWritable):
    """A fitted value with the columns it was fitted on."""

    def __init__(self, value: Any = None):
        super().__init__()
        self.value = value

    def write(self) -> _Writer:
        return _Writer(self)

    @classmethod
    def read(cls) -> _Reader:
        return _Reader(cls)


class BoostedModel(_Fitted):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), boosting.probability_of(self.value))


class BoostedEstimator(_Fit):
    """Boosted trees; options of ``boosting.Options``."""

    model_class = BoostedModel

    def value_of(self, df: DataFrame) -> boosting.Ensemble:
        return models.fit_gbt(df, self.getInputCols(), self.getOrDefault(self.idCol), self.getLabelCol(), **self.wanted())


class PlattStage(_Fitted):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.value.score(dataset, self.getOutputCol())


class PlattEstimator(_Fit):
    """Boosted trees calibrated over folds; options of ``models.fit_platt``."""

    model_class = PlattStage

    def value_of(self, df: DataFrame) -> models.PlattModel:
        return models.fit_platt(df, self.getInputCols(), self.getOrDefault(self.idCol), self.getLabelCol(), **self.wanted())


class ReconstructionStage(_Fitted):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), self.value.error())


class ReconstructionEstimator(_Fit):
    """Linear reconstruction of rows with label 0 (of all rows without a label column)."""

    model_class = ReconstructionStage

    def value_of(self, df: DataFrame) -> models.ReconstructionModel:
        normal = df.where(F.col(self.getLabelCol()) == 0) if self.isSet(self.labelCol) else df
        return models.fit_reconstruction(cut_lineage(normal.select(*self.getInputCols()), "normal"), self.getInputCols(), **self.wanted())


@dataclass
class Segments:
    """Robust scaling (median and quartile distance per column) and centroids in order of value."""

    cols: list[str]
    centre: list[float]
    spread: list[float]
    centroids: list[list[float]]


class SegmentModel(_Fitted):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        v: Segments = self.value
        raw = {c: f"__{c}" for c in v.cols}
        scaled = {c: (F.col(c) - F.lit(m)) / F.lit(s) for c, m, s in zip(v.cols, v.centre, v.spread)}
        kept = dataset.withColumns({raw[c]: F.col(c) for c in v.cols}).withColumns(scaled)
        placed = rfm.assign_nearest(kept, v.cols, v.centroids)
        back = placed.withColumns({c: F.col(raw[c]) for c in v.cols}).drop(*raw.values())
        return back.withColumnRenamed("cluster_id", self.getOutputCol())


class SegmentEstimator(_Fit):
    """Robust scaling and k-means; options of ``models.fit_kmeans``."""

    model_class = SegmentModel

    def value_of(self, df: DataFrame) -> Segments:
        cols = list(self.getInputCols())
        found = quantile_values(df, cols, [0.25, 0.5, 0.75])
        centre = [found[c][1] for c in cols]
        spread = [(found[c][2] - found[c][0]) or 1.0 for c in cols]
        scaled = df.select(*[((F.col(c) - F.lit(m)) / F.lit(s)).alias(c) for c, m, s in zip(cols, centre, spread)])
        centroids, _ = models.fit_kmeans(scaled, cols, **self.wanted())
        ranked = [centroids[k] for k in rfm.value_order(centroids)] if cols == list(rfm.RFM) else centroids
        return Segments(cols, centre, spread, ranked)


@dataclass
class Hazard:
    """Standardisation and coefficients of a proportional-hazards model, one per column."""

    cols: list[str]
    mean: list[float]
    std: list[float]
    beta: list[float]


class CoxStage(_Fitted):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        v: Hazard = self.value
        terms = [F.lit(b) * (F.col(c) - F.lit(m)) / F.lit(s) for c, m, s, b in zip(v.cols, v.mean, v.std, v.beta)]
        return dataset.withColumn(self.getOutputCol(), F.exp(sum(terms, F.lit(0.0))))


class CoxEstimator(_Fit):
    """Proportional hazards on standardised columns; the label marks events."""

    model_class = CoxStage

    def value_of(self, df: DataFrame) -> Hazard:
        cols = list(self.getInputCols())
        table = cut_lineage(df, "cox")
        stats = table.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)], *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
        mean, std = [float(stats[f"m{i}"]) for i in range(len(cols))], [float(stats[f"s{i}"]) or 1.0 for i in range(len(cols))]
        z = table.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, m, s in zip(cols, mean, std)})
        model = cox.fit_cox(cut_lineage(z, "cox-z"), self.getOrDefault(self.durationCol), self.getLabelCol(), cols, **self.wanted())
        return Hazard(cols, mean, std, [float(b) for b in model.beta])
