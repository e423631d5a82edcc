"""Run log: every metric of every training run as one appended row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.sources.schemas import RUNS


def append_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    ts: datetime,
    pipeline: str,
    metrics: Mapping[str, float],
    step: int | None = None,
) -> None:
    rows = [(run_id, ts, pipeline, m, step, float(v)) for m, v in metrics.items()]
    spark.createDataFrame(rows, RUNS).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(path)


def latest(runs: DataFrame, tie: str = "run_id") -> DataFrame:
    """Last value of each metric per pipeline."""
    return runs.groupBy("pipeline", "metric").agg(
        F.max_by("value", F.struct("ts", tie)).alias("value"), F.max("ts").alias("ts")
    )


def best_step(
    runs: DataFrame, metric: str, by: Sequence[str] = ("run_id",), value: str = "value"
) -> DataFrame:
    """Step of the smallest value of a metric per run, the earliest on ties."""
    return (
        runs.where(F.col("metric") == metric)
        .groupBy(*by)
        .agg(
            F.min_by("step", F.struct(value, "step")).alias("step"),
            F.min(value).alias("value"),
        )
    )
