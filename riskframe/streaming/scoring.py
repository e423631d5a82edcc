"""Scoring and summaries on streams. The same column functions as in batch, so a finished
stream equals the batch result."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.scores import at_or_above, fraud_label
from riskframe.operators.quality import split_valid, with_violations
from riskframe.session import scratch_path


def read_stream(spark: SparkSession, glob: str, schema: T.StructType, **options) -> DataFrame:
    """Parquet files as they arrive."""
    reader = spark.readStream.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.parquet(glob)


def score_stream(
    df: DataFrame, rules: Mapping[str, Column], score: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Valid rows through a stateless scoring projection."""
    valid, _ = split_valid(df, rules)
    return score(valid)


def split_stream(
    df: DataFrame, rules: Mapping[str, Column], score: Callable[[DataFrame], DataFrame], name: str
) -> tuple[DataFrame, DataFrame]:
    """Drain a stream into two tables: scored valid rows, and rejected rows with ``violations``.

    Each micro-batch is checked once and written to both sinks, so no row is lost.
    """
    spark = df.sparkSession
    valid, rejected = scratch_path(spark, name), scratch_path(spark, f"{name}-rejected")

    def checked(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        marked = with_violations(rows, rules)
        return score(marked.where(F.size("violations") == 0).drop("violations")), marked.where(F.size("violations") > 0)

    def write(rows: DataFrame, batch: int) -> None:
        kept, lost = checked(rows)
        # One folder per batch, overwritten when a batch is repeated after a failure.
        kept.write.mode("overwrite").parquet(f"{valid}/batch={batch}")
        lost.write.mode("overwrite").parquet(f"{rejected}/batch={batch}")

    _drain(df.writeStream.foreachBatch(write), name)
    empty = spark.createDataFrame([], df.schema)
    return tuple(
        spark.read.schema(side.schema).parquet(f"{path}/batch=*")
        for side, path in zip(checked(empty), (valid, rejected), strict=True)
    )


def label_scores(df: DataFrame, probability: str = "p", threshold: float = 0.5) -> DataFrame:
    return df.withColumn("flag", at_or_above(F.col(probability), threshold)).withColumn(
        "risk_label", fraud_label(F.col(probability))
    )


def _event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need the zoned timestamp type; wall-clock times take the session zone."""
    if dict(df.dtypes)[ts] == "timestamp_ntz":
        return df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df


def windowed_summary(
    df: DataFrame,
    ts: str,
    label: str,
    size: str = "1 hour",
    late: str = "10 minutes",
) -> DataFrame:
    """Counts per tumbling window and label. A window closes once event time passes its
    end by ``late``; state holds open windows only."""
    return (
        _event_time(df, ts)
        .withWatermark(ts, late)
        .groupBy(F.window(ts, size).alias("w"), label)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), label, "n")
    )


def first_per_id(df: DataFrame, ts: str, id_col: str, late: str = "10 minutes") -> DataFrame:
    """Drops repeats of an id that arrive within the watermark."""
    return _event_time(df, ts).withWatermark(ts, late).dropDuplicatesWithinWatermark([id_col])


def _drain(writer, name: str) -> None:
    spark = writer._spark
    state = scratch_path(spark, f"{name}-state")
    writer.option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()


def run_to_table(stream: DataFrame, name: str) -> DataFrame:
    """Drain everything available into Parquet under the shared folder and read it back."""
    spark = stream.sparkSession
    out = scratch_path(spark, name)
    _drain(stream.writeStream.format("parquet").option("path", out).outputMode("append"), name)
    return spark.read.schema(stream.schema).parquet(out)


def summary_to_table(summary: DataFrame, name: str) -> DataFrame:
    """Drain a windowed summary with the windows that are still open.

    Every micro-batch writes the rows it changed; a count only grows, so the largest one of a
    window and label is its latest.
    """
    spark = summary.sparkSession
    out = scratch_path(spark, name)

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    _drain(summary.writeStream.outputMode("update").foreachBatch(write), name)
    changes = spark.read.schema(summary.schema).parquet(f"{out}/batch=*")
    keys = [c for c in summary.columns if c != "n"]
    return changes.groupBy(*keys).agg(F.max("n").alias("n"))
