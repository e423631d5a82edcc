"""Reading and writing tables: CSV with a stated layout, partitioned splits, fitted models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.parse import nan_to_null
from riskframe.operators.loans import RAW_COLUMNS
from riskframe.operators.quality import require_columns
from riskframe.session import cut_lineage
from riskframe.sources import schemas

# Equal rows that one row of a count stands for when they are numbered.
EQUAL_ROWS = 10_000


def csv_header(spark: SparkSession, path: str, encoding: str = "UTF-8") -> list[str]:
    """Column names of a CSV file or folder; reads the header only."""
    return (
        spark.read.option("header", True)
        .option("encoding", encoding)
        .csv(path)
        .columns
    )


def read_csv(
    spark: SparkSession,
    path: str,
    types: Mapping[str, T.DataType],
    names: Mapping[str, str] | None = None,
    encoding: str = "UTF-8",
) -> DataFrame:
    """The stated columns, typed and renamed, wherever they stand in the file.

    Missing files and columns fail before any job over the data. Unstated columns are
    not parsed.
    """
    header = csv_header(spark, path, encoding)
    missing = sorted(set(types) - set(header))
    if missing:
        from riskframe.operators.quality import SchemaError

        raise SchemaError(f"missing columns: {', '.join(missing)}")
    layout = T.StructType([T.StructField(h, types.get(h, T.StringType())) for h in header])
    raw = (
        spark.read.schema(layout)
        .option("header", True)
        .option("encoding", encoding)
        .option("enforceSchema", False)
        .csv(path)
    )
    names = names or {}
    return raw.select(*[F.col(f"`{h}`").alias(names.get(h, h)) for h in types])


def _types(schema: T.StructType, only: Sequence[str] | None = None) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in schema if only is None or f.name in only}


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """Adds a unique id made of a hash of the row and its number among equal rows.

    It depends on values alone, however the file is split. Equal rows are counted before they
    move and numbered from their count, in pieces that Spark may spread, so a row that is repeated
    without end does not make one task. The result is written once for all later steps.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    size = F.lit(EQUAL_ROWS)
    pieces = counted.withColumn("__piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("__n") - 1) / size)))).hint("rebalance")
    numbers = F.sequence(F.col("__piece") * size + 1, F.least("__n", (F.col("__piece") + 1) * size))
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("null")) for c in columns])
    rows = pieces.withColumn("__number", F.explode(numbers)).withColumn(name, F.xxhash64(F.md5(text), "__number"))
    return cut_lineage(rows.select(name, *columns), "identified")


def read_card_transactions(spark: SparkSession, path: str) -> DataFrame:
    return with_row_id(read_csv(spark, path, _types(schemas.CARD_SCHEMA), schemas.CARD_HEADERS), "txn_id")


def read_retail(spark: SparkSession, path: str, timestamp_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Invoice lines from Latin-1 CSV; the customer number becomes integral."""
    needed = ["Invoice", "Quantity", "InvoiceDate", "Price", "Customer ID"]
    raw = read_csv(
        spark, path, _types(schemas.RETAIL_SCHEMA, needed), schemas.RETAIL_HEADERS, "ISO-8859-1"
    )
    return raw.withColumns(
        {
            "customer_id": nan_to_null(F.col("customer_id")).cast("long"),
            "invoice_ts": F.to_timestamp_ntz("invoice_ts", F.lit(timestamp_format)),
        }
    )


def read_applicants(spark: SparkSession, path: str) -> DataFrame:
    """Applicants with ``applicant_id``, which the file does not hold."""
    raw = read_csv(spark, path, _types(schemas.APPLICANT_SCHEMA), schemas.APPLICANT_HEADERS)
    return with_row_id(raw, "applicant_id")


def read_loans(spark: SparkSession, path: str) -> DataFrame:
    """The 16 loan columns of a wide CSV, with ``loan_id``."""
    text = {
        "loan_status", "issue_d", "last_pymnt_d", "term", "int_rate", "grade", "emp_length",
        "revol_util",
    }
    types = {c: T.StringType() if c in text else T.DoubleType() for c in RAW_COLUMNS}
    return with_row_id(read_csv(spark, path, types), "loan_id")


def write_split(df: DataFrame, path: str, label: str) -> None:
    """Splits as Parquet partitions, so that reading one touches only its files."""
    require_columns(df, ["split", label])
    df.write.partitionBy("split", label).parquet(path)


def read_split(spark: SparkSession, path: str, split: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path).where(F.col("split") == split)


def save_coefficients(table: DataFrame, path: str) -> None:
    """A fitted model that is a table (Cox coefficients, scaler statistics, centroids)."""
    table.write.parquet(path)


def load_coefficients(spark: SparkSession, path: str, key: str, value: str) -> dict[str, float]:
    """Model-sized table back as name to value."""
    return {r[key]: r[value] for r in spark.read.parquet(path).select(key, value).collect()}
