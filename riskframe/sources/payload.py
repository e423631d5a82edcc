"""Batch payloads: JSON documents to typed rows, and results to JSON documents."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.parse import or_unknown

APPLICANT_FIELDS = {
    "utilization": "double",
    "age": "int",
    "late_30_59": "int",
    "debt_ratio": "double",
    "monthly_income": "double",
    "open_lines": "int",
    "late_90": "int",
    "real_estate": "int",
    "late_60_89": "int",
    "dependents": "int",
}
LOAN_FIELDS = {
    "loan_amnt": "double",
    "int_rate": "double",
    "grade": "string",
    "emp_length_years": "double",
    "annual_inc": "double",
    "dti": "double",
    "fico_range_low": "double",
    "open_acc": "int",
    "revol_util": "double",
    "total_acc": "int",
    "inq_last_6mths": "int",
    "pub_rec": "int",
    "term_months": "int",
}


def explode_payload(
    df: DataFrame, payload: str, records: str, id_field: str, fields: Mapping[str, str]
) -> DataFrame:
    """One typed row per record of a JSON batch ``{records: [{...}, ...]}``.

    Values that do not fit their type become null (validation then names them); a
    missing or empty id becomes ``unknown``; grades are upper-cased.
    """
    record = T.StructType([T.StructField(n, T.StringType()) for n in (id_field, *fields)])
    document = T.StructType([T.StructField(records, T.ArrayType(record))])
    rows = df.withColumn("_doc", F.from_json(F.col(payload), document)).select(
        *[c for c in df.columns if c != payload],
        F.posexplode(F.col("_doc")[records]).alias("position", "_r"),
    )

    def typed(name: str, kind: str):
        raw = F.col("_r")[name]
        if name == "grade":
            return F.upper(raw).alias(name)
        return raw.try_cast(kind).alias(name)

    return rows.select(
        *[c for c in rows.columns if c != "_r"],
        or_unknown(F.col("_r")[id_field]).alias(id_field),
        *[typed(n, k) for n, k in fields.items()],
    )


def to_response(df: DataFrame, id_field: str) -> DataFrame:
    """One JSON document per scored row."""
    return df.select(id_field, F.to_json(F.struct(*df.columns)).alias("response"))
