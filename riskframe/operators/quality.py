"""Validation as table operators: broken rules become a column, never an exception."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.parse import first_integer


class SchemaError(ValueError):
    """A table lacks required columns."""


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Fail before any job runs when columns are missing."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise SchemaError(f"missing columns: {', '.join(missing)}")
    return df


def with_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Adds ``violations``: names of the rules a row breaks. A rule that is null is broken."""
    broken = [
        F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in rules.items()
    ]
    return df.withColumn("violations", F.array_compact(F.array(*broken)))


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows that keep every rule, rejected rows with their violations).

    The valid side filters by one conjunct per rule, so each can push down to the scan; a
    rule that is null filters its row out.
    """
    valid = df
    for holds in rules.values():
        valid = valid.where(holds)
    return valid, with_violations(df, rules).where(F.size("violations") > 0)


def finite(c: str) -> Column:
    x = F.col(c).cast("double")
    return ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def at_least(c: str, low: float) -> Column:
    return ~F.isnan(F.col(c).cast("double")) & (F.col(c) >= low)


def within(c: str, low: float, high: float) -> Column:
    return F.col(c).between(low, high)


# Every rule names the column it guards. Bounds are fixed values of the business rules.
def applicant_rules() -> dict[str, Column]:
    return {
        "utilization": within("utilization", 0.0, 1.0),
        "age": within("age", 18, 100),
        "late_30_59": at_least("late_30_59", 0),
        "debt_ratio": at_least("debt_ratio", 0.0),
        "monthly_income": at_least("monthly_income", 0.0),
        "open_lines": at_least("open_lines", 0),
        "late_90": at_least("late_90", 0),
        "real_estate": at_least("real_estate", 0),
        "late_60_89": at_least("late_60_89", 0),
        "dependents": at_least("dependents", 0),
    }


def loan_rules() -> dict[str, Column]:
    """Rules for parsed loans (numeric columns, grade still a letter)."""
    return {
        "loan_amnt": ~F.isnan("loan_amnt") & (F.col("loan_amnt") > 0),
        "int_rate": (F.col("int_rate") > 0) & (F.col("int_rate") < 100),
        "grade": F.col("grade").isin(*"ABCDEFG"),
        "emp_length_years": within("emp_length_years", 0.0, 50.0),
        "annual_inc": at_least("annual_inc", 0.0),
        "dti": within("dti", 0.0, 100.0),
        "fico_range_low": within("fico_range_low", 300.0, 850.0),
        "open_acc": at_least("open_acc", 0),
        "revol_util": within("revol_util", 0.0, 100.0),
        "total_acc": at_least("total_acc", 0),
        "inq_last_6mths": at_least("inq_last_6mths", 0),
        "pub_rec": at_least("pub_rec", 0),
        "term_months": F.col("term_months").isin(36, 60),
    }


def transaction_rules(features: Sequence[str], amount: str = "amount") -> dict[str, Column]:
    rules = {c: finite(c) for c in features}
    rules[f"{amount}_negative"] = F.isnan(amount) | (F.col(amount) >= 0)
    return rules


def customer_rules() -> dict[str, Column]:
    return {c: finite(c) & (F.col(c) >= 0) for c in ("recency", "frequency", "monetary")}


def null_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: rows, missing values (null or NaN) and their share."""
    types = dict(df.dtypes)

    def missing(c: str) -> Column:
        test = F.col(c).isNull()
        return test | F.isnan(c) if types[c] in ("double", "float") else test

    one = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(missing(c)).alias(c) for c in cols]
    )
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing")) for c in cols]
    )
    return one.select("n", F.inline(pairs)).select(
        "column_name", "n", "missing", (F.col("missing") / F.col("n")).alias("missing_share")
    )


def duplicate_ids(df: DataFrame, id_col: str) -> DataFrame:
    """Ids that occur more than once, with their counts."""
    return df.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def table_check(df: DataFrame, id_col: str, max_rows: int | None = None) -> DataFrame:
    """One row: size, distinct ids and the table-level rules (not empty, unique, optional cap)."""
    counted = df.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(F.col(id_col)).alias("n_ids")
    )
    fits = F.lit(True) if max_rows is None else F.col("n") <= max_rows
    return counted.select(
        "n",
        "n_ids",
        (F.col("n") > 0).alias("not_empty"),
        (F.col("n") == F.col("n_ids")).alias("unique_ids"),
        fits.alias("within_cap"),
    )


def term_is_readable(term: str = "term") -> Column:
    """A loan without a readable term cannot be scored."""
    return first_integer(F.col(term)).isNotNull()
