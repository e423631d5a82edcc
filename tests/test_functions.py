from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from riskframe.functions import parse, scores


def column(spark, values, type_, fn):
    df = spark.createDataFrame([(v,) for v in values], f"x {type_}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


@pytest.mark.parametrize(
    "fn, type_, cases",
    [
        (scores.credit_score, "double", {0.0: 1000, 1.0: 0, 0.25: 750, 1.5: 0, -0.5: 1000, 0.3335: 666}),
        (scores.credit_grade, "int", {850: "A", 800: "A", 700: "B", 650: "B", 550: "C", 400: "D", 350: "D", 200: "E"}),
        (scores.credit_decision, "int", {750: "APPROVE", 650: "APPROVE", 649: "REVIEW", 400: "REVIEW", 300: "DENY"}),
        (scores.loan_tier, "double", {0.03: "LOW", 0.05: "MEDIUM", 0.10: "MEDIUM", 0.25: "HIGH", 0.30: "VERY_HIGH", 0.40: "VERY_HIGH"}),
        (scores.fraud_label, "double", {0.95: "HIGH", 0.90: "HIGH", 0.75: "MEDIUM", 0.5: "MEDIUM", 0.10: "LOW"}),
        (scores.age_band, "int", {18: None, 19: "18-30", 30: "18-30", 31: "31-40", 70: "61-70", 71: "71+", 101: None}),
        (scores.utilization_bucket, "double", {0.0: 0, 0.15: 0, 0.2: 1, 0.99: 4, 1.0: 4}),
        (lambda c: scores.calibration_bin(c, 10), "double", {0.0: 0, 0.1: 0, 0.11: 1, 1.0: 9}),
        (lambda c: scores.histogram_bin(c, 0.0, 1.0, 4), "double", {0.0: 0, 0.25: 1, 1.0: 3, 1.1: None, -0.1: None}),
        (parse.employment_years, "string", {"10+ years": 10.0, "< 1 year": 0.5, "3 years": 3.0, "n/a": None, None: None}),
        (parse.percent_or_null, "string", {"13.5%": 13.5, "": None, "nan": None, None: None}),
        (parse.first_integer, "string", {" 36 months": 36, "x": None}),
        (parse.month_year_or_null, "string", {"Dec-2015": date(2015, 12, 1), "bad": None}),
        (parse.or_unknown, "string", {"a": "a", "": "unknown", None: "unknown"}),
    ],
)
def test_values(spark, fn, type_, cases):
    assert column(spark, list(cases), type_, fn) == list(cases.values())


def test_strict_percent_fails_on_text(spark):
    with pytest.raises(Exception):
        column(spark, ["abc"], "string", parse.percent)


def test_whole_days_floors_by_time_of_day(spark):
    rows = [
        (datetime(2024, 1, 3, 1), datetime(2024, 1, 1, 2)),
        (datetime(2024, 1, 3, 2), datetime(2024, 1, 1, 2)),
        (datetime(2024, 1, 1, 1), datetime(2024, 1, 1, 2)),
    ]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(parse.whole_days(F.col("a"), F.col("b"))).collect()]
    assert got == [1, 2, -1]


def test_thirty_day_months_round_half_even(spark):
    df = spark.sql("select date'2024-01-01' a, date_add(date'2024-01-01', d) b from values (30),(45),(37) t(d)")
    got = [r[0] for r in df.select(parse.thirty_day_months(F.col("b"), F.col("a"))).collect()]
    assert got == [1.0, 1.5, 1.2]
