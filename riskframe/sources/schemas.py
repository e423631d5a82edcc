"""Table layouts. Readers never infer types in production."""

from __future__ import annotations

from pyspark.sql import types as T

_D, _I, _L, _S = T.DoubleType(), T.IntegerType(), T.LongType(), T.StringType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


TRANSACTION_FEATURES = ["time_s", *[f"v{i}" for i in range(1, 29)], "amount"]

# CSV headers of the public data sets, in file order, and our names.
CARD_HEADERS = {
    "Time": "time_s",
    **{f"V{i}": f"v{i}" for i in range(1, 29)},
    "Amount": "amount",
    "Class": "class",
}
RETAIL_HEADERS = {
    "Invoice": "invoice",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_ts",
    "Price": "price",
    "Customer ID": "customer_id",
    "Country": "country",
}
APPLICANT_HEADERS = {
    "SeriousDlqin2yrs": "serious_dlqin2yrs",
    "RevolvingUtilizationOfUnsecuredLines": "utilization",
    "age": "age",
    "NumberOfTime30-59DaysPastDueNotWorse": "late_30_59",
    "DebtRatio": "debt_ratio",
    "MonthlyIncome": "monthly_income",
    "NumberOfOpenCreditLinesAndLoans": "open_lines",
    "NumberOfTimes90DaysLate": "late_90",
    "NumberRealEstateLoansOrLines": "real_estate",
    "NumberOfTime60-89DaysPastDueNotWorse": "late_60_89",
    "NumberOfDependents": "dependents",
}

CARD_SCHEMA = T.StructType(
    [T.StructField(h, _I if h == "Class" else _D) for h in CARD_HEADERS]
)
RETAIL_SCHEMA = T.StructType(
    [
        T.StructField(h, {"Quantity": _D, "Price": _D, "Customer ID": _D}.get(h, _S))
        for h in RETAIL_HEADERS
    ]
)
APPLICANT_SCHEMA = T.StructType(
    [
        T.StructField(
            h,
            _D
            if h in ("RevolvingUtilizationOfUnsecuredLines", "DebtRatio", "MonthlyIncome")
            else _I,
        )
        for h in APPLICANT_HEADERS
    ]
)

TRANSACTIONS = T.StructType(
    [
        T.StructField("txn_id", _L),
        *[T.StructField(c, _D) for c in TRANSACTION_FEATURES],
        T.StructField("class", _I),
    ]
)
RUNS = _struct(
    run_id=_S, ts=T.TimestampNTZType(), pipeline=_S, metric=_S, step=_L, value=_D
)
