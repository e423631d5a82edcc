"""Output conventions of the registered queries: doubles rounded to six places at the
sink, in both engines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.plans.fixtures import view_sql


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Rounds every double column; adding 0.0 turns -0.0 into 0.0."""
    return df.select(
        *[
            (F.round(F.col(c), places) + F.lit(0.0)).alias(c) if t == "double" else F.col(c)
            for c, t in df.dtypes
        ]
    )


def sql(body: str, doubles: Sequence[str] = (), views: Sequence[str] = (), places: int = 6) -> str:
    """``body`` over the named views, its double columns rounded as in :func:`rounded`."""
    rounding = ", ".join(f"round({c}, {places}) + 0.0 as {c}" for c in doubles)
    replace = f" replace ({rounding})" if doubles else ""
    ctes = "".join(f"{v} as ({view_sql(v)}),\n" for v in views)
    return f"with {ctes}result_rows as (\n{body}\n)\nselect *{replace} from result_rows"
