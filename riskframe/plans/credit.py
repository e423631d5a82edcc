"""Registered queries: applicants, credit features, scores, calibration and attribution."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from riskframe.operators import boosting, credit, explain, impute, metrics, models, quality, sampling
from riskframe.plans.fixtures import view
from riskframe.plans.shape import rounded, sql
from riskframe.session import cut_lineage
from riskframe.sources.model_store import session_store
from riskframe.sources.payload import APPLICANT_FIELDS, explode_payload

LABEL = "serious_dlqin2yrs"

# Coefficients of a linear score for attribution checks.
LINEAR = {
    "utilization": 1.5,
    "age": -0.02,
    "late_30_59": 0.4,
    "debt_ratio": 0.05,
    "monthly_income": -0.00002,
    "late_90": 0.7,
    "late_60_89": 0.5,
    "dependents": 0.08,
}


def _applicants(spark, sf):
    return view(spark, sf, "applicants")


def _features(spark, sf):
    return credit.credit_features(credit.clean_applicants(_applicants(spark, sf)))


def validate_applicants(spark, sf):
    checked = quality.with_violations(_applicants(spark, sf), quality.applicant_rules())
    return checked.select("applicant_id", F.concat_ws(",", "violations").alias("violations"))


def credit_clean(spark, sf):
    return rounded(credit.clean_applicants(_applicants(spark, sf)))


def credit_features(spark, sf):
    return rounded(_features(spark, sf).select("applicant_id", *credit.FEATURES))


def impute_group_median(spark, sf):
    df = credit.with_age_group(credit.valid_age(_applicants(spark, sf)))
    filled = impute.impute_group_median(df, "monthly_income", "age_group")
    return rounded(filled.select("applicant_id", "age_group", "monthly_income"))


def impute_global_median(spark, sf):
    filled = impute.impute_global_median(_applicants(spark, sf), ["dependents", "monthly_income"])
    return rounded(filled.select("applicant_id", "dependents", "monthly_income"))


def null_profile(spark, sf):
    df = _applicants(spark, sf)
    return rounded(quality.null_profile(df, df.columns))


def feature_medians(spark, sf):
    cols = ["utilization", "age", "debt_ratio", "monthly_income", "open_lines", "dependents"]
    found = impute.quantile_values(_applicants(spark, sf), cols, [0.5])
    rows = [(c, q[0]) for c, q in found.items()]
    return rounded(spark.createDataFrame(rows, "series string, median double"))


def credit_score_map(spark, sf):
    scored = credit.score_scale(view(spark, sf, "scored"), "p")
    return scored.select(
        "id", "score", "risk_grade", "recommendation", F.col("is_approved").cast("int").alias("approved")
    )


def decision_summary(spark, sf):
    return metrics.label_summary(credit.score_scale(view(spark, sf, "scored"), "p"), "recommendation")


def fairness_by_band(spark, sf):
    return rounded(metrics.fairness_by_band(view(spark, sf, "scored"), "p", "y"))


def top_factors(spark, sf):
    clean = credit.clean_applicants(_applicants(spark, sf))
    phi = explain.linear_attribution(clean, LINEAR)
    return rounded(
        clean.select("applicant_id", F.posexplode(explain.top_factors(phi)).alias("pos", "f")).select(
            "applicant_id", "pos", "f.feature", "f.shap_value", "f.impact"
        )
    )


def mean_abs_attribution(spark, sf):
    clean = credit.clean_applicants(_applicants(spark, sf))
    return rounded(explain.mean_absolute(clean, explain.linear_attribution(clean, LINEAR)))


def payload_explode(spark, sf):
    """One two-record JSON batch per applicant: with id, and with an empty id."""
    rows = _applicants(spark, sf)
    fields = list(APPLICANT_FIELDS)
    named = F.struct(F.col("applicant_id").cast("string").alias("applicant_id"), *fields)
    anonymous = F.struct(
        F.lit("").alias("applicant_id"),
        *[(F.col("age") + 1).alias(f) if f == "age" else F.col(f) for f in fields],
    )
    batches = rows.select(
        F.col("applicant_id").alias("request_id"),
        F.to_json(F.struct(F.array(named, anonymous).alias("applicants"))).alias("payload"),
    )
    return rounded(
        explode_payload(batches, "payload", "applicants", "applicant_id", APPLICANT_FIELDS)
    )


# Trees, depth, leaves, least rows of a leaf, rate, shares of rows and columns, and trees without
# improvement of the described model.
BOOSTED = dict(
    trees=500, depth=6, max_leaves=31, min_rows=50, rate=0.05, row_share=0.8, column_share=0.8,
    penalty=0.0, patience=50, metric="logloss",
)


def _split(spark, sf):
    return cut_lineage(sampling.stratified_split(_features(spark, sf), "applicant_id", LABEL), "applicants")


def _stored(spark, sf, name, fit):
    """The session's model of these tables, fitted once."""
    key = f"{name}-{hashlib.md5(sf.encode()).hexdigest()}"
    return session_store(spark).load_or_fit(key, credit.FEATURES, fit)


def _boosted(spark, sf):
    """All applicants with their split, and the model of the training rows."""
    df = _split(spark, sf)
    train = df.where("split = 'train'")
    fit = lambda: models.fit_gbt(train, credit.FEATURES, "applicant_id", LABEL, **BOOSTED)
    return df, _stored(spark, sf, "credit", fit)


# Bin ends for the first histograms of a boosted tree.
EDGES = {
    "utilization": [0.1, 0.25, 0.5, 0.9], "age": [30, 40, 50, 60, 70], "late_90": [0, 1, 2],
    "monthly_income": [2000, 4000, 8000], "debt_ratio": [0.2, 0.5, 1.0],
}


def gradient_histogram(spark, sf):
    """Gradient, curvature and rows per bin before the first tree."""
    df = _features(spark, sf).withColumn("label", F.col(LABEL).cast("double"))
    return rounded(boosting.root_histogram(df, EDGES))


def credit_gbt(spark, sf):
    df, model = _boosted(spark, sf)
    return rounded(models.score_with(model, df).select("applicant_id", "split", "p"))


def _calibrated(spark, sf):
    """The calibrated model of the training rows, and the test rows, which no fold has seen."""
    df = _split(spark, sf)
    train, test = (df.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    fit = lambda: models.fit_platt(train, credit.FEATURES, "applicant_id", LABEL, **BOOSTED)
    return _stored(spark, sf, "platt", fit), test


def platt_calibration(spark, sf):
    model, test = _calibrated(spark, sf)
    return rounded(model.score(test).select("applicant_id", "pd"))


def credit_scores(spark, sf):
    """Calibrated probability, score, grade, decision and the top three factors."""
    calibrated, test = _calibrated(spark, sf)
    scored = credit.score_scale(calibrated.score(test), "pd")
    phi = explain.calibrated_attribution(test, calibrated, credit.FEATURES, "applicant_id")
    factors = phi.select(
        F.col("id").alias("applicant_id"),
        explain.top_factors({c: F.col(c) for c in credit.FEATURES}).alias("top_factors"),
    )
    return scored.join(factors, "applicant_id").select(
        "applicant_id", "score", "pd", "risk_grade", "recommendation", "is_approved", "top_factors"
    )


def tree_attribution(spark, sf):
    """Of the test rows, which the model has not seen."""
    df, model = _boosted(spark, sf)
    return rounded(explain.tree_attribution(df.where("split = 'test'"), model, credit.FEATURES, "applicant_id"))


QUERIES = {
    f.__name__: f
    for f in (
        validate_applicants, credit_clean, credit_features, impute_group_median,
        impute_global_median, null_profile, feature_medians, credit_score_map, decision_summary,
        fairness_by_band, top_factors, mean_abs_attribution, payload_explode, gradient_histogram, credit_gbt,
        platt_calibration, credit_scores, tree_attribution,
    )
}

_views = ["applicants"]

_AGED = "aged as (select *, cast(floor(age / 10) * 10 as int) as age_group from applicants where age > 0 and age <= 100)"
_INCOME = """
gm as (select age_group, median(monthly_income) as m from aged group by 1),
inc as (select a.* exclude (monthly_income), coalesce(a.monthly_income, m) as monthly_income
        from aged a left join gm on a.age_group = gm.age_group)"""
CLEAN_CTE = f"""{_AGED},{_INCOME},
clean as (
  select applicant_id, serious_dlqin2yrs,
    least(greatest(utilization, 0.0::double), 1.0::double) as utilization, age,
    least(greatest(coalesce(nullif(late_30_59, 98), 0), 0), 10) as late_30_59,
    least(greatest(debt_ratio, 0.0::double), 10.0::double) as debt_ratio,
    least(greatest(coalesce(monthly_income, (select median(monthly_income) from inc)), 0.0::double), 50000.0::double) as monthly_income,
    open_lines,
    least(greatest(coalesce(nullif(late_90, 98), 0), 0), 10) as late_90, real_estate,
    least(greatest(coalesce(nullif(late_60_89, 98), 0), 0), 10) as late_60_89,
    coalesce(cast(dependents as double), (select median(dependents) from inc)) as dependents
  from inc
)"""
_DOUBLES = ["utilization", "debt_ratio", "monthly_income", "dependents"]
_FEATURE_ROWS = f"""with {CLEAN_CTE}
select applicant_id, utilization, age, late_30_59, debt_ratio, monthly_income, open_lines, late_90,
  real_estate, late_60_89, dependents, late_30_59 + late_60_89 + late_90 as total_late,
  least(greatest(debt_ratio / (monthly_income + 1e-9), 0.0::double), 100.0::double) as debt_to_income,
  cast(floor(least(greatest(utilization * 5, 0.0::double), 4.0::double)) as int) as utilization_category
from clean"""
_RULES = {
    "utilization": "utilization between 0 and 1",
    "age": "age between 18 and 100",
    **{
        c: f"{c} >= 0"
        for c in (
            "late_30_59", "debt_ratio", "monthly_income", "open_lines", "late_90", "real_estate",
            "late_60_89", "dependents",
        )
    },
}
_broken = ", ".join(f"case when not coalesce({r}, false) then '{n}' end" for n, r in _RULES.items())
_profile = " union all ".join(
    f"select '{c}' as column_name, count(*) as n, count(*) - count({c}) as missing from applicants"
    for c in (
        "applicant_id", LABEL, "utilization", "age", "late_30_59", "debt_ratio", "monthly_income",
        "open_lines", "late_90", "real_estate", "late_60_89", "dependents",
    )
)
_medians = " union all ".join(
    f"select '{c}' as series, cast(median({c}) as double) as median from applicants"
    for c in ("utilization", "age", "debt_ratio", "monthly_income", "open_lines", "dependents")
)
_SCALED_SCORE = "cast(floor(least(greatest((cast(1 as double) - p) * 1000, 0.0::double), 1000.0::double)) as int)"
_DECIDED = f"""select id, {_SCALED_SCORE} as score from scored"""
_DECISION = "case when score >= 650 then 'APPROVE' when score >= 400 then 'REVIEW' else 'DENY' end"
_phi = " union all ".join(
    f"select applicant_id, '{f}' as feature, cast({b:.10f} as double) * ({f} - (select avg({f}) from clean)) as shap_value from clean"
    for f, b in LINEAR.items()
)
_fields = ", ".join(f for f in APPLICANT_FIELDS if f != "age")
_band = (
    "case when age > 18 and age <= 30 then '18-30' when age > 30 and age <= 40 then '31-40' "
    "when age > 40 and age <= 50 then '41-50' when age > 50 and age <= 60 then '51-60' "
    "when age > 60 and age <= 70 then '61-70' when age > 70 and age <= 100 then '71+' end"
)

_histograms = " union all ".join(
    f"select '{c}' as feature, cast({' + '.join(f'({c} > {e})::int' for e in ends)} as int) as bin, "
    f"0.5 - {LABEL} as g from clean"
    for c, ends in EDGES.items()
)
ORACLES = {
    "gradient_histogram": sql(
        f"""with {CLEAN_CTE}
select feature, bin, sum(cast(g as double)) as gradient, 0.25::double * count(*) as curvature, count(*) as rows
from ({_histograms}) group by feature, bin""",
        ["gradient", "curvature"],
        _views,
    ),
    "validate_applicants": sql(
        f"select applicant_id, concat_ws(',', {_broken}) as violations from applicants", views=_views
    ),
    "credit_clean": sql(f"with {CLEAN_CTE} select * from clean", _DOUBLES, _views),
    "credit_features": sql(_FEATURE_ROWS, [*_DOUBLES, "debt_to_income"], _views),
    "impute_group_median": sql(
        f"""with {_AGED},{_INCOME}
select applicant_id, age_group,
coalesce(monthly_income, (select median(monthly_income) from inc)) as monthly_income from inc""",
        ["monthly_income"],
        _views,
    ),
    "impute_global_median": sql(
        """select applicant_id,
coalesce(cast(dependents as double), (select median(dependents) from applicants)) as dependents,
coalesce(monthly_income, (select median(monthly_income) from applicants)) as monthly_income
from applicants""",
        ["dependents", "monthly_income"],
        _views,
    ),
    "null_profile": sql(
        f"select *, missing / cast(n as double) as missing_share from ({_profile}) t",
        ["missing_share"],
        _views,
    ),
    "feature_medians": sql(_medians, ["median"], _views),
    "credit_score_map": sql(
        f"""select id, score, case when score >= 800 then 'A' when score >= 650 then 'B'
when score >= 500 then 'C' when score >= 350 then 'D' else 'E' end as risk_grade,
{_DECISION} as recommendation, case when score >= 650 then 1 else 0 end as approved
from ({_DECIDED}) t""",
        views=["scored"],
    ),
    "decision_summary": sql(
        f"select {_DECISION} as recommendation, count(*) as n from ({_DECIDED}) t group by 1",
        views=["scored"],
    ),
    "fairness_by_band": sql(
        f"""select {_band} as age_band, 1 - avg(case when p >= 0.35 then 1.0 else 0.0 end) as approval_rate,
avg(y) as default_rate, count(*) as n from scored where {_band} is not null group by 1""",
        ["approval_rate", "default_rate"],
        ["scored"],
    ),
    "top_factors": sql(
        f"""with {CLEAN_CTE},
phi as ({_phi}),
ranked as (select *, cast(row_number() over (partition by applicant_id order by abs(shap_value) desc, feature) - 1 as int) as pos from phi)
select applicant_id, pos, feature, shap_value,
case when shap_value > 0 then 'increases_risk' else 'decreases_risk' end as impact
from ranked where pos < 3""",
        ["shap_value"],
        _views,
    ),
    "mean_abs_attribution": sql(
        f"with {CLEAN_CTE}, phi as ({_phi}) select feature, avg(abs(shap_value)) as mean_abs from phi group by 1",
        ["mean_abs"],
        _views,
    ),
    "payload_explode": sql(
        f"""select applicant_id as request_id, cast(0 as int) as position,
cast(applicant_id as varchar) as applicant_id, age, {_fields} from applicants
union all select applicant_id, 1, 'unknown', age + 1, {_fields} from applicants""",
        ["utilization", "debt_ratio", "monthly_income"],
        _views,
    ),
}
