"""Registered queries: loans and survival analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.scores import loan_tier
from riskframe.operators import cox, loans, quality, rfm, survival
from riskframe.plans.fixtures import view
from riskframe.plans.shape import rounded, sql
from riskframe.session import cut_lineage

DURATION, EVENT = "duration_months", "event"


def _table(spark, sf) -> DataFrame:
    return loans.survival_table(view(spark, sf, "loans"))


def _hazards(spark, sf) -> DataFrame:
    table = cut_lineage(_table(spark, sf), "survival")
    return survival.partial_hazard(rfm.standardize(table, loans.FEATURES), survival.PUBLISHED_COX)


def loan_parse(spark, sf):
    parsed = loans.parse_loans(view(spark, sf, "loans"))
    return parsed.select(
        "loan_id",
        F.col("issue_d").cast("string").alias("issue_d"),
        F.col("last_pymnt_d").cast("string").alias("last_pymnt_d"),
        "int_rate",
        "revol_util",
        "term_months",
        "emp_length_years",
    )


_CLEAN_COLUMNS = [
    "loan_id", "loan_status", "grade", "int_rate", "revol_util", "emp_length_years", "dti",
    "open_acc", "total_acc", "inq_last_6mths", "pub_rec", "annual_inc", "term_months",
]


def loan_clean(spark, sf):
    return rounded(loans.clean_loans(view(spark, sf, "loans")).select(*_CLEAN_COLUMNS))


def loan_events(spark, sf):
    events = loans.loan_events(loans.clean_loans(view(spark, sf, "loans")))
    return events.select("loan_id", DURATION, EVENT)


def loan_features(spark, sf):
    return rounded(_table(spark, sf))


def grade_lookup(spark, sf):
    df = view(spark, sf, "loans")
    return df.select("loan_id", "grade", loans.grade_code(F.col("grade")).alias("grade_encoded"))


def validate_loans(spark, sf):
    parsed = loans.parse_loans(view(spark, sf, "loans"))
    checked = quality.with_violations(parsed, quality.loan_rules())
    return checked.select("loan_id", F.concat_ws(",", "violations").alias("violations"))


def loan_risk_tier(spark, sf):
    tier = loan_tier(F.col("p"))
    return view(spark, sf, "scored").select(
        "id", tier.alias("risk_tier"), (tier == "LOW").cast("int").alias("low_risk")
    )


def kaplan_meier(spark, sf):
    return rounded(survival.kaplan_meier(_table(spark, sf), DURATION, EVENT))


def median_survival(spark, sf):
    curve = survival.kaplan_meier(_table(spark, sf), DURATION, EVENT, ["term_months"])
    return survival.median_survival(curve, ["term_months"])


def interpolate_curve(spark, sf):
    """The Kaplan-Meier curve read at every loan amount, scaled to 0..80 months."""
    table = cut_lineage(_table(spark, sf), "survival")
    curve = survival.kaplan_meier(table, DURATION, EVENT)
    at = table.select("loan_id", (F.col("loan_amnt") % 80).alias("months"))
    return rounded(survival.interpolate_at(curve, at, "months"))


def c_index(spark, sf):
    table = _table(spark, sf).withColumn("risk", F.col("int_rate") * F.col("loan_amnt"))
    return rounded(survival.concordance(table, DURATION, EVENT, "risk"))


def c_index_ties(spark, sf):
    """Few distinct risks: most pairs tie somewhere."""
    return rounded(survival.concordance(_table(spark, sf), DURATION, EVENT, "int_rate"))


def cox_hazard(spark, sf):
    return rounded(_hazards(spark, sf).select("loan_id", "hazard_ratio"))


def baseline_hazard(spark, sf):
    return rounded(survival.baseline_hazard(_hazards(spark, sf), DURATION, EVENT))


def loan_scores(spark, sf):
    rows = _hazards(spark, sf)
    scored = survival.score_loans(rows, survival.baseline_hazard(rows, DURATION, EVENT))
    return rounded(
        scored.select(
            "loan_id", "s_12m", "s_24m", "s_36m", "median_months", "hazard_ratio", "pd_12m",
            "risk_tier", F.col("is_low_risk").cast("int").alias("low_risk"),
        )
    )


def survival_brier(spark, sf):
    rows = _hazards(spark, sf)
    scored = survival.score_loans(rows, survival.baseline_hazard(rows, DURATION, EVENT))
    return rounded(survival.naive_survival_brier(scored, "s_12m", DURATION, EVENT, 12))


def _fit(spark, sf):
    table = cut_lineage(rfm.standardize(cut_lineage(_table(spark, sf), "raw"), loans.FEATURES), "z")
    return table, cox.fit_cox(table, DURATION, EVENT, loans.FEATURES)


def cox_fit(spark, sf):
    _, model = _fit(spark, sf)
    return rounded(model.table(spark))


def survival_by_grade(spark, sf):
    """Curves of the median applicant with the grade set to 1..7, standardised."""
    raw = cut_lineage(_table(spark, sf), "raw")
    z = cut_lineage(rfm.standardize(raw, loans.FEATURES), "z")
    model = cox.fit_cox(z, DURATION, EVENT, loans.FEATURES)
    hazards = survival.partial_hazard(z, model.coefficients())
    baseline = survival.baseline_hazard(hazards, DURATION, EVENT)
    medians = loans.quantile_values(raw, loans.FEATURES, [0.5])
    profile = raw.sparkSession.range(1, 8).select(
        F.col("id").cast("int").alias("grade"),
        *[
            (F.col("id").cast("double") if c == "grade_encoded" else F.lit(medians[c][0])).alias(c)
            for c in loans.FEATURES
        ],
    )
    placed = survival.partial_hazard(
        rfm.standardize(profile, loans.FEATURES, fit_on=raw), model.coefficients()
    )
    # A row per grade, joined to every step by its number.
    steps = baseline.select("t", "h0", F.explode(F.sequence(F.lit(1), F.lit(7))).alias("grade"))
    curves = steps.join(F.broadcast(placed.select("grade", "hazard_ratio")), "grade")
    return rounded(curves.select("grade", "t", F.exp(-F.col("h0") * F.col("hazard_ratio")).alias("s")))


QUERIES = {
    f.__name__: f
    for f in (
        loan_parse, loan_clean, loan_events, loan_features, grade_lookup, validate_loans,
        loan_risk_tier, kaplan_meier, median_survival, interpolate_curve, c_index, c_index_ties,
        cox_hazard, baseline_hazard, loan_scores, survival_brier, cox_fit, survival_by_grade,
    )
}

_views = ["loans"]
PARSED_CTE = """
parsed as (
  select * exclude (issue_d, last_pymnt_d, int_rate, revol_util),
    cast(strptime(issue_d, '%b-%Y') as date) as issue_d,
    cast(try_strptime(last_pymnt_d, '%b-%Y') as date) as last_pymnt_d,
    cast(replace(int_rate, '%', '') as double) as int_rate,
    case when isnan(try_cast(replace(revol_util, '%', '') as double)) then null
         else try_cast(replace(revol_util, '%', '') as double) end as revol_util,
    cast(regexp_extract(term, '([0-9]+)', 1) as int) as term_months,
    case when contains(lower(emp_length), '10+') then 10.0::double
         when contains(lower(emp_length), '< 1') then 0.5::double
         else try_cast(regexp_replace(emp_length, '[^0-9]', '', 'g') as double) end as emp_length_years
  from loans
)"""
CLEAN_CTE = f"""{PARSED_CTE.strip()},
known as (select * from parsed where issue_d is not null and loan_status is not null
          and grade in ('A','B','C','D','E','F','G')),
clean as (
  select * exclude (revol_util, emp_length_years, dti, open_acc, total_acc, inq_last_6mths, pub_rec),
    coalesce(revol_util, (select median(revol_util) from known)) as revol_util,
    coalesce(emp_length_years, (select median(emp_length_years) from known)) as emp_length_years,
    coalesce(dti, (select median(dti) from known)) as dti,
    coalesce(open_acc, (select median(open_acc) from known)) as open_acc,
    coalesce(total_acc, (select median(total_acc) from known)) as total_acc,
    coalesce(inq_last_6mths, 0) as inq_last_6mths, coalesce(pub_rec, 0) as pub_rec
  from known where annual_inc <= (select quantile_cont(annual_inc, 0.99) from known)
)"""
EVENTS_CTE = f"""{CLEAN_CTE},
timed as (
  select *, case when loan_status in ('Charged Off','Default','Late (31-120 days)') then 1 else 0 end as event,
    round_even(date_diff('day', issue_d, coalesce(last_pymnt_d, cast(issue_d + to_days(term_months * 30) as date))) / 30.0::double, 1) as duration_months
  from clean
),
events_rows as (select * from timed where duration_months > 0 and duration_months <= 72)"""
TABLE_CTE = f"""{EVENTS_CTE},
tbl as (
  select loan_id, duration_months, event, {", ".join(
      "position(grade in 'ABCDEFG') as grade_encoded" if c == "grade_encoded" else c
      for c in loans.FEATURES)}
  from events_rows
  where loan_amnt is not null and fico_range_low is not null and term_months is not null
)"""
_used = list(survival.PUBLISHED_COX)
_lp = " + ".join(
    f"(t.{c} - m_{c}) / d_{c} * cast({b} as double)" for c, b in survival.PUBLISHED_COX.items()
)
HAZARD_CTE = f"""{TABLE_CTE},
stats as (select {", ".join(f"avg({c}) as m_{c}, stddev_pop({c}) as d_{c}" for c in _used)} from tbl),
hz as (select t.*, exp({_lp}) as hazard_ratio from tbl t, stats)"""
BASE_CTE = f"""{HAZARD_CTE},
per_t as (select duration_months as t, sum(event) as d, sum(hazard_ratio) as ph from hz group by 1),
risk as (select t, cast(d as bigint) as d, sum(ph) over (order by t desc) as risk_sum from per_t),
base as (select t, d, risk_sum, sum(d / risk_sum) over (order by t) as h0 from risk)"""


def _s_at(h: int) -> str:
    left = f"(select max(t) from base where t <= {h})"
    right = f"(select min(t) from base where t >= {h})"
    h_l, h_r = (f"(select h0 from base where t = {x})" for x in (left, right))
    s_l, s_r = f"exp(-{h_l} * hazard_ratio)", f"exp(-{h_r} * hazard_ratio)"
    return (
        f"case when {left} is null then {s_r} when {right} is null or {left} = {right} then {s_l} "
        f"else {s_l} + ({s_r} - {s_l}) * ({h} - {left}) / ({right} - {left}) end"
    )


SCORES = f"""with {BASE_CTE},
scored_loans as (
  select loan_id, duration_months, event, hazard_ratio, {", ".join(f"{_s_at(h)} as s_{h}m" for h in (12, 24, 36))}
  from hz
),
crossing as (
  select loan_id, min(t) as median_months from hz, base
  where exp(-h0 * hazard_ratio) <= 0.5 group by 1
)"""
_TIER = (
    "case when {p} < 0.05 then 'LOW' when {p} < 0.15 then 'MEDIUM' "
    "when {p} < 0.30 then 'HIGH' else 'VERY_HIGH' end"
)


def _km(keys: str = "") -> str:
    part = f"partition by {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    return f"""
per_t as (select {lead}duration_months as t, cast(sum(event) as bigint) as d, count(*) as n from tbl group by all),
risk as (select *, cast(sum(n) over ({part} order by t desc) as bigint) as at_risk from per_t),
steps as (
  select *, case when d = at_risk then 0 else ln(1 - d / cast(at_risk as double)) end as ls,
    case when d = at_risk then 0 else d / (cast(at_risk as double) * (at_risk - d)) end as vs
  from risk),
summed as (select *, sum(ls) over ({part} order by t) as log_s, sum(vs) over ({part} order by t) as var from steps),
curve as (
  select {lead}t, d, at_risk, case when d = at_risk then 0 else exp(log_s) end as s, log_s,
    case when d = at_risk or log_s >= 0 then null else 1.96::double * sqrt(var) / log_s end as spread
  from summed)"""


def _concordance(risk: str) -> str:
    return f"""with {TABLE_CTE},
r as (select duration_months as t, event as e, {risk} as risk from tbl),
cells as (select t, risk, sum(e) as ev, count(*) as n from r group by 1, 2),
pairs as (
  select sum(a.ev * b.n) as comparable,
    sum(case when a.risk > b.risk then a.ev * b.n end) as concordant,
    sum(case when a.risk = b.risk then a.ev * b.n end) as tied
  from cells a join cells b on a.t < b.t
  union all
  select sum(a.ev * (b.n - b.ev)), sum(case when a.risk > b.risk then a.ev * (b.n - b.ev) end),
    sum(case when a.risk = b.risk then a.ev * (b.n - b.ev) end)
  from cells a join cells b on a.t = b.t
),
total as (select cast(sum(comparable) as bigint) as comparable, cast(sum(concordant) as bigint) as concordant,
          cast(sum(tied) as bigint) as tied from pairs)
select *, (concordant + tied / cast(2 as double)) / comparable as c_index from total"""


_LOAN_RULES = {
    "loan_amnt": "loan_amnt > 0",
    "int_rate": "int_rate > 0 and int_rate < 100",
    "grade": "grade in ('A','B','C','D','E','F','G')",
    "emp_length_years": "emp_length_years between 0 and 50",
    "annual_inc": "annual_inc >= 0",
    "dti": "dti between 0 and 100",
    "fico_range_low": "fico_range_low between 300 and 850",
    "open_acc": "open_acc >= 0",
    "revol_util": "revol_util between 0 and 100",
    "total_acc": "total_acc >= 0",
    "inq_last_6mths": "inq_last_6mths >= 0",
    "pub_rec": "pub_rec >= 0",
    "term_months": "term_months in (36, 60)",
}
_broken = ", ".join(
    f"case when not coalesce({r}, false) then '{n}' end" for n, r in _LOAN_RULES.items()
)
_clean_doubles = [
    "int_rate", "revol_util", "emp_length_years", "dti", "open_acc", "total_acc",
    "inq_last_6mths", "pub_rec", "annual_inc",
]

ORACLES = {
    "loan_parse": sql(
        f"""with {PARSED_CTE.strip()}
select loan_id, cast(issue_d as varchar) as issue_d, cast(last_pymnt_d as varchar) as last_pymnt_d,
int_rate, revol_util, term_months, emp_length_years from parsed""",
        views=_views,
    ),
    "loan_clean": sql(
        f"with {CLEAN_CTE} select {', '.join(_CLEAN_COLUMNS)} from clean", _clean_doubles, _views
    ),
    "loan_events": sql(
        f"with {EVENTS_CTE} select loan_id, duration_months, event from events_rows", views=_views
    ),
    "loan_features": sql(
        f"""with {TABLE_CTE} select * replace (cast(grade_encoded as int) as grade_encoded) from tbl""",
        ["duration_months", *[c for c in loans.FEATURES if c not in ("grade_encoded", "term_months")]],
        _views,
    ),
    "grade_lookup": sql(
        """select loan_id, grade, cast(nullif(position(grade in 'ABCDEFG'), 0) as int) as grade_encoded
from loans""",
        views=_views,
    ),
    "validate_loans": sql(
        f"with {PARSED_CTE.strip()} select loan_id, concat_ws(',', {_broken}) as violations from parsed",
        views=_views,
    ),
    "loan_risk_tier": sql(
        f"select id, {_TIER.format(p='p')} as risk_tier, case when p < 0.05 then 1 else 0 end as low_risk from scored",
        views=["scored"],
    ),
    "kaplan_meier": sql(
        f"""with {TABLE_CTE}, {_km()}
select t, d, at_risk, s, coalesce(exp(log_s * exp(-spread)), s) as s_low,
coalesce(exp(log_s * exp(spread)), s) as s_high from curve""",
        ["t", "s", "s_low", "s_high"],
        _views,
    ),
    "median_survival": sql(
        f"""with {TABLE_CTE}, {_km("term_months")}
select term_months, min(case when s <= 0.5 + 1e-12 then t end) as median_t from curve group by 1""",
        views=_views,
    ),
    "interpolate_curve": sql(
        f"""with {TABLE_CTE}, {_km()},
q as (select loan_id, loan_amnt % 80 as months from tbl),
l as (select q.loan_id, q.months, c.t as lt, c.s as ls from q asof left join curve c on q.months >= c.t),
r as (select q.loan_id, c.t as rt, c.s as rs from q asof left join curve c on q.months <= c.t)
select l.loan_id, l.months, case when lt is null then rs when rt is null or lt = rt then ls
else ls + (rs - ls) * (l.months - lt) / (rt - lt) end as s
from l join r on l.loan_id = r.loan_id""",
        ["months", "s"],
        _views,
    ),
    "c_index": sql(_concordance("int_rate * loan_amnt"), ["c_index"], _views),
    "c_index_ties": sql(_concordance("int_rate"), ["c_index"], _views),
    "cox_hazard": sql(
        f"with {HAZARD_CTE} select loan_id, hazard_ratio from hz", ["hazard_ratio"], _views
    ),
    "baseline_hazard": sql(
        f"with {BASE_CTE} select t, d, risk_sum, h0, exp(-h0) as s0 from base",
        ["t", "risk_sum", "h0", "s0"],
        _views,
    ),
    "loan_scores": sql(
        f"""{SCORES}
select s.loan_id, s_12m, s_24m, s_36m, median_months, hazard_ratio, 1 - s_12m as pd_12m,
{_TIER.format(p='(1 - s_12m)')} as risk_tier, case when 1 - s_12m < 0.05 then 1 else 0 end as low_risk
from scored_loans s left join crossing c on s.loan_id = c.loan_id""",
        ["s_12m", "s_24m", "s_36m", "median_months", "hazard_ratio", "pd_12m"],
        _views,
    ),
    "survival_brier": sql(
        f"""{SCORES}
select avg((s_12m - alive) * (s_12m - alive)) as brier from (
select s_12m, case when event = 1 and duration_months <= 12 then 0.0::double else 1.0::double end as alive
from scored_loans) t""",
        ["brier"],
        _views,
    ),
}
