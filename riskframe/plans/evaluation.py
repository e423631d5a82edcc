"""Registered queries: score evaluation, run log and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.scores import at_or_above
from riskframe.operators import curves, metrics, quality
from riskframe.operators.ordering import quantile_values
from riskframe.plans.fixtures import table, view, view_on
from riskframe.plans.shape import rounded, sql
from riskframe.sources import runs
from riskframe.streaming import scoring


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "scored")


def _flagged(spark, sf) -> DataFrame:
    return _scored(spark, sf).withColumn("flag", at_or_above(F.col("p2"), 0.5))


def duplicate_ids(spark, sf):
    return quality.duplicate_ids(_scored(spark, sf), "user_id")


def table_check(spark, sf):
    checked = quality.table_check(_scored(spark, sf), "user_id", 5000)
    return checked.select(
        *[F.col(c).cast("int").alias(c) if t == "boolean" else F.col(c) for c, t in checked.dtypes]
    )


def threshold_flag(spark, sf):
    return _scored(spark, sf).select("id", at_or_above(F.col("p"), 0.25).alias("flag"))


def anomaly_flag(spark, sf):
    """Rows strictly above the 95th percentile of the negatives."""
    df = _scored(spark, sf)
    cut = quantile_values(df.where("y = 0"), ["p"], [0.95])["p"][0]
    return df.select("id", (F.col("p") > F.lit(cut)).cast("int").alias("anomaly"))


def pr_curve(spark, sf):
    curve = curves.pr_curve(_scored(spark, sf), "p", "y")
    return rounded(curve.select("threshold", "precision", "recall"), 9)


def roc_curve(spark, sf):
    return rounded(curves.roc_curve(_scored(spark, sf), "p", "y"), 9)


def average_precision(spark, sf):
    return rounded(curves.average_precision(_scored(spark, sf), "p", "y"))


def roc_auc(spark, sf):
    return rounded(curves.roc_auc(_scored(spark, sf), "p", "y"))


def ks_statistic(spark, sf):
    return rounded(curves.ks_statistic(_scored(spark, sf), "p", "y"))


def best_threshold(spark, sf):
    return rounded(
        curves.best_threshold(_scored(spark, sf), "p2", "y").select(
            "threshold", "f1", "precision", "recall"
        )
    )


def threshold_gain(spark, sf):
    return rounded(curves.threshold_gain(_scored(spark, sf), "p2", "y"))


def model_comparison(spark, sf):
    return rounded(curves.model_comparison(_scored(spark, sf), ["p", "p2"], "y"))


def brier_score(spark, sf):
    return rounded(metrics.brier_score(_scored(spark, sf), "p2", "y"))


def calibration_curve(spark, sf):
    return rounded(curves.calibration_curve(_scored(spark, sf), "p2", "y"))


def confusion_matrix(spark, sf):
    return rounded(metrics.confusion_matrix(_flagged(spark, sf), "y", "flag"))


def classification_report(spark, sf):
    return rounded(metrics.classification_report(_flagged(spark, sf), "y", "flag"))


def error_cost(spark, sf):
    return rounded(metrics.error_cost(_flagged(spark, sf), "y", "flag"))


def outcome_profile(spark, sf):
    return rounded(metrics.outcome_profile(_flagged(spark, sf), "y", "flag", ["p", "p2"]))


def density_histogram(spark, sf):
    df = _scored(spark, sf).withColumn("hours", F.col("id") / 3600)
    return rounded(metrics.density_histogram(df, "hours", 0.0, 2.0, 20, ["y"]))


def ecdf(spark, sf):
    return rounded(curves.ecdf(_scored(spark, sf), "p", ["y"]), 9)


def box_stats(spark, sf):
    return rounded(metrics.box_stats(_scored(spark, sf), "p", ["y"]))


def latest_run(spark, sf):
    log = view(spark, sf, "runs").withColumn("event", F.col("step"))
    return runs.latest(log, "event").select(
        "pipeline", "metric", "value", F.col("ts").cast("string").alias("ts")
    )


def best_step(spark, sf):
    return runs.best_step(view(spark, sf, "runs"), "val_loss")



def _stream(spark, sf) -> DataFrame:
    schema = table(spark, sf, "events").schema
    events = scoring.read_stream(spark, f"{sf}/events.parque[t]", schema)
    return view_on(spark, "scored", events=events)


def _split_stream(spark, sf):
    rules = {"p": quality.within("p", 0.01, 1.0), "age": quality.within("age", 18, 80)}
    return scoring.split_stream(_stream(spark, sf), rules, scoring.label_scores, "stream")


def stream_scores(spark, sf):
    """The event stream through validation and scoring, drained to a table."""
    return rounded(_split_stream(spark, sf)[0].select("id", "p", "flag", "risk_label"))


def stream_rejected(spark, sf):
    """The rows that the same stream rejects, with the rules they break."""
    rejected = _split_stream(spark, sf)[1]
    return rejected.select("id", F.array_join("violations", ",").alias("violations"))


def stream_unique_ids(spark, sf):
    """Rows left after repeats of an id within the watermark are dropped, as the stream wrote them."""
    first = scoring.first_per_id(_stream(spark, sf), "ts", "user_id")
    return scoring.run_to_table(first.select("user_id"), "unique")


def stream_summary(spark, sf):
    """Hourly counts per label; every event counts, also in windows that are still open."""
    labelled = scoring.label_scores(_stream(spark, sf), "p2")
    out = scoring.summary_to_table(scoring.windowed_summary(labelled, "ts", "risk_label"), "hourly")
    return out.select(
        F.col("window_start").cast("string").alias("window_start"), "risk_label", "n"
    )


QUERIES = {
    f.__name__: f
    for f in (
        duplicate_ids, table_check, threshold_flag, anomaly_flag, pr_curve, roc_curve,
        average_precision, roc_auc, ks_statistic, best_threshold, threshold_gain,
        model_comparison, brier_score, calibration_curve, confusion_matrix,
        classification_report, error_cost, outcome_profile, density_histogram, ecdf, box_stats,
        latest_run, best_step, stream_scores, stream_rejected, stream_unique_ids, stream_summary,
    )
}

_views = ["scored"]


def _curve(score: str) -> str:
    return f"""
g_{score} as (select {score} as threshold, sum(y) as pos, count(*) as cnt from scored group by 1),
c_{score} as (
  select threshold, pos, cnt, sum(pos) over w as tp, sum(cnt) over w as flagged,
    (select sum(y) from scored) as p_all, (select count(*) from scored) as n_all
  from g_{score} window w as (order by threshold desc)),
k_{score} as (
  select *, cast(tp as double) / cast(flagged as double) as precision,
    cast(tp as double) / cast(p_all as double) as recall,
    cast(flagged - tp as double) / cast(n_all - p_all as double) as fpr from c_{score}),
f_{score} as (select *, 2.0::double * precision * recall / (precision + recall + 1e-8) as f1 from k_{score}),
b_{score} as (select * from f_{score} order by f1 desc, threshold limit 1),
ap_{score} as (select sum(cast(pos as double) / p_all * precision) as average_precision from k_{score})""".strip()


_CELLS = """cells as (select
 count(*) filter (where y = 1 and p2 >= 0.5) as tp, count(*) filter (where y = 0 and p2 >= 0.5) as fp,
 count(*) filter (where y = 1 and p2 < 0.5) as fn, count(*) filter (where y = 0 and p2 < 0.5) as tn
 from scored)"""


def _compare(score: str) -> str:
    return f"""select '{score}' as model, average_precision, recall, precision, f1,
cast(p_all - tp as bigint) as fn, cast(flagged - tp as bigint) as fp, threshold
from b_{score}, ap_{score}"""


ORACLES = {
    "duplicate_ids": sql(
        "select user_id, count(*) as n from scored group by 1 having count(*) > 1", views=_views
    ),
    "table_check": sql(
        """select count(*) as n, count(distinct user_id) as n_ids, case when count(*) > 0 then 1 else 0 end as not_empty,
case when count(*) = count(distinct user_id) then 1 else 0 end as unique_ids,
case when count(*) <= 5000 then 1 else 0 end as within_cap from scored""",
        views=_views,
    ),
    "threshold_flag": sql(
        "select id, case when p >= 0.25 then 1 else 0 end as flag from scored", views=_views
    ),
    "anomaly_flag": sql(
        """select id, case when p > (select quantile_cont(p, 0.95) from scored where y = 0) then 1 else 0 end as anomaly
from scored""",
        views=_views,
    ),
    "pr_curve": sql(
        f"with {_curve('p')} select threshold, precision, recall from k_p",
        ["threshold", "precision", "recall"],
        _views,
        9,
    ),
    "roc_curve": sql(
        f"with {_curve('p')} select threshold, fpr, recall as tpr from k_p",
        ["threshold", "fpr", "tpr"],
        _views,
        9,
    ),
    "average_precision": sql(
        f"with {_curve('p')} select average_precision from ap_p", ["average_precision"], _views
    ),
    "roc_auc": sql(
        """with ranked as (select y, avg(r) over (partition by p) as r from
(select y, p, row_number() over (order by p) as r from scored) t)
select (sum(r) filter (where y = 1) - count(*) filter (where y = 1) * (count(*) filter (where y = 1) + 1) / 2.0::double)
/ (cast(count(*) filter (where y = 1) as double) * count(*) filter (where y = 0)) as roc_auc from ranked""",
        ["roc_auc"],
        _views,
    ),
    "ks_statistic": sql(
        f"with {_curve('p')} select max(recall - fpr) as ks from k_p", ["ks"], _views
    ),
    "best_threshold": sql(
        f"with {_curve('p2')} select threshold, f1, precision, recall from b_p2",
        ["threshold", "f1", "precision", "recall"],
        _views,
    ),
    "threshold_gain": sql(
        f"""with {_curve('p2')}, {_CELLS},
both_f1 as (select 2 * cells.tp / cast(2 * cells.tp + fp + fn as double) as f1_fixed,
2 * b_p2.tp / cast(flagged + p_all as double) as f1_best, threshold from b_p2, cells)
select *, f1_best - f1_fixed as gain from both_f1""",
        ["f1_fixed", "f1_best", "threshold", "gain"],
        _views,
    ),
    "model_comparison": sql(
        f"with {_curve('p')}, {_curve('p2')} {_compare('p')} union all {_compare('p2')}",
        ["average_precision", "recall", "precision", "f1", "threshold"],
        _views,
    ),
    "brier_score": sql("select avg((p2 - y) * (p2 - y)) as brier from scored", ["brier"], _views),
    "calibration_curve": sql(
        """select cast(greatest(ceil(p2 * 10), 1) - 1 as int) as bin, avg(y) as fraction_positive,
avg(p2) as mean_predicted, count(*) as n from scored group by 1""",
        ["fraction_positive", "mean_predicted"],
        _views,
    ),
    "confusion_matrix": sql(
        f"""with {_CELLS}, m as (
select 0 as actual, 0 as predicted, tn as n from cells union all select 0, 1, fp from cells
union all select 1, 0, fn from cells union all select 1, 1, tp from cells)
select *, ln(1 + cast(n as double)) as log_n from m""",
        ["log_n"],
        _views,
    ),
    "classification_report": sql(
        f"""with {_CELLS}, s as (
select '0' as class, tn / (tn + fn)::double as precision, tn / (tn + fp)::double as recall,
  2 * tn / (2 * tn + fn + fp)::double as f1, tn + fp as support, (select tn + fp + fn + tp from cells) as all_n from cells
union all select '1', tp / (tp + fp)::double, tp / (tp + fn)::double, 2 * tp / (2 * tp + fp + fn)::double,
  tp + fn, (select tn + fp + fn + tp from cells) from cells)
select class, precision, recall, f1, support from s
union all select 'accuracy', null, null, (tp + tn) / (tp + tn + fp + fn)::double, tp + tn + fp + fn from cells
union all select 'macro avg', avg(precision), avg(recall), avg(f1), max(all_n) from s
union all select 'weighted avg', sum(precision * support) / max(all_n), sum(recall * support) / max(all_n),
  sum(f1 * support) / max(all_n), max(all_n) from s""",
        ["precision", "recall", "f1"],
        _views,
    ),
    "error_cost": sql(
        f"""with {_CELLS}, c as (select fn, fp, fn * 100.0::double + fp * 5.0::double as cost,
(tp + fn) * 100.0::double as cost_without_model from cells)
select *, cost_without_model - cost as saving,
(cost_without_model - cost) / cost_without_model * 100 as saving_pct from c""",
        ["cost", "cost_without_model", "saving", "saving_pct"],
        _views,
    ),
    "outcome_profile": sql(
        """select case when y = 1 and p2 >= 0.5 then 'TP' when y = 0 and p2 >= 0.5 then 'FP'
when y = 1 then 'FN' else 'TN' end as outcome, count(*) as n, avg(p) as p_mean, avg(p2) as p2_mean,
stddev_pop(p) as p_std, stddev_pop(p2) as p2_std from scored group by 1""",
        ["p_mean", "p2_mean", "p_std", "p2_std"],
        _views,
    ),
    "density_histogram": sql(
        """with b as (select y, least(floor(id / 3600.0::double / 0.1::double), 19) as bin from scored
where id / 3600.0::double between 0 and 2),
c as (select y, cast(bin as int) as bin, count(*) as n from b group by all),
grid as (select y, sum(n) as total, cast(unnest(range(20)) as int) as bin from c group by y)
select g.y, g.bin, g.bin * 0.1::double as left_edge, coalesce(n, 0) as n,
coalesce(n, 0) / (total * 0.1::double) as density from grid g left join c on g.y = c.y and g.bin = c.bin""",
        ["left_edge", "density"],
        _views,
    ),
    "ecdf": sql(
        """with g as (select y, p as value, count(*) as n from scored group by all)
select y, value, sum(n) over (partition by y order by value) / cast(sum(n) over (partition by y) as double) as share from g""",
        ["value", "share"],
        _views,
        9,
    ),
    "box_stats": sql(
        """with q as (select y, quantile_cont(p, 0.25) as q25, quantile_cont(p, 0.5) as q50, quantile_cont(p, 0.75) as q75
from scored group by 1),
j as (select s.y, p, q25, q50, q75, p between q25 - 1.5::double * (q75 - q25) and q75 + 1.5::double * (q75 - q25) as inside
from scored s join q on s.y = q.y)
select y, q25, q50, q75, min(p) filter (where inside) as whisker_low, max(p) filter (where inside) as whisker_high,
count(*) filter (where not inside) as n_outliers from j group by all""",
        ["q25", "q50", "q75", "whisker_low", "whisker_high"],
        _views,
    ),
    "latest_run": sql(
        """select pipeline, metric, value, cast(ts as varchar) as ts from runs
qualify row_number() over (partition by pipeline, metric order by ts desc, step desc) = 1""",
        views=["runs"],
    ),
    "best_step": sql(
        """select run_id, step, value from runs where metric = 'val_loss'
qualify row_number() over (partition by run_id order by value, step) = 1""",
        views=["runs"],
    ),
    "stream_scores": sql(
        """select id, p, case when p >= 0.5 then 1 else 0 end as flag,
case when p >= 0.9 then 'HIGH' when p >= 0.5 then 'MEDIUM' else 'LOW' end as risk_label
from scored where p between 0.01 and 1 and age between 18 and 80""",
        ["p"],
        _views,
    ),
    "stream_rejected": sql(
        """select id, concat_ws(',', case when coalesce(p between 0.01 and 1, false) then null else 'p' end,
case when coalesce(age between 18 and 80, false) then null else 'age' end) as violations
from scored where not (coalesce(p between 0.01 and 1, false) and coalesce(age between 18 and 80, false))""",
        views=_views,
    ),
    "stream_unique_ids": sql("select distinct user_id from scored", views=_views),
    "stream_summary": sql(
        """select cast(date_trunc('hour', ts) as varchar) as window_start,
case when p2 >= 0.9 then 'HIGH' when p2 >= 0.5 then 'MEDIUM' else 'LOW' end as risk_label, count(*) as n
from scored
group by all""",
        views=_views,
    ),
}
