"""Registered queries: transactions, oversampling, anomaly scores and classifiers."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.scores import fraud_label
from riskframe.operators import curves, fraud, impute, metrics, models, quality, rfm, sampling
from riskframe.plans.fixtures import view
from riskframe.plans.shape import rounded, sql
from riskframe.session import cut_lineage, scratch_path
from riskframe.sources.model_store import session_store
from riskframe.sources.schemas import TRANSACTION_FEATURES
from riskframe.sources.tables import read_split, write_split

V = [f"v{i}" for i in range(1, 29)]
ID, LABEL = "txn_id", "class"
SMOTE_RATIO = 0.5


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "transactions")


def _valid(spark, sf) -> DataFrame:
    return fraud.valid_transactions(_raw(spark, sf), TRANSACTION_FEATURES)


def validate_transactions(spark, sf):
    checked = quality.with_violations(
        _raw(spark, sf), quality.transaction_rules(TRANSACTION_FEATURES)
    )
    return checked.select(ID, F.concat_ws(",", "violations").alias("violations"))


def class_balance(spark, sf):
    return rounded(metrics.class_balance(_raw(spark, sf), LABEL))


def imbalance(spark, sf):
    return rounded(metrics.imbalance(_raw(spark, sf), LABEL))


def class_weights(spark, sf):
    return rounded(metrics.class_weights(_raw(spark, sf), LABEL))


def describe_overall(spark, sf):
    return rounded(metrics.describe(_raw(spark, sf), [*TRANSACTION_FEATURES]))


def describe_by_class(spark, sf):
    return rounded(metrics.describe(_raw(spark, sf), [*TRANSACTION_FEATURES], [LABEL]))


def mean_diff_rank(spark, sf):
    return rounded(metrics.mean_differences(_raw(spark, sf), V, LABEL))


def corr_pairs(spark, sf):
    return rounded(metrics.correlations(_valid(spark, sf), [*TRANSACTION_FEATURES]))


def winsorize(spark, sf):
    cols = [*TRANSACTION_FEATURES]
    return rounded(impute.winsorize(cut_lineage(_valid(spark, sf), "valid"), cols, 0.01, 0.99).select(ID, *cols))


def standardize(spark, sf):
    return rounded(rfm.standardize(_valid(spark, sf), ["time_s", "amount"]).select(ID, "time_s", "amount"))


def centroid_distance(spark, sf):
    return rounded(metrics.centroid_distance(_valid(spark, sf), [*V, "amount", "time_s"], LABEL))


def stratified_split(spark, sf):
    return sampling.stratified_split(_raw(spark, sf).select(ID, LABEL), ID, LABEL)


def split_roundtrip(spark, sf):
    """Write the splits as partitions, read the test partition back."""
    split = sampling.stratified_split(_raw(spark, sf).select(ID, "v1", LABEL), ID, LABEL)
    path = scratch_path(spark, "splits")
    write_split(split, path, LABEL)
    return rounded(read_split(spark, path, "test", split.schema).select(ID, "v1", LABEL, "split"))


def sample_n(spark, sf):
    return sampling.sample_rows(view(spark, sf, "scored"), "id", 1234).select("id", "y")


def holdout_flag(spark, sf):
    return view(spark, sf, "scored").select(
        "id", sampling.holdout_flag("id").cast("int").alias("holdout")
    )


def minority_knn(spark, sf):
    minority = _raw(spark, sf).where(F.col(LABEL) == 1)
    near = sampling.nearest_neighbours(minority, ID, V, 5)
    return rounded(near.select("id", "rank", "neighbour", "dist"))


def smote_rows(spark, sf):
    made = sampling.smote(_raw(spark, sf), ID, LABEL, V, ratio=SMOTE_RATIO)
    return rounded(made.select("id", "i", "neighbour", "v1", "v2", "v28"))


def smote_counts(spark, sf):
    both = sampling.oversample(_raw(spark, sf), ID, LABEL, V, ratio=SMOTE_RATIO)
    return both.groupBy(LABEL, F.col("synthetic").cast("int").alias("synthetic")).agg(
        F.count(F.lit(1)).alias("n")
    )


def fraud_risk_label(spark, sf):
    return view(spark, sf, "scored").select("id", fraud_label(F.col("p2")).alias("risk_label"))


def _stored(spark, sf, name, columns, fit):
    """The session's model of these tables, fitted once."""
    key = f"{name}-{hashlib.md5(sf.encode()).hexdigest()}"
    return session_store(spark).load_or_fit(key, columns, fit)


def _reconstruction(spark, sf):
    train = sampling.stratified_split(_valid(spark, sf), ID, LABEL)
    train = cut_lineage(train, "split")
    normal = train.where((F.col("split") == "train") & (F.col(LABEL) == 0))
    fit = lambda: models.fit_reconstruction(normal, TRANSACTION_FEATURES, 8)
    return train, _stored(spark, sf, "reconstruction", TRANSACTION_FEATURES, fit)


def reconstruction_error(spark, sf):
    rows, model = _reconstruction(spark, sf)
    scored = fraud.with_error(rows, model)
    cut = fraud.anomaly_threshold(
        scored.where(F.col("split") == "test"), "reconstruction_error", LABEL
    )
    return rounded(
        scored.select(
            ID, "split", "reconstruction_error",
            (F.col("reconstruction_error") > F.lit(cut)).cast("int").alias("anomaly"),
        )
    )


_FEATURES = [*TRANSACTION_FEATURES, "reconstruction_error"]
# Trees, depth, rate, shares of rows and columns, and trees without improvement of the described model.
BOOSTED = dict(trees=500, depth=6, rate=0.05, row_share=0.8, column_share=0.8, patience=30, metric="ap")


def _classifier(spark, sf):
    """Enriched rows, the reconstruction and the boosted classifier of the training rows."""
    rows, model = _reconstruction(spark, sf)
    enriched = cut_lineage(fraud.with_error(rows, model), "enriched")
    train = enriched.where(F.col("split") == "train")
    fit = lambda: fraud.fit_classifier(train, ID, LABEL, _FEATURES, SMOTE_RATIO, **BOOSTED)
    return enriched, model, _stored(spark, sf, "fraud", _FEATURES, fit)


def fraud_gbt(spark, sf):
    enriched, _, fitted = _classifier(spark, sf)
    return rounded(models.score_with(fitted, enriched).select(ID, "split", "p"))


def fraud_scores(spark, sf):
    enriched, model, fitted = _classifier(spark, sf)
    test = models.score_with(fitted, enriched.where(F.col("split") == "test"))
    threshold = fraud.chosen_threshold(test, "p", LABEL)
    scored = fraud.score_transactions(enriched.drop("split", "reconstruction_error"), model, fitted, threshold)
    return rounded(
        scored.select(ID, "fraud_probability", "is_fraud", "reconstruction_error", "risk_label")
    )


def baseline_models(spark, sf):
    """Average precision and AUC of the three baselines on the test split."""
    rows = cut_lineage(sampling.stratified_split(_valid(spark, sf), ID, LABEL), "split")
    train, test = (rows.where(F.col("split") == s) for s in ("train", "test"))
    fitted = models.fit_baselines(train, TRANSACTION_FEATURES, ID, LABEL)
    scored = test
    for name, model in fitted.items():
        scored = models.score_with(model, scored, name)
    long = scored.select(
        LABEL,
        F.inline(
            F.array(*[F.struct(F.lit(n).alias("model"), F.col(n).alias("score")) for n in fitted])
        ),
    )
    long = cut_lineage(long, "scores")
    return rounded(
        curves.average_precision(long, "score", LABEL, ["model"]).join(
            curves.roc_auc(long, "score", LABEL, ["model"]), "model"
        )
    )


def feature_importance(spark, sf):
    """Of the model that scores transactions."""
    return rounded(models.feature_importance(_classifier(spark, sf)[2], spark))


QUERIES = {
    f.__name__: f
    for f in (
        validate_transactions, class_balance, imbalance, class_weights, describe_overall,
        describe_by_class, mean_diff_rank, corr_pairs, winsorize, standardize, centroid_distance,
        stratified_split, split_roundtrip, sample_n, holdout_flag, minority_knn, smote_rows,
        smote_counts, fraud_risk_label, reconstruction_error, fraud_gbt, fraud_scores,
        baseline_models, feature_importance,
    )
}

_views = ["transactions"]
_finite_rules = ", ".join(
    f"case when {c} is null or isnan({c}) or isinf({c}) then '{c}' end" for c in TRANSACTION_FEATURES
)
_VALID = """valid as (select * from transactions where not isnan(amount) and amount >= 0)"""


def _describe(cols, label=None) -> str:
    lead = f"{label}, " if label else ""
    group = f" group by {label}" if label else ""
    parts = []
    for c in cols:
        x = f"case when isnan({c}) then null else {c} end"
        parts.append(
            f"select {lead}'{c}' as series, count({x}) as n, avg({x}) as mean, stddev_samp({x}) as std, "
            f"min({x}) as min, quantile_cont({x}, 0.25) as q25, quantile_cont({x}, 0.5) as q50, "
            f"quantile_cont({x}, 0.75) as q75, max({x}) as max from transactions{group}"
        )
    return " union all ".join(parts)


_STATS = ["mean", "std", "min", "q25", "q50", "q75", "max"]
_diffs = " union all ".join(
    f"select '{c}' as feature, abs(avg({c}) filter (where class = 1) - avg({c}) filter (where class = 0)) as abs_diff from transactions"
    for c in V
)
_corrs = " union all ".join(
    f"select '{a}' as a, '{b}' as b, corr({a}, {b}) as corr from valid"
    for i, a in enumerate(TRANSACTION_FEATURES)
    for b in TRANSACTION_FEATURES[:i]
)
_winsor = ", ".join(
    f"least(greatest({c}, (select quantile_cont({c}, 0.01) from valid)), (select quantile_cont({c}, 0.99) from valid)) as {c}"
    for c in TRANSACTION_FEATURES
)
_all30 = [*V, "amount", "time_s"]
_scaled30 = ", ".join(
    f"({c} - (select avg({c}) from valid)) / (select stddev_pop({c}) from valid) as {c}" for c in _all30
)
_SPLIT = """
ranked as (
  select *, row_number() over (partition by class order by md5(cast(txn_id as varchar) || ':42')) as r,
         count(*) over (partition by class) as n from transactions),
split_rows as (select * exclude (r, n), case when r <= round(n * 0.2::double) then 'test' else 'train' end as split from ranked)"""
_d2 = " + ".join(f"(a.{c}-b.{c})*(a.{c}-b.{c})" for c in V)
_KNN = f"""
minority as (select * from transactions where class = 1),
knn as (
  select a.txn_id as id, b.txn_id as neighbour, sqrt({_d2}) as dist,
    cast(row_number() over (partition by a.txn_id order by sqrt({_d2}), b.txn_id) as int) as rank
  from minority a, minority b where a.txn_id <> b.txn_id
  qualify rank <= 5)"""
_SMOTE = f"""{_KNN.strip()},
sizes as (select count(*) filter (where class = 0) as maj, count(*) filter (where class = 1) as mn from transactions),
want as (select mn, greatest(cast(floor(maj * {SMOTE_RATIO}::double - mn) as bigint), 0) as total from sizes),
shares as (
  select txn_id as id, total // mn + case when row_number() over (order by md5(cast(txn_id as varchar) || ':42')) <= total % mn then 1 else 0 end as share
  from minority, want),
slots as (select id, unnest(range(1, share + 1)) as i from shares),
hashed as (select id, i, md5(cast(id as varchar) || ':' || cast(i as varchar) || ':42') as m from slots),
neighbours as (select id, max(rank) as k from knn group by 1),
chosen as (
  select h.id, i, cast(('0x' || substr(m, 1, 8))::bigint % k + 1 as int) as rank,
    ('0x' || substr(m, 9, 8))::bigint / 4294967296.0::double as u
  from hashed h join neighbours n on h.id = n.id),
made as (
  select c.id, c.i, k.neighbour, {", ".join(f"x.{c} + u * (y.{c} - x.{c}) as {c}" for c in ("v1", "v2", "v28"))}
  from chosen c join knn k on c.id = k.id and c.rank = k.rank
  join minority x on x.txn_id = c.id join minority y on y.txn_id = k.neighbour)"""

ORACLES = {
    "validate_transactions": sql(
        f"""select txn_id, concat_ws(',', {_finite_rules},
case when not isnan(amount) and amount < 0 then 'amount_negative' end) as violations from transactions""",
        views=_views,
    ),
    "class_balance": sql(
        """select class as label, count(*) as n,
count(*) / cast((select count(*) from transactions) as double) as share from transactions group by 1""",
        ["share"],
        _views,
    ),
    "imbalance": sql(
        """select count(*) filter (where class = 1) as n_pos, count(*) filter (where class = 0) as n_neg,
avg(class) as positive_rate,
count(*) filter (where class = 0) / cast(count(*) filter (where class = 1) as double) as neg_pos_ratio
from transactions""",
        ["positive_rate", "neg_pos_ratio"],
        _views,
    ),
    "class_weights": sql(
        """with c as (select class as label, count(*) as n from transactions group by 1)
select label, n, (select sum(n) from c) / ((select count(*) from c) * cast(n as double)) as balanced_weight,
case when label = 1 then (select n from c where label = 0) / cast(n as double) else 1.0::double end as pos_weight
from c""",
        ["balanced_weight", "pos_weight"],
        _views,
    ),
    "describe_overall": sql(_describe(TRANSACTION_FEATURES), _STATS, _views),
    "describe_by_class": sql(_describe(TRANSACTION_FEATURES, "class"), _STATS, _views),
    "mean_diff_rank": sql(
        f"""select feature, abs_diff,
cast(row_number() over (order by abs_diff desc, feature) as int) as rank from ({_diffs}) t""",
        ["abs_diff"],
        _views,
    ),
    "corr_pairs": sql(f"with {_VALID} {_corrs}", ["corr"], _views),
    "winsorize": sql(f"with {_VALID} select txn_id, {_winsor} from valid", [*TRANSACTION_FEATURES], _views),
    "standardize": sql(
        f"""with {_VALID}
select txn_id, (time_s - (select avg(time_s) from valid)) / (select stddev_pop(time_s) from valid) as time_s,
(amount - (select avg(amount) from valid)) / (select stddev_pop(amount) from valid) as amount from valid""",
        ["time_s", "amount"],
        _views,
    ),
    "centroid_distance": sql(
        f"""with {_VALID},
z as (select class, {_scaled30} from valid),
c as (select {", ".join(f"avg({c}) as {c}" for c in _all30)} from z where class = 0),
d as (select class as label, sqrt(({" + ".join(f"(z.{c}-c.{c})*(z.{c}-c.{c})" for c in _all30)}) / 30) as dist from z, c),
g as (select label, count(*) as n, avg(dist) as mean_distance, stddev_pop(dist) as std_distance from d group by 1)
select *, mean_distance / (select mean_distance from g where label = 0) as ratio from g""",
        ["mean_distance", "std_distance", "ratio"],
        _views,
    ),
    "stratified_split": sql(
        f"with {_SPLIT.strip()} select txn_id, class, split from split_rows", views=_views
    ),
    "split_roundtrip": sql(
        f"with {_SPLIT.strip()} select txn_id, v1, class, split from split_rows where split = 'test'",
        ["v1"],
        _views,
    ),
    "sample_n": sql(
        "select id, y from scored order by md5(cast(id as varchar) || ':42') limit 1234",
        views=["scored"],
    ),
    "holdout_flag": sql(
        """select id, case when ('0x' || substr(md5(cast(id as varchar) || ':42'), 1, 8))::bigint % 10000 < 1500
then 1 else 0 end as holdout from scored""",
        views=["scored"],
    ),
    "minority_knn": sql(
        f"with {_KNN.strip()} select id, rank, neighbour, dist from knn", ["dist"], _views
    ),
    "smote_rows": sql(f"with {_SMOTE} select * from made", ["v1", "v2", "v28"], _views),
    "smote_counts": sql(
        f"""with {_SMOTE}
select class, 0 as synthetic, count(*) as n from transactions group by 1
union all select 1, 1, count(*) from made""",
        views=_views,
    ),
    "fraud_risk_label": sql(
        "select id, case when p2 >= 0.90 then 'HIGH' when p2 >= 0.50 then 'MEDIUM' else 'LOW' end as risk_label from scored",
        views=["scored"],
    ),
}
