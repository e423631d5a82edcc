"""Registered queries: scans, retail cleaning, RFM and segmentation."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators import models, quality, rfm
from riskframe.operators.impute import keep_up_to_quantile
from riskframe.operators.ordering import exact_quantiles
from riskframe.plans.fixtures import table, view
from riskframe.plans.shape import rounded, sql
from riskframe.sources.model_store import session_store

# Centroids in robust-scaled RFM space.
CENTROIDS = [
    (-0.4, 1.2, 1.6),
    (-0.2, 0.5, 0.4),
    (0.9, 0.3, 0.3),
    (-0.3, -0.5, -0.5),
    (1.8, -0.8, -0.7),
]


def rfm_of(spark: SparkSession, sf: str) -> DataFrame:
    return rfm.rfm_features(view(spark, sf, "retail_lines"))


def scaled_rfm(spark: SparkSession, sf: str) -> DataFrame:
    return rfm.robust_scale(rfm_of(spark, sf), rfm.RFM)


def assigned_rfm(spark: SparkSession, sf: str) -> DataFrame:
    return rfm.assign_nearest(scaled_rfm(spark, sf), rfm.RFM, CENTROIDS)


def scan_filter(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .where((F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz")) & (F.col("l_quantity") < 24))
        .select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")
    )


def scan_pruned(spark, sf):
    return (
        table(spark, sf, "orders")
        .select("o_orderpriority", F.col("o_totalprice").cast("decimal(18,2)").alias("p"))
        .groupBy("o_orderpriority")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("p").cast("double").alias("total"))
    )


def retail_clean(spark, sf):
    return rounded(
        rfm.clean_retail(view(spark, sf, "retail_lines")).select(
            "line_key",
            "customer_id",
            "invoice",
            F.col("invoice_ts").cast("string").alias("invoice_ts"),
            "quantity",
            "price",
            "total_price",
        )
    )


def rfm_features(spark, sf):
    return rounded(rfm_of(spark, sf))


def p99_trim(spark, sf):
    return rounded(
        keep_up_to_quantile(table(spark, sf, "customer"), "c_acctbal", 0.99).select(
            "c_custkey", "c_acctbal"
        )
    )


def quantiles(spark, sf):
    q = exact_quantiles(
        table(spark, sf, "lineitem"),
        ["l_extendedprice", "l_quantity"],
        [0.01, 0.25, 0.5, 0.95, 0.99],
        ["l_returnflag"],
    )
    return rounded(
        q.select(
            "l_returnflag",
            "series",
            "n",
            *[F.col("q")[i].alias(f"q{p}") for i, p in enumerate((1, 25, 50, 95, 99))],
        )
    )


def robust_scale(spark, sf):
    return rounded(scaled_rfm(spark, sf))


def nearest_centroid(spark, sf):
    return rounded(assigned_rfm(spark, sf).select("customer_id", "cluster_id", "sq_dist"))


def segment_label(spark, sf):
    order = rfm.value_order(CENTROIDS)
    rank = {k: r for r, k in enumerate(order)}
    ranks = F.create_map(*[F.lit(x) for pair in rank.items() for x in pair])
    # One cluster more than there are names shows the fallback.
    label = rfm.label_of(F.try_element_at(ranks, F.col("cluster_id")))
    return assigned_rfm(spark, sf).select(
        "customer_id",
        "cluster_id",
        label.alias("segment"),
        rfm.is_high_value(label).cast("int").alias("high_value"),
        rfm.label_of(F.col("cluster_id") + 3).alias("shifted_label"),
    )


def cluster_order(spark, sf):
    return rounded(rfm.cluster_order(assigned_rfm(spark, sf)))


def cluster_inertia(spark, sf):
    return rounded(rfm.inertia(assigned_rfm(spark, sf)))


def rfm_score(spark, sf):
    return rounded(rfm.rfm_score(scaled_rfm(spark, sf)).select("customer_id", "rfm_score"))


def silhouette_exact(spark, sf):
    return rounded(rfm.silhouette_exact(assigned_rfm(spark, sf), "customer_id", rfm.RFM))


def silhouette_squared(spark, sf):
    return rounded(rfm.silhouette_squared(assigned_rfm(spark, sf), "customer_id", rfm.RFM))


def validate_customers(spark, sf):
    """The RFM table with signs flipped on some rows, so that rules break."""
    rows = rfm.rfm_table(rfm.clean_retail(view(spark, sf, "retail_lines")))
    key = F.col("customer_id").cast("long")
    broken = rows.withColumns(
        {
            "recency": F.when(key % 7 == 0, -F.col("recency")).otherwise(F.col("recency")),
            "frequency": F.when(key % 11 == 0, F.lit(float("nan"))).otherwise(F.col("frequency")),
            "monetary": F.when(key % 13 == 0, F.lit(None)).otherwise(F.col("monetary")),
        }
    )
    checked = quality.with_violations(broken, quality.customer_rules())
    return checked.select("customer_id", F.concat_ws(",", "violations").alias("violations"))


def _clusters(spark, sf):
    """Centroids and cost of the best of ten starts, fitted once a session."""
    key = f"kmeans-{hashlib.md5(sf.encode()).hexdigest()}"
    fit = lambda: models.fit_kmeans(scaled_rfm(spark, sf), rfm.RFM, 5, starts=10)
    return session_store(spark).load_or_fit(key, rfm.RFM, fit)


def kmeans_segments(spark, sf):
    centroids, cost = _clusters(spark, sf)
    order = rfm.value_order(centroids)
    ranked = [centroids[k] for k in order]
    return rounded(
        rfm.assign_nearest(scaled_rfm(spark, sf), rfm.RFM, ranked).select(
            "customer_id", "cluster_id", "sq_dist", F.lit(cost).alias("training_cost")
        )
    )


def project_2d(spark, sf):
    scaled = scaled_rfm(spark, sf)
    return rounded(models.project_2d(scaled, rfm.RFM).select("customer_id", "x", "y"))


def segment_customers(spark, sf):
    """Scale, assign, label, place and score in one projection; clusters in value order."""
    scaled = scaled_rfm(spark, sf)
    centroids, _ = _clusters(spark, sf)
    ranked = [centroids[k] for k in rfm.value_order(centroids)]
    placed = models.project_2d(rfm.assign_nearest(scaled, rfm.RFM, ranked), rfm.RFM, fit_on=scaled)
    scored = rfm.rfm_score(placed)
    label = rfm.label_of(F.col("cluster_id"))
    return rounded(
        scored.select(
            "customer_id",
            "cluster_id",
            label.alias("segment_label"),
            "x",
            "y",
            "rfm_score",
            rfm.is_high_value(label).alias("is_high_value"),
        )
    )


QUERIES = {
    f.__name__: f
    for f in (
        scan_filter, scan_pruned, retail_clean, rfm_features, p99_trim, quantiles, robust_scale,
        nearest_centroid, segment_label, cluster_order, cluster_inertia, rfm_score,
        silhouette_exact, silhouette_squared, validate_customers, kmeans_segments, project_2d,
        segment_customers,
    )
}

CLEAN = """
clean as (
  select *, quantity * price as total_price from retail_lines
  where customer_id is not null and substr(invoice,1,1) <> 'C' and quantity > 0 and price > 0
)"""
RFM_ALL = f"""{CLEAN},
rfm_all as (
  select cast(customer_id as varchar) as customer_id,
         cast(floor((epoch((select max(invoice_ts) + interval 1 day from clean))
                     - epoch(max(invoice_ts))) / 86400) as double) as recency,
         cast(count(distinct invoice) as double) as frequency,
         sum(total_price) as monetary
  from clean group by customer_id
)"""
RFM_CTE = f"""{RFM_ALL},
rfm as (
  select * from rfm_all where monetary <= (select quantile_cont(monetary, 0.99) from rfm_all)
)"""


def _scale(c: str) -> str:
    iqr = f"(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"
    return (
        f"({c} - (select median({c}) from rfm)) / "
        f"(select case when {iqr} = 0 then 1 else {iqr} end from rfm) as {c}"
    )


SCALED_CTE = f"""{RFM_CTE},
scaled as (select customer_id, {", ".join(_scale(c) for c in rfm.RFM)} from rfm)"""

_centres = ", ".join(f"({k}, {a}, {b}, {c})" for k, (a, b, c) in enumerate(CENTROIDS))
ASSIGNED_CTE = f"""{SCALED_CTE},
centres(k, cr, cf, cm) as (values {_centres}),
dists as (
  select customer_id, recency, frequency, monetary, k,
         (recency-cast(cr as double))*(recency-cast(cr as double))
         + (frequency-cast(cf as double))*(frequency-cast(cf as double))
         + (monetary-cast(cm as double))*(monetary-cast(cm as double)) as d
  from scaled, centres
),
assigned as (
  select customer_id, recency, frequency, monetary, cast(k as int) as cluster_id, d as sq_dist
  from dists qualify row_number() over (partition by customer_id order by d, k) = 1
)"""


def _silhouette(distance: str) -> str:
    return f"""
with {ASSIGNED_CTE.strip()},
sizes as (select cluster_id, count(*) as n from assigned group by 1),
totals as (
  select a.customer_id, a.cluster_id as own, b.cluster_id,
         sum({distance}) as total
  from assigned a, assigned b group by 1, 2, 3
),
parts as (
  select customer_id,
         max(case when own = t.cluster_id then n end) as own_n,
         max(case when own = t.cluster_id and n > 1 then total / (n - 1) end) as a,
         min(case when own <> t.cluster_id then total / n end) as b
  from totals t join sizes s on t.cluster_id = s.cluster_id group by 1
)
select avg(case when own_n = 1 then 0 else (b - a) / greatest(a, b) end) as silhouette,
       count(*) as n
from parts"""


_sq = (
    "(a.recency-b.recency)*(a.recency-b.recency) + (a.frequency-b.frequency)*(a.frequency-b.frequency)"
    " + (a.monetary-b.monetary)*(a.monetary-b.monetary)"
)
_retail = ["retail_lines"]
_value_rank = {k: r for r, k in enumerate(rfm.value_order(CENTROIDS))}
_names = " ".join(f"when {k} then '{rfm.SEGMENT_LABELS[r]}'" for k, r in _value_rank.items())
_shifted = " ".join(f"when {k} then '{v}'" for k, v in rfm.SEGMENT_LABELS.items())

ORACLES = {
    "scan_filter": sql(
        """select l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice from lineitem
where l_shipdate >= timestamp '1996-01-01' and l_quantity < 24"""
    ),
    "scan_pruned": sql(
        """select o_orderpriority, count(*) as n,
cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total from orders group by 1"""
    ),
    "retail_clean": sql(
        f"""with {CLEAN.strip()}
select line_key, cast(customer_id as varchar) as customer_id, invoice,
cast(invoice_ts as varchar) as invoice_ts, quantity, price, total_price from clean""",
        ["quantity", "price", "total_price"],
        _retail,
    ),
    "rfm_features": sql(f"with {RFM_CTE.strip()} select * from rfm", rfm.RFM, _retail),
    "p99_trim": sql(
        """select c_custkey, c_acctbal from customer
where c_acctbal <= (select quantile_cont(c_acctbal, 0.99) from customer)""",
        ["c_acctbal"],
    ),
    "quantiles": sql(
        " union all ".join(
            f"""select l_returnflag, '{c}' as series, count({c}) as n,
"""
            + ", ".join(f"quantile_cont({c}, {p / 100}) as q{p}" for p in (1, 25, 50, 95, 99))
            + " from lineitem group by 1"
            for c in ("l_extendedprice", "l_quantity")
        ),
        [f"q{p}" for p in (1, 25, 50, 95, 99)],
    ),
    "robust_scale": sql(f"with {SCALED_CTE.strip()} select * from scaled", rfm.RFM, _retail),
    "nearest_centroid": sql(
        f"with {ASSIGNED_CTE.strip()} select customer_id, cluster_id, sq_dist from assigned",
        ["sq_dist"],
        _retail,
    ),
    "segment_label": sql(
        f"""with {ASSIGNED_CTE.strip()},
named as (select customer_id, cluster_id, case cluster_id {_names} end as segment from assigned)
select *, case when segment in ('Champions', 'Loyal Customers') then 1 else 0 end as high_value,
case cluster_id + 3 {_shifted} else 'Cluster ' || cast(cluster_id + 3 as varchar) end
as shifted_label from named""",
        views=_retail,
    ),
    "cluster_order": sql(
        f"""with {ASSIGNED_CTE.strip()}
select cluster_id, count(*) as n, avg(monetary) as mean_value,
cast(row_number() over (order by avg(monetary) desc, cluster_id) - 1 as int) as value_rank
from assigned group by 1""",
        ["mean_value"],
        _retail,
    ),
    "cluster_inertia": sql(
        f"with {ASSIGNED_CTE.strip()} select sum(sq_dist) as inertia from assigned",
        ["inertia"],
        _retail,
    ),
    "rfm_score": sql(
        f"""with {SCALED_CTE.strip()},
lim as (select min(recency) rl, max(recency) rh, min(frequency) fl, max(frequency) fh,
        min(monetary) ml, max(monetary) mh from scaled)
select customer_id,
 (1 - (recency - rl) / (rh - rl + 1e-9)) * 0.3 + (frequency - fl) / (fh - fl + 1e-9) * 0.3
 + (monetary - ml) / (mh - ml + 1e-9) * 0.4 as rfm_score from scaled, lim""",
        ["rfm_score"],
        _retail,
    ),
    "silhouette_exact": sql(_silhouette(f"sqrt({_sq})"), ["silhouette"], _retail),
    "silhouette_squared": sql(_silhouette(_sq), ["silhouette"], _retail),
    "validate_customers": sql(
        f"""with {RFM_ALL.strip()},
broken as (
  select customer_id, case when cast(customer_id as bigint) % 7 = 0 then -recency else recency end as r,
         case when cast(customer_id as bigint) % 11 = 0 then cast('NaN' as double) else frequency end as f,
         case when cast(customer_id as bigint) % 13 = 0 then null else monetary end as m
  from rfm_all)
select customer_id, concat_ws(',',
  case when r is null or isnan(r) or isinf(r) or r < 0 then 'recency' end,
  case when f is null or isnan(f) or isinf(f) or f < 0 then 'frequency' end,
  case when m is null or isnan(m) or isinf(m) or m < 0 then 'monetary' end) as violations
from broken""",
        views=_retail,
    ),
}
