"""Customer segmentation: recency, frequency, monetary value, clusters and labels."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.parse import text_id, whole_days
from riskframe.functions.scores import HIGH_VALUE_SEGMENTS
from riskframe.operators.impute import keep_up_to_quantile
from riskframe.operators.ordering import quantile_values
from riskframe.operators.tiles import paired_distance_sums
from riskframe.session import cut_lineage

RFM = ["recency", "frequency", "monetary"]
LEAST_TILE_ROWS = 4_096

# Segment names by cluster rank, richest first.
SEGMENT_LABELS = {
    0: "Champions",
    1: "Loyal Customers",
    2: "At Risk",
    3: "New Customers",
    4: "Lost",
}


def clean_retail(lines: DataFrame) -> DataFrame:
    """Lines of known customers, not cancelled, with positive quantity and price."""
    return (
        lines.where(F.col("customer_id").isNotNull())
        .where(~F.col("invoice").startswith("C"))
        .where((F.col("quantity") > 0) & (F.col("price") > 0))
        .withColumn("customer_id", text_id(F.col("customer_id")))
        .withColumn("total_price", F.col("quantity") * F.col("price"))
    )


def rfm_table(clean: DataFrame, reference: Column | None = None) -> DataFrame:
    """One row per customer. ``reference`` defaults to the last purchase plus one day.

    The distinct invoice count is aggregated per (customer, invoice) before anything
    moves to the customer, so one huge customer does not make one huge task. Money is
    summed at six decimals: exact for prices of up to six, in any order of rows.
    """
    if reference is None:
        reference = clean.agg(
            (F.max("invoice_ts") + F.expr("interval 1 day")).alias("ref")
        ).scalar()
    return (
        clean.groupBy("customer_id")
        .agg(
            F.max("invoice_ts").alias("_last"),
            F.count_distinct("invoice").cast("double").alias("frequency"),
            F.sum(F.col("total_price").cast("decimal(30,6)")).cast("double").alias("monetary"),
        )
        .withColumn("_ref", reference)
        .withColumn("recency", whole_days(F.col("_ref"), F.col("_last")).cast("double"))
        .select("customer_id", *RFM)
    )


def rfm_features(lines: DataFrame, reference: Column | None = None) -> DataFrame:
    """Clean, aggregate and drop customers above the 99th percentile of value.

    The customer table is written once; the percentile and all later steps read it.
    """
    customers = cut_lineage(rfm_table(clean_retail(lines), reference), "rfm")
    return keep_up_to_quantile(customers, "monetary", 0.99)


def _scaled(df: DataFrame, centre_spread: Mapping[str, tuple[float, float]]) -> DataFrame:
    """(x - centre) / spread per column; a zero spread divides by 1."""
    return df.withColumns(
        {
            c: (F.col(c) - F.lit(float(m))) / F.lit(float(d) or 1.0)
            for c, (m, d) in centre_spread.items()
        }
    )


def robust_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """(x - median) / (q75 - q25)."""
    found = quantile_values(df if fit_on is None else fit_on, cols, [0.25, 0.5, 0.75])
    return _scaled(df, {c: (q[1], q[2] - q[0]) for c, q in found.items() if q[1] is not None})


def standardize(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population standard deviation."""
    stats = (
        (df if fit_on is None else fit_on)
        .agg(
            *[F.avg(c).alias(f"m_{c}") for c in cols],
            *[F.stddev_pop(c).alias(f"d_{c}") for c in cols],
        )
        .first()
    )
    return _scaled(
        df,
        {c: (stats[f"m_{c}"], stats[f"d_{c}"]) for c in cols if stats[f"m_{c}"] is not None},
    )


def assign_nearest(
    df: DataFrame, cols: Sequence[str], centroids: Sequence[Sequence[float]]
) -> DataFrame:
    """Adds ``cluster_id`` and ``sq_dist``; ties go to the lower id. No join: k centroids
    are literals."""
    choices = []
    for k, centre in enumerate(centroids):
        d = sum(
            ((F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v))) for c, v in zip(cols, centre)),
            F.lit(0.0),
        )
        choices.append(F.struct(d.alias("d"), F.lit(k).alias("k")))
    best = F.array_min(F.array(*choices))
    return (
        df.withColumn("_best", best)
        .withColumn("cluster_id", F.col("_best")["k"])
        .withColumn("sq_dist", F.col("_best")["d"])
        .drop("_best")
    )


def value_order(centroids: Sequence[Sequence[float]], value_index: int = 2) -> list[int]:
    """Cluster ids by falling centre value."""
    return sorted(range(len(centroids)), key=lambda k: (-centroids[k][value_index], k))


def label_of(rank: Column, labels: Mapping[int, str] = SEGMENT_LABELS) -> Column:
    """Segment name, or ``Cluster <id>`` beyond the known ones."""
    names = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.coalesce(F.try_element_at(names, rank), F.concat(F.lit("Cluster "), rank.cast("string")))


def is_high_value(label: Column) -> Column:
    return label.isin(*HIGH_VALUE_SEGMENTS)


def cluster_order(assigned: DataFrame, value: str = "monetary") -> DataFrame:
    """Clusters ranked by mean value, richest first (k rows)."""
    means = assigned.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean_value")
    )
    rank = F.row_number().over(
        Window.partitionBy(F.lit(0)).orderBy(F.col("mean_value").desc(), "cluster_id")
    )
    return means.withColumn("value_rank", rank - 1)


def rfm_score(
    scaled: DataFrame, ranges: Mapping[str, tuple[float, float]] | None = None
) -> DataFrame:
    """0.3 recency (inverted) + 0.3 frequency + 0.4 monetary, each min-max scaled.

    ``ranges`` ((lo, hi) per column) freezes the scale for streams; without it the scored
    table supplies it.
    """
    if ranges is None:
        ranges = rfm_ranges(scaled)

    def unit(c: str) -> Column:
        lo, hi = ranges[c]
        return (F.col(c) - F.lit(lo)) / F.lit(hi - lo + 1e-9)

    return scaled.withColumn(
        "rfm_score",
        (1 - unit("recency")) * 0.3 + unit("frequency") * 0.3 + unit("monetary") * 0.4,
    )


def rfm_ranges(scaled: DataFrame) -> dict[str, tuple[float, float]]:
    row = scaled.agg(
        *[F.min(c).alias(f"lo_{c}") for c in RFM], *[F.max(c).alias(f"hi_{c}") for c in RFM]
    ).first()
    return {c: (row[f"lo_{c}"] or 0.0, row[f"hi_{c}"] or 0.0) for c in RFM}


def inertia(assigned: DataFrame) -> DataFrame:
    return assigned.agg(F.sum("sq_dist").alias("inertia"))


def silhouette_exact(
    assigned: DataFrame, id_col: str, cols: Sequence[str], rows_per_tile: int = 65_536
) -> DataFrame:
    """Mean Euclidean silhouette, one row.

    Work is quadratic by definition. Pairs of tiles of bounded size meet once each and return one
    distance sum per row and cluster for both sides, never pairs. For very large tables use
    :func:`silhouette_squared`.
    """
    import pandas as pd

    cols = list(cols)
    fields = [f"x{i}" for i in range(len(cols))]
    data = cut_lineage(
        assigned.select(
            F.col(id_col).alias("id"), F.col("cluster_id").cast("int").alias("own"), *[F.col(c).cast("double").alias(f) for c, f in zip(cols, fields)]
        ),
        "silhouette",
    )
    sizes = data.where("own is not null").groupBy("own").count().orderBy("own").collect()  # clusters
    if not sizes:
        return _silhouette(data.select("id", "own", F.col("own").alias("cluster_id"), F.lit(0).alias("n"), F.lit(0.0).alias("total")).limit(0))
    clusters = [r["own"] for r in sizes]
    totals = [f"t{k}" for k in range(len(clusters))]
    n, cores = data.count(), assigned.sparkSession.sparkContext.defaultParallelism
    # Smaller tiles where few rows would leave cores idle.
    parts = max(-(-n // rows_per_tile), min(-(-n // LEAST_TILE_ROWS), 2 * math.isqrt(2 * cores) + 1))

    def distance_sums(rows: pd.DataFrame) -> pd.DataFrame:
        # Rows without a cluster are nobody's neighbours.
        codes = pd.Categorical(rows["own"], categories=clusters).codes
        rows = rows.assign(code=np.where(codes < 0, len(clusters), codes)).sort_values("code", kind="stable")
        i, j = int(rows["i"].iloc[0]), int(rows["j"].iloc[0])
        sides = [rows[rows["part"] == p] for p in ((i,) if i == j else (i, j))]
        sums = paired_distance_sums(*[(side[fields].to_numpy(float), side["code"].to_numpy()) for side in sides], clusters=len(clusters) + 1)
        out = [side[["id", "own"]].assign(**{t: total[:, k] for k, t in enumerate(totals)}) for side, total in zip(sides, sums)]
        return pd.concat(out)

    part, other = F.col("part"), F.col("other")
    pairs = (
        data.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        .select("id", "own", *fields, "part", F.least(part, other).alias("i"), F.greatest(part, other).alias("j"))
        .repartition(parts * (parts + 1) // 2, "i", "j")
    )
    id_type = dict(data.dtypes)["id"]
    partial = pairs.groupBy("i", "j").applyInPandas(distance_sums, f"id {id_type}, own int, {', '.join(f'{t} double' for t in totals)}")
    per_cluster = [
        F.struct(F.lit(r["own"]).alias("cluster_id"), F.lit(r["count"]).alias("n"), F.col(t).alias("total")) for r, t in zip(sizes, totals)
    ]
    per_row = partial.groupBy("id", "own").agg(*[F.sum(t).alias(t) for t in totals]).select("id", "own", F.inline(F.array(*per_cluster)))
    return _silhouette(per_row)


def silhouette_squared(assigned: DataFrame, id_col: str, cols: Sequence[str]) -> DataFrame:
    """Mean silhouette under squared Euclidean distance, one row, in linear time.

    sum over y in C of |x-y|^2 = n|x|^2 - 2 x.S + Q with per-cluster n, S, Q; the k
    cluster rows are gathered into one array.
    """
    norm = sum((F.col(c) * F.col(c) for c in cols), F.lit(0.0))
    stats = assigned.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(norm).alias("q"),
        *[F.sum(c).alias(f"s_{c}") for c in cols],
    )
    table = stats.agg(F.collect_list(F.struct(*stats.columns))).scalar()
    rows = assigned.select(F.col("cluster_id").alias("own"), *cols, norm.alias("x2"), table.alias("clusters"))

    def total(k: Column) -> Column:
        cross = sum((F.col(c) * k[f"s_{c}"] for c in cols), F.lit(0.0))
        return k["n"] * F.col("x2") - 2 * cross + k["q"]

    own = F.filter("clusters", lambda k: k["cluster_id"] == F.col("own"))[0]
    others = F.filter("clusters", lambda k: k["cluster_id"] != F.col("own"))
    a = F.when(own["n"] > 1, total(own) / (own["n"] - 1))
    b = F.array_min(F.transform(others, lambda k: total(k) / k["n"]))
    value = F.when(own["n"] == 1, F.lit(0.0)).otherwise((b - a) / F.greatest(a, b))
    return rows.agg(F.avg(value).alias("silhouette"), F.count(F.lit(1)).alias("n"))


def _silhouette(per_row: DataFrame) -> DataFrame:
    """From distance sums per (row, cluster); a row alone in its cluster scores 0."""
    own = F.col("own") == F.col("cluster_id")
    s = per_row.groupBy("id").agg(
        F.max(F.when(own, F.col("n"))).alias("own_n"),
        F.max(F.when(own & (F.col("n") > 1), F.col("total") / (F.col("n") - 1))).alias("a"),
        F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b"),
    )
    value = F.when(F.col("own_n") == 1, F.lit(0.0)).otherwise(
        (F.col("b") - F.col("a")) / F.greatest("a", "b")
    )
    return s.agg(F.avg(value).alias("silhouette"), F.count(F.lit(1)).alias("n"))
