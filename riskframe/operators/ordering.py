"""Order-based work (running sums, exact quantiles, exact-size samples) that never
needs one task to see all rows.

The value range is cut at approximate percentiles into as many buckets as the
session has shuffle partitions. A bucket holds about 1/B of the rows whatever the
distribution, buckets are sorted in parallel, and only per-bucket totals meet in
one place. The cut points decide the balance, never the result: everything
computed here is exact.
"""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import BROADCAST_ROWS, cut_lineage, join_checked

MIN_BUCKETS = 64
# Partial sketches meet in this many tasks first, so the last one merges few.
SKETCH_GROUPS = 256
# A window over this many aggregated rows is light work for one task.
WINDOW_ROWS = 100_000
# A cell of an exact quantile is cut again while it holds more rows than this.
CELL_ROWS = 100_000
FINE_CELLS = 1024
TREE_LEAVES = 64


def bucket_count(df: DataFrame) -> int:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(n, MIN_BUCKETS)


def at_most(df: DataFrame, rows: int) -> bool:
    """True when ``df`` has at most ``rows`` rows; only a count reaches the driver."""
    return df.count() <= rows


def _sketch(column: Column, buckets: int) -> Column:
    probabilities = double_array([i / buckets for i in range(1, buckets)])
    return F.percentile_approx(column, probabilities, accuracy=10 * buckets)


def _cut_points(
    df: DataFrame, columns: Mapping[str, Column], buckets: int
) -> dict[str, list[float]]:
    """Per column, at most ``buckets`` - 1 approximate cut points.

    Sketches merge in two levels: groups of input partitions, then the cut points of all
    groups. That blurs the cut points a little, which only affects balance.
    """
    none = F.array().cast("array<double>")
    parts = df.groupBy((F.spark_partition_id() % SKETCH_GROUPS).alias("_g")).agg(
        *[F.coalesce(_sketch(c, buckets), none).alias(o) for o, c in columns.items()],
    )
    points = parts.select(F.inline(F.arrays_zip(*columns)))
    row = points.agg(*[_sketch(F.col(o), buckets).alias(o) for o in columns]).first()
    return {o: list(row[o] or []) for o in columns}


def double_array(values: Sequence[float]) -> Column:
    """An array literal; text keeps the plan small and folds to one constant."""
    if not values:
        return F.array().cast("array<double>")
    return F.split(F.lit(",".join(repr(v) for v in values)), ",").cast("array<double>")


def _literal(v: float) -> str:
    return f"double('{v!r}')"


def _search_tree(name: str, cuts: Sequence[float], lo: int, hi: int, strict: str) -> str:
    """Nested IFs that find how many of ``cuts[lo:hi]`` lie below, plus ``lo``."""
    if lo == hi:
        return str(lo)
    mid = (lo + hi) // 2
    below = _search_tree(name, cuts, mid + 1, hi, strict)
    above = _search_tree(name, cuts, lo, mid, strict)
    return f"if({_literal(cuts[mid])} {strict} {name}, {below}, {above})"


def count_below(name: str, cuts: Sequence[float], inclusive: bool = False) -> Column:
    """How many of the sorted distinct ``cuts`` are below column ``name`` (or equal to it).

    Up to 64 cuts: a tree of comparisons that stays in generated code. More: the tree
    picks one of 64 blocks, the rest is counted inside the block.
    """
    strict = "<=" if inclusive else "<"
    quoted = f"cast(`{name}` as double)"
    step = -(-(len(cuts) + 1) // TREE_LEAVES)
    coarse = list(cuts[step - 1 :: step])
    block = F.expr(_search_tree(quoted, coarse, 0, len(coarse), strict))
    if step == 1:
        return block
    value = F.col(name).cast("double")
    inside = F.slice(double_array(cuts), block * step + 1, F.lit(step - 1))
    test = (lambda e: e <= value) if inclusive else (lambda e: e < value)
    return F.coalesce(block * step + F.size(F.filter(inside, test)), F.lit(0))


def _bucket_of(name: str, cuts: Sequence[float]) -> Column:
    return count_below(name, sorted(set(cuts)))


def prefix_sum(
    df: DataFrame,
    order: str,
    sums: Mapping[str, str],
    by: Sequence[str] = (),
    descending: bool = False,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Running sums along ``order`` within ``by``; ``sums`` maps output name to input column.

    ``df`` must hold one row per (by, order), i.e. be aggregated already. Adds
    ``<out>`` (inclusive running sum) and ``<out>_total`` (sum over the group). The input
    is written once. Up to ``window_rows`` rows take a plain window, more are bucketed.
    """
    by = list(by)
    stored = cut_lineage(df, "prefix")

    def ordered(c: str) -> Column:
        return F.col(c).desc() if descending else F.col(c).asc()

    def group(*keys: str):
        return Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))

    if at_most(stored, window_rows):
        whole = group(*by)
        upto = whole.orderBy(ordered(order)).rowsBetween(Window.unboundedPreceding, 0)
        return stored.select(
            *df.columns,
            *[F.sum(c).over(upto).alias(o) for o, c in sums.items()],
            *[F.sum(c).over(whole).alias(f"{o}_total") for o, c in sums.items()],
        )
    position = F.col(order).cast("double")
    cuts = _cut_points(stored, {"order": position}, bucket_count(df))
    rows = stored.withColumn("_b", _bucket_of(order, cuts["order"]))
    # At most B rows per group: the windows below run over bucket totals only.
    totals = rows.groupBy(*by, "_b").agg(*[F.sum(c).alias(f"_{o}") for o, c in sums.items()])
    before = group(*by).orderBy(ordered("_b")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by,
        "_b",
        *[
            F.coalesce(F.sum(f"_{o}").over(before), F.lit(0)).alias(f"_before_{o}")
            for o in sums
        ],
        *[F.sum(f"_{o}").over(group(*by)).alias(f"{o}_total") for o in sums],
    )
    inside = (
        group(*by, "_b").orderBy(ordered(order)).rowsBetween(Window.unboundedPreceding, 0)
    )
    joined = rows.join(offsets, [*by, "_b"])
    return joined.select(
        *df.columns,
        *[(F.col(f"_before_{o}") + F.sum(c).over(inside)).alias(o) for o, c in sums.items()],
        *[f"{o}_total" for o in sums],
    )


def _coarse_cell(value: Column) -> Column:
    """A whole number that never falls as the value grows: about 1/128 of relative width each."""
    size = F.least(F.floor(F.log1p(F.abs(value) * 1e6) * 128), F.lit(1_000_000))
    return (F.signum(value) * size).cast("int")


def _fine_cell(value: Column, low: Column, high: Column) -> Column:
    """Likewise within [low, high]; both ends have a cell of their own."""
    share = F.nanvl((value - low) / (high - low), F.lit(0.5))
    inside = 1 + F.floor(share * (FINE_CELLS - 3)).cast("int")
    return F.when(value <= low, 0).when(value >= high, FINE_CELLS - 1).otherwise(inside)


def _join_null_safe(df: DataFrame, side: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join in which nulls are equal; the stored side is broadcast if it is small."""
    named = side.select(*[F.col(c).alias(f"_{c}_") for c in on], *[c for c in side.columns if c not in on])
    small = side.count() <= BROADCAST_ROWS
    same = [F.col(c).eqNullSafe(F.col(f"_{c}_")) for c in on]
    joined = df.join(F.broadcast(named) if small else named, reduce(operator.and_, same))
    return joined.drop(*[f"_{c}_" for c in on])


def as_of(df: DataFrame, at: str, points: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Adds structs ``before`` (the point with the greatest ``key`` <= ``at``) and ``after`` (the least
    ``key`` >= ``at``), with the key and ``cols``; null where there is none or ``at`` is null.

    Both sides may be of any size. Distinct values and points are one sequence, cut into buckets;
    within a bucket the last (next) point is carried along, and the points at the ends of buckets
    are carried across those without any. Points must be unique by ``key``.
    """
    point = F.struct(F.col(key).cast("double").alias(key), *cols)
    asked = df.select(F.col(at).cast("double").alias("_v"), F.lit(None).cast(points.select(point.alias("p")).schema["p"].dataType).alias("_p"))
    given = points.select(F.col(key).cast("double").alias("_v"), point.alias("_p"))
    marks = asked.where(F.col("_v").isNotNull() & ~F.isnan("_v")).unionByName(given).groupBy("_v").agg(F.max("_p").alias("_p"))
    marks = cut_lineage(marks, "marks")
    cuts = _cut_points(marks, {"v": F.col("_v")}, bucket_count(df))["v"]
    rows = marks.withColumn("_b", _bucket_of("_v", cuts))
    # A row per bucket: the first and last point in it.
    ends = rows.where("_p is not null").groupBy("_b").agg(F.min_by("_p", "_v").alias("_first"), F.max_by("_p", "_v").alias("_last"))
    ends = rows.select("_b").distinct().join(ends, "_b", "left")
    buckets = Window.partitionBy(F.lit(0)).orderBy("_b")
    ends = ends.select(
        "_b",
        F.last("_last", ignorenulls=True).over(buckets.rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"),
        F.first("_first", ignorenulls=True).over(buckets.rowsBetween(1, Window.unboundedFollowing)).alias("_coming"),
    )
    # Both from running frames: one that ends with its bucket is worked out anew for every row.
    inside, reverse = (Window.partitionBy("_b").orderBy(o).rowsBetween(Window.unboundedPreceding, 0) for o in (F.col("_v").asc(), F.col("_v").desc()))
    before = F.last("_p", ignorenulls=True).over(inside)
    after = F.last("_p", ignorenulls=True).over(reverse)
    found = rows.withColumns({"_before": before, "_after": after}).join(F.broadcast(ends), "_b")  # at most a row per bucket
    found = found.select(
        F.col("_v").alias("_at"), F.coalesce("_before", "_carried").alias("before"), F.coalesce("_after", "_coming").alias("after")
    )
    return join_checked(df.withColumn("_at", F.col(at).cast("double")), found, ["_at"], "left").drop("_at")


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Exact linearly interpolated quantiles, one row per (by, series).

    Output: ``by``, ``series`` (column name), ``n`` (non-null values) and ``q``, an
    array aligned with ``probs``. Null and NaN are skipped.

    Radix selection over cells of an order-preserving code, for all columns, groups and
    ranks at once. One pass counts rows per cell and keeps each cell's least and greatest
    value; running counts name the cells that hold a wanted rank. Cells of a single value
    are done. The others are cut again between their own least and greatest value, as often
    as any still holds more than ``cell_rows`` rows, and only then are values sorted, cell by
    cell. Counts combine before they shuffle, so a value or group of any size is one row, and
    only rows of wanted cells ever move. Nothing depends on the size of the table.
    """
    by, cols = list(by), list(cols)
    series = [F.struct(F.lit(c).alias("series"), F.nanvl(F.col(c).cast("double"), F.lit(None)).alias("value")) for c in cols]
    long = df.select(*by, F.inline(F.array(*series))).where(F.col("value").isNotNull())
    long = long.withColumn("_b", _coarse_cell(F.col("value")))
    key = [*by, "series"]
    group = Window.partitionBy(*key)
    measures = [F.count(F.lit(1)).alias("_n"), F.min("value").alias("_low"), F.max("value").alias("_high")]

    cells = (
        long.groupBy(*key, "_b")
        .agg(*measures)
        .withColumn("n", F.sum("_n").over(group))
        .withColumn("_before", F.sum("_n").over(group.orderBy("_b")) - F.col("_n"))
    )
    at = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    ranks = [(F.floor(a), F.ceil(a)) for a in at]

    def holds(rank: Column) -> Column:
        return (F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_n"))

    wanted = reduce(operator.or_, [holds(r) for pair in ranks for r in pair], F.lit(False))
    cells = cut_lineage(cells.where(wanted), "cells")
    done = cells.where("_low = _high").select(*key, "n", "_before", "_n", F.col("_low").alias("_value"))
    rows, place = long, [*key, "_b"]
    while True:
        open_ = cells.where("_low < _high").drop("_n")
        largest = cells.where("_low < _high").agg(F.max("_n")).first()[0]
        if largest is None:
            break
        picked = _join_null_safe(rows, cut_lineage(open_, "open-cells"), place)
        if largest <= cell_rows:
            within = Window.partitionBy(*place).orderBy("value")
            values = picked.groupBy(*place, "n", "_before", "value").agg(F.count(F.lit(1)).alias("_n"))
            values = values.withColumn("_before", F.col("_before") + F.sum("_n").over(within) - F.col("_n"))
            done = done.unionByName(values.select(*key, "n", "_before", "_n", F.col("value").alias("_value")))
            break
        # Rows of wanted cells only, so this table shrinks by the width of a cell each time.
        picked = picked.withColumn("_c", _fine_cell(F.col("value"), F.col("_low"), F.col("_high")))
        rows = cut_lineage(picked.select(*place, "n", "_before", "value", "_c"), "wanted-rows")
        fine = rows.groupBy(*place, "n", "_before", "_c").agg(*measures)
        inside = Window.partitionBy(*place).orderBy("_c")
        fine = fine.withColumn("_before", F.col("_before") + F.sum("_n").over(inside) - F.col("_n")).where(wanted)
        # A number per cell in place of the two codes; the next turn only needs it to tell cells apart.
        cells = cut_lineage(fine.withColumn("_b", F.struct("_b", "_c").cast("string")).drop("_c"), "cells")
        done = done.unionByName(cells.where("_low = _high").select(*key, "n", "_before", "_n", F.col("_low").alias("_value")))
        rows = rows.select(*key, F.struct("_b", "_c").cast("string").alias("_b"), "value")
    found = done.groupBy(*key, "n").agg(
        *[
            F.max(F.when(holds(r), F.col("_value"))).alias(f"_{i}_{side}")
            for i, pair in enumerate(ranks)
            for side, r in zip(("lo", "hi"), pair)
        ]
    )
    values = [
        F.when(F.col(f"_{i}_lo") == F.col(f"_{i}_hi"), F.col(f"_{i}_lo")).otherwise(
            F.col(f"_{i}_lo") + (F.col(f"_{i}_hi") - F.col(f"_{i}_lo")) * (a - F.floor(a))
        )
        for i, a in enumerate(at)
    ]
    return found.select(*key, "n", F.array(*values).alias("q"))


def approx_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int = 10000,
) -> DataFrame:
    """Same output as :func:`exact_quantiles` from one pass of mergeable sketches."""
    wide = df.groupBy(*by).agg(
        *[
            F.struct(
                F.lit(c).alias("series"),
                F.count(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias("n"),
                F.percentile_approx(
                    F.nanvl(F.col(c).cast("double"), F.lit(None)), list(probs), accuracy
                ).alias("q"),
            ).alias(f"_{i}")
            for i, c in enumerate(cols)
        ]
    )
    return wide.select(*by, F.inline(F.array(*[f"_{i}" for i in range(len(cols))])))


def quantile_values(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float]
) -> dict[str, list[float | None]]:
    """Exact quantiles of whole columns as numbers (one small row per column); None for an
    empty column. Fitted statistics become literals, so filters on them push down."""
    found = {r["series"]: list(r["q"]) for r in exact_quantiles(df, cols, probs).collect()}
    return {c: found.get(c, [None] * len(probs)) for c in cols}


def hash_cutoff(
    df: DataFrame, id_col: str, seed: int, size: Column, by: Sequence[str] = ()
) -> DataFrame:
    """The hash value at rank ``size`` per group, for exact-size seeded samples.

    ``size`` is an expression over ``n``, the group's row count. Output: ``by``,
    ``cutoff``; a row belongs to the sample when ``row_hash(id) <= cutoff``. Ids must
    be unique. Hashes are uniform, so their first four hex digits cut the rows into
    65,536 even buckets; one bucket per group is sorted.
    """
    by = list(by)
    rows = df.select(*by, row_hash(id_col, seed).alias("_h")).withColumn(
        "_b", F.conv(F.substring("_h", 1, 4), 16, 10).cast("int")
    )
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    cells = (
        rows.groupBy(*by, "_b")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("n", F.sum("_n").over(group))
        .withColumn("_want", size.cast("long"))
        .withColumn("_upto", F.sum("_n").over(group.orderBy("_b")))
        .where((F.col("_want") <= F.col("_upto")) & (F.col("_want") > F.col("_upto") - F.col("_n")))
        .select(*by, "_b", (F.col("_want") - F.col("_upto") + F.col("_n")).alias("_k"))
    )
    rank = F.row_number().over(Window.partitionBy(*by, "_b").orderBy("_h"))
    return (
        join_checked(rows, cells, [*by, "_b"])
        .withColumn("_r", rank)
        .where(F.col("_r") == F.col("_k"))
        .select(*by, F.col("_h").alias("cutoff"))
    )


def hash_cutoff_value(df: DataFrame, id_col: str, seed: int, size: Column) -> str:
    """:func:`hash_cutoff` of the whole table as text; below every hash when it is empty."""
    row = hash_cutoff(df, id_col, seed, size).first()
    return row["cutoff"] if row else ""


def row_hash(id_col: str, seed: int) -> Column:
    """Seeded order that any engine reproduces: md5 of ``id:seed``."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def hash_fraction(id_col: str, seed: int) -> Column:
    """Integer 0..9999 from the first eight hex digits of the row hash; needs no shuffle."""
    return F.conv(F.substring(row_hash(id_col, seed), 1, 8), 16, 10).cast("long") % 10000
