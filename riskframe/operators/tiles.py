"""Work on two row sets in square tiles of bounded size."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import cut_lineage


def tile_join(
    left: DataFrame,
    right: DataFrame,
    id_col: str,
    fn: Callable,
    schema: str,
    rows_per_tile: int = 2048,
) -> DataFrame:
    """Run ``fn(left_part, right_part)`` on every tile (i, j).

    Both sides are hashed into parts of about ``rows_per_tile`` rows; a task sees one
    part of each, so memory is bounded whatever the data looks like. ``fn`` must reduce
    (per-row sums, per-row top k): no pair ever becomes a row.
    """

    def parts(df: DataFrame) -> int:
        return max(-(-df.count() // rows_per_tile), 1)

    def part(p: int):
        return F.pmod(F.xxhash64(id_col), F.lit(p)).cast("int")

    def every(p: int):
        return F.explode(F.sequence(F.lit(0), F.lit(p - 1)))

    i_parts = parts(left)
    j_parts = i_parts if right is left else parts(right)
    # New column identities on the right, so that a table tiled with itself is not pruned
    # by the needs of only one side.
    right = right.select(*[F.col(c).alias(c) for c in right.columns])
    l_rows = left.select("*", part(i_parts).alias("_i"), every(j_parts).alias("_j"))
    r_rows = right.select("*", part(j_parts).alias("_j"), every(i_parts).alias("_i"))
    return l_rows.groupBy("_i", "_j").cogroup(r_rows.groupBy("_i", "_j")).applyInPandas(fn, schema)


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared Euclidean distances of one tile, summed dimension by dimension."""
    d = np.zeros((len(a), len(b)))
    for i in range(a.shape[1]):
        gap = a[:, i][:, None] - b[:, i][None, :]
        d += gap * gap
    return d


# Distances at once: 1 MB, near a core.
CACHE_ROWS, CACHE_COLUMNS = 256, 512


def _runs(codes: np.ndarray, most: int) -> list[tuple[int, int, int]]:
    """(code, start, end) of the pieces of sorted codes, of one code and at most so many rows each."""
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])[: len(codes)]).tolist()
    return [(int(codes[a]), i, min(i + most, b)) for a, b in zip(first, [*first[1:], len(codes)]) for i in range(a, b, most)]


def paired_distance_sums(
    left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray] | None = None, *, clusters: int
) -> list[np.ndarray]:
    """Per side and row the sums of Euclidean distances to the rows of each cluster of the other side.

    A side is its places and its sorted cluster codes; one side alone meets itself. Every distance
    serves both of its ends."""
    alone = right is None
    right = left if alone else right
    (x, own), (y, other) = left, right
    x, y = np.ascontiguousarray(x), np.ascontiguousarray(y.T)
    to_left, to_right = np.zeros((len(own), clusters)), np.zeros((clusters, len(other)))
    columns = _runs(other, CACHE_COLUMNS)
    ones = np.ones(max(CACHE_ROWS, CACHE_COLUMNS))
    buffers = np.empty((2, CACHE_ROWS * CACHE_COLUMNS))
    for a, i, i_end in _runs(own, CACHE_ROWS):
        rows = x[i:i_end]
        for b, j, j_end in columns:
            d, gap = (m[: len(rows) * (j_end - j)].reshape(len(rows), -1) for m in buffers)
            for c in range(x.shape[1]):
                to = gap if c else d
                np.subtract(rows[:, c : c + 1], y[c, j:j_end], out=to)
                np.multiply(to, to, out=to)
                if c:
                    np.add(d, gap, out=d)
            np.sqrt(d, out=d)
            to_left[i:i_end, b] += d @ ones[: j_end - j]
            if not alone:
                to_right[a, j:j_end] += ones[: len(rows)] @ d
    return [to_left] if alone else [to_left, to_right.T]


PIVOTS, PIVOT_SAMPLE = 48, 2000
PACK_TILES = 2048
# Rounding of distances never rules out a tile.
SLACK = 1e-9


def _pivots(points: DataFrame) -> np.ndarray:
    """Points far from each other, out of at most PIVOT_SAMPLE with the smallest hashes."""
    drawn = points.select("x").orderBy(F.xxhash64("x"), "x").limit(PIVOT_SAMPLE).collect()
    pool = np.array([r.x for r in drawn], float)
    if not len(pool):
        return pool
    chosen, near = [0], squared_distances(pool, pool[:1])[:, 0]
    while len(chosen) < min(PIVOTS, len(pool)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, squared_distances(pool, pool[chosen[-1:]])[:, 0])
    return pool[chosen]


def _best(d: np.ndarray, first: np.ndarray, ids: list, pid: np.ndarray, k: int) -> pd.DataFrame:
    """Per row of ``d`` the best k ids among the points of its finite columns, each with at most k ids.

    Only the k best points by (distance, smallest id) can hold one of the k best ids.
    """
    columns = np.argsort(first, kind="stable")
    order = columns[np.argsort(d[:, columns], axis=1, kind="stable")[:, :k]]
    rows = []
    for i, own in enumerate(order):
        found = sorted((d[i, j], n) for j in own if np.isfinite(d[i, j]) for n in ids[j][:k])[:k]
        rows += [(pid[i], n, float(np.sqrt(q))) for q, n in found]
    return pd.DataFrame(rows, columns=["pid", "neighbour", "dist"])


def _tiled(points: DataFrame, pivots: np.ndarray, rows_per_tile: int, schema: str) -> DataFrame:
    """Stored points with their distances to the pivots, in tiles of neighbours: points are sorted by
    nearest pivot and distance to it, and cut."""

    def measured(frames):
        for f in frames:
            d = np.sqrt(squared_distances(np.vstack(f["x"]), pivots)) if len(f) else np.zeros((0, len(pivots)))
            home = d.argmin(axis=1) if len(f) else []
            yield f.assign(far=list(d), home=home, to_home=d[np.arange(len(f)), home] if len(f) else [])

    def cut(frames):
        made = 0
        for f in frames:
            home, n = f["home"].to_numpy(), np.arange(len(f))
            first = np.append(True, home[1:] != home[:-1])[: len(f)]
            within = n - np.maximum.accumulate(np.where(first, n, 0)) if len(f) else n
            # A tile has one nearest pivot, so that it does not reach from one cluster to the next.
            numbers = made + np.cumsum(within % rows_per_tile == 0)
            made = int(numbers[-1]) if len(f) else made
            yield f.drop(columns=["home", "to_home"]).assign(tile=(TaskContext.get().partitionId() << 32) + numbers)

    placed = points.mapInPandas(measured, f"{schema}, far array<double>, home int, to_home double")
    place = ["home", "to_home", "pid"]
    return cut_lineage(
        placed.repartitionByRange(*place).sortWithinPartitions(*place).mapInPandas(cut, f"{schema}, far array<double>, tile bigint"), "tiles"
    )


def _meeting(tiled: DataFrame, reach: DataFrame, pivots: int) -> DataFrame:
    """(tile, other) for all pairs of different tiles where a point of ``other`` can be within the reach of
    a point of ``tile``: the gap between their ranges of distances to every pivot bounds the distance."""
    low = F.array(*[F.min(F.col("far")[p]) for p in range(pivots)]).alias("low")
    high = F.array(*[F.max(F.col("far")[p]) for p in range(pivots)]).alias("high")
    ranges = cut_lineage(tiled.groupBy("tile").agg(low, high).join(reach, "tile"), "ranges")
    packs = -(-ranges.count() // PACK_TILES) or 1
    # Packs of some thousand tiles meet all tiles one by one; a range is a few hundred bytes.
    packed = ranges.withColumn("pack", F.pmod(F.xxhash64("tile"), F.lit(packs))).groupBy("pack").agg(F.collect_list(F.struct("tile", "low", "high")).alias("others"))
    side = cut_lineage(packed, "packs")
    every = ranges.withColumn("pack", F.explode(F.sequence(F.lit(0), F.lit(packs - 1)).cast("array<bigint>")))
    pairs = every.join(F.broadcast(side) if packs <= BROADCAST_PACKS else side, "pack")

    def near(frames):
        for f in frames:
            out = []
            for tile, low, high, reach, others in zip(f["tile"], f["low"], f["high"], f["reach"], f["others"]):
                names = np.array([o["tile"] for o in others])
                gap = np.maximum(np.array([o["low"] for o in others]) - high, low - np.array([o["high"] for o in others])).max(axis=1)
                meets = names[(gap * (1 - SLACK) - SLACK <= reach) & (names != tile)]
                out.append(pd.DataFrame({"tile": tile, "other": meets}))
            yield pd.concat(out) if out else pd.DataFrame({"tile": [], "other": []})

    return cut_lineage(pairs.mapInPandas(near, "tile bigint, other bigint"), "meeting")


BROADCAST_PACKS = 8


def nearest_neighbours(
    df: DataFrame, id_col: str, cols: list[str], k: int, rows_per_tile: int = 2048, report: dict | None = None
) -> DataFrame:
    """The k nearest other rows of every row: id, rank (1..k), neighbour, dist.

    Exact; ties go to the lower id; rows with a null component are no neighbours and have none.
    Equal points are one entry with their k + 1 smallest ids, so copies cost nothing. Points are
    sorted by nearest pivot and cut into tiles; a tile is searched in itself first, which gives each
    point a reach (the distance of its k-th neighbour so far), and then in the tiles that the
    triangle inequality does not rule out. A pair of tiles returns at most k ids per point. ``report``
    takes the number of tile pairs visited and of all.
    """
    data = df.select(F.col(id_col).alias("id"), F.transform(F.array(*cols), lambda v: v.cast("double") + 0.0).alias("x"))
    data = cut_lineage(data.where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v))), "points")
    id_type = dict(data.dtypes)["id"]
    schema = f"pid {id_type}, x array<double>, ids array<{id_type}>"
    rank = F.row_number().over(Window.partitionBy("x").orderBy("id"))
    first = data.withColumn("r", rank).where(F.col("r") <= k + 1)
    points = first.groupBy("x").agg(F.min("id").alias("pid"), F.sort_array(F.collect_list("id")).alias("ids"))
    points = cut_lineage(points.select("pid", "x", "ids"), "distinct-points")
    pivots = _pivots(points)
    found_schema = f"pid {id_type}, neighbour {id_type}, dist double"
    if not len(pivots):
        return df.sparkSession.createDataFrame([], f"id {id_type}, rank int, neighbour {id_type}, dist double")
    tiled = _tiled(points, pivots, rows_per_tile, schema)

    def within(f: pd.DataFrame) -> pd.DataFrame:
        d = squared_distances(np.vstack(f["x"]), np.vstack(f["x"]))
        np.fill_diagonal(d, np.inf)
        pid = f["pid"].to_numpy()
        return _best(d, pid, f["ids"].tolist(), pid, k)

    own = cut_lineage(tiled.groupBy("tile").applyInPandas(within, found_schema), "within")
    # With its copies a point may have k ids nearer than any other point.
    got = own.groupBy("pid").agg(F.sort_array(F.collect_list("dist")).alias("d"))
    copies = F.size("ids") - 1
    enough = F.when(copies >= k, 0.0).otherwise(F.coalesce(F.get("d", k - 1 - copies), F.lit(float("inf"))))
    reached = cut_lineage(tiled.select("tile", "pid", "ids").join(got, "pid", "left").select("tile", "pid", enough.alias("reach")), "reach")
    pairs = _meeting(tiled, reached.groupBy("tile").agg(F.max("reach").alias("reach")), len(pivots))
    if report is not None:
        tiles = tiled.select("tile").distinct().count()
        report |= {"visited": pairs.count() + tiles, "all": tiles * tiles}

    def across(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"pid": [], "neighbour": [], "dist": []})
        # Only points whose own reach goes into the other tile.
        far, other = np.vstack(left["far"]), np.vstack(right["far"])
        gap = np.maximum(other.min(axis=0) - far, far - other.max(axis=0)).max(axis=1)
        left = left[gap * (1 - SLACK) - SLACK <= left["reach"].to_numpy()]
        if left.empty:
            return pd.DataFrame({"pid": [], "neighbour": [], "dist": []})
        d = squared_distances(np.vstack(left["x"]), np.vstack(right["x"]))
        return _best(d, right["pid"].to_numpy(), right["ids"].tolist(), left["pid"].to_numpy(), k)

    asking = tiled.select("tile", "pid", "x", "far").join(reached.select("pid", "reach"), "pid").join(pairs, "tile")
    # New column identities, so that a table tiled with itself is told apart from itself.
    again = pairs.select(F.col("tile").alias("tile"), F.col("other").alias("other"))
    asked = tiled.select(F.col("tile").alias("other"), *[F.col(c).alias(c) for c in ("pid", "x", "far", "ids")]).join(again, "other")
    rest = asking.groupBy("tile", "other").cogroup(asked.groupBy("tile", "other")).applyInPandas(across, found_schema)
    order = Window.partitionBy("pid").orderBy("dist", "neighbour")
    best = own.unionByName(rest).withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)
    listed = best.groupBy("pid").agg(F.sort_array(F.collect_list(F.struct("dist", "neighbour"))).alias("near"))
    classes = points.join(listed, "pid", "left")
    zero = F.transform(F.filter("ids", lambda n: n != F.col("id")), lambda n: F.struct(F.lit(0.0).alias("dist"), n.alias("neighbour")))
    near = F.slice(F.concat(zero, F.coalesce("near", F.array().cast(f"array<struct<dist: double, neighbour: {id_type}>>"))), 1, k)
    return data.join(classes, "x").select("id", F.posexplode(near).alias("pos", "n")).select(
        "id", (F.col("pos") + 1).alias("rank"), "n.neighbour", "n.dist"
    )
