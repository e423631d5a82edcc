"""Exact mining of hard negatives, with bounds from angles to reference directions.

A row is a vector of whole numbers (``quantised``) with a label; its score for an anchor is the
inner product. An anchor's positives are its best rows of the same label; the negatives of a
positive are the best rows of other labels with a score between ``LOW_PERCENT`` percent of the
positive's and the positive's. Higher scores come first, then smaller ids.

Bounds. For every row the angles to ``REFERENCES`` fixed directions are stored (far apart, chosen
from a bounded sample of rows; they affect speed only). The angle between two rows lies between the
largest difference of their angles to a reference and the least sum, so the cosine lies in an
interval; times both norms it bounds the score. Angles are widened by ``ANGLE_SLACK`` and bounds by
more than a rounding error, so no row is lost to rounding.

Blocks. Rows are stored in order of (label, nearest reference, angle to it); a block is a run of them
with one label and reference, a group a run of anchors with one label, and both know the range of
their angles and norms. A block whose bounds miss the windows of a whole group is skipped. Otherwise
the bounds of single rows are compared with the anchors' windows, and only rows whose bounds overlap
one are scored. Windows shrink while a task runs: a row must beat the worst of the best found so far.
Positives take two turns: the block around each anchor gives first windows, which then decide on
all other blocks of the label.

Distribution. Rows stay where they are and are read once per turn and pass; the anchors of a pass, at
most ``PASS_BYTES``, go to every task, and the number of passes grows with the anchors. A task
returns its best rows per anchor (or positive), so what is shuffled does not grow with the rows
scored. Any number of rows may share a label or a vector: rows are dealt by ranges that end with the id.

Defined results: rows with a null id, label or vector, or with a null, infinite or NaN component
take no part. Of rows that share an id the one with the least label and vector does. Missing
components of shorter vectors count as 0. Anchors without positives, and positives without
negatives, have no rows. Other columns are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.ipc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import discard, store

REFERENCES, SAMPLE_ROWS = 16, 512
BLOCK_ROWS, GROUP_ROWS = 1024, 256
PASS_BYTES = 16 << 20
POSITIVES, NEGATIVES, LOW_PERCENT = 5, 5, 80
ANGLE_SLACK = 1e-6
_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
_BEST = pa.schema([(c, pa.int64()) for c in ("anchor", "positive", "aim", "id", "score")])


def quantised(vector: Column) -> Column:
    """floor(256 x) of every component, as longs."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("bigint"))


def valid_rows(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, q) of the rows that take part."""

    def fine(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    vector = F.col(vector_col)
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & vector.isNotNull())
    rows = rows.where(F.forall(vector, fine)).select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.struct(F.col(label_col).cast("int").alias("label"), quantised(vector).alias("q")).alias("row")
    )
    return rows.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.*")


def _matrix(column: pa.Array, width: int = 0) -> np.ndarray:
    """A list column as rows of equal length, shorter ones filled with 0."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    size = np.diff(offsets)
    width = max(width, int(size.max(initial=0)))
    out = np.zeros((len(size), width), flat.dtype)
    own = np.repeat(np.arange(len(size)), size)
    out[own, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], size)] = flat
    return out


def references(rows: DataFrame, number: int = REFERENCES, sample: int = SAMPLE_ROWS) -> np.ndarray:
    """Unit vectors far from each other, out of at most ``sample`` rows with the smallest hashed ids."""
    drawn = rows.select("q").where(F.exists("q", lambda x: x != 0)).orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    width = max((len(r.q) for r in drawn), default=1)
    pool = np.array([[*r.q, *[0] * (width - len(r.q))] for r in drawn], np.float64).reshape(-1, width)
    if not len(pool):
        return np.eye(1, width)
    pool /= np.linalg.norm(pool, axis=1, keepdims=True)
    chosen, nearest = [0], pool @ pool[0]
    for _ in range(min(number, len(pool)) - 1):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, pool @ pool[chosen[-1]])
    return pool[chosen]


def _described(q: Column, directions: np.ndarray) -> Column:
    @F.arrow_udf("norm double, angles array<double>, home int, to_home double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            x = _matrix(column).astype(np.float64)
            norm = np.sqrt((x * x).sum(axis=1))
            width = min(x.shape[1], directions.shape[1])
            cos = (x[:, :width] / np.maximum(norm, 1e-300)[:, None]) @ directions[:, :width].T
            angles = np.arccos(np.clip(cos, -1, 1))
            home = angles.argmin(axis=1)
            offsets = np.arange(len(x) + 1, dtype=np.int32) * len(directions)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(angles.ravel()))
            parts = [pa.array(norm), lists, pa.array(home, pa.int32()), pa.array(angles[np.arange(len(x)), home])]
            yield pa.StructArray.from_arrays(parts, ["norm", "angles", "home", "to_home"])

    return run(q)


def bounds(low: np.ndarray, high: np.ndarray, norm_low: np.ndarray, norm_high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score for angles in [low, high] and products of norms in [norm_low, norm_high]."""
    most, least = np.cos(np.maximum(low - ANGLE_SLACK, 0)), np.cos(np.minimum(high + ANGLE_SLACK, np.pi))
    upper = np.where(most > 0, norm_high, norm_low) * most
    lower = np.where(least > 0, norm_low, norm_high) * least
    slack = 1 + 1e-9 * norm_high
    return lower - slack, upper + slack


def interval(a_low: np.ndarray, a_high: np.ndarray, b_low: np.ndarray, b_high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest angle between members, from ranges of angles per reference (rows of each side)."""
    shape = (len(a_low), len(b_low))
    low, high = np.zeros(shape), np.full(shape, np.pi)
    for r in range(a_low.shape[1]):
        al, ah, bl, bh = a_low[:, r, None], a_high[:, r, None], b_low[None, :, r], b_high[None, :, r]
        np.maximum(low, np.maximum(al - bh, bl - ah), out=low)
        far, near = ah + bh, al + bl
        # Beyond a half turn the sum of two angles comes back.
        np.minimum(high, np.where(far <= np.pi, far, np.where(near >= np.pi, 2 * np.pi - near, np.pi)), out=high)
    return low, high


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * width
    if largest < 2**53:  # doubles hold every partial sum
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


class _Part:
    """Some rows (or anchors, with their aims) as arrays."""

    def __init__(self, batch: pa.RecordBatch | pa.Table):
        def column(name: str) -> pa.Array:
            c = batch.column(name)
            return c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c

        for name in ("vec_id", "label", "home", "to_home", "norm"):
            setattr(self, name, column(name).to_numpy(zero_copy_only=False))
        for name in ("q", "angles", "aims", "named"):
            if name in batch.schema.names:
                setattr(self, name, _matrix(column(name)))

    def cut(self, first: int, last: int) -> _Part:
        part = object.__new__(_Part)
        part.__dict__.update({k: v[first:last] for k, v in self.__dict__.items()})
        part.low, part.high = part.angles.min(axis=0), part.angles.max(axis=0)
        part.norms = part.norm.min(), part.norm.max()
        return part

    def runs(self, size: int, *by: str) -> Iterator[_Part]:
        """Parts of at most ``size`` consecutive rows that agree in the columns ``by``."""
        n = len(self.vec_id)
        new = np.arange(n) == 0
        for name in by:
            values = getattr(self, name)
            new[1:] |= values[1:] != values[:-1]
        edges = [*np.flatnonzero(new).tolist(), n]
        for first, last in zip(edges[:-1], edges[1:], strict=True):
            for at in range(first, last, size):
                yield self.cut(at, min(at + size, last))


class _Group:
    """Anchors of one label, the windows of their slots and the best rows found so far.

    A slot is an anchor when positives are sought, and one of its positives when negatives are."""

    def __init__(self, anchors: _Part, negatives: bool, keep: int):
        self.anchors, self.keep, self.label = anchors, keep, anchors.label[0]
        if negatives:
            # From LOW_PERCENT of the positive's score, rounded up, to that score; below 0 none.
            self.floor = np.where(anchors.aims >= 0, -(-LOW_PERCENT * anchors.aims // 100), _MOST)
            self.top = anchors.aims
        else:
            self.floor = anchors.aims[:, :1].copy()
            self.top = np.full(self.floor.shape, _MOST)
        self.slot = self.id = self.score = np.zeros(0, np.int64)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest useful score of every anchor."""
        live = self.floor <= self.top
        return np.where(live, self.floor, _MOST).min(axis=1), np.where(live, self.top, _LEAST).max(axis=1)

    def add(self, anchor: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        slots = self.floor.shape[1]
        for s in range(slots):
            useful = (score >= self.floor[anchor, s]) & (score <= self.top[anchor, s])
            if useful.any():
                self._keep(anchor[useful] * slots + s, ids[useful], score[useful])

    def _keep(self, slot: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        slot, ids, score = (np.concatenate(p) for p in ((self.slot, slot), (self.id, ids), (self.score, score)))
        order = np.lexsort((ids, -score, slot))
        slot, ids, score = slot[order], ids[order], score[order]
        first = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
        rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        stays = rank < self.keep
        self.slot, self.id, self.score = slot[stays], ids[stays], score[stays]
        full = rank[stays] == self.keep - 1
        floor = self.floor.reshape(-1)
        floor[self.slot[full]] = np.maximum(floor[self.slot[full]], self.score[full])


def _meet(group: _Group, block: _Part, wanted: str) -> np.ndarray | None:
    """Which (anchor, row) pairs need a score; None if ranges alone rule out all."""
    a = group.anchors
    if (group.label == block.label[0]) != (wanted != "other"):
        return None
    if wanted == "near":
        r, at = block.home[0], a.to_home
        near = (a.home == r) & (at >= block.low[r]) & (at <= block.high[r])
        return near[:, None] & (a.vec_id[:, None] != block.vec_id[None, :]) if near.any() else None
    least, most = group.windows()
    ranges = interval(a.low[None], a.high[None], block.low[None], block.high[None])
    lower, upper = bounds(*ranges, a.norms[0] * block.norms[0], a.norms[1] * block.norms[1])
    if upper[0, 0] < least.min() or lower[0, 0] > most.max():
        return None
    norms = a.norm[:, None] * block.norm[None, :]
    lower, upper = bounds(*interval(a.angles, a.angles, block.angles, block.angles), norms, norms)
    return (upper >= least[:, None]) & (lower <= most[:, None]) & (a.vec_id[:, None] != block.vec_id[None, :])


def _best_rows(shared: Broadcast, wanted: str, keep: int):
    """Sorted rows to the best of them for every slot, over the whole task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = _Part(pa.ipc.open_stream(shared.value).read_all())
        negatives = wanted == "other"
        groups = [_Group(part, negatives, keep) for part in anchors.runs(GROUP_ROWS, "label")]
        for batch in batches:
            for block in _Part(batch).runs(BLOCK_ROWS, "label", "home"):
                for group in groups:
                    need = _meet(group, block, wanted)
                    if need is None:
                        continue
                    own, of = np.flatnonzero(need.any(axis=1)), np.flatnonzero(need.any(axis=0))
                    if not len(own):
                        continue
                    scores = _products(group.anchors.q[own], block.q[of])
                    i, j = np.nonzero(need[np.ix_(own, of)])
                    group.add(own[i], block.vec_id[of[j]], scores[i, j])
        for group in groups:
            a, slots = group.anchors, group.floor.shape[1]
            anchor, s = group.slot // slots, group.slot % slots
            named, aim = (a.named[anchor, s], a.aims[anchor, s]) if negatives else (anchor * 0, anchor * 0)
            columns = [a.vec_id[anchor], named, aim, group.id, group.score]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_BEST)

    return run


def _search(rows: DataFrame, anchors: DataFrame, wanted: str, keep: int, name: str) -> DataFrame:
    """The best rows for every slot, stored. ``wanted``: "near" and "same" seek rows of the anchor's
    label (around it, everywhere), "other" those of other labels."""
    spark = rows.sparkSession
    size = anchors.agg(F.sum(8 * (F.size("q") + F.size("angles") + 2 * F.size("aims") + 8)).alias("bytes")).first().bytes or 0
    passes, found = -(-size // PASS_BYTES), []
    for p in range(passes):
        own = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(passes)) == p)
        # PASS_BYTES bounds what goes to the tasks.
        table = own.select("vec_id", "label", "home", "to_home", "norm", "q", "angles", "aims", "named").toArrow()
        table = table.sort_by([(c, "ascending") for c in ("label", "home", "to_home", "vec_id")])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        shared = spark.sparkContext.broadcast(sink.getvalue().to_pybytes())
        found.append(rows.mapInArrow(_best_rows(shared, wanted, keep), "anchor bigint, positive bigint, aim bigint, id bigint, score bigint"))
    if not found:
        return spark.createDataFrame([], "anchor bigint, positive bigint, aim bigint, id bigint, score bigint, rank int")
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "id")
    best = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order))
    return store(best.where(F.col("rank") <= keep), name)


def mine(rows: DataFrame, anchor: Column) -> DataFrame:
    """Hard negatives of the anchors among ``rows`` (vec_id, label, q): anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score."""
    described = rows.withColumn("d", _described(F.col("q"), references(rows))).select("vec_id", "label", "q", "d.*")
    place = ["label", "home", "to_home", "vec_id"]
    described = store(described.repartitionByRange(*place).sortWithinPartitions(*place), "vectors")
    anchors, nothing = described.where(anchor), F.array().cast("array<bigint>")
    at = F.col("vec_id") == F.col("anchor")

    open_ = anchors.select("*", F.array(F.lit(_LEAST)).alias("aims"), nothing.alias("named"))
    near = _search(described, open_, "near", POSITIVES, "near-positives")
    reached = near.where(F.col("rank") == POSITIVES).select("anchor", F.col("score").alias("least"))
    closed = anchors.join(reached, at, "left").select(
        *anchors.columns, F.array(F.coalesce("least", F.lit(_LEAST))).alias("aims"), nothing.alias("named")
    )
    positives = _search(described, closed, "same", POSITIVES, "positives")
    listed = positives.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("p"))
    # An aim below 0 has no window; it fills up short lists.
    filled = F.array_repeat(F.lit(-1).cast("bigint"), POSITIVES)
    aimed = anchors.join(listed, at).select(
        *anchors.columns,
        F.slice(F.concat(F.col("p.score"), filled), 1, POSITIVES).alias("aims"),
        F.slice(F.concat(F.col("p.id"), filled), 1, POSITIVES).alias("named"),
    )
    found = _search(described, aimed, "other", NEGATIVES, "negatives")
    discard(described)
    return found.select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"), F.col("aim").alias("positive_score"), F.col("score").alias("negative_score"),
    )
