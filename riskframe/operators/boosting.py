"""Gradient-boosted trees on binned columns, several models in the same passes.

Every column is cut into at most ``BINS`` bins at quantiles of a bounded sample of rows; the binned
table is stored once, in blocks of rows. A tree grows a level per pass: tasks add up gradient and
curvature per (node, column, bin) of their own blocks, these histograms are summed in a tree of
tasks, and the driver reads the best split of every node off them. Their size depends on the model
alone, never on the rows. With ``max_leaves`` a tree is cut back to the splits that best-first growth
would have made within the same depth: a node's split depends on its own histogram only, so the
order of growth changes nothing else.

A binned table that fits the memory of a task (``WHOLE_BYTES``) needs no pass per level: a task per
model holds it, grows all trees from the same sums and keeps the place of every row between levels.
Beyond that size passes run over the cluster, where a job per level costs more than its work on few rows.

In passes, rows keep their margins as of some trees ago; the latest trees go with each pass and are folded into
stored margins every ``REFRESH`` trees, which also cuts lineage: whatever executors are lost, at most
that many trees are evaluated again. Rows are sampled per tree by a hash of their id, columns by the
tree's number, so results do not depend on how rows are dealt out, up to the order of sums.

Models of several folds grow together: a fold's model learns from the rows of other folds. Rows
marked as hold-out never enter a histogram; they stop a model once its metric has not improved for
``patience`` trees, and the trees up to the best one stay.

Null, and NaN, is the lowest value. Ids must not be null.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.session import cut_lineage

BINS = 64
BIN_SAMPLE = 20_000
REFRESH = 8
SCORE_BUCKETS = 4096
# A binned table of up to so many bytes fits the memory of a task, with so many bytes a row besides its bins.
WHOLE_BYTES = 64 << 20
ROW_BYTES = 40
_U = np.uint64


@dataclass
class Ensemble:
    """Trees one after the other; ``start`` has the first node of each, children count from there.

    A row goes left if its value is at most the threshold. ``feature`` is -1 at leaves."""

    cols: list[str]
    start: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    rows: np.ndarray  # training rows that reached the node
    gain: np.ndarray
    metric: list[float] = field(default_factory=list)

    @property
    def trees(self) -> int:
        return len(self.start)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        x = np.ascontiguousarray(np.where(np.isnan(x), -np.inf, x).T)
        for s, e in zip(self.start.tolist(), np.append(self.start[1:], len(self.feature)).tolist()):
            _add_tree(out, x, tuple(c[s:e] for c in (self.feature, self.threshold, self.left, self.right, self.value)))
        return out

    def importance(self) -> np.ndarray:
        """Total gain per column, as shares."""
        inner = self.feature >= 0
        total = np.bincount(self.feature[inner], self.gain[inner], len(self.cols))
        return total / (total.sum() or 1.0)


def _matrix(columns: Sequence[pa.Array]) -> np.ndarray:
    return np.stack([c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in columns], axis=1)


def margin_of(model: Ensemble) -> Column:
    """The model's margin of a row, from its columns."""

    @F.arrow_udf("double")
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in batches:
            yield pa.array(model.margin(_matrix(columns)), pa.float64())

    return run(*[F.col(c).cast("double") for c in model.cols])


def margin_of_fold(models: Sequence[Ensemble], fold: str) -> Column:
    """The margin of a row by the model of its own fold, all models of the same columns."""

    @F.arrow_udf("double")
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for number, *columns in batches:
            x, of = _matrix(columns), number.to_numpy(zero_copy_only=False)
            out = np.full(len(x), np.nan)
            for k, model in enumerate(models):
                out[of == k] = model.margin(x[of == k])
            yield pa.array(out, pa.float64())

    return run(F.col(fold), *[F.col(c).cast("double") for c in models[0].cols])


def probability_of(model: Ensemble) -> Column:
    return 1 / (1 + F.exp(-margin_of(model)))


@dataclass
class Options:
    trees: int = 500
    depth: int = 6
    rate: float = 0.05
    row_share: float = 0.8
    column_share: float = 0.8
    min_rows: int = 1
    max_leaves: int | None = None
    penalty: float = 1.0  # on squared leaf values
    patience: int | None = 30
    metric: str = "ap"  # of hold-out rows: "ap" or "logloss"
    seed: int = 42


@dataclass
class _Tree:
    """A tree on bins while it grows; nodes in the order they were made."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    rows: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(c) for c in (self.feature, self.bin, self.left, self.right, self.value))

    def add(self, value: float, rows: float) -> int:
        for column, v in zip((self.feature, self.bin, self.left, self.right, self.value, self.rows, self.gain), (-1, 0, 0, 0, value, rows, 0.0), strict=True):
            column.append(v)
        return len(self.feature) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def sampled(ids: np.ndarray, tree: int, share: float, seed: int) -> np.ndarray:
    """Which rows a tree learns from, by their hashed ids."""
    if share >= 1:
        return np.ones(len(ids), bool)
    salt = _mixed(np.array([seed * 1_000_003 + tree + 1], np.uint64))[0]
    return (_mixed(ids ^ salt) >> _U(11)).astype(np.float64) < share * 2.0**53


def columns_of(tree: int, columns: int, share: float, seed: int) -> np.ndarray:
    """The columns a tree may split on."""
    rng = np.random.default_rng([seed, tree])
    return np.sort(rng.choice(columns, max(1, int(round(share * columns))), replace=False))


def _routed(bins: np.ndarray, tree: tuple[np.ndarray, ...]) -> np.ndarray:
    feature, cut, left, right, _ = tree
    node, every = np.zeros(len(bins), np.int64), np.arange(len(bins))
    while True:
        f = feature[node]
        inner = f >= 0
        if not inner.any():
            return node
        goes = bins[every, np.maximum(f, 0)] <= cut[node]
        node = np.where(inner, np.where(goes, left[node], right[node]), node)


def _add_tree(margin: np.ndarray, x: np.ndarray, tree: tuple[np.ndarray, ...]) -> None:
    """Adds the values of a tree to the margins of rows; ``x`` has a row per column, of bins or of values.

    Rows part at every node, so each is looked at once a level."""
    feature, cut, left, right, value = (c.tolist() for c in tree)
    stack: list[tuple[int, np.ndarray | None]] = [(0, None)]  # None: all rows
    while stack:
        node, rows = stack.pop()
        f = feature[node]
        if f < 0:
            margin[slice(None) if rows is None else rows] += value[node]
            continue
        goes = (x[f] if rows is None else x[f][rows]) <= cut[node]
        for child, side in ((left[node], goes), (right[node], ~goes)):
            part = np.flatnonzero(side) if rows is None else rows[side]
            if len(part):
                stack.append((child, part))


def _margins(block: dict, m: int, recent: Sequence[tuple[np.ndarray, ...]]) -> np.ndarray:
    out = block["margin"][:, m].copy()
    for tree in recent:
        _add_tree(out, block["bins"].T, tree)
    return out


def histogram(bins: np.ndarray, columns: np.ndarray, slot: np.ndarray, slots: int, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Sums (slot, column, bin, [gradient, curvature, rows]) over rows whose slot is not -1."""
    keep = slot >= 0
    if not keep.all():
        bins, slot, g, h = bins[keep], slot[keep], g[keep], h[keep]
    slot = slot * BINS
    out = np.zeros((slots, len(columns), BINS, 3))
    for i, c in enumerate(columns.tolist()):
        key = slot + bins[:, c]
        for k, weights in enumerate((g, h, None)):
            out[:, i, :, k] = np.bincount(key, weights, slots * BINS).reshape(slots, BINS)
    return out


@dataclass
class _Task:
    """What a pass does for one model."""

    recent: list[tuple[np.ndarray, ...]]
    grown: tuple[np.ndarray, ...]
    slots: dict[int, int]  # node to slot
    tree: int
    columns: np.ndarray


def _pass(block: dict, tasks: dict[int, _Task], options: Options, folds: int) -> dict:
    """Histograms of the nodes of each model, and before a tree's first level its metric's sums."""
    out = {}
    for m, task in tasks.items():
        margin = _margins(block, m, task.recent)
        p = 1 / (1 + np.exp(-margin))
        y, w = block["y"], block["w"]
        others = block["fold"] != m if folds else np.ones(len(y), bool)
        learns = others & ~block["hold"] & sampled(block["ids"], task.tree, options.row_share, options.seed)
        node = _routed(block["bins"], task.grown)
        place = np.full(len(task.grown[0]), -1)
        for n, s in task.slots.items():
            place[n] = s
        slot = np.where(learns, place[node], -1)
        out[m] = histogram(block["bins"], task.columns, slot, len(task.slots), w * (p - y), w * p * (1 - p))
        if 0 in task.slots:
            test = others & block["hold"]
            out[m, "metric"] = _test_sums(y[test], w[test], p[test], options)
    return out


def _test_sums(y: np.ndarray, w: np.ndarray, p: np.ndarray, options: Options) -> np.ndarray:
    """What the metric of hold-out rows is made of."""
    if options.metric == "ap":
        bucket = np.minimum((p * SCORE_BUCKETS).astype(np.int64), SCORE_BUCKETS - 1)
        return np.stack([np.bincount(bucket, v, SCORE_BUCKETS) for v in (y, 1 - y)])
    q = np.clip(np.where(y > 0, p, 1 - p), 1e-15, 1)
    return np.array([-(w * np.log(q)).sum(), w.sum()])


def _added(a: dict, b: dict) -> dict:
    return {k: a[k] + b[k] for k in a}


def _metric(sums: np.ndarray, kind: str) -> float | None:
    """Higher is better; None without hold-out rows of both kinds."""
    if kind != "ap":
        return -sums[0] / sums[1] if sums[1] else None
    found, false = np.cumsum(sums[:, ::-1], axis=1)
    if not found[-1] or not false[-1]:
        return None
    return float((sums[0, ::-1] / found[-1] * (found / np.maximum(found + false, 1))).sum())


def best_splits(hist: np.ndarray, options: Options) -> list[tuple[float, int, int, np.ndarray, np.ndarray] | None]:
    """Per slot: gain, column place, bin, and the sums left and right of it; None without any gain."""
    below = np.cumsum(hist, axis=2)
    whole = below[:, :, -1:, :]
    left, right = below[:, :, :-1, :], whole - below[:, :, :-1, :]

    def score(s: np.ndarray) -> np.ndarray:
        return s[..., 0] ** 2 / (s[..., 1] + options.penalty + 1e-12)

    gain = score(left) + score(right) - score(whole)
    fits = np.minimum(left[..., 2], right[..., 2]) >= max(options.min_rows, 1)
    gain = np.where(fits, gain, -np.inf)
    out = []
    for s in range(len(hist)):
        # Twelve digits: the order of sums does not choose between equal splits.
        flat = int(np.argmax(np.round(gain[s], 9)))
        column, cut = divmod(flat, gain.shape[2])
        value = float(gain[s, column, cut])
        out.append((value, column, cut, left[s, column, cut], right[s, column, cut]) if value > 1e-9 else None)
    return out


def root_histogram(df: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """(feature, bin, gradient, curvature, rows) of the logistic loss at margin 0, for given bin ends."""
    cols, ends = list(edges), [np.array(e, float) for e in edges.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(cols), BINS, 3))
        for batch in batches:
            x = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in cols], axis=1)
            y = batch.column("label").to_numpy(zero_copy_only=False)
            total += histogram(binned(x, ends), np.arange(len(cols)), np.zeros(len(y), np.int64), 1, 0.5 - y, np.full(len(y), 0.25))[0]
        f, b = np.nonzero(total[:, :, 2])
        columns = [pa.array([cols[i] for i in f], pa.string()), pa.array(b, pa.int32()), *(pa.array(total[f, b, k]) for k in range(3))]
        yield pa.RecordBatch.from_arrays(columns, ["feature", "bin", "gradient", "curvature", "rows"])

    rows = df.select(F.col("label").cast("double").alias("label"), *[F.col(c).cast("double").alias(c) for c in cols])
    parts = rows.mapInArrow(run, "feature string, bin int, gradient double, curvature double, rows double")
    return parts.groupBy("feature", "bin").agg(
        F.sum("gradient").alias("gradient"), F.sum("curvature").alias("curvature"), F.sum("rows").cast("bigint").alias("rows")
    )


def _pruned(tree: _Tree, max_leaves: int | None) -> _Tree:
    """The part of a tree that best-first growth reaches with that many leaves."""
    if max_leaves is None:
        return tree
    open_, chosen = [0], set()
    while len(chosen) + 1 < max_leaves:
        inner = [n for n in open_ if tree.feature[n] >= 0]
        if not inner:
            break
        best = max(inner, key=lambda n: (tree.gain[n], -n))
        chosen.add(best)
        open_.remove(best)
        open_ += [tree.left[best], tree.right[best]]
    out = _Tree()
    stack = [(0, 0)]
    while stack:
        old, new = stack.pop()
        out.value[new], out.rows[new] = tree.value[old], tree.rows[old]
        if old in chosen:
            out.feature[new], out.bin[new], out.gain[new] = tree.feature[old], tree.bin[old], tree.gain[old]
            out.left[new], out.right[new] = out.add(0.0, 0.0), out.add(0.0, 0.0)
            stack += [(tree.left[old], out.left[new]), (tree.right[old], out.right[new])]
    return out


def bin_edges(df: DataFrame, cols: Sequence[str], id_col: str, bins: int = BINS) -> list[np.ndarray]:
    """Per column the upper ends of all bins but the last: quantiles of at most BIN_SAMPLE rows, those
    with the smallest hashed ids. Few distinct values get a bin each."""
    sample = df.select(F.xxhash64(F.col(id_col), F.lit(3)).alias("__order"), F.col(id_col).alias("__id"), *[F.col(c).cast("double").alias(c) for c in cols])
    table = sample.orderBy("__order", "__id").limit(BIN_SAMPLE).toArrow()  # BIN_SAMPLE rows
    edges = []
    for c in cols:
        x = table.column(c).to_numpy()
        values = np.unique(x[~np.isnan(x)])
        if len(values) > bins:
            values = np.unique(np.quantile(x[~np.isnan(x)], np.arange(1, bins) / bins, method="inverted_cdf"))
        else:
            values = values[:-1]
        edges.append(values)
    return edges


_BLOCK = "n int, bins binary, y binary, w binary, ids binary, fold binary, hold binary, margin binary"
# What a task that grows a whole model reads, ids first; margins start at 0.
_WHOLE = ["ids", "bins", "y", "w", "fold", "hold"]
_SCHEMA = pa.schema([("n", pa.int32()), *((c.split(" ")[0], pa.binary()) for c in _BLOCK.split(", ")[1:])])


def binned(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, np.where(np.isnan(v), -np.inf, v), side="left").astype(np.uint8) for v, e in zip(x.T, edges, strict=True)], axis=1)


def _blocks(df: DataFrame, cols: Sequence[str], id_col: str, edges: list[np.ndarray], models: int) -> DataFrame:
    """The stored binned table; columns label, weight, fold and holdout are read if they exist."""

    def optional(name: str, otherwise: float) -> Column:
        return F.col(name).cast("double") if name in df.columns else F.lit(float(otherwise))

    rows = df.select(
        F.xxhash64(id_col).alias("ids"), F.col("label").cast("double").alias("y"), optional("weight", 1).alias("w"),
        optional("fold", -1).alias("fold"), optional("holdout", 0).alias("hold"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)],
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda c, b=batch: b.column(c).to_numpy(zero_copy_only=False)
            n = batch.num_rows
            if not n:
                continue
            x = np.stack([get(f"x{i}") for i in range(len(cols))], axis=1)
            row = [n, binned(x, edges), get("y"), get("w"), get("ids"), get("fold").astype(np.int8), get("hold") > 0, np.zeros((n, models))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v if i == 0 else v.tobytes()], f.type) for i, (v, f) in enumerate(zip(row, _SCHEMA, strict=True))], schema=_SCHEMA
            )

    return cut_lineage(rows.mapInArrow(run, _BLOCK), "blocks")


def _read(row, columns: int, models: int) -> dict:
    def get(name: str, kind) -> np.ndarray:
        return np.frombuffer(row[name], kind)

    return {
        "bins": get("bins", np.uint8).reshape(-1, columns), "y": get("y", np.float64), "w": get("w", np.float64), "ids": get("ids", np.uint64),
        "fold": get("fold", np.int8), "hold": get("hold", bool),
    } | ({"margin": get("margin", np.float64).reshape(-1, models)} if "margin" in row else {})


def _refreshed(blocks: DataFrame, recent: dict[int, list], columns: int, models: int) -> DataFrame:
    """Blocks with the latest trees in their margins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = _read(row, columns, models)
                margin = np.stack([_margins(block, m, recent.get(m, [])) for m in range(models)], axis=1)
                yield pa.RecordBatch.from_pylist([row | {"margin": margin.tobytes()}], _SCHEMA)

    return cut_lineage(blocks.mapInArrow(run, _BLOCK), "blocks")


class _Spread:
    """The binned table as blocks all over the cluster; a pass is a job over all of them."""

    every = REFRESH

    def __init__(self, blocks: DataFrame, columns: int, models: int, options: Options, folds: int):
        self.blocks, self.columns, self.models, self.options, self.folds = blocks, columns, models, options, folds
        self.state = self._opened()

    def _opened(self):
        columns, models = self.columns, self.models
        return self.blocks.rdd.map(lambda row: _read(row, columns, models)).persist(StorageLevel.MEMORY_AND_DISK)

    def add(self, recent: dict[int, list]) -> None:
        self.blocks = _refreshed(self.blocks, recent, self.columns, self.models)
        old, self.state = self.state, self._opened()
        old.unpersist()

    def sums(self, tasks: dict[int, _Task]) -> dict:
        # Not a DataFrame: the sum of arrays over a few thousand short passes.
        options, folds = self.options, self.folds
        return self.state.map(lambda block: _pass(block, tasks, options, folds)).treeReduce(_added, 2) if tasks else {}


class _Whole:
    """The rows of one model in the memory of a task. A pass goes on where the one before ended: a level
    moves rows one step down, and a tree is added to the margins once."""

    every = 1

    def __init__(self, block: dict, m: int, options: Options, folds: int):
        # Of its own fold a model sees nothing.
        seen = block["fold"] != m if folds else np.ones(len(block["y"]), bool)
        self.bins = np.ascontiguousarray(block["bins"][seen].T)
        self.y, self.w, self.ids, self.hold = (block[c][seen] for c in ("y", "w", "ids", "hold"))
        self.m, self.options, self.margin = m, options, np.zeros(len(self.y))

    def add(self, recent: dict[int, list]) -> None:
        for tree in recent[self.m]:
            _add_tree(self.margin, self.bins, tree)

    def _begin(self, task: _Task) -> dict:
        p = 1 / (1 + np.exp(-self.margin))
        rows = np.flatnonzero(~self.hold & sampled(self.ids, task.tree, self.options.row_share, self.options.seed))
        self.own = np.stack([self.bins[c][rows] for c in task.columns.tolist()])
        y, w, p_own = self.y[rows], self.w[rows], p[rows]
        self.g, self.h = w * (p_own - y), w * p_own * (1 - p_own)
        self.node = np.zeros(len(rows), np.int64)
        return {(self.m, "metric"): _test_sums(self.y[self.hold], self.w[self.hold], p[self.hold], self.options)}

    def _step(self, task: _Task) -> None:
        feature, cut, left, right, _ = task.grown
        place = np.zeros(len(self.bins), np.int64)
        place[task.columns] = np.arange(len(task.columns))
        split = feature[self.node] >= 0
        if not split.all():
            self.own, self.g, self.h, self.node = self.own[:, split], self.g[split], self.h[split], self.node[split]
        goes = self.own[place[feature[self.node]], np.arange(len(self.node))] <= cut[self.node]
        self.node = np.where(goes, left[self.node], right[self.node])

    def sums(self, tasks: dict[int, _Task]) -> dict:
        if not tasks:
            return {}
        task, out = tasks[self.m], {}
        if 0 in task.slots:
            out |= self._begin(task)
        else:
            self._step(task)
        slot = np.zeros(len(task.grown[0]), np.int64)
        for n, s in task.slots.items():
            slot[n] = s
        return out | {self.m: histogram(self.own.T, np.arange(len(self.own)), slot[self.node], len(task.slots), self.g, self.h)}


def _grown(table: _Spread | _Whole, models: Sequence[int], columns_all: int, options: Options) -> tuple[dict[int, list[_Tree]], dict[int, list[float]]]:
    """Trees and scores of each model, from the sums of the table's rows."""
    trees: dict[int, list[_Tree]] = {m: [] for m in models}
    scores: dict[int, list[float]] = {m: [] for m in models}
    live, folded = set(models), 0
    for number in range(options.trees + 1):
        if number - folded >= table.every:
            table.add({m: [t.arrays() for t in trees[m][folded:]] for m in models})
            folded = number
        columns = columns_of(number, columns_all, options.column_share, options.seed)
        growing = {m: _Tree() for m in live}
        frontier = {m: [0] for m in live}
        for level in range(options.depth):
            tasks = {
                m: _Task([t.arrays() for t in trees[m][folded:]], growing[m].arrays(), {n: s for s, n in enumerate(frontier[m])}, number, columns)
                for m in live
                if frontier[m]
            }
            found = table.sums(tasks)
            for m in tasks:
                if level == 0:
                    score = _metric(found[m, "metric"], options.metric)
                    if score is not None:
                        scores[m].append(round(score, 12))
                        best = int(np.argmax(scores[m]))
                        if options.patience and number - best >= options.patience:
                            live = live - {m}
                    if number == options.trees:
                        live = live - {m}
                    if m not in live:
                        continue
                tree, after = growing[m], []
                if level == 0:
                    whole = found[m][0, 0].sum(axis=0)
                    tree.value[0], tree.rows[0] = -options.rate * whole[0] / (whole[1] + options.penalty + 1e-12), whole[2]
                for n, split in zip(frontier[m], best_splits(found[m], options), strict=True):
                    if split is None:
                        continue
                    gain, column, cut, left, right = split
                    tree.feature[n], tree.bin[n], tree.gain[n] = int(columns[column]), cut, gain
                    tree.left[n], tree.right[n] = (tree.add(-options.rate * s[0] / (s[1] + options.penalty + 1e-12), s[2]) for s in (left, right))
                    after += [tree.left[n], tree.right[n]]
                frontier[m] = after
            frontier = {m: frontier[m] for m in live}
            if not any(frontier.values()):
                break
        if not live:
            break
        for m in live:
            trees[m].append(_pruned(growing[m], options.max_leaves))
    return trees, scores


def _grown_whole(blocks: DataFrame, columns: int, models: int, options: Options, folds: int) -> tuple[dict[int, list[_Tree]], dict[int, list[float]]]:
    """The same with a task per model, which holds the table and so needs no job per level."""

    def grow(pairs: Iterator[tuple[int, tuple]]) -> Iterator[tuple]:
        rows: dict[int, list] = {}
        for m, row in pairs:
            rows.setdefault(m, []).append(row)
        for m in sorted(rows):
            # Of blocks in any order: sums come in that of their first ids.
            parts = [_read(dict(zip(_WHOLE, row, strict=True)), columns, models) for row in sorted(rows.pop(m), key=lambda row: row[0])]
            block = {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
            del parts
            trees, scores = _grown(_Whole(block, m, options, folds), [m], columns, options)
            yield m, trees[m], scores[m]

    dealt = blocks.select(*_WHOLE).rdd.flatMap(lambda row: [(m, tuple(row)) for m in range(models)]).partitionBy(models, int)
    found = dealt.mapPartitions(grow).collect()  # models
    return {m: t for m, t, _ in found}, {m: s for m, _, s in found}


def fit(df: DataFrame, cols: Sequence[str], id_col: str, options: Options, folds: int = 0, whole_bytes: int = WHOLE_BYTES) -> list[Ensemble]:
    """One model, or one per fold, of column ``label`` (0 or 1). Optional columns: ``weight``,
    ``holdout`` (true rows stop the descent and are not learnt from) and, with folds, ``fold``."""
    cols, models = list(cols), max(folds, 1)
    edges = bin_edges(df, cols, id_col)
    blocks = _blocks(df, cols, id_col, edges, models)
    rows = blocks.agg(F.sum("n")).first()[0]
    if not rows:
        raise ValueError("no rows to learn from")
    if rows * (len(cols) + ROW_BYTES) <= whole_bytes:
        trees, scores = _grown_whole(blocks, len(cols), models, options, folds)
    else:
        table = _Spread(blocks, len(cols), models, options, folds)
        trees, scores = _grown(table, range(models), len(cols), options)
        table.state.unpersist()
    return [_ensemble(cols, trees[m], edges, scores[m], options.patience is not None) for m in range(models)]


def _ensemble(cols: list[str], trees: list[_Tree], edges: list[np.ndarray], scores: list[float], stop: bool) -> Ensemble:
    """All trees, or those up to the best score on hold-out rows (scores[k] is that of k trees)."""
    trees = trees[: int(np.argmax(scores))] if scores and stop else trees
    sizes = np.array([len(t.feature) for t in trees], np.int64)

    def every(name: str, kind) -> np.ndarray:
        return np.array([v for t in trees for v in getattr(t, name)], kind)

    feature, cut = every("feature", np.int32), every("bin", np.int64)
    ends = [np.append(e, np.inf) for e in edges]
    threshold = np.array([ends[f][b] if f >= 0 else 0.0 for f, b in zip(feature, cut, strict=True)])
    return Ensemble(
        cols, np.cumsum(sizes) - sizes, feature, threshold, every("left", np.int32), every("right", np.int32),
        every("value", float), every("rows", float), every("gain", float), list(scores),
    )


def with_options(**changes) -> Options:
    return replace(Options(), **changes)
