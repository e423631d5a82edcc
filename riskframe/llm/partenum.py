"""Exact n-gram Jaccard join and its components, by PartEnum signatures.

A document is its set of word n-grams, hashed to 64 bits. Two sets link when 100 * |A & B| is at
least ``percent`` * |A | B|. Documents with equal sets are one class, found by a 128-bit digest;
everything below works on one representative per class (the smallest id).

Signatures. Sizes are cut into bands; a set signs for its own band, and for the next one if a
partner there is possible, so linked sets share a band. In a band with largest size r, linked sets
differ in at most K = 2r (100 - percent) / (100 + percent) features, a set and its partners there in
at most k <= K. The feature domain is hashed into some more than K partitions, and the content of a
partition is a signature. A set signs only the k + 1 with the most features (ties by content), because
what few features say chance says too. Linked sets share one: of the k + 1 of either set at least one
is untouched by any difference, so the other set has it as well; and as both sets rank contents alike,
the one of them whose last signature ranks higher finds its untouched one among those of the other.
A set that fills no more than k partitions signs them all, and in a second, independent partitioning
too, and so on; in the last one it signs its empty partitions as well.

Search. Rows (signature, id) are sorted by signature, and every member of a bucket is compared
with one pivot; equal signatures inside one task keep one row each before the shuffle. Verified
links give components. Buckets that still hold several components are compared with other pivots,
and what remains is compared pair by pair across components, so no link that could join two
components is missed, while members already connected are never paired. Buckets that stay large
are first divided by signatures of an independent partitioning, which linked sets share as well.
Before texts are compared, sizes and 2048-bit parity sketches (their difference is at most the
true one) rule out most pairs.

Defined results: null or empty text, or text without words, has 0 n-grams, links with nothing and
is its own component; so is a null id, with a null component. With fewer than n words the whole
sequence is the one n-gram. Rows that share an id are one node. Empty tables give empty tables.
Only id and text are read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm import text as tx
from riskframe.llm.common import discard, free_finished, release_memory, store
from riskframe.llm.components import components

FAMILIES = 6
BAND_RATIO = 1.45
# Partitions beyond those in which linked sets may differ, in tenths of these.
SPARE_TENTHS = 3
# 2048 bits tell sets of some 4,000 features apart; pairs inside a bucket carry a folded sketch of 512.
SKETCH_LONGS, FOLDED_LONGS = 32, 8
# Up to this many rows an id list is broadcast; more are joined by shuffle.
BROADCAST_IDS = 100_000
# Buckets above this size are divided before their pairs are compared.
BUCKET_ROWS = 512
DIVISIONS = 3
PIVOT_ROUNDS = 1
# Signatures per batch that leaves a Python worker.
EMIT_ROWS = 100_000

_U = np.uint64


def smallest(percent: int) -> int:
    """The smallest size at which sets that differ can link; smaller sets only link when equal."""
    return -(-percent // (100 - percent))


SMALLEST = smallest(85)


def _differ(percent: int, size: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The most features in which linked sets of these sizes differ."""
    return (100 - percent) * (size + other) // (100 + percent)


class Bands:
    """Size bands for a similarity of ``percent``: smallest and largest size, and K."""

    def __init__(self, percent: int, largest: int):
        self.percent = percent
        low, high, self.low, self.high = smallest(percent), 0, [], []
        while not self.high or self.high[-1] < largest * 2:
            high = max(int(low * BAND_RATIO), -(-100 * low // percent))
            self.low.append(low)
            self.high.append(high)
            low = high + 1
        self.low, self.high = np.array(self.low), np.array(self.high)
        differ = _differ(percent, self.high, self.high)
        # In integers, so that all machines agree on it.
        self.parts = differ + 1 + -(-SPARE_TENTHS * differ // 10)

    def differ(self, size: np.ndarray, band: np.ndarray) -> np.ndarray:
        """The most features in which sets differ from those in a band that they link with."""
        return _differ(self.percent, size, np.minimum(self.high[band], 100 * size // self.percent))

    def of(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.high, size)

    def reaches_next(self, size: np.ndarray) -> np.ndarray:
        """Whether a set in the next band can link."""
        return 100 * size // self.percent >= self.low[self.of(size) + 1]


def shingle_sets(chunk: tx.Chunk, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-gram hashes of each text, one text after the other, and their numbers."""
    words = tx.words(chunk)
    m = max(len(words.hash) - n + 1, 0)
    grams = np.full(m, n, np.uint64)
    for k in range(n):
        grams = tx.mix(grams * _U(31) + words.hash[k : k + m])
    inside = words.text[:m] == words.text[n - 1 : n - 1 + m]
    short = (words.per_text > 0) & (words.per_text < n)
    whole = tx.sequence_hash(words.hash, words.per_text)
    grams, per_text = grams[inside], np.bincount(words.text[:m][inside], minlength=len(chunk))
    end, sets = np.cumsum(per_text), []
    for i in range(len(chunk)):
        if short[i]:
            sets.append(whole[i : i + 1])
            continue
        own = np.sort(grams[end[i] - per_text[i] : end[i]])
        sets.append(own[np.append(own[1:] != own[:-1], True)[: len(own)]])
    return np.concatenate([np.zeros(0, np.uint64), *sets]), np.array([len(s) for s in sets], np.int64)


def _sum_hashes(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(counts), np.uint64)
    full = counts > 0
    if full.any():
        out[full] = np.add.reduceat(values, (np.cumsum(counts) - counts)[full])
    return out


def _largest(who: np.ndarray, held: np.ndarray, content: np.ndarray, filled: np.ndarray, differ: np.ndarray) -> np.ndarray:
    """Of each set's filled partitions the ``differ`` + 1 of most features, ties by content (all of
    those that tie for the last place too); rows are in order of ``who``."""
    low = tx.mix(content) >> _U(32)
    key = (who.astype(np.uint64) << _U(40)) | (_U(255) - np.minimum(held, 255).astype(np.uint64)) << _U(32) | low
    last = np.cumsum(filled) - filled + np.minimum(differ, filled - 1)
    return key <= np.sort(key)[last][who]


def signatures(
    values: np.ndarray, counts: np.ndarray, percent: int, seed: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """(signature, index of its set) for sets given one after the other."""
    bands = Bands(percent, int(counts.max(initial=smallest(percent))))
    signs = counts >= smallest(percent)
    out_sig, out_set = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    start = np.cumsum(counts) - counts
    for step in (0, 1):
        chosen = np.flatnonzero(signs & (bands.reaches_next(counts) if step else True))
        for family in range(FAMILIES):
            if not len(chosen):
                break
            band = bands.of(counts[chosen]) + step
            size = counts[chosen]
            differ, parts = bands.differ(size, band), bands.parts[band]
            own = np.repeat(np.arange(len(chosen)), size)
            at = np.repeat(start[chosen] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            h = tx.mix(values[at] ^ _U((seed * FAMILIES + family + 1) * 0x9E3779B97F4A7C15 % 2**64))
            part = ((h >> _U(32)) * parts[own].astype(np.uint64)) >> _U(32)
            offset = np.cumsum(parts) - parts
            cell = offset[own] + part.astype(np.int64)
            order = np.argsort(cell, kind="stable")
            cell, h = cell[order], tx.mix(h[order] + _U(1))
            first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
            content = np.add.reduceat(h, first)
            held = np.diff(np.append(first, len(cell)))
            cell, who = cell[first], own[order][first]
            filled = np.bincount(who, minlength=len(chosen))
            sparse = filled <= differ
            largest = _largest(who, held, content, filled, differ)
            cell, who, content = cell[largest], who[largest], content[largest]
            if family == FAMILIES - 1 and sparse.any():
                gone = np.setdiff1d(np.arange(parts.sum()), cell)  # sparse sets sign all they fill
                gone_who = np.searchsorted(offset, gone, side="right") - 1
                gone, gone_who = gone[sparse[gone_who]], gone_who[sparse[gone_who]]
                cell, who = np.append(cell, gone), np.append(who, gone_who)
                content = np.append(content, np.zeros(len(gone), np.uint64))
            place = (cell - offset[who]).astype(np.uint64)
            tag = band[who].astype(np.uint64) * _U(64) + _U(family)
            out_sig.append(tx.mix(content ^ tx.mix(place * _U(1 << 16) + tag)))
            out_set.append(chosen[who])
            chosen = chosen[sparse]
    return np.concatenate(out_sig), np.concatenate(out_set)


def _digest(text: Column, n: int) -> Column:
    @F.arrow_udf("n bigint, d1 bigint, d2 bigint")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            parts = []
            for chunk in tx.chunks(column):
                values, counts = shingle_sets(chunk, n)
                d1 = _sum_hashes(tx.mix(values ^ _U(0xA5A5)), counts)
                d2 = _sum_hashes(tx.mix(values * _U(3) + _U(7)), counts)
                rows = [pa.array(c.view(np.int64)) for c in (counts, d1, d2)]
                parts.append(pa.StructArray.from_arrays(rows, ["n", "d1", "d2"]))
            yield pa.concat_arrays(parts)
        release_memory()

    return run(text)


def _emit(n: int, percent: int):
    """Rows (sig, id, pivot): the first member of a signature in a chunk, without a pivot, goes
    to its bucket; later members of the chunk only need the comparison with that first one."""

    def run(batches):
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            # A chunk at a time: memory does not depend on the size of Arrow batches.
            for chunk in tx.chunks(batch.column("text")):
                sig, who = signatures(*shingle_sets(chunk, n), percent)
                own = ids[chunk.first + who]
                order = np.lexsort((own, sig))
                sig, own = sig[order], own[order]
                first = np.append(True, sig[1:] != sig[:-1])[: len(sig)]
                pivot = own[np.maximum.accumulate(np.where(first, np.arange(len(sig)), 0))]
                passing = ~first
                # Rows that need no bucket are spread by id.
                sig = np.where(passing, tx.mix(own.astype(np.uint64)), sig)
                keep = first | (own != pivot)
                sig, own, pivot, first = sig.view(np.int64)[keep], own[keep], pivot[keep], first[keep]
                for at in range(0, max(len(sig), 1), EMIT_ROWS):
                    part = slice(at, at + EMIT_ROWS)
                    rows = [pa.array(sig[part]), pa.array(own[part], pa.int64()), pa.array(pivot[part], pa.int64(), mask=first[part])]
                    yield pa.RecordBatch.from_arrays(rows, ["sig", "id", "pivot"])
        release_memory()

    return run


def _stars(batches):
    """From rows sorted by (sig, id): pairs (id, pivot) of every bucket with its first member."""
    last_sig, last_pivot = None, 0
    for batch in batches:
        sig, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        ready = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
        pivot = batch.column(2).fill_null(0).to_numpy(zero_copy_only=False)
        done_id, done_pivot = ids[ready], pivot[ready]
        sig, ids = sig[~ready], ids[~ready]
        if len(sig):
            first = np.append(sig[0] != last_sig, sig[1:] != sig[:-1])
            run = np.maximum.accumulate(np.where(first, np.arange(len(sig)), -1))
            of = np.where(run < 0, last_pivot, ids[np.maximum(run, 0)])
            last_sig, last_pivot = sig[-1], of[-1]
            more = ids != of
            done_id, done_pivot = np.append(done_id, ids[more]), np.append(done_pivot, of[more])
        pairs = np.unique(np.stack([done_id, done_pivot], axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _describe(text: Column, n: int, percent: int, seed: int = 0) -> Column:
    """A struct (n, sketch, sigs); the sketch has a bit per parity of hashed features."""

    @F.arrow_udf("n bigint, sketch array<bigint>, sigs array<bigint>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            parts = []
            for chunk in tx.chunks(column):
                values, counts = shingle_sets(chunk, n)
                sig, who = signatures(values, counts, percent, seed)
                order = np.argsort(who, kind="stable")
                at = np.concatenate([[0], np.cumsum(np.bincount(who, minlength=len(counts)))]).astype(np.int32)
                bits = SKETCH_LONGS * 64
                cell = np.repeat(np.arange(len(counts)), counts) * bits + (tx.mix(values) % _U(bits)).astype(np.int64)
                octets = np.zeros(len(counts) * bits // 8, np.uint8)
                np.bitwise_xor.at(octets, cell >> 3, np.uint8(1) << (cell & 7).astype(np.uint8))
                packed = octets.view(np.int64)
                fixed = np.arange(0, len(packed) + 1, SKETCH_LONGS, dtype=np.int32)
                parts.append(
                    pa.StructArray.from_arrays(
                        [
                            pa.array(counts),
                            pa.ListArray.from_arrays(pa.array(fixed), pa.array(packed)),
                            pa.ListArray.from_arrays(pa.array(at), pa.array(sig[order].view(np.int64))),
                        ],
                        ["n", "sketch", "sigs"],
                    )
                )
            yield pa.concat_arrays(parts)
        release_memory()

    return run(text)


def _linked(left: Column, right: Column, n: int, percent: int) -> Column:
    """The exact test on two texts."""

    @F.arrow_udf("boolean")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for a, b in batches:
            sets = []
            for column in (a, b):
                own = []
                for chunk in tx.chunks(column):
                    values, counts = shingle_sets(chunk, n)
                    own += np.split(values, np.cumsum(counts)[:-1]) if len(counts) else []
                sets.append(own)
            out = []
            for x, y in zip(*sets, strict=True):
                same = len(np.intersect1d(x, y, assume_unique=True))
                out.append(100 * same >= percent * (len(x) + len(y) - same) and same > 0)
            yield pa.array(out, pa.bool_())
        release_memory()

    return run(left, right)


def _folded(sketch: Column) -> Column:
    """The sketch of FOLDED_LONGS that the same features have."""
    parts = [[sketch[j] for j in range(i, SKETCH_LONGS, FOLDED_LONGS)] for i in range(FOLDED_LONGS)]
    return F.array(*[functools.reduce(Column.bitwiseXOR, p) for p in parts])


def _near(a: str, b: str, percent: int, longs: int = SKETCH_LONGS) -> Column:
    """Whether sizes n<a>, n<b> and sketches s<a>, s<b> of ``longs`` allow a link."""
    na, nb, sa, sb = (F.col(c) for c in (f"n{a}", f"n{b}", f"s{a}", f"s{b}"))
    differ = sum(F.bit_count(sa[i].bitwiseXOR(sb[i])) for i in range(longs))
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & (
        differ * (100 + percent) <= (100 - percent) * (na + nb)
    )


def _small(side: DataFrame) -> DataFrame:
    """A stored side of a join, broadcast if it has at most BROADCAST_IDS rows."""
    return F.broadcast(side) if side.count() <= BROADCAST_IDS else side


class _Join:
    """One run: the described candidates and what is known of their components."""

    def __init__(self, known: DataFrame, n: int, percent: int):
        self.known, self.n, self.percent = known, n, percent
        self.links = self.roots = None

    def info(self, end: str, folded: bool = False) -> DataFrame:
        """Size and sketch of every candidate, named after one end of a pair."""
        sketch = _folded(F.col("sketch")) if folded else F.col("sketch")
        return self.known.select(F.col("id").alias(end), F.col("n").alias(f"n{end}"), sketch.alias(f"s{end}"))

    def verify(self, pairs: DataFrame) -> int:
        """Compare pairs (a, b), add the links and refresh the components; returns the links found."""
        possible = pairs.distinct().join(self.info("a"), "a").join(self.info("b"), "b")
        possible = store(possible.where(_near("a", "b", self.percent)).select("a", "b"), "possible")
        ends = store(possible.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ends")
        # Texts are what costs to move: only those of pairs left by sizes and sketches are.
        texts = self.known.join(_small(ends), "id", "left_semi").select("id", "text")
        both = possible.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
        both = both.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
        tested = both.withColumn("linked", _linked(F.col("ta"), F.col("tb"), self.n, self.percent))
        found = store(tested.where("linked").select(F.col("a").alias("u"), F.col("b").alias("v")), "found")
        new = found.count()
        if new or self.links is None:
            links = found if self.links is None else self.links.unionByName(found)
            before, self.links = self.links, store(components(links).select(F.col("node").alias("u"), F.col("root").alias("v")), "stars")
            if before is not None:
                discard(before)
        discard(found, possible, ends)
        del tested, both, texts
        free_finished(self.known.sparkSession)
        return new

    def unresolved(self, rows: DataFrame) -> DataFrame:
        """Rows (sig, id) of buckets with more than one component, with their component."""
        roots = self.links.select(F.col("u").alias("id"), F.col("v").alias("root"))
        rows = rows.join(_small(roots), "id", "left").select("sig", "id", F.coalesce("root", "id").alias("root"))
        open_ = rows.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
        # Few buckets are open; known as a table, they do not make all rows move once more.
        return rows.join(_small(store(open_.select("sig"), "open-buckets")), "sig")


def _divide(join: _Join, rows: DataFrame, bucket_rows: int) -> DataFrame:
    """Replace buckets above ``bucket_rows`` by their division with independent signatures.

    Linked members share a part of the division too. A bucket of texts that share no more than a
    passage falls apart; one of truly similar texts would be repeated in every part and stays whole.
    """
    done = []
    for seed in range(1, DIVISIONS + 1):
        sizes = rows.groupBy("sig").agg(F.count(F.lit(1)).alias("size"))
        large = store(sizes.where(F.col("size") > bucket_rows), "large-buckets")
        if large.isEmpty():
            break
        done.append(rows.join(large, "sig", "left_anti"))
        hot = rows.join(large, "sig")
        again = join.known.join(hot.select("id").distinct(), "id", "left_semi").select(
            "id", F.explode(_describe(F.col("text"), join.n, join.percent, seed)["sigs"]).alias("other")
        )
        parts = hot.select("sig", "size", "id").join(again, "id")
        parts = store(parts.select("sig", "size", F.xxhash64("sig", "other").alias("part"), "id"), "parts")
        per_part = parts.groupBy("sig", "size", "part").agg(F.count(F.lit(1)).alias("own")).where("own > 1")
        pairs = per_part.groupBy("sig", "size").agg(F.sum(F.col("own") * F.col("own")).alias("after"))
        whole = store(pairs.where(2 * F.col("after") > F.col("size") * F.col("size")).select("sig"), "whole-buckets")
        done.append(hot.drop("size").join(whole, "sig"))
        divided = parts.join(whole, "sig", "left_anti").select(F.col("part").alias("sig"), "id")
        rows = store(join.unresolved(divided), "divided")
    for part in done:
        rows = rows.unionByName(part)
    return rows


def jaccard_components(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    n: int = 4,
    percent: int = 85,
    bucket_rows: int = BUCKET_ROWS,
    pivot_rounds: int = PIVOT_ROUNDS,
) -> DataFrame:
    """Per row: id, n_shingles, class_id (smallest id with the same set), component_id."""
    docs = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    members = store(docs.select("id", _digest(F.col("text"), n).alias("d")).select("id", "d.*"), "sets")
    named = members.where("n > 0 and id is not null")
    # Stored, so that the join below deals out rows anew and Spark can split a set that many share.
    classes = store(named.groupBy("n", "d1", "d2").agg(F.min("id").alias("rep")), "classes")
    members = store(
        members.join(classes, ["n", "d1", "d2"], "left").select("id", "n", F.when(F.col("id").isNotNull() & (F.col("n") > 0), F.col("rep")).alias("rep")),
        "members",
    )
    copies = store(members.where("rep <> id or n = 0").select("id").distinct(), "copies")

    distinct = docs.where("id is not null").join(_small(copies), "id", "left_anti")
    emitted = distinct.mapInArrow(_emit(n, percent), "sig bigint, id bigint, pivot bigint")
    sorted_rows = emitted.repartition("sig").sortWithinPartitions("sig", "id")
    pairs = store(sorted_rows.mapInArrow(_stars, "a bigint, b bigint").distinct(), "pairs")
    candidates = store(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "candidates")
    # The signatures are the largest shuffle; its files are not needed any more.
    del emitted, sorted_rows
    free_finished(docs.sparkSession)
    described = distinct.join(_small(candidates), "id", "left_semi")
    known = store(described.withColumn("d", _describe(F.col("text"), n, percent)).select("id", "text", "d.*"), "known")

    join = _Join(known, n, percent)
    join.verify(pairs)
    rows = known.select("id", F.explode("sigs").alias("sig"))
    for turn in range(pivot_rounds):
        rows = store(join.unresolved(rows.select("id", "sig")), "open")
        if rows.isEmpty():
            break
        # Another pivot in every bucket, so that a member meets different ones.
        order = F.struct(F.xxhash64("sig", "id", F.lit(turn)), "id", "root")
        pivots = rows.groupBy("sig").agg(F.min(order).alias("p"))
        met = rows.join(pivots, "sig").where("root <> p.root").select("id", F.col("p.id").alias("p"))
        if not join.verify(met.select(F.greatest("id", "p").alias("a"), F.least("id", "p").alias("b"))):
            break
    rows = store(join.unresolved(rows.select("id", "sig")), "open")
    rows = _divide(join, rows, bucket_rows)
    left = rows.withColumnRenamed("id", "a").join(join.info("a", folded=True), "a")
    right = rows.select("sig", F.col("id").alias("b"), F.col("root").alias("other")).join(join.info("b", folded=True), "b")
    across = left.join(right, "sig").where((F.col("a") > F.col("b")) & (F.col("root") != F.col("other")))
    join.verify(across.where(_near("a", "b", percent, FOLDED_LONGS)).select("a", "b"))
    # The result reads members and links only.
    discard(pairs, candidates, known)

    roots = join.links.select(F.col("u").alias("rep"), F.col("v").alias("root"))
    return members.join(roots, "rep", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("rep", "id").alias("class_id"),
        F.coalesce("root", "rep", "id").alias("component_id"),
    )
