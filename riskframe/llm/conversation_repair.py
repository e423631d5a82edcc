"""Cheapest repair of a conversation's turn structure, by Four-Russians block tables.

A conversation is legal if the initials of its roles, in order of turns, match ``(s?(ua)+)?``. Every
message is kept (cost 0), given the role user or assistant (``RECAST``) or deleted (``DELETE``);
empty user or assistant messages may be inserted anywhere (``INSERT``); a message that breaks off
costs ``UNFINISHED`` unless deleted. Blank messages and repetitions must go. Of the cheapest repairs
the one whose edits (D, I, K, R in order) come first in ASCII order is taken.

Costs. Before every message stands a vector: the least cost to the end from each of four states
(nothing yet, after system, after user, after assistant). Insertions bound the differences within a
vector, so up to a constant there are only a few dozen vectors. ``Tables`` holds, for every such
vector and every block of ``BLOCK`` messages (nine kinds of message and one filler), the vector
before the block and the constant added. A conversation is walked from its end, a lookup per block.

Tracing. Going forward, each block is expanded once for its state and the vector behind it: inner
vectors are rebuilt backward, then the ASCII-least edit that still reaches the least cost is taken.
An edit fixes the next state, so this greedy choice settles all ties. Expansions are remembered.

Distribution. Equal messages of a turn are one row with a count. Rows are dealt by ranges of
(conversation, turn, role, start of the text), so a conversation of any length is spread, and cut
into segments of one Arrow batch. A segment in the middle of a batch is a whole conversation. The
others are functions from (vector behind, state before) to (vector before, state behind), a few
hundred bytes each; these are composed per conversation and range, then per conversation. Only
narrow rows take part in that; texts never leave their segment. The digest of a long conversation
is read as a stream.

Defined results: null roles and texts are one space; null turns come first; messages of a turn are
ordered by role, then text; null conversation ids are one conversation. Roles count by their first
letter, other roles (empty ones too) can only be recast or deleted. Extra columns are ignored. An
empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import store

RECAST, DELETE, INSERT, UNFINISHED = 2, 3, 2, 1
BLOCK = 3
# Kinds of message: 0 to 3 by initial (s, u, a, other), 4 more if it breaks off; 8 must go; 9 fills a block.
OTHER, BREAKS_OFF, MUST_GO, FILLER, KINDS = 3, 4, 8, 9, 10
STEP = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}
# The state after an inserted or recast message: user, except after user.
GIVEN = (2, 2, 3, 2)
ENDS = (0, 2 * INSERT, INSERT, 0)
TAIL = ("", "II", "I", "")
FINE, BLANK, REPEATED, UNENDED = range(4)
NO_TURN = np.iinfo(np.int64).max
SPACES = " \t\n\x0b\f\r"
# A list of repetitions that are joined in; beyond, they are joined by shuffle.
BROADCAST_ROWS = 100_000


def _before(behind: tuple[int, ...], kind: int) -> tuple[int, ...]:
    """Least costs before a message from those behind it."""
    if kind == FILLER:
        return behind
    cost = [DELETE + c for c in behind]
    if kind != MUST_GO:
        initial, extra = kind % BREAKS_OFF, UNFINISHED * (kind >= BREAKS_OFF)
        for q in range(4):
            cost[q] = min(cost[q], RECAST + extra + behind[GIVEN[q]])
            if (q, initial) in STEP:
                cost[q] = min(cost[q], extra + behind[STEP[q, initial]])
    for _ in range(2):  # insertions: at most two in a row help
        cost = [min(cost[q], INSERT + cost[GIVEN[q]]) for q in range(4)]
    return tuple(cost)


class Tables:
    """Transitions of normalised vectors over blocks, and expansions of blocks."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.vectors, to, add = [ENDS], [], []
        place = {ENDS: 0}
        for vector in self.vectors:
            row = []
            for kind in range(KINDS):
                cost = _before(vector, kind)
                low = min(cost)
                flat = tuple(c - low for c in cost)
                if flat not in place:
                    place[flat] = len(self.vectors)
                    self.vectors.append(flat)
                row.append((place[flat], low))
            to.append([v for v, _ in row])
            add.append([a for _, a in row])
        one_to, one_add = np.array(to), np.array(add)
        one_state = np.array([[self._trace(v, [kind], range(4))[1] for kind in range(KINDS)] for v in range(len(to))])
        # Tables of a block from those of its last messages and one message before them.
        self.to, self.add, self.state = one_to, one_add, one_state
        at = np.arange(len(to))[:, None, None]
        for _ in range(block - 1):
            behind, rest = self.to, np.arange(self.to.shape[1])[None, :, None]
            first = np.arange(KINDS)[None, None, :]
            mid = one_state[behind[:, :, None], first]  # (vector, rest, kind, state)
            state = self.state[at[..., None], rest[..., None], mid]
            shape = (len(to), KINDS * self.to.shape[1])
            self.state = state.transpose(0, 2, 1, 3).reshape(*shape, 4)
            self.add = (self.add[:, :, None] + one_add[behind]).transpose(0, 2, 1).reshape(shape)
            self.to = one_to[behind].transpose(0, 2, 1).reshape(shape)
        self._known: dict[tuple[int, int, int], tuple[list[str], int]] = {}

    def codes(self, kinds: np.ndarray) -> list[int]:
        """The block numbers of a run of kinds, the last block filled up."""
        missing = -len(kinds) % self.block
        full = np.append(kinds, np.full(missing, FILLER)).reshape(-1, self.block).astype(np.int64)
        return (full @ (KINDS ** np.arange(self.block - 1, -1, -1))).tolist()

    def _trace(self, vector: int, kinds: list[int], states) -> tuple[list[list[str]], list[int]]:
        """Edits at each message and the last state, from each of ``states``."""
        costs = [self.vectors[vector]]
        for kind in reversed(kinds):
            costs.append(_before(costs[-1], kind))
        costs.reverse()
        edits, ends = [], []
        for q in states:
            letters = []
            for i, kind in enumerate(kinds):
                done = ""
                while kind != FILLER:
                    now, behind = costs[i], costs[i + 1]
                    initial, extra = kind % BREAKS_OFF, UNFINISHED * (kind >= BREAKS_OFF)
                    if now[q] == DELETE + behind[q]:
                        done += "D"
                        break
                    if now[q] == INSERT + now[GIVEN[q]]:
                        done, q = done + "I", GIVEN[q]
                        continue
                    if (q, initial) in STEP and now[q] == extra + behind[STEP[q, initial]]:
                        done, q = done + "K", STEP[q, initial]
                        break
                    done, q = done + "R", GIVEN[q]
                    break
                letters.append(done)
            edits.append(letters)
            ends.append(q)
        return edits, ends

    def expand(self, vector: int, code: int, state: int) -> tuple[list[str], int]:
        """Edits at each message of a block and the state behind it."""
        key = (vector, code, state)
        if key not in self._known:
            kinds = [code // KINDS**i % KINDS for i in range(self.block - 1, -1, -1)]
            edits, ends = self._trace(vector, kinds, [state])
            self._known[key] = edits[0], ends[0]
        return self._known[key]

    def solve(self, kinds: np.ndarray, vector: int = 0, state: int = 0) -> tuple[int, int, list[str], int]:
        """Cost added, vector before, edits at each message and state behind a run of messages."""
        codes, added, behind = self.codes(kinds), 0, []
        for code in reversed(codes):
            behind.append(vector)
            added += int(self.add[vector, code])
            vector = int(self.to[vector, code])
        edits: list[str] = []
        for code, right in zip(codes, reversed(behind), strict=True):
            letters, state = self.expand(right, code, state)
            edits += letters
        return added, vector, edits[: len(kinds)], state

    def function(self, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every vector behind a run of messages: the vector before it, and the state behind it
        for every state before it."""
        to = np.arange(len(self.vectors))
        state = np.tile(np.arange(4), (len(to), 1))
        for code in reversed(self.codes(kinds)):
            state = np.take_along_axis(state, self.state[to, code], axis=1)
            to = self.to[to, code]
        return to, state


@lru_cache(maxsize=2)
def tables(block: int = BLOCK) -> Tables:
    return Tables(block)


def damage(messages: DataFrame) -> DataFrame:
    """Break messages in known ways, by crc32(conv_id:turn) modulo 20: drop, empty, cut marks, repeat, recast."""
    space = F.lit(" ")
    written = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    way = F.crc32(written.cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    broken = messages.select("conv_id", "turn", way.alias("way"), role.alias("role"), text.alias("text")).where("way <> 0")
    return broken.select(
        "conv_id",
        "turn",
        F.when(F.col("way") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("way") == 1, "").when(F.col("way") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("way") == 3, 2).otherwise(1))).alias("__copy"),
    ).drop("__copy")


def _key(conv: str) -> Column:
    return F.when(F.col(conv).isNull(), "").otherwise(F.concat(F.lit("="), F.col(conv).cast("string")))


def _faults(messages: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Distinct messages with their number of copies, kind of role and first fault."""
    space = F.lit(" ")
    rows = messages.select(
        _key(conv).alias("key"),
        F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role).cast("string"), space).alias("role"),
        F.coalesce(F.col(text).cast("string"), space).alias("text"),
    )
    rows = rows.groupBy("key", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.withColumn("digest", F.md5(F.col("text").cast("binary")))
    since = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    again = rows.groupBy("key", "role", "digest").agg(F.count(F.lit(1)).alias("rows"), F.min(since).alias("since"))
    again = store(again.where("rows > 1").drop("rows"), "repeated")
    # Counted before; a text that one conversation repeats in many turns is one row here.
    side = F.broadcast(again) if again.count() <= BROADCAST_ROWS else again
    rows = rows.join(side, ["key", "role", "digest"], "left")
    ended = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = (
        F.when(ended == "", BLANK)
        .when(F.col("since").isNotNull() & ~F.col("since.turn").eqNullSafe(F.col("turn")), REPEATED)
        .when(F.right(ended, F.lit(1)).isin(".", "!", "?"), FINE)
        .otherwise(UNENDED)
    )
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    return rows.select("key", "turn", "role", "text", "copies", kind.cast("int").alias("initial"), fault.cast("int").alias("fault"))


_SEGMENT = (
    "key string, edge boolean, part bigint, seq bigint, sub bigint, kinds array<int>, copies array<bigint>, roles array<string>, "
    "texts array<string>, blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, "
    "first_turn bigint, last_turn bigint, least_turn bigint, first_initial int, last_initial int"
)
_LEGAL = {(0, 1), (1, 2), (2, 1)}


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation and batch, from rows sorted by conversation and place in it."""
    part = TaskContext.get().partitionId()
    for seq, batch in enumerate(batches):
        n = batch.num_rows
        if not n:
            continue
        key, turn = batch.column("key"), batch.column("turn")
        copies, initial, fault = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("copies", "initial", "fault"))
        new = np.append(True, pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)) if n > 1 else np.array([True])
        start = np.flatnonzero(new)
        end = np.append(start[1:], n)
        known = turn.is_valid().to_numpy(zero_copy_only=False)
        at = turn.fill_null(0).to_numpy(zero_copy_only=False)
        fresh = known & (new | np.append(True, (at[1:] != at[:-1]) | ~known[:-1]))
        legal = np.zeros(16, bool)
        legal[[a * 4 + b for a, b in _LEGAL]] = True
        # A copy of a message follows it, and the same initial twice is never legal.
        inner = copies - 1
        inner[1:] += ~new[1:] & ~legal[initial[:-1] * 4 + initial[1:]]
        kinds = np.where((fault == BLANK) | (fault == REPEATED), MUST_GO, initial + BREAKS_OFF * (fault == UNENDED))

        def total(values: np.ndarray) -> pa.Array:
            return pa.array(np.add.reduceat(values.astype(np.int64), start), pa.int64())

        def listed(values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(np.append(start, n), pa.int32()), values)

        least = np.minimum.reduceat(np.where(known, at, NO_TURN), start)
        edge = np.zeros(len(start), bool)
        edge[[0, -1]] = True
        again = np.where(fault == BLANK, 0, copies - (fault != REPEATED))
        yield pa.RecordBatch.from_arrays(
            [
                key.take(pa.array(start)),
                pa.array(edge),
                pa.array(np.full(len(start), part, np.int64)),
                pa.array(np.full(len(start), seq, np.int64)),
                pa.array(np.arange(len(start), dtype=np.int64)),
                listed(pa.array(kinds, pa.int32())),
                listed(pa.array(copies, pa.int64())),
                listed(batch.column("role")),
                listed(batch.column("text")),
                total(np.where(fault == BLANK, copies, 0)),
                total(again),
                total(fault == UNENDED),
                total(inner),
                total(fresh),
                turn.take(pa.array(start)),
                turn.take(pa.array(end - 1)),
                pa.array(least, mask=least == NO_TURN),
                pa.array(initial[start], pa.int32()),
                pa.array(initial[end - 1], pa.int32()),
            ],
            [c.strip().split(" ")[0] for c in _SEGMENT.split(", ")],
        )


def _functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    t = tables()
    for batch in batches:
        to, state = [], []
        for kinds in batch.column("kinds").to_pylist():
            v, q = t.function(np.array(kinds, np.int64))
            to.append(v)
            state.append(q.ravel())
        lists = [pa.array(c, pa.list_(pa.int32())) for c in (to, state)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], *lists], ["key", "part", "seq", "sub", "to", "state"])


def _composed(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    to = np.arange(len(pdf["to"].iloc[0]))
    state = np.tile(np.arange(4), (len(to), 1))
    for v, q in zip(reversed(pdf["to"].tolist()), reversed(pdf["state"].tolist()), strict=True):
        state = np.take_along_axis(state, np.reshape(q, (-1, 4))[to], axis=1)
        to = np.asarray(v)[to]
    return to, state


def _placed(pdf: pd.DataFrame, vector: int, state: int) -> pd.DataFrame:
    """The vector behind and the state before each of a run of functions."""
    behind = []
    for to in reversed(pdf["to"].tolist()):
        behind.append(vector)
        vector = int(to[vector])
    behind.reverse()
    before = []
    for q, v in zip(pdf["state"].tolist(), behind, strict=True):
        before.append(state)
        state = int(q[v * 4 + state])
    return pdf.assign(vector=behind, before=before)


def _places(edges: DataFrame) -> DataFrame:
    """Vector behind, state before, and whether it is the first or last, for every segment of ``edges``."""
    function = edges.select("key", "part", "seq", "sub", "kinds").mapInArrow(
        _functions, "key string, part bigint, seq bigint, sub bigint, to array<int>, state array<int>"
    )
    function = store(function, "functions")
    order = ["seq", "sub"]

    def of_range(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        to, state = _composed(pdf)
        return pd.DataFrame({"key": [pdf.key.iloc[0]], "part": [pdf.part.iloc[0]], "to": [to], "state": [state.ravel()]})

    def of_conversation(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = _placed(pdf.sort_values("part"), 0, 0)
        ends = {"first": pdf.part == pdf.part.min(), "last": pdf.part == pdf.part.max()}
        return pdf.assign(**ends)[["key", "part", "vector", "before", "first", "last"]]

    def of_segment(pdf: pd.DataFrame, place: pd.DataFrame) -> pd.DataFrame:
        pdf = _placed(pdf.sort_values(order), int(place.vector.iloc[0]), int(place.before.iloc[0]))
        first, last = np.zeros((2, len(pdf)), bool)
        first[0], last[-1] = place["first"].iloc[0], place["last"].iloc[0]
        return pdf.assign(first=first, last=last)[["key", "part", *order, "vector", "before", "first", "last"]]

    # A group holds one row per segment of a range, then one per range.
    ranges = function.groupBy("key", "part").applyInPandas(of_range, "key string, part bigint, to array<int>, state array<int>")
    placed = ranges.groupBy("key").applyInPandas(of_conversation, "key string, part bigint, vector int, before int, first boolean, last boolean")
    return (
        function.groupBy("key", "part")
        .cogroup(placed.groupBy("key", "part"))
        .applyInPandas(of_segment, "key string, part bigint, seq bigint, sub bigint, vector int, before int, first boolean, last boolean")
    )


def _solved(kinds: Column, copies: Column, vector: Column, before: Column, first: Column, last: Column) -> Column:
    """A struct: audit and cost of a segment, and for each message it leaves: place of its source
    (-1 if inserted) and a new role if it has one."""

    @F.arrow_udf("audit string, cost bigint, source array<int>, given array<string>")
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        t = tables()
        for columns in batches:
            out = []
            for kinds, copies, vector, state, is_first, is_last in zip(*(c.to_pylist() for c in columns), strict=True):
                added, start, edits, end = t.solve(np.array(kinds, np.int64), vector, state)
                more = sum(copies) - len(copies)
                cost = added + DELETE * more + (t.vectors[start][0] if is_first else 0)
                audit, source, given = [], [], []

                def give(place: int) -> None:
                    nonlocal state
                    given.append("assistant" if state == 2 else "user")
                    source.append(place)
                    state = GIVEN[state]

                for i, letters in enumerate(edits):
                    for letter in letters:
                        if letter == "I":
                            give(-1)
                        elif letter == "R":
                            give(i)
                        elif letter == "K":
                            given.append(None)
                            source.append(i)
                            state = STEP[state, kinds[i] % BREAKS_OFF]
                    audit.append(letters + "D" * (copies[i] - 1))
                if is_last:
                    for _ in TAIL[end]:
                        give(-1)
                    audit.append(TAIL[end])
                out.append({"audit": "".join(audit), "cost": cost, "source": source, "given": given})
            yield pa.array(
                out,
                pa.struct([("audit", pa.string()), ("cost", pa.int64()), ("source", pa.list_(pa.int32())), ("given", pa.list_(pa.string()))]),
            )

    return run(kinds, copies, vector, before, first, last)


def repaired_segments(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per segment: key, place (part, seq, sub), fault counts, audit, cost and the repaired
    messages as an array of (role, text). ``edge`` marks conversations that may have other segments."""
    rows = _faults(messages, conv, turn, role, text)
    place = [F.col("key"), F.col("turn").asc_nulls_first(), F.col("role")]
    rows = rows.repartitionByRange(*place, F.substring("text", 1, 32)).sortWithinPartitions(*place, F.col("text"))
    parts = store(rows.mapInArrow(_segments, _SEGMENT), "segments")
    edges = parts.where("edge")
    placed = edges.join(_places(edges), ["key", "part", "seq", "sub"])
    whole = parts.where("not edge").select("*", F.lit(0).alias("vector"), F.lit(0).alias("before"), F.lit(True).alias("first"), F.lit(True).alias("last"))

    def message(z: Column) -> Column:
        old = z["source"] >= 0
        return F.struct(
            F.coalesce(z["given"], F.when(old, F.get("roles", z["source"]))).alias("role"),
            F.when(old, F.get("texts", z["source"])).otherwise("").alias("text"),
        )

    def solved(side: DataFrame) -> DataFrame:
        done = side.withColumn("s", _solved(*(F.col(c) for c in ("kinds", "copies", "vector", "before", "first", "last"))))
        repaired = F.transform(F.arrays_zip(F.col("s.source").alias("source"), F.col("s.given").alias("given")), message)
        return done.select("*", "s.audit", "s.cost", repaired.alias("repaired")).drop("s", "kinds", "copies", "roles", "texts", "vector", "before", "first", "last")

    return solved(whole).unionByName(solved(placed))


def repaired_messages(segments: DataFrame) -> DataFrame:
    """One row per repaired message: key, place (part, seq, sub, position), role and text."""
    return segments.select("key", "part", "seq", "sub", F.posexplode("repaired").alias("position", "m")).select(
        "key", "part", "seq", "sub", "position", "m.role", "m.text"
    )


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")
_REPORT = "key string, gaps bigint, " + ", ".join(f"{c} bigint" for c in _COUNTS) + ", audit string, repaired_sha256 string"


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reports from segments sorted by key and place; texts pass through the digest one at a time."""
    key, out = None, None
    state: dict = {}

    def finished() -> dict:
        known = state["first"] is not None
        gaps = state["last"] - state["first"] + 1 - state["turns"] if known else 0
        row = {"key": key, "gaps": gaps, **{c: state[c] for c in _COUNTS}}
        return row | {"audit": "".join(state["audit"]), "repaired_sha256": state["sha"].hexdigest()}

    names = [c.strip().split(" ")[0] for c in _REPORT.split(", ")]
    types = [pa.string(), pa.int64(), *[pa.int64() for _ in _COUNTS], pa.string(), pa.string()]
    schema = pa.schema(list(zip(names, types, strict=True)))
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["key"] != key:
                if key is not None:
                    out.append(finished())
                key = row["key"]
                state = {c: 0 for c in _COUNTS} | {"turns": 0, "first": None, "last": None, "audit": [], "sha": hashlib.sha256(), "any": False}
            elif (state["initial"], row["first_initial"]) not in _LEGAL:
                state["illegal"] += 1
            for c in (*_COUNTS, "turns"):
                state[c] += row[c]
            if row["first_turn"] is not None and row["first_turn"] == state["last"]:
                state["turns"] -= 1
            if row["last_turn"] is not None:
                state["last"] = row["last_turn"]
                if state["first"] is None:
                    state["first"] = row["least_turn"]
            state["initial"] = row["last_initial"]
            state["audit"].append(row["audit"])
            if row["n"]:
                state["sha"].update((("\n" if state["any"] else "") + row["body"]).encode())
                state["any"] = True
        yield pa.RecordBatch.from_pylist(out, schema)
    if key is not None:
        yield pa.RecordBatch.from_pylist([finished()], schema)


def conversation_report(messages: DataFrame, segments: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Per conversation of ``messages``: gaps between turns, faults, cost, audit and digest of the repair.

    A conversation without segments has zeros, no edits and the digest of no text.
    """
    body = F.array_join(F.transform("repaired", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "\n")
    rows = segments.select(
        "key", "edge", "part", "seq", "sub", *_COUNTS, "turns", "first_turn", "last_turn", "least_turn", "first_initial", "last_initial",
        "audit", F.size("repaired").alias("n"), body.alias("body"),
    )
    gaps = F.coalesce(F.col("last_turn") - F.col("least_turn") + 1 - F.col("turns"), F.lit(0))
    digest = F.sha2(F.col("body").cast("binary"), 256).alias("repaired_sha256")
    whole = rows.where("not edge").select("key", gaps.alias("gaps"), *_COUNTS, "audit", digest)
    edges = rows.where("edge").repartition("key").sortWithinPartitions("key", "part", "seq", "sub").mapInArrow(_fold, _REPORT)
    found = whole.unionByName(edges)
    ids = messages.select(F.col(conv)).distinct().withColumn("key", _key(conv))
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", *_COUNTS)]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return ids.join(found, "key", "left").select(
        conv, *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256")
    )
