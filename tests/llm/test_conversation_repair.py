import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from riskframe.llm import conversation_repair as repair
from riskframe.llm import queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string, key string, copies string, part int"
ROLES = {0: "user", 1: "user", 2: "assistant", 3: "user"}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        way = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if way:
            text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
            out += [(conv, turn, "user" if way == 4 else role, text)] * (2 if way == 3 else 1)
    return out


def cheapest(messages, faults):
    """Cost, edits and repaired messages by a search over all edit sequences, least (cost, edits) first."""
    heap = [(0, "", 0, 0, ())]
    seen = set()
    while True:
        cost, edits, i, q, done = heapq.heappop(heap)
        if i == len(messages) and q in (0, 3):
            return cost, edits, done
        if (i, q) in seen:
            continue
        seen.add((i, q))
        role = ROLES[q] if q != 2 else "assistant"
        heapq.heappush(heap, (cost + 2, edits + "I", i, repair.GIVEN[q], (*done, (role, ""))))
        if i < len(messages):
            heapq.heappush(heap, (cost + 3, edits + "D", i + 1, q, done))
            if faults[i] not in ("blank", "duplicate"):
                extra = faults[i] == "truncated"
                heapq.heappush(heap, (cost + 2 + extra, edits + "R", i + 1, repair.GIVEN[q], (*done, (role, messages[i][1]))))
                step = repair.STEP.get((q, "sua".find(messages[i][0][:1]) if messages[i][0] else -1))
                if step:
                    heapq.heappush(heap, (cost + extra, edits + "K", i + 1, step, (*done, messages[i])))


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = [r[1:] for r in damaged(rows) if r[0] == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        messages, faults = [(r, t) for _, r, t in own], []
        for i, (role, text) in enumerate(messages):
            words = text.strip(" \t\n\x0b\f\r")
            faults.append("blank" if not words else "duplicate" if (role, text) in messages[:i] else "" if words[-1] in ".!?" else "truncated")
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(messages, messages[1:], strict=False))
        cost, edits, done = cheapest(messages, faults)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in done).encode()).hexdigest()
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, edits, digest)
    return out


def conversations(seed, number):
    rng = random.Random(seed)
    said = ["Yes.", "No", "Well, that is fine!", " \t", "", None, "What?  \n", "ünd ß", "Cut off"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
    rows = []
    for conv in range(number):
        conv = None if conv == 7 else conv
        for turn in range(rng.randrange(0, 12)):
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), rng.choice(roles), rng.choice([*said, f"Text {turn}."])))
    return rows + rows[:20]


def report(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA).repartition(4)
    segments = repair.repaired_segments(repair.damage(df))
    found = repair.conversation_report(df, segments).collect()
    assert len({r.conv_id for r in found}) == len(found)
    return {r.conv_id: tuple(r)[1:] for r in found}, segments


def test_reports_equal_brute_force(spark):
    rows = conversations(1, 300)
    found, segments = report(spark, rows)
    assert found == brute(rows)
    listed = repair.repaired_messages(segments).where("key = '=12'").orderBy("part", "seq", "sub", "position").collect()
    assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in listed).encode()).hexdigest() == found[12][-1]


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_hot_conversation_is_cut_into_many_segments(spark, small_batches):
    rng = random.Random(3)
    rows = [(5, t, rng.choice(["user", "assistant", "system"]), rng.choice([f"Line {t}.", "ok", f"cut {t}"])) for t in range(250)]
    rows += conversations(4, 20)[:60]
    rows = [r for r in rows if r[0] != 5 or r[3] is None or r[3].startswith(("Line", "ok", "cut"))]
    found, segments = report(spark, rows)
    assert found == brute(rows)
    assert segments.where("key = '=5'").count() > 20 and segments.where("key = '=5'").select("part").distinct().count() > 1


def test_block_tables_equal_single_steps():
    rng, t = random.Random(6), repair.tables()
    for v, vector in enumerate(t.vectors):
        for _ in range(40):
            kinds = [rng.randrange(repair.KINDS) for _ in range(repair.BLOCK)]
            code, cost = sum(k * repair.KINDS**i for i, k in enumerate(reversed(kinds))), vector
            for kind in reversed(kinds):
                cost = repair._before(cost, kind)
            assert t.add[v, code] == min(cost) and t.vectors[t.to[v, code]] == tuple(c - min(cost) for c in cost)
            assert [t.expand(v, code, q)[1] for q in range(4)] == t.state[v, code].tolist()
            to, state = t.function(np.array(kinds * 3))
            assert t.solve(np.array(kinds * 3), v, 2)[1::2] == (to[v], state[v, 2])


def test_long_texts_and_an_empty_table(spark):
    rows = [(1, 1, "user", "word " * 200_000 + "end."), (1, 2, "assistant", "x" * 500_000)]
    assert report(spark, rows)[0] == brute(rows)
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA).where(F.lit(False))
    assert repair.conversation_report(df, repair.repaired_segments(repair.damage(df))).count() == 0
