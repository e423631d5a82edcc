"""Operators in DataFrame operations: pseudonyms, tool calls, search; and the registered queries."""

import datetime
import hashlib
import itertools
import json
import sys
from pathlib import Path

import numpy as np
import pytest
from data import TEXTS, documents, empty
from pyspark.sql import functions as F
from riskframe.llm import pii, queries, toolcalls, topk_mih

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

import check  # noqa: E402

SF = "/root/testdata/sf0.001"


def digest(key, tweak, turn, other):
    return hashlib.sha512(f"{key}|{tweak}|{turn}|{other}".encode()).hexdigest()


def plain_permute(value, key, tweak, alphabets):
    """The network over characters, written again in Python."""
    half = len(value) // 2
    left, right = value[:half], value[half:]

    def shift(part, d):
        out = ""
        for i, c in enumerate(part):
            amount = int(d[i % 32 * 4 : i % 32 * 4 + 4], 16)
            own = next((a for a in reversed(alphabets) if c in a), None)
            out += own[(own.index(c) + amount) % len(own)] if own else c
        return out

    for turn in range(1, 9):
        if turn % 2:
            left = shift(left, digest(key, tweak, turn, right))
        else:
            right = shift(right, digest(key, tweak, turn, left))
    return left + right


def replaced(spark, text, **more):
    df = spark.createDataFrame([(text,)], "text string")
    return pii.pseudonymise(df, "k", **more).first().text


def luhn(number):
    digits = [int(c) for c in number if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def test_values_keep_their_format_and_links(spark):
    text = "x 4929348385146306, 4929 3483 8514 6306 +1 (017) 555-7713 10.1.200.3 me.07@mail7.example.com 1984-02-29"
    parts = replaced(spark, text).split(" ")
    assert "4929348385146306" not in "".join(parts) and luhn(parts[1]) and parts[1].strip(",") == "".join(parts[2:6])
    assert parts[6] == "+1" and parts[7][0] == "(" and parts[8][3] == "-" and parts[8] != "555-7713"
    assert all(0 <= int(p) <= 255 for p in parts[9].split(".")) and parts[9] != "10.1.200.3"
    assert parts[10].endswith("@mail7.example.com") and parts[10][2] == "."
    assert datetime.date.fromisoformat(parts[11])
    assert parts[10].split("@")[0] == plain_permute("me.07", "k", "email", pii.ALPHABETS)
    assert parts[1][:15] == plain_permute("492934838514630", "k", "card", (pii.DIGITS,))


def test_neighbouring_values_are_all_found(spark):
    text = "+1 (826) 555-4081 190.137.223.204 4929348385146306 12 4929348385146306 7 +49 30 1234567 10.0.0.1 und.34@mail7.example.com"
    df = spark.createDataFrame([(text,)], "text string")
    found = pii.pseudonymise_counted(df, "k").first()
    assert [found[f"n_{k}"] for k in ("phone", "ip", "card", "email")] == [2, 2, 2, 1]
    assert not set(text.split()) & set(found.text.split()) - {"12", "7", "+1", "+49"}


@pytest.mark.parametrize(
    "text",
    [
        "9807915762804490 fails the Luhn check", "999.1.2.3 is no address", "2023-02-30 and 13/40/2000 are no dates",
        "+1 23 is short", "plain words only", "version 1.2.3.4.5", "a 40-digit hash 9b0b3c6a43eb78aa99cbd7049c572391524f37a8",
    ],
)
def test_values_that_fail_validation_stay(spark, text):
    assert replaced(spark, text) == text


def test_every_number_of_a_domain_has_its_own_image(spark):
    side = 12
    df = spark.range(side * side).select("id", pii.permute_number(F.col("id"), side, "k", "t").alias("x"))
    images = {r.id: r.x for r in df.collect()}
    assert sorted(images.values()) == list(range(side * side)) and images != {i: i for i in images}
    back = df.select("id", pii.permute_number(F.col("x"), side, "k", "t", invert=True).alias("y"))
    assert back.where("id <> y").count() == 0


def test_pii_round_trip_over_a_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    done = pii.pseudonymise_counted(docs, "k")
    assert done.agg(*[F.sum(f"n_{k}").alias(k) for k in ("email", "card", "ip")]).first()[0] > 0
    back = pii.pseudonymise(done.select("doc_id", "text"), "k", invert=True).withColumnRenamed("text", "again")
    assert docs.join(back, "doc_id").where("not (text <=> again)").count() == 0


def test_pii_odd_rows(spark):
    found = pii.pseudonymise_counted(documents(spark), "k").collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == 12 and by_id[3].text is None and by_id[4].text == "" and by_id[8].text == TEXTS[8]
    assert [by_id[9][f"n_{k}"] for k in ("email", "phone", "card", "ip")] == [1, 1, 1, 1]
    assert pii.pseudonymise(documents(spark), "k").columns == documents(spark).columns
    assert pii.pseudonymise(empty(spark), "k").count() == 0


def test_pii_plan_has_no_python(spark):
    plan = pii.pseudonymise_counted(documents(spark).select("doc_id", "text"), "k")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


SCHEMAS = {"f": {"a": {"type": "integer", "required": True, "min": 1}, "b": {"type": "string"}}}


def linked(spark, calls, results):
    c = spark.createDataFrame(calls, "conv_id bigint, call_id string, parent_id string, turn bigint, tool string, arguments string")
    r = spark.createDataFrame(results, "conv_id bigint, call_id string, turn bigint")
    return {(x.conv_id, x.call_id): x for x in toolcalls.link_calls(c, r, SCHEMAS).collect()}


def test_calls_are_linked_ordered_and_checked(spark):
    ok = '{"a": 1}'
    calls = [
        (1, "x", None, 1, "f", ok), (1, "y", "x", 0, "f", '{"b": "s", "a": 0}'), (1, "z", "y", 3, "f", '{"a": "s", "c": 1}'),
        (1, "p", "q", 4, "f", ok), (1, "q", "p", 5, "f", ok), (1, "behind", "q", 6, "f", ok),
        (1, "lost", "nowhere", 7, "g", ok), (2, "x", None, 1, "f", "[1]"), (2, "x", None, 9, "f", ok), (None, "x", None, 1, "f", ok),
        (3, "n", None, 1, "f", None), (3, "m", None, 2, "f", '{"a": 1, "a": 2}'),
    ]
    calls += [(4, f"c{i}", f"c{i - 1}" if i else None, 1000 - i, "f", ok) for i in range(70)]
    got = linked(spark, calls, [(1, "x", 2), (1, "x", 8), (9, "gone", 3), (1, None, 1)])
    assert len(got) == len(calls) - 2 + 1
    assert (got[1, "x"].status, got[1, "x"].result_turn, got[1, "x"].depth, got[1, "x"].errors) == ("answered", 2, 0, [])
    assert (got[1, "y"].status, got[1, "y"].depth, got[1, "y"].errors) == ("unanswered", 1, ["range:a"])
    assert (got[1, "z"].depth, got[1, "z"].errors) == (2, ["type:a", "unknown:c"])
    assert {got[1, k].status for k in ("p", "q", "behind")} == {"cycle"} and got[1, "behind"].depth is None
    assert (got[1, "lost"].depth, got[1, "lost"].errors) == (0, ["parent", "tool"])
    assert got[2, "x"].errors == ["object"] and got[3, "n"].errors == ["object"] and got[3, "m"].errors == ["object"]
    assert got[9, "gone"].status == "orphan" and got[9, "gone"].errors is None
    assert all(got[4, f"c{i}"].depth == i for i in range(70))


def test_lines_are_canonical_and_empty_tables_work(spark):
    m = spark.createDataFrame([(1, 0, "user", 'say "é"\n'), (1, 1, "assistant", None)], "conv_id bigint, turn bigint, role string, text string")
    m = m.withColumn("status", F.lit("clash"))
    c = spark.createDataFrame([(1, "x", None, 0, "f", '{"b":"s" , "a" : 2.50}')], "conv_id bigint, call_id string, parent_id string, turn bigint, tool string, arguments string")
    r = spark.createDataFrame([(1, "x", 1)], "conv_id bigint, call_id string, turn bigint")
    rows = sorted(toolcalls.message_lines(m, toolcalls.link_calls(c, r, SCHEMAS)).collect(), key=lambda x: x.turn)
    assert rows[0].line == '{"call":{"arguments":{"a":2.5,"b":"s"},"id":"x","tool":"f","valid":false},"content":"say \\"é\\"\\n","role":"user","turn":0}'
    assert rows[1].line == '{"answers":"x","role":"assistant","turn":1}'
    nothing = toolcalls.link_calls(c.where("false"), r.where("false"), SCHEMAS)
    assert nothing.count() == 0 and toolcalls.message_lines(m.where("false"), nothing).count() == 0


def test_parallel_calls_and_answers_keep_one_row_per_message(spark):
    long = "word " * 50_000
    m = spark.createDataFrame([(1, 0, "user", long), (1, 1, "assistant", "done"), (1, 2, "user", "thanks")], "conv_id bigint, turn bigint, role string, text string")
    c = spark.createDataFrame(
        [(1, "b", None, 0, "f", '{"a": 1, "b": "s"}'), (1, "a", None, 0, "f", "[]"), (1, "c", "a", 0, "f", "{}")],
        "conv_id bigint, call_id string, parent_id string, turn bigint, tool string, arguments string",
    )
    r = spark.createDataFrame([(1, "a", 1), (1, "b", 1)], "conv_id bigint, call_id string, turn bigint")
    rows = sorted(toolcalls.message_lines(m, toolcalls.link_calls(c, r, SCHEMAS)).collect(), key=lambda x: x.turn)
    assert len(rows) == 3
    first, second = json.loads(rows[0].line), json.loads(rows[1].line)
    assert [x["id"] for x in first["calls"]] == ["a", "b", "c"] and first["content"] == long and "call" not in first
    assert (rows[0].call_id, rows[0].status, rows[0].depth) == ("a;b;c", "answered;answered;unanswered", 1)
    assert rows[0].errors.split(";")[0] == "object" and rows[0].errors.count(";") == 2
    assert second == {"answer_ids": ["a", "b"], "content": "done", "role": "assistant", "turn": 1}
    assert (rows[2].call_id, rows[2].status, rows[2].depth, rows[2].errors) == (None, "plain", None, None)


def brute_top(rows, queries_, k):
    ids = sorted({(i, tuple(x >= 0 for x in v)) for i, v in rows if i is not None and v is not None})
    out = set()
    for q, qc in ids:
        if q in queries_:
            near = sorted((sum(a != b for a, b in zip(qc, c, strict=True)), i) for i, c in ids if i != q)[:k]
            out |= {(q, r + 1, i, d) for r, (d, i) in enumerate(near)}
    return out


@pytest.mark.parametrize("bits, n", [(64, 400), (20, 150), (8, 90)])
def test_top_k_equals_brute_force(spark, bits, n):
    rng = np.random.default_rng(bits)
    rows = [(i, rng.normal(size=bits).tolist()) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(60)] + [(5, rows[5][1]), (None, rows[5][1]), (9999, None)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("code", F.lit(1))
    found = topk_mih.search(df, df.where("vec_id % 10 = 0"), k=7)
    got = {tuple(r) for r in found.select("query_id", "rank", "neighbor_id", "distance").collect()}
    assert got == brute_top(rows, {i for i in range(n + 60) if i % 10 == 0}, 7)


def test_top_k_of_few_and_no_rows(spark):
    df = spark.createDataFrame([(1, [1.0, -1.0]), (2, [1.0, 1.0])], "vec_id bigint, embedding array<double>")
    assert [tuple(r) for r in topk_mih.search(df, df).orderBy("query_id").collect()] == [(1, 1, 2, 1), (2, 1, 1, 1)]
    assert topk_mih.search(df.where("false"), df.where("false")).count() == 0


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_their_sql(spark, con, name):
    status, n, note = check.compare(queries.QUERIES[name](spark, SF), con, queries.ORACLES[name])
    assert status == "ok" and n > 0, note


def test_all_are_registered():
    assert [int(n.split("_")[0][2:]) for n in queries.QUERIES] == list(range(1, 14))
    assert list(itertools.islice(queries.QUERIES, 1)) == ["op1_quality"]
