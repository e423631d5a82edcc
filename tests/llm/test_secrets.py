import hashlib
import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from data import LONG, documents, empty
from pyspark.sql import functions as F
from riskframe.llm import queries, secrets

ALLOWED = [re.compile(p, re.S) for p in secrets.ALLOWED]
BASE64 = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"


def base_spans(text):
    found = [
        (m.start(), 0, m.end(), "assign")
        for m in re.finditer(r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text)
        if len(m[2]) >= 6
    ]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return found + [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]


def entropy(window):
    return -sum(c / len(window) * math.log2(c / len(window)) for c in Counter(window).values())


def brute(text):
    """Every window of every candidate, counted anew."""
    spans = base_spans(text)
    for k, c in enumerate(secrets.CLASSES, 3):
        earlier = list(spans)
        for m in re.finditer("[" + re.escape(c.characters.decode()) + "]{%d,}" % c.window, text):
            run, merged = m[0], []
            for i in range(len(run) - c.window + 1):
                w = run[i : i + c.window]
                if entropy(w) >= c.bits - 1e-9 and re.search("[A-Za-z]", w) and re.search("[0-9]", w):
                    if merged and i <= merged[-1][1]:
                        merged[-1][1] = i + c.window
                    else:
                        merged.append([i, i + c.window])
            for b, e in merged:
                b, e = b + m.start(), e + m.start()
                inside = any(x <= b and e <= y for x, _, y, _ in earlier)
                if not inside and not secrets.is_allowed(run.encode(), ALLOWED):
                    spans.append((b, k, e, f"entropy_{c.name}"))
    return [(n, a, b) for a, _, b, n in sorted(spans)]


def texts(seed, number):
    rng = random.Random(seed)
    parts = [
        lambda: "".join(rng.choices(BASE64, k=rng.randrange(15, 60))),
        lambda: "".join(rng.choices("0123456789ABCDEFabcdef", k=rng.randrange(20, 60))),
        lambda: rng.choice(["Token", "API_KEY", "passwd"]) + rng.choice(['"', ""]) + rng.choice(["", "  "]) + rng.choice(":=")
        + rng.choice([" '", ""]) + "".join(rng.choices(BASE64, k=rng.randrange(3, 12))),
        lambda: "AKIA" + "".join(rng.choices("ABCDEFGHIJ0123456789", k=rng.randrange(12, 20))),
        lambda: "é ünd ß 日本",
        lambda: "".join(rng.choices("0123456789abcdef", k=rng.randrange(20, 50))),
        lambda: "".join(rng.choices(BASE64, k=1300)),
        lambda: "abcdefghijklmnopqrstuvwxyz0123456789",
        lambda: "123e4567-e89b-12d3-a456-426614174000",
        lambda: "token=token=abcdefg ſecret=abcdefgh apiKey=abcdefgh",
    ]
    return [rng.choice([" ", "", "\n"]).join(rng.choice(parts)() for _ in range(rng.randrange(8))) for _ in range(number)]


@pytest.mark.parametrize("seed", [1, 2])
def test_spans_equal_brute_force(seed):
    rows = [None, "", "AKIA", "token", ":", "deadbeef" * 3, "deadbeef" * 3, *texts(seed, 800)]
    found = secrets._scan(pa.array(rows, pa.string()), secrets.CLASSES, ALLOWED).to_pylist()
    for text, spans in zip(rows, found, strict=True):
        assert [(s["kind"], s["start"], s["end"]) for s in spans] == brute(text or ""), text


def test_windows_of_long_candidates_are_complete():
    rng = random.Random(5)
    quiet, loud = "a1" * 900, "".join(rng.sample(BASE64, 40))
    text = quiet + loud + quiet + loud + "x" * secrets.PIECE
    found = secrets._scan(pa.array([text]), secrets.CLASSES, ALLOWED).to_pylist()[0]
    assert [(s["kind"], s["start"], s["end"]) for s in found] == brute(text)


def test_allow_list_suppresses_only_added_spans():
    hidden = "Zq3Xv8Lm1Tw6Rb9Kd4Hs7"
    for text, kinds in [
        (hidden, ["entropy_base64"]),
        ("EXAMPLE" + hidden, []),
        ("token=EXAMPLE" + hidden, ["assign"]),
        ("usr/local/lib/python/site-packages/numpy/core/2024/include", []),
        ("F3A9C05D7E1B486290CDAF31", ["entropy_hex"]),
    ]:
        found = secrets._scan(pa.array([text]), secrets.CLASSES, ALLOWED).to_pylist()[0]
        assert [s["kind"] for s in found] == kinds, text


def test_query_digests_whole_texts(spark, tmp_path):
    secret = "é" * 10 + ' token = "0123456789abcdef0123456789"'
    rows = [(1, secret), (1, secret), (2, None), (3, ""), (None, "AKIA" + "Z9" * 9), (4, LONG + secret)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_secrets(spark, str(tmp_path)).collect()
    assert len(found) == len(rows)
    texts_by_id = dict(rows)
    for r in found:
        spans = sorted(base_spans(texts_by_id[r.doc_id] or ""))
        text = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[3] == k for s in spans) for k in secrets.BASE)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest() and r.spans == text


def test_odd_and_empty_tables(spark):
    docs = documents(spark).withColumn("spans", F.lit(1))
    found = secrets.find_secrets(docs)
    assert found.columns == docs.columns and found.count() == 12
    assert secrets.find_secrets(empty(spark)).count() == 0
