import hashlib
import random

import pyarrow as pa
import pytest
from data import TEXTS, documents, empty
from riskframe.llm import bpe_lexicon as b
from riskframe.llm import queries

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def library():
    out = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out.no_truncation()
    out.no_padding()
    return out


@pytest.fixture(scope="module")
def words():
    return queries.vocabulary()


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def odd_texts():
    rng = random.Random(9)
    pool = "aAzZ09 \t\n'´’éÉßİıΣσς中文字①²٣́ -_.,!%#|<>😀👍🏽각Ωﬁ"
    texts = ["".join(rng.choices(pool, k=rng.randint(0, 40))) for _ in range(400)]
    texts += ["<|endoftext|> hi <|startoftext|><|endoftext|>É", "it's we've I'LL they'd 'S", "ΑΣ ΑΣΑ", "a" * 5000, "\0<|x"]
    return texts + [t for t in TEXTS if t is not None]


def test_encoding_equals_the_library(spark, library, words):
    texts = odd_texts() + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    lexicon = b.build_lexicon(df, words, max_words=300)
    found = b.decode_docs(b.encode_docs(df, words, lexicon), words).collect()
    for r in found:
        assert (r.ids, r.decoded) == expected(library, r.text), repr(r.text[:60] if r.text else r.text)


def test_short_and_long_merges_agree(library, words):
    merger, rng = b.Merger(words), random.Random(2)
    for _ in range(300):
        word = "".join(rng.choices("thandreéßinger", k=rng.randint(1, 39)))
        data = word.encode()
        ids = [merger.inner[x] for x in data]
        ids[-1] = merger.last[data[-1]]
        assert merger._merge_short(list(ids)) == merger._merge_long(list(ids)) == library.encode(word).ids


def test_transducer_is_minimal_and_ranks_words(tmp_path):
    stems = ["walk", "talk", "stalk", "jump"]
    entries = {(s + e).encode(): [i, j] for i, s in enumerate(stems) for j, e in enumerate(["", "s", "ed", "ing"])}
    entries["été".encode()] = [7]
    lexicon = b.Lexicon.compile(entries)
    (tmp_path / "x.bin").write_bytes(lexicon.to_bytes())
    mapped = b.Lexicon.map(str(tmp_path / "x.bin"))
    ranks = mapped.ranks([*sorted(entries), b"wal", b"walke", b"zz", b""]).tolist()
    assert ranks == [*range(len(entries)), -1, -1, -1, -1]
    for word, r in zip(sorted(entries), ranks, strict=False):
        assert mapped.ids[mapped.at[r] : mapped.at[r + 1]].tolist() == entries[word]
    # The endings share their states: one ending automaton, not one per stem.
    assert len(mapped.final) < 25
    assert b.Lexicon.compile({}).ranks([b"a"]).tolist() == [-1]


def test_odd_rows(spark, words):
    lexicon = b.build_lexicon(documents(spark), words)
    rows = b.encode_docs(documents(spark), words, lexicon).collect()
    assert len(rows) == 12 and all(r.ids == [] for r in rows if r.doc_id in (3, 4, 5))
    nothing = b.build_lexicon(empty(spark), words)
    assert b.encode_docs(empty(spark), words, nothing).count() == 0
    assert b.decode_docs(spark.createDataFrame([(None,), ([],)], "ids array<int>"), words).collect()[0].decoded == ""


def test_query_digests(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    for r in queries.op3_bpe(spark, sf).collect():
        ids, decoded = expected(library, texts[r.doc_id])
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert (r.n_tokens, r.ids_sha256) == (len(ids), digest)
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_slices_cover_all_rows(monkeypatch):
    monkeypatch.setattr(b, "CHUNK_CHARS", 10)
    texts = ["abc", None, "", "x" * 50, "éé", "defg", "h" * 10, None]
    for rows in (texts, [], texts[:1]):
        assert [t for part in b._slices(pa.array(rows, pa.string())) for t in part] == rows
    assert [len(p) for p in b._slices(pa.array(["12345"] * 4))] == [1, 1, 1, 1]
    assert [len(p) for p in b._slices(pa.array(["1"] * 25))] == [9, 9, 7]
