import pyarrow as pa
from riskframe.llm import bpe_lexicon, queries


def test_encoded_batches_stay_small_and_complete(spark, monkeypatch):
    words = queries.vocabulary()
    sizes = []
    monkeypatch.setattr(bpe_lexicon, "_Encoder", lambda *_: _Fake())
    monkeypatch.setattr(bpe_lexicon.F, "arrow_udf", lambda _: lambda run: lambda text: run)
    run = bpe_lexicon.encode_and_decode(None, words, "none")
    texts = ["x" * (bpe_lexicon.CHUNK_CHARS // 3)] * 10 + [None, ""]
    for part in run(iter([pa.array(texts, pa.string()), pa.array([], pa.string())])):
        sizes.append(len(part))
    assert sum(sizes) == len(texts) and max(sizes) <= 4 + 2


class _Fake:
    def encode(self, texts):
        return pa.array([[1] if t else [] for t in texts], pa.list_(pa.int32()))
