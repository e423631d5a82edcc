import pytest
from riskframe.llm import pii

SECRETS = ["9233A8ECB04D77F1", "9233a8ECB04d77f10c", "ABCDEFABCDEFABCDEFAB", "9233a8ecb04d77f1"]
LOCALS = ["иван.петров", "γιώργος", "Ελένη", "王小明", "김철수", "Ивaн7", "łukasz", "م.علي٣", "ꀀꀁ", "𠀀𠀁"]


@pytest.mark.parametrize("key", ["k", "other"])
def test_secrets_of_either_case_and_letters_of_every_script_move(spark, key):
    texts = [f'TOKEN = "{s}"' for s in SECRETS] + [f"mail {x}@mail7.example.com now" for x in LOCALS]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    done = pii.pseudonymise_counted(df, key)
    rows = {r.doc_id: r for r in done.collect()}
    for i, secret in enumerate(SECRETS):
        new = rows[i].text.split('"')[1]
        assert rows[i].n_secret == 1 and len(new) == len(secret) and new != secret
        if secret != secret.lower():
            assert [c.isupper() for c in new] == [c.isupper() for c in secret]
    for i, local in enumerate(LOCALS, len(SECRETS)):
        new = rows[i].text.split(" ")[1].split("@")[0]
        assert rows[i].n_email == 1 and len(new) == len(local)
        assert new != local and all(c.isalnum() == d.isalnum() for c, d in zip(new, local, strict=True))
    back = pii.pseudonymise(done.select("doc_id", "text"), key, invert=True).collect()
    assert {r.doc_id: r.text for r in back} == dict(enumerate(texts))
