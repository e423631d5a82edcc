"""Small tables with the odd cases every operator has to survive."""

from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977}" for i in range(60_000))
TEXTS = [
    "The quick brown fox jumps over the lazy dog. " * 8,
    "The quick brown fox jumps over the lazy dog. " * 8,
    "Der schnelle braune Fuchs springt über den faulen Hund. " * 6,
    None,
    "",
    " \n\t ",
    "12345 %%% !!!",
    "a",
    LONG,
    "mail me.07@mail7.example.com or +1 (017) 555-7713, card 4929348385146306 at 10.1.2.3",
]


def documents(spark):
    """Ids with a null and a repeated row; extra columns named like outputs."""
    rows = [(i, t, "en" if i != 2 else "de", f"src{i % 2}") for i, t in enumerate(TEXTS)]
    rows += [(0, TEXTS[0], "en", "src0"), (None, "an id is missing here", None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    return df.withColumns({"score": F.lit("x"), "shard": F.lit("y"), "id": F.lit("z"), "Kept": F.lit(1), "n": F.lit(2)})


def empty(spark):
    return documents(spark).where("false")
