import pytest

# Texts with what the operators must get through: NULL and empty, one very
# long, ties and repeated rows, NULL ids and sources, odd white space.
LONG = "lorem ipsum dolor sit amet consectetur " * 8000
ROWS = [
    (1, "Alpha beta gamma delta epsilon", "en", "a", 30),
    (2, "alpha BETA gamma delta epsilon", "en", "a", 30),
    (3, None, "en", "b", 0),
    (4, "", "en", None, 0),
    (5, LONG, "en", "a", len(LONG)),
    (6, "\x0b \t\r\n", None, "b", 5),
    (7, "Ünï çödé ÀÉ 漢字 🙂 mail me: jo.doe@example.org or +1 (555) 010-9999", "xx", "c", None),
    (8, "alpha beta gamma delta epsilon", "en", "a", 30),
    (8, "alpha beta gamma delta epsilon", "en", "a", 30),
    (None, "one two three four five six", "en", "b", 27),
    (9, "a  b\n\nc   d <|endoftext|> e", "en", "c", 20),
    (10, "\x1c\x85\xa0 nbsp em", "en", None, 9),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with extra columns whose names clash with results."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("kept", "digest", "score", "fp", "part", "n", "rid", "root"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
