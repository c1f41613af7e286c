import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "the cat and a dog or two in an old house by the sea " * 20_000


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in any column, empty, blank and very long texts, repeated rows, and extra columns named like results."""
    rows = [
        (1, "the quick brown fox and the lazy dog are here to stay for a while", "en", "a", 60),
        (1, "the quick brown fox and the lazy dog are here to stay for a while", "en", "a", 60),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, " \t\n\r\x0b\x0c ", "de", None, 7),
        (5, LONG, "en", "a", len(LONG)),
        (6, "12345 *** !!!   \U0001f600", None, "b", 3),
        (None, "eine kleine Katze und der Hund sind hier", "de", "b", 40),
        (None, "eine kleine Katze und der Hund sind hier", "de", "b", 40),
        (7, "x" * 300_000, "fr", "b", 300_000),
        (8, "a\x00b � café İstanbul \U00010400", "fr", "b", 20),
    ]
    df = spark.createDataFrame(rows, DOCS)
    extra = "part first ids at base fp root n t k p q_text words kept score lang_pred fingerprint component_id _found id label".split()
    return df.selectExpr("*", *[f"'clash' AS {c}" for c in extra])


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
