import random

import pytest

LONG_WORD = "x" * 40_000
COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, score double, "
           "digest string, block int, size int, label string, place string, row string")


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(["the", "river", "runs", "over", "green", "stones", "and", "birds",
                                "sing", "near", "old", "mills", "while", "clouds", "drift"])
                    + rng.choice(["", "s", "ed", "ing", "er"]) for _ in range(n))


def filled(doc_id, text, lang="en", source="src0", n_chars=None):
    n_chars = len(text) if n_chars is None and text is not None else n_chars
    return (doc_id, text, lang, source, n_chars, 0.5, "d", 1, 2, "l", "p", "r")


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing names."""
    rows = [
        filled(1, prose(1, 300)), filled(1, prose(1, 300)), filled(2, prose(1, 300)),
        filled(3, ""), filled(4, None), filled(5, None, None, None, None), filled(None, prose(2, 50)),
        filled(None, None, None, None), filled(6, " ".join([LONG_WORD, prose(3, 4000)])),
        filled(7, "a"), filled(8, "one two three"), filled(9, "漢字かな交じり文。 😀 é"),
        filled(10, "line\n" * 2000), filled(11, "   \n\t  "), filled(12, prose(4, 200), "de", "src1"),
        filled(-1, prose(5, 30), "fr", ""),
    ]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], COLUMNS)


def texts(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
