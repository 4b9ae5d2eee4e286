import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    words = ["".join(chr(97 + int(d)) for d in str(i)) for i in range(30_000)]
    rows = [
        (1, None, "en", "a", 0), (2, "", None, "a", 0), (3, " \t\n\x0b\x0c\r ", "en", None, 7), (4, " ".join(words), "en", "b", None),
        (5, "one two three four five six seven", "en", "a", 33), (5, "one two three four five six seven", "en", "a", 33),
        (6, "One two\nthree four five SIX seven", "fr", "a", 33), (None, "no id here at all", None, None, None),
        (8, "z" * 70_000, "de", "b", 70_000), (9, "nul\0byte and \U0001f600 emoji é", "de", "b", 27), (10, None, None, None, None),
    ]
    extra = "kept string, rid string, n string, s string, ids string, node string, words string, a string, kind string, w string, h string"
    names = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame([(*r, *["extra"] * 11) for r in rows], f"{names}, {extra}")
