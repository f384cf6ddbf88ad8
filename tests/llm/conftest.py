import pytest

ODD = ["", " ", "a", "một  hai", "don't I'll x²½", "<|endoftext|> x <|endoftext|>", "日本語 🙂", "a\n \n b", "A" * 3000, "x\u0000y", "İstanbul ΣΑΣ"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns with the names used inside."""
    rows = [(i, t, "en", "s", 1, "x", b"y") for i, t in enumerate(ODD)] + [(3, ODD[3], "en", "s", 1, "x", b"y")]
    rows += [(100, None, None, None, None, None, None), (None, "null id", "fr", None, 2, "z", b"")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, class_id string, digest binary")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
