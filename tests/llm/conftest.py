import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, source=lambda i: f"s{i % 3}"):
        rows = [(i, t, "en", source(i), len(t or "")) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty, blank and very long texts, repeated texts, strange white space."""
    long = " ".join(f"w{i % 997} the" for i in range(30_000))
    return make_docs([None, "", " \n\t ", "a", "A  b\r\n c", "the same line\nand more", "the same line\nand more", long, "日本 語 x", "x\n\ny"],
                     source=lambda i: None if i % 4 == 0 else "s")
