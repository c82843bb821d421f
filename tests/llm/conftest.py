import pytest

SF = "/root/testdata/sf0.001"

EDGE = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa 4539 1488 0343 6467 mail a.b@c.example.org or +1 (017) 555-7713", "en", "s0"),
    (2, None, None, None),
    (3, "", "en", "s0"),
    (None, "a text without an id but with enough words to make more than one window of five words", "en", "s1"),
    (None, None, None, None),
    (4, "  \n\t ", "xx", "s1"),
    (5, "x" * 50_000 + " 1" * 3000 + " 999.1.2.3 10.0.0.255 été " + "9" * 5000, "fr", "s0"),
    (6, "one two three four five " * 60, "en", "s0"),
    (6, "one two three four five " * 60, "en", "s0"),
    (6, "another text under the same id with other words in it altogether now", "en", "s0"),
    (7, "alpha beta gamma delta epsilon zeta eta theta iota kappa 4539 1488 0343 6467 mail a.b@c.example.org or +1 (017) 555-7713", "en", "s9"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Null ids, texts and sources, empty and long texts, repeated rows and ids, columns with clashing names."""
    rows = [(*r, i, "z", 1) for i, r in enumerate(EDGE)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, node string, k1 long")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
