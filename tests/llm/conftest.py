import pytest

# What a table may hold besides plain texts: NULLs, no words, ties, a very long text, and columns
# named like those that operators make.
ODD = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank", "en", "a"),
    (2, "the quick  brown fox jumps over the lazy dog near the river bank", "en", "b"),
    (3, None, None, None),
    (4, "", "en", ""),
    (5, " \t\n\x0b ", "de", "a"),
    (6, "one two three", None, "a"),
    (7, "One two\nthree", "en", "c"),
    (7, "One two\nthree", "en", "c"),
    (None, "a text without an id", "en", "a"),
    (8, "word " * 40_000 + "x@y.example", "en", "a"),
    (9, "a" * 200_000, "en", "a"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    return _docs(spark, ODD)


@pytest.fixture(scope="session")
def no_docs(spark):
    return _docs(spark, [])


def _docs(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return docs.selectExpr(
        "*",
        *[
            f"'extra' AS `{name}`"
            for name in (
                "kept", "keep_id", "row", "pos", "line", "node", "n", "found", "lines", "stratum", "quality",
                "level", "digest", "ids", "chunk", "cluster", "short",
            )
        ],
    )


@pytest.fixture
def make_docs(spark):
    def make(texts):
        rows = [(i, text, "en", f"s{i % 5}") for i, text in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")

    return make
