import pytest

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that the operators use inside.
CLASHING = ("id", "h", "key", "label", "tokens", "bucket", "rank", "path", "fp", "score", "length")

LONG = "Lange Reihe von Wörtern und noch mehr, the end of it. " * 2000
EDGES = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "Same text here twice."), (6, "Same text here twice."),
    (7, "Same text here twice."), (7, "Same text here twice."), (None, "A row without a key."), (None, "A row without a key."),
    (8, LONG), (9, "word " * 60), (10, "line\nline\n\nline\r\n<|endoftext|> x"), (11, "日本語のテキスト 😀 é ½"),
]


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(f"other {c}") for c in CLASHING})


@pytest.fixture(scope="session")
def with_clash():
    return with_clashes


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def edges(spark):
    rows = [(i, t, "en" if k % 3 else None, "s", len(t or "")) for k, (i, t) in enumerate(EDGES)]
    return with_clashes(spark.createDataFrame(rows, COLUMNS))


@pytest.fixture(scope="session")
def empty(spark):
    return with_clashes(spark.createDataFrame([], COLUMNS))


@pytest.fixture(scope="session")
def mixed(documents, edges):
    """The sample documents and the edge cases."""
    return with_clashes(documents).union(edges)


@pytest.fixture(scope="session")
def texts():
    def of(df):
        return [(r[0], r[1] or "") for r in df.select("doc_id", "text").collect()]

    return of
