import pytest

SF = "/root/testdata/sf0.001"

#: Rows that every operator must take: NULLs, empty and blank texts, repeated rows, a very long text and word.
EDGES = [
    (1, "the same line of text here\nanother line", "en", "s", 40),
    (1, "the same line of text here\nanother line", "en", "s", 40),
    (2, None, "en", None, None),
    (None, "a text without an id, of ten words or perhaps more", None, "s", 50),
    (None, None, None, None, None),
    (3, "", "fr", "s", 0),
    (4, " \t\n \x0b", "fr", "s", 5),
    (5, "word " * 30000, "en", "s", 150000),
    (6, "x" * 40000, "de", "s", 40000),
    (7, "ßΣ é 日本語 ½ 👍🏽 <|endoftext|> it's", "de", "s", 30),
    (8, "12345 !!! ### 42", "es", "s", 16),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture()
def rows(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture()
def edges(spark):
    return spark.createDataFrame(EDGES, SCHEMA)


@pytest.fixture()
def clashing(edges):
    """Other columns with names that operators use themselves."""
    from pyspark.sql import functions as F
    names = ["row", "key", "a", "b", "line", "fp", "uid", "n_words", "spans", "items", "kept", "c0", "c1", "slot", "shard",
             "score", "lang_pred", "drop", "par", "ids", "w", "t", "h", "n", "first", "v", "c", "class", "part", "block", "kept_text"]
    return edges.select("*", *[F.lit(7).alias(x) for x in names])


@pytest.fixture()
def empty(edges):
    return edges.where("doc_id = -1")


def same(a, b):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    return sorted(map(tuple, a), key=key) == sorted(map(tuple, b), key=key)
