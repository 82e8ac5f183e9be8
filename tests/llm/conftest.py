import duckdb
import pytest

FOLDER = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word " * 30_000 + "\n" + "line of text here\n" * 2_000
WORDS = " ".join(f"w{k} x{k % 7}" for k in range(60))
# NULLs in every column, empty and blank texts, a very long one, repeated rows, a number used twice.
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n ", "en", "a", 4),
    (4, WORDS, "en", "b", 1),
    (5, WORDS, "en", "b", 1),
    (5, WORDS, "en", "b", 1),
    (6, WORDS.replace("w30", "other"), "de", "b", 1),
    (7, LONG, "en", "c", 1),
    (8, "one two", None, "c", 1),
    (8, "a different text with the same number", "en", "c", 1),
    (None, "no number " * 5, "fr", "c", 1),
    (9, "ÉTÉ İstanbul 日本語 😀  double  blanks\x0bx\x1cy   <|endoftext|> don't", "fr", None, 1),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, DOCUMENTS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def clashing(spark):
    """Columns named like those that operators add or use inside."""
    names = ["label", "key", "size", "part", "print", "row", "node", "u", "v", "fingerprint", "component_id", "kept",
             "score", "predicted", "taken", "target", "epochs", "ids", "start", "before", "_doc", "doc"]
    rows = [(*r, *["x"] * len(names)) for r in ODD]
    return spark.createDataFrame(rows, DOCUMENTS + "".join(f", `{n}` string" for n in names))


@pytest.fixture(scope="session")
def given(spark):
    return lambda name, folder=FOLDER: spark.read.parquet(f"{folder}/{name}.parquet")


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for name in "documents embeddings pages benchmark labels conversations".split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection
