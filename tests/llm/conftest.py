import duckdb
import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

#: A null text, an empty and a blank one, no letters, one word, repeated rows, a null id, and a long text.
AWKWARD = [
    (1, None, None, None, None),
    (2, "", "en", "s", 0),
    (3, " \n\t ", "en", None, 4),
    (4, "123 !!", None, "s", 6),
    (5, "word", "en", "s", 4),
    (6, "the same line of words here.", "en", "s", 28),
    (6, "the same line of words here.", "en", "s", 28),
    (7, "the same line of words here.", "en", "s", 28),
    (None, "a text without an id, in English words.", "en", "s", 39),
    (8, "lang " * 30_000, "en", "s", 150_000),
    (9, "x" * 50_000, "fr", "s", 50_000),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Odd documents, with extra columns whose names clash with those of the results."""
    frame = spark.createDataFrame(AWKWARD, DOCUMENTS)
    return frame.selectExpr("*", "'x' AS score", "1 AS n_tokens", "true AS kept", "0 AS held_out", "'y' AS row", "2 AS fp", "3 AS words")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def tables(spark, sf_dir):
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")


@pytest.fixture(scope="session")
def con(sf_dir):
    con = duckdb.connect()
    for name in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con
