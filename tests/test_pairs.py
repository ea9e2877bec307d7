import pytest
from pyspark.sql import functions as F

import turnmill as tm
from turnmill.functions.pairs import length_between

CASES = [
    ("x" * 10, "y" * 10, True),
    ("x" * 9, "y" * 50, False),
    ("x" * 8000, "y" * 8000, True),
    ("x" * 8001, "y" * 50, False),
    ("x" * 50, "y" * 8001, False),
    (None, "y" * 50, False),
    ("x" * 50, None, False),
    ("", "y" * 50, False),
    (" " * 12, "y" * 50, False),
    ("　" * 12, "y" * 50, False),
    (" " * 9 + "x", "y" * 50, True),
    ("\U0001f600" * 10, "y" * 50, True),
    ("\U0001f600" * 9, "y" * 50, False),
]


@pytest.fixture
def pairs(spark):
    return spark.createDataFrame([(i, c, r) for i, (c, r, _) in enumerate(CASES)], "id int, Context string, Response string")


def test_validity_table(pairs):
    got = pairs.select(tm.is_valid_pair(F.col("Context"), F.col("Response")).alias("v")).collect()
    assert [r["v"] for r in got] == [v for *_, v in CASES]


def test_length_bounds_in_characters(spark):
    texts = [c * n for c in "aé中😀" for n in range(13)] + [None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for low, high in ((0, 0), (1, 3), (2, 8), (3, 3), (5, 2)):
        got = [r["t"] for r in df.where(length_between(F.col("t"), low, high)).collect()]
        assert got == [t for t in texts if t is not None and low <= len(t) <= high]


def test_filter_and_counts_agree(pairs):
    kept = pairs.transform(tm.filter_valid).count()
    counts = pairs.transform(tm.skip_counts).first()
    assert (counts["kept"], counts["skipped"]) == (kept, len(CASES) - kept)


def test_min_length_zero_still_rejects_empty(spark):
    df = spark.createDataFrame([("", "a"), ("a", "b")], "Context string, Response string")
    assert tm.filter_valid(df, min_len=0).count() == 1


def test_missing_column_counts_as_empty(spark):
    df = spark.createDataFrame([("x" * 20,)], "Context string")
    assert df.transform(tm.skip_counts).first()["skipped"] == 1
    messages = df.transform(tm.pairs_to_messages).first()["messages"]
    assert [(m["role"], m["content"]) for m in messages] == [("user", "x" * 20), ("assistant", "")]


def test_limits_apply_before_cleaning(pairs):
    row = pairs.where("id = 10").transform(tm.filter_valid).transform(tm.pairs_to_messages).first()
    assert row["messages"][0]["content"] == "x"
    assert row.__fields__ == ["id", "messages"]
