import re
import sys

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from turnmill.functions.text import WHITESPACE, clean_text, cut, has_text, strip


def apply(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.select(column(F.col("t")).alias("x"), "i").orderBy("i").select("x").collect()]


def python_clean(text):
    return re.sub("\n{3,}", "\n\n", (text or "").strip())


def test_whitespace_is_pythons():
    assert sorted(WHITESPACE) == [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]


def test_cleaning_table(spark):
    cases = {
        None: "",
        "": "",
        "　 a\n\n\n\n\nb\n\nc\x1c\n": "a\n\nb\n\nc",
        "a\n\nb": "a\n\nb",
        WHITESPACE + "a b" + WHITESPACE: "a b",
        "\n\n\n\n": "",
        "a\n\n\n \n\n\nb": "a\n\n \n\nb",
    }
    assert apply(spark, list(cases), clean_text) == list(cases.values())


alphabet = st.sampled_from(list("ab \n\n\n\t 　​́é😀"))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet, max_size=30), min_size=50, max_size=100))
def test_cleaning_agrees_with_python_and_is_stable(spark, texts):
    assert apply(spark, texts, clean_text) == [python_clean(t) for t in texts]
    assert apply(spark, texts, lambda c: clean_text(clean_text(c))) == [python_clean(t) for t in texts]
    assert apply(spark, texts, strip) == [t.strip() for t in texts]
    assert apply(spark, texts, has_text) == [t.strip() != "" for t in texts]


def test_cut_counts_characters(spark):
    assert apply(spark, ["😀" * 4, "abcde", "abc"], lambda c: cut(c, 4)) == ["😀" * 4, "abcd...", "abc"]
