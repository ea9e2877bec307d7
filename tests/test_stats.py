from pyspark.sql import functions as F

import turnmill as tm

SCHEMA = "split string, messages array<struct<role:string,content:string>>"


def test_average_weights_messages(spark):
    df = spark.createDataFrame(
        [("train", [("user", "a" * 10), ("assistant", "b" * 20), ("user", "c" * 60)]), ("val", [("user", "d" * 2)])], SCHEMA
    )
    row = tm.dataset_stats(df).first()
    assert (row["num_samples"], row["num_features"], row["features"]) == (2, 2, ["split", "messages"])
    assert (row["avg_messages_per_sample"], row["min_messages"], row["max_messages"]) == (2.0, 1, 3)
    assert (row["avg_content_length"], row["min_content_length"], row["max_content_length"]) == (23.0, 2, 60)
    by = {r["split"]: r for r in tm.dataset_stats(df, by="split").collect()}
    assert by["train"]["avg_content_length"] == 30.0 and by["val"]["max_content_length"] == 2
    assert by["val"]["features"] == ["messages"]


def test_empty_and_null(spark):
    empty = tm.dataset_stats(spark.createDataFrame([], SCHEMA)).first()
    assert empty["num_samples"] == 0 and empty["avg_messages_per_sample"] is None and empty["avg_content_length"] is None
    nulls = tm.dataset_stats(spark.createDataFrame([("t", [("user", None), ("user", "abc")]), ("t", []), ("t", None)], SCHEMA)).first()
    assert (nulls["num_samples"], nulls["min_messages"], nulls["avg_content_length"]) == (3, 0, 3.0)


def test_null_messages_without_ansi_mode(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = spark.createDataFrame([("t", None), ("t", [("user", "a")])], SCHEMA)
        row = tm.dataset_stats(df).first()
        assert (row["num_samples"], row["min_messages"], row["avg_messages_per_sample"]) == (2, 1, 1.0)
        lines = spark.createDataFrame([(1, '{"messages": null}')], "id int, value string")
        assert tm.schema_issues_json(lines, "id").first()["detail"] == "Sample 1: Expected 2 messages, got 0"
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_without_messages(spark):
    row = tm.dataset_stats(spark.range(5)).first()
    assert row.asDict() == {"num_samples": 5, "num_features": 1, "features": ["id"]}


def test_profile(spark):
    assert tm.source_profile(spark.range(4)).first().asDict() == {"num_rows": 4, "columns": ["id"]}


def test_filter_long_bounds_and_special_tokens(spark):
    rows = [("t", [("user", "a b"), ("assistant", "c")]), ("t", [("user", " \n a"), ("assistant", None)]), ("t", [])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert tm.filter_long(df, max_length=3).count() == 3
    assert tm.filter_long(df, max_length=2).count() == 2
    assert tm.filter_long(df, max_length=3, special_tokens=1).count() == 2
    assert tm.filter_long(df, max_length=0).count() == 1


def test_filter_long_short_cut_changes_nothing(spark):
    texts = ["a " * k for k in range(40)] + ["a" * k for k in range(40)] + [" " * k + "b" for k in range(40)]
    df = spark.createDataFrame([("t", [("user", t)]) for t in texts], SCHEMA)
    slow = lambda c: tm.word_count(c)
    for limit in (0, 1, 5, 20):
        assert tm.filter_long(df, max_length=limit).count() == tm.filter_long(df, slow, limit).count()
        assert tm.filter_long(df, max_length=limit).count() == sum(len(t.split()) <= limit for t in texts)


def test_filter_long_with_a_tokenizer(spark):
    import pandas as pd

    @F.pandas_udf("int")
    def tokens(texts: pd.Series) -> pd.Series:
        return texts.str.len()

    df = spark.createDataFrame([("t", [("user", "abc")]), ("t", [("user", "abcdef")])], SCHEMA)
    assert tm.filter_long(df, tokens, max_length=5, special_tokens=2).count() == 1
    assert tm.curate(spark.createDataFrame([("t", [("user", "a@b.co"), ("assistant", "x")])], SCHEMA), tokens, 20).first()["text"] == (
        "User: [REDACTED]\nAssistant: x"
    )
