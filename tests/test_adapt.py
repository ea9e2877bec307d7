from collections import Counter

from pyspark.sql import functions as F

import turnmill as tm


def turns(spark, n):
    role = F.when(F.col("id") % 2 == 0, "user").otherwise("assistant")
    return spark.range(n).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.concat(F.lit("t"), "id").alias("text")
    )


def test_messages_in_turn_order(spark):
    rows = [(1, 2, "user", "c"), (1, 0, "system", "a"), (2, 0, "user", None), (1, 1, "assistant", "b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: [tuple(m) for m in r["messages"]] for r in tm.turns_to_messages(df).collect()}
    assert got == {1: [("system", "a"), ("assistant", "b"), ("user", "c")], 2: [("user", None)]}


def test_a_long_conversation_stays_whole(spark):
    (row,) = tm.turns_to_messages(turns(spark, 2500)).collect()
    assert [m["content"] for m in row["messages"]] == [f"t{i}" for i in range(2500)]
    cut = tm.turns_to_messages(turns(spark, 2500), max_turns=1000).orderBy("segment").collect()
    assert [len(r["messages"]) for r in cut] == [1000, 1000, 500]


def test_turn_numbers_need_not_be_dense(spark):
    seam = turns(spark, 4).withColumn("turn", F.col("turn") + 998)
    far = turns(spark, 4).selectExpr("conv_id + 1 as conv_id", "turn * 86400000000 - 5 as turn", "role", "text")
    got = {r["conv_id"]: [m["content"] for m in r["messages"]] for r in tm.turns_to_messages(seam.union(far)).collect()}
    assert got == {1: ["t0", "t1", "t2", "t3"], 2: ["t0", "t1", "t2", "t3"]}
    pairs = tm.turns_to_pairs(seam.union(far)).select("conv_id", "Context", "Response").collect()
    assert sorted(map(tuple, pairs)) == [(c, a, b) for c in (1, 2) for a, b in (("t0", "t1"), ("t2", "t3"))]


def test_curate_loses_no_turn(spark):
    samples = tm.turns_to_messages(turns(spark, 1001))
    (row,) = tm.curate(samples, max_length=10_000).collect()
    assert len(row["messages"]) == 1001


def test_names_with_dots(spark):
    df = spark.createDataFrame([("a",), ("a",)], "`a.b` string")
    assert len({r["row_key"] for r in tm.with_row_key(df).collect()}) == 2


def test_pairs_need_a_direct_answer(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "system", "s"), (1, 4, "assistant", "d"), (2, 0, "user", "e")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in tm.turns_to_pairs(df).collect()] == [(1, 1, "b", "c")]
    assert tm.turns_to_pairs(turns(spark, 2500)).count() == 1250


def test_row_key_is_unique_and_keeps_every_copy(spark):
    texts = ["hot"] * 1000 + ["twice"] * 2 + [f"t{i}" for i in range(300)] + [None]
    df = spark.createDataFrame([(t, "r") for t in texts], "Context string, Response string")
    keys = None
    for parts in (1, 9):
        keyed = tm.with_row_key(df.repartition(parts), chunk=64).collect()
        assert Counter(r["Context"] for r in keyed) == Counter(texts)
        assert len({r["row_key"] for r in keyed}) == len(texts)
        assert keys in (None, {r["row_key"] for r in keyed})
        keys = {r["row_key"] for r in keyed}


def test_split_of_rows_without_a_key(spark):
    df = spark.createDataFrame([("hot",)] * 700 + [(f"t{i}",) for i in range(300)], "Context string")
    counts = tm.split_counts(tm.split_exact(tm.with_row_key(df, chunk=50), "row_key", 0.9)).collect()
    assert {r["split"]: r["num_samples"] for r in counts} == {"train": 900, "val": 100}
