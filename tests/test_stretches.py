"""Stretches by measured counts, and pairs and samples over them."""

import random

import pytest
from pyspark.sql import functions as F

import turnmill as tm
from tests.plantools import plan_text
from turnmill.operators.stretches import with_stretches

TURNS = "conv_id long, turn long, role string, text string"


def conversations(seed):
    """Dense, sparse, clustered and repeated turn numbers, NULLs, and extremes; one conversation is huge."""
    choose = random.Random(seed)
    rows = []
    kinds = [
        lambda i: i,
        lambda i: i * 1_000_003,
        lambda i: choose.choice((0, 10**15)) + choose.randrange(300),
        lambda i: choose.randrange(40),
        lambda i: choose.choice((None, 7, 8)),
        lambda i: choose.randrange(-(2**63), 2**63),
        lambda i: 1_700_000_000_000 + choose.randrange(10) ** 9 * 1000 + i % 50,
    ]
    for conv, kind in enumerate(kinds):
        for i in range(choose.choice((3, 90, 700))):
            rows.append((conv, kind(i), choose.choice(("user", "assistant", None)), choose.choice((None, "x", f"t{i}"))))
    rows += [(None, i, "user" if i % 2 else "assistant", f"n{i}") for i in range(250)]
    return rows


def key(value):
    return (value is not None, value if value is not None else 0) if not isinstance(value, str) else (True, value)


def in_order(rows):
    text = lambda v: (v is not None, v or "")
    return sorted(rows, key=lambda r: ((r[1] is not None, r[1] or 0), text(r[2]), text(r[3])))


@pytest.mark.parametrize("block", [1, 10, 64, 100_000])
def test_pairs_and_samples_do_not_depend_on_the_block(spark, block):
    rows = conversations(block)
    df = spark.createDataFrame(rows, TURNS).repartition(7)
    by = {c: in_order([r for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    pairs = [(c, a[1], a[3], b[3]) for c, turns in by.items() for a, b in zip(turns, turns[1:]) if (a[2], b[2]) == ("user", "assistant")]
    assert sorted(map(tuple, tm.turns_to_pairs(df, block).collect()), key=repr) == sorted(pairs, key=repr)
    got = {r["conv_id"]: [tuple(m) for m in r["messages"]] for r in tm.turns_to_messages(df, block=block).collect()}
    assert got == {c: [r[2:] for r in turns] for c, turns in by.items()}


def test_stretches_are_of_about_equal_counts(spark):
    dense = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").alias("p"))
    sparse = spark.range(20_000).select(F.lit(2).alias("k"), (F.col("id") * 1_000_000).alias("p"))
    burst = spark.range(20_000).select(F.lit(3).alias("k"), F.when(F.col("id") == 0, 0).otherwise(10**12 + F.col("id")).alias("p"))
    small = spark.range(900).select(F.lit(4).alias("k"), F.col("id").alias("p"))
    placed, several = with_stretches(dense.union(sparse).union(burst).union(small), "k", "p", 1000)
    sizes = placed.groupBy("k", "_stretch").count().collect()
    assert several and max(r["count"] for r in sizes) <= 2000
    assert [sum(r["k"] == k for r in sizes) for k in (1, 2, 3, 4)] == [20, 20, 20, 1]


def test_texts_of_huge_conversations_are_shuffled_by_stretch(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.lit("t").alias("text"))
    plan = plan_text(tm.turns_to_pairs(df, block=100))
    assert "hashpartitioning(conv_id" in plan and "_stretch" in plan
    small = plan_text(tm.turns_to_messages(df, block=10_000))
    assert "_stretch" not in small and small.count("Exchange hashpartitioning") <= 1


def test_row_keys_of_rows_that_hardly_differ(spark):
    rows = spark.sql(
        "SELECT timestamp'2020-01-01 00:00:00.000001' AS t, array('a, b') AS a, named_struct('x', CAST(NULL AS STRING)) AS s, X'00' AS b "
        "UNION ALL SELECT timestamp'2020-01-01 00:00:00.000002', array('a', 'b'), named_struct('x', 'NULL'), X'00' "
        "UNION ALL SELECT timestamp'2020-01-01 00:00:00.000001', array('a', 'b'), named_struct('x', '-'), X'01' "
        "UNION ALL SELECT timestamp'2020-01-01 00:00:00.000001', array('a', 'b'), named_struct('x', ''), X'01' "
        "UNION ALL SELECT timestamp'2020-01-01 00:00:00.000001', array('a', 'b'), NULL, X'01'"
    )
    assert len({r["row_key"] for r in tm.with_row_key(rows).collect()}) == 5
    dotted = spark.createDataFrame([(1, 2), (2, 1)], "`a.b` int, `a` int")
    assert len({r["row_key"] for r in tm.with_row_key(dotted).collect()}) == 2
