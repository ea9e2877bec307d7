import hashlib

import pytest
from pyspark.sql import functions as F

import turnmill as tm
from tests.plantools import main_nodes


def expected(keys, fraction, seed):
    order = sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))
    cut = int(len(order) * fraction)
    return {k: "train" if i < cut else "val" for i, k in enumerate(order)}


@pytest.mark.parametrize("n", [0, 1, 33, 5000])
@pytest.mark.parametrize("fraction", [0.0, 0.97, 1.0])
def test_exact_sizes_and_members(spark, n, fraction):
    df = spark.range(n).withColumnRenamed("id", "k")
    got = {r["k"]: r["split"] for r in tm.split_exact(df, "k", fraction, 42).collect()}
    assert got == expected(range(n), fraction, 42)


def test_same_split_for_any_partitioning_and_string_keys(spark):
    df = spark.range(3000).select(F.concat(F.lit("é"), F.col("id")).alias("k"))
    want = expected([f"é{i}" for i in range(3000)], 0.9, 7)
    for parts in (1, 3, 11):
        got = {r["k"]: r["split"] for r in tm.split_exact(df.repartition(parts), "k", 0.9, 7).collect()}
        assert got == want


def test_truncates_like_int(spark):
    counts = tm.split_counts(tm.split_exact(spark.range(199), "id", 0.97)).collect()
    assert {r["split"]: r["num_samples"] for r in counts} == {"train": 193, "val": 6}


def test_seed_changes_the_order(spark):
    df = spark.range(200)
    orders = [[r["id"] for r in tm.seeded_order(df, "id", seed).collect()] for seed in (1, 2, 1)]
    assert orders[0] == orders[2] != orders[1]
    assert sorted(orders[0]) == list(range(200))


def test_data_rows_are_not_moved(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert set(main_nodes(tm.split_exact(docs, "doc_id"))) <= {"WholeStageCodegen (1)", "InputAdapter", "ColumnarToRow", "Project", "Scan parquet "}


def test_layout_is_the_seeded_order(spark):
    df = spark.range(5000)
    laid = tm.seeded_layout(df, "id", 7)
    assert [r["id"] for r in laid.collect()] == [r["id"] for r in tm.seeded_order(df, "id").collect()]
    sizes = [r["count"] for r in laid.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 7 and min(sizes) > 600


def test_number_rows(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("a"), F.lit("x").alias("b")).repartition(13)
    got = tm.number_rows(df, "a").collect()
    assert sorted((r["sample_id"], r["a"]) for r in got) == [(i + 1, i) for i in range(1000)]
    assert tm.number_rows(df.where("a < 0"), "a").count() == 0


def test_number_rows_with_a_hot_first_column(spark):
    df = spark.range(2000).select(F.when(F.col("id") < 1500, 1).otherwise(F.col("id")).alias("c"), F.col("id").alias("t"))
    rows = sorted(df.collect())
    got = sorted(tm.number_rows(df, "c", "t").collect())
    assert [(r["c"], r["t"]) for r in got] == [tuple(r) for r in rows]
