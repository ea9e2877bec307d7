"""Exact, reproducible train/validation split."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from turnmill.operators.order import order_hash

TRAIN, VALIDATION = "train", "val"


def _last_train_place(keys: DataFrame, key: str, train_fraction: float, seed: int) -> Column:
    """Hash and key of the last train row, as a scalar subquery; NULL when train is empty.

    Rows are counted per hash prefix first (at most 65,536 counts, combined on the map
    side), which tells in which prefix the cut falls and how far in.  Only the rows of that
    one prefix, 1/65,536 of all, are then ranked.
    """
    place = keys.select(order_hash(F.col(key), seed).alias("h"), F.col(key).alias("k"))
    place = place.withColumn("prefix", F.left("h", F.lit(4)))

    counts = place.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"))
    running = counts.select(
        "prefix",
        "n",
        F.sum("n").over(Window.orderBy("prefix")).alias("upto"),
        # Truncated, not rounded, like int() of the product.
        (F.sum("n").over(Window.partitionBy(F.lit(1))) * F.lit(float(train_fraction))).cast("long").alias("n_train"),
    )
    cut = running.where((F.col("upto") >= F.col("n_train")) & (F.col("upto") - F.col("n") < F.col("n_train"))).select(
        "prefix", (F.col("n_train") - F.col("upto") + F.col("n")).alias("within")
    )
    # `cut` is one row at most.
    rank = F.row_number().over(Window.partitionBy("prefix").orderBy("h", "k"))
    last = place.join(F.broadcast(cut), "prefix").withColumn("rank", rank).where(F.col("rank") == F.col("within"))
    return last.select(F.struct("h", "k")).scalar()


def split_exact(
    df: DataFrame,
    key: str,
    train_fraction: float = 0.97,
    seed: int = 42,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Add ``split``: the first ``int(n * train_fraction)`` rows of the seeded order are train.

    The cut is found as an order statistic of the hashes, so the rows themselves are only
    compared with it where they lie: no shuffle and no sort of the data.  ``key`` must be
    unique.  Pass ``keys``, a cheap table with the same keys, when ``df`` is costly to read.
    """
    last = _last_train_place(keys if keys is not None else df, key, train_fraction, seed)
    place = F.struct(order_hash(F.col(key), seed).alias("h"), F.col(key).alias("k"))
    is_train = F.coalesce(place <= last, F.lit(False))
    return df.withColumn("split", F.when(is_train, F.lit(TRAIN)).otherwise(F.lit(VALIDATION)))


def split_hash(df: DataFrame, key: str, train_fraction: float = 0.97, seed: int = 42) -> DataFrame:
    """Add ``split`` by a threshold on the order hash: about that share is train.

    A row's split depends on its own key only, so it stays when rows are added.  No pass over the
    keys; a NULL key is validation.
    """
    share = F.conv(F.left(order_hash(F.col(key), seed), F.lit(8)), 16, 10).cast("long") / F.lit(float(1 << 32))
    is_train = F.coalesce(share < F.lit(float(train_fraction)), F.lit(False))
    return df.withColumn("split", F.when(is_train, F.lit(TRAIN)).otherwise(F.lit(VALIDATION)))


def split_counts(df: DataFrame) -> DataFrame:
    """Number of rows per split."""
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("num_samples"))
