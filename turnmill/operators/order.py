"""Reproducible order, first rows, and global numbering."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from turnmill.functions.chat import message_preview
from turnmill.storage import materialize, small


def order_hash(key: Column, seed: int) -> Column:
    """Position of a row in the seeded shuffle.

    A function of seed and key only, so neither partitioning nor a retried task changes it
    (``rand(seed)`` depends on the partition layout).
    """
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def seeded_order(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """All rows in the order of the seeded shuffle; ``key`` must be unique."""
    return df.orderBy(order_hash(F.col(key), seed), F.col(key))


def seeded_layout(df: DataFrame, key: str, partitions: int, seed: int = 42, first: tuple[str, ...] = ()) -> DataFrame:
    """The rows in seeded order over that many partitions of equal size, for writing.

    The hashes are uniform, so a row's partition follows from its hash alone; a sort would
    first read the whole input once more to sample it.  Rows are sorted by ``first`` inside
    a partition before the hash, for a writer that groups by those columns.
    """
    # A column of its own: a sort evaluates an expression anew in every comparison.
    placed = df.withColumn("_place", order_hash(F.col(key), seed))
    fraction = F.conv(F.left("_place", F.lit(8)), 16, 10).cast("long")
    target = F.shiftright(fraction * partitions, 32).cast("int")
    return placed.repartitionById(partitions, target).sortWithinPartitions(*first, "_place", key).drop("_place")


def smoke_sample(df: DataFrame, key: str, n: int = 5, seed: int = 42) -> DataFrame:
    """The first ``n`` rows of the seeded order; a top-n per task, no full sort."""
    return seeded_order(df, key, seed).limit(n)


def preview(df: DataFrame, key: str, n: int = 5, seed: int = 42, width: int = 200) -> DataFrame:
    """The messages of the first ``n`` samples, ready for a listing."""
    first = smoke_sample(df.select(key, "messages"), key, n, seed)
    place = F.row_number().over(Window.orderBy(order_hash(F.col(key), seed), F.col(key)))
    return (
        first.withColumn("sample_no", place)
        .select("sample_no", key, F.posexplode("messages").alias("msg_idx", "m"))
        .select(
            "sample_no",
            key,
            "msg_idx",
            F.upper("m.role").alias("role"),
            message_preview(F.col("m.content"), width).alias("content"),
        )
    )


def number_rows(df: DataFrame, *order: str, name: str = "sample_id") -> DataFrame:
    """Number all rows 1, 2, 3, ... in the given order without a one-task window.

    Only the order columns are range-partitioned, sorted and written.  A row's number is the count
    of rows in the files before its own plus its place in the file; only one small row per
    file is gathered to add up the counts.  The numbers are then joined to the rows by the order columns: a small table of them
    is broadcast, and the rows stay where they are.  Rows that the order columns don't tell apart are
    numbered as whole rows instead.
    """
    keys = _numbered(df.select(*order), order, name)
    if keys.groupBy(*order).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).isEmpty():
        named = keys.select(name, *(F.col(c).alias(f"_order{i}") for i, c in enumerate(order)))
        same = [F.col(c).eqNullSafe(F.col(f"_order{i}")) for i, c in enumerate(order)]
        return df.join(small(named), reduce(Column.__and__, same)).select(name, *df.columns)
    return _numbered(df, order, name)


def _numbered(df: DataFrame, order: tuple[str, ...], name: str) -> DataFrame:
    part = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("long")
    place = F.col("_metadata.row_index")
    written = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order), "numbered")
    placed = written.select("*", part.alias("_part"), place.alias("_place"))

    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # One row per written file: bounded by the number of shuffle partitions.
    return placed.join(F.broadcast(offsets), "_part").select(
        (F.col("_before") + F.col("_place") + 1).alias(name), *df.columns
    )


def number_lines(lines: DataFrame, name: str = "sample_id") -> DataFrame:
    """Number the rows of a text scan 1, 2, 3, ... by file name, and by place in the file.

    The rows stay where they are read: the first pass counts them per file and block, the second adds the count before its
    block to a row's place in it.  Both read the files in the same blocks, as one session does.
    """
    at = lines.select(
        *lines.columns,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        # Grows with the place inside one block of one file.
        F.monotonically_increasing_id().alias("_pos"),
    )
    blocks = at.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    blocks = materialize(blocks, "blocks")
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("_file", "_start", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # One row per block of the input.
    numbered = at.join(F.broadcast(offsets), ["_file", "_start"])
    return numbered.select((F.col("_before") + F.col("_pos") - F.col("_first") + 1).alias(name), *lines.columns)
