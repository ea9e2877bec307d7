"""Stretches of a long group: consecutive rows, about equally many each."""

from pyspark.sql import DataFrame, Window, functions as F

from turnmill.storage import materialize, small

#: Bins per stretch: a stretch is put together from whole bins.
BINS = 4


def _bin(place: str, low: str, high: str, n: str, size: int) -> str:
    """SQL for the bin of a place in [low, high], of which there are BINS per ``size`` rows; grows with the place."""
    return f"CAST(floor((CAST({place} AS DOUBLE) - {low}) / ((CAST({high} AS DOUBLE) - {low} + 1) / ceil({n} * {BINS} / {size}))) AS BIGINT)"


def with_stretches(df: DataFrame, key: str, place: str, size: int, name: str = "_stretch") -> tuple[DataFrame, bool]:
    """Number the stretches of every group ``key``, in the order of ``place``; also whether any group has several.

    Groups of at most ``size`` rows, which are counted first, are one stretch, 0.  A larger group is cut by counts on two
    levels: bins of equal width between its smallest and largest place, and bins again inside those that hold too many
    rows, so that wide gaps and dense spots do no harm.  Rows with equal places stay together.  A missing place comes first.
    All of this reads two narrow columns; what is joined to the rows is one row per bin of the large groups.
    """
    size = int(size)
    narrow = df.select(F.col(key).alias("_key"), F.col(place).cast("long").alias("_place"))
    sizes = narrow.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_low"), F.max("_place").alias("_high"))
    large = materialize(sizes.where(F.col("_n") > size), "large")
    if large.isEmpty():
        return df.withColumn(name, F.lit(0).cast("long")), False

    def binned(rows: DataFrame, of: DataFrame, how: str) -> DataFrame:
        # NULL and the places of an all-NULL group are in bin -1.
        joined = rows.join(of, rows["_key"].eqNullSafe(of["_of"]), how)
        return joined.withColumn("_bin", F.coalesce(F.expr(_bin("_place", "_low", "_high", "_n", size)), F.lit(-1)))

    known = small(large.withColumnRenamed("_key", "_of"))
    counted = binned(narrow, known, "inner").groupBy("_key", "_bin")
    bins = materialize(counted.agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_low"), F.max("_place").alias("_high")), "bins")

    crowded = (F.col("_n") > size) & (F.col("_low") < F.col("_high"))
    dense = bins.where(crowded).select(*(F.col(c).alias(f"{c}2") for c in ("_key", "_bin", "_n", "_low", "_high")))
    dense = small(dense)

    def split(rows: DataFrame, how: str) -> DataFrame:
        joined = rows.join(dense, rows["_key"].eqNullSafe(dense["_key2"]) & (rows["_bin"] == dense["_bin2"]), how)
        return joined.withColumn("_sub", F.coalesce(F.expr(_bin("_place", "_low2", "_high2", "_n2", size)), F.lit(0)))

    inner = split(binned(narrow, known, "inner"), "inner").groupBy("_key", "_bin", "_sub").agg(F.count(F.lit(1)).alias("_n"))
    leaves = bins.where(~F.coalesce(crowded, F.lit(False))).select("_key", "_bin", F.lit(0).cast("long").alias("_sub"), "_n").unionByName(inner)
    before = Window.partitionBy("_key").orderBy("_bin", "_sub").rowsBetween(Window.unboundedPreceding, -1)
    begun = F.coalesce(F.sum("_n").over(before), F.lit(0))
    leaves = leaves.select("_key", "_bin", "_sub", F.floor(begun / size).cast("long").alias(name))
    leaves = small(materialize(leaves, "stretches").select(*(F.col(c).alias(f"{c}3") for c in ("_key", "_bin", "_sub")), name))

    rows = df.withColumn("_key", F.col(key)).withColumn("_place", F.col(place).cast("long"))
    rows = split(binned(rows, known, "left"), "left")
    same = rows["_key"].eqNullSafe(leaves["_key3"]) & (rows["_bin"] == leaves["_bin3"]) & (rows["_sub"] == leaves["_sub3"])
    placed = rows.join(leaves, same, "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return placed.select(*(f"`{c}`" for c in df.columns), name), True
