"""Shared scratch space for intermediate tables.

Two operators (exact split, global numbering) read an intermediate result more
than once.  They write it as Parquet under the folder the cluster names in
``spark.checkpoint.dir``, so a lost executor costs a re-read and never a
recomputation with another row layout.
"""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Tables of at most so many narrow rows are broadcast; larger ones are joined by a shuffle.
SMALL = 500_000


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the session's checkpoint folder.

    Without the setting a local session gets a temporary folder; a cluster
    session is refused, because a machine-local folder would not be shared.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="turnmill-"))
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch space and return the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    # One file per task, whatever the session says: the numbering counts on it.
    df.write.option("maxRecordsPerFile", 0).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame) -> DataFrame:
    """Mark a written table of narrow rows for broadcast, if its count says that it is small."""
    return F.broadcast(df) if df.count() <= SMALL else df


def hadoop_path(spark: SparkSession, path: str):
    """The path and its file system, as Hadoop objects."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())
