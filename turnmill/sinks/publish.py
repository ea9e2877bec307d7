"""Publishing the splits of a dataset as one: readers see all of the new ones, or all of the old ones.

Every version of a dataset is written to a folder of its own, ``<out>/versions/<id>``.  When it is whole, a
manifest that names it replaces the one before in a single rename.  A job that fails at any point
before leaves the manifest, and what it names, as they were.
"""

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from turnmill.operators.split import TRAIN, VALIDATION
from turnmill.storage import hadoop_path

#: The file under the output folder that names the version to read.
MANIFEST = "_manifest.json"


@dataclass(frozen=True)
class Published:
    """A version of a dataset: the folder and the number of rows of each split."""

    version: str
    paths: dict[str, str]
    rows: dict[str, int]


def qualified(spark: SparkSession, path: str, encoded: bool = False) -> str:
    """The one name of a path: scheme, authority and working folder filled in, dots and a last slash taken out.

    ``encoded`` is for the names that ``inputFiles`` gives, in which odd characters are written as in a URI.
    """
    if encoded:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(path)).toString()
    place, system = hadoop_path(spark, path)
    uri = system.makeQualified(place).toUri().normalize()
    return f"{uri.getScheme()}://{uri.getAuthority() or ''}{uri.getPath()}".rstrip("/")


def _read(spark: SparkSession, out: str) -> dict | None:
    place, system = hadoop_path(spark, f"{out}/{MANIFEST}")
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _write(spark: SparkSession, out: str, manifest: dict) -> None:
    new, system = hadoop_path(spark, f"{out}/_manifest-{uuid.uuid4().hex}")
    stream = system.create(new, True)
    try:
        stream.write(bytearray(json.dumps(manifest).encode()))
    finally:
        stream.close()
    hadoop, gateway = spark._jvm.org.apache.hadoop.fs, spark.sparkContext._gateway
    rename = getattr(hadoop, "Options$Rename")
    how = gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    files = hadoop.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    files.rename(system.makeQualified(new), system.makeQualified(hadoop_path(spark, f"{out}/{MANIFEST}")[0]), how)


def stage_splits(df: DataFrame, out: str, splits: Sequence[str] = (TRAIN, VALIDATION)) -> Published:
    """Phase one: write the rows as JSON Lines, by their ``split``, to a folder of their own, in one job.

    Rows keep the order they come in.  They are counted in the writing stage itself, where a repeated task
    counts once.  A split without rows is an empty folder.  Nothing is published yet.
    """
    spark, version = df.sparkSession, f"{out.rstrip('/')}/versions/{uuid.uuid4().hex}"
    seen, known = Observation(), F.col("split").isin(*splits)
    counts = {name: F.count_if(F.col("split") == name) for name in splits}
    counted = df.observe(seen, F.count_if(F.coalesce(~known, F.lit(True))).alias("_other"), *(n.alias(name) for name, n in counts.items()))
    counted.write.partitionBy("split").json(version)
    if seen.get["_other"]:
        raise ValueError(f"{seen.get['_other']} rows belong to none of the splits {', '.join(splits)}")
    paths = {name: f"{version}/split={name}" for name in splits}
    rows = {name: seen.get[name] for name in splits}
    for name in splits:
        if not rows[name]:
            place, system = hadoop_path(spark, paths[name])
            system.mkdirs(place)
    return Published(version, paths, rows)


def publish(spark: SparkSession, out: str, staged: Published) -> None:
    """Phase two: make a staged version the one that readers see.

    The version before stays for readers that are at it; older ones are removed.  Of two jobs that publish at the same
    time the later one wins, whole.
    """
    before = _read(spark, out) or {}
    _write(spark, out, {"version": staged.version, "previous": before.get("version"), "paths": staged.paths, "rows": staged.rows})
    if before.get("previous"):
        place, system = hadoop_path(spark, before["previous"])
        system.delete(place, True)


def publish_splits(df: DataFrame, out: str, splits: Sequence[str] = (TRAIN, VALIDATION)) -> Published:
    """Write and publish a dataset with a ``split`` column."""
    staged = stage_splits(df, out, splits)
    publish(df.sparkSession, out, staged)
    return staged


def is_published(spark: SparkSession, out: str) -> bool:
    """Whether anything is published under ``out``."""
    return _read(spark, out) is not None


def published(spark: SparkSession, out: str) -> Published:
    """The version that is published under ``out``."""
    manifest = _read(spark, out)
    if manifest is None:
        raise FileNotFoundError(f"nothing is published under {out}")
    return Published(manifest["version"], manifest["paths"], manifest["rows"])
