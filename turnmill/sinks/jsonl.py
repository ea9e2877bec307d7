"""JSON Lines output: one object per line, UTF-8, not escaped."""

from pyspark.sql import DataFrame, Observation, functions as F


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    # Counted in the writing stage itself: no second pass, and each task counts once even if
    # it is repeated.
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_jsonl(df: DataFrame, path: str, keep_nulls: bool = False) -> int:
    """Write ``df``, replacing what is there, and return the number of rows.

    NULL fields are left out of the objects unless ``keep_nulls`` is set.
    """
    rows, seen = _counted(df)
    rows.write.mode("overwrite").option("ignoreNullFields", not keep_nulls).json(path)
    return seen.get["rows"]


def write_records(df: DataFrame, path: str, record: str = "record") -> int:
    """Write a VARIANT column, a line each, replacing what is there; returns the number of rows."""
    rows, seen = _counted(df.select(F.to_json(F.col(record)).alias("value")))
    rows.write.mode("overwrite").text(path)
    return seen.get["rows"]


def write_splits(df: DataFrame, out: str) -> int:
    """Write the rows under ``out/split=<name>`` in one job and return their number.

    Only the folders of splits that have rows are replaced, one after the other; whatever else is in ``out``
    stays.  ``publish_splits`` replaces them together.
    Rows keep the order they come in: a frame sorted by split and position needs no
    further sort.
    """
    rows, seen = _counted(df)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("split").json(out)
    return seen.get["rows"]
