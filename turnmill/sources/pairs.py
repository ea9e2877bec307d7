"""Tables of question/answer pairs."""

from collections.abc import Mapping
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

from turnmill.sources.jsonl import read_jsonl

Split = TypeVar("Split")


def pick_split(splits: Mapping[str, Split]) -> Split:
    """The ``train`` split if there is one, else the first."""
    return splits["train"] if "train" in splits else next(iter(splits.values()))


def read_pairs(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """A pairs table from Parquet, JSON Lines or CSV with a header, with all its columns.

    Texts in CSV contain line breaks, so a CSV file can't be split: each file is one task.
    """
    if format == "json":
        return read_jsonl(spark, path)
    if format == "csv":
        # Quotes inside texts are doubled.
        return spark.read.csv(path, header=True, multiLine=True, escape='"')
    return spark.read.format(format).load(path)
