"""Curation of pairs as they arrive: a file stream in, files out, nothing twice and nothing left out.

Every step looks at one row, so the stream has no state beyond the log of the files that it has read.  The split
goes by a threshold on the key's hash, which later rows do not move.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from turnmill.config import PrepareConfig
from turnmill.functions.checks import validate_messages
from turnmill.functions.pii import KINDS, PLACEHOLDER
from turnmill.operators.adapt import pairs_to_messages
from turnmill.operators.filters import filter_valid
from turnmill.operators.redact import redact_messages
from turnmill.operators.split import split_hash
from turnmill.storage import hadoop_path


def read_files(spark: SparkSession, path: str, schema: T.StructType, source: str = "parquet", files: int | None = None) -> DataFrame:
    """A stream of the files under ``path``, or of one file; ``files`` of them at a time at most."""
    place, system = hadoop_path(spark, path)
    if system.isFile(place):
        path = f"{path[:-1]}[{path[-1]}]"  # a pattern that only this file matches: the source wants a folder or a pattern
    reader = spark.readStream.schema(schema).format(source)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).load(path)


def curate_pairs(
    pairs: DataFrame,
    key: str,
    config: PrepareConfig = PrepareConfig(),
    placeholder: str = PLACEHOLDER,
    kinds: Sequence[str] = KINDS,
) -> DataFrame:
    """Pairs to ``(key, messages, split)``: usable ones, cleaned, checked, redacted and labelled.

    The same rows for a stream and for a table.
    """
    samples = filter_valid(pairs, config.min_length, config.max_length).transform(pairs_to_messages)
    checked = samples.select(key, "messages").where(validate_messages(F.col("messages")))
    return redact_messages(checked, placeholder, kinds).transform(split_hash, key, config.train_split, config.seed)


def write_files(stream: DataFrame, out: str, checkpoint: str, sink: str = "parquet") -> None:
    """Write all that is there now to ``out`` and return; the next call goes on with what came since.

    What has been read is kept under ``checkpoint``, and the files that count in a log under ``out``: a batch that
    fails is repeated, and its first files don't count.  Both folders must be shared by all machines.
    """
    written = stream.writeStream.format(sink).option("path", out).option("checkpointLocation", checkpoint)
    written.outputMode("append").trigger(availableNow=True).start().awaitTermination()
