"""JSON Lines input."""

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from turnmill import schemas
from turnmill.functions.text import has_text
from turnmill.operators.order import number_lines
from turnmill.storage import scratch_path


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The raw lines that are not blank, for checks on the text itself."""
    return spark.read.text(path).where(has_text(F.col("value")))


def is_object(value: Column) -> Column:
    """Whether a line of valid JSON is an object: it begins like one."""
    return value.rlike(r"^[ \t\r\n]*\{")


def infer_schema(records: Column, of: DataFrame) -> T.StructType:
    """The fields of VARIANT objects, in one pass; a field whose type differs between records stays VARIANT."""
    merged = of.agg(F.schema_of_variant_agg(records)).first()[0]
    if merged is None or not merged.startswith("OBJECT<"):
        return T.StructType()
    # A field that is null wherever it is has no type of its own.
    return T.StructType.fromDDL(re.sub(r"\bVOID\b", "VARIANT", merged.replace("OBJECT<", "STRUCT<"))[len("STRUCT<") : -1])


def read_jsonl(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Typed rows of JSON Lines files; blank lines are skipped, a malformed line fails.

    The lines are read as text because the JSON source fails on a line of Unicode spaces.
    With ``mode='PERMISSIVE'`` a malformed line gives NULLs, and its text goes to a
    ``_corrupt_record`` column if ``schema`` has one.  Without a ``schema`` all fields found in the files are read, at
    the cost of one more pass to find them, and no value is changed: a field that is a number here and
    a string or a list there is VARIANT, and is written back as it was.  A missing field and a null one both are
    NULL; ``read_records`` tells them apart.
    """
    if schema is None:
        lines = read_lines(spark, path).select(F.try_parse_json("value").alias("record"), "value")
        schema = infer_schema(F.col("record"), lines.where(is_object(F.col("value"))))
    record = F.from_json("value", schema, {"mode": mode, "columnNameOfCorruptRecord": "_corrupt_record"})
    return read_lines(spark, path).select(record.alias("r")).select("r.*")


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every line as one VARIANT column ``record``, exactly as it is; a malformed line fails."""
    return read_lines(spark, path).select(F.parse_json("value").alias("record"))


def quarantine_jsonl(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the lines that are none as ``(file, text, reason)``, from one pass over the files.

    Reasons: ``not valid JSON`` (a repeated key counts as such), ``not an object``, and with a declared ``schema``
    ``does not fit the schema``.  Without one the good rows have all their fields, as ``read_jsonl`` gives
    them.  What was read is written to the scratch folder once, good and bad lines apart, and both results come from there.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")).where(has_text(F.col("value")))
    record = F.try_parse_json("value")
    reason = F.when(record.isNull(), "not valid JSON").when(~is_object(F.col("value")), "not an object")
    if schema is not None:
        checked = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
        fits = F.from_json("value", checked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
        reason = reason.when(fits["_corrupt_record"].isNotNull(), "does not fit the schema")
    bad = F.col("reason").isNotNull()
    judged = lines.select("file", "value", reason.alias("reason"), record.alias("record"))
    parts = judged.select("file", F.when(bad, F.col("value")).alias("text"), "reason", F.when(~bad, F.col("record")).alias("record"), bad.alias("bad"))
    at = scratch_path(spark, "quarantine")
    parts.write.partitionBy("bad").parquet(at)
    written = spark.read.schema(parts.schema).option("basePath", at).parquet(at)
    good = written.where("NOT bad").select("record")
    if schema is None:
        schema = infer_schema(F.col("record"), good)
    rows = good.select(F.col("record").cast(schema).alias("r")).select("r.*")
    return rows, written.where("bad").select("file", "text", "reason")


def load_splits(
    spark: SparkSession,
    paths: Mapping[str, str | None],
    schema: T.StructType | None = None,
) -> dict[str, DataFrame]:
    """One frame per named split, e.g. ``{'train': ..., 'validation': ...}``.

    A split whose path is None is left out.
    """
    return {name: read_jsonl(spark, path, schema) for name, path in paths.items() if path}


def union_splits(splits: Mapping[str, DataFrame]) -> DataFrame:
    """All splits in one frame with a ``split`` column; a field that a split lacks is NULL there."""
    frames = [df.withColumn("split", F.lit(name)) for name, df in splits.items()]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def read_eval_prompts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Evaluation prompts with ``sample_id`` 1, 2, 3, ... in the order of the input."""
    record = F.from_json("value", schemas.EVAL_PROMPTS, {"mode": "FAILFAST"})
    return number_lines(read_lines(spark, path)).select("sample_id", record.alias("r")).select("sample_id", "r.*")
