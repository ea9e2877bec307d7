"""Evaluation results on disk."""

from pyspark.sql import DataFrame, SparkSession

from turnmill import schemas
from turnmill.config import ChatTemplate, GenerationParams
from turnmill.operators.evals import assemble_results
from turnmill.sinks.jsonl import write_jsonl
from turnmill.sources.jsonl import read_jsonl


def write_results(
    prompts: DataFrame,
    responses: DataFrame,
    path: str,
    params: GenerationParams = GenerationParams(),
    template: ChatTemplate | None = None,
) -> int:
    """Join prompts and responses and write the records in sample order.

    The NULL fields of failed samples are left out, so their records hold only the
    sample's number and error.
    """
    results = assemble_results(prompts, responses, params, template).drop("model_prompt")
    return write_jsonl(results.orderBy("sample_id"), path)


def results_of(spark: SparkSession, path: str) -> DataFrame:
    """The records a results job wrote."""
    return read_jsonl(spark, path, schemas.RESULTS)
