"""Evaluation tables: prompts in, results and their summary out."""

from pyspark.sql import DataFrame, functions as F

from turnmill.config import ChatTemplate, GenerationParams
from turnmill.functions.chat import lead_in, model_prompt, prompt_error, record_error, shown_prompt

NO_RESPONSE = "no response"


def _complete(prompts: DataFrame) -> DataFrame:
    """Add the optional columns a prompt table may lack."""
    missing = {
        "messages": "array<struct<role:string,content:string>>",
        "prompt": "string",
        "metadata": "map<string,string>",
    }
    return prompts.withColumns({c: F.lit(None).cast(t) for c, t in missing.items() if c not in prompts.columns})


def eval_prompts(prompts: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """Add ``model_prompt`` and, where a sample has nothing to prompt with, ``error``."""
    full = _complete(prompts)
    messages, prompt = F.col("messages"), F.col("prompt")
    return full.withColumns(
        {"model_prompt": model_prompt(messages, prompt, template), "error": prompt_error(messages, prompt)}
    )


def assemble_results(
    prompts: DataFrame,
    responses: DataFrame,
    params: GenerationParams = GenerationParams(),
    template: ChatTemplate | None = None,
) -> DataFrame:
    """One result row per prompt and response; a failed sample has only ``sample_id`` and ``error``.

    ``responses`` is ``(sample_id, response, error)``.  Both sides should be unique in
    ``sample_id``: a second response gives a second row, and one without a prompt is left out.
    ``unmatched_responses`` lists both.
    """
    asked = eval_prompts(prompts, template).withColumnRenamed("error", "prompt_error")
    got = responses.select("sample_id", "response", F.col("error").alias("response_error"))
    joined = asked.join(got, "sample_id", "left")

    unanswered = F.when(F.col("response").isNull(), F.lit(NO_RESPONSE))
    unshown = record_error(F.col("messages"), F.col("prompt"))
    joined = joined.withColumn("error", F.coalesce("prompt_error", "response_error", unanswered, unshown))
    ok = F.col("error").isNull()
    no_metadata = F.create_map().cast("map<string,string>")
    settings = F.struct(
        F.lit(params.max_new_tokens).alias("max_new_tokens"),
        F.lit(float(params.temperature)).alias("temperature"),
        F.lit(float(params.top_p)).alias("top_p"),
    )
    return joined.select(
        "sample_id",
        F.when(ok, F.col("model_prompt")).alias("model_prompt"),
        F.when(ok, shown_prompt(F.col("messages"), F.col("prompt"))).alias("prompt"),
        F.when(ok, F.col("response")).alias("response"),
        F.when(ok, F.coalesce(F.col("metadata"), no_metadata)).alias("metadata"),
        F.when(ok, settings).alias("generation_params"),
        "error",
    )


def eval_preview(results: DataFrame) -> DataFrame:
    """Start of prompt and response of every answered sample."""
    return results.where(F.col("error").isNull()).select(
        "sample_id",
        lead_in(F.col("prompt"), 100).alias("prompt"),
        lead_in(F.col("response"), 150).alias("response"),
    )


def eval_summary(results: DataFrame) -> DataFrame:
    """One row: number of results and of errors among them."""
    return results.agg(
        F.count(F.lit(1)).alias("total"),
        F.count("error").alias("errors"),
    )


def eval_by_category(results: DataFrame, name: str = "category") -> DataFrame:
    """Answered results per value of one metadata field; NULL where it is missing."""
    answered = results.where(F.col("error").isNull())
    category = F.try_element_at("metadata", F.lit(name)).alias("category")
    return answered.groupBy(category).agg(F.count(F.lit(1)).alias("n"))


def unmatched_responses(prompts: DataFrame, responses: DataFrame) -> DataFrame:
    """Responses that ``assemble_results`` can't place: without a prompt, or several for one.

    One row per such ``sample_id`` with the number of its responses.
    """
    counted = responses.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_responses"))
    known = prompts.select("sample_id", F.lit(True).alias("_known")).distinct()
    return counted.join(known, "sample_id", "left").where((F.col("n_responses") > 1) | F.col("_known").isNull()).drop("_known")


def first_responses(results: DataFrame, n: int = 3) -> DataFrame:
    """The answered ones among the first ``n`` results."""
    return results.orderBy("sample_id").limit(n).where(F.col("error").isNull()).select("sample_id", "prompt", "response")
