"""From stored chat samples to safe, bounded, rendered text."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from turnmill.config import PLAIN, ChatTemplate
from turnmill.functions.chat import render_chat
from turnmill.functions.checks import validate_messages
from turnmill.functions.pii import KINDS, PLACEHOLDER
from turnmill.operators.adapt import compute_once
from turnmill.operators.filters import within_length, word_count
from turnmill.operators.redact import redact_messages


def curate(
    df: DataFrame,
    counter: Callable[[Column], Column] = word_count,
    max_length: int = 2048,
    template: ChatTemplate = PLAIN,
    special_tokens: int = 0,
    placeholder: str = PLACEHOLDER,
    kinds: Sequence[str] = KINDS,
) -> DataFrame:
    """Keep well-formed samples, redact them, drop the too long ones and add ``text``.

    One narrow stage: nothing is shuffled.
    """
    return (
        compute_once(df, "messages", F.col("messages"))
        .where(validate_messages(F.col("messages")))
        .transform(redact_messages, placeholder=placeholder, kinds=kinds)
        .where(within_length(F.col("messages"), counter, max_length, special_tokens))
        .withColumn("text", render_chat(F.col("messages"), template))
    )
