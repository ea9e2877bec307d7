"""Redaction over a table of chat samples."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from turnmill.functions.pii import KINDS, PLACEHOLDER, hits, redact_contents
from turnmill.operators.adapt import compute_once


def redact_messages(
    df: DataFrame,
    placeholder: str = PLACEHOLDER,
    kinds: Sequence[str] = KINDS,
    messages: str = "messages",
) -> DataFrame:
    """Redact every message content of every sample."""
    return compute_once(df, messages, redact_contents(df[messages], placeholder, kinds))


def pii_counts(df: DataFrame, text: str = "text", kinds: Sequence[str] = KINDS, placeholder: str = PLACEHOLDER) -> DataFrame:
    """One row per kind: number of replacements that redacting the column makes, and of rows with one."""
    found = df.select(*(n.alias(kind) for kind, n in hits(F.col(text), placeholder, kinds).items()))
    kinds = found.columns
    sums = found.agg(*(F.struct(F.sum(k).alias("n_hits"), F.count_if(F.col(k) > 0).alias("n_rows")).alias(k) for k in kinds))
    rows = F.array(*(F.struct(F.lit(k).alias("kind"), F.coalesce(F.col(k)["n_hits"], F.lit(0)).alias("n_hits"), F.col(k)["n_rows"].alias("n_rows")) for k in kinds))
    return sums.select(F.inline(rows))
