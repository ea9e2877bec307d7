"""Row filters."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from turnmill.functions.binding import bind
from turnmill.functions.pairs import is_valid_pair
from turnmill.functions.text import WHITESPACE, has_text
from turnmill.operators.adapt import compute_once, field


def pair_validity(df: DataFrame, min_len: int = 10, max_len: int = 8000) -> Column:
    """The pair predicate on the columns of ``df``; a missing column counts as empty."""
    return is_valid_pair(field(df, "Context"), field(df, "Response"), min_len, max_len)


def filter_valid(df: DataFrame, min_len: int = 10, max_len: int = 8000) -> DataFrame:
    """Keep the usable pairs."""
    return df.where(pair_validity(df, min_len, max_len))


def skip_counts(df: DataFrame, min_len: int = 10, max_len: int = 8000) -> DataFrame:
    """One row with the number of kept and of skipped pairs."""
    valid = pair_validity(df, min_len, max_len)
    return df.agg(F.count_if(valid).alias("kept"), F.count_if(~valid).alias("skipped"))


def skip_reasons(df: DataFrame, min_len: int = 10, max_len: int = 8000) -> DataFrame:
    """Skipped pairs per reason: the first side at fault, and what is wrong with it."""

    def fault(name: str) -> Column:
        text = field(df, name)
        label = name.lower()
        size = F.length(text)
        return (
            F.when(text.isNull() | (size == 0), F.lit(f"{label} missing"))
            .when(~has_text(text), F.lit(f"{label} blank"))
            .when(size < min_len, F.lit(f"{label} too short"))
            .when(size > max_len, F.lit(f"{label} too long"))
        )

    reason = F.coalesce(fault("Context"), fault("Response")).alias("reason")
    return df.select(reason).where(F.col("reason").isNotNull()).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words, the default length measure."""
    # Blanks first: a class of one character is much cheaper than one of 29, which each character is tried against.
    return F.regexp_count(F.translate(text, WHITESPACE, " " * len(WHITESPACE)), F.lit("[^ ]+"))


def within_length(
    messages: Column,
    counter: Callable[[Column], Column] = word_count,
    max_length: int = 2048,
    special_tokens: int = 0,
) -> Column:
    """Whether a sample has at most ``max_length`` tokens over all its contents."""
    text = F.array_join(messages["content"], " ")
    room = max_length - special_tokens
    if counter is not word_count:
        return counter(text) <= room
    # n words need at least 2n - 1 characters, so most texts are settled by their length.
    return bind(text, lambda t: (F.length(t) < 2 * room + 1) | (word_count(t) <= room))


def filter_long(
    df: DataFrame,
    counter: Callable[[Column], Column] = word_count,
    max_length: int = 2048,
    special_tokens: int = 0,
    messages: str = "messages",
) -> DataFrame:
    """Keep samples of at most ``max_length`` tokens over all their contents.

    ``counter`` maps a text column to a count; pass ``arrow_counter`` around a tokenizer for
    true token counts, and its number of special tokens as ``special_tokens``.  It is evaluated once per
    sample.  A NULL content counts as empty, so the sample stays for the content check to report.
    """
    once = compute_once(df, messages, F.col(messages))
    return once.where(within_length(F.col(messages), counter, max_length, special_tokens))
