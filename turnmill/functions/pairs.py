"""Question/answer pairs: validity and conversion to messages."""

from pyspark.sql import Column, functions as F

from turnmill.functions.text import clean_text, has_text


def length_between(col: Column, low: int, high: int) -> Column:
    """Whether the text has ``low`` to ``high`` characters, both included.

    A character has one to four bytes, so the stored byte size settles nearly every text
    without a pass over it.
    """
    size = F.octet_length(col)
    long_enough = (size >= 4 * low) | (F.length(col) >= low)
    short_enough = (size <= high) | ((size <= 4 * high) & (F.length(col) <= high))
    return long_enough & short_enough


def _usable(col: Column, min_len: int, max_len: int) -> Column:
    return length_between(col, max(min_len, 1), max_len) & has_text(col)


def is_valid_pair(context: Column, response: Column, min_len: int = 10, max_len: int = 8000) -> Column:
    """Both sides present, of a raw length within the bounds, and not just whitespace.

    Never NULL, so kept and skipped rows always add up to the input.
    """
    both = _usable(context, min_len, max_len) & _usable(response, min_len, max_len)
    return F.coalesce(both, F.lit(False))


def message(role: str, content: Column) -> Column:
    """One ``{role, content}`` struct."""
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def pair_messages(context: Column, response: Column) -> Column:
    """The two-message array of a pair, both sides cleaned."""
    return F.array(
        message("user", clean_text(context)),
        message("assistant", clean_text(response)),
    )
