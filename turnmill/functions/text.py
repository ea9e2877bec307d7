"""Text cleaning."""

from pyspark.sql import Column, functions as F

# The 29 code points Python's str.strip() removes.
WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u001c\u001d\u001e\u001f\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(col: Column) -> Column:
    """Remove Unicode whitespace at both ends; plain ``trim`` only knows U+0020."""
    return F.btrim(col, F.lit(WHITESPACE))


def has_text(col: Column) -> Column:
    """True when some character is not whitespace; stops at the first such one."""
    return col.rlike(f"[^{WHITESPACE}]")


def clean_text(col: Column) -> Column:
    """Strip, then shorten every run of three or more newlines to two; NULL gives ''."""
    text = F.coalesce(col, F.lit(""))
    # Few texts have such a run; a byte search is cheaper than the regex.
    return F.when(F.contains(text, F.lit("\n\n\n")), F.regexp_replace(strip(text), "\n{3,}", "\n\n")).otherwise(strip(text))


def cut(col: Column, width: int) -> Column:
    """The first ``width`` characters, followed by '...' only when some were left out."""
    return F.when(F.length(col) > width, F.concat(F.left(col, F.lit(width)), F.lit("..."))).otherwise(col)
