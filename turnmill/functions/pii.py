"""Redaction of e-mail addresses, phone numbers and social security numbers."""

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# The three patterns, in the order they are applied, without their
# word boundaries; the address in two parts.  The bar in the last class of EMAIL_HOST
# stands for itself.
LOCAL = r"[A-Za-z0-9._%+-]"
EMAIL_HOST = r"[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}"
EMAIL = f"{LOCAL}+@{EMAIL_HOST}"
PHONE = r"\d{3}[-.]?\d{3}[-.]?\d{4}"
SSN = r"\d{3}-\d{2}-\d{4}"
PLACEHOLDER = "[REDACTED]"

# Java's \b, \w and \d are ASCII by default, and its Unicode mode counts combining
# marks as letters.  These forms agree with Python's.
WORD = r"[\p{L}\p{N}_]"
DIGIT = r"\p{Nd}"
BOUNDARY = f"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"

KINDS = ("email", "phone", "ssn")


def _email_pattern() -> str:
    # An address starts at the first word boundary in a run of address characters.  The search
    # only stops where such a run or the rest of one after a hit begins, steps over what is
    # before the boundary (and puts it back), and takes the local part without giving any of it
    # back: so every character is looked at a few times, however long the run is.
    skipped = rf"((?:(?<={WORD})[A-Za-z0-9_]++|(?<!{WORD})[.%+-]++)?+)"
    return rf"(?:(?<!{LOCAL})|\G){skipped}{LOCAL}++@{EMAIL_HOST}{BOUNDARY}"


def _number_pattern(pattern: str) -> str:
    # A number starts and ends with a digit, so its boundaries are "no word character
    # before" and "none after".  The leading lookahead turns other text down quickly.
    return f"(?={DIGIT})(?<!{WORD})" + pattern.replace(r"\d", DIGIT) + f"(?!{WORD})"


def literal_replacement(placeholder: str) -> str:
    """Escape a placeholder so that the regex engine inserts it as it stands."""
    return placeholder.replace("\\", "\\\\").replace("$", "\\$")


def redact_pii(col: Column, placeholder: str = PLACEHOLDER, kinds: Sequence[str] = KINDS) -> Column:
    """Replace the chosen kinds, always in the order e-mail, phone, SSN."""
    unknown = set(kinds) - set(KINDS)
    if unknown:
        raise ValueError(f"unknown kinds: {sorted(unknown)}")
    new = literal_replacement(placeholder)
    # Most texts hold nothing to redact.  Two cheap tests that every hit must pass, on the
    # original text, spare them the patterns.
    has_at = F.contains(col, F.lit("@"))
    suspicious = F.lit(False)
    out = col
    if "email" in kinds:
        suspicious = has_at
        # No address begins before the word that holds the first sign; what is before it is only copied.
        before = F.substring_index(col, "@", 1)
        kept = F.length(before) - F.length(F.substring_index(before, " ", -1))
        rest = F.regexp_replace(F.substr(col, kept + 1), _email_pattern(), "$1" + new)
        out = F.when(has_at, F.concat(F.left(col, kept), rest)).otherwise(col)
    if "phone" in kinds or "ssn" in kinds:
        suspicious = suspicious | col.rlike(f"{DIGIT}{{3}}")
    if "phone" in kinds:
        out = F.regexp_replace(out, _number_pattern(PHONE), new)
    if "ssn" in kinds:
        out = F.regexp_replace(out, _number_pattern(SSN), new)
    return F.when(suspicious, out).otherwise(col)


def _pattern(kind: str) -> str:
    return _email_pattern() if kind == "email" else _number_pattern(PHONE if kind == "phone" else SSN)


def hits(col: Column, placeholder: str = PLACEHOLDER, kinds: Sequence[str] = KINDS) -> dict[str, Column]:
    """How many hits of each kind ``redact_pii`` replaces, in its order; NULL has none.

    A kind is counted in the text in which the kinds before it are replaced already, so what belongs to an
    address is no phone number as well.
    """
    found = {}
    for i, kind in enumerate(k for k in KINDS if k in kinds):
        before = [k for k in KINDS if k in kinds][:i]
        text = redact_pii(col, placeholder, before) if before else col
        possible = F.contains(col, F.lit("@")) if kind == "email" else col.rlike(f"{DIGIT}{{3}}")
        found[kind] = F.when(possible, F.regexp_count(text, F.lit(_pattern(kind)))).otherwise(0)
    return found


def redact_contents(messages: Column, placeholder: str = PLACEHOLDER, kinds: Sequence[str] = KINDS) -> Column:
    """Redact the content of every message and keep all other fields."""
    return F.transform(messages, lambda m: m.withField("content", redact_pii(m["content"], placeholder, kinds)))
