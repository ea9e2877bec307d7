"""Line-first quality rules, in built-in expressions only.

Every line is tested for punctuation, navigation and boilerplate; lines that fail are taken out, and a
document that loses too much of its text is rejected.  Besides, a document fails the base rules if it is
short or repeats itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnmill.llm.common import SPACE

#: Marks that prose has few of.
SYMBOLS = "[#*$%&|<>]"

#: What ends or structures a sentence.
SENTENCE_MARKS = r"[.!?;:…。！？]"

#: Separators of menu entries, between white space.
SEPARATORS = r"\s[|»›·•>]\s"

#: Phrases of page furniture, in lower case.
BOILERPLATE = (
    "all rights reserved",
    "cookie policy",
    "privacy policy",
    "terms of use",
    "terms of service",
    "enable javascript",
    "click here",
    "lorem ipsum",
    "licensed under",
    "released under the",
    "general public license",
)


@dataclass(frozen=True)
class LineRules:
    """``plain_words``: a line of so many words needs a sentence mark.  ``symbol_share``: symbols per word.
    ``shouts``: exclamation marks per word.  ``separators``: menu separators in a line.
    ``min_kept``: share of the characters that must remain."""

    plain_words: int = 12
    symbol_share: float = 0.3
    shouts: float = 0.3
    separators: int = 3
    min_kept: float = 0.5
    min_words: int = 50
    max_repeat_percent: int = 50


def words_of(text: Column) -> Column:
    """Words of a text; NULL has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def line_passes(line: Column, rules: LineRules) -> Column:
    """Whether a line with words meets all rules.  Blank lines pass."""
    n_words = F.size(words_of(line))
    punctuation = (
        ((n_words < rules.plain_words) | line.rlike(SENTENCE_MARKS))
        & (F.regexp_count(line, F.lit(SYMBOLS)) <= n_words * rules.symbol_share)
        & (F.regexp_count(line, F.lit("!")) <= F.greatest(F.lit(1), n_words * rules.shouts))
    )
    navigation = F.regexp_count(line, F.lit(SEPARATORS)) < rules.separators
    boilerplate = ~F.lower(line).rlike("|".join(BOILERPLATE))
    return (n_words == 0) | (punctuation & navigation & boilerplate)


def assess(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text") -> DataFrame:
    """The rows of ``docs`` as struct ``row``, their measures, the cleaned text and the verdict.

    NULL and empty texts have no words and fail; an empty table gives no rows; repeated rows are judged
    each; clashing names stay inside ``row``.  Windows are compared by a 64-bit hash: in a text of a
    million words the chance of a false repeat is below one in ten million.
    """
    own = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    df = df.select("row", "text", words_of(own).alias("words"), F.split(own, "\n", -1).alias("lines"))
    window = lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))
    no_windows = F.array().cast("array<bigint>")
    df = df.select(
        "*",
        F.filter("lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("full"),
        F.filter("lines", lambda x: line_passes(x, rules)).alias("good"),
        F.when(F.size("words") >= 3, F.transform(F.sequence(F.lit(0), F.size("words") - 3), window))
        .otherwise(no_windows)
        .alias("windows"),
    )
    # Repeats: sort (hash, place), keep places whose neighbour has the same hash, count the words they cover.
    places = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = df.select(
        "*",
        F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(places))
        .otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
        .alias("ordered"),
    )
    # The number is never negative.  Its being there keeps filters on the verdict above the projections; below them
    # they would repeat all of this for every mention of an array.
    here = F.monotonically_increasing_id() >= 0
    same = lambda x, k: F.get("ordered", k)["h"] == x["h"]
    twice = F.transform("ordered", lambda x, k: F.when(same(x, k - 1) | same(x, k + 1), x["i"]))
    df = df.select("*", F.sort_array(F.array_compact(twice)).alias("places"))
    covered = F.transform("places", lambda i, k: F.least(F.lit(3), i - F.coalesce(F.get("places", k - 1), F.lit(-3))))
    df = df.select(
        "row",
        F.array_join("good", "\n").alias("cleaned"),
        F.when(here, F.size("words")).cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count(own, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("full") - F.size(F.array_distinct("full"))).cast("long").alias("n_dup_lines"),
        F.when(here, F.aggregate(covered, F.lit(0), lambda a, x: a + x)).cast("long").alias("n_repeat_words"),
        (F.size("lines") - F.size("good")).cast("long").alias("n_failed_lines"),
        F.length(F.array_join("lines", "")).alias("all_chars"),
        F.when(here, F.length(F.array_join("good", ""))).alias("good_chars"),
    )
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )
    df = df.withColumn("base_failed", failed)
    enough = F.col("good_chars") >= rules.min_kept * F.col("all_chars")
    return df.withColumn("kept", ~F.col("base_failed") & enough)


def quality_rules(docs: DataFrame, rules: LineRules = LineRules(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, the measures, base_failed and kept; see ``assess``."""
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return assess(docs, rules, text).select(
        F.col(f"row.{key}").alias("doc_id"), *measures, "base_failed", "kept", "n_failed_lines"
    )


def keep_good(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text") -> DataFrame:
    """The documents that pass, without their failed lines; all columns of ``docs``.

    NULL, empty and blank texts have too few words and go.  Repeated rows and NULL ids are judged like any others; columns
    of the same name as a measure are kept as they are.
    """
    judged = assess(docs, rules, text).where("kept")
    mine = [F.col("cleaned").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return judged.select(*mine)
