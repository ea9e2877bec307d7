"""Inputs of the queries, derived by Spark from the whole given tables.

The raw tables would let many checks pass without any work (no edge whitespace, hardly any
personal data), so these frames put the features in.  ``oracles`` defines the same in SQL.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

import turnmill as tm
from turnmill.operators.adapt import compute_once

NL = "\n"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First line of a document as Context, the rest as Response; NULL without a line break."""
    return pairs_of(table(spark, sf_dir, "documents"))


def pairs_of(docs: DataFrame) -> DataFrame:
    """The same of any documents, also of a stream."""
    parts = docs.select("doc_id", "text").transform(compute_once, "parts", F.split("text", NL, 2))
    return parts.select(
        "doc_id",
        F.get("parts", F.lit(0)).alias("Context"),
        F.get("parts", F.lit(1)).alias("Response"),
    )


def doc_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document pairs as two-message samples, unfiltered."""
    return doc_pairs(spark, sf_dir).transform(tm.pairs_to_messages)


def turn_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as samples."""
    return tm.turns_to_messages(table(spark, sf_dir, "conversations"))


def gapped_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns whose numbers have gaps, some wide."""
    number = F.col("turn") * F.when(F.col("conv_id") % 2 == 0, 10).otherwise(700) + F.col("conv_id") % 3
    return table(spark, sf_dir, "conversations").withColumn("turn", number.cast("long"))


def sparse_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns far apart, two with each number; a third of the conversations are put together as one."""
    conv = F.col("conv_id")
    number = (conv * 100 + F.floor(F.col("turn") / 2)) * 1_000_000
    one = F.when(conv % 3 == 0, 0).otherwise(conv).cast("long").alias("conv_id")
    return table(spark, sf_dir, "conversations").select(one, number.cast("long").alias("turn"), "role", "text")


def mixed_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, some with an unknown role, and each one's first turn as a conversation of its own."""
    turns, conv, turn = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"), F.col("conv_id"), F.col("turn")
    role = F.when((conv % 5 == 0) & (turn == 1), F.lit("bot")).otherwise(F.col("role"))
    short = turns.where(turn == 0).withColumn("conv_id", -1 - conv)
    return turns.withColumn("role", role).unionByName(short)


def overlapping_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns with addresses that have numbers in them."""
    more = " 5551234567@x.com and 5551234567.b@y.org 123-45-6789@z.org"
    return dirty_turns(spark, sf_dir).withColumn("text", F.concat("text", F.lit(more)))


def dirty_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns with odd whitespace at the ends, blank lines, and an address, a phone number and an SSN."""
    conv, turn = F.col("conv_id").cast("string"), F.lpad(F.col("turn").cast("string"), 4, "0")
    dirty = F.concat(
        F.lit("\u00a0 "),
        F.col("text"),
        F.lit(NL * 4 + "mail u"),
        conv,
        F.lit("@ex.com tel 555-"),
        F.lpad(F.right(conv, F.lit(3)), 3, "0"),
        F.lit("-"),
        turn,
        F.lit(" id 123-45-"),
        turn,
        F.lit(" \t"),
    )
    return table(spark, sf_dir, "conversations").withColumn("text", dirty)


def dirty_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.turns_to_messages(dirty_turns(spark, sf_dir))


def raw_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line of JSON per turn, well-formed or broken depending on its role and place."""
    text, turn, role = F.col("text"), F.col("turn"), F.col("role")
    said = F.to_json(F.struct(role, text.alias("content")))
    value = (
        F.when(role == "system", F.concat(F.lit('{"text":'), said, F.lit("}")))
        .when(turn == 0, F.concat(F.lit('{"messages":['), said, F.lit("]}")))
        .when(turn == 1, F.concat(F.lit('{"messages":['), said, F.lit(',{"role":"assistant","content":null}]}')))
        .when(turn == 2, F.concat(F.lit('{"messages":['), said, F.lit(',{"role":"bot","content":"x"}]}')))
        .when(turn == 3, F.concat(F.lit('{"messages":['), said, F.lit(',{"role":"user"}]}')))
        .when(turn == 4, F.concat(F.lit('{"messages":['), said, F.lit(',"x"]}')))
        .when(turn == 5, F.concat(F.lit('{"messages":'), said, F.lit("}")))
        .when(
            turn == 6,
            F.concat(F.lit('{"id":7,"messages":['), said, F.lit(',{"role":"assistant","content":5,"extra":true}]}')),
        )
        .otherwise(F.concat(F.lit('{"messages":['), said))
    )
    key = F.concat_ws("-", "conv_id", "turn")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", key.alias("key"), value.alias("value"))


def mixed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line of JSON per turn, with a value that is a number, a string, a list, an object or true."""
    turn, text = F.col("turn"), F.to_json(F.struct(F.col("text").alias("t")))
    number = turn.cast("string")
    value = (
        F.when(turn % 5 == 0, number)
        .when(turn % 5 == 1, F.concat(F.lit('"'), number, F.lit('"')))
        .when(turn % 5 == 2, F.concat(F.lit("["), number, F.lit(',"x"]')))
        .when(turn % 5 == 3, text)
        .otherwise(F.lit("true"))
    )
    line = F.concat(F.lit('{"conv":'), F.col("conv_id").cast("string"), F.lit(',"turn":'), number, F.lit(',"value":'), value, F.lit("}"))
    return table(spark, sf_dir, "conversations").select(line.alias("value"))


def odd_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw samples, some in a list of their own and some cut off."""
    value = F.col("value")
    return raw_samples(spark, sf_dir).select(F.when(F.col("turn") == 4, F.concat(F.lit("["), value, F.lit("]"))).otherwise(value).alias("value"))


def eval_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user turn as an evaluation prompt, numbered, with the answer that followed.

    Later turns have a ``prompt`` instead of or next to ``messages``; very short texts have
    neither or an empty one, so that every branch of the record is used.
    """
    turns = table(spark, sf_dir, "conversations")
    asked = turns.where(F.col("role") == "user").select("conv_id", "turn", "text").transform(tm.number_rows, "conv_id", "turn")
    answered = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response")
    )
    numbered = asked.join(answered, ["conv_id", "turn"], "left")
    text, turn, size = F.col("text"), F.col("turn"), F.length("text")
    message = F.array(F.struct(F.lit("user").alias("role"), text.alias("content")))
    category = F.when(F.contains(text, F.lit("?")), F.lit("question")).otherwise(F.lit("statement"))
    return numbered.select(
        "sample_id",
        F.when(((turn < 4) & (size >= 30)) | (turn >= 6), message).alias("messages"),
        F.when((turn >= 4) & (size >= 100), F.concat(F.lit("Q: "), text)).when(turn >= 4, F.lit("")).alias("prompt"),
        F.when(size >= 60, F.create_map(F.lit("category"), category)).alias("metadata"),
        "response",
        F.when(F.length("response") > 1200, F.lit("response too long")).alias("error"),
    )


def eval_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = eval_turns(spark, sf_dir)
    return tm.assemble_results(
        asked.select("sample_id", "messages", "prompt", "metadata"),
        asked.select("sample_id", "response", "error"),
    )
