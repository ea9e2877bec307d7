"""Between the shapes chat data comes in: pairs, turns, message arrays."""

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from turnmill.functions.pairs import pair_messages
from turnmill.operators.stretches import with_stretches


def field(df: DataFrame, name: str) -> Column:
    """The named column, or '' when the table does not have it."""
    return F.col(name) if name in df.columns else F.lit("")


def named(df: DataFrame) -> list[str]:
    """The column names, quoted, so that names with dots can be selected."""
    return [f"`{c}`" for c in df.columns]


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``withColumn`` for a costly value that later steps read more than once.

    Filters on a plain projected column are pushed below it with the expression copied in,
    so the value would be computed for the filter and again for the output.  A one-row
    generator keeps it in one place.
    """
    others = [c for c in named(df) if c != f"`{name}`"]
    once = df.select(*others, F.inline(F.array(F.struct(value.alias(name)))))
    return once.select(*named(df)) if name in df.columns else once


def pairs_to_messages(df: DataFrame) -> DataFrame:
    """Replace ``Context`` and ``Response`` by the two-message ``messages`` array."""
    messages = pair_messages(field(df, "Context"), field(df, "Response"))
    return df.withColumn("messages", messages).drop("Context", "Response")


def turns_to_messages(df: DataFrame, max_turns: int | None = None, block: int = 20_000) -> DataFrame:
    """Turn rows ``(conv_id, turn, role, text)`` to one row ``(conv_id, messages)`` per conversation.

    The turns are in the order of (turn, role, text).  Those of a conversation of more than ``block`` turns are gathered and
    sorted per stretch of about so many first; its stretches are then put in order and joined, so no task
    sorts the loose turns of a long one.  With ``max_turns`` a longer conversation is cut into rows
    ``(conv_id, segment, messages)`` of that many messages.
    """
    turn = F.struct("turn", F.col("role"), F.col("text").alias("content"))
    rows, several = with_stretches(df.select("conv_id", "turn", "role", "text"), "conv_id", "turn", block)
    turns = F.sort_array(F.collect_list(turn))
    if several:
        parts = rows.groupBy("conv_id", "_stretch").agg(turns.alias("_turns"))
        whole = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("_stretch", "_turns"))).alias("_parts"))
        whole = whole.select("conv_id", F.flatten(F.col("_parts")["_turns"]).alias("_turns"))
    else:
        whole = rows.groupBy("conv_id").agg(turns.alias("_turns"))
    plain = F.transform("_turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    samples = whole.select("conv_id", plain.alias("messages"))
    if max_turns is None:
        return samples
    starts = F.sequence(F.lit(0), F.array_size("messages") - 1, F.lit(int(max_turns)))
    cut = F.transform(starts, lambda at: F.slice("messages", at + 1, F.lit(int(max_turns))))
    return samples.select("conv_id", F.posexplode(cut).alias("segment", "messages"))


def turns_to_pairs(df: DataFrame, block: int = 20_000) -> DataFrame:
    """Each user turn with the turn after it, if that is the assistant's; numbers may have gaps and repeat.

    The order is that of (turn, role, text).  The next turn is found inside stretches of about ``block`` turns, measured
    first, over which a huge conversation spreads whatever its numbers are.  The last turn of a stretch goes with the first
    one of the next, and only these ends, one row per stretch, are ordered per conversation.
    """
    rows, several = with_stretches(df.select("conv_id", "turn", "role", "text"), "conv_id", "turn", block)
    inside = Window.partitionBy("conv_id", "_stretch") if several else Window.partitionBy("conv_id")
    inside = inside.orderBy("turn", "role", "text")
    pairs = rows.select(
        "conv_id",
        "turn",
        "role",
        F.col("text").alias("Context"),
        F.lead("role").over(inside).alias("_role"),
        F.lead("text").over(inside).alias("Response"),
    )
    if several:
        end = F.struct("turn", "role", "text")
        ends = rows.groupBy("conv_id", "_stretch").agg(F.min(end).alias("_first"), F.max(end).alias("_last"))
        across = Window.partitionBy("conv_id").orderBy("_stretch")
        seams = ends.select("conv_id", "_last", F.lead("_first").over(across).alias("_next")).select(
            "conv_id",
            "_last.turn",
            "_last.role",
            F.col("_last.text").alias("Context"),
            F.col("_next.role").alias("_role"),
            F.col("_next.text").alias("Response"),
        )
        pairs = pairs.unionByName(seams)
    return pairs.where((F.col("role") == "user") & (F.col("_role") == "assistant")).select("conv_id", "turn", "Context", "Response")


def exact_text(value: Column, kind: T.DataType) -> Column:
    """Text that differs wherever the values differ: every part with its length, NULLs marked, nothing rounded."""
    if isinstance(kind, T.StructType):
        parts = [exact_text(value.getField(f.name), f.dataType) for f in kind.fields]
        text = F.concat(*parts) if parts else F.lit("")
    elif isinstance(kind, T.ArrayType):
        text = F.array_join(F.transform(value, lambda x: exact_text(x, kind.elementType)), "")
    elif isinstance(kind, T.MapType):
        entry = T.StructType().add("key", kind.keyType).add("value", kind.valueType)
        text = F.array_join(F.array_sort(F.transform(F.map_entries(value), lambda x: exact_text(x, entry))), "")
    elif isinstance(kind, T.BinaryType):
        text = F.hex(value)
    else:
        text = value.cast("string")
    return F.coalesce(F.when(value.isNotNull(), F.concat(F.length(text).cast("string"), F.lit(":"), text)), F.lit("-"))


def with_row_key(df: DataFrame, name: str = "row_key", chunk: int = 10_000) -> DataFrame:
    """Add a unique, reproducible key to rows that have none.

    The key is a hash of the row's content, exact in every column, and the number of the copy.  Equal rows are
    counted with map-side combine first, so a row with very many copies is no hot group,
    and the copies are made again in chunks on many tasks.
    """
    columns = named(df)
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    counted = counted.withColumn("_hash", F.md5(exact_text(F.struct(*columns), df.schema)))

    few = counted.where(F.col("_copies") <= chunk).withColumn("_first", F.lit(0).cast("long"))
    many = (
        counted.where(F.col("_copies") > chunk)
        .withColumn("_first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1, F.lit(chunk).cast("long"))))
        .repartition("_hash", "_first")
    )
    last = F.least(F.col("_first") + chunk, F.col("_copies")) - 1
    copy = F.explode(F.sequence(F.col("_first"), last)).alias("_copy")
    rows = few.unionByName(many).select(*columns, "_hash", copy)
    return rows.select(F.concat_ws("-", "_hash", "_copy").alias(name), *columns)
