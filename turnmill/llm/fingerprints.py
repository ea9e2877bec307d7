"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, in built-in expressions only.

A document is the set of the digests of its paragraphs (lines, and sentences within lines).  A sketch has three
tables of cells; a digest falls into one cell of each.  A cell holds the number of its digests, their
exclusive or, and that of their check values.  Cells of two versions are subtracted: what both have cancels out.  A cell
with one digest left gives it away, its other two cells are relieved of it, and so on: peeling.  If cells remain, the
pair is tried again with tables of twice the size and other hashes.

The fingerprint is a sketch of 12 cells in hexadecimal digits.  The sketches that are peeled have ample room for
all paragraphs of both versions; only cells that something falls into exist, as rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnmill.llm.common import staged

#: A paragraph ends with its line, or with a sentence.
PARAGRAPH_END = r"\n|(?<=[.!?。！？])\s+"

#: Cells of a table of the fingerprint: a digest's bits 0-1, 2-3 and 4-5 name its cells.
NARROW = 4

#: Tables are peeled in turn, each so many times at most.
PASSES = 2

#: Cells of a table per paragraph of the two versions; cells that nothing falls into cost nothing.
ROOM = 2

#: Ranges of ids per shuffle partition.
RANGES = 4


def paragraph_digests(text: Column) -> Column:
    """The distinct digests (XXH64, seed 42) of the paragraphs; NULL and empty texts have none."""
    hashed = F.transform(F.split(F.coalesce(text, F.lit("")), PARAGRAPH_END), lambda p: F.xxhash64(p))
    return F.array_distinct(F.array_remove(hashed, F.xxhash64(F.lit(""))))


def _check(digest: Column) -> Column:
    return F.xxhash64(digest)


def sketch(digests: Column) -> Column:
    """The 12 cells as 144 bytes: number of digests (2), exclusive or (8), exclusive or of the check values (2)."""
    call, zero = F.call_function, F.lit(0).cast("long")

    def cell(number: Column) -> Column:
        table, place = call("div", number, F.lit(NARROW)).cast("int"), number % NARROW
        own = F.filter(digests, lambda d: call("shiftright", d, 2 * table).bitwiseAND(NARROW - 1) == place)
        start = F.struct(zero.alias("n"), zero.alias("d"), zero.alias("c"))
        add = lambda a, d: F.struct((a["n"] + 1).alias("n"), a["d"].bitwiseXOR(d).alias("d"), a["c"].bitwiseXOR(_check(d)).alias("c"))
        hexed = lambda value, digits: F.lpad(F.hex(value), digits, "0")
        return F.aggregate(own, start, add, lambda a: F.concat(hexed(a["n"] % 65536, 4), hexed(a["d"], 16), F.right(hexed(a["c"], 16), F.lit(4))))

    return F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3 * NARROW - 1)), cell), ""))


def fingerprint(text: Column) -> Column:
    """288 lowercase hexadecimal digits; equal texts have equal ones."""
    return F.lower(F.hex(sketch(paragraph_digests(text))))


def _peel(rows: DataFrame, by: list[str], old: str, others: list[str], attempt: int, passes: int, keep: bool) -> DataFrame:
    """Per row and other version what peeling finds: (by, version, width, cell, found, n, d, c, gone, new).

    Rows with a cell are what is left.  The others count what was found, per digest if ``keep`` is set.
    """
    sides = ", ".join(
        f"struct({i} AS version, (size({old}) + size({name}) + 8) * {ROOM * 2**attempt}L AS width, {sign}L AS sign, {of} AS digests)"
        for i, name in enumerate(others)
        for sign, of in ((1, old), (-1, name))
    )
    place = lambda table: f"width * {table} + pmod(xxhash64(d, {3 * attempt + table}), width)"
    key = [*by, "version", "width"]
    digests = rows.selectExpr(*by, f"inline(array({sides}))").selectExpr(*key, "sign", "explode(digests) AS d").selectExpr("*", "xxhash64(d) AS c")
    at = digests.selectExpr("*", f"explode(array({place(0)}, {place(1)}, {place(2)})) AS cell")
    sums = [F.expr(x) for x in ("sum(n) AS n", "bit_xor(d) AS d", "bit_xor(c) AS c")]
    cells = at.withColumnRenamed("sign", "n").groupBy(*key, "cell").agg(*sums)
    cells = cells.selectExpr(*key, "cell", "CAST(NULL AS BIGINT) AS found", "n", "d", "c", "0L AS gone", "0L AS new")
    sums += [F.expr(x) for x in ("sum(gone) AS gone", "sum(new) AS new")]
    full = "cell IS NULL OR n <> 0 OR d <> 0 OR c <> 0"
    for turn in range(3 * passes):
        table = turn % 3
        lone = f"cell BETWEEN width * {table} AND width * {table + 1} - 1 AND abs(n) = 1 AND c = xxhash64(d)"
        made = "struct({} AS cell, {} AS found, {} AS n, {} AS d, {} AS c, {} AS gone, {} AS new)".format
        taken = made("CAST(NULL AS BIGINT)", "d" if keep else "CAST(NULL AS BIGINT)", "0L", "0L", "0L", "if(n > 0, 1L, 0L)", "if(n < 0, 1L, 0L)")
        relieved = [made(place(t), "CAST(NULL AS BIGINT)", "-n", "d", "c", "0L", "0L") for t in range(3) if t != table]
        same = made("cell", "found", "n", "d", "c", "gone", "new")
        step = f"inline(if({lone}, array({taken}, {', '.join(relieved)}), array({same})))"
        cells = cells.where(full).selectExpr(*key, step).groupBy(*key, "cell", "found").agg(*sums)
    return cells.where(full)


def differing_digests(pairs: DataFrame, by: list[str], old: str, new: str, passes: int = PASSES) -> DataFrame:
    """(by, digest, gone): the digests that only one of two versions has, one row each; ``gone`` if it is the old one.

    ``by`` names columns that are unique and not NULL; ``old`` and ``new`` are arrays of distinct digests.  Pairs that do not
    peel are tried again, larger, until all do.
    """
    todo, attempt, done = pairs.select(*by, old, new), 0, []
    while True:
        found = staged(_peel(todo, by, old, [new], attempt, passes, True).select(*by, "found", "gone", F.col("cell").isNotNull().alias("left")), "peeled")
        failed = found.where("left").select(*by).distinct()
        done.append(found.join(failed, by, "left_anti").select(*by, F.col("found").alias("digest"), (F.col("gone") > 0).alias("gone")))
        if failed.isEmpty():
            return reduce(DataFrame.unionAll, done)
        todo, attempt = todo.join(failed, by, "left_semi"), attempt + 1


@contextmanager
def partitioned_by_any(spark: SparkSession) -> Iterator[None]:
    """In this block a join takes sides that are partitioned by some of its columns as they are."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def count_differences(rows: DataFrame, by: list[str], old: str, others: list[str], passes: int = PASSES) -> DataFrame:
    """``rows`` without the arrays, with ``gone_<name>`` and ``new_<name>`` per other version: how many digests differ.

    Like ``differing_digests``, but only counted.  Rows that come partitioned by some of the columns in ``by`` are not
    shuffled again.  The arrays are written with those rows only that do not peel.
    """
    # Both sides of the join below then ask for the same rows, so that what they are shuffled from is shuffled once.
    todo = rows.where(" AND ".join(f"{c} IS NOT NULL" for c in by))
    own, attempt, done = [c for c in rows.columns if c not in (old, *others)], 0, []
    names = [f"{kind}_{name}" for name in others for kind in ("gone", "new")]
    while True:
        of = lambda kind, i: F.sum(F.when(F.col("version") == i, F.col(kind))).alias(f"{kind}_{others[i]}")
        counts = [of(kind, i) for i in range(len(others)) for kind in ("gone", "new")]
        peeled = _peel(todo, by, old, others, attempt, passes, False).groupBy(*by).agg(F.count("cell").alias("_left"), *counts)
        joined = todo.join(peeled.hint("shuffle_hash"), by, "left")
        left = F.coalesce("_left", F.lit(0))
        found = joined.select(
            *own,
            *(F.coalesce(n, F.lit(0)).alias(n) for n in names),
            left.alias("_left"),
            *(F.when(left > 0, F.col(c)).alias(c) for c in (old, *others)),
        )
        with partitioned_by_any(rows.sparkSession):
            found = staged(found, "peeled")
        done.append(found.where("_left = 0").select(*own, *names))
        todo = found.where("_left > 0").select(*own, old, *others)
        if todo.isEmpty():
            return reduce(DataFrame.unionAll, done)
        attempt += 1


def _ranges(ids: DataFrame, ranges: int) -> tuple[Column, Column]:
    """The range of a row (id, h), ordered as the rows are: number of the id's range, and its part if the id fills several."""
    fractions = [i / ranges for i in range(1, ranges)]
    apart = ids.select("id", (F.spark_partition_id() % 64).alias("of")).groupBy("of")
    some = apart.agg(F.percentile_approx("id", fractions, 10 * ranges).alias("q")).select(F.explode("q").alias("q"))
    bounds = some.agg(F.percentile_approx("q", fractions, 10 * ranges).alias("q")).first()["q"] or []
    times = {b: bounds.count(b) for b in sorted(set(bounds))}
    values, step = list(times), max(1, int(len(times) ** 0.5))
    if not values:
        return F.lit(0).cast("long"), F.lit(0).cast("long")
    upto = lambda known: F.size(F.filter(known, lambda b: b <= F.col("id")))
    numbers = lambda of: F.array(*(F.lit(int(b)) for b in of)).cast("array<bigint>")
    chunk = upto(numbers(values[::step])) - 1
    chunks = F.array(*(numbers(values[i : i + step]) for i in range(0, len(values), step)))
    number = F.when(chunk >= 0, chunk * step + upto(F.get(chunks, chunk))).otherwise(0).cast("long")
    # An id that fills several ranges is split by the texts' hashes, whose order the rows follow.
    copies = F.get(numbers([1, *times.values()]), F.col("_range").cast("int"))
    begins = F.col("id") == F.get(numbers([values[0], *values]), F.col("_range").cast("int"))
    place = F.shiftrightunsigned(F.col("h").bitwiseXOR(F.lit(-(2**63))), 33)
    part = F.when((copies > 1) & begins & (F.col("_range") > 0), F.shiftright(place * copies, 31)).when(copies > 1, copies).otherwise(0)
    return number, part.cast("long")


def with_next_text(docs: DataFrame, key: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """(part, place, doc_id, text, digests, next_text, next_digests): each row with the one after it, the last with the first.

    The order is that of the ids (NULL first), of equal ids that of their texts' hashes.  Rows are dealt out by ranges of ids of
    about equal counts, an id with very many rows by its texts' hashes as well; the first row of each range also goes to the range
    before it.  Equal rows go to one task.  ``part`` and ``place`` name a row; the result is partitioned by ``part``.
    """
    spark = docs.sparkSession
    ranges = max(2, ranges or RANGES * int(spark.conf.get("spark.sql.shuffle.partitions")))
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("id"), value.alias("text")).withColumn("h", F.xxhash64("text"))
    number, part = _ranges(rows.select("id"), ranges)
    most = ranges + 1
    rows = rows.withColumn("_range", number).withColumn("part", F.col("_range") * most + part)
    firsts = rows.groupBy("part").agg(F.min(F.struct("id", "h")).alias("_first"))
    around = Window.orderBy("part")
    whole = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("part").over(around), F.max("part").over(whole))
    # At most two rows per range, whose number is a setting.
    firsts = F.broadcast(firsts.select("part", "_first", before.alias("_before")))
    is_first = F.col("id").eqNullSafe(F.col("_first.id")) & (F.col("h") == F.col("_first.h"))
    to = lambda part, extra: F.struct(F.col(part).alias("part"), F.lit(extra).alias("extra"))
    goes = F.when(is_first, F.array(to("part", False), to("_before", True))).otherwise(F.array(to("part", False)))
    dealt = rows.join(firsts, "part").select("id", "h", "text", paragraph_digests(F.col("text")).alias("digests"), F.inline(goes))
    # A number of its own keeps partitions small: what follows needs memory for all rows of one.
    dealt = dealt.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "part")
    order = Window.partitionBy("part").orderBy("extra", "id", "h")
    following = dealt.select(
        "part",
        "extra",
        F.row_number().over(order).alias("place"),
        F.col("id").cast(docs.schema[key].dataType).alias("doc_id"),
        "text",
        "digests",
        F.lead("text").over(order).alias("next_text"),
        F.lead("digests").over(order).alias("next_digests"),
    )
    return following.where("NOT extra").drop("extra")


def fingerprint_edits(docs: DataFrame, key: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and counts.

    The edited text is the text with its last n_chars // 2 code points replaced by the first as many (or all) of the next
    document's, by ascending id; the first follows the last.  Likeness is the Dice coefficient of the paragraph sets, from
    the digests that peeling recovers: 1 for two texts without paragraphs, 0 if one of them has none.

    NULL counts as the empty text; a NULL id comes before all others; rows of one id follow in the order of their texts' hashes;
    repeated rows give a row each; other columns are not read; an empty table gives no rows.
    """
    near = with_next_text(docs, key, text, ranges)
    once = lambda value, name: F.inline(F.array(F.struct(value.alias(name))))  # noqa: E731  keeps Catalyst from copying the value into each use
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.left("text", F.col("n_chars").cast("int") - half), F.left("next_text", half))
    of = near.withColumn("n_chars", F.length("text").cast("long")).select("*", once(edited, "edited"))
    of = of.select("*", once(paragraph_digests(F.col("edited")), "edited_digests"))
    rows = of.select(
        "part",
        "place",
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        sketch(F.col("digests")).alias("own_sketch"),
        sketch(F.col("edited_digests")).alias("edited_sketch"),
        *(F.size(f"{p}digests").cast("long").alias(f"{p}paragraphs") for p in ("", "edited_", "next_")),
        "digests",
        "edited_digests",
        "next_digests",
    )
    counted = count_differences(rows, ["part", "place"], "digests", ["edited_digests", "next_digests"])
    digits = lambda cells: F.lower(F.hex(cells))

    def likeness(other: str) -> Column:
        both = F.col("paragraphs") + F.col(f"{other}_paragraphs")
        return F.when(both == 0, 1.0).otherwise((both - F.col(f"gone_{other}_digests") - F.col(f"new_{other}_digests")) / both)

    return counted.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        digits("own_sketch").alias("fingerprint"),
        digits("edited_sketch").alias("edited_fingerprint"),
        likeness("edited").alias("near_edited"),
        likeness("next").alias("near_next"),
        "paragraphs",
        F.col("gone_edited_digests").alias("n_gone"),
        F.col("new_edited_digests").alias("n_new"),
    )
