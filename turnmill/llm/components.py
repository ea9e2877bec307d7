"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnmill.llm.common import staged


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One step: every node's neighbours are linked to the least of them instead.

    ``large`` moves the neighbours above the node, else the node and the neighbours below it.  The least
    neighbour is a grouped minimum, joined back; no neighbourhood is gathered, so a hub does no harm.
    """
    if large:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
    return moved.union(least.select("a", F.col("least").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """From links (a, b) to (node, root), root the least node reachable; nodes without links are left out.

    Each round is written to the shared folder.  Rounds grow with the logarithm of the longest path.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    links, before = staged(links, "links"), None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        links = staged(_star(_star(links, large=True).distinct(), large=False).distinct(), "links")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
