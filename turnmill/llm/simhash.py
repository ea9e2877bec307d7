"""SimHash near duplicates by covering locality-sensitive hashing.

Every bit position of a fingerprint gets a vector of radius + 1 bits.  For every non-zero vector v there
is a mask: the positions whose vector has an odd product with v.  Two fingerprints that differ in at most
``radius`` bits agree under one of these masks at least, since ``radius`` vectors never span the space.
So each pair within the radius meets in one of 2^(radius + 1) - 1 tables, for certain and not just likely.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnmill.llm.common import flagged, staged, word_blocks
from turnmill.llm.components import components

BITS = 64
SEED = 42

#: A bucket with more fingerprints is dealt out anew under further masks.  Not a cap: no pair is lost.
BUCKET = 2048


def fingerprint(text: str | None, shingle: int) -> int:
    """Majority of the bits of the shingles' hashes, signed; 0 without a word."""
    counts, total, carried = np.zeros(BITS, np.int64), 0, []
    digest = xxhash.xxh64_intdigest

    def add(hashes: list[int]) -> None:
        nonlocal counts, total
        octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)

    for block in word_blocks((text or "").encode().lower()):  # of bytes, only A-Z are lowered
        words = carried + block
        if len(words) >= shingle:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))
            spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
            add([digest(joined[a:b], SEED) for a, b in spans])
        carried = words[-(shingle - 1) :] if shingle > 1 else []
    if not total and carried:
        add([digest(b" ".join(carried), SEED)])
    value = sum(1 << int(k) for k in np.flatnonzero(2 * counts > total))
    return value - (1 << BITS) if value >> (BITS - 1) else value


def fingerprints(text: Column, shingle: int) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(x, shingle) for x in texts], dtype="int64")

    return F.pandas_udf(run, "long").asNondeterministic()(text)


def covering_masks(radius: int, level: int) -> list[int]:
    """The masks of one level, signed.  Levels deal the vectors to the positions in different ways."""
    vectors = [i % (2 << radius) for i in range(BITS)]
    random.Random(level).shuffle(vectors)
    masks = [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() & 1) for v in range(1, 2 << radius)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def spanning_links(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links within the radius that connect whatever all of them would connect; one less than there are nodes at most."""
    links, left = [], prints.view(np.uint64)  # bits of negative numbers would be counted without their sign
    while len(left) > 1:
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            x = reached.pop()
            near = np.bitwise_count(left ^ x) <= radius
            if near.any():
                found = left[near]
                links += [(int(x.view(np.int64)), y) for y in found.view(np.int64).tolist()]
                reached += list(found)
                left = left[~near]
    return links


def _linked(batches: Iterator[pd.DataFrame], radius: int, bucket: int) -> Iterator[pd.DataFrame]:
    """From rows sorted by (mask, key) to links, and to the rows of buckets that are too large."""
    columns = ["a", "b", "mask", "key"]
    held: list[np.ndarray] = []  # the bucket at the end of the rows so far
    last, size, over = None, 0, False

    def close() -> pd.DataFrame | None:
        if size < 2 or over:
            return None
        links = spanning_links(np.concatenate(held).astype(np.int64), radius)
        return pd.DataFrame({"a": [x for x, _ in links], "b": [y for _, y in links], "mask": None, "key": None}, columns=columns)

    for rows in batches:
        if not len(rows):
            continue
        mask, key, value = (rows[c].to_numpy(np.int64) for c in ("mask", "key", "fp"))
        cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
        starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(rows)]))
        runs = np.flatnonzero(ends - starts > 1).tolist()
        for run in dict.fromkeys([0, *runs, len(starts) - 1]):  # others hold one fingerprint and are closed
            a, b = int(starts[run]), int(ends[run])
            own = (int(mask[a]), int(key[a]))
            if own != last:
                if (out := close()) is not None:
                    yield out
                held, last, size, over = [], own, 0, False
            held.append(value[a:b])
            size += b - a
            if size > bucket:
                over = True
                rest = np.concatenate(held)
                held = []
                yield pd.DataFrame({"a": rest, "b": None, "mask": own[0], "key": own[1]}, columns=columns)
    if (out := close()) is not None:
        yield out


def links_within(prints: DataFrame, radius: int, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints of column fp within the radius.

    A bucket of over ``bucket`` fingerprints goes on to the next level: its mask is joined with each mask
    of another covering family, which again no close pair can escape.  Each level about halves the free
    bits, and 11 free bits can't overfill a bucket.
    """
    spark = prints.sparkSession
    rows = prints.select(F.lit(0).cast("long").alias("mask"), "fp")
    found, level = [], 0
    while True:
        level += 1
        masks = F.array(*(F.lit(m).cast("long") for m in covering_masks(radius, level)))
        dealt = (
            rows.select("fp", "mask", F.explode(masks).alias("more"))
            .select("fp", F.col("mask").bitwiseOR(F.col("more")).alias("mask"))
            .select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
        )
        if level > 1:
            dealt = dealt.distinct()
        out = (
            dealt.repartition("mask", "key")
            .sortWithinPartitions("mask", "key", "fp")
            .mapInPandas(lambda x: _linked(x, radius, bucket), "a long, b long, mask long, key long")
        )
        out = staged(out, "covering")
        found.append(out.where("b IS NOT NULL").select("a", "b"))
        rows = out.where("b IS NULL").select("mask", F.col("a").alias("fp"))
        if rows.isEmpty():
            break
    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    return links


def rooted(nodes: DataFrame, radius: int) -> DataFrame:
    """Distinct fingerprints with the root of their component, itself a fingerprint, in a column ``root``."""
    roots = staged(components(links_within(nodes, radius)), "roots").withColumnRenamed("node", "fp")
    return nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def classes(prints: DataFrame, radius: int) -> DataFrame:
    """From (doc_id, fp) to (fp, component_id): the least id among all rows reachable by links."""
    nodes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    linked = staged(rooted(nodes, radius), "rooted")
    of_root = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    return linked.join(of_root, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint, component_id.

    NULL, empty and blank texts have fingerprint zero and are linked like any other.  A NULL id never is a
    component's id unless no row of the component has one.  Repeated rows give repeated rows; other columns
    are not read; an empty table gives no rows.
    """
    prints = staged(docs.select(F.col(key).alias("doc_id"), fingerprints(F.col(text), shingle).alias("fp")), "prints")
    named = prints.join(classes(prints, radius), "fp")
    return named.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, radius: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each component, that with the least id; all columns of ``docs``.

    Among rows of the same id, and in a component without ids, any one row stays.  NULL and blank texts all are near
    copies of each other.  The rows are written once with a number each; which ones stay is found on a narrow table, and a bit
    for each number picks them, so that no text is shuffled.  An empty table gives no rows.
    """
    marked = docs.select(F.struct("*").alias("row"), fingerprints(F.col(text), shingle).alias("fp"), F.monotonically_increasing_id().alias("number"))
    marked = staged(marked, "marked")
    id_ = F.col(f"row.`{key}`")
    first = F.min(F.struct(id_.isNull().alias("idless"), id_.alias("id"), "number")).alias("first")
    nodes = staged(marked.groupBy("fp").agg(first), "nodes")
    chosen = rooted(nodes, radius).groupBy("root").agg(F.min("first").alias("first")).select("first.number")
    return flagged(marked, staged(chosen, "chosen"), "stays").where("stays").select("row.*")
