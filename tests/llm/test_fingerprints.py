"""Invertible Bloom lookup sketches against plain sets."""

import hashlib
import random
import re

import pytest
import xxhash

from pyspark.sql import functions as F
from turnmill.llm import fingerprints as fp
from turnmill.llm.queries import QUERIES

signed = lambda h: h - (1 << 64) if h >> 63 else h
digest = lambda data: signed(xxhash.xxh64_intdigest(data, 42))


def paragraphs(text):
    parts = re.split(r"\n|(?<=[.!?。！？])[ \t\n\x0b\f\r]+", text or "")
    return {digest(p.encode()) for p in parts if p}


def cells(digests):
    out = [[0, 0, 0] for _ in range(12)]
    for d in digests:
        check = xxhash.xxh64_intdigest(d.to_bytes(8, "little", signed=True), 42) & 0xFFFF
        for t in range(3):
            cell = out[4 * t + (d >> 2 * t & 3)]
            cell[0], cell[1], cell[2] = cell[0] + 1, cell[1] ^ d & (1 << 64) - 1, cell[2] ^ check
    return "".join(f"{n % 65536:04x}{d:016x}{c:04x}" for n, d, c in out)


def dice(a, b):
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0


def expected(docs):
    """Rows by (id, NULL first, hash of the text), each with the next one."""
    order = sorted(((k is not None, k or 0, digest((t or "").encode()), k, t or "") for k, t in docs))
    for i, (*_, k, text) in enumerate(order):
        following = order[(i + 1) % len(order)][4]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, other, after = paragraphs(text), paragraphs(edited), paragraphs(following)
        yield (k, len(text), hashlib.sha256(edited.encode()).hexdigest(), cells(own), cells(other), dice(own, other), dice(own, after), len(own), len(own - other), len(other - own))


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "paragraphs", "n_gone", "n_new"]


def same(frame, docs):
    got = sorted(map(repr, (tuple(r[c] for c in COLUMNS) for r in frame.collect())))
    return got == sorted(map(repr, expected(docs)))


def test_query_agrees_with_sets(spark, sf_dir, tables):
    docs = [(r["doc_id"], r["text"]) for r in tables("documents").collect()]
    frame = QUERIES["op13_fingerprints"](spark, sf_dir)
    assert same(frame, docs)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
    means = frame.agg(F.avg("near_edited").alias("a"), F.avg("near_next").alias("b")).first()
    assert means["a"] > 0.4 > 0.1 > means["b"]


@pytest.mark.parametrize("ranges", [2, 7, 60])
def test_any_number_of_ranges(spark, ranges):
    choose = random.Random(ranges)
    line = lambda: choose.choice(["Same. ", "Two! ", "a\n", "é ü\n", ""]) + f"{choose.randrange(50)}. "
    docs = [(choose.choice([None, 3, choose.randrange(500)]), "".join(line() for _ in range(choose.randrange(30)))) for _ in range(300)]
    frame = spark.createDataFrame(docs, "doc_id int, text string").repartition(5)
    assert same(fp.fingerprint_edits(frame.selectExpr("*", "1 AS part", "2 AS place", "3 AS id"), ranges=ranges), docs)


def test_all_differing_digests_are_recovered(spark):
    choose = random.Random(2)
    rows = []
    for i in range(200):
        both = [choose.randrange(-(2**63), 2**63) for _ in range(choose.choice((0, 1, 5, 300)))]
        sides = [[choose.randrange(-(2**63), 2**63) for _ in range(choose.choice((0, 1, 2, 3, 40, 900)))] for _ in range(2)]
        rows.append((i, both + sides[0], both + sides[1]))
    frame = spark.createDataFrame(rows, "k long, a array<long>, b array<long>")
    found = {(r["k"], r["digest"], r["gone"]) for r in fp.differing_digests(frame, ["k"], "a", "b").collect()}
    assert found == {(k, d, gone) for k, a, b in rows for gone, only in ((True, set(a) - set(b)), (False, set(b) - set(a))) for d in only}


def test_pairs_that_do_not_peel_are_tried_again(spark):
    choose = random.Random(4)
    rows = [(i, [choose.randrange(2**62) for _ in range(500)], [choose.randrange(2**62) for _ in range(400)], "x") for i in range(20)]
    frame = spark.createDataFrame(rows, "k long, a array<long>, b array<long>, more string")
    first = fp._peel(frame, ["k"], "a", ["b"], 0, 1, False)
    assert first.where("cell IS NOT NULL").select("k").distinct().count() > 0
    got = fp.count_differences(frame, ["k"], "a", ["b"], passes=1).collect()
    assert sorted((r["k"], r["gone_b"], r["new_b"], r["more"]) for r in got) == [(i, 500, 400, "x") for i in range(20)]


def test_awkward_rows(awkward, nothing, spark):
    docs = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert same(fp.fingerprint_edits(awkward), docs)
    assert fp.fingerprint_edits(nothing).collect() == []
    one = [(5, "One. Two. Three.")]
    assert same(fp.fingerprint_edits(spark.createDataFrame(one, "doc_id long, text string")), one)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_equal_texts_have_equal_fingerprints(spark):
    frame = spark.createDataFrame([("a. b.",), ("b.\na.",), ("a. c.",), (None,), ("",)], "text string")
    a, b, c, d, e = (r[0] for r in frame.select(fp.fingerprint(F.col("text"))).collect())
    assert a == b != c and d == e == cells([]) and len(a) == 288
