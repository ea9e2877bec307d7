"""Fill-in-the-middle against code point slicing and round trips; the SQL is run with the other queries."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from turnmill.llm import fill_in_middle as fim

ALPHABET = ["a", "é", "語", "😀", "́", "\n", "<", "P", ">", "<P>", "<S>", "<M>", "S>", "<M", "\x00"]


def by_slicing(key, text, seed="1", rate=90, spm=20):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    if h4 % 100 < spm:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def some_texts(n, seed=3):
    choose = random.Random(seed)
    return [None if choose.random() < 0.05 else "".join(choose.choices(ALPHABET, k=choose.choice((0, 1, 2, 7, 8, 9, 40, 300)))) for _ in range(n)]


@pytest.mark.parametrize("most", [1, 64, 1 << 20])
def test_blocks_of_any_size_agree_with_slicing(most):
    texts = some_texts(400)
    got = []
    for first, offsets, data in fim.blocks(pa.array(["before", *texts], pa.string()).slice(1), most):
        made = fim.transform_block(list(range(first, first + len(offsets) - 1)), offsets, data, "1", 90, 20)
        got += zip(*(column.to_pylist() for column in made.values()))
    assert got == [by_slicing(i, t) for i, t in enumerate(texts)]
    assert {g[1] for g in got} == {"plain", "psm", "spm"}


def test_every_unit_is_found():
    text = "".join(t or "" for t in some_texts(200, 5))
    units = fim.Units(np.frombuffer(text.encode(), np.uint8))
    ends = np.cumsum([len(c.encode()) for c in text])
    assert (units.select(np.arange(1, len(text) + 1)) == ends).all()
    assert (units.rank(ends) == np.arange(1, len(text) + 1)).all() and units.rank(np.array([0])) == 0


def test_operator_and_restoring(spark):
    rows = [(i, t) for i, t in enumerate(some_texts(500, 7))] + [(None, "no id, twice"), (None, "no id, twice"), (2**60, "é" * 300_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "'x' AS form", "2 AS output")
    made = fim.fill_in_middle(docs)
    got = [(r["doc_id"], *tuple(r)[1:6]) for r in made.collect()]
    assert sorted(got, key=repr) == sorted([(k, *by_slicing(k, t)) for k, t in rows], key=repr)
    sha = {(k, hashlib.sha256((t or "").encode()).hexdigest()) for k, t in rows}
    assert {(r["doc_id"], r["restored_sha256"]) for r in fim.digests(made).collect()} == sha


def test_awkward_rows(awkward, nothing):
    got = fim.digests(fim.fill_in_middle(awkward)).collect()
    assert len(got) == awkward.count() and {r["doc_id"]: r["n"] for r in got}[9] == 50_000
    assert {r["doc_id"]: r["form"] for r in got}[1] == "plain"
    assert fim.digests(fim.fill_in_middle(nothing)).collect() == []
