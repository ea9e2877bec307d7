"""Periodic runs against a search over all spans, and the Lyndon arrays against their definition."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from turnmill.llm import runs
from turnmill.llm.queries import QUERIES


def all_runs(words, least):
    """Every maximal stretch, straight from the definition."""
    found, n = set(), len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            stretch = words[start : i + q]
            smallest = next(p for p in range(1, len(stretch) + 1) if stretch[p:] == stretch[: len(stretch) - p])
            if smallest == q and len(stretch) >= max(least, 2 * q):
                found.add((start, len(stretch), q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words, found):
    dropped = {i for start, length, q in found for i in range(start + q, start + length)}
    return [w for i, w in enumerate(words) if i not in dropped]


def words_by_chance(choose):
    kind = choose.randrange(5)
    if kind == 0:
        return choose.choices("ab", k=choose.randrange(60))
    if kind == 1:
        return choose.choices("abc", k=4) * choose.randrange(12) + choose.choices("abc", k=choose.randrange(9))
    if kind == 2:  # Fibonacci
        a, b = ["x"], ["x", "y"]
        while len(b) < choose.randrange(5, 90):
            a, b = b, b + a
        return b
    if kind == 3:  # ascending chains
        return [w for k in range(1, choose.randrange(2, 9)) for w in ["a"] + ["b"] * k]
    return choose.choices("abcdefgh", k=choose.randrange(40)) + ["z"] * choose.randrange(30)


def test_lyndon_words_are_the_longest_ones():
    choose = random.Random(1)
    for trial in range(300):
        n = choose.randrange(1, 40)
        text = choose.choices(range(1, choose.choice((2, 3, 6)) + 1), k=n)
        longest = []
        for i in range(n):
            fits = [j for j in range(i + 1, n + 1) if all(text[i:j] < text[k:j] for k in range(i + 1, j))]
            longest.append(max(fits) - i)
        for rounds in (runs.ROUNDS, 0, 2):
            place, size = runs.lyndon_roots(np.array([0, *text, 0]), rounds)
            got = dict(zip((place - 1).tolist(), size.tolist()))
            assert all(longest[i] == l for i, l in got.items())
            for i in set(range(n)) - set(got):  # left out only behind an equal one
                l = longest[i]
                assert longest[i - l] == l and text[i - l : i] == text[i : i + l]


@pytest.mark.parametrize("least", [2, 12])
def test_blocks_agree_with_the_definition(least):
    choose = random.Random(least)
    for trial in range(60):
        texts = [words_by_chance(choose) for _ in range(choose.randrange(1, 12))]
        n_words, n_runs, found, collapsed = runs.runs_in_block([" ".join(t).encode() for t in texts], least)
        rows, at = list(zip(*found.tolist())), 0
        for text, n, count, short in zip(texts, n_words, n_runs.tolist(), collapsed):
            expected = all_runs(text, least)
            assert (n, rows[at : at + count]) == (len(text), expected)
            assert short.decode() == " ".join(collapse(text, expected))
            at += count
        assert at == len(rows)


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_what_the_rounds_leave_is_finished(rounds):
    choose = random.Random(rounds)
    for _ in range(60):
        text = [ord(w) - 97 for w in words_by_chance(choose)]
        order = np.random.default_rng(0).permutation(26)
        got = runs.runs_of(np.array([-1, *text, -1], np.int32), 3, order, rounds)
        assert [(s - 1, l, q) for s, l, q in zip(*(x.tolist() for x in got))] == all_runs(text, 3)


def test_long_texts_take_few_steps():
    for text in (["w"] * 400_000, ["a", "b", "c"] * 130_000, [str(i) for i in range(400_000)], [w for k in range(1, 700) for w in ["a"] + ["b"] * k]):
        _, n_runs, found, _ = runs.runs_in_block([" ".join(text).encode()], 12)
        assert n_runs[0] < 2000 and (len(text) < 390_000 or n_runs[0] <= 1)


def as_edited(doc_id, text):
    words = (text or "").encode().split()
    words = [w.decode() for w in words]
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def expected_row(doc_id, text):
    words = as_edited(doc_id, text)
    found = all_runs(words, 12)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    listed = "".join(f"{s},{l},{q}\n" for s, l, q in found)
    milli = best[1] * 1000 // best[2] if found else None
    return (doc_id, len(found), *best, milli, sha(listed), sha(" ".join(collapse(words, found))))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_agrees_with_the_definition(spark, sf_dir, tables):
    docs = {r["doc_id"]: r["text"] for r in tables("documents").collect()}
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in QUERIES["op11_periodic_runs"](spark, sf_dir).collect()}
    assert set(got) == set(docs)
    short = [k for k, t in docs.items() if len((t or "").split()) <= 400]
    edited = [k for k in short if zlib.crc32(str(k).encode()) % 10 == 0]
    assert len(edited) > 30
    for k in edited + short[:200]:
        assert got[k] == expected_row(k, docs[k])
    assert sum(r[1] > 0 for r in got.values()) >= len(edited)


def test_awkward_rows(awkward, nothing):
    got = runs.digests(runs.periodic_runs(runs.with_repeated_tails(awkward.withColumn("runs", awkward["doc_id"])))).collect()
    empty = hashlib.sha256(b"").hexdigest()
    rows = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in got}
    assert len(got) == awkward.count()
    for k in (1, 2, 3):
        assert rows[k] == (k, 0, None, None, None, None, empty, empty)
    assert rows[8][1:6] == (1, 0, 30_000, 1, 30_000_000) and rows[8][7] == hashlib.sha256(b"lang").hexdigest()
    assert rows[9][1] == 0 and None in rows
    assert runs.digests(runs.periodic_runs(runs.with_repeated_tails(nothing))).collect() == []
