"""SimHash, language ID, language model: brute force, held-out accuracy, awkward rows."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.plantools import main_nodes
from turnmill.llm import common, components, kneser_ney, language_id, simhash


def brute_fingerprint(text, k=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    parts = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Least id reachable for a list of (id, fingerprint)."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i][1] ^ prints[j][1]).bit_count() <= 3:
            root[find(j)] = find(i)
    least = {}
    for i, (key, _) in enumerate(prints):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [least.get(find(i)) for i in range(len(prints))]


def test_simhash_classes(tables):
    docs = {r["doc_id"]: r["text"] for r in tables("documents").collect()}
    prints = [(i, brute_fingerprint(t)) for i, t in sorted(docs.items())]
    want = {i: (f"{p:016x}", c) for (i, p), c in zip(prints, brute_components(prints))}
    got = simhash.near_duplicates(tables("documents")).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == want and len(got) == len(want)
    kept = simhash.one_of_each(tables("documents")).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({c for _, c in want.values()})
    assert kept[0].__fields__ == tables("documents").columns


def test_simhash_of_awkward_rows(awkward, nothing):
    rows = awkward.collect()
    prints = [(r["doc_id"], brute_fingerprint(r["text"])) for r in rows]
    want = sorted((i or 0, f"{p:016x}", c) for (i, p), c in zip(prints, brute_components(prints)))
    assert sorted((r[0] or 0, *r[1:]) for r in simhash.near_duplicates(awkward).collect()) == want
    kept = simhash.one_of_each(awkward)
    assert kept.columns == awkward.columns and kept.where("doc_id = 6").count() == 1 and kept.where("doc_id = 7").count() == 0
    assert simhash.near_duplicates(nothing).collect() == [] and simhash.one_of_each(nothing).collect() == []


@pytest.mark.parametrize("bitmaps", [common.BITMAPS, 0])
def test_numbers_are_flagged_whether_bits_are_broadcast_or_not(spark, monkeypatch, bitmaps):
    monkeypatch.setattr(common, "BITMAPS", bitmaps)
    rows = spark.range(0, 100_000, numPartitions=3).select("id", F.monotonically_increasing_id().alias("number"))
    rows = common.staged(rows, "rows")
    edge = F.col("number").bitwiseAND((1 << 33) - 1).isin(0, 1, 32_767, 32_768, 33_332)
    numbers = rows.where(edge | (F.col("id") % 7 == 3)).select("number")
    found = common.flagged(rows, numbers.union(numbers), "flag")
    assert found.columns == ["id", "number", "flag"] and found.count() == 100_000
    assert found.where(F.col("flag") != (edge | (F.col("id") % 7 == 3))).count() == 0
    assert common.flagged(rows, numbers.limit(0), "flag").where("flag IS NULL OR flag").count() == 0


def test_rows_that_stay_are_picked_without_a_shuffle_of_texts(spark):
    docs = spark.createDataFrame([(i, f"text {i // 2} of some") for i in range(200)], "doc_id long, text string").repartition(3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        kept = simhash.one_of_each(docs)
        nodes = main_nodes(kept)
        assert "Exchange" not in nodes and not any("SortMerge" in x for x in nodes)
        assert sorted(r["doc_id"] for r in kept.collect()) == list(range(0, 200, 2))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_one_row_of_each_component_without_ids(spark):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(None, base + f" w{i % 3}") for i in range(40)] + [(None, "quite another text"), (7, "a third one"), (7, "a third one"), (None, "a third one"), (None, None), (3, " ")]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS fp", "2 AS number").repartition(4)).collect()
    near = brute_links([brute_fingerprint(base + f" w{i}") for i in range(3)])
    assert len([r for r in kept if (r["text"] or "").startswith("word")]) == len(near)
    assert [r["doc_id"] for r in kept if r["text"] == "a third one"] == [7]
    assert [r["doc_id"] for r in kept if not (r["text"] or "").strip()] == [3]


def brute_links(prints):
    """Groups of equal or close fingerprints."""
    groups = []
    for p in prints:
        near = [g for g in groups if any((p ^ q).bit_count() <= 3 for q in g)]
        groups = [g for g in groups if g not in near] + [{p}.union(*near)]
    return groups


def close_prints():
    choose = random.Random(3)
    prints = set()
    for center in [choose.getrandbits(64) for _ in range(4)]:
        for _ in range(120):
            value = center
            for bit in choose.sample(range(64), choose.randrange(1, 6)):
                value ^= 1 << bit
            prints.add(value)
    return sorted(prints)


def test_every_close_pair_shares_a_masked_key():
    for level in (1, 2, 3):
        masks = [m % (1 << 64) for m in simhash.covering_masks(3, level)]
        assert len(masks) == 15
        for a, b in itertools.combinations(close_prints()[::4], 2):
            assert (a ^ b).bit_count() > 3 or any((a ^ b) & m == 0 for m in masks)


@pytest.mark.parametrize("bucket", [2048, 40])
def test_large_buckets_are_dealt_out_anew(spark, bucket):
    values = close_prints()
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = simhash.links_within(spark.createDataFrame(signed, "fp long"), 3, bucket)
    got = {r["node"]: r["root"] for r in components.components(links).collect()}
    want = brute_components([(s, v) for (s,), v in zip(signed, values)])
    assert [got.get(s, s) for (s,) in signed] == want


def test_components_of_a_long_path(spark):
    ids = list(range(60))
    random.Random(1).shuffle(ids)
    links = spark.createDataFrame(list(zip(ids, ids[1:])) + [(1000, 1001), (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(links).collect()}
    assert got == {**dict.fromkeys(ids, 0), 1000: 1000, 1001: 1000}


def test_blocks_of_words_are_all_words(monkeypatch):
    monkeypatch.setattr(common, "BLOCK", 7)
    for text in (b"", b"   ", b"aa bb\ncc\x0bdddddddddddddd e", b"x" * 50, b" a" * 40 + b"\t"):
        assert [w for block in common.word_blocks(text) for w in block] == text.split()


def test_held_out_languages(tables):
    rows = language_id.identify(tables("documents")).join(tables("documents").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == tables("documents").count() and all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.99 * len(held)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert language_id.keep_identified(tables("documents")).count() >= 0.99 * len(rows)


class PlainLanguages:
    """The same model in dictionaries."""

    def __init__(self, rows):
        self.counts, self.totals = {}, Counter()
        for lang, text in rows:
            if lang is None or text is None:
                continue
            for word in language_id.words_of(text):
                for kind, unit in [(0, word)] + [(n, g) for n in language_id.ORDERS for g in language_id.grams(word, n)]:
                    self.counts.setdefault((kind, unit), Counter())[lang] += 1
                    self.totals[lang, kind] += 1
        words = {lang: n for (lang, kind), n in self.totals.items() if kind == 0}
        self.langs = sorted(words, key=lambda x: (-words[x], x))

    def row(self, kind, unit):
        own = self.counts.get((kind, unit))
        if own is None:
            return None
        return np.array([np.log10(own[x] / self.totals[x, kind]) if own[x] else language_id.PENALTY for x in self.langs])

    def word(self, word):
        row = self.row(0, word)
        for n in language_id.ORDERS:
            found = [r for r in (self.row(n, g) for g in language_id.grams(word, n)) if r is not None]
            if row is None and found:
                row = np.mean(found, axis=0)
        return row

    def predict(self, text):
        words = language_id.words_of(text)
        if not any(c.isalpha() for w in words for c in w):
            return "und", 0.0
        rows = [r for r in map(self.word, words) if r is not None]
        if not rows:
            return self.langs[0], 1 / len(self.langs)
        mean = np.mean(rows, axis=0)
        best = int(np.argmax(mean))
        return self.langs[best], 1 / np.exp((mean - mean[best]) * min(len(rows), 50) * np.log(10)).sum()


@pytest.mark.parametrize("shard", [1 << 20, 3000])
def test_languages_by_brute_force(spark, tables, shard, monkeypatch):
    monkeypatch.setattr(language_id, "COUNTED", 2000)
    docs = tables("documents").where("doc_id < 120")
    rows = [(r["lang"] if i % 7 else None, r["text"]) for i, r in enumerate(docs.orderBy("doc_id").collect())]
    learned, asked = rows[:80], [t for _, t in rows] + [None, "", "12 !", "ж", "ǆǆǆ", "½", "the qzx", "x" * 500]
    model, plain = language_id.train(spark.createDataFrame(learned, "lang string, text string"), shard), PlainLanguages(learned)
    assert model.langs == plain.langs and (model.bits > 2) == (shard < 1 << 20)
    got, want = language_id.predictor(model)(asked), [plain.predict(t) for t in asked]
    assert [g[0] for g in got] == [w[0] for w in want]
    assert np.allclose([g[1] for g in got], [w[1] for w in want], rtol=1e-3, atol=1e-9)
    monkeypatch.setattr(language_id, "REMEMBERED", 40)
    monkeypatch.setattr(language_id, "BLOCK_CHARS", 1000)
    again = language_id.predictor(model)(asked)
    assert np.allclose([g[1] for g in again], [g[1] for g in got]) and [g[0] for g in again] == [g[0] for g in got]


def test_every_counted_unit_is_found_in_every_language(spark):
    rows = [("a", "rare rare rare common"), ("b", "common common x"), ("c", "y")]
    model = language_id.train(spark.createDataFrame(rows, "lang string, text string"), 5)
    scores, plain = language_id.Scores(model), PlainLanguages(rows)
    units = list(plain.counts)
    found = scores.find([("w" if kind == 0 else str(kind), unit) for kind, unit in units])
    assert np.allclose(found[:, :-1], [plain.row(*u) for u in units]) and (found[:, -1] == 1).all()
    assert not scores.find([("w", "absent"), ("4", "rare!")]).any()


def test_languages_of_awkward_rows(awkward, nothing):
    rows = {r["doc_id"]: r for r in language_id.identify(awkward).collect()}
    assert [rows[i]["lang_pred"] for i in (1, 2, 3, 4)] == ["und"] * 4 and rows[5]["lang_pred"] == "en"
    assert language_id.identify(nothing).collect() == []
    unlabelled = awkward.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_id.identify(unlabelled).collect()} == {"und"}


def brute_model(texts):
    """Counts and the probability function of the interpolated model, straight from the formulas."""
    chains = [t.encode().lower().split() + [b"\n"] for t in texts]
    count = Counter(w for c in chains for w in c)
    pairs = Counter(p for c in chains for p in zip([b"<"] + c, c))
    before = Counter(w for _, w in pairs)
    of = lambda counts: np.array([Counter(counts.values())[k] for k in (1, 2, 3, 4)])
    d2, d1 = kneser_ney.discounts(of(pairs)), kneser_ney.discounts(of(before))
    total, taken = Counter(), Counter()
    for (v, _), n in pairs.items():
        total[v] += n
        taken[v] += d2[min(n, 3)]
    rest = sum(d1[min(n, 3)] for n in before.values()) / len(pairs)

    def p(v, w):
        low = (before[w] - d1[min(before[w], 3)]) / len(pairs) + rest / (len(count) + 1)
        if not total[v]:
            return low
        return (pairs[v, w] - d2[min(pairs[v, w], 3)]) / total[v] + taken[v] / total[v] * low

    unseen = lambda v: taken[v] / total[v] * rest / (len(count) + 1)
    return count, p, unseen


@pytest.mark.parametrize("small", [False, True])
def test_language_model(tables, monkeypatch, small):
    if small:  # several shards and ranges, split contexts, cleared memories
        for name, value in (("SHARD_WORDS", 64), ("RANGE_TOKENS", 512), ("REMEMBERED", 50), ("LOOKED_UP", 300), ("COUNTED", 100)):
            monkeypatch.setattr(kneser_ney, name, value)
    docs = tables("documents").where("n_chars < 1500").orderBy("doc_id").limit(120)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    seen = [t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    count, p, unseen = brute_model(seen)
    total = sum(count.values())
    assert abs(sum(p(b"<", w) for w in count) + unseen(b"<") - 1) < 1e-9
    for r in kneser_ney.score_documents(docs).collect():
        chain = texts[r["doc_id"]].encode().lower().split() + [b"\n"]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(chain), sum(count[w] > 0 for w in chain), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 1) / (total + len(count) + 1)) for w in chain))
        assert r["score"] == pytest.approx(sum(math.log10(p(v, w)) for v, w in zip([b"<"] + chain, chain)))


def test_language_model_on_unseen_texts(tables):
    held = kneser_ney.score_documents(tables("documents")).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


def test_language_model_on_awkward_rows(awkward, nothing):
    rows = kneser_ney.score_documents(awkward).collect()
    assert len(rows) == 11 and sorted(r["n_tokens"] for r in rows)[:3] == [1, 1, 1]
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert kneser_ney.score_documents(nothing).collect() == []
