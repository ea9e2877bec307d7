"""Toxicity, co-training, decontamination and the pipeline: held-out accuracy, brute force, awkward rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from turnmill.llm import cotraining, decontaminate, toxicity


def test_toxicity_of_planted_words(spark):
    choose, insults = random.Random(4), ["trashy", "moronic", "idiot"]
    rows = []
    for i in range(900):
        words = [f"w{choose.randrange(400)}" for _ in range(choose.randrange(5, 80))]
        toxic = i % 3 == 0
        if toxic:
            for _ in range(4):
                words.insert(choose.randrange(len(words)), choose.choice(insults))
        rows.append((i, " ".join(words), "en" if i % 2 else None, int(toxic)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    scored = toxicity.score_toxicity(frame.drop("toxic"), frame.select("doc_id", "toxic")).collect()
    held = [(r["predicted"], rows[r["doc_id"]][3]) for r in scored if r["held_out"]]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in scored)


def test_toxicity_learns_from_all_labelled_rows(spark, monkeypatch):
    """Every labelled text that doesn't calibrate is learnt from in an epoch, however many and however long; all are counted."""
    choose, learnt, whole = random.Random(6), [], toxicity.epoch

    def watched(*args):
        table, dense = whole(*args)
        learnt.append(dense[-1])
        return table, dense

    monkeypatch.setattr(toxicity, "epoch", watched)
    rows = [(i, " ".join(choose.choices(["a", "b", "c", f"w{i % 9}"], k=3)), None, 0) for i in range(7000)]
    rows += [(i, " ".join([*choose.choices(["a", "b", "c"], k=5000), "vilest", "a b"]), "en", 1) for i in range(7000, 7060)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int").repartition(3)
    settings = toxicity.Settings(epochs=2)
    model = toxicity.train(frame.drop("toxic"), frame.select("doc_id", "toxic").union(frame.select("doc_id", F.lit(0)).limit(50)), settings)
    learning = frame.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(settings.checked)) != 0).count()
    assert learning > 5000 and set(learnt) == {learning}
    assert all(model.rows.get(toxicity.units(w)[0]) for w in ("a", "vilest", "w8")) and model.langs == ["en"]
    n = 60 * 5003 + 0.1 * (settings.buckets + 1)
    assert model.lang_scores[model.rows.get(toxicity.units("vilest")[0]), 0] == pytest.approx(np.log(60.1 / n), abs=0.01)
    assert not model.rows.get(toxicity.units("nowhere")[0])


def test_changes_of_many_shares_are_averaged(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARE", 10_000)
    choose = random.Random(4)
    rows = [(i, " ".join([f"w{choose.randrange(300)}" for _ in range(30)] + ["idiot"] * (i % 2) * 2), "en", i % 2) for i in range(1500)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int").repartition(4)
    scored = toxicity.score_toxicity(frame.drop("toxic"), frame.select("doc_id", "toxic"))
    held = [r["predicted"] == r["doc_id"] % 2 for r in scored.collect() if r["held_out"]]
    assert sum(held) >= 0.97 * len(held) > 400


def test_a_text_scores_the_same_whatever_stands_behind_it():
    random_ = np.random.default_rng(2)
    rows = {toxicity.units(f"w{i}")[0]: i + 1 for i in range(50)}
    filters = [random_.normal(size=(w, 4, 3)).astype(np.float32) for w in (1, 2, 3)]
    embedding = np.vstack([np.zeros((1, 4)), random_.normal(size=(50, 4))]).astype(np.float32)
    model = toxicity.Model(rows, embedding, filters, [np.ones(3, np.float32)] * 3, random_.normal(size=9), 0.1, ["en"], np.zeros((51, 1), np.float32), np.zeros(1), 1.0, 0.7)
    words = toxicity._Words(model)
    of = lambda texts: toxicity.joined([np.array([words[w] for w in x], np.int64) for x in texts], 3)
    z = lambda texts: toxicity.logits(model, words.table[of(texts)[0]][:, :4], words.table[of(texts)[0]][:, 4:], of(texts)[1])[0]
    texts = [[f"w{random_.integers(50)}" for _ in range(n)] for n in (1, 0, 2, 0, 5, 1, 3, 1)]
    assert z(texts) == pytest.approx([z([x])[0] for x in texts], abs=1e-5)


def test_rows_of_new_words_are_made_together(monkeypatch):
    monkeypatch.setattr(toxicity, "REMEMBERED", 40)
    monkeypatch.setattr(toxicity, "CHUNK", 64)
    random_, names = np.random.default_rng(4), [f"w{i}" * (1 + i % 4) for i in range(150)]
    rows = {x: int(random_.integers(1, 51)) for w in names for x in toxicity.units(w) if random_.random() < 0.7}
    embedding = np.vstack([np.zeros((1, 4)), random_.normal(size=(50, 4))]).astype(np.float32)
    scores = np.vstack([np.zeros((1, 2)), random_.normal(size=(50, 2))]).astype(np.float32)
    filters = [random_.normal(size=(w, 4, 3)).astype(np.float32) for w in (1, 2, 3)]
    model = toxicity.Model(rows, embedding, filters, [np.ones(3, np.float32)] * 3, random_.normal(size=9), 0.1, ["en", "fr"], scores, np.zeros(2), 1.0, 0.7)
    texts = [[names[i] for i in random_.integers(0, 150, n)] for n in (0, 7, 30, 1, 90, 12, 25, 3) * 6]
    made, rows_of = [], toxicity._Words.rows
    monkeypatch.setattr(toxicity._Words, "rows", lambda self, at: (made.append(len(self.waiting)), rows_of(self, at))[1])
    together = toxicity._values(texts, model, toxicity._Words(model, together=True), 0.0)
    assert max(made) > 5
    assert (together == toxicity._values(texts, model, toxicity._Words(model), 0.0)).all()


def test_gradients_of_a_step_by_differences():
    """What a step adds to Adam's mean is a tenth of the loss's gradient, block by block of the words."""
    settings, random_ = toxicity.Settings(buckets=30, dimensions=3, filters=2, decay=0.0), np.random.default_rng(3)
    table = np.concatenate((random_.normal(size=(31, 3)), np.full((31, 1), 1e-4)), axis=1)
    table[0, :3] = 0
    size = 6 * 6 + 6 + 6 + 1
    dense = np.concatenate((random_.normal(size=size), np.zeros(2 * size + 3)))
    texts, labels, weight = [random_.integers(0, 12, n) for n in (7, 0, 1, 30)], np.array([1.0, 0, 1, 0]), np.array([1.0, 0.5, 1, 0.5])
    word_units = np.concatenate((np.zeros((1, 6), np.int64), random_.integers(0, 31, (11, 6))))

    def loss(parameters):
        own = toxicity.Learner(table.copy(), np.concatenate((parameters, dense[size:])), settings)
        own.learn(texts, word_units, labels, weight)
        return own.dense[-2] / 4, own.dense[size : 2 * size] * 10

    _, gradient = loss(dense[:size])
    for at in range(size - 1):
        step = np.eye(size)[at] * 1e-4
        assert gradient[at] == pytest.approx((loss(dense[:size] + step)[0] - loss(dense[:size] - step)[0]) / 2e-4, abs=2e-3)


def test_a_long_text_scores_as_its_parts_do(monkeypatch):
    monkeypatch.setattr(toxicity, "CHUNK", 64)
    random_ = np.random.default_rng(1)
    rows = {toxicity.units(f"w{i}")[0]: i + 1 for i in range(50)}
    filters = [random_.normal(size=(w, 4, 3)).astype(np.float32) for w in (1, 2, 3)]
    embedding = np.vstack([np.zeros((1, 4)), random_.normal(size=(50, 4))]).astype(np.float32)
    model = toxicity.Model(rows, embedding, filters, [np.ones(3, np.float32)] * 3, random_.normal(size=9), 0.1, ["en"], np.zeros((51, 1), np.float32), np.zeros(1), 1.0, 0.7)
    found, words = [f"w{i % 57}" for i in range(500)], toxicity._Words(model)
    numbers, starts = toxicity.joined([np.array([words[w] for w in found])], 3)
    z, _ = toxicity.logits(model, words.table[numbers][:, :4], words.table[numbers][:, 4:], starts)
    assert toxicity._long(found, model, toxicity._Words(model), 0.0)[0] == pytest.approx(float(z[0]), abs=1e-4)


def test_label_learners_on_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(2, 0, 0), (5, 1, 1), (5, 0, 0), (None, 1, 1), (6, None, None), (77, 1, 0)], "doc_id long, quality int, toxic int")
    for docs in (awkward, nothing):
        for known in (labels, labels.limit(0)):
            scored = toxicity.score_toxicity(docs, known).collect()
            assert len(scored) == docs.count() and all(0 <= r["score"] <= 1 for r in scored)
            judged = cotraining.classify(docs, known).collect()
            assert len(judged) == docs.count() and all(0 <= r["score"] <= 1 for r in judged)


def test_quality_on_held_out_rows(tables):
    labels = tables("labels")
    rows = cotraining.classify(tables("documents"), labels).join(labels, "doc_id").where("held_out").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.4 * len(bad)


def test_views_teach_each_other():
    """One view has too few labels to see its feature; it learns from what the other is sure of."""
    random_ = np.random.default_rng(2)
    settings = cotraining.Settings(buckets=8, rounds=2, confident=0.8)
    y = np.array([0, 1] * 12, float)
    pool_y = random_.integers(0, 2, 300)
    one = lambda places: cotraining.stacked([(np.array([int(p)]), np.ones(1)) for p in places])
    views = [one(y), one(np.full(len(y), 5))]  # the labelled rows show the second view one feature only
    pool = [one(pool_y), one(2 + pool_y)]
    model = cotraining.Model(np.zeros((7, 9)), [None, None], [np.array([1.0, 0.0])] * 2, np.zeros(3))
    cotraining.cotrain(views, y, lambda teachers, students: cotraining.examples(pool, teachers, students, settings), model, settings)
    assert model.weights[1][3] > 0 > model.weights[1][2]


def test_gradients_of_all_rows_by_brute_force(spark, tables):
    settings = cotraining.Settings(buckets=512, confident=0.55)
    own = cotraining._own(tables("documents"), "doc_id", "text", "source", "lang", "n_chars")
    edges = np.tile(np.linspace(0.1, 5, settings.bins - 1), (len(cotraining.LAYOUT), 1))
    random_ = np.random.default_rng(4)
    teachers, students = ([random_.normal(0, 1, s + 1) for s in settings.sizes] for _ in range(2))
    views = cotraining.with_views(own, edges, settings).persist()
    want = [[[0, np.zeros(s + 1)], [0, np.zeros(s + 1)]] for s in settings.sizes]
    limit, sums = np.log(0.55 / 0.45), 0
    for row in views.collect():
        pairs = [
            (np.frombuffer(row["content_places"], "<u4"), np.frombuffer(row["content_values"], "<f2").astype(float)),
            (np.frombuffer(row["metadata_places"], "<u4"), np.ones(len(row["metadata_places"]) // 4)),
        ]
        for i in (0, 1):
            (at, x), (other, z) = pairs[i], pairs[1 - i]
            odds = (teachers[1 - i][:-1][other] * z).sum() + teachers[1 - i][-1]
            for label in (0, 1):
                if (2 * label - 1) * odds >= limit:
                    error = 1 / (1 + np.exp(-((students[i][:-1][at] * x).sum() + students[i][-1]))) - label
                    want[i][label][0] += 1
                    np.add.at(want[i][label][1], at, error * x)
                    want[i][label][1][-1] += error
                    sums += 1
    assert sums > 500
    for parts in (1, 7):
        got = cotraining.summed_examples(views.repartition(parts), teachers, students, settings)
        for i in (0, 1):
            for label in (0, 1):
                assert got[i][label][0] == want[i][label][0] and np.allclose(got[i][label][1], want[i][label][1])
    views.unpersist()


def test_all_unlabelled_rows_take_part(spark, tables, monkeypatch):
    """Long texts too; and labels of ids that aren't there, or of texts too long, don't use up the sample."""
    docs = tables("documents").selectExpr("doc_id", "text", "source", "lang", "n_chars")
    seen, whole = [], cotraining.summed_examples
    monkeypatch.setattr(cotraining, "summed_examples", lambda views, *rest: seen.append(views.count()) or whole(views, *rest))
    labels = tables("labels").select("doc_id", "quality")
    absent = spark.range(10**6, 10**6 + 5000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality")
    settings = cotraining.Settings(sample=40, rounds=1, passes=1)
    cotraining.classify(docs, labels.union(absent.select(*(F.col(c).cast(t) for c, t in labels.dtypes))), settings).collect()
    assert seen == [docs.count() - 80]


def common_subsequence(a, b):
    table = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, table[j] = table[j], last + 1 if x == y else max(table[j], table[j - 1])
    return table[-1]


def test_common_subsequence():
    random_ = np.random.default_rng(3)
    for _ in range(300):
        a, b = random_.integers(0, 6, random_.integers(0, 30)), random_.integers(0, 6, random_.integers(0, 40))
        assert decontaminate.common_subsequence(a, b) == common_subsequence(a.tolist(), b.tolist())


@pytest.mark.parametrize("block_items", [2000, 15])
def test_leaks_and_edited_leaks(spark, tables, monkeypatch, block_items):
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", block_items)
    choose = random.Random(5)
    items = {r["item_id"]: r["text"] for r in tables("benchmark").collect()}
    docs = [r["text"] for r in tables("documents").orderBy("doc_id").limit(300).collect()]
    clean = [t for t in docs if not any(item in t for item in items.values())]
    rows, planted = [], set()
    for i, text in enumerate(clean):
        if i % 3 == 0:
            item = choose.choice(sorted(items))
            words = items[item].split()
            for k in range(len(words) - 8):  # an edited copy keeps the answer, the end of the item
                if i % 2 and choose.random() < 0.25:
                    words[k] = f"other{choose.randrange(1000)}"
            own = text.split()
            at = choose.randrange(len(own) + 1)
            text = " ".join(own[:at] + words + own[at:])
            planted.add((i, item))
        rows.append((i, text))
    found = decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), tables("benchmark"))
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert len(got & planted) >= 0.97 * len(planted)
    assert {i for i, _ in got} <= {i for i, _ in planted}


def test_short_and_end_edited_items_among_benchmark_words(spark):
    """What surrounds an item is made of the benchmark's own words, which dilute a window longer than the item."""
    choose = random.Random(6)
    words = [f"w{i}" for i in range(3000)]
    items = [[choose.choice(words) for _ in range(choose.choice((6, 8, 10, 30, 45)))] for _ in range(400)]
    rows, planted = [], set()
    for i in range(100):
        own = [choose.choice(words) for _ in range(choose.randrange(100, 400))]
        at, item = choose.randrange(len(own)), choose.randrange(len(items))
        copy = list(items[item])
        if i % 2:
            copy[-(len(copy) // 4) :] = [choose.choice(words) for _ in range(len(copy) // 4)]
        rows.append((i, " ".join(own[:at] + copy + own[at:])))
        planted.add((i, item))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, benchmark).collect()}
    assert len(got & planted) >= 0.97 * len(planted) and got <= planted


def test_recall_against_the_longest_common_subsequence(spark):
    """A full block of items of 5 to 60 words, one in each of 400 documents, edited in five ways; truth by brute force."""
    choose = random.Random(8)
    words = [f"w{i}" for i in range(6000)]
    items = [[choose.choice(words) for _ in range(choose.choice((5, 7, 9, 12, 14, 30, 45, 60)))] for _ in range(decontaminate.BLOCK_ITEMS)]
    rows, planted = [], set()
    for i in range(400):
        own = [choose.choice(words) for _ in range(choose.randrange(80, 250))]
        at, item = choose.randrange(len(own)), choose.randrange(len(items))
        copy, n = list(items[item]), len(items[item])
        new = lambda k: [choose.choice(words) for _ in range(k)]
        if i % 5 == 1:
            copy[n - 35 * n // 100 :] = new(35 * n // 100)
        elif i % 5 == 2:
            copy[: 35 * n // 100] = new(35 * n // 100)
        elif i % 5 in (3, 4):
            for k in choose.sample(range(n), n * (25, 40)[i % 5 - 3] // 100):
                copy[k] = choose.choice(words)
        own[at:at] = copy
        rows.append((i, " ".join(own)))
        place = own[max(0, at - 2) : at + n + max(2, n // 4)]
        share = common_subsequence(items[item], place) / n
        answer = items[item][-min(8, -(-n // 2)) :]
        if share >= 0.6 or share >= 0.5 and common_subsequence(answer, place) / len(answer) >= 0.75:
            planted.add((i, item))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    benchmark = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, benchmark).collect()}
    assert len(planted) > 350 and len(got & planted) >= 0.97 * len(planted)


def test_sums_of_matrices_over_many_tasks(spark):
    random_ = np.random.default_rng(1)
    whole = random_.normal(size=(300, 150, 4)).astype(np.float32)
    rows = [(t, a, whole[t, a : a + 100].tobytes()) for t in range(300) for a in (0, 100)]
    parts = spark.createDataFrame(rows, "task long, first long, rows binary")
    assert np.allclose(decontaminate._summed(parts, (150, 4)), whole.sum(axis=0), atol=1e-3)


def test_the_latent_space_is_fitted_to_all_passages(spark, monkeypatch, tmp_path):
    """The summed image is that of every passage, by brute force, however many there are; in the pipeline too."""
    choose, images, whole = random.Random(9), [], decontaminate._summed
    monkeypatch.setattr(decontaminate, "FITTED_PASSAGES", 20, raising=False)
    monkeypatch.setattr(decontaminate, "_summed", lambda parts, shape: images.append(whole(parts, shape)) or images[-1])
    words = [f"w{i}" for i in range(900)]
    texts = [[choose.choice(words[: choose.choice((20, 900))]) for _ in range(choose.randrange(300))] for _ in range(60)]
    items = [(i, " ".join(choose.sample(words[:600], 30)), None) for i in range(40)]
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(texts)], "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string, answer string").coalesce(1)
    decontaminate.find_leaks(docs, benchmark).collect()
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    dict(corpus_pipeline.STAGES)["benchmark decontamination"](spark, docs, str(tmp_path)).collect()

    rules = decontaminate.Rules()
    block = decontaminate.build_block(items, rules)
    n = len(block.words) + 1
    cut = [x[a : a + decontaminate.WINDOW] for x in texts for a in range(0, len(x), decontaminate.WINDOW)]
    tf = np.zeros((len(cut), n))
    for i, passage in enumerate(cut):
        for w in passage:
            tf[i, block.words.get(w, 0)] += 1
    own = np.stack([np.bincount(x, minlength=n) for _, x, _ in block.passages])
    weight = np.log((1 + len(cut) + len(own)) / (1 + (tf > 0).sum(axis=0) + (own > 0).sum(axis=0)))
    weight[0] = 0
    basis = np.random.default_rng(7).standard_normal((n, min(rules.rank, n - 1) + rules.oversample)) * weight[:, None]
    want = tf.T @ (tf @ basis)
    want[0] = 0
    assert n > decontaminate.FREQUENT and len(images) == 2
    assert all(np.allclose(image, want, atol=1e-3 * np.abs(want).max()) for image in images)


def test_candidates_by_brute_force():
    random_ = np.random.default_rng(5)
    for _ in range(50):
        pairs = sorted((int(g), int(p)) for g, p in random_.integers(0, [4, 60], (random_.integers(0, 80), 2)))
        seen, want = {}, []
        for i, (g, p) in enumerate(pairs):
            if p - seen.get(g, -9) >= 9:
                seen[g] = p
                want.append(i)
        group, place = np.array(pairs, np.int64).reshape(-1, 2).T
        assert decontaminate.spaced(group, place, 9) == want
    numbers = random_.integers(0, 40, 500)
    items = [random_.integers(1, 40, n) for n in (3, 9, 20)]
    members = np.stack([decontaminate.membership(x, 40) for x in items])
    low = random_.integers(0, 490, 200)
    high = np.minimum(500, low + random_.integers(1, 90, 200))
    length, place = random_.integers(1, 40, 200), random_.integers(0, 3, 200)
    got = decontaminate.most_words(numbers, low, high, length, members, place)
    for a, b, n, p, most in zip(low, high, length, place, got):
        own = np.isin(numbers[a:b], items[p])
        assert most == max(own[i : i + n].sum() for i in range(max(1, b - a - n + 1)))


def test_numbers_of_words_are_those_of_the_pattern(spark):
    block = decontaminate.build_block([(1, "It's a naïve_word, x\u00a0y İstanbul ½ ß", None)], decontaminate.Rules())
    texts = ["It's a NAÏVE_word,x y--It's\u3000½ İSTANBUL İstanbul ß SS a\x1ca", "", None, "a" * 100 + " x"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [np.frombuffer(r[0], decontaminate.kind_of(block)).tolist() for r in df.select(decontaminate.encoded(F.col("text"), block, spark)).collect()]
    assert got == [[block.words.get(w, 0) for w in decontaminate.words_of(t)] for t in texts]


def test_leaks_in_awkward_rows(spark, awkward, nothing):
    items = spark.createDataFrame([(1, "the same line of words here."), (2, None), (3, ""), (4, "!!")], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(awkward, items).collect())
    assert got == [(6, 1), (7, 1)]
    assert decontaminate.find_leaks(nothing, items).collect() == []
    assert decontaminate.find_leaks(awkward, items.limit(0)).collect() == []
    left = decontaminate.without_leaks(awkward, items)
    assert left.columns == awkward.columns and left.count() == awkward.count() - 3
    rows = [(None, "the same line of words here."), (None, "clean words without a leak"), (6, "the same line of words here."), (6, "other clean words"), (6, None)]
    own = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS number", "2 AS row")
    left = decontaminate.without_leaks(own, items)
    assert sorted(map(str, left.select("text").toPandas()["text"])) == ["None", "clean words without a leak", "other clean words"]


def test_pipeline(spark, sf_dir, tables):
    docs = tables("documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "language ID", "SimHash near-dedup", "benchmark decontamination", "byte-level BPE"]
    result = {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, sf_dir).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = [r["text"] for r in tables("benchmark").collect()]
    assert 0 < len(result) < len(texts) and not any(item in texts[i] for i in result for item in items)
    assert len({texts[i] for i in result}) == len(result)
    rows = docs.join(tables("labels").where("quality = 1"), "doc_id").where("n_chars > 800").collect()
    single = [r["doc_id"] for r in rows if sum(r["text"][:200] == t[:200] for t in texts.values()) == 1]
    clean = [i for i in single if not any(item in texts[i] for item in items)]
    assert sum(i in result for i in clean) >= 0.98 * len(clean)


def test_pipeline_on_awkward_rows(spark, awkward, nothing, sf_dir):
    for docs in (awkward, nothing):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, sf_dir)
            assert kept.columns == docs.columns and kept.count() <= docs.count()
        coded = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
        assert len(coded) == docs.count() and sorted(r["n_tokens"] for r in coded)[:3] == ([0, 0, 1] if coded else [])
