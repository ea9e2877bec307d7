"""Toxicity by a convolutional text classifier, trained on all labelled texts by tasks whose steps are averaged.

A word's embedding is the sum of those that the word and its beginnings hash to, so that inflected and
compound words share what their stem tells.  Filters over one, two and three words are pooled by their
maximum over the whole text; a logistic layer gives the logit.  The threshold is calibrated for each
language, which is guessed from the same words, and built into the score: 0.7 is every language's threshold.

Training texts are written once as words.  In an epoch each share of them, of about SHARE characters, goes on from the common
model by itself; where several shares have changed an embedding or a filter, the mean of their changes counts.  Which units are
known, languages' words and thresholds come from counts over all labelled texts, added up by shuffles.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnmill.llm.common import flagged, remainder, staged
from turnmill.llm.decontaminate import _summed as summed

WORD = re.compile(r"\w+")

#: Lengths of the beginnings that are hashed besides the word.
STEMS = (3, 4, 5, 6, 7)

#: Texts a worker computes at a time, in words; words it remembers.
CHUNK = 1 << 16
REMEMBERED = 400_000

#: Characters of words that a task learns from before its changes are averaged with those of other tasks.
SHARE = 64 << 20

#: Bits of a unit's hash that choose its slot: whether a unit is known is kept for each slot.
SLOT_BITS = 24

#: Rows of a slice in which tables are added up; parts of a logit in which texts are counted for thresholds.
SLICE = 4096
BINS = 256


@dataclass(frozen=True)
class Settings:
    """``seen``: a unit's slot needs so many labelled texts for the unit to be known.  ``settled``: training ends before
    ``epochs`` when the mean loss of an epoch, which is 0.7 for a guess, is less than this."""

    seen: int = 3
    buckets: int = 1 << 17
    dimensions: int = 12
    filters: int = 12
    widths: tuple[int, ...] = (1, 2, 3)
    epochs: int = 8
    settled: float = 0.02
    batch: int = 32
    rate: float = 0.01
    decay: float = 1e-4
    checked: int = 5  # one in so many labelled texts, by a hash of its id, calibrates instead of training
    least: int = 15  # texts of each class that a language's own threshold needs
    threshold: float = 0.7


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def units(word: str) -> list[int]:
    """Hashes of the word and of its beginnings; the word first."""
    parts = [f"={word}", *(word[:n] for n in STEMS if len(word) >= n)]
    return [xxhash.xxh64_intdigest(x.encode()) for x in parts]


class Known:
    """Embedding's number per known unit, looked up in a bit per slot: its size doesn't depend on the texts."""

    def __init__(self, bits: bytes, buckets: int):
        self.bits, self.buckets = bits, buckets

    def get(self, unit: int, default: int = 0) -> int:
        slot = unit >> (64 - SLOT_BITS)
        return unit % self.buckets + 1 if self.bits[slot >> 3] >> (slot & 7) & 1 else default


@dataclass
class Model:
    rows: Known | dict[int, int]  # embedding's number per known unit
    embedding: np.ndarray  # 0 is for unknown units
    filters: list[np.ndarray]  # per width: width x dimensions x filters
    bias: list[np.ndarray]
    output: np.ndarray
    constant: float
    langs: list[str]
    lang_scores: np.ndarray  # per embedding's number (those of whole words) and language
    thresholds: np.ndarray  # logit per language
    slope: float
    threshold: float


def joined(texts: list[np.ndarray], gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts after each other with ``gap`` unknown words behind each, and where each begins."""
    pad = np.zeros(gap, np.int64)
    parts = [x for own in texts for x in (own, pad)]
    return np.concatenate(parts), np.cumsum([0, *(len(x) + gap for x in texts[:-1])])


def convolved(x: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Filter responses at every place; the last places see zeros behind the end."""
    width = len(weights)
    out = x @ weights[0]
    for k in range(1, width):
        out[:-k] += x[k:] @ weights[k]
    return out + bias


class Learner:
    """What a share of the texts makes of the common model: Adam, for the embeddings Adagrad, on the logistic loss.

    ``table`` holds the embeddings and, in the last column, their sums of squared steps; ``dense`` the filters, biases,
    output and constant, Adam's two means of them, its steps, and the loss and number of texts of this epoch.  Gradients reach
    only each filter's best place.
    """

    def __init__(self, table: np.ndarray, dense: np.ndarray, settings: Settings):
        self.settings, self.table, self.dense = settings, table, dense
        self.size = (len(dense) - 3) // 3
        self.touched = np.zeros(len(table), bool)
        self.views(dense)

    def views(self, dense: np.ndarray) -> None:
        s = self.settings
        at, self.filters, self.bias = 0, [], []
        for w in s.widths:
            self.filters.append(dense[at : at + w * s.dimensions * s.filters].reshape(w, s.dimensions, s.filters))
            at += w * s.dimensions * s.filters
        self.decayed = at
        for _ in s.widths:
            self.bias.append(dense[at : at + s.filters])
            at += s.filters
        self.output = dense[at : at + s.filters * len(s.widths)]
        self.constant = dense[self.size - 1 : self.size]

    def pooled(self, numbers: np.ndarray, starts: np.ndarray, embedded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each text's largest response per filter, without bias, and its place; CHUNK words at a time."""
        f, widths = self.settings.filters, self.settings.widths
        gap, n = max(widths), len(numbers)
        projected = embedded @ np.concatenate([part for w in self.filters for part in w], axis=1).astype(np.float32)
        ends = np.append(starts[1:], n) - gap + 1  # the places behind see the next text
        best = np.full((len(starts), f * len(widths)), -np.inf, np.float32)
        place, columns = np.zeros(best.shape, np.int64), np.arange(best.shape[1])
        for low in range(0, n, CHUNK):
            high = min(low + CHUNK, n)
            near = projected[numbers[low : high + gap]]
            out, at = np.empty((len(near), best.shape[1]), np.float32), 0
            for k, width in enumerate(widths):
                own = out[:, k * f : (k + 1) * f]
                own[:] = near[:, at : at + f]
                for j in range(1, width):
                    own[:-j] += near[j:, at + j * f : at + (j + 1) * f]
                at += width * f
            for i in range(int(np.searchsorted(starts, low, "right")) - 1, int(np.searchsorted(starts, high))):
                a, e = max(int(starts[i]), low), min(int(ends[i]), high)
                if a < e:
                    where = out[a - low : e - low].argmax(axis=0)
                    value = out[a - low + where, columns]
                    better = value > best[i]
                    best[i][better], place[i][better] = value[better], (a + where)[better]
        return best, place

    def learn(self, texts: list[np.ndarray], word_units: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> None:
        """One step: ``texts`` are word numbers, ``word_units`` the embeddings' numbers of each word."""
        s, f, d = self.settings, self.settings.filters, self.settings.dimensions
        numbers, starts = joined(texts, max(s.widths))
        some, numbers = np.unique(numbers, return_inverse=True)
        rows_of = word_units[some]
        embedded = self.table[rows_of, :d].sum(axis=1)
        best, places = self.pooled(numbers, starts, embedded)
        raw = best + np.concatenate(self.bias)
        own = np.maximum(raw, 0)
        z = own @ self.output + self.constant[0]
        error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - labels) * weight / len(texts)
        back = error[:, None] * self.output * (raw > 0)
        gradient, words, steps = np.zeros(self.size), [], []
        gradient[: self.decayed] = s.decay * self.dense[: self.decayed]
        at = 0
        for k, w in enumerate(self.filters):
            g = back[:, k * f : (k + 1) * f]
            for j in range(len(w)):
                word = numbers[np.minimum(places[:, k * f : (k + 1) * f] + j, len(numbers) - 1)]
                gradient[at : at + d * f] += np.einsum("tfd,tf->df", embedded[word], g).ravel()
                words.append(word.ravel())
                steps.append((g[:, :, None] * w[j].T[None]).reshape(-1, d))
                at += d * f
        gradient[at : at + back.shape[1]] = back.sum(axis=0)
        gradient[at + back.shape[1] : -1] = own.T @ error + s.decay * self.output
        n, constant = self.size, self.constant[0] - s.rate * float(error.sum())
        mean, square = self.dense[n : 2 * n], self.dense[2 * n : 3 * n]
        self.dense[3 * n] += 1
        t = self.dense[3 * n]
        mean += 0.1 * (gradient - mean)
        square += 0.001 * (gradient * gradient - square)
        words, back_to = np.unique(np.concatenate(words), return_inverse=True)
        of_words = np.zeros((len(words), d))
        np.add.at(of_words, back_to, np.concatenate(steps))
        rows, back_to = np.unique(rows_of[words].ravel(), return_inverse=True)
        step = np.zeros((len(rows), d))
        np.add.at(step, back_to, np.repeat(of_words, rows_of.shape[1], axis=0))
        step += s.decay * self.table[rows, :d]
        self.table[rows, d] += (step * step).mean(axis=1)
        self.table[rows, :d] -= 5 * s.rate * step / np.sqrt(self.table[rows, d])[:, None]
        self.table[0, :d] = 0  # unknown units stay zero
        self.touched[rows] = True
        self.dense[:n] -= s.rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-8)
        self.constant[0] = constant
        self.dense[3 * n + 1] += float((weight * (np.logaddexp(0, z) - labels * z)).sum())
        self.dense[3 * n + 2] += len(texts)


def logits(model: Model, x: np.ndarray, votes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logit and guessed language (its place) of texts, given as embedded words and votes for languages."""
    ends = np.append(starts[1:], len(x)) - max(len(w) for w in model.filters) + 1  # the places behind see the next text
    cuts = np.stack((starts, ends), axis=1).ravel()
    cuts = cuts[:-1] if cuts[-1] == len(x) else cuts
    pooled = [np.maximum.reduceat(convolved(x, w, b), cuts, axis=0)[::2] for w, b in zip(model.filters, model.bias)]
    z = np.maximum(np.concatenate(pooled, axis=1), 0) @ model.output + model.constant
    return z, np.add.reduceat(votes, starts, axis=0).argmax(axis=1)


def best_threshold(z: np.ndarray, toxic: np.ndarray, other: np.ndarray) -> float:
    """Middle of the gap where the two classes' error rates have the least sum; ``toxic``, ``other``: texts at each logit."""
    order = np.argsort(z)
    z, toxic, other = z[order], toxic[order], other[order]
    missed = np.concatenate(([0], np.cumsum(toxic))) / max(toxic.sum(), 1)
    wrong = 1 - np.concatenate(([0], np.cumsum(other))) / max(other.sum(), 1)
    total = missed + wrong
    edges = np.concatenate(([z[0] - 1], z, [z[-1] + 1]))
    at = np.flatnonzero(total <= total.min() + 1e-12)
    widest = at[np.argmax(edges[at + 1] - edges[at])]
    return float((edges[widest] + edges[widest + 1]) / 2)


class _Table(dict):
    """Row per word in a growing table of what ``of`` makes of it; row 0 is for the words of which it makes only zeros."""

    def __init__(self, of: Callable[[str], list[int]], kind: type):
        super().__init__()
        self.of, self.table, self.next = of, np.zeros((1 << 12, len(STEMS) + 1), kind), 1

    def room(self) -> None:
        if len(self) > REMEMBERED:
            self.clear()
            self.next = 1

    def __missing__(self, word: str) -> int:
        own, at = self.of(word), 0
        if any(own):
            at, self.next = self.next, self.next + 1
            if at == len(self.table):
                self.table = np.concatenate((self.table, np.zeros_like(self.table)))
            self.table[at] = 0
            self.table[at, : len(own)] = own
        self[word] = at
        return at

    def numbers(self, words: str) -> np.ndarray:
        found = words.split()
        return np.fromiter(map(self.__getitem__, found), np.int64, len(found))


def as_words(text: Column) -> Column:
    """The words of each text with blanks between."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([" ".join(words_of(x)) for x in texts], dtype=object)

    return F.pandas_udf(run, "string").asNondeterministic()(text)


def counted(rows: DataFrame, settings: Settings) -> DataFrame:
    """Labelled texts that each slot is in (``lang`` is NULL, ``slot`` true), and words per embedding's number and language."""
    kinds = 1 << SLOT_BITS

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, total = _Table(units, np.uint64), np.zeros(kinds + 1, np.int32)
        by_lang: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch["words"], batch["lang"]):
                numbers = words.numbers(text)
                own = words.table[np.unique(numbers)]
                # Adds one to a slot however often it is there; the one behind the last is for stems that a word lacks.
                total[np.where(own, own >> np.uint64(64 - SLOT_BITS), np.uint64(kinds)).astype(np.int64)] += 1
                if lang is not None and len(numbers):
                    at = (words.table[numbers, 0] % np.uint64(settings.buckets)).astype(np.int64) + 1
                    np.add.at(by_lang.setdefault(lang, np.zeros(settings.buckets + 1, np.int64)), at, 1)
                words.room()
        total = total[:kinds]
        found = np.flatnonzero(total)
        yield pd.DataFrame({"lang": None, "slot": True, "place": found, "n": total[found]})
        for lang, n in by_lang.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"lang": lang, "slot": False, "place": at, "n": n[at]})

    parts = rows.select("words", "lang").mapInPandas(run, "lang string, slot boolean, place int, n long")
    return staged(parts.groupBy("lang", "slot", "place").agg(F.sum("n").alias("n")), "toxic-counts")


def known_units(counts: DataFrame, settings: Settings) -> Known:
    place = F.col("place") + 1
    slots = counts.where(F.col("slot") & (F.col("n") >= settings.seen))
    found = slots.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    bits = bytearray((1 << SLOT_BITS) // 8)
    for row in found.collect():  # a bit per slot
        begin = (row["part"] - 1) * len(row["bits"])
        bits[begin : begin + len(row["bits"])] = row["bits"]
    return Known(bytes(bits), settings.buckets)


def epoch(rows: DataFrame, known: Known, table: np.ndarray, dense: np.ndarray, weights: tuple[float, float], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Table and dense part after every share has learnt from its texts: the mean of the changes, of the shares that made one."""
    shared = rows.sparkSession.sparkContext.broadcast((known, table, dense))
    width, n = table.shape[1], len(table)
    padding = -len(dense) % width
    both = lambda t, x: np.concatenate((t, np.append(x, np.zeros(padding)).reshape(-1, width)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, table, dense = shared.value
        words = _Table(lambda word: [known.get(x) for x in units(word)], np.int64)
        own, random, task = Learner(table.copy(), dense.copy(), settings), np.random.default_rng(11), 0
        for batch in batches:
            task = int(batch["task"].iloc[0]) if len(batch) else task
            order = random.permutation(len(batch))
            texts, labels = batch["words"].to_numpy()[order], batch["toxic"].to_numpy(np.float64)[order]
            for begin in range(0, len(order), settings.batch):
                words.room()
                numbers = [words.numbers(x) for x in texts[begin : begin + settings.batch]]
                y = labels[begin : begin + settings.batch]
                own.learn(numbers, words.table, y, np.where(y == 1, *weights))
        if own.dense[-1]:
            change = both(own.table, own.dense) - both(table, dense)
            made = np.append(own.touched, np.ones(len(change) - n)).astype(np.float64)
            change = np.concatenate((change, made[:, None]), axis=1).astype(np.float32)
            firsts = [a for a in range(0, len(change), SLICE) if change[a : a + SLICE, -1].any()]
            yield pd.DataFrame({"task": [task] * len(firsts), "first": firsts, "rows": [change[a : a + SLICE].tobytes() for a in firsts]})

    parts = rows.select("words", "toxic", F.spark_partition_id().alias("task")).mapInPandas(run, "task long, first long, rows binary")
    before = both(table, dense)
    total = summed(parts, (len(before), width + 1))
    shared.unpersist()
    after = before + total[:, :width] / np.maximum(total[:, width:], 1)
    return after[:n].astype(np.float32), after[n:].ravel()[: len(dense)]


def calibrate(model: Model, rows: DataFrame, settings: Settings) -> None:
    """Threshold per language and the score's slope, from counts of ``rows`` in small parts of their logits."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _Words(shared.value, together=True)
        for batch in batches:
            z, lang = _values((x.split() for x in batch["words"]), shared.value, words, 0.0).T
            yield pd.DataFrame({"lang": lang.astype(np.int64), "z": z, "toxic": batch["toxic"].to_numpy(np.int64)})

    found = rows.select("words", F.col("toxic").cast("long").alias("toxic")).mapInPandas(run, "lang long, z double, toxic long")
    found = found.groupBy("lang", F.floor(F.col("z") * BINS).alias("bin")).agg(F.avg("z").alias("z"), F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("other"))
    found = found.toPandas().sort_values(["lang", "bin"])  # a row per language and part of a logit
    lang, z, toxic, other = (found[c].to_numpy() for c in ("lang", "z", "toxic", "other"))
    both = lambda of: min(toxic[of].sum(), other[of].sum())
    everything = np.ones(len(z), bool)
    overall = best_threshold(z, toxic, other) if len(z) and both(everything) else 0.0
    for at in range(len(model.langs)):
        mine = lang == at
        model.thresholds[at] = best_threshold(z[mine], toxic[mine], other[mine]) if both(mine) >= settings.least else overall
    if len(z):
        away, n = z - model.thresholds[lang], toxic + other
        spread = np.sqrt(np.average((away - np.average(away, weights=n)) ** 2, weights=n))
        model.slope = float(np.clip(4 / max(spread, 1e-3), 0.05, 4.0))


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit to all labelled rows that have a text, of whatever length.

    ``docs``: doc_id, text, lang; ``labels``: doc_id, toxic.  An id with several labels is toxic if one is; of the rows of an id
    one counts; rows without id, text or label are left out.  Without examples of both classes the model knows nothing and
    scores all texts alike, below the threshold.
    """
    texts = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    texts = staged(texts.select("doc_id", "lang", as_words(F.col("text")).alias("words"), F.monotonically_increasing_id().alias("number")), "toxic-texts")
    label = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where("toxic IN (0, 1)")
    first = texts.groupBy("doc_id").agg(F.min("number").alias("number"))
    checked = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(settings.checked)) == 0
    chosen = staged(first.join(label, "doc_id").select("number", "toxic", checked.alias("checked")), "toxic-numbers")
    rows = flagged(flagged(texts, chosen, "labelled").where("labelled"), chosen.where("toxic = 1"), "toxic").withColumn("checked", checked)
    size = rows.agg(F.sum(F.length("words").cast("long"))).first()[0] or 0
    rows = rows.coalesce(size // SHARE + 1)
    found = {(r["toxic"], r["checked"]): r["count"] for r in chosen.groupBy("toxic", "checked").count().collect()}

    counts = counted(rows, settings)
    by_lang = counts.where(~F.col("slot")).select("lang", "place", "n").toArrow()  # at most a row per embedding and language
    langs = sorted(pc.unique(by_lang["lang"]).to_pylist())
    random = np.random.default_rng(5)
    d, f, buckets = settings.dimensions, settings.filters, settings.buckets
    embedding = random.normal(0, 0.1, (buckets + 1, d)).astype(np.float32)
    embedding[0] = 0
    model = Model(
        known_units(counts, settings), embedding,
        [random.normal(0, (1 / (w * d)) ** 0.5, (w, d, f)).astype(np.float32) for w in settings.widths],
        [np.zeros(f, np.float32) for _ in settings.widths],
        random.normal(0, 0.1, f * len(settings.widths)), 0.0,
        langs or ["und"], np.zeros((buckets + 1, max(1, len(langs))), np.float32),
        np.zeros(max(1, len(langs))), 1.0, settings.threshold,
    )
    if {toxic for toxic, _ in found} != {0, 1}:
        model.thresholds += 1e6
        return model
    for at, lang in enumerate(langs):
        n, mine = np.full(buckets + 1, 0.1), by_lang.filter(pc.equal(by_lang["lang"], lang))
        n[mine["place"].to_numpy()] += mine["n"].to_numpy()
        model.lang_scores[:, at] = np.log(n / n.sum())
    model.lang_scores[0] = 0
    del by_lang

    share = found.get((1, False), 0) / max(found.get((1, False), 0) + found.get((0, False), 0), 1)
    weights = 0.5 / max(share, 1e-3), 0.5 / max(1 - share, 1e-3)
    parameters = np.concatenate([*(x.ravel() for x in model.filters), *model.bias, model.output, [model.constant]]).astype(np.float64)
    table = np.concatenate((embedding, np.full((buckets + 1, 1), 1e-4, np.float32)), axis=1)
    dense = np.concatenate((parameters, np.zeros(2 * len(parameters) + 3)))
    for _ in range(settings.epochs):
        dense[-2:] = 0
        table, dense = epoch(rows.where("NOT checked"), model.rows, table, dense, weights, settings)
        if dense[-2] < settings.settled * dense[-1]:
            break
    fitted = Learner(table, dense, settings)
    model.embedding = table[:, :d].copy()
    model.filters, model.bias = [x.astype(np.float32) for x in fitted.filters], [x.astype(np.float32) for x in fitted.bias]
    model.output, model.constant = fitted.output.copy(), float(fitted.constant[0])
    calibrate(model, rows.where("checked"), settings)
    return model


class _Words(dict):
    """Row per word in a table of embedded words and their votes for languages; remembered for a while.

    Row 0 is the unknown word.  ``together``: rows of new words wait until ``rows`` is asked for some.
    """

    def __init__(self, model: Model, together: bool = False):
        super().__init__()
        self.together = together
        self.model, self.size = model, model.embedding.shape[1]
        self.table = np.zeros((REMEMBERED + CHUNK + 1, self.size + len(model.langs)), np.float32)
        self.next = self.made = 1
        self.waiting: list[list[int]] = []

    def room(self) -> None:
        if self.next > REMEMBERED:
            self.clear()
            self.next = self.made = 1
            self.waiting = []

    def rows(self, numbers: np.ndarray) -> np.ndarray:
        """The table's rows; those of new words are made together."""
        if self.waiting:
            units = np.array(self.waiting)
            self.table[self.made : self.next, : self.size] = self.model.embedding[units].sum(axis=1)
            self.table[self.made : self.next, self.size :] = self.model.lang_scores[units[:, 0]]
            self.made, self.waiting = self.next, []
        return self.table[numbers]

    def __missing__(self, word: str) -> int:
        rows = [self.model.rows.get(x, 0) for x in units(word)]
        at = 0
        if any(rows):
            at, self.next = self.next, self.next + 1
            self.waiting.append(rows + [0] * (len(STEMS) + 1 - len(rows)))  # embedding 0 is zero
            if not self.together:
                self.rows(np.empty(0, np.int64))
        if at or len(self) < 4 * REMEMBERED:
            self[word] = at
        return at


def _values(texts: Iterable[list[str]], own: Model, words: _Words, offset: float) -> np.ndarray:
    """Logit, shifted and scaled, and guessed language (its place) of texts given as words."""
    size, gap = own.embedding.shape[1], max(len(w) for w in own.filters)

    def flush(texts: list[np.ndarray]) -> np.ndarray:
        if not texts:
            return np.empty((0, 2))
        numbers, starts = joined(texts, gap)
        both = words.rows(numbers)
        z, lang = logits(own, both[:, :size], both[:, size:], starts)
        return np.stack((own.slope * (z - own.thresholds[lang]) + offset, lang), axis=1)

    out, held, total = [], [], 0
    for found in texts:
        if len(found) > CHUNK // 2:  # by itself
            out += [flush(held), _long(found, own, words, offset)[None]]
            held, total = [], 0
            words.room()
            continue
        held.append(np.fromiter(map(words.__getitem__, found), np.int64, len(found)))
        total += len(found)
        if total >= CHUNK // 2:
            out.append(flush(held))
            held, total = [], 0
            words.room()
    out.append(flush(held))
    words.room()
    return np.concatenate(out)


def scored(text: Column, model: Model, spark) -> Column:
    """Score of each text; NULL counts as empty.  Long texts go through in blocks; pooling joins them."""
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        words, offset = _Words(own, together=True), np.log(own.threshold / (1 - own.threshold))
        for batch in batches:
            values = _values(map(words_of, batch), own, words, offset)[:, 0]
            yield pd.Series(1 / (1 + np.exp(-np.clip(values, -50, 50))))

    return F.pandas_udf(run, "double").asNondeterministic()(text)


def _long(found: list[str], own: Model, words: _Words, offset: float) -> np.ndarray:
    """``_values`` of a long text in overlapping blocks: the maximum of the blocks' maxima is the text's."""
    size, gap, step = words.size, max(len(w) for w in own.filters), CHUNK // 2
    best, votes = None, 0
    for begin in range(0, len(found), step):
        words.room()
        part = found[begin : begin + step + gap - 1]
        both = words.rows(np.fromiter(map(words.__getitem__, part), np.int64, len(part)))
        x = np.concatenate((both[:, :size], np.zeros((gap, size), np.float32)))
        pooled = np.concatenate([convolved(x, w, b).max(axis=0) for w, b in zip(own.filters, own.bias)])
        best = pooled if best is None else np.maximum(best, pooled)
        votes = votes + both[:step, size:].sum(axis=0)
    z = np.maximum(best, 0) @ own.output + own.constant
    lang = int(np.argmax(votes))
    return np.array([own.slope * (z - own.thresholds[lang]) + offset, lang])


def score_toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Learns from rows that aren't held out.  A score depends on the text alone; NULL and empty texts get the
    score of a text without known words.  A NULL id isn't held out and has no label; repeated rows are scored
    each; other columns are not read; an empty table gives no rows.
    """
    own = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    model = train(own.where(remainder(F.col("doc_id"), 3) != 1), labels.where(remainder(F.col("doc_id"), 3) != 1), settings)
    result = own.select(
        "doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), scored(F.col("text"), model, docs.sparkSession).alias("score")
    )
    return result.withColumn("predicted", (F.col("score") >= settings.threshold).cast("int"))
