"""Language identification, words first, then ever shorter character n-grams.

A known word counts with its log frequency in each language.  An unseen word counts with the mean over
its longest known character n-grams: four characters, else three, two, one.  A text's score for a
language is the mean over its words.

Every word and n-gram of the training texts is kept.  The counts go to shards by the hash of the unit; a shard is
three arrays (hash, language, log frequency), sorted by hash, in the shared folder.  Workers map them and look up
the words that they meet.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnmill.llm.common import local_path, release, remainder, shared_path, staged
from turnmill.llm.kneser_ney import save

UNKNOWN = "und"

#: n-gram lengths, longest first.
ORDERS = (4, 3, 2, 1)

#: log10 frequency of a unit in a language that lacks it.
PENALTY = -7.0

#: Units a task counts before it passes them on; entries of a shard, about.
COUNTED = 300_000
SHARD = 1 << 20

#: Words a worker remembers at most, and bytes for their scores; characters of texts looked at together.
REMEMBERED = 300_000
SCORE_BYTES = 64 << 20
BLOCK_CHARS = 1 << 20

LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of a word between blanks; an n-gram of one character is one of its letters."""
    padded = word if n == 1 else f" {word} "
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def _rows(counts: dict, columns: list[str]) -> pd.DataFrame:
    flat = [(*group, unit, n) for group, own in counts.items() for unit, n in own.items()]
    return pd.DataFrame(flat, columns=columns)


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    release()
    counts: dict[tuple, Counter] = defaultdict(Counter)
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            counts[(lang,)].update(words_of(text))
            if len(counts[(lang,)]) > COUNTED or sum(map(len, counts.values())) > 2 * COUNTED:
                yield _rows(counts, ["lang", "unit", "n"])
                counts.clear()
    if counts:
        yield _rows(counts, ["lang", "unit", "n"])


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[tuple, Counter] = defaultdict(Counter)
    size = 0
    for batch in batches:
        for lang, word, times in zip(batch["lang"], batch["unit"], batch["n"]):
            for n in ORDERS:
                own = counts[lang, n]
                for gram in grams(word, n):
                    own[gram] += times
            size += len(word)
            if size > 1 << 20:
                size = 0
                if sum(map(len, counts.values())) > COUNTED:
                    yield _rows(counts, ["lang", "size", "unit", "n"])
                    counts.clear()
    if counts:
        yield _rows(counts, ["lang", "size", "unit", "n"])


@dataclass
class Model:
    """Languages, the most frequent first, and where the log10 frequencies of all units are."""

    langs: list[str] = field(default_factory=list)
    folder: str = ""
    bits: int = 0


def unit_key(kind: str, unit: str) -> int:
    """The unit's hash; ``kind`` is ``w`` for words, else the n-gram's length."""
    return xxhash.xxh64_intdigest((kind + unit).encode(), 42)


def _write_shard(group: pd.DataFrame, folder: str) -> pd.DataFrame:
    shard = int(group["shard"].iloc[0])
    keys = group["key"].to_numpy(np.int64).view(np.uint64)
    order = np.lexsort((group["lang_id"].to_numpy(), keys))
    save(f"{folder}/langs-{shard}.npy", group["lang_id"].to_numpy(np.int32)[order])
    save(f"{folder}/shares-{shard}.npy", group["share"].to_numpy(np.float32)[order])
    save(f"{folder}/keys-{shard}.npy", keys[order])
    return pd.DataFrame({"n": [len(keys)]})


def train(docs: DataFrame, shard: int = SHARD) -> Model:
    """Fit a model to columns text and lang; rows where one is NULL are left out.  ``shard``: entries of a shard."""
    spark = docs.sparkSession
    labelled = docs.select("lang", "text").where("lang IS NOT NULL AND text IS NOT NULL")
    words = staged(
        labelled.mapInPandas(_count_words, "lang string, unit string, n long").groupBy("lang", "unit").agg(F.sum("n").alias("n")),
        "lang-words",
    )
    counted = words.mapInPandas(_count_grams, "lang string, size int, unit string, n long")
    parts = staged(counted.groupBy("lang", "size", "unit").agg(F.sum("n").alias("n")), "lang-grams")
    units = words.withColumn("size", F.lit(0)).unionByName(parts)
    totals = units.groupBy("lang", "size").agg(F.sum("n").alias("n"), F.count("n").alias("entries")).collect()  # a few per language
    of_words = {r["lang"]: r["n"] for r in totals if r["size"] == 0}
    if not of_words:
        return Model()
    langs = sorted(of_words, key=lambda x: (-of_words[x], x))
    place = {lang: i for i, lang in enumerate(langs)}
    bits = max(0, int(np.ceil(np.log2(sum(r["entries"] for r in totals) / shard))))
    folder = local_path(shared_path(spark, "lang-shards"))
    rows = [{"lang": r["lang"], "size": r["size"], "lang_id": place[r["lang"]], "total": r["n"]} for r in totals]
    # Of Arrow, since executors start further Python processes for a list, and keep them.
    of = spark.createDataFrame(pa.Table.from_pylist(rows), "lang string, size int, lang_id int, total long")
    kind = F.when(F.col("size") == 0, "w").otherwise(F.col("size").cast("string"))
    key = F.xxhash64(F.concat(kind, F.col("unit")))
    number = F.shiftrightunsigned("key", 64 - bits) if bits else F.lit(0)
    entries = units.join(F.broadcast(of), ["lang", "size"]).select(key.alias("key"), "lang_id", F.log10(F.col("n") / F.col("total")).cast("float").alias("share"))
    entries = entries.select(number.cast("long").alias("shard"), "key", "lang_id", "share")
    entries.groupBy("shard").applyInPandas(lambda group: _write_shard(group, folder), "n long").agg(F.sum("n")).collect()
    return Model(langs, folder, bits)


class Scores:
    """Scores of words per language, looked up in the shards many at a time and remembered for a while.

    The last column says whether the word tells anything at all.
    """

    def __init__(self, model: Model):
        self.model, self.maps = model, {}
        width = len(model.langs) + 1
        self.most = max(1, min(REMEMBERED, SCORE_BYTES // (4 * width)))
        self.table, self.rows = np.zeros((0, width), np.float32), {}

    def array(self, name: str) -> np.ndarray:
        if name not in self.maps:
            self.maps[name] = np.load(f"{self.model.folder}/{name}.npy", mmap_mode="r")
        return self.maps[name]

    def find(self, units: list[tuple[str, str]]) -> np.ndarray:
        """A row per (kind, unit): log frequencies, and 1 in the last column if the unit is known."""
        keys = np.fromiter((unit_key(kind, unit) for kind, unit in units), np.uint64, len(units))
        out = np.zeros((len(units), len(self.model.langs) + 1), np.float32)
        order = np.argsort(keys)
        keys, bits = keys[order], self.model.bits
        shards = keys >> np.uint64(64 - bits) if bits else np.zeros(len(keys), np.uint64)
        cuts = np.searchsorted(shards, np.arange((1 << bits) + 1, dtype=np.uint64))
        for shard in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            own = slice(cuts[shard], cuts[shard + 1])
            known = self.array(f"keys-{shard}")
            first = np.searchsorted(known, keys[own])
            times = np.searchsorted(known, keys[own], side="right") - first
            rows = order[own]
            out[rows[times > 0]] = [PENALTY] * len(self.model.langs) + [1]
            ends = np.cumsum(times)
            at = np.arange(ends[-1]) - np.repeat(ends - times - first, times)
            out[np.repeat(rows, times), self.array(f"langs-{shard}")[at]] = self.array(f"shares-{shard}")[at]
        return out

    def learn(self, words: list[str]) -> None:
        """Look up words that aren't remembered."""
        if len(self.rows) + len(words) > self.most:
            self.rows, self.table = {}, self.table[:0]
        made = self.find([("w", w) for w in words])
        open_ = np.flatnonzero(made[:, -1] == 0)
        for n in ORDERS:
            if not len(open_):
                break
            own = [grams(words[i], n) for i in open_]
            found = self.find([(str(n), g) for part in own for g in part])
            of = np.repeat(np.arange(len(open_)), [len(part) for part in own])
            sums = np.zeros((len(open_), made.shape[1]))
            np.add.at(sums, of, found * found[:, -1:])
            hit = sums[:, -1] > 0
            made[open_[hit]] = sums[hit] / sums[hit, -1:]
            open_ = open_[~hit]
        start = len(self.table)
        self.table = np.concatenate((self.table, made))
        self.rows.update(zip(words, range(start, start + len(words))))

    def total(self, words: list[str]) -> np.ndarray:
        """Sum of the words' rows."""
        out = np.zeros(len(self.model.langs) + 1)
        for start in range(0, len(words), self.most):
            part = words[start : start + self.most]
            new = [w for w in dict.fromkeys(part) if w not in self.rows]
            if new:
                if len(self.rows) + len(new) > self.most:  # then all are looked up anew
                    new = list(dict.fromkeys(part))
                self.learn(new)
            rows = np.fromiter(map(self.rows.__getitem__, part), np.int64, len(part))
            out += self.table[rows].sum(axis=0, dtype=np.float64)
        return out


def predictor(model: Model):
    """A function from texts to a (language, share of the posterior) each."""
    scores = Scores(model)

    def judge(words: list[str]) -> tuple[str, float]:
        if not model.langs or not any(c.isalpha() for word in words for c in word):  # the pattern lets numerals like a half pass
            return UNKNOWN, 0.0
        total = scores.total(words)
        if not total[-1]:
            return model.langs[0], 1 / len(model.langs)
        mean = total[:-1] / total[-1]
        best = int(np.argmax(mean))
        weight = min(total[-1], 50) * np.log(10)
        return model.langs[best], float(1 / np.exp((mean - mean[best]) * weight).sum())

    def predict(texts: list[str | None]) -> list[tuple[str, float]]:
        found: list[tuple[str, float]] = []
        held: list[list[str]] = []
        size = 0
        for text in texts:
            held.append(words_of(text))
            size += len(text or "")
            if size >= BLOCK_CHARS:
                found += judged(held)
                held, size = [], 0
        return found + judged(held)

    def judged(held: list[list[str]]) -> list[tuple[str, float]]:
        # What several texts have in common is looked up once, and many words at a time.
        new = [w for w in set().union(*held) if w not in scores.rows] if model.langs else []
        if new and len(new) <= scores.most // 2:
            scores.learn(new)
        return [judge(words) for words in held]

    return predict


def predicted(text: Column, model: Model, spark) -> Column:
    """Struct of lang_pred and score for each text."""
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predict = predictor(shared.value)
        for texts in batches:
            yield pd.DataFrame(predict(texts.tolist()), columns=["lang_pred", "score"]).astype({"score": "float64"})

    return F.pandas_udf(run, "lang_pred string, score double").asNondeterministic()(text)


def _labelled(docs: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    own = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    return own.withColumn("held_out", remainder(F.col("doc_id"), 3) == 1)


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    Learns from rows that aren't held out and have a language.  Texts that are NULL or have no letter, and all
    texts if there is nothing to learn from, are ``und`` with score 0.  Texts of letters none of which was seen
    get the most frequent language with the score of a guess; ties go to the more frequent language.  A NULL
    id isn't held out.  Repeated rows are predicted each; other columns are not read.
    """
    own = _labelled(docs, key, text, lang)
    model = train(own.where(~F.col("held_out")))
    result = own.select("doc_id", "held_out", predicted(F.col("text"), model, docs.sparkSession).alias("of"))
    return result.select("doc_id", "held_out", F.col("of.lang_pred").alias("lang_pred"), F.col("of.score").alias("score"))


def keep_identified(docs: DataFrame, least: float = 0.5, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows whose language is told with a share of ``least`` or more; all columns of ``docs``.

    Texts that are NULL or have no letter go; repeated rows are judged each; without any language to learn from all go.  A tie
    between two languages is a share of a half, which stays by default.
    """
    model = train(_labelled(docs, key, text, lang).where(~F.col("held_out")))
    rows = docs.select(F.struct("*").alias("row"), predicted(F.col(text), model, docs.sparkSession).alias("of"))
    return rows.where((F.col("of.lang_pred") != UNKNOWN) & (F.col("of.score") >= least)).select("row.*")
