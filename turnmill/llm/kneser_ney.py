"""Interpolated modified Kneser-Ney bigram model: counted in Spark, kept as sorted hash arrays that
workers map into memory, applied to whole texts.

Training, all of it distributed:

1. Words are counted by their 64-bit hash.  The counts go to shards by the hash's first bits, each shard
   one sorted array.  A word's id is its place in all shards together.
2. A bigram is one 64-bit number, id of the context and id of the word.  Tasks count the bigrams they see
   and send one block of sorted numbers per key range.  A range holds about RANGE_TOKENS tokens: frequent
   contexts are split into several ranges by the counts of step 1, so that no range holds a hot context whole.
3. Each range becomes one sorted array.  How many words follow a context once, twice or more, and how many
   contexts precede a word, goes in blocks to the shards, which add these up.

The files lie in the shared folder, are written under another name first and then renamed, so that a
repeated task does no harm, and are mapped, not read, by the workers that score.
"""

from __future__ import annotations

import os
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnmill.llm.common import local_path, remainder, shared_path, staged, word_blocks

#: Words per shard and tokens per range, about: they bound the memory of a task.
SHARD_WORDS = 1 << 20
RANGE_TOKENS = 1 << 22

#: Words that a worker remembers; tokens it looks up at a time; words it counts before it passes them on.
REMEMBERED = 400_000
LOOKED_UP = 1 << 20
COUNTED = 400_000

#: The end token can't be a word, since it is white space.
END = b"\n"


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def save(path: str, array: np.ndarray) -> None:
    """Write an array; it appears under its name only when it is whole."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    own = f"{path}.{uuid.uuid4().hex}"
    with open(own, "wb") as file:
        np.save(file, array)
    os.replace(own, path)


def pack(numbers: np.ndarray) -> bytes:
    """Ascending numbers as differences, byte by byte, which the shuffle compresses well."""
    steps = np.diff(numbers.astype(np.uint64), prepend=np.uint64(0))
    return planes(steps)


def unpack(data: bytes) -> np.ndarray:
    return np.cumsum(unplanes(data), dtype=np.uint64)


def planes(numbers: np.ndarray) -> bytes:
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").reshape(-1)


def added(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, with the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    sums = (np.add.reduceat(v[order], starts) if len(keys) else v for v in values)
    return keys[starts], *sums


def discounts(n: np.ndarray) -> np.ndarray:
    """Discounts for counts 1, 2, 3 and over, from how many counts are 1 to 4; within (0, count)."""
    n1, n2, n3, n4 = (float(x) for x in n)
    y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0, *(min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1))])


@dataclass
class Model:
    """Where the arrays are, and the few numbers that go with them."""

    folder: str
    bits: int = 0
    offsets: np.ndarray = field(default_factory=lambda: np.zeros(2, np.int64))  # first id of each shard, and the end
    bounds: np.ndarray = field(default_factory=lambda: np.zeros(1, np.uint64))  # first key of each range
    tokens: int = 0
    texts: int = 0
    pairs: int = 0  # distinct bigrams
    d2: np.ndarray = field(default_factory=lambda: np.zeros(4))
    d1: np.ndarray = field(default_factory=lambda: np.zeros(4))
    rest: float = 1.0  # what the discounts of the lowest order leave to the uniform distribution

    @property
    def words(self) -> int:
        return int(self.offsets[-1])


class Reader:
    """A worker's view of a model; maps each array when it is first needed."""

    def __init__(self, model: Model):
        self.model, self.maps, self.ids = model, {}, {}

    def array(self, name: str) -> np.ndarray:
        if name not in self.maps:
            path = f"{self.model.folder}/{name}.npy"
            self.maps[name] = np.load(path, mmap_mode="r") if os.path.exists(path) else np.empty(0, np.uint64)
        return self.maps[name]

    def find(self, words: list[bytes]) -> np.ndarray:
        """Ids of words, -1 for those that training didn't see."""
        hashes = np.fromiter(map(word_hash, words), np.uint64, len(words))
        order = np.argsort(hashes)
        hashes, out = hashes[order], np.full(len(words), -1, np.int64)
        shards = hashes >> np.uint64(64 - self.model.bits) if self.model.bits else np.zeros(len(words), np.uint64)
        cuts = np.searchsorted(shards, np.arange((1 << self.model.bits) + 1, dtype=np.uint64))
        for shard in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            a, b, known = cuts[shard], cuts[shard + 1], self.array(f"words-{shard}")
            at = np.searchsorted(known, hashes[a:b])
            hit = at < len(known)
            hit[hit] = known[at[hit]] == hashes[a:b][hit]
            out[order[a:b][hit]] = at[hit] + self.model.offsets[shard]
        return out

    def tokens(self, text: str | None) -> Iterator[np.ndarray]:
        """Ids of a text's tokens, in blocks; the end token last."""
        for words in word_blocks((text or "").encode().lower()):
            yield self._ids(words)
        yield self._ids([END])

    def _ids(self, words: list[bytes]) -> np.ndarray:
        new = [w for w in set(words) if w not in self.ids]
        if new:
            if len(self.ids) > REMEMBERED:
                self.ids.clear()
                new = list(set(words))
            self.ids.update(zip(new, self.find(new).tolist()))
        return np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))

    def gather(self, name: str, ids: np.ndarray) -> np.ndarray:
        """Values of a per-word array at ascending ids; the id after the last is the start of a text."""
        out, cuts = np.zeros(len(ids), np.int64), np.searchsorted(ids, self.model.offsets)
        cuts[-1] = len(ids)
        for shard in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            a, b = cuts[shard], cuts[shard + 1]
            out[a:b] = self.array(f"{name}-{shard}")[ids[a:b] - self.model.offsets[shard]]
        return out

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of ascending bigram numbers, 0 for unseen ones."""
        out, cuts = np.zeros(len(keys), np.int64), np.append(np.searchsorted(keys, self.model.bounds), len(keys))
        for part in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            a, b, known = cuts[part], cuts[part + 1], self.array(f"pairs-{part}")
            if len(known):
                at = np.minimum(np.searchsorted(known, keys[a:b]), len(known) - 1)
                hit = known[at] == keys[a:b]
                out[a:b][hit] = self.array(f"times-{part}")[at[hit]]
        return out

    def score(self, ids: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per token: its count, the base model's log10 and this model's."""
        m = self.model
        seen, back = np.unique(np.concatenate((ids, context)), return_inverse=True)
        real = seen >= 0
        value = lambda name: np.concatenate((np.zeros((~real).sum(), np.int64), self.gather(name, seen[real])))
        count, before = value("counts"), value("cont")
        once, twice, more = (value(x) for x in ("once", "twice", "more"))
        here, prior = back[: len(ids)], back[len(ids) :]
        low = np.full(len(seen), m.rest / (m.words + 1))
        if m.pairs:
            low += (before - m.d1[np.minimum(before, 3)]) / m.pairs * (before > 0)
        keys, place = np.unique(context.astype(np.uint64) << np.uint64(32) | (ids & 0xFFFFFFFF).astype(np.uint64), return_inverse=True)
        pairs = self.pair_counts(keys)[place] * ((ids >= 0) & (context >= 0))
        total = count[prior]
        known = total > 0
        kept = (m.d2[1] * once + m.d2[2] * twice + m.d2[3] * more)[prior]
        total = np.maximum(total, 1)
        p = np.where(known, (pairs - m.d2[np.minimum(pairs, 3)]) / total + kept / total * low[here], low[here])
        counts = np.where(ids == m.words, 0, count[here])
        return counts, np.log10((counts + 1) / (m.tokens + m.words + 1)), np.log10(p)


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def rows() -> pd.DataFrame:
        hashes = np.fromiter(map(word_hash, counts), np.uint64, len(counts))
        return pd.DataFrame({"hash": hashes.view(np.int64), "n": np.fromiter(counts.values(), np.int64, len(counts))})

    counts: Counter[bytes] = Counter()
    for batch in batches:
        for text in batch["text"]:
            for words in word_blocks((text or "").encode().lower()):
                counts.update(words)
            counts[END] += 1
            if len(counts) > COUNTED:
                yield rows()
                counts.clear()
    if counts:
        yield rows()


def _count_pairs(batches: Iterator[pd.DataFrame], model: Model) -> Iterator[pd.DataFrame]:
    reader, held, size = Reader(model), [], 0
    start = np.array([model.words])

    def rows() -> pd.DataFrame:
        keys, times = np.unique(np.concatenate(held), return_counts=True)
        cuts = np.append(np.searchsorted(keys, model.bounds), len(keys))
        parts = np.flatnonzero(cuts[1:] > cuts[:-1]).tolist()
        spans = [slice(cuts[p], cuts[p + 1]) for p in parts]
        return pd.DataFrame({"part": parts, "keys": [pack(keys[s]) for s in spans], "times": [planes(times[s]) for s in spans]})

    for batch in batches:
        for text in batch["text"]:
            last = start
            for ids in reader.tokens(text):
                if len(ids):
                    chain = np.concatenate((last, ids)).astype(np.uint64)
                    held.append(chain[:-1] << np.uint64(32) | chain[1:])
                    size += len(ids)
                    last = ids[-1:]
            if size >= RANGE_TOKENS:
                yield rows()
                held, size = [], 0
    if held:
        yield rows()


def _merge_pairs(group: pd.DataFrame, model: Model) -> pd.DataFrame:
    """One range: write its arrays; per shard, what its contexts and words get from it."""
    part = int(group["part"].iloc[0])
    keys, times = added(np.concatenate([unpack(x) for x in group["keys"]]), np.concatenate([unplanes(x) for x in group["times"]]))
    save(f"{model.folder}/pairs-{part}.npy", keys)
    save(f"{model.folder}/times-{part}.npy", times.astype(np.uint32 if times.max() < 1 << 32 else np.uint64))
    of = np.bincount(np.minimum(times, 5).astype(np.int64), minlength=6)[1:5]
    out = [(-1, "n", planes(np.append(of, len(keys))), b"")]
    context = (keys >> np.uint64(32)).astype(np.int64)
    kinds = [("once", times == 1), ("twice", times == 2), ("more", times > 2)]
    groups = [(name, *added(context[chosen], np.ones(chosen.sum(), np.int64))) for name, chosen in kinds]
    word = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
    groups.append(("cont", *added(word, np.ones(len(word), np.int64))))
    for name, ids, sums in groups:
        cuts = np.searchsorted(ids, model.offsets)
        cuts[-1] = len(ids)
        for shard in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            a, b = cuts[shard], cuts[shard + 1]
            out.append((shard, name, pack(ids[a:b]), planes(sums[a:b])))
    return pd.DataFrame(out, columns=["shard", "name", "ids", "sums"])


def _merge_stats(group: pd.DataFrame, model: Model) -> pd.DataFrame:
    """One shard: add up and write what its words got from all ranges."""
    shard = int(group["shard"].iloc[0])
    first, end = model.offsets[shard], model.offsets[shard + 1] + (shard == len(model.offsets) - 2)
    for name in ("once", "twice", "more", "cont"):
        total = np.zeros(end - first, np.int64)
        own = group[group["name"] == name]
        for ids, sums in zip(own["ids"], own["sums"]):
            total[unpack(ids).astype(np.int64) - first] += unplanes(sums).astype(np.int64)
        save(f"{model.folder}/{name}-{shard}.npy", total.astype(np.uint32 if total.max(initial=0) < 1 << 32 else np.int64))
    of = np.bincount(np.minimum(total, 5), minlength=6)  # of the last, cont
    return pd.DataFrame([of[1:].tolist()], columns=["n1", "n2", "n3", "n4", "more"])


def _bounds(counts: DataFrame, model: Model) -> np.ndarray:
    """First keys of ranges of about RANGE_TOKENS tokens: equal spans of context ids, hot contexts apart and split."""
    ranges = max(1, -(-model.tokens // RANGE_TOKENS))
    starts = {int(i) << 32 for i in np.linspace(0, model.words, ranges, endpoint=False)}
    reader = Reader(model)
    hot = [(r["hash"] % (1 << 64), r["n"]) for r in counts.where(F.col("n") > RANGE_TOKENS).select("hash", "n").collect()]
    ids = [(model.words, model.texts)] if model.texts > RANGE_TOKENS else []
    for value, n in hot:  # at most one per range
        shard = value >> (64 - model.bits) if model.bits else 0
        at = np.searchsorted(reader.array(f"words-{shard}"), np.uint64(value))
        ids.append((int(at + model.offsets[shard]), n))
    for context, n in ids:
        pieces = -(-n // RANGE_TOKENS)
        starts |= {context << 32 | int(w) for w in np.linspace(0, model.words, pieces, endpoint=False)}
        starts.add((context + 1) << 32)
    return np.array(sorted(starts), np.uint64)


def train(texts: DataFrame) -> Model:
    """Fit a model to column ``text`` of a frame; NULL texts are empty, an empty frame gives a uniform model."""
    spark = texts.sparkSession
    texts = texts.select("text")
    model = Model(local_path(shared_path(spark, "kneser-ney")))
    counts = staged(
        texts.mapInPandas(_count_words, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")), "words"
    )
    words, model.tokens = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if words >= (1 << 32) - 2:
        raise ValueError("a bigram's number has 32 bits for each word; there are more words")
    if not words:
        return model
    model.texts = counts.where(F.col("hash") == int(np.uint64(word_hash(END)).astype(np.int64))).first()["n"]
    model.bits = max(0, (words - 1).bit_length() - (SHARD_WORDS.bit_length() - 1))
    shard = F.shiftrightunsigned("hash", 64 - model.bits) if model.bits else F.lit(0).cast("long")
    folder, starts = model.folder, model.texts
    last = (1 << model.bits) - 1

    def write_words(group: pd.DataFrame) -> pd.DataFrame:
        number = int(group["shard"].iloc[0])
        hashes, n = added(group["hash"].to_numpy(np.int64).view(np.uint64), group["n"].to_numpy(np.int64))
        save(f"{folder}/words-{number}.npy", hashes)
        save(f"{folder}/counts-{number}.npy", np.append(n, starts) if number == last else n)  # after the last: the start
        return pd.DataFrame({"shard": [number], "size": [len(hashes)]})

    sizes = counts.withColumn("shard", shard).groupBy("shard").applyInPandas(write_words, "shard long, size long").collect()
    size = np.zeros(1 << model.bits, np.int64)
    for row in sizes:
        size[row["shard"]] = row["size"]
    model.offsets = np.concatenate(([0], np.cumsum(size)))
    model.bounds = _bounds(counts, model)

    blocks = texts.mapInPandas(lambda x: _count_pairs(x, model), "part long, keys binary, times binary")
    stats = blocks.groupBy("part").applyInPandas(
        lambda g: _merge_pairs(g, model), "shard long, name string, ids binary, sums binary"
    )
    stats = staged(stats, "pair-stats")
    of = sum((unplanes(r["ids"]).astype(np.int64) for r in stats.where("shard < 0").select("ids").toLocalIterator()), np.zeros(5, np.int64))
    model.d2, model.pairs = discounts(of[:4]), int(of[4])
    merged = stats.where("shard >= 0").groupBy("shard").applyInPandas(
        lambda g: _merge_stats(g, model), "n1 long, n2 long, n3 long, n4 long, more long"
    )
    sums = merged.agg(*(F.sum(c) for c in ("n1", "n2", "n3", "n4", "more"))).first()
    model.d1 = discounts(np.array(sums[:4]))
    model.rest = float((model.d1[1] * sums[0] + model.d1[2] * sums[1] + model.d1[3] * sum(sums[2:])) / model.pairs)
    return model


def scored(text: Column, model: Model, spark) -> Column:
    """Per text: n_tokens, n_known, base_score, score."""
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        reader = Reader(shared.value)
        start = np.array([reader.model.words])
        for texts in batches:
            out = np.zeros((len(texts), 4))
            held: list[tuple[int, np.ndarray, np.ndarray]] = []
            size = 0

            def flush() -> None:
                if not held:
                    return
                counts, base, own = reader.score(np.concatenate([x[1] for x in held]), np.concatenate([x[2] for x in held]))
                starts = np.cumsum([0, *(len(x[1]) for x in held[:-1])])
                sums = [np.add.reduceat(v, starts) for v in (np.ones(len(counts)), counts > 0, base, own)]
                np.add.at(out, [x[0] for x in held], np.stack([s.astype(float) for s in sums], axis=1))
                held.clear()

            for i, text in enumerate(texts):
                last = start
                for ids in reader.tokens(text):
                    if len(ids):
                        held.append((i, ids, np.concatenate((last, ids[:-1]))))
                        size, last = size + len(ids), ids[-1:]
                    if size >= LOOKED_UP:
                        flush()
                        size = 0
            flush()
            yield pd.DataFrame(out, columns=["n_tokens", "n_known", "base_score", "score"]).astype({"n_tokens": "int64", "n_known": "int64"})

    return F.pandas_udf(run, "n_tokens long, n_known long, base_score double, score double").asNondeterministic()(text)


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Train on the rows whose id's remainder isn't 2, score all rows with base and model.

    NULL and empty texts have one token, the end.  Repeated rows count and are scored each; rows with a NULL
    id are trained on; other columns are not read; an empty table gives no rows.
    """
    own = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), (remainder(F.col(key), 7) == 2).alias("held_out"))
    model = train(own.where(~F.col("held_out")))
    result = own.select("doc_id", "held_out", scored(F.col("text"), model, docs.sparkSession).alias("of"))
    columns = ["n_tokens", "n_known", "base_score", "score"]
    result = result.select("doc_id", "held_out", *(F.col(f"of.{c}").alias(c) for c in columns))
    perplexity = F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))
    return result.withColumn("train_tokens", F.lit(model.tokens).cast("long")).withColumn("perplexity", perplexity)
