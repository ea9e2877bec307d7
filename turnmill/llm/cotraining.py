"""Quality classifier by co-training two views of a document.

The content view sees the words and marks of the text, the metadata view its source, language, length and
page layout.  Each view learns from a sample of labelled rows and, round by round, from all other rows of which
the other view is confident.  Both are calibrated on labelled rows that neither has learned
from, and the calibrated log odds are combined by a logistic layer fitted there as well.

The texts are read once: both views of every row are written to the shared folder.  In a round each row is scored with the
weights that the round began with; the rows that one view is sure of are examples for the other.  Their gradients are summed
per task, then by slices of the weights, so the driver sees vectors of the weights' size only.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnmill.llm.common import remainder, staged

TOKEN = re.compile(r"\w+|[^\w\s]+")

#: Tokens whose place a worker remembers.
REMEMBERED = 300_000


@dataclass(frozen=True)
class Settings:
    """``sample``: labelled rows per class for training, at most, of texts of at most ``sample_chars`` characters.
    ``confident``: the share that makes a row an example for the other view; ``rounds``, and ``passes`` over all rows
    in each.  ``trust``: the weight of those examples together against the labelled ones."""

    sample: int = 2500
    sample_chars: int = 30_000
    buckets: int = 1 << 15
    bins: int = 10
    rounds: int = 3
    passes: int = 4
    confident: float = 0.9
    trust: float = 0.5
    checked: int = 4  # one in so many labelled rows calibrates
    steps: int = 150
    rate: float = 0.1
    decay: float = 1e-4
    threshold: float = 0.1

    @property
    def sizes(self) -> tuple[int, int]:
        """Places of the content view and of the metadata view."""
        return self.buckets, 2 * self.buckets + len(LAYOUT) * self.bins


LAYOUT = ("chars", "lines", "line_chars", "distinct_lines", "capitals", "digits", "marks")


def layout(text: Column, n_chars: Column) -> Column:
    """Numbers about the page, not its words: array of double, in the order of LAYOUT."""
    own = F.coalesce(text, F.lit(""))
    lines = F.split(own, "\n", -1)
    length = F.greatest(F.length(own), F.lit(1)).cast("double")
    share = lambda pattern: (F.regexp_count(own, F.lit(pattern)) / length).cast("double")
    return F.array(
        F.log1p(F.coalesce(n_chars, F.length(own)).cast("double")),
        F.log1p(F.size(lines).cast("double")),
        F.log1p(length / F.size(lines)),
        F.size(F.array_distinct(lines)) / F.size(lines).cast("double"),
        share(r"\p{Lu}"),
        share("[0-9]"),
        share(r"[^\p{L}\p{N}\s]"),
    )


@dataclass
class Sparse:
    """Rows of (place, value) pairs."""

    places: np.ndarray
    values: np.ndarray
    starts: np.ndarray  # one more than rows

    def times(self, weights: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0.0], np.cumsum(weights[self.places] * self.values)))
        return total[self.starts[1:]] - total[self.starts[:-1]]

    def back(self, errors: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.places, np.repeat(errors, np.diff(self.starts)) * self.values, size)

    def take(self, rows: np.ndarray) -> Sparse:
        spans = [(self.starts[r], self.starts[r + 1]) for r in rows]
        chosen = np.concatenate([np.arange(a, b) for a, b in spans]) if spans else np.empty(0, np.int64)
        return Sparse(self.places[chosen], self.values[chosen], np.cumsum([0, *(b - a for a, b in spans)]))


def stacked(rows: list[tuple[np.ndarray, np.ndarray]]) -> Sparse:
    places = np.concatenate([r[0] for r in rows]) if rows else np.empty(0, np.int64)
    values = np.concatenate([r[1] for r in rows]) if rows else np.empty(0)
    return Sparse(places, values, np.cumsum([0, *(len(r[0]) for r in rows)]))


class _Places(dict):
    """Place of each token among the buckets, remembered for a while."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, token: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        place = xxhash.xxh64_intdigest(token.encode()) % (self.buckets - 1) + 1
        if len(token) < 64:
            self[token] = place
        return place


def content(text: str | None, places: _Places) -> tuple[np.ndarray, np.ndarray]:
    """Content view: hashed words and marks by the logarithm of their number, to unit length; place 0 is the share
    of tokens that repeat the one before."""
    tokens = TOKEN.findall(text) if text else []
    if not tokens:
        return np.zeros(1, np.int64), np.zeros(1)
    found = Counter(map(places.__getitem__, tokens))
    values = np.log1p(np.fromiter(found.values(), np.float64, len(found)))
    again = sum(map(str.__eq__, tokens, tokens[1:])) / len(tokens)
    return np.append(np.fromiter(found, np.int64, len(found)), 0), np.append(values / np.linalg.norm(values), again)


def metadata(source: str | None, lang: str | None, numbers: np.ndarray, edges: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Metadata view: source and language by hash, and the bin of each number."""
    names = [xxhash.xxh64_intdigest((x or "").encode()) % buckets + i * buckets for i, x in enumerate((source, lang))]
    bins = [2 * buckets + i * (edges.shape[1] + 1) + int(np.searchsorted(e, x)) for i, (e, x) in enumerate(zip(edges, numbers))]
    return np.array(names + bins), np.ones(len(names) + len(bins))


def regression(x: Sparse, y: np.ndarray, weight: np.ndarray, size: int, settings: Settings) -> np.ndarray:
    """Logistic regression by Adam over all rows; the last weight is the constant."""
    w, adam = np.zeros(size + 1), Adam(size + 1, settings.rate)
    weight = weight / weight.sum()
    for _ in range(settings.steps):
        error = (1 / (1 + np.exp(-np.clip(x.times(w[:-1]) + w[-1], -50, 50))) - y) * weight
        g = np.append(x.back(error, size) + settings.decay * w[:-1] / max(len(y), 1), error.sum())
        w = adam.step(w, g)
    return w


def _dense(columns: list[np.ndarray]) -> Sparse:
    n, k = len(columns[0]), len(columns)
    return Sparse(np.tile(np.arange(k), n), np.stack(columns, axis=1).ravel(), np.arange(0, n * k + 1, k))


@dataclass
class Model:
    edges: np.ndarray
    weights: list[np.ndarray]  # content, metadata; constant last
    calibration: list[np.ndarray]  # slope and constant of each view
    mix: np.ndarray  # weight of each view's calibrated log odds, and a constant

    def combine(self, views: list[Sparse]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shares by content, by metadata, and by both."""
        odds = [c[0] * (x.times(w[:-1]) + w[-1]) + c[1] for x, w, c in zip(views, self.weights, self.calibration)]
        both = self.mix[0] * odds[0] + self.mix[1] * odds[1] + self.mix[2]
        return tuple(1 / (1 + np.exp(-np.clip(z, -50, 50))) for z in (*odds, both))


def examples(views: list[Sparse], teachers: list[np.ndarray], students: list[np.ndarray], settings: Settings) -> list[list[tuple[int, np.ndarray]]]:
    """Per view and label (0, 1): the number of rows that the other view's teacher is sure of, and their gradient."""
    limit = np.log(settings.confident / (1 - settings.confident))
    odds = [x.times(w[:-1]) + w[-1] for x, w in zip(views, teachers)]
    out = []
    for i in (0, 1):
        z = views[i].times(students[i][:-1]) + students[i][-1]
        share = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        own = []
        for label in (0, 1):
            error = np.where((2 * label - 1) * odds[1 - i] >= limit, share - label, 0.0)
            sure = int(((2 * label - 1) * odds[1 - i] >= limit).sum())
            own.append((sure, np.append(views[i].back(error, settings.sizes[i]), error.sum())))
        out.append(own)
    return out


class Adam:
    """Steps along a gradient, each coordinate at its own pace."""

    def __init__(self, size: int, rate: float):
        self.rate, self.t, self.m, self.v = rate, 0, np.zeros(size), np.zeros(size)

    def step(self, w: np.ndarray, g: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m += 0.1 * (g - self.m)
        self.v += 0.01 * (g * g - self.v)
        return w - self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.99**self.t)) + 1e-9)


def balanced(y: np.ndarray) -> np.ndarray:
    """Weights that sum to a half per class."""
    return np.where(y == 1, 0.5 / max((y == 1).sum(), 1), 0.5 / max((y == 0).sum(), 1))


def cotrain(views: list[Sparse], y: np.ndarray, others, model: Model, settings: Settings) -> None:
    """``views``: labelled rows by view, ``y``: 0 or 1; ``others``: ``examples`` of all other rows, summed, for given weights."""
    held = np.arange(len(y)) % settings.checked == 0
    base = np.flatnonzero(~held)
    own = [v.take(base) for v in views]
    even = balanced(y[base])
    for i in (0, 1):
        model.weights[i] = regression(own[i], y[base], even, settings.sizes[i], settings)
    for _ in range(settings.rounds):
        teachers, steps = [w.copy() for w in model.weights], [Adam(s + 1, settings.rate) for s in settings.sizes]
        for _ in range(settings.passes):
            found = others(teachers, model.weights)
            for i in (0, 1):
                w = model.weights[i]
                error = (1 / (1 + np.exp(-np.clip(own[i].times(w[:-1]) + w[-1], -50, 50))) - y[base]) * even
                g = np.append(own[i].back(error, settings.sizes[i]) + settings.decay * w[:-1] / max(len(base), 1), error.sum())
                g = g + settings.trust * sum(0.5 / n * total for n, total in found[i] if n)
                model.weights[i] = steps[i].step(w, g)
    checked = np.flatnonzero(held)
    even = np.ones(len(checked))
    mild = Settings(steps=300, rate=0.05, decay=1e-2)
    odds = []
    for i in (0, 1):
        z = views[i].take(checked).times(model.weights[i][:-1]) + model.weights[i][-1]
        fitted = regression(_dense([z]), y[checked], even, 1, mild)
        model.calibration[i] = np.array([max(fitted[0], 1e-3), fitted[1]])
        odds.append(model.calibration[i][0] * z + model.calibration[i][1])
    model.mix = regression(_dense(odds), y[checked], even, 2, mild)


def _own(docs: DataFrame, key: str, text: str, source: str, lang: str, n_chars: str) -> DataFrame:
    own = docs.select(*(F.col(c).alias(a) for c, a in zip((key, text, source, lang, n_chars), ("doc_id", "text", "source", "lang", "n_chars"))))
    return own.select("doc_id", "text", "source", "lang", layout(F.col("text"), F.col("n_chars")).alias("numbers"))


def label_sample(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """doc_id and quality of the labelled rows to learn from: joined and checked for length first, then the first ones by a
    hash of each class.  An id with several labels is bad if one is; it is taken if all its texts are short enough."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sizes = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.length("text")).alias("most"))
    usable = known.join(sizes.where(F.coalesce("most", F.lit(0)) <= settings.sample_chars), "doc_id").select("doc_id", "quality")
    order = F.xxhash64("doc_id"), F.col("doc_id")
    chosen = [usable.where(F.col("quality") == c).orderBy(*order).limit(settings.sample) for c in (1, 0)]
    return staged(chosen[0].union(chosen[1]), "quality-sample")


def with_views(own: DataFrame, edges: np.ndarray, settings: Settings) -> DataFrame:
    """The rows of ``own`` without their texts, each with the (place, value) pairs of both views as bytes."""
    shared = own.sparkSession.sparkContext.broadcast(edges)
    schema = "content_places binary, content_values binary, metadata_places binary"

    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        places = _Places(settings.buckets)
        for texts, sources, langs, numbers in batches:
            rows = []
            for text, *more in zip(texts, sources, langs, numbers):
                at, value = content(text, places)
                rows.append((at.astype("<u4").tobytes(), value.astype("<f2").tobytes(), metadata(*more, shared.value, settings.buckets)[0].astype("<u4").tobytes()))
            yield pd.DataFrame(rows, columns=["content_places", "content_values", "metadata_places"])

    views = F.pandas_udf(run, schema).asNondeterministic()("text", "source", "lang", "numbers")
    return own.select(*(c for c in own.columns if c not in ("text", "source", "lang", "numbers")), views.alias("v")).select("*", "v.*").drop("v")


def unpacked(content_places, content_values, metadata_places) -> list[Sparse]:
    """Both views of the rows of a batch."""
    joined = lambda column, kind: np.frombuffer(b"".join(column), kind)
    starts = lambda column, width: np.cumsum([0, *(len(x) // width for x in column)])
    meta = joined(metadata_places, "<u4").astype(np.int64)
    return [
        Sparse(joined(content_places, "<u4").astype(np.int64), joined(content_values, "<f2").astype(np.float64), starts(content_places, 4)),
        Sparse(meta, np.ones(len(meta)), starts(metadata_places, 4)),
    ]


#: Weights per slice in which gradients are summed.
SLICE = 1 << 13


def summed_examples(views: DataFrame, teachers: list[np.ndarray], students: list[np.ndarray], settings: Settings) -> list[list[tuple[int, np.ndarray]]]:
    """``examples`` of all rows: summed per task first, then per slice of the weights."""
    spark = views.sparkSession
    shared = spark.sparkContext.broadcast((teachers, students))
    schema = "view int, label int, slice int, sure long, total binary"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            found = examples(unpacked(batch["content_places"], batch["content_values"], batch["metadata_places"]), *shared.value, settings)
            total = found if total is None else [[(n + m, a + b) for (n, a), (m, b) in zip(x, y)] for x, y in zip(total, found)]
        rows = []
        for view, own in enumerate(total or []):
            for label, (sure, gradient) in enumerate(own):
                for k in range(0, len(gradient), SLICE):
                    part = gradient[k : k + SLICE]
                    if part.any() or not k:
                        rows.append((view, label, k // SLICE, sure, part.tobytes()))
        yield pd.DataFrame(rows, columns=["view", "label", "slice", "sure", "total"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(x) for x in group["total"]], axis=0)
        return pd.DataFrame([(*group[["view", "label", "slice"]].iloc[0], group["sure"].sum(), total.tobytes())], columns=list(group.columns))

    out = [[[0, np.zeros(s + 1)], [0, np.zeros(s + 1)]] for s in settings.sizes]
    for view, label, part, sure, total in views.mapInPandas(run, schema).groupBy("view", "label", "slice").applyInPandas(add, schema).collect():
        own, numbers = out[view][label], np.frombuffer(total)
        own[1][part * SLICE : part * SLICE + len(numbers)] = numbers
        own[0] = max(own[0], sure)  # the first slice has it from every task
    return [[tuple(x) for x in own] for own in out]


def fitted(views: DataFrame, edges: np.ndarray, settings: Settings) -> Model:
    """Fit to the labelled rows of ``views`` (``quality`` is not NULL there), and exchange over all others.

    Without examples of both classes all scores are the share of good ones, or a half without labels.
    """
    rows = views.where("quality IS NOT NULL").withColumn("doc_id", F.col("doc_id").cast("string"))
    rows = rows.dropDuplicates(["doc_id"]).toPandas().sort_values("doc_id")  # bounded by ``sample``
    y = rows["quality"].to_numpy(np.float64)
    model = Model(edges, [np.zeros(s + 1) for s in settings.sizes], [np.array([1.0, 0.0])] * 2, np.array([0.5, 0.5, 0.0]))
    if not len(y) or y.min() == y.max():
        if len(y):
            model.mix[2] = 50.0 if y[0] else -50.0
        return model
    free = views.where("quality IS NULL")
    both = unpacked(rows["content_places"], rows["content_values"], rows["metadata_places"])
    cotrain(both, y, lambda teachers, students: summed_examples(free, teachers, students, settings), model, settings)
    return model


def scored(views: DataFrame, model: Model) -> Column:
    """Struct of content_score, metadata_score and score for rows of ``with_views``."""
    shared = views.sparkSession.sparkContext.broadcast(model)
    columns = ["content_score", "metadata_score", "score"]

    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(np.stack(shared.value.combine(unpacked(*batch)), axis=1), columns=columns)

    schema = ", ".join(f"{c} double" for c in columns)
    return F.pandas_udf(run, schema).asNondeterministic()("content_places", "content_values", "metadata_places")


def classify(
    docs: DataFrame, labels: DataFrame, settings: Settings = Settings(),
    key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", n_chars: str = "n_chars",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, content_score, metadata_score, score, kept.

    Rows whose id's remainder is 1 are held out: no label of theirs is used.  All rows outside the label sample, of any
    length, take part in the exchange as unlabelled ones.  A score is the share of good
    documents; NULL texts, sources, languages and lengths count as empty or as the text's own length; a NULL id
    isn't held out and has no label; repeated rows are scored each; an empty table gives no rows.
    """
    own = _own(docs, key, text, source, lang, n_chars)
    held = remainder(F.col("doc_id"), 3) == 1
    sample = label_sample(own.where(~held), labels.where(~held), settings)
    few = F.broadcast(sample)  # at most twice ``sample`` pairs of numbers
    numbers = [r["numbers"] for r in own.join(few, "doc_id", "left_semi").select("numbers").limit(4 * settings.sample).collect()]
    cuts = np.linspace(0, 1, settings.bins + 1)[1:-1]
    edges = np.quantile(np.array(sorted(numbers), float), cuts, axis=0).T if numbers else np.zeros((len(LAYOUT), len(cuts)))
    views = staged(with_views(own.join(few, "doc_id", "left"), edges, settings), "quality-views")
    model = fitted(views, edges, settings)
    result = views.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), scored(views, model).alias("of"))
    scores = [F.col(f"of.{c}").alias(c) for c in ("content_score", "metadata_score", "score")]
    return result.select("doc_id", "held_out", *scores, (F.col("of.score") >= settings.threshold).alias("kept"))
