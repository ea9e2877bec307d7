"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into passages.  A distributed randomised SVD of the TF-IDF matrix of all passages
gives a latent space; spans of a document whose cosine with a benchmark passage of about their length is high
are candidates.  A candidate counts if the words of the item come back in order (longest common subsequence),
either nearly all of them, or the greater part of them together with the answer: a paraphrase.

Only words of the benchmark can match, so a document becomes an array of word numbers, 0 for all other words.
These arrays are written once to the shared folder; the passes over them are array work.  A benchmark is
searched in blocks of BLOCK_ITEMS items, so that what is broadcast has a bound at any benchmark size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnmill.llm.common import staged

WORD = re.compile(r"\w+")

#: Items searched at a time.
BLOCK_ITEMS = 2000

#: Words per passage at most, and per window of the SVD.
WINDOW = 48

#: Words per grain.  Spans are made of whole grains: so many of them, each built from two shorter spans.
GRAIN = 4
SPANS = {1: (), 2: (1, 1), 3: (2, 1), 4: (2, 2), 6: (3, 3), 8: (4, 4), 12: (6, 6)}

#: Leaking rows whose numbers are broadcast; more are joined by a shuffle.
SMALL = 500_000

#: Stretches of text whose words' numbers a worker remembers.
REMEMBERED = 200_000

#: Words of texts that are handled at a time in array passes: their sums stay in a processor's cache.
CHUNK = 1 << 15

#: Words whose part of a matrix product is dense; that of the others is summed row by row.
FREQUENT = 256

#: Candidates whose words are counted at a time.
COUNTED = 4096

#: Rows of a slice in which the parts of a matrix are added up, and parts that one task adds.
SLICE = 128
ADDED = 64


@dataclass(frozen=True)
class Rules:
    """``rank``, ``oversample``: of the SVD.  ``cosine``: for candidates.  ``copy``: share of the item's words
    that must come back in order; ``paraphrase``: the same if ``answer`` of the answer's words do too.
    ``answer_words``: the answer is the end of an item without one of its own."""

    rank: int = 128
    oversample: int = 12
    cosine: float = 0.4
    copy: float = 0.6
    paraphrase: float = 0.5
    answer: float = 0.75
    answer_words: int = 8


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


@dataclass
class Block:
    """Some benchmark items as arrays of word numbers, and the passages they are searched by."""

    ids: list[int]
    items: list[np.ndarray]
    answers: list[np.ndarray]
    words: dict[str, int]
    passages: list[tuple[int, np.ndarray, int]] = field(default_factory=list)  # item's place, words, first word's place
    weight: np.ndarray | None = None  # inverse document frequency by word number; 0 for 0
    space: np.ndarray | None = None  # latent coordinates by word number
    queries: np.ndarray | None = None  # unit vectors of the passages


def build_block(rows: list[tuple[int, str | None, str | None]], rules: Rules) -> Block:
    """Number the words and cut the items; items without words can't be found and are left out."""
    block = Block([], [], [], {})
    for item_id, text, answer in rows:
        own = words_of(text)
        if not own:
            continue
        numbers = np.array([block.words.setdefault(w, len(block.words) + 1) for w in own])
        ending = [block.words.setdefault(w, len(block.words) + 1) for w in words_of(answer)]
        place = len(block.ids)
        block.ids.append(item_id)
        block.items.append(numbers)
        block.answers.append(np.array(ending) if ending else numbers[-min(rules.answer_words, -(-len(own) // 2)) :])
        count = -(-len(own) // WINDOW)
        cuts = np.linspace(0, len(own), count + 1).astype(int)
        block.passages += [(place, numbers[a:b], int(a)) for a, b in zip(cuts[:-1], cuts[1:])]
    return block


class _Numbered(dict):
    """Numbers of the words in what stands between white space, as bytes, remembered for a while."""

    def __init__(self, words: dict[str, int], kind: str):
        super().__init__()
        size = np.dtype(kind).itemsize
        self.words = {w: i.to_bytes(size, "little") for w, i in words.items()}
        self.other = bytes(size)

    def __missing__(self, stretch: str) -> bytes:
        if stretch.isalnum():  # one word
            numbers = self.words.get(stretch, self.other)
        else:
            numbers = b"".join([self.words.get(w, self.other) for w in WORD.findall(stretch)])
        if len(self) > REMEMBERED:
            self.clear()
        if len(stretch) < 64:
            self[stretch] = numbers
        return numbers


def encoded(text: Column, block: Block, spark) -> Column:
    """Word numbers of each text, as little-endian integers of two or four bytes."""
    shared = spark.sparkContext.broadcast(block.words)
    kind = kind_of(block)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        # No word has white space in it, so a text may be split there first.
        known = _Numbered(shared.value, kind).__getitem__
        for texts in batches:
            yield pd.Series([b"".join(map(known, x.lower().split())) if x else b"" for x in texts], dtype=object)

    return F.pandas_udf(run, "binary").asNondeterministic()(text)


def kind_of(block: Block) -> str:
    return "<u2" if len(block.words) < (1 << 16) - 1 else "<u4"


def _chunks(batches: Iterator[pd.DataFrame], kind: str, pad: int, gap: int = 0) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Groups of documents: their rows, one array of word numbers, and the place where each begins.

    Each document is padded by ``gap`` words, then to a multiple of ``pad`` words.
    """
    rows, parts, starts, size = [], [], [], 0
    for batch in batches:
        for row, data in zip(batch["row"], batch["words"]):
            numbers = np.frombuffer(data, kind)
            rows.append(row)
            parts.append(numbers)
            starts.append(size)
            size += len(numbers)
            if rest := gap + -(len(numbers) + gap) % pad:
                parts.append(np.zeros(rest, kind))
                size += rest
            if size >= CHUNK:
                yield rows, np.concatenate(parts), np.array(starts + [size])
                rows, parts, starts, size = [], [], [], 0
    if size:
        yield rows, np.concatenate(parts), np.array(starts + [size])


def _frequencies(words: DataFrame, block: Block) -> tuple[np.ndarray, int]:
    """In how many passages each word occurs, over documents and benchmark; number of passages."""
    kind, n = kind_of(block), len(block.words) + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(n, np.int64)
        for _, numbers, _ in _chunks(batches, kind, WINDOW):
            at = np.flatnonzero(numbers)
            keys = np.unique((at // WINDOW) * n + numbers[at])
            total += np.bincount(keys % n, minlength=n)
            total[0] += len(numbers) // WINDOW
        found = np.flatnonzero(total)
        yield pd.DataFrame({"word": found, "n": total[found]})

    counts = words.mapInPandas(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toPandas()  # a row per word of the block
    total = np.zeros(n, np.int64)
    total[counts["word"].to_numpy()] = counts["n"].to_numpy()
    for _, numbers, _ in block.passages:
        total[np.unique(numbers)] += 1
    return total, int(total[0]) + len(block.passages)


def _product(numbers: np.ndarray, basis: np.ndarray, frequent: np.ndarray, place: np.ndarray, out: np.ndarray) -> None:
    """Add A'(A basis) to ``out``, A the TF matrix of the passages in ``numbers``.

    Words whose row of ``basis`` is zero count as absent.  ``place``: of each word among the ``frequent`` ones, -1 for the other
    words, -2 for absent ones.
    """
    words = numbers.reshape(-1, WINDOW)
    image = basis[words[:, 0]]
    for i in range(1, WINDOW):
        image += basis[words[:, i]]
    of = place[numbers]
    at = np.flatnonzero(of >= 0)
    size = len(frequent)
    tf = np.bincount(at // WINDOW * size + of[at], minlength=len(words) * size).reshape(len(words), size)
    out[frequent] += tf.T.astype(np.float32) @ image
    at = np.flatnonzero(of == -1)
    word = numbers[at]
    order = np.argsort(word, kind="stable")
    word, rows = word[order], image[at[order] // WINDOW]
    if len(word):
        starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        out[word[starts]] += np.add.reduceat(rows, starts, axis=0)


def _summed(parts: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """Sum of the matrices that tasks have put out as (task, first row of the slice, rows).

    Added up slice by slice, of at most ADDED tasks first, then of as many of these sums, and so on.
    """

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(x, np.float32) for x in group["rows"]], axis=0, dtype=np.float64)
        return pd.DataFrame({"task": [group["task"].iloc[0]], "first": [group["first"].iloc[0]], "rows": [total.astype(np.float32).tobytes()]})

    schema = "task long, first long, rows binary"
    for _ in range(3):
        parts = parts.withColumn("task", F.floor(F.col("task") / ADDED).cast("long")).groupBy("task", "first").applyInPandas(add, schema)
    out = np.zeros(shape)
    for row in parts.collect():  # the words of the block times the columns
        part = np.frombuffer(row["rows"], np.float32).reshape(-1, shape[1])
        out[row["first"] : row["first"] + len(part)] += part
    return out


def _latent_space(words: DataFrame, block: Block, rules: Rules) -> None:
    """Randomised SVD in one pass: Y = A'A W for a random W, summed over all tasks, then Nystrom's formula.

    Document frequencies are those of all passages, and A holds all of them.  The benchmark's passages weigh as much as the documents' together, so that the space holds them too.
    """
    spark, kind, n = words.sparkSession, kind_of(block), len(block.words) + 1
    counts, passages = _frequencies(words, block)
    weight = np.log((1 + passages) / (1 + counts)).astype(np.float32)
    weight[0] = 0
    rank = min(rules.rank, n - 1)
    random = np.random.default_rng(7).standard_normal((n, min(rank + rules.oversample, n))).astype(np.float32)
    shared = spark.sparkContext.broadcast(random * weight[:, None])
    columns = random.shape[1]
    place = np.where(shared.value.any(axis=1), -1, -2)
    frequent = np.argsort(np.where(place == -1, -counts, 1), kind="stable")[: min(FREQUENT, int((place == -1).sum()))]
    place[frequent] = np.arange(len(frequent))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        basis = shared.value
        out = np.zeros(basis.shape, np.float64)
        task = 0
        for batch in batches:
            task = int(batch["task"].iloc[0]) if len(batch) else task
            for _, numbers, _ in _chunks(iter([batch]), kind, WINDOW):
                _product(numbers, basis, frequent, place, out)
        firsts = [a for a in range(0, n, SLICE) if out[a : a + SLICE].any()]
        yield pd.DataFrame({"task": [task] * len(firsts), "first": firsts, "rows": [out[a : a + SLICE].astype(np.float32).tobytes() for a in firsts]})

    numbered = words.withColumn("task", F.spark_partition_id())
    image = _summed(numbered.mapInPandas(run, "task long, first long, rows binary"), (n, columns))
    own = np.zeros_like(image)
    for _, numbers, _ in block.passages:
        tf = np.bincount(numbers, minlength=n).astype(np.float32)
        used = np.flatnonzero(tf)
        own[used] += np.outer(tf[used], tf[used] @ shared.value[used])
    energy = lambda y: float((random * weight[:, None] * y).sum())  # noqa: E731  estimates the sum of squares of A
    scale = energy(image) / max(energy(own), 1e-9)
    image = (image + max(scale, 1.0) * own) * weight[:, None]
    core = random.T @ image
    value, vector = np.linalg.eigh((core + core.T) / 2)
    keep = value > value.max() * 1e-9
    left, single, _ = np.linalg.svd(image @ (vector[:, keep] / np.sqrt(value[keep])), full_matrices=False)
    block.weight = weight
    block.space = (left[:, :rank] * weight[:, None]).astype(np.float32)
    vectors = np.stack([block.space[numbers].sum(axis=0) for _, numbers, _ in block.passages])
    block.queries = vectors / np.maximum(np.linalg.norm(vectors, axis=1), 1e-9)[:, None]


def places_of(words: np.ndarray) -> dict[int, int]:
    """Bits of one number stand for the places of each word."""
    places: dict[int, int] = {}
    for i, x in enumerate(words.tolist()):
        places[x] = places.get(x, 0) | 1 << i
    return places


def _subsequence(places: dict[int, int], size: int, b: list[int]) -> int:
    full = state = (1 << size) - 1
    for x in b:
        match = places.get(x, 0)
        if match:
            kept = state & match
            state = ((state + kept) | (state - kept)) & full
    return size - state.bit_count()


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence."""
    return _subsequence(places_of(a), len(a), b.tolist())


def membership(words: np.ndarray, n: int) -> np.ndarray:
    """One bit for each of n word numbers: whether it is among ``words``."""
    bits = np.zeros(n // 8 + 1, np.uint8)
    np.bitwise_or.at(bits, words >> 3, (1 << (words & 7)).astype(np.uint8))
    return bits


def spaced(group: np.ndarray, place: np.ndarray, least: int) -> list[int]:
    """Of ascending places per ascending group: the first of each group, and always the next that is ``least`` behind the last."""
    if not len(place):
        return []
    key = np.cumsum(np.concatenate(([0], group[1:] != group[:-1]))) * (int(place.max()) - int(place.min()) + least + 1) + (place - place.min())
    follower = np.searchsorted(key, key + least).tolist()
    kept, at = [], 0
    while at < len(follower):
        kept.append(at)
        at = follower[at]
    return kept


def most_words(numbers: np.ndarray, low: np.ndarray, high: np.ndarray, length: np.ndarray, members: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The most words of an item that a span of ``length`` has, between two places each: low < high."""
    count = high - low
    ends = np.cumsum(count)
    begins = ends - count
    near = numbers[np.repeat(low - begins, count) + np.arange(ends[-1])]
    own = members[np.repeat(place, count), near >> 3] >> (near & 7).astype(np.uint8) & 1
    total = np.concatenate(([0], np.cumsum(own, dtype=np.int32)))
    last = np.arange(1, ends[-1] + 1)
    return np.maximum.reduceat(total[1:] - total[np.maximum(last - np.repeat(length, count), np.repeat(begins, count))], begins)


def _verdict(numbers: np.ndarray, low: int, high: int, place: int, known: dict[int, int], block: Block, rules: Rules) -> tuple[float, float] | None:
    """Shares of an item's and its answer's words between two places, if they suffice.

    Slides a span a quarter longer than the item over them.  ``known``: the places of the item's words.
    """
    item, answer = block.items[place], block.answers[place]
    size, length = len(item), len(item) + max(2, len(item) // 4)
    least = rules.paraphrase * size
    words = numbers[low:high].tolist()
    if _subsequence(known, size, words) < least:
        return None
    step, best = max(1, size // 8), (0.0, 0.0)
    for a in range(0, max(1, high - low - length + step), step):
        share = _subsequence(known, size, words[a : a + length]) / size
        if share >= rules.paraphrase and share > best[0]:
            best = (share, common_subsequence(answer, numbers[low + a : low + a + length]) / len(answer))
    good = best[0] >= rules.copy or (best[0] >= rules.paraphrase and best[1] >= rules.answer)
    return best if good else None


def span_of(words: int) -> int:
    """Grains of the spans that are compared with a passage of so many words: one of SPANS, the nearest that
    holds all of a short passage wherever it begins."""
    fitting = [k for k in SPANS if k > 1]
    if words <= 2 * GRAIN:
        return next(k for k in fitting if k * GRAIN >= words + GRAIN - 1)
    return min(fitting, key=lambda k: abs(np.log(k * GRAIN / words)))


def _grains(numbers: np.ndarray, space: np.ndarray) -> np.ndarray:
    """Sum of the words' vectors over each grain; that of word 0 is zero."""
    words = numbers.reshape(-1, GRAIN)
    out = space[words[:, 0]]
    for i in range(1, GRAIN):
        out += space[words[:, i]]
    return out


def _search(batches: Iterator[pd.DataFrame], block: Block, rules: Rules) -> Iterator[pd.DataFrame]:
    kind, space = kind_of(block), block.space
    spans = np.array([span_of(len(words)) for _, words, _ in block.passages])
    asked = {k: np.flatnonzero(spans == k) for k in SPANS}
    queries = {k: block.queries[of].T.copy() for k, of in asked.items()}
    known = [places_of(item) for item in block.items]
    members = np.stack([membership(item, len(block.words) + 1) for item in block.items])
    sizes = np.array([len(item) for item in block.items])
    lengths = sizes + np.maximum(2, sizes // 4)
    of_passage = np.array([(place, first) for place, _, first in block.passages])
    needed = {k for k in SPANS if len(asked[k])}
    for k in sorted(SPANS, reverse=True):
        needed |= set(SPANS[k]) if k in needed else set()
    for rows, numbers, starts in _chunks(batches, kind, GRAIN, WINDOW):
        sums: dict[int, np.ndarray] = {}
        found: dict[tuple[int, int], tuple[float, float, float]] = {}
        for k, of in SPANS.items():
            if k not in needed:
                continue
            if not of:
                sums[k] = _grains(numbers, space)
            else:
                a, b = sums[of[0]], sums[of[1]]
                n = len(sums[1]) - k + 1
                sums[k] = a[:n] + b[of[0] : of[0] + n]
            if not len(asked[k]):
                continue
            stride = max(1, k // 4)
            size = np.sqrt(np.einsum("ij,ij->i", sums[k][::stride], sums[k][::stride]))
            some = np.flatnonzero(size > 1e-6)
            spans_close, asks_close, cosines = [], [], []
            for part in np.array_split(some, -(-len(some) // 4096) or 1):
                product = sums[k][part * stride] @ queries[k]
                close = product >= rules.cosine * size[part, None]
                rows_close = np.flatnonzero(close.any(axis=1))  # few
                at, asks = np.nonzero(close[rows_close])
                at = rows_close[at]
                spans_close.append(part[at])
                asks_close.append(asks)
                cosines.append(product[at, asks] / size[part[at]])
            width = k * GRAIN
            begins, asks, cosine = np.concatenate(spans_close) * stride * GRAIN, np.concatenate(asks_close), np.concatenate(cosines)
            # The gap between documents is as long as the longest span: its end tells the document.
            docs = np.searchsorted(starts, begins + width - 1, side="right") - 1
            order = np.lexsort((begins, asks))
            # What is near a candidate is looked at with it: the margin is half a span more than this.
            order = order[spaced(asks[order] * len(starts) + docs[order], begins[order], width)]
            place, first = of_passage[asked[k][asks[order]]].T
            margin, doc = width + width // 2, docs[order]
            middle = begins[order] - first
            low = np.maximum(starts[doc], middle - margin)
            high = np.minimum(starts[doc + 1], middle + margin + lengths[place])
            for some in np.split(np.arange(len(order)), range(COUNTED, len(order), COUNTED)):
                some = some[low[some] < high[some]]
                if not len(some):
                    continue
                # No span has a longer common subsequence than it has words of the item.
                most = most_words(numbers, low[some], high[some], lengths[place[some]], members, place[some])
                for i in some[most >= rules.paraphrase * sizes[place[some]]].tolist():
                    of_item = int(place[i])
                    shares = _verdict(numbers, low[i], high[i], of_item, known[of_item], block, rules)
                    if shares is not None:
                        new, pair = (*shares, float(cosine[order[i]])), (int(doc[i]), of_item)
                        found[pair] = max(found.get(pair, (0.0, 0.0, 0.0)), new)
        yield pd.DataFrame(
            [(rows[doc], block.ids[place], cosine, share, answer) for (doc, place), (share, answer, cosine) in found.items()],
            columns=["row", "item_id", "cosine", "item_share", "answer_share"],
        )


def find_leaks(docs: DataFrame, benchmark: DataFrame, rules: Rules = Rules(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document id and benchmark item that it contains: doc_id, item_id, cosine, item_share, answer_share.

    ``benchmark`` has item_id, text and, if there is one, answer; otherwise the end of the text stands for it.
    NULL or wordless texts and items never match; an id that repeats is one document with the best match of its
    rows; a NULL id is a document as well; other columns are not read; empty tables give no rows.
    """
    spark = docs.sparkSession
    answer = F.col("answer") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = benchmark.select("item_id", "text", answer.alias("answer")).where("text IS NOT NULL")
    own = docs.select(F.col(key).cast("string").alias("row"), F.col(text).alias("text"))
    schema = "row string, item_id long, cosine double, item_share double, answer_share double"
    nothing = spark.range(0).select(*(F.lit(None).cast(kind).alias(name) for name, kind in (x.split() for x in schema.split(", "))))
    result, rows = nothing, []  # an empty list would start Python processes on executors

    def searched(rows: list) -> DataFrame:
        block = build_block(rows, rules)
        if not block.ids:
            return nothing
        words = staged(own.select("row", encoded(F.col("text"), block, spark).alias("words")), "benchmark-words")
        _latent_space(words, block, rules)
        shared = spark.sparkContext.broadcast(block)
        return staged(words.mapInPandas(lambda x: _search(x, shared.value, rules), schema), "leaks")

    for row in items.toLocalIterator():
        rows.append(tuple(row))
        if len(rows) == BLOCK_ITEMS:
            result, rows = result.union(searched(rows)), []
    if rows:
        result = result.union(searched(rows))
    best = result.groupBy("row", "item_id").agg(F.max(F.struct("item_share", "answer_share", "cosine")).alias("best"))
    kind = docs.schema[key].dataType
    return best.select(
        F.col("row").cast(kind).alias("doc_id"), "item_id", *(F.col(f"best.{c}").alias(c) for c in ("cosine", "item_share", "answer_share"))
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, rules: Rules = Rules(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item; all columns of ``docs``.

    Every row is judged by its own text, whether its id is NULL, repeats, or not; ``key`` is not looked at.  NULL and wordless
    texts stay.
    """
    numbered = docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("number"))
    numbered = staged(numbered, "numbered")
    leaked = find_leaks(numbered.select("number", F.col(f"row.`{text}`").alias("text")), benchmark, rules, "number")
    leaked = staged(leaked.select(F.col("doc_id").alias("number")).distinct(), "leaked")
    few = F.broadcast(leaked) if leaked.count() <= SMALL else leaked
    return numbered.join(few, "number", "left_anti").select("row.*")
