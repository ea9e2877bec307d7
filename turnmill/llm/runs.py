"""Periodic runs of words, by Baier's grouping of suffixes.

Phase one of Baier's suffix sorter groups the suffixes by their longest Lyndon prefix.  It keeps the text as a
sequence of letters, each the Lyndon word found so far at its position, and lets a letter take in the
greater ones that follow it.  A letter that nothing can be added to has its final length: the Lyndon array.

Here all texts of a block go through it together, and instead of the highest group alone every plateau of
equal letters between smaller ones is taken in at once.  The letters that take one in are ranked anew inside their old
group: by what follows, and by how often.  Where the following plateau itself is still to grow, fewer copies
before something greater rank higher.  Groups that are apart never change their order, so a few sorts of ever
fewer letters suffice.

Every run has a Lyndon root under the order of the letters or under its reverse (the end of the text being
smallest in both), and that root is an entry of the Lyndon array.  Its two longest common extensions, to the right and
to the left, give the run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnmill.llm.common import SPACE, word_blocks
from turnmill.llm.fill_in_middle import blocks

#: Bytes of text that are grouped together; a longer text is taken by itself.
BLOCK = 3 << 20

#: After so many rounds the letters that are left (long ascending chains) are ranked by doubling.
ROUNDS = 200

#: Extensions are compared word by word so far for all roots together, beyond that root by root.
NEAR = 24


class _Numbers(dict):
    """Words to numbers in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _finish(letters: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of what is left: next smaller suffixes, from ranks made by doubling."""
    rank, step = np.unique(letters, return_inverse=True)[1].astype(np.int64), 1
    ends = np.flatnonzero(letters == 0)
    while step < np.diff(ends).max(initial=1):
        following = np.zeros_like(rank)
        following[:-step] = rank[step:]
        rank, step = np.unique(rank * (rank.max() + 1) + following, return_inverse=True)[1].astype(np.int64), 2 * step
    values, smaller, stack = rank.tolist(), [0] * len(rank), []
    is_end = (letters == 0).tolist()
    for i in range(len(values) - 1, -1, -1):
        if is_end[i]:
            stack = [i]
            continue
        while not is_end[stack[-1]] and values[stack[-1]] > values[i]:
            stack.pop()
        smaller[i] = stack[-1]
        stack.append(i)
    own = np.flatnonzero(letters)
    return place[own], place[np.array(smaller, np.int64)[own]] - place[own]


def lyndon_roots(letters: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Position and length of the longest Lyndon word at each position, the first only of equal ones in a row.

    ``letters`` are positive; zeros, of which one is at either end, part the texts.
    """
    letters, place = letters.astype(np.int64), np.arange(len(letters))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        begins = np.ones(len(letters), bool)
        np.not_equal(letters[1:], letters[:-1], out=begins[1:])
        begins |= letters == 0
        first = np.flatnonzero(begins)
        value = letters[first]
        if not value.any():
            break
        copies = np.diff(first, append=len(letters))
        after = np.append(value[1:], 0)
        before = np.concatenate(([0], value[:-1]))
        done = (value > after) & (value > before)
        own = first[done]
        found.append((place[own], place[own + 1] - place[own]))

        grows = np.flatnonzero((after > value) & (value > 0))
        width = 2 * int(copies.max()) + 2
        times = copies[grows + 1]
        detail = after[grows] * width + np.where(done[grows + 1], times, width - times)
        if int(detail.max(initial=0)) * (int(value.max()) + 1) >= 1 << 62:
            detail = np.unique(detail, return_inverse=True)[1]
        width = int(detail.max(initial=0)) + 1
        ranked, place_in = np.unique(value[grows] * width + detail, return_inverse=True)
        group = ranked // width
        most = int(value.max())
        if most < 4 * len(letters):
            lower = np.zeros(most + 1, np.int64)
            np.cumsum(np.bincount(group, minlength=most + 1)[:-1], out=lower[1:])
            renewed = letters + lower[letters]
        else:
            renewed = letters + np.searchsorted(group, letters)
        renewed[first[grows] + copies[grows] - 1] = value[grows] + place_in + 1
        stay = np.repeat(~done, copies)
        letters, place = renewed[stay], place[stay]
    else:
        if letters.any():
            found.append(_finish(letters, place))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def _far(text: np.ndarray, a: int, b: int, forward: bool) -> int:
    """How many words from a on equal those from b on (going back: those before and at them)."""
    n, size = 0, 64
    while True:
        if forward:
            y = text[b + n : b + n + size]
            x = text[a + n : a + n + len(y)]
        else:
            low = max(a - n - size + 1, 0)
            x = text[low : a - n + 1][::-1]
            y = text[low + b - a : b - n + 1][::-1]
        differ = x != y
        at = int(differ.argmax())
        if differ[at]:
            return n + at
        n, size = n + len(x), min(2 * size, 1 << 16)


def _near(text: np.ndarray, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """Extensions, NEAR at most."""
    size = np.zeros(len(a), np.int64)
    going = np.arange(len(a))
    for k in range(NEAR):
        going = going[text[a[going] + step * k] == text[b[going] + step * k]]
        if not len(going):
            break
        size[going] += 1
    return size


def runs_of(text: np.ndarray, least: int, order: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of every run of at least ``least`` words, by start and period.

    ``text`` holds word numbers; -1, of which one is at either end, parts the texts.  ``order`` gives each number its rank.
    """
    ranks = np.where(text < 0, 0, order[text] + 1)
    spans = []
    for letters in (ranks, np.where(text < 0, 0, len(order) + 1 - ranks)):
        root, period = lyndon_roots(letters, rounds)
        right = _near(text, root, root + period, 1)
        left = _near(text, root - 1, root + period - 1, -1)
        far = np.flatnonzero((right == NEAR) | (left == NEAR))
        repeats: dict[int, tuple[int, int]] = {}
        for k in far[np.argsort(root[far])].tolist():
            i, p = int(root[k]), int(period[k])
            start, end = repeats.get(p, (0, 0))
            if not (start <= i and i + p <= end):  # else a root before has found this stretch
                start, end = i - _far(text, i - 1, i + p - 1, False), i + p + _far(text, i, i + p, True)
                repeats[p] = (start, end)
            left[k], right[k] = i - start, end - i - p
        size = left + period + right
        good = size >= np.maximum(least, 2 * period)
        spans.append(np.stack(((root - left)[good], size[good], period[good])))
    start, size, period = np.unique(np.concatenate(spans, axis=1), axis=1)
    by = np.lexsort((period, start))
    return start[by], size[by], period[by]


def runs_in_block(raws: list, least: int) -> tuple[list, np.ndarray, np.ndarray, np.ndarray, list]:
    """Per text the number of words and of runs; the runs, starts counted from the text's first word; the collapsed texts."""
    numbers = _Numbers()
    parts, ends = [np.array([-1], np.int32)], []
    at = 1
    for raw in raws:
        for words in word_blocks(raw):
            parts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
            at += len(words)
        parts.append(parts[0])
        ends.append(at)
        at += 1
    text = np.concatenate(parts)
    # An order by chance keeps ascending chains short whatever the texts are.
    order = np.random.default_rng(len(numbers)).permutation(len(numbers))
    start, size, period = runs_of(text, least, order) if numbers else (np.empty(0, np.int64),) * 3
    change = np.zeros(len(text) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + size, -1)
    kept = np.cumsum(change[:-1]) == 0
    begins = np.array([1] + [e + 1 for e in ends[:-1]], np.int64)
    owner = np.searchsorted(begins, start, side="right") - 1
    n_runs = np.bincount(owner, minlength=len(raws))
    words, collapsed = list(numbers), []
    for b, e, repeats in zip(begins.tolist(), ends, n_runs.tolist()):
        own = text[b:e][kept[b:e]] if repeats else text[b:e]
        collapsed.append(b" ".join(map(words.__getitem__, own.tolist())))
    return [e - b for b, e in zip(begins.tolist(), ends)], n_runs, np.stack((start - begins[owner], size, period)), collapsed


RUN = "struct<start: bigint, length: bigint, period: bigint>"


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 12) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (start, length, period; by start, then period), collapsed.

    A run is a longest stretch of at least ``least`` words, and two periods, in which words a period apart are identical;
    the period is the smallest one.  ``collapsed`` is the text with one period of each run: words that any run
    contains after its first period are left out, the others are joined by one space.  NULL and blank texts have no
    words, no runs and an empty ``collapsed``; repeated rows give a row each; other columns are not read; an empty table gives
    no rows.  Texts are taken whole; a very long one needs about 150 bytes of memory a word.
    """
    narrow = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, n_words long, runs array<{RUN}>, collapsed string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, offsets, data in blocks(batch.column(1), BLOCK):
                keys = batch.column(0).slice(first, len(offsets) - 1)
                bounds = offsets.tolist()
                n_words, n_runs, found, collapsed = runs_in_block([data[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], least)
                names = ["start", "length", "period"]
                values = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in found], names)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n_runs))), pa.int32()), values)
                columns = [keys, pa.array(n_words, pa.int64()), lists, pa.array(collapsed, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    return narrow.mapInArrow(run, schema)


def with_repeated_tails(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and text; of a tenth of the documents, chosen by id, the words from some place on repeat with some period.

    With h the CRC of the id and g = h // 10, every word i >= a of the n words becomes word a + (i - a) % p, where
    a = g % n and p = 1 + (n - a) // (3 + g % 8), if h % 10 is 0 and n > 0.  A NULL id leaves the text as it is.
    """
    code = F.crc32(F.col(key).cast("string").cast("binary"))
    g, n = F.floor(F.col("_h") / 10).cast("long"), F.size("_w").cast("long")
    words = F.when(F.col("_h") % 10 == 0, F.filter(F.split(F.col(text).cast("string"), SPACE), lambda w: w != ""))
    of = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"), code.alias("_h"))
    of = of.withColumn("_w", words.alias("_w"))
    a = g % n
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
    of = of.withColumn("_a", F.when(n > 0, a)).withColumn("_p", F.when(n > 0, p))
    at = F.transform(
        F.sequence(F.lit(0).cast("long"), n - 1),
        lambda i: F.get("_w", F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int")),
    )
    repeated = F.array_join(at, " ")
    return of.select("doc_id", F.when(n > 0, repeated).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the greatest run and digests, of ``periodic_runs``' rows.

    The greatest run is the longest; ties go to the smallest start, then period; without runs its columns are NULL.
    """
    of = lambda r, name: r[name].cast("string")
    listed = F.transform("runs", lambda r: F.concat(of(r, "start"), F.lit(","), of(r, "length"), F.lit(","), of(r, "period"), F.lit("\n")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    return found.select("doc_id", "runs", best.alias("b"), "collapsed").select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("b.s")).alias("start"),
        F.col("b.l").alias("length"),
        (-F.col("b.p")).alias("period"),
        F.expr("(1000 * b.l) div -b.p").alias("exponent_milli"),
        sha(F.array_join(listed, "")).alias("runs_sha256"),
        sha(F.col("collapsed")).alias("collapsed_sha256"),
    )
