"""Fill-in-the-middle: a text is cut at two code points and its parts are put in another order.

The cuts are found on the UTF-8 bytes eight at a time.  A batch of texts is viewed as unsigned integers of
64 bits; shifts and masks set one bit per byte that ends a code point; ``bitwise_count`` counts the
marks per integer.  The k-th mark lies in the integer that a search in the running counts gives; inside it a
multiplication spreads the counts over its bytes, and a comparison of all eight bytes at once finds the place.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Marks before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: Bytes of text that are looked at together; a longer text is taken by itself.
BLOCK = 8 << 20

ONES = np.uint64(0x0101010101010101)
HIGHS = np.uint64(0x8080808080808080)


def ending_marks(data: np.ndarray) -> np.ndarray:
    """One uint64 per eight bytes: bit 0 of each byte is set if a code point ends with that byte.

    A byte ends a code point if the next one is no continuation byte (10xxxxxx).  Bytes beyond the data
    count as zeros.
    """
    padded = np.zeros((len(data) // 8 + 1) * 8, np.uint8)
    padded[: len(data)] = data
    words = padded.view("<u8")
    continued = (words >> np.uint64(7)) & ~(words >> np.uint64(6)) & ONES
    following = continued >> np.uint64(8)
    following[:-1] |= continued[1:] << np.uint64(56)
    return ~following & ONES


class Units:
    """Counts and finds code points in a block of valid UTF-8."""

    def __init__(self, data: np.ndarray):
        self.marks = ending_marks(data)
        self.before = np.zeros(len(self.marks) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.marks), out=self.before[1:], dtype=np.int64)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many code points end before byte ``at``."""
        word, shift = at >> 3, ((at & 7) << 3).astype(np.uint64)
        lower = (np.uint64(1) << shift) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.marks[word] & lower)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte after the ``k``-th code point of the block, k from 1."""
        word = np.searchsorted(self.before, k, side="left") - 1
        wanted = (k - self.before[word]).astype(np.uint64)
        upto = self.marks[word] * ONES  # byte j: how many marks there are in bytes 0 to j, 8 at most
        reached = (upto + (np.uint64(128) - wanted) * ONES) & HIGHS
        return (word << 3) + 9 - np.bitwise_count(reached)


def draws(key, seed: str) -> tuple[int, ...]:
    """Four unsigned integers of 32 bits from the id; a NULL id counts as an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return struct.unpack(">4I", digest[:16])


def blocks(texts: pa.Array, most: int = BLOCK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, byte offsets and bytes of successive blocks of rows; NULL has no bytes."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1, first + 1)
        own = offsets[first : last + 1]
        yield first, own - own[0], whole[own[0] : own[-1]]
        first = last


def transform_block(keys: list, offsets: np.ndarray, data: np.ndarray, seed: str, rate: int, spm: int) -> dict:
    """Columns of the result for the texts between the offsets."""
    units, marks = Units(data), [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    before = units.rank(offsets)
    n = np.diff(before)
    drawn = np.array([draws(k, seed) for k in keys], np.int64).reshape(-1, 4)
    cuts = np.sort(drawn[:, :2] % (n + 1)[:, None], axis=1)
    places = np.repeat(offsets[:-1, None], 2, axis=1)
    inner = cuts > 0
    places[inner] = units.select((before[:-1, None] + cuts)[inner])
    p, s, m = marks
    forms, outputs, raw = [], [], data.tobytes()
    for start, end, (a, b), h3, h4 in zip(offsets[:-1].tolist(), offsets[1:].tolist(), places.tolist(), drawn[:, 2].tolist(), drawn[:, 3].tolist()):
        text = raw[start:end]
        if not text or h3 % 100 >= rate or any(x in text for x in marks):
            forms.append("plain")
            outputs.append(text)
        elif h4 % 100 < spm:
            forms.append("spm")
            outputs.append(b"".join((s, raw[b:end], p, raw[start:a], m, raw[a:b])))
        else:
            forms.append("psm")
            outputs.append(b"".join((p, raw[start:a], s, raw[b:end], m, raw[a:b])))
    plain = np.array([f == "plain" for f in forms], bool)
    return {
        "n": pa.array(n, pa.int64()),
        "form": pa.array(forms, pa.string()),
        "prefix_chars": pa.array(cuts[:, 0], pa.int64(), mask=plain),
        "middle_chars": pa.array(cuts[:, 1] - cuts[:, 0], pa.int64(), mask=plain),
        "output": pa.array(outputs, pa.binary()).cast(pa.string()),
    }


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: str = "1", rate: int = 90, spm: int = 20) -> DataFrame:
    """One row per row of ``docs``: doc_id, n (code points), form, prefix_chars, middle_chars, output.

    ``rate`` of a hundred texts are transformed, ``spm`` of a hundred of those with the suffix first; which ones,
    and the two cuts, follow from the id and ``seed`` alone.  NULL counts as the empty text; empty texts and texts
    that hold one of the marks stay plain and have no cuts.  Rows of one id are cut alike; a NULL id draws as an empty
    one does.  Texts are taken whole, however long; other columns are not read; an empty table gives no rows.
    """
    narrow = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, offsets, data in blocks(batch.column(1)):
                keys = batch.column(0).slice(first, len(offsets) - 1)
                made = transform_block(keys.to_pylist(), offsets, data, seed, rate, spm)
                yield pa.RecordBatch.from_arrays([keys, *made.values()], ["doc_id", *made])

    return narrow.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The exact text, from the output and its form alone."""
    p, s, m = PREFIX, SUFFIX, MIDDLE  # no pattern characters in them
    return (
        F.when(form == "psm", F.regexp_replace(output, f"(?s)^{p}(.*?){s}(.*?){m}(.*)$", "$1$3$2"))
        .when(form == "spm", F.regexp_replace(output, f"(?s)^{s}(.*?){p}(.*?){m}(.*)$", "$2$3$1"))
        .otherwise(output)
    )


def digests(made: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 of ``fill_in_middle``'s rows."""
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        sha(F.col("output")).alias("output_sha256"),
        sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )
