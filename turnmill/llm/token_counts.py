"""Token counts with a whole-token shortcut.

Offline, once per vocabulary, each vocabulary string is put through the merges.  Those that come out
as one token form a table: a pre-token found there counts 1 without any merge.  Only the rest is merged.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Merged pre-tokens that a worker remembers before it starts anew; bounds its memory.
REMEMBERED = 300_000

#: Texts over so many characters are cut into pre-tokens one by one.
LONG = 1 << 20

#: Fixed value: the pre-token pattern of the byte-level vocabularies (white space as in Unicode).
PRE_TOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    shifted = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(shifted)) for b in range(256)]


def merged_count(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Number of tokens after merging: lowest rank first, leftmost among equals; n log n for n symbols."""
    size = len(symbols)
    after = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    parts: list[str | None] = list(symbols)
    heap = [(ranks[pair], i) for i, pair in enumerate(zip(symbols, symbols[1:])) if pair in ranks]
    heapq.heapify(heap)
    left = size
    while heap:
        rank, i = heapq.heappop(heap)
        if parts[i] is None or (j := after[i]) >= size or ranks.get((parts[i], parts[j])) != rank:
            continue  # one of the two has been merged since
        parts[i] += parts[j]
        parts[j] = None
        left -= 1
        after[i] = after[j]
        if after[i] < size:
            before[after[i]] = i
            if (r := ranks.get((parts[i], parts[after[i]]))) is not None:
                heapq.heappush(heap, (r, i))
        if (p := before[i]) >= 0 and (r := ranks.get((parts[p], parts[i]))) is not None:
            heapq.heappush(heap, (r, p))
    return left


class Tokenizer:
    """What the count needs of a byte-level BPE file; built on the driver, sent to workers.

    ``whole``: the texts proven to be one token.  Its size is that of the vocabulary.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError("only byte-level files without an added prefix space are supported")
        if spec.get("normalizer") or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("normalizers, ignore_merges and dropout are not supported")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that strip or match single words are not supported")
        self.special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks = {tuple(p): i for i, p in enumerate(pairs)}
        self.alphabet = byte_alphabet()
        value = {c: b for b, c in enumerate(self.alphabet)}
        self.whole = set()
        for token in model["vocab"]:
            if all(c in value for c in token) and merged_count(list(token), self.ranks) == 1:
                try:
                    self.whole.add(bytes(value[c] for c in token).decode())
                except UnicodeDecodeError:
                    pass  # part of a character: never a whole pre-token

    def merge(self, piece: str) -> int:
        return merged_count([self.alphabet[b] for b in piece.encode()], self.ranks)


class _Counts(dict):
    """Tokens per pre-token: 1 for whole tokens, else merged once and remembered for a while."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__(dict.fromkeys(tokenizer.whole, 1))
        self.tokenizer = tokenizer

    def __missing__(self, piece: str) -> int:
        if len(self) > len(self.tokenizer.whole) + REMEMBERED:
            self.clear()
            self.update(dict.fromkeys(self.tokenizer.whole, 1))
        n = self.tokenizer.merge(piece)
        if len(piece) < 100:
            self[piece] = n
        return n


def counter(tokenizer: Tokenizer):
    """A function from a text to its number of tokens.  Special strings count as one token each."""
    counts = _Counts(tokenizer)
    pattern = regex.compile(PRE_TOKEN)
    special = tokenizer.special and regex.compile("|".join(map(regex.escape, tokenizer.special)))

    def count(text: str | None) -> int:
        if not text:
            return 0
        parts = special.split(text) if special else [text]
        n = len(parts) - 1
        for part in parts:
            # A list of pieces is faster, an iterator needs no memory: the list only while it is small.
            found = pattern.findall(part) if len(part) < LONG else (m.group() for m in pattern.finditer(part))
            n += sum(map(counts.__getitem__, found))
        return n

    return count


def n_tokens(text: Column, tokenizer: Tokenizer, spark) -> Column:
    """Number of tokens of each text; NULL counts as empty."""
    shared = spark.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = counter(shared.value)
        for texts in batches:
            yield texts.map(count, na_action=None).astype("int64")

    return F.pandas_udf(run, "long").asNondeterministic()(text)


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 1024, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_bytes, n_tokens, over_limit.

    NULL and empty texts have 0 bytes and 0 tokens; rows that repeat are counted each; other columns
    are not read, so their names can't clash; an empty table gives no rows.
    """
    own = F.coalesce(F.col(text), F.lit(""))
    counted = docs.select(
        F.col(key).alias("doc_id"),
        F.octet_length(own).cast("long").alias("n_bytes"),
        n_tokens(F.col(text), Tokenizer(tokenizer_path), docs.sparkSession).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
