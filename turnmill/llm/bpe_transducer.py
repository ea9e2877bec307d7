"""Byte-level BPE as a finite-state transducer, and streaming decoding.

The transducer reads a pre-token byte by byte.  After each byte it knows the last token of the encoding of all that
was read, and every prefix that can still matter: one that ends where a vocabulary token may still be under
way.  Such a configuration is a state.  States and transitions are made when the input first asks for them.
The tokens are read off backwards, from one last token to the one before; those on which all prefixes that can
still matter agree come out of a long pre-token before its end.

The step rests on a property of rank-ordered merges: a token sequence is the encoding of its bytes if
and only if every two neighbours are the encoding of theirs.  So the encoding of a prefix is the
encoding of a shorter prefix plus one token, and two neighbours suffice to find it.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnmill.llm.common import KEPT, kept, release
from turnmill.llm.fill_in_middle import blocks

#: Bounds on what a worker remembers; transitions beyond them are made, but not kept.
MAX_TRANSITIONS = 200_000
MAX_STATES = 75_000
MAX_PAIRS = 75_000

#: Bytes, by estimate, of the texts whose ids a worker remembers: those after a blank, and other pre-tokens.
STRETCH_BYTES = 32 << 20
PIECE_BYTES = 12 << 20

#: What an entry takes besides its text and its ids.
ENTRY_BYTES = 220

#: A node that at most so many tokens continue is dropped where none of them can follow.
FEW = 100

#: Where at most so many can follow, contexts that allow the same of them are one.
SAME = 12

#: States of a pre-token that are held before the tokens that are sure come out.
HELD = 1 << 16

#: Characters of a text that are cut into pre-tokens at a time.
LONG = 1 << 20

#: Ids decoded at a time.
CHUNK = 1 << 16

#: Bytes of texts that are handed back together; a longer one goes by itself.
BLOCK = 2 << 20

#: White space other than the blank, by this pattern language or Python's.
OTHER_SPACE = [chr(c) for c in (*range(0x09, 0x0E), *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]

#: A blank with no white space on either side.
LONE_BLANK = re.compile(r"(?<=\S) (?=\S)")


def merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[list[int], tuple[int, int] | None]:
    """Plain merging of a short byte string: lowest rank first, leftmost among equals.

    Gives the ids, and the two that the last merge joined.
    """
    parts, joined = [piece[i : i + 1] for i in range(len(piece))], None
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, len(ranks)), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == len(ranks):
            break
        joined = (ranks[parts[at]], ranks[parts[at + 1]])
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts], joined


class Ranks:
    """A rank file, as the driver sends it to workers; its size is that of the vocabulary.

    The tasks of a worker process go on with what earlier ones have built.
    """

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.pattern = pattern
        self.name = hashlib.sha256(repr((sorted(self.ranks.items()), pattern)).encode()).hexdigest()
        if any(bytes([b]) not in self.ranks for b in range(256)) or max(self.ranks.values()) >= len(self.ranks):
            raise ValueError("the ranks must cover every byte and be dense")
        #: Tokens that merging never reaches: they stand only for a pre-token that equals them.
        self.unreached: dict[bytes, int] = {}
        #: The two tokens that each token is merged from; none for bytes.
        self.halves: list[tuple[int, int] | None] = [None] * len(self.ranks)
        for token, rank in self.ranks.items():
            ids, self.halves[rank] = merge(token, self.ranks)
            if ids != [rank]:
                self.unreached[token] = rank


class _Steps(dict):
    """state << 8 | byte -> state; made when first asked for."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, step: int) -> int | None:
        return self.make(step)


class Transducer:
    """Encodes byte strings; see the head of this file.

    A state is (last token of what was read or -1, live prefixes); a live prefix is (trie node of the bytes after it,
    its last token).  That token is left out where all that may come can follow; one may stand for others that allow
    the same.  Everything read so far is the last live prefix, and not listed.
    """

    ROOT = 0

    def __init__(self, source: Ranks):
        self.ranks, self.halves = source.ranks, source.halves
        self.token = [b""] * len(source.ranks)
        self.trie: dict[int, int] = {}  # node << 8 | byte -> node
        self.below: dict[int, list[int]] = {}  # node -> tokens that continue it
        self.ends: dict[int, int] = {}  # node -> token
        self.depth = [0]
        for token, rank in source.ranks.items():
            self.token[rank] = token
            if token in source.unreached:
                continue
            node = self.ROOT
            for byte in token:
                step = node << 8 | byte
                self.below.setdefault(node, []).append(rank)
                if step not in self.trie:
                    self.trie[step] = len(self.depth)
                    self.depth.append(self.depth[node] + 1)
                node = self.trie[step]
            self.ends[node] = rank
        #: Nodes that few tokens continue; the others are taken to be open in any context.
        self.few = {node: tokens for node, tokens in self.below.items() if len(tokens) <= FEW}
        self.below = self.below.keys()
        self.lives: dict[int, tuple] = {}
        self.same: dict[tuple, tuple[int, tuple[int, ...]]] = {}
        self.pairs: dict[int, bool] = {}
        self.restart()

    def restart(self) -> None:
        first = (-1, ())
        self.states = [first]
        self.number = {first: 0}
        self.steps = _Steps(self._make)

    def adjacent(self, a: int, b: int) -> bool:
        """Whether b may follow a; anything may come first (-1)."""
        if a < 0:
            return True
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > MAX_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._never_joined(a, b)
        return known

    def _never_joined(self, a: int, b: int) -> bool:
        """Whether merging leaves the border between a and b alone.

        Goes back in time: undoes the later of the merges that made the two neighbours of the border, and looks
        each time whether the neighbours would have been merged before either was used up.  Of two merges of
        the same rank the left one comes first.
        """
        token, ranks, halves = self.token, self.ranks, self.halves
        until_a = until_b = len(ranks)
        while True:
            rank = ranks.get(token[a] + token[b])
            if rank is not None and rank < until_a and rank <= until_b:
                return False
            of_a, of_b = halves[a], halves[b]
            if of_a is not None and (of_b is None or a > b):
                until_a, a = a, of_a[1]
            elif of_b is not None:
                until_b, b = b, of_b[0]
            else:
                return True

    def _live(self, last: int, node: int) -> tuple:
        """The live prefix with this last token and node; empty if no token that begins with the node's bytes may follow."""
        if len(self.lives) > MAX_PAIRS:
            self.lives.clear()
            self.same.clear()
        tokens, made = self.few.get(node), (node, (last,) if last >= 0 else ())
        if tokens is not None and last >= 0:
            if len(tokens) <= SAME:
                allowed = tuple([t for t in tokens if self.adjacent(last, t)])
                if len(allowed) == len(tokens):
                    made = (node, ())
                made = self.same.setdefault((node, allowed), made) if allowed else ()
            elif not any(self._never_joined(last, t) for t in tokens):
                made = ()
        self.lives[last << 32 | node] = made
        return made

    def _advance(self, state: tuple, byte: int) -> tuple:
        """The state after one more byte."""
        last, live = state
        trie, ends, below, pairs, lives = self.trie, self.ends, self.below, self.pairs, self.lives
        kept, whole = [], -1
        for node, before in (*live, (self.ROOT, (last,))):
            node = trie.get(node << 8 | byte)
            if node is None:
                continue
            before = before[0] if before else -1
            if whole < 0:
                token = ends.get(node, -1)
                if token >= 0:
                    fits = before < 0 or pairs.get(before << 32 | token)
                    if fits or fits is None and self.adjacent(before, token):
                        whole = token
            if node in below:
                found = lives.get(before << 32 | node)
                if found is None:
                    found = self._live(before, node)
                if found:
                    kept.append(found)
        return whole, tuple(kept)

    def _make(self, step: int) -> int | None:
        """Determinise one transition; None when there is no more room."""
        if len(self.steps) >= MAX_TRANSITIONS or len(self.states) >= MAX_STATES:
            return None
        state = self._advance(self.states[step >> 8], step & 255)
        number = self.number.get(state)
        if number is None:
            number = self.number[state] = len(self.states)
            self.states.append(state)
        self.steps[step] = number
        return number

    def encode(self, piece: bytes) -> list[int]:
        if len(piece) > HELD:
            return self._encode_long(piece)
        state, lasts, steps, states = 0, [], self.steps, self.states
        for at, byte in enumerate(piece):
            state = steps[state << 8 | byte]
            if state is None:
                self._go_on(states[lasts[-1]] if lasts else states[0], piece[at:], lasts := [states[s][0] for s in lasts])
                return self._read_off(lasts, len(lasts))
            lasts.append(state)
        out, end = [], len(lasts)
        while end:
            token = states[lasts[end - 1]][0]
            out.append(token)
            end -= len(self.token[token])
        out.reverse()
        return out

    def _go_on(self, state: tuple, rest: bytes, lasts: list[int]) -> tuple:
        """Reads on from a state without keeping what is made; the last token after each byte goes to ``lasts``."""
        steps, states, number = self.steps, self.states, self.number.get(state)
        for byte in rest:
            known = None if number is None else steps[number << 8 | byte]
            if known is None:
                state = self._advance(state if number is None else states[number], byte)
                number = self.number.get(state)
            else:
                number = known
            lasts.append(state[0] if number is None else states[number][0])
        return state if number is None else states[number]

    def _read_off(self, lasts: list[int], end: int) -> list[int]:
        """The tokens of the first ``end`` bytes, by the last token after each byte."""
        out = []
        while end:
            out.append(lasts[end - 1])
            end -= len(self.token[out[-1]])
        out.reverse()
        return out

    def _encode_long(self, piece: bytes) -> list[int]:
        """The same, HELD bytes at a time."""
        state, lasts, out = self.states[0], [], []
        for start in range(0, len(piece), HELD):
            state = self._go_on(state, piece[start : start + HELD], lasts)
            sure = self._sure(state, lasts)
            out += self._read_off(lasts, sure)
            del lasts[:sure]
        return out + self._read_off(lasts, len(lasts))

    def _sure(self, state: tuple, lasts: list[int]) -> int:
        """How many of the bytes read have their tokens in the encodings of all live prefixes."""
        ends = {len(lasts), *(len(lasts) - self.depth[node] for node, _ in state[1])}
        while len(ends) > 1:
            latest = max(ends)
            ends.remove(latest)
            ends.add(latest - len(self.token[lasts[latest - 1]]))
        return ends.pop()


class _Memo(dict):
    """Ids per text, as little-endian integers of four bytes, remembered within a number of bytes.

    When it is full it becomes the older half, from which what is still in use is taken over.
    """

    def __init__(self, encode: Callable[[str], bytes], most: int):
        super().__init__()
        self.encode, self.most, self.size, self.older = encode, most // 2, 0, {}

    def __missing__(self, text: str) -> bytes:
        ids = self.older.get(text)
        if ids is None:
            ids = self.encode(text)
        if len(text) < 100:
            self.size += ENTRY_BYTES + 2 * len(text) + len(ids)
            if self.size > self.most:
                self.older, self.size = dict(self), 0
                self.clear()
            self[text] = ids
        return ids


def segments(text: str, size: int) -> Iterator[str]:
    """The text in parts of about ``size`` characters, cut before blanks that no pre-token goes across."""
    start = 0
    while len(text) - start > size:
        found = LONE_BLANK.search(text, start + size)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text


def encoder(source: Ranks):
    """A function from a text to the array of its token ids.

    A blank between two other characters always begins a pre-token, so a text is cut at its blanks first; most stretches
    between them have been met before.
    """
    transducer, pattern, unreached = Transducer(source), regex.compile(source.pattern), source.unreached

    def piece_ids(piece: str) -> bytes:
        raw = piece.encode()
        rank = unreached.get(raw)
        return array("i", transducer.encode(raw) if rank is None else [rank]).tobytes()

    # Keyed by what follows the blank; a stretch that is one pre-token is an entry like any other pre-token after a blank.
    stretches = _Memo(lambda stretch: after_blank(stretch), STRETCH_BYTES)
    pieces = _Memo(piece_ids, PIECE_BYTES)

    def after_blank(stretch: str) -> bytes:
        found = pattern.findall(" " + stretch)
        return piece_ids(found[0]) if len(found) == 1 else joined(found)

    def joined(found: Iterable[str]) -> bytes:
        return b"".join([stretches[p[1:]] if p[0] == " " and len(p) > 1 else pieces[p] for p in found])

    def plain(text: str) -> bytes:
        return joined(pattern.findall(text) if len(text) < LONG else (m.group() for m in pattern.finditer(text)))

    def part(text: str) -> bytes:
        side = "  " in text or any(w + " " in text or " " + w in text for w in OTHER_SPACE if w in text)
        first, *rest = LONE_BLANK.split(text) if side else text.split(" ")
        return plain(first) + b"".join(map(stretches.__getitem__, rest))

    def encode(text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        return np.frombuffer(b"".join(map(part, segments(text, LONG))), np.int32)

    return encode


class Utf8Stream:
    """Incremental UTF-8: bytes go in as they come, whole characters come out.

    The state is how many continuation bytes are due and the range of the next one; the bytes of an
    unfinished character wait.  Bytes that can't be part of a character become U+FFFD.
    """

    #: Lead byte ranges: first, last, bytes due, range of the next byte.
    LEADS = (
        (0xC2, 0xDF, 1, 0x80, 0xBF),
        (0xE0, 0xE0, 2, 0xA0, 0xBF),
        (0xE1, 0xEC, 2, 0x80, 0xBF),
        (0xED, 0xED, 2, 0x80, 0x9F),
        (0xEE, 0xEF, 2, 0x80, 0xBF),
        (0xF0, 0xF0, 3, 0x90, 0xBF),
        (0xF1, 0xF3, 3, 0x80, 0xBF),
        (0xF4, 0xF4, 3, 0x80, 0x8F),
    )
    START = {b: (due, low, high) for first, last, due, low, high in LEADS for b in range(first, last + 1)}

    def __init__(self):
        self.waiting = b""

    @classmethod
    def unfinished(cls, data: bytes) -> int:
        """How many bytes at the end are the beginning of a character."""
        for back in range(1, min(3, len(data)) + 1):
            state = cls.START.get(data[-back])
            if state is None:
                continue
            due, low, high = state
            for byte in data[len(data) - back + 1 :]:
                if not low <= byte <= high:
                    return 0
                due, low, high = due - 1, 0x80, 0xBF
            return back if due else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.waiting + data
        cut = len(data) - self.unfinished(data)
        self.waiting = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.waiting = self.waiting, b""
        return rest.decode("utf-8", "replace")


def decode_stream(ids: Iterable[int], token: list[bytes]) -> Iterator[str]:
    """Decode ids chunk by chunk; characters may be split between tokens and chunks."""
    stream = Utf8Stream()
    ids = np.asarray(ids)
    for start in range(0, len(ids), CHUNK):
        yield stream.feed(b"".join(map(token.__getitem__, ids[start : start + CHUNK].tolist())))
    yield stream.finish()


def encode_text(text: Column, source: Ranks, spark) -> Column:
    """Token ids of each text (array of int); NULL counts as empty."""
    shared = spark.sparkContext.broadcast(source)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        with kept(lambda: coder(shared.value)) as (encode, _):
            for texts in batches:
                for block in text_blocks(texts):
                    yield id_lists([encode(x) for x in block])

    return F.arrow_udf(run, "array<int>").asNondeterministic()(text)


def text_blocks(texts: pa.Array) -> Iterator[list[str]]:
    """The texts, BLOCK bytes at a time; NULL as the empty text.  One empty list if there are none."""
    if not len(texts):
        yield []
    for _, offsets, data in blocks(texts, BLOCK):
        bounds, raw = offsets.tolist(), data.tobytes()
        yield [raw[a:b].decode() for a, b in zip(bounds, bounds[1:])]


def id_lists(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids) if ids else [], pa.int32()))


def tokens_of(source: Ranks) -> list[bytes]:
    token = [b""] * len(source.ranks)
    for raw, rank in source.ranks.items():
        token[rank] = raw
    return token


def decode_ids(ids: Column, source: Ranks, spark) -> Column:
    """Text of each array of ids; a NULL array gives the empty text, an unknown id fails."""
    shared = spark.sparkContext.broadcast(source)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with kept(lambda: coder(shared.value)) as (_, token):
            for arrays in batches:
                yield pd.Series(["" if x is None else "".join(decode_stream(x, token)) for x in arrays], dtype=object)

    return F.pandas_udf(run, "string").asNondeterministic()(ids)


def coder(source: Ranks) -> tuple:
    """The process's encoder and token list for the last rank file; tasks get at it through ``kept``."""
    if source.name not in KEPT:
        release()
        KEPT[source.name] = (encoder(source), tokens_of(source))
    return KEPT[source.name]


def coded_text(text: Column, source: Ranks, spark) -> Column:
    """Struct of ids and the text decoded from them, by one worker."""
    shared = spark.sparkContext.broadcast(source)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        with kept(lambda: coder(shared.value)) as (encode, token):
            for texts in batches:
                for block in text_blocks(texts):
                    ids = [encode(x) for x in block]
                    decoded = pa.array(["".join(decode_stream(x, token)) for x in ids], pa.string())
                    yield pa.StructArray.from_arrays([id_lists(ids), decoded], ["ids", "decoded"])

    return F.arrow_udf(run, "ids array<int>, decoded string").asNondeterministic()(text)


def encode_documents(docs: DataFrame, source: Ranks, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key and ids.

    NULL and empty texts have no ids; repeated rows are encoded each; other columns are not read; an
    empty table gives no rows.
    """
    return docs.select(F.col(key).alias("doc_id"), encode_text(F.col(text), source, docs.sparkSession).alias("ids"))


def round_trip(docs: DataFrame, source: Ranks, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``encode_documents`` plus the decoded text."""
    coded = docs.select(F.col(key).alias("doc_id"), coded_text(F.col(text), source, docs.sparkSession).alias("of"))
    return coded.select("doc_id", "of.ids", "of.decoded")


def digests(coded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of ``round_trip``'s rows."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
