"""Byte-level BPE by replaying the merges over a corpus of words, and decoding.

A text is cut into words by a pattern. The distinct new words of a batch of texts are put one after the other as
bytes, and an inverted index leads from each token that a pair would make to the positions of such pairs. The
lowest rank is taken first, all its positions in order; a merge touches only its two neighbours, whose new pairs go
into the index. So a word that a thousand texts share is merged once, and pairs that occur nowhere cost nothing.
Texts are then their words' ids put together.

The result is that of merging each word by itself, lowest rank first and leftmost among equals. Where a merge makes
a pair of a still lower rank, the rest of that word waits till that pair is done. A word that is a token as a whole
is that token, as in the library that these rank files belong to.

Tasks are independent and shuffle nothing. Words are remembered from batch to batch of a task, up to ``KNOWN``
bytes, then forgotten; a text is cut in spans of words, so a very long one needs no more memory than its own size.

Defined cases: a null text is an empty one and has no ids; rows with equal or null keys stay as they are; a batch
without rows gives none. Ids are little-endian unsigned 32-bit integers in one binary value.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of words and ids that a task remembers, roughly.
KNOWN = 96 << 20
#: Words of texts that are looked up and put together at a time.
SPAN = 500_000
#: No token, no position.
NOTHING = -1
#: Texts up to this length are cut in one call; longer ones word by word.
LONG = 1 << 20


class Ranks:
    """Tokens by their bytes, and what each pair of tokens makes."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ids = ranks
        self.bytes = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, number in ranks.items():
            self.bytes[number] = token
        self.single = np.array([ranks[bytes([b])] for b in range(256)])
        #: By left token: what it makes with a right one.
        self.made: list[dict[int, int]] = [{} for _ in self.bytes]
        for token, number in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.made[left][right] = number
        #: The same for pairs of bytes, NOTHING where a pair makes no token.
        self.of_bytes = np.array([[self.made[left].get(right, NOTHING) for right in self.single.tolist()] for left in self.single.tolist()])

    @staticmethod
    @lru_cache(2)
    def read(path: str) -> Ranks:
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines)
            return Ranks({base64.b64decode(token): int(number) for token, number in (p for p in pairs if p)})


def replay(words: list[bytes], ranks: Ranks) -> list[list[int]]:
    """The ids of each word, all merges of one rank over all words before the next rank's."""
    if not any(words):
        return [[] for _ in words]
    raw = np.frombuffer(b"".join(words), np.uint8)
    lengths = np.array([len(w) for w in words])
    ends = np.cumsum(lengths)
    pairs = np.full(len(raw), NOTHING)
    pairs[:-1] = ranks.of_bytes[raw[:-1], raw[1:]]
    pairs[ends[lengths > 0] - 1] = NOTHING  # the last byte of a word starts no pair

    # The inverted index: what a pair makes, to the positions of such pairs, falling behind as tokens merge.
    order = np.argsort(pairs, kind="stable")
    order = order[np.searchsorted(pairs[order], NOTHING, "right") :].tolist()
    made = pairs.tolist()  # at each token's first byte: what it makes with the next one
    index: dict[int, list[int]] = {}
    for at in order:
        if made[at] in index:
            index[made[at]].append(at)
        else:
            index[made[at]] = [at]
    waiting = list(index)  # in rank order, which is that of a heap
    token = ranks.single[raw].tolist()
    after = list(range(1, len(raw) + 1))
    before = list(range(-1, len(raw) - 1))
    for end in ends[lengths > 0].tolist():
        after[end - 1] = NOTHING
    for start in (ends - lengths)[lengths > 0].tolist():
        before[start] = NOTHING

    follow = ranks.made
    push, pop = heapq.heappush, heapq.heappop
    while waiting:
        rank = pop(waiting)
        places = index.pop(rank, None)
        if places is None:
            continue
        places.sort()
        makes = follow[rank]
        held: set[int] = set()  # words in which a lower rank has come up meanwhile
        for at in places:
            if made[at] != rank:
                continue
            if held and int(np.searchsorted(ends, at, "right")) in held:
                if rank in index:
                    index[rank].append(at)
                else:
                    index[rank] = [at]
                    push(waiting, rank)
                continue
            right = after[at]
            beyond = after[right]
            token[at] = rank
            token[right] = made[right] = NOTHING
            after[at] = beyond
            lowest = rank
            new = NOTHING
            if beyond >= 0:
                before[beyond] = at
                new = makes.get(token[beyond], NOTHING)
                if new >= 0:
                    if new in index:
                        index[new].append(at)
                    else:
                        index[new] = [at]
                        push(waiting, new)
                    if new < rank:
                        lowest = new
            made[at] = new
            ahead = before[at]
            if ahead >= 0:
                new = made[ahead] = follow[token[ahead]].get(rank, NOTHING)
                if new >= 0:
                    if new in index:
                        index[new].append(ahead)
                    else:
                        index[new] = [ahead]
                        push(waiting, new)
                    if new < rank:
                        lowest = new
            if lowest < rank:
                held.add(int(np.searchsorted(ends, at, "right")))

    kept = np.array(token)
    ids = kept[kept >= 0].tolist()
    sizes = np.add.reduceat(np.append(kept >= 0, False), np.minimum(ends - lengths, len(kept))).tolist()
    out, start = [], 0
    for length, size in zip(lengths.tolist(), sizes):
        size = size if length else 0
        out.append(ids[start : start + size])
        start += size
    return out


class Encoder:
    """Texts to ids, with the words met so far."""

    def __init__(self, ranks: Ranks, pattern: str) -> None:
        import regex

        self._ranks = ranks
        self._pattern = regex.compile(pattern)
        self._known: dict[str, bytes] = {}
        self._size = 0

    def _learn(self, words: set[str]) -> None:
        if self._size > KNOWN:
            self._known.clear()
            self._size = 0
        whole = self._ranks.ids
        rest = []
        for word in words - self._known.keys():
            raw = word.encode("utf-8", "surrogatepass")
            number = whole.get(raw)
            if number is None:
                rest.append((word, raw))
            else:
                self._known[word] = number.to_bytes(4, "little")
        self._size += 100 * (len(words) - len(rest))
        for (word, _), ids in zip(rest, replay([raw for _, raw in rest], self._ranks)):
            self._known[word] = np.array(ids, "<u4").tobytes()
            self._size += 100 + 8 * len(word)

    def _spans(self, text: str) -> Iterator[list[str]]:
        if len(text) <= LONG:
            yield self._pattern.findall(text)
            return
        words = (found.group() for found in self._pattern.finditer(text))
        while span := list(islice(words, SPAN)):
            yield span

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text; texts are gathered until they have ``SPAN`` words."""
        held: list[list[str]] = []
        size = 0
        for text in texts:
            if text is not None and len(text) > LONG:
                yield from self._joined(held)
                held, size = [], 0
                yield b"".join(part for span in self._spans(text) for part in self._joined([span]))
                continue
            held.append(self._pattern.findall(text) if text else [])
            size += len(held[-1])
            if size >= SPAN:
                yield from self._joined(held)
                held, size = [], 0
        yield from self._joined(held)

    def _joined(self, texts: list[list[str]]) -> Iterator[bytes]:
        self._learn(set().union(*texts))
        found = self._known.__getitem__
        for words in texts:
            yield b"".join(map(found, words))


def encode(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and ``ids`` (binary) of every row's text. ``path`` is a rank file that every machine has."""
    rows = docs.select(*[F.col(c) for c in keep], F.col("text").alias("_text"))
    fields = [docs.schema[c] for c in keep]
    schema = T.StructType([*fields, T.StructField("ids", T.BinaryType())])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Ranks.read(path), pattern)
        for part in parts:
            texts = part.column(len(keep))
            whole = encoder.encode(text.as_py() for text in texts)
            ids = pa.array(whole, pa.binary(), size=part.num_rows) if part.num_rows else pa.array([], pa.binary())
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], ids], [*keep, "ids"])

    return rows.mapInArrow(batches, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows with ``text``, the bytes that their ids stand for (binary), beside all their columns."""
    names = encoded.columns
    if "text" in names:
        raise ValueError("the decoded column is called text; rename the one that is there")
    schema = T.StructType([*encoded.schema.fields, T.StructField("text", T.BinaryType())])
    at = names.index("ids")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Ranks.read(path).bytes.__getitem__
        for part in parts:
            texts = [
                None if ids is None else b"".join(map(found, np.frombuffer(ids, "<u4").tolist()))
                for ids in (value.as_py() for value in part.column(at))
            ]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], [*names, "text"])

    return encoded.mapInArrow(batches, schema)
