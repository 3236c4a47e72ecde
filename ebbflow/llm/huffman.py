"""Token ids in files of canonical length-limited Huffman codes.

One code for the whole corpus comes from the global counts of the ids. Every document starts at a byte and is
cut into blocks of ``BLOCK`` tokens whose bit offsets are kept as checkpoints, so blocks are decoded
independently: the decoder looks up one table entry per token for many blocks at a time.

File: ``HUF1``, the documents' bit streams, a footer (zlib: JSON head, then arrays), its length, ``HUF1``. The
footer has the code lengths, so a file is read without anything else.

Defined results: a null text is empty and encodes to the end id alone; a null doc_id sorts first; rows that
repeat a doc_id stand side by side, ordered by their ids. An empty table gives no file. Other columns are
ignored.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.llm.common import drop, open_in, open_out, scratch

MAGIC = b"HUF1"
#: A blank as byte-level vocabularies spell it.
BLANK = "\u0120"
BLOCK = 1024
#: Tokens whose streams one task puts in order, about.
PART = 16_000_000
#: Pieces whose ids a Python worker remembers, of at most so many characters each.
REMEMBERED, SHORT = 1_000_000, 40

# How the byte-level vocabulary splits a text before merging.
_LETTERS = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
_BLANKS = r"\t\n\v\f\r \xa0"


def _pieces(letters: str, blanks: str) -> re.Pattern:
    return re.compile(
        rf" ?[{letters}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+| ?[^{blanks}{letters}0-9]+|[{blanks}]+(?![^{blanks}])|[{blanks}]+"
    )


PIECES, ASCII_PIECES = _pieces(_LETTERS, _BLANKS), _pieces("A-Za-z", r"\t\n\v\f\r ")
#: Beyond these characters the classes above do not hold: such texts are not split here.
UNSURE = re.compile(
    "[^\x00-\x1b\x20-\x7f\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f\u2010-\u2027\u2030-\u205e\u20ac\u2122]"
)


# ---- tokens ------------------------------------------------------------------------------------------------


class Encoder:
    """Whole texts to ids. The library encodes each distinct piece once; a text is the sum of its pieces.

    Texts with a special token's own string, or with characters outside the blocks above, go to the library as
    they are.
    """

    def __init__(self, path: str, kind: str = "<u4") -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.kind = np.dtype(kind)

        self.tokenizer = Tokenizer.from_file(path)
        #: Whether the model's own spelling of an ASCII word is the word, its blank written as one letter.
        self.bytewise = self.tokenizer.normalizer is None and isinstance(self.tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def learn(self, pieces: set[str]) -> dict[str, bytes]:
        """The ids of each piece. Words with a blank before them are merged by the library's model as they are where
        they are ASCII. Others are encoded together: the blanks part them again, and the library says which token is
        of which word."""
        words = [p for p in pieces if p[0] == " " and p[1:].isalpha()]
        found = {p: self.whole(p) for p in pieces.difference(words)}
        if self.bytewise:
            merge = self.tokenizer.model.tokenize
            plain = [p for p in words if p.isascii()]
            found.update((p, np.asarray([t.id for t in merge(BLANK + p[1:])], self.kind).tobytes()) for p in plain)
            words = [p for p in words if p not in found]
        for at in range(0, len(words), 1000):
            some = words[at : at + 1000]
            encoding = self.tokenizer.encode("".join(some), add_special_tokens=False)
            ids, width = np.asarray(encoding.ids, self.kind).tobytes(), self.kind.itemsize
            cuts = np.flatnonzero(np.diff(np.asarray(encoding.word_ids))) * width + width
            edges = [0, *cuts.tolist(), len(ids)]
            found.update(zip(some, (ids[a:b] for a, b in zip(edges, edges[1:], strict=False)), strict=True))
        return found

    def ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned integers of the encoder's kind."""
        return self.batch([text])[0]

    def batch(self, texts: list[str]) -> list[bytes]:
        out: list = [None] * len(texts)
        split: dict[int, list[str]] = {}
        for i, text in enumerate(texts):
            if UNSURE.search(text) or any(s in text for s in self.specials):
                out[i] = self.whole(text)
            else:
                split[i] = (ASCII_PIECES if text.isascii() else PIECES).findall(text)
        known = self.known
        new = set().union(*split.values())
        fresh = new.difference(known)
        if len(known) + len(fresh) > REMEMBERED:
            known.clear()
            fresh = new
        known.update(self.learn(fresh))
        for i, pieces in split.items():
            out[i] = b"".join(map(known.__getitem__, pieces))
        for p in fresh:
            if len(p) > SHORT:
                del known[p]
        return out


@cache
def encoder(path: str, kind: str) -> Encoder:
    """One per Python worker, which serves task after task."""
    return Encoder(path, kind)


def encode(docs: DataFrame, tokenizer_path: str, end_id: int = 0, wide: bool = False) -> DataFrame:
    """doc_id, ids (binary, little-endian; 2 bytes an id, or 4 where ``wide``), the end id last."""
    kind = "<u4" if wide else "<u2"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        end = np.asarray([end_id], kind).tobytes()
        for batch in batches:
            for low in range(0, len(batch), 500):
                some = batch.iloc[low : low + 500]
                found = encoder(tokenizer_path, kind).batch([t if isinstance(t, str) else "" for t in some["text"]])
                yield pd.DataFrame({"doc_id": some["doc_id"].values, "ids": [x + end for x in found]})

    # Ids go through pandas as text, which keeps them whole beside a null one.
    found = docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(run, "doc_id string, ids binary")
    return found.select(F.col("doc_id").cast("long"), "ids")


def count_ids(encoded: DataFrame, wide: bool = False) -> DataFrame:
    """id, n over all documents: each task adds up its own before the shuffle."""
    kind = "<u4" if wide else "<u2"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            counted = np.bincount(np.frombuffer(b"".join(batch["ids"]), kind))
            if len(counted) > len(total):
                total = np.pad(total, (0, len(counted) - len(total)))
            total[: len(counted)] += counted
        (found,) = np.nonzero(total)
        yield pd.DataFrame({"id": found, "n": total[found]})

    return encoded.select("ids").mapInPandas(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


# ---- the code ----------------------------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits by package-merge; 0 for ids that do not occur."""
    lengths = np.zeros(len(counts), np.uint8)
    (used,) = np.nonzero(counts)
    n = len(used)
    if n <= 1:
        lengths[used] = 1
        return lengths
    if n > 1 << limit:
        raise ValueError(f"{n} symbols do not fit codes of {limit} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.float64)
    leaf_flags = []
    packages = np.empty(0)
    for _ in range(limit):
        merged = np.concatenate([weights, packages])
        order = np.argsort(merged, kind="stable")
        leaf_flags.append(order < n)
        merged = merged[order]
        merged = merged[: len(merged) // 2 * 2]
        packages = merged[0::2] + merged[1::2]
    chosen = 2 * (n - 1)
    depth = np.zeros(n, np.int64)
    for flags in reversed(leaf_flags):
        leaves = int(flags[:chosen].sum())
        depth[:leaves] += 1
        chosen = 2 * (chosen - leaves)
    lengths[used] = depth
    return lengths


class Code:
    """The canonical code of given lengths: shorter first, then by id."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.lengths = lengths
        (used,) = np.nonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        self.limit = limit = int(lengths.max(initial=1))
        spans = np.left_shift(1, limit - lengths[order].astype(np.int64))
        starts = np.cumsum(spans) - spans
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[order] = starts >> (limit - lengths[order].astype(np.int64))
        entries = (order.astype(np.uint32) << np.uint32(5)) | lengths[order].astype(np.uint32)
        self.table = np.zeros(1 << limit, np.uint32)
        self.table[: int(spans.sum())] = np.repeat(entries, spans)

    def encode(self, ids: np.ndarray, doc_ends: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Streams of consecutive documents, each from a byte on: the bytes, each document's first byte (and
        the end), and each token's bit position in its document's stream."""
        sizes = self.lengths[ids].astype(np.int64)
        if len(ids) and not sizes.all():
            raise ValueError("an id without a code")
        before = np.concatenate([[0], np.cumsum(sizes)])
        starts = np.concatenate([[0], doc_ends[:-1]]).astype(np.int64)
        bits = before[doc_ends] - before[starts]
        first_byte = np.concatenate([[0], np.cumsum((bits + 7) // 8)])
        within = before[:-1] - np.repeat(before[starts], doc_ends - starts)
        at = within + np.repeat(first_byte[:-1] * 8, doc_ends - starts)
        word = at >> 5
        shifted = self.codes[ids] << (64 - sizes - (at & 31)).astype(np.uint64)
        total = int(first_byte[-1]) // 4 + 2
        high = np.bincount(word, (shifted >> np.uint64(32)).astype(np.float64), total)
        high += np.bincount(word + 1, (shifted & np.uint64(0xFFFFFFFF)).astype(np.float64), total)
        return high.astype(np.uint32).astype(">u4").tobytes()[: int(first_byte[-1])], first_byte, within

    def decode(self, data: bytes, block_bits: np.ndarray, block_tokens: np.ndarray) -> np.ndarray:
        """All blocks' tokens in order, from their bit positions: one table entry per token, blocks abreast."""
        raw = np.frombuffer(data + b"\0" * 8, np.uint8).astype(np.uint32)
        words = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        order = np.argsort(-block_tokens, kind="stable")
        at = block_bits[order].astype(np.int64)
        target = (np.cumsum(block_tokens) - block_tokens)[order].astype(np.int64)
        left = block_tokens[order]
        out = np.empty(int(block_tokens.sum()), np.uint32)
        mask, room = np.uint32((1 << self.limit) - 1), 32 - self.limit
        active = np.searchsorted(-left, -np.arange(int(left.max(initial=0))), side="left")
        for step, n in enumerate(active):
            where = at[:n]
            entry = self.table[(words[where >> 3] >> (room - (where & 7)).astype(np.uint32)) & mask]
            out[target[:n] + step] = entry >> np.uint32(5)
            where += entry & np.uint32(31)
        return out


# ---- files -------------------------------------------------------------------------------------------------

MANIFEST = "part long, first_row long, file string, docs long, tokens long, bytes long"


def pack_footer(code: Code, doc_ids: list, tokens: np.ndarray, first_byte: np.ndarray, checks: np.ndarray) -> bytes:
    missing = np.asarray([x is None for x in doc_ids], np.uint8)
    arrays = {
        "lengths": code.lengths.astype("u1"),
        "missing": missing,
        "doc_ids": np.asarray([0 if x is None else x for x in doc_ids], "<i8"),
        "tokens": tokens.astype("<i8"),
        "first_byte": first_byte.astype("<i8"),
        "checks": checks.astype("<i8"),
    }
    head = json.dumps([[k, v.dtype.str, len(v)] for k, v in arrays.items()]).encode()
    body = zlib.compress(struct.pack("<I", len(head)) + head + b"".join(v.tobytes() for v in arrays.values()))
    return body + struct.pack("<Q", len(body)) + MAGIC


def read_footer(file) -> dict[str, np.ndarray]:
    size = file.size()
    file.seek(size - 12)
    tail = file.read(12)
    if tail[8:] != MAGIC:
        raise ValueError("not a file of this format")
    (length,) = struct.unpack("<Q", tail[:8])
    file.seek(size - 12 - length)
    body = zlib.decompress(file.read(length))
    (head,) = struct.unpack("<I", body[:4])
    at, arrays = 4 + head, {}
    for name, kind, n in json.loads(body[4 : 4 + head]):
        arrays[name] = np.frombuffer(body, kind, n, at)
        at += arrays[name].nbytes
    return arrays


def compress(encoded: DataFrame, lengths: np.ndarray, wide: bool = False, bounds: tuple = ()) -> DataFrame:
    """doc_id, tokens, checks (bit offsets of the blocks), bits: each document's own stream; and its part: how
    many of the ascending ``bounds`` are below its doc_id, -1 for a null doc_id."""
    kind = "<u4" if wide else "<u2"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = Code(lengths)
        for batch in batches:
            sizes = np.asarray([len(x) for x in batch["ids"]], np.int64) // np.dtype(kind).itemsize
            edges = [0, *np.flatnonzero(np.diff(np.cumsum(sizes) >> 21)) + 1, len(sizes)]
            for low, high in zip(edges, edges[1:], strict=False):
                if low == high:
                    continue
                part = batch.iloc[low:high]
                ends = np.cumsum(sizes[low:high])
                data, first, within = code.encode(np.frombuffer(b"".join(part["ids"]), kind), ends)
                starts = ends - sizes[low:high]
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"].values,
                        "tokens": sizes[low:high],
                        "checks": [within[a:b:BLOCK].astype("<i8").tobytes() for a, b in zip(starts, ends, strict=True)],
                        "bits": [data[a:b] for a, b in zip(first, first[1:], strict=False)],
                        "part": [bisect_left(bounds, int(x)) if isinstance(x, str) else -1 for x in part["doc_id"]],
                    }
                )

    found = encoded.select(F.col("doc_id").cast("string"), "ids").mapInPandas(
        run, "doc_id string, tokens long, checks binary, bits binary, part long"
    )
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def write_files(compressed: DataFrame, lengths: np.ndarray, folder: str, max_bytes: int = 64 << 20) -> DataFrame:
    """Files of about ``max_bytes``, in ascending doc_id order over ``part``, then ``first_row``; lazy.

    ``compressed`` has a column ``part``, whose ranges of doc_id do not overlap, and is sorted by part and doc_id
    within each partition.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = Code(lengths)
        out, part, row = None, None, 0
        task = TaskContext.get().partitionId()

        def close() -> pd.DataFrame:
            first = np.concatenate([[0], np.cumsum(sizes)])
            out.write(pack_footer(code, ids, np.asarray(tokens, np.int64), first, np.frombuffer(b"".join(checks), "<i8")))
            size = out.tell()
            out.close()
            return pd.DataFrame([[part, row - len(ids), path, len(ids), sum(tokens), size]], columns=FILE)

        for batch in batches:
            for doc_id, n, check, bits, now in batch.itertuples(index=False, name=None):
                if out is not None and (now != part or out.tell() >= max_bytes):
                    yield close()
                    out = None
                if out is None:
                    path = f"{folder}/{task:06d}-{uuid.uuid4().hex}.huf"
                    out, part, ids, tokens, checks, sizes = open_out(path), now, [], [], [], []
                    out.write(MAGIC)
                ids.append(int(doc_id) if isinstance(doc_id, str) else None)
                tokens.append(n)
                checks.append(check)
                sizes.append(len(bits))
                out.write(bits)
                row += 1
        if out is not None:
            yield close()

    return compressed.select(F.col("doc_id").cast("string"), "tokens", "checks", "bits", "part").mapInPandas(run, MANIFEST)


FILE = ["part", "first_row", "file", "docs", "tokens", "bytes"]


def read_files(files: DataFrame) -> DataFrame:
    """doc_id, start (tokens of all documents before it), ids (binary, 4 bytes each) of the files' documents;
    ``files`` has each file's path and its first document's ``start``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for path, start in (x for batch in batches for x in batch.itertuples(index=False, name=None)):
            with open_in(path) as file:
                foot = read_footer(file)
                code = Code(foot["lengths"])
                tokens = foot["tokens"]
                ends, blocks = np.cumsum(tokens), -(-tokens // BLOCK)
                edges = [0, *np.flatnonzero(np.diff(ends >> 21)) + 1, len(tokens)]
                block_ends = np.cumsum(blocks)
                for low, high in zip(edges, edges[1:], strict=False):
                    if low == high:
                        continue
                    first = foot["first_byte"][low : high + 1]
                    file.seek(len(MAGIC) + int(first[0]))
                    data = file.read(int(first[-1] - first[0]))
                    own = blocks[low:high]
                    bits = foot["checks"][block_ends[low] - blocks[low] : block_ends[high - 1]]
                    bits = bits + np.repeat((first[:-1] - first[0]) * 8, own)
                    sizes = np.full(int(own.sum()), BLOCK)
                    last = np.cumsum(own) - 1
                    sizes[last] = tokens[low:high] - (own - 1) * BLOCK
                    got = code.decode(data, bits, sizes).astype("<u4").tobytes()
                    stops = np.cumsum(tokens[low:high]) * 4
                    yield pd.DataFrame(
                        {
                            "doc_id": pd.array(
                                np.where(foot["missing"][low:high] == 1, None, foot["doc_ids"][low:high]), "Int64"
                            ),
                            "start": start + ends[low:high] - tokens[low:high],
                            "ids": [got[a:b] for a, b in zip(stops - tokens[low:high] * 4, stops, strict=True)],
                        }
                    )

    return files.select("file", "start").mapInPandas(run, "doc_id long, start long, ids binary")


def _vocabulary(tokenizer_path: str, end_id: int) -> int:
    """One more than the largest id that can come up."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True), end_id + 1)


def write_corpus(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0, limit: int = 16, wide: bool = False
) -> DataFrame:
    """The manifest (MANIFEST, and ``start``: tokens of all files before) of the corpus written below ``folder``.

    The driver holds a count per id of the vocabulary and a bound per part, neither of which grows with the
    rows of a part. What is shuffled into order are the compressed streams, not texts or ids.
    """
    spark = docs.sparkSession
    wide = wide or _vocabulary(tokenizer_path, end_id) > 1 << 16
    encoded, path = scratch(encode(docs, tokenizer_path, end_id, wide), "ids")
    counted = count_ids(encoded, wide).toPandas()
    counts = np.zeros(int(counted["id"].max()) + 1 if len(counted) else 1, np.int64)
    counts[counted["id"]] = counted["n"]
    lengths = code_lengths(counts, max(limit, int(np.count_nonzero(counts)).bit_length()))
    total = int(counts.sum())
    parts = total // PART + 1
    shares = [i / parts for i in range(1, parts)]
    found = encoded.stat.approxQuantile("doc_id", shares, 0.2 / parts) if shares else []
    bounds = tuple(sorted({int(x) for x in found}))
    ordered = (
        compress(encoded, lengths, wide, bounds)
        .repartitionById(len(bounds) + 2, F.col("part").cast("int") + 1)  # a part is a task
        .sortWithinPartitions("part", F.asc_nulls_first("doc_id"), "tokens", "bits")
    )
    files, _ = scratch(write_files(ordered, lengths, folder), "files")
    drop(spark, path)
    before = Window.orderBy("part", "first_row").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_corpus(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids of every document in the files."""
    read = read_files(manifest.repartition(max(1, manifest.count())))
    n_tokens = (F.length("ids") / 4).cast("long")
    return read.select("doc_id", "start", n_tokens.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"), "ids")
