"""LM scoring by Katz backoff: Good-Turing discounted bigrams over words, then unigrams, then one unknown word.

A token's probability is looked up recursively: the discounted share of its pair if the pair was seen; else the
backoff weight of the word before it times the unigram probability; an unknown word takes the mass that the
unigrams leave. Weights are exact: for every word before it, the probabilities of all known words, the end and
the unknown word add up to 1. Pairs are the highest order since at three words nearly every count is one.

Everything is counted over all rows. Documents are cut into batches (a batch ends after ``BATCH`` tokens; a longer
text is one batch); each keeps its distinct words and its tokens as places among them. Batches send distinct words
and pairs to buckets, whose number grows with the tokens; buckets add up and answer each batch. Pairs of a frequent
first word are spread over as many buckets as its count asks for; one row per batch stands for a repeated pair,
so a hot word or pair is added up before it is shuffled. Batches are files of the shared folder, read by whoever
works on them and not shuffled; tables beside them hold word counts and pair counts.

Words are known by 64-bit digests: two different words meet with a chance of about 3 in 10^8 per million words.

Defined results: null text is an empty one, whose only token is the end. Documents that do not train
(``train`` false or null) are scored alike; rows that repeat an id are scored each by itself and learned from each.
With nothing to learn from, the only probability is that of the unknown word, 1. An empty table gives an empty one.
Columns other than those named are not read.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.llm.common import drop, open_in, open_out, run_folder, scratch

BATCH = 1_000_000  # tokens
BUCKET = 1_000_000  # tokens for each bucket
SPLIT = 50_000  # pairs of a first word in one bucket
COUNTED = 5  # counts up to this are discounted
START = np.uint64(0x9E3779B97F4A7C15)  # the word before the first
END = "\n"  # no word holds a line end
WORDS, PAIRS, CONTEXTS, HOME = range(4)

_LETTER = "to long, kind int, sender long, payload binary, stats array<long>"


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as planes of their bytes, compressed: high bytes of small numbers are runs of zeros."""
    planes = [(a.dtype.str, len(a), a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()) for a in map(np.ascontiguousarray, arrays)]
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(planes, protocol=5))


def unpack(payload: bytes) -> list[np.ndarray]:
    found = []
    for kind, n, planes in pickle.loads(zstandard.ZstdDecompressor().decompress(payload)):
        size = np.dtype(kind).itemsize
        found.append(np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, n).T).view(kind).reshape(n))
    return found


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit digest of two."""
    x = (a * np.uint64(0xBF58476D1CE4E5B9)) ^ (b + (a >> np.uint64(29)))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def tokenize(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Tokens per text with its end, distinct tokens (the end is the last), and each token's place among them."""
    texts = pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    parts = pc.ascii_split_whitespace(texts)
    flat, owner = pc.list_flatten(parts), pc.list_parent_indices(parts)
    full = pc.not_equal(flat, "")  # edges leave empty words behind
    flat, owner = flat.filter(full), owner.filter(full).to_numpy(zero_copy_only=False)
    coded = pc.dictionary_encode(flat)
    words = np.bincount(owner, minlength=len(texts))
    names = [*coded.dictionary.to_pylist(), END]
    places = np.insert(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(words), len(names) - 1)
    return words + 1, names, places


def discounts(n: np.ndarray) -> np.ndarray:
    """Katz's factor for each count from 0 to COUNTED, from the numbers of types with counts 1 .. COUNTED + 1.

    Where those numbers are too few or uneven to give a falling estimate, half a count is taken off instead.
    """
    n = np.asarray(n, float)
    r = np.arange(1, COUNTED + 1)
    factor = (r - 0.5) / r
    if n.min() > 0:
        cut = (COUNTED + 1) * n[COUNTED] / n[0]
        turing = (r + 1) * n[1:] / (n[:-1] * r)
        if cut < 1:
            katz = (turing - cut) / (1 - cut)
            if ((katz > 0) & (katz < 1)).all():
                factor = katz
    return np.concatenate([[0.0], factor])


def discounted(c: np.ndarray, factor: np.ndarray) -> np.ndarray:
    c = np.asarray(c)
    return c * np.where(c > COUNTED, 1.0, factor[np.minimum(c, COUNTED)])


def _home(rows: pa.Table) -> tuple[int, bytes]:
    """One batch: ids, whether they train, tokens of each; digests of distinct words; places of tokens."""
    lengths, names, places = tokenize(rows["text"].combine_chunks() if rows.num_rows else rows["text"])
    digests = np.fromiter((xxhash.xxh3_64_intdigest(w.encode()) for w in names), np.uint64, len(names))
    ids = rows["doc_id"]
    return len(places), pack(
        pc.fill_null(ids, 0).to_numpy().astype(np.int64),
        ids.is_null().to_numpy(),
        pc.fill_null(rows["train"], False).to_numpy().astype(bool),
        lengths.astype(np.int32),
        np.concatenate([digests, [START]]),
        places.astype(np.int32),
    )


def batches(docs: DataFrame, folder: str) -> DataFrame:
    """batch, tokens and file (below ``folder``) of the documents (doc_id, text, train)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, size = TaskContext.get().partitionId() << 33, [], 0

        def cut() -> pa.RecordBatch:
            n, payload = _home(pa.Table.from_batches(held))
            file = f"{folder}/{uuid.uuid4().hex}"  # a task that is run again writes files of its own
            with open_out(file) as out:
                out.write(payload)
            return pa.RecordBatch.from_pydict({"batch": pa.array([number], pa.int64()), "tokens": pa.array([n], pa.int64()), "file": [file]})

        for part in parts:
            sizes = pc.fill_null(pc.binary_length(part["text"]), 0).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.diff(np.cumsum(sizes) // (6 * BATCH), prepend=0))
            for start, end in zip([0, *edges], [*edges, len(part)]):
                held.append(part.slice(start, end - start))
                size += int(sizes[start:end].sum())
                if size >= 6 * BATCH:
                    yield cut()
                    number, held, size = number + 1, [], 0
        if sum(map(len, held)):
            yield cut()

    return docs.select(F.col("doc_id").cast("long"), "text", "train").mapInArrow(run, "batch long, tokens long, file string")


class _Batch:
    def __init__(self, file: str):
        with open_in(file) as stored:
            self.ids, self.no_id, self.train, self.lengths, self.words, self.places = unpack(stored.read())
        self.learns = np.repeat(self.train, self.lengths)

    def by_bucket(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """The order in which words are sent, and the bucket of each so ordered."""
        bucket = (self.words % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        return order, bucket[order]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs as places of both words, and the place of each token's pair among them."""
        size = len(self.words)
        before = np.empty(len(self.places), np.int64)
        before[1:] = self.places[:-1]
        before[(np.cumsum(self.lengths) - self.lengths).astype(np.int64)] = size - 1
        both, place = np.unique(before * size + self.places, return_inverse=True)
        return both // size, both % size, place

    def pair_order(self, first: np.ndarray, second: np.ndarray, c: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        starts = c.copy()
        starts[-1] = c[-2]  # as many documents begin as end
        pieces = (1 + starts[first] // SPLIT).astype(np.uint64)
        h1, h2 = self.words[first], self.words[second]
        bucket = (_mix(h1, h2 % pieces) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((h1, bucket))
        return order, bucket[order]


def _letters(order: np.ndarray, bucket: np.ndarray, kind: int, sender: int, *columns: np.ndarray) -> pd.DataFrame:
    """One row per bucket with its part of the columns."""
    to, starts = np.unique(bucket, return_index=True)
    ends = np.append(starts[1:], len(bucket))
    parts = [pack(*(c[order[a:b]] for c in columns)) for a, b in zip(starts, ends)]
    return pd.DataFrame({"to": to, "kind": kind, "sender": sender, "payload": parts, "stats": None})


def _answers(letters: pd.DataFrame, sizes: list[int], kind: int, *columns: np.ndarray) -> list[tuple]:
    ends = np.cumsum(sizes)
    own = int(letters["to"].iloc[0]) if len(letters) else 0
    return [
        (int(sender), kind, own, pack(*(c[end - size : end] for c in columns)), None)
        for sender, size, end in zip(letters["sender"], sizes, ends)
    ]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["to", "kind", "sender", "payload", "stats"])


def _number_of_counts(c: np.ndarray) -> list[int]:
    """Types seen, tokens, and types seen 1 .. COUNTED + 1 times."""
    spread = np.bincount(np.minimum(c, COUNTED + 2), minlength=COUNTED + 3)
    return [int((c > 0).sum()), int(c.sum()), *map(int, spread[1 : COUNTED + 2])]


def _add_words(letters: pd.DataFrame) -> pd.DataFrame:
    parts = [unpack(p) for p in letters["payload"]]
    _, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    c = np.bincount(place, np.concatenate([p[1] for p in parts])).astype(np.int64)
    rows = _answers(letters, [len(p[0]) for p in parts], WORDS, c[place])
    return _frame([*rows, (-1, WORDS, -1, None, _number_of_counts(c))])


def _add_pairs(buckets: int, letters: pd.DataFrame) -> pd.DataFrame:
    parts = [unpack(p) for p in letters["payload"]]
    h1, h2, n, seconds = (np.concatenate([p[i] for p in parts]) for i in range(4))
    _, at, place = np.unique(_mix(h1, h2), return_index=True, return_inverse=True)
    c = np.bincount(place, n).astype(np.int64)
    rows = _answers(letters, [len(p[0]) for p in parts], PAIRS, c[place])
    seen = c > 0
    firsts, who = np.unique(h1[at[seen]], return_inverse=True)
    sums = []  # per first word: pairs and second words by count, and the sum of the higher counts
    for counts in (c[seen], seconds[at[seen]].astype(np.int64)):
        sums += [np.bincount(who, counts == r, len(firsts)) for r in range(1, COUNTED + 1)]
        sums.append(np.bincount(who, counts * (counts > COUNTED), len(firsts)))
    sent = (firsts % np.uint64(buckets)).astype(np.int64)
    out = _letters(np.argsort(sent, kind="stable"), np.sort(sent), CONTEXTS, -1, firsts, *(s.astype(np.int64) for s in sums))
    return pd.concat([_frame([*rows, (-1, PAIRS, -1, None, _number_of_counts(c))]), out])


def weights(sums: np.ndarray, pairs: np.ndarray, unigrams: np.ndarray, tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """The divisor of each first word's pairs, and its backoff weight, from its twelve sums."""
    r = np.arange(1, COUNTED + 1)
    own, other = sums[: COUNTED + 1], sums[COUNTED + 1 :]
    count = r @ own[:COUNTED] + own[COUNTED]
    kept = (r * pairs[1:]) @ own[:COUNTED] + own[COUNTED]
    divisor = np.where(kept < count, count, count + 1)  # some mass is left in any case
    lower = ((r * unigrams[1:]) @ other[:COUNTED] + other[COUNTED]) / tokens
    return divisor, (1 - kept / divisor) / (1 - lower)


def _answer_contexts(pair_factor: np.ndarray, word_factor: np.ndarray, divisor: int, letters: pd.DataFrame) -> pd.DataFrame:
    asked = letters[letters["kind"] == WORDS]
    sent = [unpack(p) for p in letters.loc[letters["kind"] == CONTEXTS, "payload"]]
    requests = [unpack(p)[0] for p in asked["payload"]]
    if not requests:
        return _frame([])
    wanted = np.concatenate(requests)
    below, weight = np.ones(len(wanted)), np.ones(len(wanted))
    if sent:
        firsts, place = np.unique(np.concatenate([s[0] for s in sent]), return_inverse=True)
        sums = np.stack([np.bincount(place, np.concatenate([s[i] for s in sent])) for i in range(1, 2 * COUNTED + 3)])
        own, backoff = weights(sums, pair_factor, word_factor, divisor)
        at = np.minimum(np.searchsorted(firsts, wanted), len(firsts) - 1)
        known = firsts[at] == wanted
        below[known], weight[known] = own[at[known]], backoff[at[known]]
    return _frame(_answers(asked, [len(r) for r in requests], CONTEXTS, below, weight))


def _collected(rows: pd.DataFrame, kind: int, i: int = 0) -> np.ndarray:
    """The answers to a batch, in the order in which it asked."""
    own = rows[rows["kind"] == kind].sort_values("sender")["payload"]
    return np.concatenate([unpack(p)[i] for p in own])


def _ordered(order: np.ndarray, values: np.ndarray) -> np.ndarray:
    found = np.empty_like(values)
    found[order] = values
    return found


def _stats(answers: DataFrame) -> list[int]:
    """The sums over all buckets: eight numbers."""
    found = answers.filter("to = -1").select(F.posexplode("stats").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v"))
    sums = [0] * (COUNTED + 3)
    for i, v in found.collect():
        sums[i] = v
    return sums


def score(docs: DataFrame) -> DataFrame:
    """doc_id, train, n_tokens, n_known, train_tokens, base_score and score of every row of docs (doc_id, text, train)."""
    spark = docs.sparkSession
    folder = run_folder(spark, "katz")
    home, home_path = scratch(batches(docs, folder), "katz-batches")
    tokens = home.agg(F.sum("tokens")).first()[0] or 0
    buckets = max(1, -(-tokens // BUCKET))
    letter = home.select(
        F.col("batch").alias("to"),
        F.lit(HOME).alias("kind"),
        F.lit(-1).cast("long").alias("sender"),
        F.col("file").cast("binary").alias("payload"),
        F.lit(None).cast("array<long>").alias("stats"),
    )

    def send_words(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for number, file in zip(part["batch"], part["file"]):
                batch = _Batch(file)
                order, bucket = batch.by_bucket(buckets)
                n = np.bincount(batch.places[batch.learns], minlength=len(batch.words))
                yield _letters(order, bucket, WORDS, int(number), batch.words, n.astype(np.int32))

    asked = home.mapInPandas(send_words, _LETTER)
    words, words_path = scratch(asked.groupBy("to").applyInPandas(_add_words, _LETTER), "katz-words", "none")
    types, train_tokens, *spread = _stats(words)
    word_factor = discounts(spread)
    r = np.arange(1, COUNTED + 1)
    kept = train_tokens - float((r * (1 - word_factor[1:])) @ spread[:COUNTED])
    divisor = train_tokens if kept < train_tokens else train_tokens + 1

    def send_pairs(rows: pd.DataFrame) -> pd.DataFrame:
        batch = _Batch(rows.loc[rows["kind"] == HOME, "payload"].iloc[0].decode())
        c = _ordered(batch.by_bucket(buckets)[0], _collected(rows, WORDS))
        first, second, place = batch.pairs()
        order, bucket = batch.pair_order(first, second, c, buckets)
        n = np.bincount(place[batch.learns], minlength=len(first)).astype(np.int32)
        return _letters(order, bucket, PAIRS, int(rows["to"].iloc[0]), batch.words[first], batch.words[second], n, c[second])

    told = words.filter("to >= 0")
    sent = letter.unionByName(told).groupBy("to").applyInPandas(send_pairs, _LETTER)

    def add_pairs(letters: pd.DataFrame) -> pd.DataFrame:
        return _add_pairs(buckets, letters)

    pairs, pairs_path = scratch(sent.groupBy("to").applyInPandas(add_pairs, _LETTER), "katz-pairs", "none")
    pair_factor = discounts(_stats(pairs)[2:])

    def answer_contexts(letters: pd.DataFrame) -> pd.DataFrame:
        return _answer_contexts(pair_factor, word_factor, divisor, letters)

    contexts = asked.unionByName(pairs.filter(F.col("kind") == CONTEXTS)).groupBy("to").applyInPandas(answer_contexts, _LETTER)

    def evaluate(rows: pd.DataFrame) -> pd.DataFrame:
        batch = _Batch(rows.loc[rows["kind"] == HOME, "payload"].iloc[0].decode())
        order = batch.by_bucket(buckets)[0]
        c = _ordered(order, _collected(rows, WORDS))
        first, second, place = batch.pairs()
        pair_order = batch.pair_order(first, second, c, buckets)[0]
        c2 = _ordered(pair_order, _collected(rows, PAIRS))
        below, weight = (_ordered(order, _collected(rows, CONTEXTS, i)) for i in (0, 1))
        p1 = np.where(c > 0, discounted(c, word_factor), divisor - kept) / divisor
        p2 = np.where(c2 > 0, discounted(c2, pair_factor) / below[first], weight[first] * p1[second])
        base = np.log10((c + 0.5) / (train_tokens + 0.5 * (types + 1)))
        starts = (np.cumsum(batch.lengths) - batch.lengths).astype(np.int64)
        return pd.DataFrame(
            {
                "doc_id": pd.array(np.where(batch.no_id, 0, batch.ids), "Int64").copy(),
                "no_id": batch.no_id,
                "train": batch.train,
                "n_tokens": batch.lengths.astype(np.int64),
                "n_known": np.add.reduceat((c > 0)[batch.places].astype(np.int64), starts),
                "base_score": np.add.reduceat(base[batch.places], starts),
                "score": np.add.reduceat(np.log10(p2)[place], starts),
            }
        )

    told = told.unionByName(pairs.filter(F.col("kind") == PAIRS).filter("to >= 0")).unionByName(contexts)
    schema = "doc_id long, no_id boolean, train boolean, n_tokens long, n_known long, base_score double, score double"
    found, _ = scratch(letter.unionByName(told).groupBy("to").applyInPandas(evaluate, schema), "katz-scores")
    for path in (home_path, folder, words_path, pairs_path):
        drop(spark, path)
    return found.select(
        F.expr("if(no_id, null, doc_id)").alias("doc_id"),
        "train",
        "n_tokens",
        "n_known",
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
