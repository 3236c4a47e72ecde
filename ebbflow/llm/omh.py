"""Near duplicates by order MinHash, verified by banded alignment.

A text is its words (runs of letters and digits in lower case), told apart by 64-bit hashes. Equal word sequences are
one node, whoever has the smallest doc_id. A node's k-mers (five words), each labelled with how many equal ones came
before it, are hashed; each of ``bands`` hash functions picks the ``picks`` smallest and keeps them in text order, so
that the sketch depends on order, as edit distance does; ``singles`` more pick one. Nodes that share a sketch meet in a
bucket.

In a bucket each node is first compared with the bucket's smallest node, by the edit distance of their words: few edits
are found along the diagonals, more in a band that widens until it holds the distance or passes the bound. Nodes found unlike the leader stay together and
choose a new leader, as long as a tenth of the comparisons link. Classes are the components of the links.

Buckets that then still hold nodes of different classes are parted by an exact rule. An edit takes two pairs of
neighbouring words at most, so near texts share all but two fifths of the longer one's pairs, and in any one order of
all pairs the first two fifths of each, and c pairs more, have c pairs in common: ``common``, or for long texts one for
``each`` words. All nodes of such buckets, those of the leader's class as well, meet in these pairs, rare ones first;
whoever shares enough of them, is of another class and not too long is compared. So do all texts of up to ``short``
words, whose sketches rarely agree, and the longer ones that may be near these. How rare a pair is, is told by how
often its words occur, but for pairs seen far more often than that (of passages that many texts hold), which are counted.

No texts are moved for a comparison that counts of words, in MARKS counters a node, show to be in vain: words that one
of two texts has more often cost an edit each.

Two texts are near when 1 - distance / length of the longer is at least ``similarity``.

Defined results: null texts and texts without a word are copies of each other. Rows that repeat a doc_id are one
document, with the least of their texts. Rows with a null doc_id get the class of their copies, or null. Other columns stay out.
"""

from __future__ import annotations

import hashlib
import uuid
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.llm.common import materialized, one_row_per_id
from ebbflow.llm.graph import components
from ebbflow.llm.workspace import Workspace

SKETCHED = 50_000
# Of all texts' words, the share that the pairs of one slice of an alignment may bring to the shuffle.
SLICE = 0.5
COUNTERS = 1 << 19  # of words, for an order of them
BLOCK = 1 << 21  # words whose runs are counted together
# Runs are counted where a block has them so many times as often as their words let expect; those that come so often
# in all are looked up in a table of so many at most.
EXCESS, FREQUENT, LISTED = 4, 16, 1 << 18
MARKS = 256  # counters of a node's words, a byte each


@dataclass(frozen=True)
class Settings:
    k: int = 5
    bands: int = 24
    picks: int = 2
    singles: int = 20  # more bands, of one pick
    similarity: float = 0.8
    short: int = 20
    common: int = 3
    each: int = 20

    @property
    def run(self) -> int:
        """How many neighbouring words texts meet in: pairs, unless edits may take all pairs of near texts."""
        return 2 if self.similarity >= 0.75 else 1


# ---- sketches ----------------------------------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = np.uint64(0x9E3779B97F4A7C13)


@cache
def _characters() -> np.ndarray:
    """A number for each character that is in words, as for \\w (letters, digits and the underscore); zero for others."""
    inside = np.fromiter((c.isalnum() or c == "_" for c in map(chr, range(0x110000))), bool, 0x110000)
    return np.where(inside, _mixed(np.arange(1, 0x110001, dtype=np.uint64) * _BASE), np.uint64(0))


@cache
def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, _BASE)]))


def words_of(text: str | None) -> np.ndarray:
    """64-bit hashes of the words of a text, in order: polynomials of their characters in lower case, mixed."""
    if not isinstance(text, str):
        return np.empty(0, np.uint64)
    text = text.lower()
    if text.isascii():
        codes = np.frombuffer(text.encode(), np.uint8)
    else:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    found = _characters()[codes]
    inside = found != 0
    found = found[inside]
    if not len(found):
        return np.empty(0, np.uint64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = np.flatnonzero(first[inside])
    sizes = np.diff(starts, append=len(found))
    powers = _powers(1 << int(sizes.max()).bit_length())
    at = np.arange(len(found)) - np.repeat(starts, sizes)
    return _mixed(np.add.reduceat(found * powers[at], starts))


def kmers(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of k words; of the whole where it is shorter."""
    k = min(k, len(hashes))
    total = np.zeros(len(hashes) - k + 1, np.uint64)
    for i in range(k):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - k + 1 + i]
    return _mixed(total)


def labelled(found: np.ndarray) -> np.ndarray:
    """K-mer hashes mixed with the number of equal ones before."""
    if not len(found):
        return found
    run = np.sort(found)
    if (run[1:] != run[:-1]).all():
        return found
    order = np.argsort(found, kind="stable")
    first = np.concatenate([[True], run[1:] != run[:-1]])
    starts = np.maximum.accumulate(np.where(first, np.arange(len(run)), 0))
    before = np.empty(len(run), np.uint64)
    before[order] = np.arange(len(run)) - starts
    return np.where(before > 0, _mixed(found + before * np.uint64(0xD1342543DE82EF95)), found)


@cache
def _factors(bands: int) -> np.ndarray:
    return _mixed(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def sketch(hashes: np.ndarray, settings: Settings) -> np.ndarray:
    """One signed 64-bit value per band; none for a text without words."""
    if not len(hashes):
        return np.empty(0, np.int64)
    plain = kmers(hashes, settings.k)
    ranked = labelled(plain)
    bands = settings.bands + settings.singles
    factors = _factors(bands)
    step = max(1, (1 << 21) // len(ranked))  # bands at once, so that very long texts take bounded memory
    out = []
    for start, stop, picks in ((0, settings.bands, settings.picks), (settings.bands, bands, 1)):
        for low in range(start, stop, step):
            some = factors[low : min(low + step, stop)]
            keys = ranked[None, :] * some[:, None]
            rows = np.arange(len(keys))
            picked = []
            for left in reversed(range(min(picks, len(ranked)))):
                at = keys.argmin(1)
                picked.append(at)
                if left:
                    keys[rows, at] = np.uint64(0xFFFFFFFFFFFFFFFF)
            chosen = plain[np.sort(np.stack(picked, 1), axis=1)]
            value = some.copy()
            for i in range(chosen.shape[1]):
                value = _mixed(value * np.uint64(31) + chosen[:, i])
            out.append(value)
    return np.concatenate(out).view(np.int64)


def mark(hashes: np.ndarray) -> bytes:
    """How many words fall to each of MARKS counters, up to 255."""
    found = np.bincount((hashes & np.uint64(MARKS - 1)).astype(np.int64), minlength=MARKS)
    return np.minimum(found, 255).astype(np.uint8).tobytes()


def least_distances(a: pd.Series, b: pd.Series) -> np.ndarray:
    """What the edit distance of two texts is at least, by their marks."""
    left, right = (np.frombuffer(b"".join(m), np.uint8).reshape(-1, MARKS).astype(np.int16) for m in (a, b))
    more = left - right
    over = np.maximum(more, 0).sum(1, dtype=np.int64)
    return np.maximum(over, over - more.sum(1, dtype=np.int64))


def sketches(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, digest (of the word sequence), n_words, mark, sketch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done: dict[bytes, tuple[bytes, np.ndarray]] = {}  # copies in one task are sketched once
        for batch in batches:
            rows = []
            if len(done) > SKETCHED:
                done.clear()
            for doc_id, text in zip(batch["id"], batch["text"], strict=True):
                words = words_of(text)
                digest = hashlib.blake2b(words.tobytes(), digest_size=16).digest()
                if digest not in done:
                    done[digest] = mark(words), sketch(words, settings)
                rows.append((doc_id, digest, len(words), *done[digest]))
            yield pd.DataFrame(rows, columns=["id", "digest", "n_words", "mark", "sketch"])

    # As text: pandas would make floats of all ids of a batch that has a null one.
    named = docs.select(F.col("doc_id").cast("string").alias("id"), "text")
    found = named.mapInPandas(run, "id string, digest binary, n_words int, mark binary, sketch array<long>")
    return found.select(F.col("id").cast("long").alias("doc_id"), "digest", "n_words", "mark", "sketch")


# ---- alignment ---------------------------------------------------------------------------------------------


def _in_band(a: list, b: list, d: int) -> int:
    """Edit distance if it is at most d, else something above d; len(a) >= len(b), d < len(a).

    Bit-parallel: bit i of a column's window of 2d + 1 rows tells how a cell differs from the one above it; the
    window goes down one row with every column.
    """
    where: dict = {}
    for i, x in enumerate(a):
        where.setdefault(x, []).append(i)
    width = 2 * d + 1
    mask = (1 << width) - 1
    up, down = mask & ~((1 << d) - 1), 0
    last = 1 << (width - 1)
    distance = d
    diagonal = len(a) - d
    bound = d + len(b) - diagonal
    flat = last >> 1
    for j, x in enumerate(b):
        low = j - d
        same = 0
        if (at := where.get(x)) is not None:
            for i in at[bisect_left(at, low) :]:
                if i >= low + width:
                    break
                same |= 1 << (i - low)
        zero = ((((same & up) + up) ^ up) | same | down) & mask
        right = (down | ~(zero | up)) & mask
        left = zero & up
        if j < diagonal:
            distance += not zero & last
        else:
            distance += bool(right & flat) - bool(left & flat)
            flat >>= 1
        if distance > bound:
            return d + 1
        up = (left | ~((zero >> 1) | right)) & mask
        down = (zero >> 1) & right
    return distance


def _equal_to(a: list, i: int, b: list, j: int) -> int:
    """Where in ``a`` the run of equal items from a[i] and b[j] on ends."""
    step = 4
    while (x := a[i : i + step]) == (y := b[j : j + step]):
        i, j = i + len(x), j + len(x)
        if len(x) < step:
            return i
        step *= 2
    for p, q in zip(x, y):
        if p != q:
            break
        i += 1
    return i


def _by_diagonals(a: list, b: list, most: int) -> int | None:
    """Edit distance if it is at most ``most``, by the furthest places that so many edits reach on each diagonal."""
    n, m = len(a), len(b)
    goal = m - n
    none = -n - m - 2
    reach = {0: _equal_to(a, 0, b, 0)}
    if goal == 0 and reach[0] == n:
        return 0
    for edits in range(1, most + 1):
        left = most - edits
        after = {}
        for k in range(max(-edits, goal - left), min(edits, goal + left) + 1):
            i = max(reach.get(k, none) + 1, reach.get(k - 1, none), reach.get(k + 1, none) + 1)
            i = min(i, n, m - k)
            if i < 0:
                continue
            if i < n and i + k < m and a[i] == b[i + k]:
                i = _equal_to(a, i, b, i + k)
            after[k] = i
        if after.get(goal) == n:
            return edits
        reach = after
    return None


def distance_within(a: list, b: list, most: int) -> int | None:
    """The edit distance of two sequences if it is at most ``most``, else None; the band widens up to there."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > most:
        return None
    if not b:
        return len(a)
    # Each word of the longer one that the other lacks costs an edit.
    lacking = len(a) - sum((Counter(a) & Counter(b)).values())
    if lacking > most:
        return None
    few = min(most, 2 * isqrt(len(a)) + 8)  # about as dear as one band
    if lacking <= few:
        found = _by_diagonals(a, b, few)
        if found is not None or few == most:
            return found
    d = max(24, lacking)
    while True:
        d = min(d, most, len(a) - 1)
        found = _in_band(a, b, d)
        if found <= d:
            return found
        if d == len(a) - 1:
            return len(a) if len(a) <= most else None
        if d == most:
            return None
        d *= 3


def align(pairs: DataFrame, texts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """a, b, distance, similarity of those pairs (a, b: nodes) that are similar enough; ``texts``: node, text.

    Both texts of a pair come by joins. Where texts are bucketed by node, only the pairs are shuffled for the first
    of them, and the pairs with one text for the second.
    """
    both = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b").join(
        texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a"
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, left = None, []
        for batch in batches:
            found = []
            for a, b, text_a, text_b in batch.itertuples(index=False, name=None):
                if a != last:
                    last, left = a, words_of(text_a).tolist()
                right = words_of(text_b).tolist()
                longer = max(len(left), len(right))
                most = int(longer * (1 - settings.similarity) + 1e-9)
                distance = distance_within(left, right, most)
                if distance is not None:
                    found.append((a, b, distance, 1 - distance / longer))
            yield pd.DataFrame(found, columns=["a", "b", "distance", "similarity"])

    return both.select("a", "b", "text_a", "text_b").mapInPandas(
        run, "a long, b long, distance long, similarity double"
    )


def likely(pairs: DataFrame, texts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """a, b of the pairs whose lengths may be near, and ``likely``: whether their marks (texts: node, n_words, mark)
    leave it open that they are similar enough."""
    facts = [texts.select(F.col("node").alias(x), F.col("n_words").alias(f"{x}_words"), F.col("mark").alias(f"{x}_mark")) for x in "ab"]
    both = pairs.join(facts[1], "b").join(facts[0], "a").filter(~_apart("a_words", "b_words", settings))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            most = (batch[["a_words", "b_words"]].max(axis=1) * (1 - settings.similarity) + 1e-9).astype(int)
            batch["likely"] = least_distances(batch["a_mark"], batch["b_mark"]) <= most
            yield batch[["a", "b", "likely"]]

    return both.mapInPandas(run, "a long, b long, likely boolean")


# ---- classes -----------------------------------------------------------------------------------------------


def _classed(rows: DataFrame, classes: DataFrame | None, node: str) -> DataFrame:
    """rows with the class of ``node`` (itself where it is linked to nothing smaller)."""
    if classes is None:
        return rows.withColumn(f"{node}_class", F.col(node))
    found = classes.select(F.col("node").alias(node), F.col("class").alias("_class"))
    return rows.join(found, node, "left").withColumn(f"{node}_class", F.coalesce("_class", node)).drop("_class")


def _apart(a: str, b: str, settings: Settings):
    """Whether two lengths differ by too much for any similar pair."""
    longer = F.greatest(a, b)
    return F.abs(F.col(a) - F.col(b)) > longer * (1 - settings.similarity) + 1e-9


@dataclass(frozen=True)
class Counts:
    """How often words fall to each of COUNTERS counters, and how often the runs of words that are more frequent than
    their words let expect were seen, by their hashes in order."""

    words: np.ndarray
    whole: int  # words in all
    runs: np.ndarray
    seen: np.ndarray


def _expected(often: np.ndarray, size: int, whole: int) -> np.ndarray:
    """How often the runs of ``size`` words are to be expected among ``whole`` words, by how often each word occurs."""
    out = often[: len(often) - size + 1].astype(np.float64)
    for i in range(1, size):
        out *= often[i : len(often) - size + 1 + i] / max(1, whole)
    return out


def _tallied(texts: list[np.ndarray], size: int) -> pd.DataFrame:
    """run, at, n of a block of texts: of words by counters, and of the runs that are unexpectedly frequent by hashes."""
    together = np.concatenate(texts)
    at = (together & np.uint64(COUNTERS - 1)).astype(np.int64)
    total = np.bincount(at, minlength=COUNTERS)
    starts = np.cumsum([0, *map(len, texts)])
    long = [(t, total[at[i : i + len(t)]]) for t, i in zip(texts, starts, strict=False) if len(t) >= size > 1]
    parts = [pd.DataFrame({"run": False, "at": (some := np.flatnonzero(total)), "n": total[some]})]
    if long:
        found, first, n = np.unique(np.concatenate([labelled(kmers(t, size)) for t, _ in long]), return_index=True, return_counts=True)
        expected = np.concatenate([_expected(often, size, len(together)) for _, often in long])[first]
        odd = (n > 1) & (n > EXCESS * expected)
        parts.append(pd.DataFrame({"run": True, "at": found[odd].view(np.int64), "n": n[odd]}))
    return pd.concat(parts)


def counts_of(texts: DataFrame, work: Workspace, settings: Settings = Settings()) -> Counts:
    """Counts of the words of texts and of their frequent runs: by tasks, added up by Spark."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for batch in batches:
            for text in batch["text"]:
                held.append(words_of(text))
                n += len(held[-1])
                if n >= BLOCK:
                    yield _tallied(held, settings.run)
                    held, n = [], 0
        if held:
            yield _tallied(held, settings.run)

    tallied = texts.select("text").mapInPandas(run, "run boolean, at long, n long")
    found = work.keep(tallied.groupBy("run", "at").agg(F.sum("n").alias("n")).filter(f"NOT run OR n >= {FREQUENT}"))
    words = found.filter("NOT run").select("at", "n").toPandas()  # at most COUNTERS rows
    out = np.zeros(COUNTERS, np.int64)
    out[words["at"].to_numpy(np.int64)] = words["n"].to_numpy(np.int64)
    runs = found.filter("run")
    sizes = runs.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).count().collect()
    least = 0
    while sum(n for power, n in sizes if power >= least) > LISTED:
        least += 1
    listed = runs.filter(F.col("n") >= (1 << least)).select("at", "n").toPandas()
    hashes = listed["at"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return Counts(out, int(out.sum()), hashes[order], listed["n"].to_numpy(np.float64)[order])


def _common(n_words: int, settings: Settings) -> int:
    """How many runs near texts of at least so many words must share among their first."""
    return max(settings.common, n_words // settings.each)


def first_runs(words: np.ndarray, counts: Counts, settings: Settings) -> np.ndarray:
    """Of a text's runs of words the rarest, as many as any near text must share ``_common`` of. Any order of all runs
    is exact; this one is by counts, then by hash. Runs with a word that occurs nowhere else stay out."""
    if not len(words):
        return words.view(np.int64)
    size = min(settings.run, len(words))
    often = counts.words[(words & np.uint64(COUNTERS - 1)).astype(np.int64)]
    seen = _expected(often, size, counts.whole)
    least = often[: len(often) - size + 1]
    for i in range(1, size):
        least = np.minimum(least, often[i : len(often) - size + 1 + i])
    grams = labelled(kmers(words, size))
    if len(counts.runs):
        at = np.minimum(np.searchsorted(counts.runs, grams), len(counts.runs) - 1)
        seen = np.where(counts.runs[at] == grams, np.maximum(seen, counts.seen[at]), seen)
    keep = settings.run * int(len(words) * (1 - settings.similarity) + 1e-9) + _common(len(words), settings) + settings.run - 1
    if keep < len(grams):  # the rarest, and all that are as rare as the last of them
        rare = seen <= np.partition(seen, keep - 1)[keep - 1]
        grams, seen, least = grams[rare], seen[rare], least[rare]
    order = np.lexsort((grams, seen))[:keep]
    return grams[order[least[order] > 1]].view(np.int64)


def prefixes(texts: DataFrame, work: Workspace, settings: Settings = Settings()) -> DataFrame:
    """node, class, n_words, gram: of each text (node, class, text) its ``first_runs``."""
    counts = texts.sparkSession.sparkContext.broadcast(counts_of(texts, work, settings))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [words_of(text) for text in batch["text"]]
            if not found:
                continue
            firsts = [first_runs(words, counts.value, settings) for words in found]
            sizes = [len(f) for f in firsts]
            yield pd.DataFrame(
                {
                    "node": np.repeat(batch["node"].to_numpy(), sizes),
                    "class": np.repeat(batch["class"].to_numpy(), sizes),
                    "n_words": np.repeat(np.asarray([len(words) for words in found], np.int32), sizes),
                    "gram": np.concatenate(firsts),
                }
            )

    return texts.select("node", "class", "text").mapInPandas(run, "node long, class long, n_words int, gram long")


def by_words(members: DataFrame, work: Workspace, settings: Settings = Settings()) -> DataFrame:
    """a, b: all pairs of different classes among texts (node, class, text) that can be similar enough."""
    everything = work.keep(prefixes(members, work, settings))
    # Grams of one class alone link nothing.
    several = everything.groupBy("gram").agg(F.min("class").alias("_low"), F.max("class").alias("_high"))
    grams = work.keep(everything.join(several.filter("_low < _high").select("gram").hint("shuffle_hash"), "gram", "left_semi"))
    work.drop(everything)
    left = grams.select("gram", F.col("node").alias("a"), F.col("class").alias("a_class"), F.col("n_words").alias("a_words"))
    right = grams.select("gram", F.col("node").alias("b"), F.col("class").alias("b_class"), F.col("n_words").alias("b_words"))
    met = (F.col("a") < F.col("b")) & (F.col("a_class") != F.col("b_class")) & ~_apart("a_words", "b_words", settings)
    pairs = left.join(right, (left["gram"] == right["gram"]) & met)
    # Of the longer one's grams, each edit takes ``run`` at most: so many are left of very short texts.
    longer = F.greatest("a_words", "b_words")
    edits = F.floor(longer * (1 - settings.similarity) + 1e-9)
    common = F.greatest(F.lit(settings.common), F.floor(F.least("a_words", "b_words") / settings.each))
    enough = F.least(common, longer - (settings.run - 1) - settings.run * edits)
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("_n"), F.first(enough).alias("_enough")).filter("_n >= _enough").select("a", "b")


def align_all(pairs: DataFrame, texts: DataFrame, work: Workspace, settings: Settings = Settings()) -> DataFrame:
    """a, b of the pairs that are similar enough, aligned slice by slice.

    A pair brings a text to the shuffle, and there may be many more pairs than texts. A slice brings ``SLICE`` of all
    texts' words at most, on average, and its shuffle goes before the next one's; the number of slices follows
    the ratio of pairs to texts, not the size of the data.
    """
    sizes = texts.select("node", "n_words")
    whole = sizes.agg(F.sum("n_words")).first()[0] or 1
    brought = pairs.join(sizes, pairs["b"] == sizes["node"]).agg(F.sum("n_words")).first()[0] or 0
    slices = max(1, -(-brought // max(1, int(whole * SLICE))))
    parts = []
    for i in range(slices):
        some = pairs.filter(F.pmod(F.xxhash64("a", "b"), F.lit(slices)) == i)
        with Workspace(pairs.sparkSession, "omh-slice"):
            parts.append(work.keep(align(some, texts, settings).select("a", "b")))
    return work.keep(reduce(DataFrame.unionByName, parts))


def _bucketed(texts: DataFrame, folder: str, buckets: int) -> tuple[DataFrame, str]:
    """Texts (node, text, n_words, mark) written in buckets of their node, so that no join with them moves them; the table's name."""
    name = f"omh_{uuid.uuid4().hex}"
    writer = texts.repartition(buckets, "node").write.format("parquet").bucketBy(buckets, "node").sortBy("node")
    writer.option("compression", "zstd").option("path", folder).saveAsTable(name)
    return texts.sparkSession.table(name), name


def near_classes(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, class_id (the smallest doc_id of the class), copy_of (the smallest doc_id with the same words).

    Tables and shuffles of a step go with it: what stays are ids, sketches of distinct texts, and one copy of the texts
    that share a sketch with another, which each round of alignments reads where it lies.
    """
    spark = docs.sparkSession
    docs = one_row_per_id(docs.select("doc_id", "text"))
    with Workspace(spark, "omh") as work:
        with Workspace(spark, "omh-sketches") as brief:
            found = brief.keep(sketches(docs, settings))
            first = brief.keep(found.groupBy("digest").agg(F.min("doc_id").alias("copy_of")))
            members = work.keep(found.select("doc_id", "digest").join(first, "digest").select("doc_id", "copy_of").distinct())
            heads = first.select(F.col("copy_of").alias("doc_id"))
            nodes = found.filter("size(sketch) > 0").join(heads, "doc_id", "left_semi")
            nodes = work.keep(nodes.select(F.col("doc_id").alias("node"), "n_words", "mark", "sketch"))
        table = None
        try:
            classes, table = _linked(docs, nodes, work, settings)
            classed = _classed(members, classes, "copy_of")
            return materialized(classed.select("doc_id", F.col("copy_of_class").alias("class_id"), "copy_of"))
        finally:
            if table is not None:
                spark.sql(f"DROP TABLE IF EXISTS {table}")


def _joined(classes: DataFrame | None, links: DataFrame, work: Workspace, brief: Workspace) -> DataFrame | None:
    """The classes (node, class) with more links (a, b): a class is tied by its nodes' links to its smallest."""
    if links.isEmpty():
        return classes
    if classes is not None:
        links = links.unionByName(classes.select(F.col("class").alias("a"), F.col("node").alias("b")))
    return work.keep(components(links, brief.keep))


def _linked(docs: DataFrame, nodes: DataFrame, work: Workspace, settings: Settings) -> tuple[DataFrame | None, str | None]:
    """node, class of all nodes that are linked to another one; and the table of their texts."""
    spark = docs.sparkSession
    exploded = nodes.select("node", F.explode("sketch").alias("bucket"))
    leaders = exploded.groupBy("bucket").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    with Workspace(spark, "omh-leaders") as brief:
        leaders = brief.keep(leaders)
        buckets = work.keep(exploded.join(leaders.select("bucket", "leader", (F.col("_n") > 2).alias("many")).hint("shuffle_hash"), "bucket"))
    many = buckets.filter("many").select("bucket", "node")
    # Whose text can be needed: who shares a sketch, and whoever can be near a short text.
    short = nodes.filter(F.col("n_words") <= settings.short / settings.similarity).select("node")
    wanted = work.keep(buckets.select("node").unionByName(short).distinct())
    facts = nodes.select("node", "n_words", "mark").join(wanted, "node", "left_semi")
    texts = docs.select(F.col("doc_id").alias("node"), "text").join(facts, "node")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts, table = _bucketed(texts, f"{work.folder}/texts", parts)

    seen = classes = None
    rows = buckets.select("bucket", "node", "leader")
    while True:
        with Workspace(spark, "omh-round") as brief:
            met = rows.filter("node <> leader").select("node", "leader").distinct()
            met = _classed(_classed(met, classes, "node"), classes, "leader").filter("node_class <> leader_class")
            pairs = met.select(F.col("leader").alias("a"), F.col("node").alias("b"))
            if seen is not None:
                pairs = pairs.join(seen, ["a", "b"], "left_anti")
            pairs = work.keep(likely(pairs, texts, settings))
            n = pairs.count()
            if not n:
                break
            fresh = align_all(pairs.filter("likely").select("a", "b"), texts, work, settings)
            pairs = pairs.select("a", "b")
            seen = pairs if seen is None else seen.unionByName(pairs)
            old, classes = classes, _joined(classes, fresh, work, brief)
            if classes is not old:
                work.drop(old)
            if fresh.count() * 10 < n:
                break
            # Who is not in the leader's class stays for the next leader.
            left = _classed(_classed(rows.filter("node <> leader"), classes, "node"), classes, "leader")
            left = brief.keep(left.filter("node_class <> leader_class").select("bucket", "node"))
            following = left.groupBy("bucket").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("_n"))
            last, rows = rows, work.keep(left.join(following.filter("_n > 1").select("bucket", "leader"), "bucket"))
            work.drop(last)
    # All nodes of buckets in which some pair may not have been compared. Two nodes were.
    with Workspace(spark, "omh-words") as brief:
        several = _classed(many, classes, "node")
        mixed = several.groupBy("bucket").agg(F.min("node_class").alias("_low"), F.max("node_class").alias("_high")).filter("_low < _high")
        chosen = several.join(mixed.select("bucket").hint("shuffle_hash"), "bucket", "left_semi").select("node", "node_class")
        # Short texts meet in their words, whether or not a sketch agrees; so do the longest that can be near them.
        few = _classed(short, classes, "node").select("node", "node_class")
        chosen = brief.keep(chosen.unionByName(few).distinct().withColumnRenamed("node_class", "class"))
        work.drop(buckets)
        with Workspace(spark, "omh-prefixes") as words:
            pairs = by_words(texts.join(chosen, "node"), words, settings)
            pairs = pairs if seen is None else pairs.join(seen, ["a", "b"], "left_anti")
            pairs = words.keep(pairs)
            pairs = brief.keep(likely(pairs, texts, settings).filter("likely").select("a", "b"))
        if not pairs.isEmpty():
            classes = _joined(classes, align_all(pairs, texts, work, settings), work, brief)
    return classes, table
