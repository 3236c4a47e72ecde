"""Language identification: averaged embeddings of hashed subwords, a linear softmax, calibrated rejection.

A word is the mean of the embeddings of its hashed subwords (itself and its n-grams with its borders), a text
the mean of its words. Since all of that is linear, a task keeps one row of class scores per distinct word and
adds rows up. The embeddings and the softmax are learned together by stochastic gradient descent in numpy from
at most ``max_docs`` documents, dealt evenly over the languages (those with the smallest hashes of their ids, so
which ones is fixed). A part of them is held back to fit the temperature of the scores and the bound below which
a prediction is rejected.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and rejected. Words are runs of
letters in lower case, over the whole text; long words count like others. With no labelled document every text
is ``und``. Ties go to the first language by name. Rows that repeat are predicted alike; other columns stay out.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "und"
WORDS = re.compile(r"[^\W\d_]+")
REMEMBERED = 500_000
# Texts that a task splits into words at a time.
AT_ONCE = 256


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 16
    size: int = 16
    grams: tuple[int, int] = (2, 4)
    max_docs: int = 3000
    epochs: int = 4
    rate: float = 0.5
    batch: int = 16
    held_back: float = 0.25  # share of the sample that calibrates
    may_reject: float = 0.001  # share of rightly predicted calibration documents that may be rejected
    seed: int = 7


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    scores: np.ndarray  # a row of class scores per bucket: embeddings times softmax weights
    bias: np.ndarray
    temperature: float
    least: float


class _Buckets(dict):
    """The bucket of each subword asked for so far: words share most of theirs."""

    def __init__(self, buckets: int) -> None:
        self.buckets = buckets

    def __missing__(self, part: str) -> int:
        self[part] = found = zlib.crc32(part.encode()) % self.buckets
        return found


def subwords(word: str, settings: Settings, seen: _Buckets | None = None) -> list[int]:
    """The buckets of a word's subwords; ``seen`` remembers those of its n-grams."""
    marked = f"<{word}>"
    low, high = settings.grams
    size = len(marked)
    parts = {marked[i : i + n] for n in range(low, high + 1) for i in range(size - n + 1)}
    parts.add(marked)
    seen = _Buckets(settings.buckets) if seen is None else seen
    found = [seen[p] for p in sorted(parts)]
    if size > high:
        del seen[marked]  # the word itself, which no other has
    return found


def word_scores(words: list[str], scores: np.ndarray, settings: Settings, seen: _Buckets) -> np.ndarray:
    """A row of class scores per word, the mean of its subwords': words of as many subwords are added up together."""
    own = [subwords(word, settings, seen) for word in words]
    sizes = np.fromiter(map(len, own), np.int64, len(own))
    out = np.empty((len(own), scores.shape[1]), scores.dtype)
    for size in np.unique(sizes).tolist():
        (at,) = np.nonzero(sizes == size)
        out[at] = scores[np.asarray([own[i] for i in at.tolist()])].mean(1)
    return out


def sparse(text: str, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """A text as buckets and their weights, which add up to 1: at most as many as there are buckets."""
    words, counts = np.unique(WORDS.findall(text.lower()), return_counts=True)
    buckets, weights = [], []
    for word, n in zip(words.tolist(), counts.tolist(), strict=True):
        own = subwords(word, settings)
        buckets += own
        weights += [n / len(own)] * len(own)
    found, at = np.unique(np.asarray(buckets, np.int32), return_inverse=True)
    total = np.bincount(at, np.asarray(weights), len(found)) / max(1, counts.sum())
    return found, total.astype(np.float32)


def sample(labelled: DataFrame, settings: Settings) -> DataFrame:
    """text, lang of about ``max_docs`` rows at most, evenly over the languages."""
    labelled = labelled.filter("text is not null and lang is not null")
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}  # a row per language
    if not sizes:
        return labelled.select("lang", "text").limit(0)
    each = settings.max_docs / len(sizes)
    hashed = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(settings.seed)), F.lit(1 << 30)) / (1 << 30)
    keep: Column = F.lit(False)
    for lang, n in sizes.items():
        keep = keep | ((F.col("lang") == lang) & (hashed < each / n))
    return labelled.filter(keep).select("lang", "text")


def fit(labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn from doc_id, text and lang. The driver gets the sample as bucket weights, at most
    8 bytes times ``buckets`` a document, and not as texts."""

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                buckets, weights = sparse(text, settings)
                rows.append((lang, buckets.astype("<i4").tobytes(), weights.astype("<f4").tobytes()))
            yield pd.DataFrame(rows, columns=["lang", "buckets", "weights"])

    rows = sample(labelled, settings).mapInPandas(weigh, "lang string, buckets binary, weights binary")
    found = [r for r in rows.toPandas().itertuples(index=False) if len(r.buckets)]
    found.sort(key=lambda r: (r.lang, r.buckets, r.weights))
    languages = tuple(sorted({r.lang for r in found}))
    if not languages:
        return Model((), np.zeros((settings.buckets, 0)), np.zeros(0), 1.0, 0.0)
    return _descend(found, languages, settings)


def _descend(found: list, languages: tuple[str, ...], settings: Settings) -> Model:
    rng = np.random.default_rng(settings.seed)
    known = {x: i for i, x in enumerate(languages)}
    labels = np.asarray([known[r.lang] for r in found])
    docs = [(np.frombuffer(r.buckets, "<i4"), np.frombuffer(r.weights, "<f4")) for r in found]
    order = rng.permutation(len(docs))
    cut = int(len(docs) * settings.held_back) if len(docs) > 8 * len(languages) else 0
    tuning, training = order[:cut], order[cut:]
    embeddings = rng.normal(0, 1 / settings.size**0.5, (settings.buckets, settings.size)).astype(np.float32)
    weights = np.zeros((settings.size, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    steps = max(1, settings.epochs * (len(training) // settings.batch + 1))
    step = 0
    for _ in range(settings.epochs):
        rng.shuffle(training)
        for start in range(0, len(training), settings.batch):
            rate = settings.rate * (1 - step / steps)
            step += 1
            some = training[start : start + settings.batch]
            x = np.stack([docs[i][1] @ embeddings[docs[i][0]] for i in some])
            error = _softmax(x @ weights + bias)
            error[np.arange(len(some)), labels[some]] -= 1
            back = error @ weights.T
            for i, g in zip(some, back, strict=True):
                # Each document's weights add up to 1 over hundreds of buckets: the step is scaled to the largest.
                w = docs[i][1]
                embeddings[docs[i][0]] -= rate * np.outer(w / w.max(), g)
            weights -= rate * x.T @ error
            bias -= rate * error.mean(0)
    scores = embeddings @ weights
    chosen = tuning if len(tuning) else training
    logits = np.stack([docs[i][1] @ scores[docs[i][0]] for i in chosen]) + bias
    right = labels[chosen]
    grid = np.geomspace(0.05, 50, 61)
    losses = [-np.log(_softmax(logits * t)[np.arange(len(right)), right] + 1e-12).mean() for t in grid]
    temperature = float(grid[int(np.argmin(losses))])
    sure = _softmax(logits * temperature)
    good = sure.max(1)[sure.argmax(1) == right]
    least = min(0.5, float(np.quantile(good, settings.may_reject))) if len(good) else 0.0
    return Model(languages, scores, bias, temperature, least)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def predict(docs: DataFrame, model: Model, settings: Settings = Settings()) -> DataFrame:
    """docs' own columns, lang_pred, lang_score and rejected, from the text alone.

    The model is broadcast; its size is buckets times languages, whatever the rows. Columns that have the new
    names already are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "lang_score", "rejected")
    added = (("lang_pred", T.StringType()), ("lang_score", T.DoubleType()), ("rejected", T.BooleanType()))
    schema = T.StructType([*docs.schema.fields, *(T.StructField(name, kind) for name, kind in added)])
    at = docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        model = shared.value
        count = len(model.languages)
        seen = _Buckets(settings.buckets)
        known, rows, lettered = {}, np.zeros((1 << 12, count), np.float32), np.zeros(1 << 12, bool)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            labels, probs, rejected = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
            for low in range(0, len(texts) if count else 0, AT_ONCE):
                found = [() if text is None else WORDS.findall(text.lower()) for text in texts[low : low + AT_ONCE]]
                if len(known) > REMEMBERED:
                    known = {}
                if len(seen) > REMEMBERED:
                    seen.clear()
                fresh = list(set().union(*found).difference(known))
                if fresh:
                    first = len(known)
                    while first + len(fresh) > len(rows):
                        rows = np.concatenate([rows, np.zeros_like(rows)])
                        lettered = np.concatenate([lettered, np.zeros_like(lettered)])
                    rows[first : first + len(fresh)] = word_scores(fresh, model.scores, settings, seen)
                    # Words may be of number forms alone, such as halves.
                    lettered[first : first + len(fresh)] = [any(map(str.isalpha, word)) for word in fresh]
                    known.update(zip(fresh, range(first, first + len(fresh)), strict=True))
                sizes = np.fromiter(map(len, found), np.int64, len(found))
                at_words = np.fromiter(map(known.__getitem__, chain.from_iterable(found)), np.int64, int(sizes.sum()))
                (full,) = np.nonzero(sizes)
                if len(full):
                    at_texts = (np.cumsum(sizes) - sizes)[full]
                    sums = np.add.reduceat(rows[at_words].astype(np.float64), at_texts, axis=0)
                    letters = np.logical_or.reduceat(lettered[at_words], at_texts)
                    full, sums = full[letters], sums[letters]
                if len(full):
                    p = _softmax((sums / sizes[full, None] + model.bias) * model.temperature)
                    full = full + low
                    probs[full] = p.max(1)
                    rejected[full] = probs[full] < model.least
                    for i, k in zip(full, p.argmax(1), strict=True):
                        labels[i] = model.languages[k]
            arrays = [*batch.columns, pa.array(labels), pa.array(probs), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "lang_pred", "lang_score", "rejected"])

    return docs.mapInArrow(run, schema)
