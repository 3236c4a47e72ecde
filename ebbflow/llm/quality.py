"""Quality classifier: quadratic discriminant with shrunken class covariances over document statistics.

The statistics (shares of kinds of characters, repetition, lengths of words, lines and sentences) come from the
whole text; shares are smoothed towards plain prose, so that short texts stay near it, and put on a logarithmic
scale. Each class is a Gaussian: its mean, and its covariance drawn towards the pooled one and the diagonal. The
sums a fit needs are added up over all labelled rows by Spark; how much to draw is chosen by log loss on a tenth
of them. A score compares two log densities, from Mahalanobis distances with Cholesky factors made once.

Defined results: null and empty texts have the statistics of an empty text and a score like any other. Rows
without a label, or with one that is neither 0 nor 1, are not learned from; a document labelled twice counts
twice. Where a class has no row, every score is the share of the other class. Other columns stay out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbflow.llm.common import integers_again, integers_as_text

# Bytes of each kind (bytes from 128 on are parts of letters), and the share expected in prose.
_KINDS = np.zeros(256, np.int64)
_KINDS[list(b"abcdefghijklmnopqrstuvwxyz")] = 1
_KINDS[128:] = 1
_KINDS[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 2
_KINDS[list(b"0123456789")] = 3
_KINDS[list(b".,;:?'\"-()")] = 4
_KINDS[list(b"!")] = 5
_KINDS[list(b"#$%&*+/<=>@[\\]^_`{|}~")] = 6
_KINDS[list(b"\n")] = 7
STATISTICS = (
    "log_words upper digits marks exclaims symbols newlines word_length length_spread short_words long_words "
    "log_distinct top_word repeated_lines bare_words sentence"
).split()
LAMBDAS = ((0.02, 0.001), (0.1, 0.01), (0.3, 0.03), (0.5, 0.1), (0.8, 0.1))


def _share(part: float, whole: float, expected: float, weight: float = 20.0) -> float:
    """The log odds of a share, smoothed by ``weight`` observations of what is expected."""
    p = (part + expected * weight) / (whole + weight)
    p = min(max(p, 1e-6), 1 - 1e-6)
    return float(np.log(p / (1 - p)))


def statistics(text: str | None) -> list[float]:
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    kinds = np.bincount(_KINDS[raw], minlength=8) if len(raw) else np.zeros(8, np.int64)
    words = text.split()
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    letters = int(kinds[1] + kinds[2])
    solid = max(1, int(kinds[1:7].sum()))
    ends = text.count(". ") + text.count(".\n") + text.count("? ") + text.count("! ") + 1
    mean = (lengths.sum() + 5.5 * 20) / (n + 20)
    spread = (((lengths - mean) ** 2).sum() + 9.0 * 20) / (n + 20)
    return [
        float(np.log1p(n)),
        _share(kinds[2], letters, 0.03),
        _share(kinds[3], solid, 0.002),
        _share(kinds[4], solid, 0.025),
        _share(kinds[5], solid, 0.0005),
        _share(kinds[6], solid, 0.0005),
        _share(kinds[7], solid, 0.004),
        float(np.log(mean)),
        float(np.log(spread)),
        _share(int((lengths <= 3).sum()), n, 0.35),
        _share(int((lengths >= 14).sum()), n, 0.02),
        float(np.log1p(len(counts))),
        _share(max(counts.values(), default=0), n, 0.06),
        _share(len(lines) - len(set(lines)), len(lines), 0.01),
        _share(sum(c for w, c in counts.items() if not any(map(str.isalnum, w))), n, 0.001),
        float(np.log((n + 15) / (ends + 1))),
    ]


def with_statistics(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and x, the statistics of the whole text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch.pop("text")
            yield batch.assign(x=[statistics(t if isinstance(t, str) else None) for t in texts])

    kept = docs.select(*keep, "text")
    rows = integers_as_text(kept)
    x = T.StructField("x", T.ArrayType(T.DoubleType()))
    schema = T.StructType([*rows.drop("text").schema.fields, x])
    return integers_again(rows.mapInPandas(run, schema), kept.schema)


@dataclass(frozen=True)
class Model:
    priors: np.ndarray
    means: np.ndarray  # class by statistic
    factors: np.ndarray  # lower Cholesky factor of each class's covariance, inverted
    log_dets: np.ndarray
    sharpness: float = 1.0

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 with its prior, less that of class 0."""
        parts = []
        for k in (0, 1):
            z = (x - self.means[k]) @ self.factors[k].T
            parts.append(np.log(self.priors[k]) - 0.5 * (z * z).sum(1) - 0.5 * self.log_dets[k])
        return parts[1] - parts[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.priors.min() <= 0:
            return np.full(len(x), float(self.priors[1]))
        return 1 / (1 + np.exp(-np.clip(self.sharpness * self.log_odds(x), -60, 60)))


def _model(n: np.ndarray, s: np.ndarray, q: np.ndarray, to_pooled: float, to_diagonal: float) -> Model:
    """From counts, sums and sums of products per class."""
    size = s.shape[1]
    if n.min() <= 0:
        return Model(n / max(1, n.sum()), np.zeros_like(s), np.zeros((2, size, size)), np.zeros(2))
    means = s / n[:, None]
    scatter = q - n[:, None, None] * np.einsum("ki,kj->kij", means, means)
    pooled = scatter.sum(0) / n.sum()
    factors, log_dets = [], []
    for k in (0, 1):
        own = (1 - to_pooled) * scatter[k] / n[k] + to_pooled * pooled
        own = (1 - to_diagonal) * own + to_diagonal * np.diag(np.diag(own)) + 1e-6 * np.eye(size)
        lower = np.linalg.cholesky(own)
        factors.append(np.linalg.inv(lower))
        log_dets.append(2 * np.log(np.diag(lower)).sum())
    return Model(n / n.sum(), means, np.stack(factors), np.asarray(log_dets))


def fit(labelled: DataFrame, label: str = "quality") -> Model:
    """Learn from rows of x, ``label`` and ``tune`` (boolean: rows that choose the shrinkage).

    Tasks send counts, sums and products, whose size is that of the statistics; all labelled rows take part.
    """
    size = len(STATISTICS)
    labelled = labelled.filter(F.col(label).isin(0, 1)).select("x", F.col(label).cast("int").alias("y"), "tune")

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, 2, 1 + size + size * size))
        for batch in batches:
            x = np.stack(batch["x"])
            for t in (0, 1):
                for y in (0, 1):
                    own = x[((batch["tune"] == bool(t)) & (batch["y"] == y)).to_numpy()]
                    total[t, y] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
        yield pd.DataFrame({"t": [0, 0, 1, 1], "y": [0, 1, 0, 1], "sums": list(total.reshape(4, -1))})

    sums = np.zeros((2, 2, 1 + size + size * size))
    added = labelled.mapInPandas(add, "t int, y int, sums array<double>")
    added = added.select("t", "y", F.posexplode("sums").alias("i", "v")).groupBy("t", "y", "i").agg(F.sum("v").alias("v"))
    for t, y, i, v in added.collect():  # four times 1 + 16 + 256 numbers
        sums[t, y, i] = v

    def model(part: np.ndarray, to_pooled: float, to_diagonal: float) -> Model:
        return _model(part[:, 0], part[:, 1 : 1 + size], part[:, 1 + size :].reshape(2, size, size), to_pooled, to_diagonal)

    whole = sums.sum(0)
    if whole[:, 0].min() <= 0 or sums[0, :, 0].min() <= size or sums[1, :, 0].min() <= 0:
        return model(whole, 0.5, 0.1)
    trials = [model(sums[0], *c) for c in LAMBDAS]
    sharp = (0.1, 0.2, 0.4, 0.7, 1.0)

    def loss(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(trials), len(sharp)))
        for batch in batches:
            x, y = np.stack(batch["x"]), batch["y"].to_numpy()
            for i, trial in enumerate(trials):
                odds = np.where(y == 1, 1, -1) * trial.log_odds(x)
                total[i] += [np.logaddexp(0, -s * odds).sum() for s in sharp]
        yield pd.DataFrame({"i": np.arange(total.size), "loss": total.ravel()})

    lost = labelled.filter("tune").mapInPandas(loss, "i int, loss double").groupBy("i").agg(F.sum("loss").alias("loss"))
    best = min((v, i) for i, v in lost.collect())[1]
    chosen = model(whole, *LAMBDAS[best // len(sharp)])
    return Model(chosen.priors, chosen.means, chosen.factors, chosen.log_dets, sharp[best % len(sharp)])


def score(featured: DataFrame, model: Model) -> DataFrame:
    """The rows' own columns without x, score (0 to 1) and predicted; own columns of these names are replaced."""
    shared = featured.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = np.stack(batch.pop("x"))
                found = shared.value.scores(x)
                yield batch.assign(score=found, predicted=(found >= 0.5).astype("int32"))

    own = featured.drop("score", "predicted")
    rows = integers_as_text(own)
    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    schema = T.StructType([*(f for f in rows.schema.fields if f.name != "x"), *added])
    return integers_again(rows.mapInPandas(run, schema), own.schema)
