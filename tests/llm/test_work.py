"""Inner loops of operators: the same results as plain loops, with less work than these."""

from __future__ import annotations

import re
import time
import zlib

import numpy as np
import pandas as pd

from ebbflow.llm import huffman, langid, omh, permutation
from ebbflow.llm.common import tokenizer_file


def _block(n: int, pivots: int, prefix: int, size: int = 8) -> tuple[pd.Series, pd.DataFrame]:
    """A block of random vectors with random orders of pivots, and its first 40 vectors as queries."""
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(n, size))
    nearest = np.argsort(rng.random((n, pivots)), axis=1)[:, :prefix].astype("<i2")
    order = np.argsort(nearest.ravel(), kind="stable")
    post = {
        "ids": np.arange(n).astype("<i8").tobytes(),
        "vectors": vectors.astype("<f8").tobytes(),
        "members": (order // prefix).astype("<i4").tobytes(),
        "places": (order % prefix).astype("<i2").tobytes(),
        "ends": np.cumsum(np.bincount(nearest.ravel(), minlength=pivots)).astype("<i8").tobytes(),
    }
    asked = [(i, vectors[i].tobytes(), nearest[i].tobytes()) for i in range(40)]
    return pd.Series(post), pd.DataFrame(asked, columns=["vec_id", "v", "nearest"])


def _looked_up(post: pd.Series, group: pd.DataFrame, k: int, prefix: int, settings: permutation.Settings) -> list[tuple]:
    """The same search, member by member of each file."""
    ids = np.frombuffer(post["ids"], "<i8")
    vectors = np.frombuffer(post["vectors"], "<f8").reshape(len(ids), -1)
    members, places = np.frombuffer(post["members"], "<i4"), np.frombuffer(post["places"], "<i2")
    edges = [0, *np.frombuffer(post["ends"], "<i8").tolist()]
    wanted = min(len(ids), max(settings.least, k, int(np.ceil(settings.share * len(ids)))))
    out = []
    for query_id, raw, order in zip(group["vec_id"], group["v"], group["nearest"], strict=True):
        agreed = np.zeros(len(ids), np.int32)
        for place, pivot in enumerate(np.frombuffer(order, "<i2").tolist()):
            own = slice(edges[pivot], edges[pivot + 1])
            agreed[members[own]] += np.minimum(prefix - places[own].astype(np.int32), prefix - place)
        some = np.argpartition(-agreed, wanted - 1)[:wanted] if wanted < len(ids) else np.arange(len(ids))
        some = some[ids[some] != query_id]
        score = vectors[some] @ np.frombuffer(raw, "<f8")
        out += [(query_id, int(ids[some[i]]), float(score[i])) for i in np.lexsort((ids[some], -score))[:k]]
    return out


def test_op6_searches_a_block_without_looking_members_up():
    settings = permutation.Settings(least=200)
    post, group = _block(8192, 256, 128)

    def seconds(search) -> float:
        began = time.process_time()
        search(post, group, 20, 128, settings)
        return time.process_time() - began

    assert permutation._search(post, group, 20, 128, settings) == _looked_up(post, group, 20, 128, settings)
    assert min(seconds(permutation._search) for _ in range(3)) < 0.6 * min(seconds(_looked_up) for _ in range(3))


def test_op6_weights_beyond_16_bits_and_files_without_members():
    for pivots, prefix in ((600, 500), (64, 2)):  # 500 weights add up to more than 65,535
        post, group = _block(300, pivots, prefix)
        settings = permutation.Settings(least=30)
        assert permutation._search(post, group, 5, prefix, settings) == _looked_up(post, group, 5, prefix, settings)


def test_op5_hashes_each_subword_once_and_scores_words_as_one_by_one(monkeypatch):
    settings = langid.Settings(buckets=1 << 10)
    rng = np.random.default_rng(5)
    words = sorted({"".join(rng.choice(list("abdeéñ½"), rng.integers(1, 9))) for _ in range(400)})
    scores = rng.normal(size=(settings.buckets, 3)).astype(np.float32)
    asked = []
    crc32 = zlib.crc32
    monkeypatch.setattr(langid.zlib, "crc32", lambda part: asked.append(part) or crc32(part))
    seen = langid._Buckets(settings.buckets)
    found = langid.word_scores(words, scores, settings, seen)
    assert len(asked) == len(set(asked)) and not [part for part in seen if len(part) > settings.grams[1]]
    assert np.array_equal(found, np.stack([scores[langid.subwords(w, settings)].mean(0) for w in words]))


def test_op2_splits_a_text_once_and_merges_plain_words_without_the_library_splitting_them():
    path = tokenizer_file("byte_bpe_50k.json")
    texts = ["", "It's 12 plain words,\n  or ünïcode ones, and plain again", " plain words" * 3, "Ġ odd \x00 é"] * 2
    encoder = huffman.Encoder(path)
    expected = [np.asarray(encoder.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoder.bytewise and encoder.batch(texts) == expected == huffman.Encoder(path).batch(texts)

    class Counted:
        def __init__(self, tokenizer) -> None:
            self.tokenizer, self.model, self.asked = tokenizer, tokenizer.model, []

        def encode(self, text, **more):
            self.asked.append(text)
            return self.tokenizer.encode(text, **more)

    encoder = huffman.Encoder(path)
    encoder.tokenizer = counted = Counted(encoder.tokenizer)
    encoder.batch([" every plain word of this text", " and another text"])
    assert counted.asked == []  # asked for both texts' words before


def test_op10_meets_in_pairs_of_words_and_moves_no_texts_that_counts_of_words_rule_out(spark, monkeypatch):
    rng = np.random.default_rng(8)
    texts = {i: [f"w{j}" for j in rng.integers(0, 60, 20)] for i in range(0, 200, 2)}  # of a few words, all frequent
    for i in range(0, 20, 2):
        texts[i + 1] = [*texts[i][:9], "changed", *texts[i][10:]]
    asked, align_all = [], omh.align_all
    monkeypatch.setattr(omh, "align_all", lambda pairs, *rest: asked.append(pairs.count()) or align_all(pairs, *rest))
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    found = {r["doc_id"]: r["class_id"] for r in omh.near_classes(docs).collect()}
    assert found == {i: i - i % 2 for i in texts}
    assert sum(asked) <= 40  # a thousand and more where single words were enough


def test_op10_few_edits_along_diagonals_and_marks_below_every_distance():
    rng = np.random.default_rng(9)
    for _ in range(300):
        a = rng.integers(0, 12, rng.integers(1, 40)).tolist()
        b = [x for x in a if rng.random() > 0.1] + rng.integers(0, 12, rng.integers(0, 4)).tolist()
        table = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, table[0] = table[0], i
            for j, y in enumerate(b, 1):
                last, table[j] = table[j], min(table[j] + 1, table[j - 1] + 1, last + (x != y))
        for most in (0, 3, 50):
            assert omh._by_diagonals(a, b, most) == (table[-1] if table[-1] <= most else None)
        marks = [pd.Series([omh.mark(omh.words_of(" ".join(map(str, t))))]) for t in (a, b)]
        assert omh.least_distances(*marks)[0] <= table[-1]


def test_op10_words_are_runs_of_word_characters():
    texts = ["", "a_b c-d", "İstanbul ſ ßẞ ½²Ⅷ", "x\x1cy\x85z　q", "é é 日本 मराठी", "ab ba aab", "\ud800a"]
    seen = {}
    for text in texts:
        words = re.findall(r"\w+", text.lower())
        hashes = omh.words_of(text).tolist()
        assert len(hashes) == len(words)
        assert all(seen.setdefault(w, h) == h for w, h in zip(words, hashes, strict=True))
    assert len(set(seen.values())) == len(seen)


def test_op10_a_passage_of_many_texts_makes_no_pairs(spark, monkeypatch):
    rng = np.random.default_rng(10)
    passage = [f"p{j}" for j in range(20)]  # its words are rarer than the others, its pairs of words are not
    texts = {i: [*passage, *(f"w{j}" for j in rng.integers(0, 80, 120))] for i in range(0, 400, 2)}
    for i in range(0, 20, 2):
        texts[i + 1] = [w if rng.random() > 0.1 else "changed" for w in texts[i]]
    met, likely = [], omh.likely
    monkeypatch.setattr(omh, "likely", lambda pairs, *rest: met.append(pairs.count()) or likely(pairs, *rest))
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    found = {r["doc_id"]: r["class_id"] for r in omh.near_classes(docs).collect()}
    assert found == {i: i - i % 2 for i in texts}
    assert met[-1] <= 50  # nearly all of some 20000 where its words told how rare a pair is


def test_op10_near_texts_share_enough_of_their_first_pairs_in_any_order():
    rng, settings = np.random.default_rng(11), omh.Settings()
    for n in [*range(3, 30), 60, 150, 400, 1000]:
        for _ in range(10):
            a = rng.integers(0, 40, n).tolist()
            b = list(a)
            for _ in range(int(n * (1 - settings.similarity))):  # as many edits as a near text of this length may have
                at, kind = rng.integers(0, len(b)), rng.integers(0, 3)
                b[at : at + (kind < 2)] = [1000 + int(rng.integers(0, 1 << 30))] * int(kind > 0)
            a, b = (omh.words_of(" ".join(map(str, t))) for t in (a, b))
            runs = np.sort(np.unique(omh.labelled(omh.kmers(a, settings.run)))[::3])
            counts = omh.Counts(rng.integers(2, 50, omh.COUNTERS), 10_000, runs, rng.integers(16, 99, len(runs)).astype(float))
            longer = max(len(a), len(b))
            edits = int(longer * (1 - settings.similarity) + 1e-9)
            shared = len(np.intersect1d(omh.first_runs(a, counts, settings), omh.first_runs(b, counts, settings)))
            assert shared >= min(omh._common(min(len(a), len(b)), settings), longer - settings.run + 1 - settings.run * edits)
