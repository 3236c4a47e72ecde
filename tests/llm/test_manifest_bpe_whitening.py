"""Operators 11 to 13 against brute force: a plain Merkle tree, the tokenizer's library, and dense eigenvectors."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict
from itertools import product

import numpy as np
import pytest

import __spark_entry__ as entry
from ebbflow.llm import bidiagonal, bpe, merkle, whitening
from ebbflow.llm.common import tokenizer_file, tokenizer_pattern

from .conftest import documents

# Merkle manifest


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values) -> str:
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(digests: list[str], arity: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """The top, and each leaf's steps: what stands before it in its run and after it."""
    steps, at, level = [[] for _ in digests], list(range(len(digests))), digests
    while len(level) > 1:
        runs = [level[i : i + arity] for i in range(0, len(level), arity)]
        for i, place in enumerate(at):
            run, slot = runs[place // arity], place % arity
            steps[i].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
            at[i] = place // arity
        level = [h(*run) for run in runs]
    return level[0], steps


def by_hand(rows: list[tuple], arity: int = 2) -> list[tuple]:
    """rows: doc_id, source, lang, n_chars, text."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    built = {}
    for group in order:
        own = sorted(groups[group], key=lambda x: x[:3])
        built[group] = (own, *tree([x[2] for x in own], arity))
    root, over = tree([built[g][1] for g in order], arity)
    found = []
    for group, up in zip(order, over):
        own, subroot, steps = built[group]
        for (_, _, digest, row), path in zip(own, steps):
            claimed = digest
            if row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0:
                claimed = leaf((*row[:3], row[3] + 1, row[4]))
            folded = claimed
            for before, after in [*path, *up]:
                folded = h(before, folded, after)
            proof = h(*[a + b for a, b in [*path, *up]])
            found.append((row[0], digest, subroot, root, proof, folded, folded == root))
    return found


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: [str(x) for x in r])


def test_op11_by_hand(spark, tables):
    rows = [(d[0], d[3], d[2], d[4], d[1]) for d in documents()]
    found = entry.queries()["op11_merkle"](spark, tables).collect()
    assert ordered(found) == ordered(by_hand(rows))
    assert {r["verified"] for r in found} == {True, False}


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_op11_arities_ties_nulls_and_clashing_columns(spark, arity):
    pick = random.Random(arity)
    rows = [(i, pick.choice(["a", None]), pick.choice(["en", "de", "zz", None, ""]), i, f"t{i}é") for i in range(40)]
    rows += [(None, "a", "en", 1, "x"), (None, "a", "en", None, ""), (3, "a", "en", 1, "x"), (3, "a", "en", 1, "x")]
    rows += [(7, None, "alone", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    docs = docs.selectExpr("*", "'!' AS tree", "1 AS idx", "'x' AS digest", "0 AS n", "'y' AS path", "9 AS height")
    found = merkle.manifest(docs.repartition(3), arity=arity).collect()
    assert ordered(r[:5] for r in found) == ordered(r[:5] for r in by_hand(rows, arity))
    assert all(r["verified"] for r in found)


def test_op11_one_row(spark):
    docs = spark.createDataFrame([(1, "s", "en", 2, "ab")], "doc_id long, source string, lang string, n_chars long, text string")
    (row,) = merkle.manifest(docs).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == leaf((1, "s", "en", 2, "ab")) and row["proof_sha256"] == h()


# Byte-level BPE


def test_op12_as_the_library(spark, tables):
    import tiktoken

    ranks = bpe.Ranks.read(tokenizer_file("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=tokenizer_pattern(), mergeable_ranks=ranks.ids, special_tokens={})
    found = {r["doc_id"]: r for r in entry.queries()["op12_bpe"](spark, tables).collect()}
    assert len(found) == len(documents())
    for doc_id, text, *_ in documents():
        ids = library.encode_ordinary(text or "")
        row = found[doc_id]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_op12_random_texts_as_the_library():
    import tiktoken

    ranks = bpe.Ranks.read(tokenizer_file("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=tokenizer_pattern(), mergeable_ranks=ranks.ids, special_tokens={})
    pick, letters = random.Random(2), "abcdeinorst '’éßñ\n\t0123.,!日本語😀́ABC"
    texts = ["".join(pick.choice(letters[: pick.randint(2, len(letters))]) for _ in range(pick.randint(0, 60))) for _ in range(3000)]
    texts += ["a" * 5000, "ab" * 3000, "<|endoftext|>", None]
    for text, ids in zip(texts, bpe.Encoder(ranks, tokenizer_pattern()).encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text or "")


def merged_alone(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """One word by itself: the lowest rank first, the leftmost of equals."""
    parts = [bytes([b]) for b in word]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        i = min(pairs)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_op12_ranks_in_any_order():
    """Tokens whose parts have higher ranks than they: merges bring up lower ranks on the way."""
    for seed in range(30):
        pick = random.Random(seed)
        longer = ["".join(p).encode() for n in (2, 3, 4) for p in product("ab", repeat=n)]
        pick.shuffle(longer)
        ranks = {bytes([b]): b for b in range(256)} | {t: 256 + i for i, t in enumerate(longer[: pick.randint(3, 20)])}
        words = ["".join(pick.choice("abc") for _ in range(pick.randint(0, 14))).encode() for _ in range(60)]
        assert bpe.replay(words, bpe.Ranks(ranks)) == [merged_alone(w, ranks) for w in words]


def test_op12_long_texts_and_forgotten_words(monkeypatch):
    ranks = bpe.Ranks.read(tokenizer_file("byte_bpe_50k.tiktoken"))
    texts = [d[1] for d in documents()]
    whole = list(bpe.Encoder(ranks, tokenizer_pattern()).encode(texts))
    for name, value in (("LONG", 100), ("SPAN", 7), ("KNOWN", 1000)):
        monkeypatch.setattr(bpe, name, value)
    assert list(bpe.Encoder(ranks, tokenizer_pattern()).encode(texts)) == whole


def test_op12_keeps_rows_and_columns(spark):
    docs = spark.createDataFrame([(None, "a b", 1), (5, None, 2), (5, "", 3), (2**53 + 1, "x", None)], "doc_id long, text string, ids int")
    path = tokenizer_file("byte_bpe_50k.tiktoken")
    coded = bpe.decode(bpe.encode(docs, path, tokenizer_pattern()), path).collect()
    assert sorted((r["doc_id"] or 0, bytes(r["text"])) for r in coded) == [(0, b"a b"), (5, b""), (5, b""), (2**53 + 1, b"x")]


# Whitening


def expected(vectors: list) -> dict:
    x = np.floor(64 * np.array(vectors, float)) + 1_000_000
    n = len(x)
    values, directions = np.linalg.eigh(np.cov(x.T, bias=True))
    values, directions = values[::-1], directions[:, ::-1]
    whole = np.array([[int(c) for c in row] for row in x], object)
    off = n * whole - whole.sum(axis=0)
    return {
        "n": n,
        "white": (x - x.mean(axis=0)) @ directions / np.sqrt(np.maximum(values, 1e-300)),
        "explained": values / values.sum(),
        "deviation": (off**2).sum(axis=1),
    }


def check_white(found, ids, vectors, components):
    best = expected(vectors)
    table = {(r["vec_id"], r["component"]): r for r in found}
    assert len(table) == len(found) == len(ids) * components
    for k in range(components):
        column = np.array([table[i, k + 1]["whitened"] for i in ids])
        sign = np.sign(column @ best["white"][:, k])
        assert np.allclose(sign * column, best["white"][:, k], atol=1e-7)
        assert all(abs(table[i, k + 1]["explained"] / best["explained"][k] - 1) < 1e-9 for i in ids)
    for i, deviation in zip(ids, best["deviation"]):
        assert table[i, 1]["deviation"] == deviation and table[i, 1]["n"] == best["n"]
    assert all(r["identity_error"] < 1e-9 for r in found)


def test_op13_against_dense_eigenvectors(spark, tables):
    rows = spark.read.parquet(f"{tables}/embeddings.parquet").collect()
    sound = [r for r in rows if r["embedding"] and all(c is not None and np.isfinite(c) for c in r["embedding"])]
    twice = [r["vec_id"] for r in sound]
    assert len(set(twice)) == len(twice) - 1  # one id comes twice
    found = entry.queries()["op13_whitening"](spark, tables).collect()
    assert len(found) == 8 * len(sound)
    again = [r for r in sound if twice.count(r["vec_id"]) == 1]
    best = expected([r["embedding"] for r in sound])
    place = {r["vec_id"]: i for i, r in enumerate(sound)}
    for k in range(8):
        column = {r["vec_id"]: r["whitened"] for r in found if r["component"] == k + 1}
        own = np.array([column[r["vec_id"]] for r in again])
        ref = best["white"][[place[r["vec_id"]] for r in again], k]
        assert np.allclose(np.sign(own @ ref) * own, ref, atol=1e-7)


def test_op13_many_parts_and_wide_vectors(spark, monkeypatch):
    monkeypatch.setattr(whitening, "MERGED", 2)
    monkeypatch.setattr(whitening, "BLOCK", 7)
    rng = np.random.default_rng(1)
    vectors = (rng.standard_normal((300, 40)) @ rng.standard_normal((40, 40))).tolist()
    frame = spark.createDataFrame([(i, v, 0.5, "x") for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, n double, vector string")
    check_white(whitening.whiten(frame.repartition(9)).collect(), range(300), vectors, 32)


def test_op13_lengths_equal_vectors_and_null_ids(spark):
    rng = np.random.default_rng(2)
    good = rng.standard_normal((30, 3)).tolist()
    odd = [(100, [1.0, 2.0]), (101, []), (102, None), (103, [None, 1.0, 2.0]), (104, [float("inf"), 1.0, 2.0])]
    frame = spark.createDataFrame([*enumerate(good), *odd], "vec_id long, embedding array<double>")
    check_white(whitening.whiten(frame).collect(), range(30), good, 3)
    same = spark.createDataFrame([(None, [1.0, 2.0]), (1, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert whitening.whiten(same).collect() == []
    line = spark.createDataFrame([(None, [0.0, 2.0]), (1, [1.0, 2.0]), (2, [3.0, 2.0])], "vec_id long, embedding array<float>")
    found = whitening.whiten(line).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in found) == [(0, 1), (1, 1), (2, 1)]
    assert found[0]["explained"] == pytest.approx(1)


@pytest.mark.parametrize("kind", ["plain", "graded", "repeated", "close", "rank", "zero", "split"])
def test_op13_solver(kind):
    rng = np.random.default_rng(3)
    square = np.linalg.qr(rng.standard_normal((24, 24)))[0]
    base = {
        "plain": rng.standard_normal((24, 24)),
        "graded": rng.standard_normal((24, 24)) * np.logspace(0, -6, 24),
        "repeated": square * np.r_[np.ones(8), np.full(8, 0.5), np.linspace(0.1, 0.2, 8)] @ square.T,
        "close": square * (1 + 1e-10 * rng.standard_normal(24)) @ square.T,
        "rank": rng.standard_normal((24, 2)) @ rng.standard_normal((2, 24)),
        "zero": np.zeros((24, 24)),
        "split": np.kron(np.eye(8), rng.standard_normal((3, 3))),
    }[kind]
    factor = np.linalg.qr(base, mode="r")
    diagonal, above, right = bidiagonal.bidiagonalised(factor)
    squares, inner = bidiagonal.right_singular_vectors(diagonal, above)
    vectors = right @ inner
    scale = max(np.linalg.norm(factor, 2) ** 2, 1e-300)
    assert np.allclose(squares, np.linalg.svd(factor, compute_uv=False) ** 2, atol=1e-13 * scale)
    assert np.abs(vectors.T @ vectors - np.eye(24)).max() < 1e-13
    assert np.abs(factor.T @ factor @ vectors - vectors * squares).max() <= 1e-13 * scale
