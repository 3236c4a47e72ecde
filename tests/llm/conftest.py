"""Small tables with every awkward case, as Parquet, for the queries; and frames made of rows."""

from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, extra string"
ITEM = "A baker sells fresh rolls to the old market and every morning the baker carries 3 baskets of 12 rolls down the hill"
MOVED = "A baker sells fresh rolls to the old market and every morning the baker carries 7 baskets of 90 rolls down the hill"


def prose(seed: int, lang: str = "en", n: int = 60) -> str:
    pick = random.Random(f"{seed}-{lang}")
    ends = {"en": ("th", "ing", "nd", "er"), "fr": ("eau", "ent", "oux", "que")}[lang]
    return " ".join(pick.choice("bcdfglmnprst") + pick.choice("aeiou") + pick.choice(ends) for _ in range(n)) + "."


def documents() -> list[tuple]:
    rows = [(i, prose(i, ("en", "fr")[i % 2]), ("en", "fr")[i % 2], f"s{i % 3}", 1, "x") for i in range(80)]
    rows += [(100 + i, prose(1, "fr"), "fr", "hot", 1, None) for i in range(5)]  # copies of 1
    near = prose(2).split()
    rows.append((110, " ".join([*near[:30], "changed", *near[31:]]), "en", None, 1, None))
    rows += [(120, f"{prose(300)} {ITEM}. {prose(301)}", "en", "s1", 1, ""), (121, f"{prose(302)} {MOVED}. {prose(303)}", None, "s2", 1, "")]
    rows += [(130, None, None, None, None, None), (131, "", "en", "s0", 0, ""), (132, " \n\t ", "en", "s0", 0, "")]
    rows += [(133, "12 34 !!", "en", "s0", 1, ""), (134, prose(400, n=30_000), "en", "s0", 1, "")]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(documents(), DOCS)


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.createDataFrame([(1, ITEM), (2, "Why does the quiet river always carry the green boats so slowly to the sea"), (3, None), (4, "")], "item_id long, text string")


def _tables(spark, folder, docs, benchmark, empty):
    pick = random.Random(7)
    vectors = [(i, [pick.gauss(0, 1) for _ in range(8)]) for i in range(200)]
    vectors += [(200, None), (220, [0.0] * 8), (240, [float("nan")] + [1.0] * 7), (260, [None] + [1.0] * 7), (41, vectors[40][1])]
    page = "<html>" + "é" * 90 + "</html>"
    pages = [(4, "u", page), (2, "http://h/a b", page), (9, None, page), (1, "u", "tiny"), (3, "u", "tiny"), (5, "u", None), (6, "u", "")]
    talk = [
        ("c1", 0, "user", "Where is the key?\nI looked all over."),
        ("c1", 1, "assistant", "> Where is the key?\nUnder the mat."),
        ("c1", 2, "user", ">> Where is the key?\n> Under the mat.\nThanks!"),
        ("c2", 0, "user", None),
        (None, 0, "user", "> Where is the key?"),
        ("c2", 1, None, ""),
    ]
    tables = {
        "documents": docs,
        "benchmark": benchmark,
        "embeddings": spark.createDataFrame(vectors, "vec_id long, embedding array<float>"),
        "pages": spark.createDataFrame(pages, "page_id long, url string, html string"),
        "conversations": spark.createDataFrame(talk, "conv_id string, turn int, role string, text string"),
        "labels": spark.createDataFrame([(i, i % 2, 0) for i in range(80)] + [(130, None, None)], "doc_id long, quality int, toxic int"),
    }
    for name, table in tables.items():
        (table.limit(0) if empty else table).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def tables(spark, tmp_path_factory, docs, benchmark):
    return _tables(spark, tmp_path_factory.mktemp("tables"), docs, benchmark, empty=False)


@pytest.fixture(scope="session")
def no_rows(spark, tmp_path_factory, docs, benchmark):
    return _tables(spark, tmp_path_factory.mktemp("empty"), docs, benchmark, empty=True)
