"""The dealt operators on tables with every awkward case, against brute force or SQL."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from ebbflow.llm import decontaminate, katz, langid, omh, quality, quotes
from ebbflow.llm.common import tokenizer_file
from tests.oracle import compare

from .conftest import documents, prose

NAMES = sorted(n for n in entry.queries() if re.match(r"op\d+_|pipeline$", n))


def rows(spark, folder, name):
    return [r.asDict() for r in entry.queries()[name](spark, folder).collect()]


def fold(key, n):
    return zlib.crc32(str(key).encode()) % n


def test_all_are_registered():
    assert {int(n[2:].split("_")[0]) for n in NAMES if n != "pipeline"} == set(range(1, 14)) and "pipeline" in NAMES


@pytest.mark.parametrize("name", NAMES)
def test_an_empty_table_gives_no_row(spark, no_rows, name):
    assert rows(spark, no_rows, name) == []


@pytest.mark.parametrize("name", ["op1_warc", "op4_mixing", "op8_quotes", "op11_merkle"])
def test_by_sql(spark, tables, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tables}/{table}.parquet/*.parquet'")
    assert not compare(duck, entry.queries()[name](spark, tables), entry.oracle_sql()[name])[1]


def test_op1_revisits(spark, tables):
    found = {r["page_id"]: r for r in rows(spark, tables, "op1_warc")}
    assert [found[i]["refers_to"] for i in (2, 4, 9)] == [None, 2, 2]
    assert found[5]["payload_bytes"] == 0 and found[5]["payload_digest"] == hashlib.sha256(b"").hexdigest()


def test_op2_round_trip(spark, tables):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    found, start = rows(spark, tables, "op2_huffman"), 0
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == len(documents())
    for doc_id, text, *_ in sorted(documents()):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        row = by_id[doc_id]
        assert (row["start"], row["n_tokens"]) == (start, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_op3_finds_items_and_new_parameters(spark, tables):
    found = {r["doc_id"]: r for r in rows(spark, tables, "op3_decontamination")}
    assert {i: (r["item_id"], r["kind"]) for i, r in found.items()} == {120: (1, "verbatim"), 121: (1, "reparameterised")}


def test_op3_slots_must_agree(spark, benchmark):
    text = "A baker sells fresh rolls to the old market and every morning the baker carries 3 baskets of 3 rolls down the hill"
    same = spark.createDataFrame([(1, text)], "item_id long, text string")
    docs = spark.createDataFrame([(1, text.replace("3 baskets of 3", "7 baskets of 9")), (2, text.replace("3", "8"))], "doc_id long, text string")
    assert [r["doc_id"] for r in decontaminate.contaminated(docs, same).collect()] == [2]


def items_and_documents(spark, items, docs):
    return (
        spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"),
        spark.createDataFrame(list(enumerate(items)), "item_id long, text string"),
    )


def test_op3_short_items_capitals_and_lost_full_stops(spark):
    items = ["Compute 17 * 23.", "What is 12 + 34 * 56?", "Who wrote Hamlet?", "Where is the capital of France?", "Yes"]
    docs = [
        *items[:4],
        "he asked Where is the capital of France and went",
        "where is the capital of france",
        "we all know who wrote hamlet by now",
        "Compute 17 * 24.",
        "Compute 18 * 23.",
        "Yes, who wrote Macbeth is known, and where the capital of Spain is as well.",
        None,
        "",
    ]
    found = decontaminate.contaminated(*items_and_documents(spark, items, docs)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(0, 0), (1, 1), (2, 2), (3, 3), (4, 3), (5, 3), (6, 2)}
    assert all(r["kind"] == "verbatim" and r["share"] <= 1 for r in found)


def test_op3_other_names_and_numbers_of_generated_items(spark):
    words = prose(400, n=300).rstrip(".").split()
    rng = np.random.default_rng(11)
    items, docs = [], []
    for i in range(60):
        own = [str(w).lower() for w in rng.choice(words, 24)]
        own[5], own[14] = "Zorblax", "17"
        items.append(" ".join(own).capitalize() + ".")
        own[5], own[14] = "Quimby", "4" + str(i)
        docs.append("Once upon a time there was a test " + " ".join(own) + " and so on it went")
        docs.append(" ".join(w for k, w in enumerate(own) if k != 20).lower())
    found = decontaminate.contaminated(*items_and_documents(spark, items, docs)).collect()
    pairs = {(r["doc_id"], r["item_id"]) for r in found}
    assert {d for d, _ in pairs} >= set(range(0, 120, 2)) and all(d // 2 == i for d, i in pairs)


def test_op3_a_window_never_crosses_texts_and_a_filter_passes_its_own(spark):
    canon = decontaminate.Canon()
    texts = ["one red fox ran over a hill with 3 dogs", "", "one red fox", "ran over a hill with 3 dogs near Bonn by night"]
    _, together = canon.templates(texts, {0, 1, 2})
    for r, template in together.items():
        found = set()
        at, hashes = decontaminate.window_hashes(template, decontaminate.running_hashes(template), r, 5, 2)
        for i, h in zip(at, hashes, strict=True):
            found.add((int(template.text[i]), int(i - template.first[template.text[i]]), int(h)))
        alone = set()
        for k, text in enumerate(texts):
            _, one = canon.templates([text], {r})
            at, hashes = decontaminate.window_hashes(one[r], decontaminate.running_hashes(one[r]), r, 5, 2)
            alone |= {(k, int(i), int(h)) for i, h in zip(at, hashes, strict=True)}
        assert found == alone and len(found) > 5
    hashes = np.random.default_rng(1).integers(0, 1 << 63, 20_000)
    rows = spark.createDataFrame([(int(h),) for h in hashes[:5000]], "hash long")
    passed = decontaminate._passing(hashes.view(np.uint64), decontaminate.filter_of(rows, 5000))
    assert passed[:5000].all() and passed[5000:].mean() < 0.05


def test_op5_languages(spark, tables):
    found = {r["doc_id"]: r for r in rows(spark, tables, "op5_langid")}
    assert len(found) == len(documents())
    for i in (130, 131, 132, 133):
        assert (found[i]["lang_pred"], found[i]["score"]) == ("und", 0.0)
    held = [i for i in range(80) if fold(i, 5) == 0]
    assert all(found[i]["held_out"] for i in held)
    assert sum(found[i]["lang_pred"] == ("en", "fr")[i % 2] for i in held) >= 0.9 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_op6_against_brute_force(spark, tables):
    found = defaultdict(list)
    for r in sorted(rows(spark, tables, "op6_permutation_index"), key=lambda r: r["rank"]):
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    vectors = [(r["vec_id"], np.array(r["embedding"], float)) for r in spark.read.parquet(f"{tables}/embeddings.parquet").collect() if r["embedding"] and None not in r["embedding"]]
    vectors = [(i, v) for i, v in vectors if np.isfinite(v).all() and v.any()]
    assert set(found) == {i for i, _ in vectors if i % 20 == 0}
    for i, q in vectors:
        if i % 20 == 0:
            best = sorted((-float(v @ q), j) for j, v in vectors if j != i)[:20]
            assert [j for j, _ in found[i]] == [j for _, j in best]  # below the least number of candidates: exact
            assert np.allclose([s for _, s in found[i]], [-s for s, _ in best], atol=1e-12)


def katz_by_rows(texts: dict, learns) -> dict:
    """Katz backoff by plain loops."""
    token = {i: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["\n"] for i, t in texts.items()}
    one, two = Counter(), Counter()
    for i, words in token.items():
        if learns(i):
            one.update(words)
            two.update(zip(["<s>", *words], words))
    d1, d2 = (katz.discounts([sum(c == r for c in n.values()) for r in range(1, katz.COUNTED + 2)]) for n in (one, two))
    cut = lambda c, d: float(katz.discounted(np.array([c]), d)[0])
    total = sum(one.values())
    kept = sum(cut(c, d1) for c in one.values())
    below = total if kept < total else total + 1
    p1 = lambda w: cut(one[w], d1) / below if w in one else (below - kept) / below
    after = defaultdict(dict)
    for (a, b), c in two.items():
        after[a][b] = c
    divisor, weight = {}, {}
    for a, seen in after.items():
        count, own = sum(seen.values()), sum(cut(c, d2) for c in seen.values())
        divisor[a] = count if own < count - 1e-9 else count + 1
        weight[a] = (1 - own / divisor[a]) / (1 - sum(map(p1, seen)))
        whole = sum(cut(after[a][w], d2) / divisor[a] if w in seen else weight[a] * p1(w) for w in [*one, "never seen"])
        assert math.isclose(whole, 1, abs_tol=1e-9)
    out = {}
    for i, words in token.items():
        p = [cut(after[a][b], d2) / divisor[a] if b in after.get(a, {}) else weight.get(a, 1) * p1(b) for a, b in zip(["<s>", *words], words)]
        base = sum(math.log10((one[w] + 0.5) / (total + 0.5 * (len(one) + 1))) for w in words)
        out[i] = (len(words), sum(w in one for w in words), total, base, sum(map(math.log10, p)))
    return out


def test_op7_against_loops(spark, tables):
    expected = katz_by_rows({d[0]: d[1] for d in documents()}, lambda i: fold(i, 5) != 1)
    found = {r["doc_id"]: r for r in rows(spark, tables, "op7_katz")}
    assert set(found) == set(expected)
    for i, (n, known, total, base, score) in expected.items():
        r = found[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (n, known, total, fold(i, 5) == 1)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and math.isclose(r["score"], score, rel_tol=1e-9)


def test_op7_many_buckets_and_batches_give_the_same(spark, docs, monkeypatch):
    small = docs.filter("doc_id < 134").repartition(3).selectExpr("doc_id", "text", "doc_id % 3 > 0 AS train", "1 AS score")
    whole = {r["doc_id"]: r["score"] for r in katz.score(small).collect()}
    monkeypatch.setattr(katz, "BUCKET", 700)
    monkeypatch.setattr(katz, "SPLIT", 5)
    parts = {r["doc_id"]: r["score"] for r in katz.score(small).collect()}
    assert parts.keys() == whole.keys() and all(math.isclose(parts[i], whole[i], rel_tol=1e-9) for i in whole)


def test_op7_null_and_repeated_ids_and_nothing_to_learn(spark):
    docs = spark.createDataFrame([(None, "A b"), (1, "a\x0bB"), (1, "a\x0bB"), (2, None)], "doc_id long, text string")
    found = katz.score(docs.selectExpr("*", "CAST(NULL AS boolean) AS train")).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["n_known"], r["score"]) for r in found) == [(0, 3, 0, 0.0), (1, 3, 0, 0.0), (1, 3, 0, 0.0), (2, 1, 0, 0.0)]


def test_op9_scores_everything(spark, tables):
    found = {r["doc_id"]: r for r in rows(spark, tables, "op9_quality")}
    assert len(found) == len(documents())
    for i, r in found.items():
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) and r["held_out"] == (fold(i, 3) == 1)
    held = [i for i in range(80) if fold(i, 3) == 1]  # labels follow the language here
    assert sum(found[i]["predicted"] == i % 2 for i in held) >= 0.8 * len(held)


def test_op10_classes(spark, tables):
    found = {r["doc_id"]: r for r in rows(spark, tables, "op10_order_minhash")}
    assert len(found) == len(documents())
    assert {found[i]["class_id"] for i in (1, 100, 101, 102, 103, 104)} == {1}
    assert found[110]["class_id"] == 2 and found[110]["copy_of"] == 110
    assert {found[i]["class_id"] for i in (130, 131, 132)} == {130}
    grouped = {1, 100, 101, 102, 103, 104, 110, 2, 130, 131, 132}
    assert all(r["class_id"] == i for i, r in found.items() if i not in grouped)


@pytest.mark.parametrize("a, b", [("kitten", "sitting"), ("", "abc"), ("flaw", "lawn"), ("same", "same")])
def test_op10_banded_distance(a, b):
    table = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, table[0] = table[0], i
        for j, y in enumerate(b, 1):
            last, table[j] = table[j], min(table[j] + 1, table[j - 1] + 1, last + (x != y))
    assert omh.distance_within(list(a), list(b), 7) == table[-1]


def near_pairs(texts):
    """All pairs at the bound or above, by brute force."""
    most = lambda a, b: int(max(len(a), len(b)) * 0.2 + 1e-9)
    return [(i, j) for i, a in texts.items() for j, b in texts.items() if i < j and omh.distance_within(a, b, most(a, b)) is not None]


def linked(spark, texts, pairs=None):
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r["class_id"] for r in omh.near_classes(docs).collect()}
    pairs = pairs or near_pairs(texts)
    return sum(found[i] == found[j] for i, j in pairs) / len(pairs)


def changed(rng, words, share):
    """Words with a share of them replaced, at random places."""
    out = list(words)
    for at in rng.choice(len(out), round(share * len(out)), replace=False):
        out[at] = f"new{rng.integers(1 << 40)}"
    return out


def test_op10_pairs_in_a_crowd(spark):
    rng = np.random.default_rng(3)
    word = lambda n: [f"w{i}" for i in rng.integers(0, 1 << 20, n)]
    passage, texts = word(90), {}
    for i in range(0, 120, 2):  # passage and pairs that differ in 0.15 of all words, all in their own part
        own = word(40)
        texts[i], texts[i + 1] = passage + own, passage + changed(rng, own, 0.5)
    assert linked(spark, texts) >= 0.98


def test_op10_recall_at_the_bound(spark):
    rng = np.random.default_rng(4)
    texts = {}
    for i in range(0, 400, 2):  # 100 words, a fifth changed at random places: similarity 0.8
        texts[i] = [f"{i}w{j}" for j in rng.integers(0, 1 << 20, 100)]
        texts[i + 1] = changed(rng, texts[i], 0.2)
    assert linked(spark, texts, [(i, i + 1) for i in range(0, 400, 2)]) >= 0.95


def test_op10_short_texts(spark):
    rng = np.random.default_rng(5)
    texts, i = {}, 0
    for n in range(4, 24):
        for _ in range(3):  # one word changed, and one more
            texts[i] = [f"w{j}" for j in rng.integers(0, 2000, n)]
            texts[i + 1], texts[i + 2] = changed(rng, texts[i], 1 / n), [*texts[i][: n // 2], f"more{i}", *texts[i][n // 2 :]]
            i += 3
    assert linked(spark, texts) == 1


def test_op8_a_passage_belongs_to_who_wrote_all_of_it(spark):
    said = ["Hello\nFirst thing", "Hello\nSecond thing", "Hello\nThird\nBest\nwishes", "Fourth\nBest\nwishes"]
    said += ["> Hello\n> Second thing\nyes", "> Fourth\n> Best\n> wishes\nno", "> Hello\nhi"]
    talk = spark.createDataFrame([("c", i, "user", t) for i, t in enumerate(said)], "conv_id string, turn int, role string, text string")
    found = {r["turn"]: r["parent_turn"] for r in quotes.link_conversations(talk).collect()}
    assert found == {0: None, 1: None, 2: None, 3: None, 4: 1, 5: 3, 6: 0}


TALK = "conv_id string, turn int, role string, text string"


def test_op8_a_passage_wrapped_anew_and_its_order(spark):
    said = [
        "One fine day we met\nby the river.\n\nThe second part of it\nstands alone here.",
        "by the river one fine day we met",
        "> One fine day we\n> met by\n> the river.\nYes.",
        "> the second part of it stands alone here\nNo.",
        "On Monday Ann wrote:\n> by the river,\n> one fine day we met\nHm.",
        ">> One fine day we met by the\n>> river. The second part of\n>> it stands alone here.\n> Yes.\nAll.",
    ]
    found = {r["turn"]: r for r in quotes.link_conversations(spark.createDataFrame([("c", i, "u", t) for i, t in enumerate(said)], TALK)).collect()}
    assert {i: r["parent_turn"] for i, r in found.items()} == {0: None, 1: None, 2: 0, 3: 0, 4: 1, 5: 2}
    assert found[5]["linked"] == 2 and found[5]["depth"] == 2 and found[5]["own_text"] == "All."


def quoting_talk() -> list[tuple]:
    """Conversations whose messages quote earlier ones, wrapped anew, cut to some lines, nested, or made up."""
    pick, talk = random.Random(8), []
    for conv in range(12):
        own: list[list[str]] = []
        for turn in range(14):
            lines = [" ".join(pick.choice("red blue hill fox ran over sang low".split()) for _ in range(pick.randint(2, 5))) for _ in range(pick.randint(1, 4))]
            text = []
            if own and pick.random() < 0.8:
                source, marks = pick.choice(own), ">" * pick.randint(1, 3)
                way = pick.randrange(4)
                if way == 0:
                    words = " ".join(source).split()
                    text = [f"{marks} {' '.join(words[i:i + 3]).capitalize()}," for i in range(0, len(words), 3)]
                elif way == 1:
                    text = [f"{marks} {x}" for x in pick.sample(source, pick.randint(1, len(source)))]
                elif way == 2:
                    text = ["On a day Bob wrote:", *(f"> {x}" for x in source), *(f">> {x}" for x in pick.choice(own))]
                else:
                    text = [f"{marks} nobody said this"]
            if pick.random() < 0.3:
                lines.insert(len(lines) // 2, "")
            talk.append((None if conv == 11 else f"c{conv}", turn, "u", "\n".join([*text, *lines])))
            own.append([x for x in lines if x])
    return talk


def test_op8_generated_threads_by_sql_and_by_rows(spark):
    talk = quoting_talk()
    duck = duckdb.connect()
    duck.register("conversations", pd.DataFrame(talk, columns=["conv_id", "turn", "role", "text"]).astype({"turn": "int32"}))
    found = quotes.link_conversations(spark.createDataFrame(talk, TALK))
    assert not compare(duck, found, entry.oracle_sql()["op8_quotes"])[1]
    by_key = {(r["conv_id"], r["turn"]): r for r in found.collect()}
    plain = lambda x: " ".join(re.sub(r"[^a-z0-9]+", " ", x.lower()).split())
    linked = 0
    for conv in range(11):
        texts = [t for c, _, _, t in talk if c == f"c{conv}"]
        blocks, lines = [], []
        for text in texts:
            rows = text.split("\n")
            own = [x for i, x in enumerate(rows) if not x.startswith(">") and not x.endswith("wrote:")]
            blocks.append({plain(" ".join(own)), *(plain(" ".join(p.split("\n"))) for p in "\n".join(own).split("\n\n"))})
            lines.append({plain(x) for x in rows if not x.startswith(">")})
        for turn, text in enumerate(texts):
            answers = []
            for level, run in itertools.groupby(text.split("\n"), lambda x: len(x) - len(x.lstrip(">"))):
                said = [plain(x) for x in run]
                if not level:
                    continue
                whole = [i for i in range(turn) if " ".join(said) in blocks[i]]
                votes = [(sum(x in lines[i] for x in said), -i) for i in range(turn)]
                best = whole[0] if whole else -max(votes)[1] if votes and max(votes)[0] else None
                if best is not None:
                    answers.append((-level, best))
            expected = max(answers)[1] if answers else None
            assert by_key[f"c{conv}", turn]["parent_turn"] == expected
            linked += expected is not None
    assert linked > 60


def test_pipeline_stages_follow_each_other(spark, tables):
    seen = spark.read.parquet(f"{tables}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, seen, tables)
        path = f"{tables}-{name}"
        after.write.parquet(path)
        before, seen = seen, spark.read.parquet(path)
        kept.append({r["doc_id"] for r in seen.select("doc_id").collect()})
        if name != "tokens":
            assert seen.columns == before.columns
    language, near, clean, mixed, tokens = kept
    assert not language & {130, 131, 132, 133} and 0 in language
    assert near & {1, 100, 101, 102, 103, 104} == {1} and 110 not in near
    assert near - clean == {120, 121} & near
    assert mixed <= clean and len(mixed) >= 0.6 * len(clean) and tokens == mixed


def test_op10_ids_survive_and_repeated_ids_have_one_text(spark):
    high, copy = 2**53 + 1, 2**53 + 3
    rows = [(high, prose(1)), (copy, prose(1)), (None, prose(2)), (5, prose(3)), (5, prose(2)), (5, None), (6, prose(2)), (7, prose(3))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).selectExpr("*", "1 AS class_id", "'x' AS node", "2 AS bucket")
    found = {r["doc_id"]: r["class_id"] for r in omh.near_classes(docs).collect()}
    least = 6 if prose(2) < prose(3) else 7
    assert found == {high: high, copy: high, None: 5 if least == 6 else 6, 5: 5, 6: 5 if least == 6 else 6, 7: 5 if least == 7 else 7}


HIGH = (2**53 + 1, 2**53 + 3)


def write(spark, path, schema, rows):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(path))


def test_large_ids_survive_beside_a_null_one(spark, tmp_path):
    page = "<html>" + "x" * 200 + "</html>"
    write(spark, tmp_path / "pages.parquet", "page_id long, url string, html string", [(HIGH[0], "u", page), (HIGH[1], "u", page), (None, "u", page)])
    pages = {r["page_id"]: r["refers_to"] for r in rows(spark, str(tmp_path), "op1_warc")}
    assert pages == {HIGH[0]: None, HIGH[1]: HIGH[0], None: HIGH[0]}
    texts = [(HIGH[0], prose(1), "en", 1), (HIGH[1], prose(2), "en", 2), (None, prose(3), "en", 3)]
    write(spark, tmp_path / "documents.parquet", "doc_id long, text string, lang string, n_chars long", texts)
    write(spark, tmp_path / "labels.parquet", "doc_id long, quality int", [(HIGH[0], 1), (HIGH[1], 0)])
    for name in ("op2_huffman", "op9_quality", "op5_langid", "op7_katz"):
        assert {r["doc_id"] for r in rows(spark, str(tmp_path), name)} == {*HIGH, None}, name


def test_op5_number_forms_are_no_letters(spark):
    learned = spark.createDataFrame([(i, prose(i, lang), lang) for i in range(40) for lang in ("en", "fr")], "doc_id long, text string, lang string")
    model = langid.fit(learned)
    texts = ["½ ² Ⅷ ③", "½ " + prose(500), "", None, "٣٤", "²²²"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    found = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs, model).collect()}
    assert found[1] == "en" and {found[i] for i in (0, 2, 3, 4, 5)} == {"und"}


def test_op9_replaces_columns_of_its_names(spark):
    docs = spark.createDataFrame([(i, prose(i, ("en", "fr")[i % 2]), i % 2, "mine") for i in range(40)], "doc_id long, text string, quality int, score string")
    featured = quality.with_statistics(docs, keep=("doc_id", "quality", "score"))
    model = quality.fit(featured.selectExpr("*", "doc_id % 3 = 0 AS tune"))
    found = quality.score(featured, model)
    assert found.columns.count("score") == 1 and dict(found.dtypes)["score"] == "double" and found.count() == 40
