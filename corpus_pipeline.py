"""A corpus from documents to token files, in five stages.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns what it keeps of all of
docs, with the columns of documents, but for the last, which returns what it wrote. ``run`` applies them in turn,
each result written as Parquet and read again by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.llm import decontaminate, huffman, langid, mixing, omh
from ebbflow.llm.common import materialized, one_row_per_id, run_folder, table, tokenizer_file

#: Most of what is clean is kept: the mix leans lightly towards small sources and languages.
MIX = mixing.Settings(keep=0.9, targets={"source": 0.95, "lang": 0.95, "topic": 0.95}, seed="pipeline")


def _set_aside(docs: DataFrame, *names: str) -> DataFrame:
    """The documents with columns that an operator would replace under other names."""
    return docs.withColumnsRenamed({name: f"_own_{name}" for name in names if name in docs.columns})


def _as_before(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs, those that were set aside under their names again."""
    there = set(rows.columns)
    return rows.select(*[F.col(f"_own_{name}" if f"_own_{name}" in there else name).alias(name) for name in docs.columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; a missing ``lang`` is filled in.

    Learns from a bounded sample of the documents that state a language; with none there is nothing to reject by,
    and only documents without a letter go.
    """
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    found = langid.predict(_set_aside(docs, "lang_pred", "lang_score", "rejected"), model)
    if model.languages:
        kept = found.filter(~F.col("rejected")).withColumn("lang", F.coalesce("lang", "lang_pred"))
    else:
        kept = found.filter(F.col("text").rlike(r"\p{L}"))
    return _as_before(kept, docs)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each class, once. Of rows that repeat a doc_id the one with the least
    text counts; documents without an id stay, once a text, unless they are copies of one that has an id."""
    docs = one_row_per_id(docs)
    classes = omh.near_classes(docs)
    first = classes.filter("doc_id = class_id").select("doc_id")
    kept = docs.join(first, "doc_id", "left_semi").select(*docs.columns)
    bare = docs.filter("doc_id is null")
    return kept if bare.isEmpty() else kept.unionByName(_without_id(bare, docs))


def _without_id(bare: DataFrame, docs: DataFrame) -> DataFrame:
    """One of each text among documents without an id, the least by its other columns, where no document with an id
    has that text."""
    digest = F.sha2("text", 256)
    held = docs.filter("doc_id is not null").select(digest.alias("_digest"))
    rest = F.struct(*docs.columns)
    one = bare.groupBy(digest.alias("_digest")).agg(F.min_by(rest, F.to_json(rest)).alias("_row"))
    return one.join(held, "_digest", "left_anti").select("_row.*").select(*docs.columns)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the calibrated probabilities take."""
    apart = _set_aside(docs, "topic", "tokens", "probability", "selected")
    return _as_before(mixing.sample(apart, MIX).filter("selected"), docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the token files, read back from them."""
    manifest = huffman.write_corpus(docs, run_folder(spark, "corpus"), tokenizer_file("byte_bpe_50k.json"))
    return huffman.read_corpus(manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", remove_near_duplicates),
    ("decontamination", remove_benchmark),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

#: SQL has no words for the learned and sketched stages; the tests follow planted cases through the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialized(stage(spark, docs, sf_dir))
    return docs
