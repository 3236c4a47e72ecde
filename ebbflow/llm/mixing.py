"""Mixing sources to target weights: token weights raked to three marginals, then documents sampled.

Documents are counted into cells of source, language and topic. Iterative proportional fitting scales the cells'
weights in turn to each marginal's target shares; a cell never gets more than the tokens it has. A document's
probability is its cell's fitted weight over its cell's tokens, and a document is taken where a hash of its id,
uniform in [0, 1), is below that: the same documents on every run, and tasks that are run again agree.

All of it is DataFrame work: documents are shuffled never, only cells are, whose number is that of the distinct
combinations. Sums over cells are aggregated where they lie before they move.

Targets: shares by value for each marginal, or an exponent a, which aims at shares in proportion to tokens**a (1
leaves a marginal as it is, 0 evens it out). Values without a given share aim at what they have; targets are
scaled to add up to 1.

Defined results: a null source or language is a value of its own (``(none)``); a null text has no tokens, and a
cell without tokens has probability 0. Rows with equal ids share their fate; null ids do so as well. An empty
table gives no row. Columns that have the added names already are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.llm.common import materialized

NONE = "(none)"
MARGINALS = ("source", "lang", "topic")


@dataclass(frozen=True)
class Settings:
    keep: float = 0.5  # share of all tokens to take
    targets: Mapping[str, float | Mapping[str, float]] = field(
        default_factory=lambda: {"source": 0.7, "lang": 0.7, "topic": 0.8}
    )
    rounds: int = 12
    seed: str = "mix"


# What a text must hold to be of a topic; the first that fits.
TOPICS = (("legal", ("license", "copyright")), ("contact", ("@", "http")), ("technical", ("token", "{", "=")))


def topic_of(text: Column) -> Column:
    lower = F.lower(text)
    found = None
    for name, words in TOPICS:
        has = F.lit(False)
        for word in words:
            has = has | F.contains(lower, F.lit(word))
        found = F.when(has, name) if found is None else found.when(has, name)
    return found.otherwise("prose")


def tokens_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\r\f\x0B]+")), F.lit(0)).cast("long")


def described(docs: DataFrame) -> DataFrame:
    """The documents with _source, _lang, _topic and _tokens."""
    return docs.withColumns(
        {
            "_source": F.coalesce("source", F.lit(NONE)),
            "_lang": F.coalesce("lang", F.lit(NONE)),
            "_topic": topic_of(F.coalesce("text", F.lit(""))),
            "_tokens": tokens_of(F.col("text")),
        }
    )


def _target(marginal: str, targets: float | Mapping[str, float]) -> Column:
    """What a value aims at, before scaling; its cells' tokens are in ``_has``."""
    if isinstance(targets, Mapping):
        share = F.col("_has") / F.col("_all")
        for value, given in targets.items():
            share = F.when(F.col(f"_{marginal}") == value, float(given)).otherwise(share)
        return share
    return F.pow(F.col("_has") / F.col("_all"), F.lit(float(targets)))


def rake(cells: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Cells (_source, _lang, _topic, tokens) with ``weight``, the tokens wanted of each, at most what it has."""
    cells = materialized(cells.filter("tokens > 0"))
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    rows = cells.withColumns({"weight": F.col("tokens") * F.lit(settings.keep), "_all": F.lit(total)})
    for m in MARGINALS:
        sums = rows.groupBy(f"_{m}", "_all").agg(F.sum("tokens").alias("_has"))
        aims = materialized(sums.select(f"_{m}", _target(m, settings.targets[m]).alias("_aim")))
        whole = aims.agg(F.sum("_aim")).first()[0] or 1.0
        scaled = (F.col("_aim") / F.lit(whole) * F.lit(total * settings.keep)).alias(f"_aim_{m}")
        rows = rows.join(aims.select(f"_{m}", scaled), f"_{m}")
    for done in range(settings.rounds):
        for m in MARGINALS:
            # A value's cells are few: the combinations of the other two marginals.
            has = F.sum("weight").over(Window.partitionBy(f"_{m}"))
            rows = rows.withColumn("_f", F.col(f"_aim_{m}") / has)
            rows = rows.withColumn("weight", F.least(F.col("weight") * F.col("_f"), F.col("tokens"))).drop("_f")
        if done % 4 == 3:
            rows = materialized(rows)
    return rows.select("_source", "_lang", "_topic", "tokens", "weight")


def sample(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents' own columns, topic, tokens, probability and selected."""
    docs = docs.drop("topic", "tokens", "probability", "selected")
    rows = described(docs)
    cells = rows.groupBy("_source", "_lang", "_topic").agg(F.sum("_tokens").alias("tokens"))
    raked = materialized(rake(cells, settings).select("_source", "_lang", "_topic", (F.col("weight") / F.col("tokens")).alias("_p")))
    hexed = F.substring(F.md5(F.concat_ws(":", F.lit(settings.seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(NONE)))), 1, 8)
    uniform = F.conv(hexed, 16, 10).cast("double") / F.lit(4294967296.0)
    rows = rows.join(raked, ["_source", "_lang", "_topic"], "left")
    probability = F.coalesce("_p", F.lit(0.0))
    return rows.select(
        *[F.col(c) for c in docs.columns],
        F.col("_topic").alias("topic"),
        F.col("_tokens").alias("tokens"),
        probability.alias("probability"),
        (uniform < probability).alias("selected"),
    )


def sql(settings: Settings = Settings(), documents: str = "documents") -> str:
    """The same in DuckDB's SQL, for exponents as targets: a common table expression per step of the raking."""
    lower = "lower(coalesce(text, ''))"
    topic = " ".join(
        f"WHEN {' OR '.join(f'contains({lower}, {w!r})' for w in words)} THEN '{name}'" for name, words in TOPICS
    )
    steps = [
        f"""d AS MATERIALIZED (
            SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang,
                   CASE {topic} ELSE 'prose' END AS topic,
                   coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\r\\f\\x0B]+')), 0) AS tokens
            FROM {documents})""",
        """c AS MATERIALIZED (
            SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens FROM d GROUP BY ALL HAVING sum(tokens) > 0)""",
    ]
    for m in MARGINALS:
        power = float(settings.targets[m])
        steps.append(
            f"""t_{m} AS MATERIALIZED (
            SELECT {m}, (SELECT sum(tokens) FROM c) * {settings.keep}
                   * (pow(has / (SELECT sum(tokens) FROM c), {power}) / sum(pow(has / (SELECT sum(tokens) FROM c), {power})) OVER ())
                   AS aim_{m}
            FROM (SELECT {m}, sum(tokens) AS has FROM c GROUP BY {m}))"""
        )
    steps.append(
        f"""w0 AS MATERIALIZED (
            SELECT *, tokens * {settings.keep}::DOUBLE AS weight
            FROM c JOIN t_source USING (source) JOIN t_lang USING (lang) JOIN t_topic USING (topic))"""
    )
    n = 0
    for _ in range(settings.rounds):
        for m in MARGINALS:
            steps.append(
                f"""w{n + 1} AS MATERIALIZED (
            SELECT * REPLACE (least(weight * (aim_{m} / sum(weight) OVER (PARTITION BY {m})), tokens) AS weight) FROM w{n})"""
            )
            n += 1
    uniform = f"('0x' || substr(md5('{settings.seed}:' || coalesce(doc_id::VARCHAR, '{NONE}')), 1, 8))::UBIGINT / 4294967296.0"
    return f"""WITH {", ".join(steps)}
        SELECT d.doc_id, d.source, d.lang, d.topic, d.tokens, coalesce(w.weight / w.tokens, 0)::DOUBLE AS probability,
               {uniform} < coalesce(w.weight / w.tokens, 0) AS selected
        FROM d LEFT JOIN w{n} w USING (source, lang, topic)"""
