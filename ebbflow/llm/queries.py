"""One query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.llm import (
    bpe,
    decontaminate,
    huffman,
    katz,
    langid,
    merkle,
    mixing,
    omh,
    permutation,
    quality,
    quotes,
    warc,
    whitening,
)
from ebbflow.llm.common import fold, materialized, run_folder, table, tokenizer_file, tokenizer_pattern
from ebbflow.llm.registry import query


@query(
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
         d AS (SELECT page_id, strlen(body) AS n, sha256(body) AS digest FROM p),
         f AS (SELECT digest, min(page_id) AS first_id FROM d WHERE n >= 100 GROUP BY digest)
    SELECT d.page_id, d.n AS payload_bytes, d.digest AS payload_digest,
           CASE WHEN d.n >= 100 AND d.page_id <> f.first_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN d.n >= 100 AND d.page_id <> f.first_id THEN f.first_id END AS refers_to
    FROM d LEFT JOIN f USING (digest)
    """
)
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived in monolithic gzip, normalised, and read back by the offsets of the index."""
    folder = run_folder(spark, "warc")
    files = warc.write_monolithic(warc.with_roles(table(spark, sf_dir, "pages")), f"{folder}/whole")
    index = materialized(warc.normalise(files, f"{folder}/members"))
    view = warc.page_view(warc.read_records(index))
    return view.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op2_huffman(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written as Huffman codes in order of doc_id, and read back."""
    docs = table(spark, sf_dir, "documents")
    manifest = huffman.write_corpus(docs, run_folder(spark, "huffman"), tokenizer_file("byte_bpe_50k.json"))
    return huffman.read_corpus(manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


@query(
    r"""
    WITH RECURSIVE m AS (
        SELECT conv_id, turn, role, coalesce(text, '') AS text,
               row_number() OVER (ORDER BY conv_id NULLS FIRST, turn NULLS FIRST, role NULLS FIRST,
                                  coalesce(text, '')) AS position
        FROM conversations
    ), l AS (
        SELECT position, conv_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS line_no
        FROM m
    ), v AS (
        SELECT *, length(regexp_replace(regexp_extract(line, '^([ \t]*>)+[ \t]?'), '[^>]', '', 'g')) AS level,
               lower(trim(regexp_replace(regexp_replace(line, '^([ \t]*>)+[ \t]?', ''),
                                         '[\s[:punct:]]+', ' ', 'g'))) AS said
        FROM l
    ), w AS (
        SELECT *, lag(level, 1, -1) OVER (PARTITION BY position ORDER BY line_no) AS last_level,
               lead(level, 1, 0) OVER (PARTITION BY position ORDER BY line_no) AS next_level
        FROM v
    ), x AS (
        SELECT *, sum((level <> last_level)::int) OVER (PARTITION BY position ORDER BY line_no) AS passage,
               sum((level <> last_level OR announces OR said = '')::int)
                   OVER (PARTITION BY position ORDER BY line_no) AS paragraph
        FROM (SELECT *, level = 0 AND next_level > 0
                        AND regexp_matches(line, '^(On|Le|Am|El) .*(wrote|a écrit|schrieb|escribió) ?:[ \t]*$') AS announces
              FROM w)
    ), own AS (
        SELECT position, regexp_replace(string_agg(line, chr(10) ORDER BY line_no), '^\s+|\s+$', '', 'g') AS own_text
        FROM x
        WHERE level = 0 AND NOT announces GROUP BY position
    ), blocks AS (
        SELECT conv_id, position, string_agg(said, ' ' ORDER BY line_no) AS block
        FROM x WHERE level = 0 AND said <> '' AND NOT announces GROUP BY conv_id, position
        UNION ALL
        SELECT conv_id, position, string_agg(said, ' ' ORDER BY line_no) AS block
        FROM x WHERE level = 0 AND said <> '' AND NOT announces GROUP BY conv_id, position, paragraph
    ), firsts AS (
        SELECT conv_id, block, min(position) AS original FROM blocks GROUP BY 1, 2
    ), quoted AS (
        SELECT conv_id, position, passage, level, string_agg(said, ' ' ORDER BY line_no) AS block
        FROM x WHERE level > 0 AND said <> '' GROUP BY 1, 2, 3, 4
    ), whole AS (
        SELECT q.position, q.passage, f.original FROM quoted q JOIN firsts f
        ON q.conv_id = f.conv_id AND q.block = f.block AND f.original < q.position
    ), written AS (
        SELECT DISTINCT conv_id, said, position AS original FROM x WHERE level = 0 AND said <> ''
    ), votes AS (
        SELECT q.position, q.passage, q.level, o.original, count(*) AS n
        FROM x q LEFT JOIN written o
             ON q.conv_id = o.conv_id AND q.said = o.said AND o.original < q.position
        WHERE q.level > 0 AND q.said <> '' GROUP BY 1, 2, 3, 4
    ), passages AS (
        SELECT v.position, v.passage, v.level,
               coalesce(any_value(w.original), arg_max(v.original, (v.n, -v.original)) FILTER (v.original IS NOT NULL)) AS original
        FROM votes v LEFT JOIN whole w ON w.position = v.position AND w.passage = v.passage GROUP BY 1, 2, 3
    ), parents AS (
        SELECT position, arg_max(original, (-level, original)) AS parent
        FROM passages WHERE original IS NOT NULL GROUP BY 1
    ), up AS (
        SELECT position, parent AS root, 1 AS depth FROM parents
        UNION ALL
        SELECT up.position, p.parent, up.depth + 1 FROM up JOIN parents p ON p.position = up.root
    ), roots AS (
        SELECT position, min(root) AS root, max(depth) AS depth FROM up GROUP BY 1
    ), counts AS (
        SELECT position, count(*) AS passages, count(original) AS linked, max(level) AS max_level
        FROM passages GROUP BY 1
    )
    SELECT m.conv_id, m.turn, m.role, coalesce(own.own_text, '') AS own_text, pm.turn AS parent_turn,
           coalesce(r.depth, 0)::bigint AS depth, coalesce(c.passages, 0)::bigint AS passages,
           coalesce(c.linked, 0)::bigint AS linked, coalesce(c.max_level, 0)::bigint AS max_level,
           row_number() OVER (ORDER BY m.conv_id NULLS FIRST, coalesce(r.root, m.position), m.position) AS reply_order
    FROM m LEFT JOIN own USING (position) LEFT JOIN parents USING (position)
         LEFT JOIN m pm ON pm.position = parents.parent
         LEFT JOIN roots r ON r.position = m.position LEFT JOIN counts c ON c.position = m.position
    """
)
def op8_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message with what it answers and its place in reply order, quotations taken out."""
    return quotes.link_conversations(table(spark, sf_dir, "conversations"))


@query()
def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from four folds of five."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = langid.fit(docs.filter(~held_out).select("doc_id", "text", "lang"))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), "rejected")


@query()
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from two folds of three of the labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 3) == 1
    featured = materialized(quality.with_statistics(docs))
    marks = table(spark, sf_dir, "labels").select("doc_id", "quality").filter(~held_out)
    labelled = featured.join(marks, "doc_id").withColumn("tune", fold(F.col("doc_id"), 10) == 0)
    model = quality.fit(labelled)
    return quality.score(featured, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query()
def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the class of its near duplicates and the first document with the same words."""
    return omh.near_classes(table(spark, sf_dir, "documents"))


@query(
    f"SELECT doc_id, source, lang, topic, tokens, round(probability, 6) AS probability, selected FROM ({mixing.sql()})"
)
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its calibrated probability, and whether the mix takes it."""
    found = mixing.sample(table(spark, sf_dir, "documents"))
    none = F.lit(mixing.NONE)
    return found.select(
        "doc_id",
        F.coalesce("source", none).alias("source"),
        F.coalesce("lang", none).alias("lang"),
        "topic",
        "tokens",
        F.round("probability", 6).alias("probability"),
        "selected",
    )


@query()
def op6_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors to every twentieth one, over all vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    return permutation.nearest(vectors, vectors.filter("vec_id % 20 = 0"), 20)


@query()
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, as it is or with other parameters."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op7_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log probability of every document, learned from four folds of five."""
    held_out = fold(F.col("doc_id"), 5) == 1
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (~held_out).alias("train"))
    found = katz.score(docs)
    columns = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    return found.select("doc_id", held_out.alias("held_out"), *columns)


@query(
    r"""
    WITH RECURSIVE d AS (
        SELECT *, n_chars + 1 AS claimed,
               list_reduce(list_prepend(4294967295::BIGINT,
                   list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                   lambda acc, byte: list_reduce(
                       [xor(acc, byte), 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT],
                       lambda crc, _: CASE WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384::BIGINT) ELSE crc >> 1 END)) AS crc
        FROM documents
    ), e AS (
        SELECT doc_id, lang, xor(crc, 4294967295::BIGINT) % 7 = 0 AS doubted,
               coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') AS head,
               coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS told,
               coalesce(strlen(claimed::VARCHAR) || ':' || claimed, '-') AS claim,
               coalesce(strlen(text) || ':' || text, '-') AS body
        FROM d
    ), h AS (
        SELECT doc_id, lang, sha256(head || told || body) AS leaf,
               CASE WHEN doubted THEN sha256(head || claim || body) ELSE sha256(head || told || body) END AS claimed
        FROM e
    ), leaves AS (
        SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS tree,
               row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
               count(*) OVER (PARTITION BY lang) AS n
        FROM h
    ), nodes AS (
        SELECT tree, 0 AS level, idx, n, leaf AS digest FROM leaves
        UNION ALL
        SELECT tree, any_value(level) + 1, idx // 2, (any_value(n) + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx))
        FROM nodes WHERE n > 1 GROUP BY tree, idx // 2
    ), subroots AS (
        SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n
        FROM nodes WHERE n = 1
    ), over_nodes AS (
        SELECT 0 AS level, idx, n, subroot AS digest FROM subroots
        UNION ALL
        SELECT any_value(level) + 1, idx // 2, (any_value(n) + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx))
        FROM over_nodes WHERE n > 1 GROUP BY idx // 2
    ), steps AS (
        SELECT l.doc_id, l.tree, l.idx AS leaf_idx, s.level, xor(l.idx >> s.level, 1) < (l.idx >> s.level) AS left_side,
               s.digest
        FROM leaves l JOIN nodes s ON s.tree = l.tree AND s.n > 1 AND s.idx = xor(l.idx >> s.level, 1)
        UNION ALL
        SELECT l.doc_id, l.tree, l.idx, 100 + s.level, xor(t.idx >> s.level, 1) < (t.idx >> s.level), s.digest
        FROM leaves l JOIN subroots t ON t.tree = l.tree
             JOIN over_nodes s ON s.n > 1 AND s.idx = xor(t.idx >> s.level, 1)
    ), heights AS (
        SELECT tree, max(level) AS height FROM nodes GROUP BY tree
    ), rounds AS (
        SELECT l.tree, l.idx, l.level, left_side, digest
        FROM (SELECT tree, idx, height, unnest(range(0, height)) AS level FROM leaves JOIN heights USING (tree)) l
             LEFT JOIN steps s ON s.tree = l.tree AND s.leaf_idx = l.idx AND s.level = l.level
        UNION ALL
        SELECT l.tree, l.idx, l.level, left_side, digest
        FROM (SELECT tree, idx, unnest(range(100, 100 + (SELECT max(level) FROM over_nodes))) AS level FROM leaves) l
             LEFT JOIN steps s ON s.tree = l.tree AND s.leaf_idx = l.idx AND s.level = l.level
    ), numbered AS (
        SELECT tree, idx, row_number() OVER (PARTITION BY tree, idx ORDER BY level) AS step, left_side, digest FROM rounds
    ), folding AS (
        SELECT tree, idx, 0 AS step, claimed AS digest FROM leaves
        UNION ALL
        SELECT f.tree, f.idx, n.step, sha256(CASE WHEN n.digest IS NULL THEN f.digest WHEN n.left_side
                                             THEN n.digest || f.digest ELSE f.digest || n.digest END)
        FROM folding f JOIN numbered n ON n.tree = f.tree AND n.idx = f.idx AND n.step = f.step + 1
    ), folded AS (
        SELECT tree, idx, arg_max(digest, step) AS folded_root FROM folding GROUP BY 1, 2
    ), proofs AS (
        SELECT tree, idx, sha256(coalesce(string_agg(digest, '' ORDER BY step), '')) AS proof_sha256
        FROM numbered GROUP BY 1, 2
    ), top AS (SELECT digest AS root FROM over_nodes WHERE n = 1)
    SELECT l.doc_id, l.leaf, s.subroot, t.root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, f.folded_root,
           f.folded_root = t.root AS verified
    FROM leaves l JOIN subroots s USING (tree) CROSS JOIN top t
         LEFT JOIN proofs p ON p.tree = l.tree AND p.idx = l.idx JOIN folded f ON f.tree = l.tree AND f.idx = l.idx
    """
)
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's digest, its proof, and whether the document as claimed still leads to the root."""
    docs = table(spark, sf_dir, "documents")
    claimed = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") + 1, F.col("text")]
    tampered = F.when(fold(F.col("doc_id"), 7) == 0, merkle.leaf_digest(claimed))
    return merkle.manifest(docs, tampered=tampered)


@query()
def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, and the bytes that they stand for."""
    path = tokenizer_file("byte_bpe_50k.tiktoken")
    ids = bpe.encode(table(spark, sf_dir, "documents"), path, tokenizer_pattern())
    return bpe.decode(ids, path).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query()
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's whitened components, the directions learned from all vectors."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
