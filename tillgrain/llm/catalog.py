"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path
from . import (blockdedup, decontaminate, fingerprint, hardnegatives, langid, linededup, merkle, minhash, packing, pii,
               quality, suffixdedup, tokenfiles)
from .common import id_remainder, prepare, table

PII_KEY = "production surrogate key"


def tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_fingerprints(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder(3) == 1
    detector = langid.fit(docs.filter(~held_out))
    return docs.select("doc_id", held_out.alias("held_out"),
                       langid.detect(F.col("text"), detector).alias("found")).select(
        "doc_id", "held_out", F.col("found.lang_pred").alias("lang_pred"),
        F.col("found.score").alias("score"), F.col("found.rejected").alias("rejected"))


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.anonymize(table(spark, sf_dir, "documents"), PII_KEY).select(
        "doc_id", "text", "lang", "source", "n_chars", "n_entities")


def op5_block_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blockdedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    tokenfiles.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer("word_bpe_49k.json"))
    return tokenfiles.stored_documents(spark, path)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = id_remainder(5) == 0
    known = labels.filter(~held_out & F.col("quality").isNotNull()).select(
        "doc_id", F.col("quality").alias("label"))
    weights = quality.fit(docs.select("doc_id", "text"), known)
    return docs.select("doc_id", held_out.alias("held_out"),
                       quality.scores(F.col("text"), weights).alias("score")).withColumn(
        "predicted", (F.col("score") >= quality.CUT).cast("int"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.when(id_remainder(2) == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    rows = merkle.manifest(merkle.document_leaves(docs, tampered))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("proof")).cast("binary"), 256).alias("proof_sha256"),
        merkle.folded(F.col("claimed"), F.col("proof")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of some rows are moved first, and components are taken as whole numbers."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double"))
    points = hardnegatives.usable(rows, "vec_id", label, F.col("embedding"), whole)
    return hardnegatives.mine(points, F.col("id") % 100 == 0)


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.remove_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_fingerprint, op2_decontamination, op3_language_id, op4_surrogates, op5_block_dedup,
    op6_token_files, op7_quality, op8_suffix_dedup, op9_near_duplicates, op10_packing, op11_merkle_manifest,
    op12_hard_negatives, op13_line_dedup, pipeline)}

# The other operators learn a model, tokenize, or take far longer than a check in SQL over
# whole texts; they are tested against brute force.
SQL = {
    "op5_block_dedup": r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(words) - 11)) AS pos, words FROM w WHERE len(words) >= 13),
hashed AS (SELECT doc_id, pos, md5(array_to_string(words[pos:pos + 12], ' ')) AS h FROM windows),
heads AS (SELECT h, min(doc_id) AS doc FROM hashed GROUP BY h HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 13)) AS pos
  FROM hashed JOIN heads USING (h) WHERE doc_id > doc),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM w)
  ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""",
    "op11_merkle_manifest": r"""
WITH RECURSIVE d AS (
  SELECT *, CASE WHEN source IS NULL THEN '' ELSE '+' || source END AS tree FROM documents),
l AS (
  SELECT doc_id, tree, head, text,
    sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf
  FROM (SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
      || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head FROM d)),
lower_levels AS (
  SELECT tree, 0 AS level, list(leaf ORDER BY doc_id) AS nodes FROM l GROUP BY tree
  UNION ALL
  SELECT tree, level + 1, list_transform(range(0, len(nodes), 3), lambda k: sha256(array_to_string(nodes[k + 1:k + 3], '')))
  FROM lower_levels WHERE len(nodes) > 1),
subroots AS (SELECT tree, level AS height, nodes[1] AS subroot,
  row_number() OVER (ORDER BY tree) - 1 AS place FROM lower_levels WHERE len(nodes) = 1),
upper_levels AS (
  SELECT 0 AS level, list(subroot ORDER BY tree) AS nodes FROM subroots
  UNION ALL
  SELECT level + 1, list_transform(range(0, len(nodes), 3), lambda k: sha256(array_to_string(nodes[k + 1:k + 3], '')))
  FROM upper_levels WHERE len(nodes) > 1),
root AS (SELECT nodes[1] AS root FROM upper_levels WHERE len(nodes) = 1),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS place FROM l),
steps AS (
  SELECT doc_id, level, nodes, (place // (3 ** level)::BIGINT) AS pos
  FROM leaves JOIN lower_levels USING (tree) WHERE len(nodes) > 1
  UNION ALL
  SELECT doc_id, height + level, nodes, (subroots.place // (3 ** level)::BIGINT)
  FROM leaves JOIN subroots USING (tree), upper_levels WHERE len(nodes) > 1),
ways AS (
  SELECT doc_id, level, array_to_string(nodes[pos - pos % 3 + 1:pos], '') AS before,
         array_to_string(nodes[pos + 2:pos - pos % 3 + 3], '') AS after FROM steps),
proofs AS (
  SELECT doc_id, sha256(string_agg(before || after, '' ORDER BY level)) AS proof_sha256,
         list({'b': before, 'a': after} ORDER BY level) AS way FROM ways GROUP BY doc_id),
-- crc32 of a number's digits, bit by bit
bits AS (
  SELECT doc_id, doc_id::VARCHAR AS s, 0 AS k, 4294967295::BIGINT AS c FROM documents
  UNION ALL
  SELECT doc_id, s, k + 1, CASE WHEN k % 8 = 0 THEN step(xor(c, ascii(s[k // 8 + 1])::BIGINT)) ELSE step(c) END
  FROM bits WHERE k < 8 * len(s)),
claims AS (
  SELECT leaves.*, CASE WHEN text IS NOT NULL AND xor(c, 4294967295) % 2 = 0
    THEN sha256(head || strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), '')) ELSE leaf END AS claimed
  FROM leaves JOIN bits USING (doc_id) WHERE k = 8 * len(s)),
fold AS (
  SELECT doc_id, 1 AS k, claimed AS h, way FROM claims LEFT JOIN proofs USING (doc_id)
  UNION ALL
  SELECT doc_id, k + 1, sha256(way[k].b || h || way[k].a), way FROM fold WHERE k <= len(way))
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
       h AS folded_root, h = root AS verified
FROM claims JOIN subroots USING (tree) CROSS JOIN root LEFT JOIN proofs USING (doc_id)
JOIN fold USING (doc_id) WHERE fold.k = coalesce(len(fold.way), 0) + 1""".replace(
        "step(xor(c, ascii(s[k // 8 + 1])::BIGINT))", "xor(xor(c, ascii(s[k // 8 + 1])::BIGINT) // 2, "
        "3988292384 * (xor(c, ascii(s[k // 8 + 1])::BIGINT) % 2))").replace(
        "step(c)", "xor(c // 2, 3988292384 * (c % 2))"),
    "op12_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         list_dot_product(a.x, b.x)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT * FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id))::INT AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5""",
    "op13_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
keys AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
marked AS (
  SELECT *, length(key) >= 10 AND min(doc_id) OVER (PARTITION BY key) < doc_id AS gone FROM keys)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
}


def queries():
    def runner(query):
        def run(spark, sf_dir):
            prepare(spark)
            return query(spark, sf_dir)
        return run
    return {name: runner(query) for name, query in QUERIES.items()}


def oracle_sql():
    return dict(SQL)
