"""The registered corpus queries: thin digests over the operators' own results, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe_codec, chat_format, collocations, hard_negatives, langid_hd, line_dedup, mixing, ngram_join, pii_feistel, token_fst, topk_taat, vptree, warc
from tidemark.llm.common import ship

#: The key of the pseudonyms in the query; a deployment passes its own secret to the operator.
DEMO_KEY = b"public demonstration key"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.round_trip_digests(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_components(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return vptree.nearest(rows, rows.where("vec_id % 50 = 0"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid_hd.identify(_table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_feistel.pseudonymise(_table(spark, sf_dir, "documents"), DEMO_KEY)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return warc.read_archives(warc.write_archives(pages)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_fst.token_counts(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return topk_taat.top_k(rows, rows.where("vec_id % 50 = 0"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digests(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.hard_negatives(rows, rows.where("vec_id % 50 = 0"))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    messages = table.unionByName(odd).withColumn("parts", chat_format.text_parts(F.col("text")))
    return chat_format.digests(chat_format.formatted(messages))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
owned AS (SELECT *, min(doc_id) OVER (PARTITION BY k) AS owner FROM keyed),
flagged AS (SELECT *, length(k) >= 10 AND doc_id <> owner AS gone FROM owned)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM flagged GROUP BY doc_id"""

#: Exact neighbours: what the recall of op4_nearest, which is approximate, is measured against.
EXACT_NEAREST_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.e, c.e) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM s
QUALIFY rank <= 5"""

OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM s
QUALIFY rank <= 5"""

OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.e, c.e) AS HUGEINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS ps FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id AS negative_id,
  CAST(ps AS BIGINT) AS positive_score, CAST(score AS BIGINT) AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * ps <= 100 * score AND 100 * score <= 95 * ps
QUALIFY rank <= 3"""

OP12_SQL = r"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
f AS (
  SELECT *, len(text) + len(regexp_extract_all(text, '<\\*(?:\|[^<|\[\\]*\|>|/?s>|nl>)|\[\\*/?INST\]')) AS chars,
    len(role) + len(regexp_extract_all(role, '<\\*(?:\|[^<|\[\\]*\|>|/?s>|nl>)|\[\\*/?INST\]')) + 3 * (len(role) - len(replace(role, chr(10), ''))) AS head
  FROM m)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(len(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(8 + head + 1 + chars + 8) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id"""

OP13_SQL = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
grams AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces), (VALUES (1), (2), (3), (4)) s(size) WHERE i + size - 1 <= len(w)),
f AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r, CAST(CAST(2000000 AS HUGEINT) * a // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM c) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:k], ' ') JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[k + 1:], ' ')
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, size + 1)) AS i FROM c WHERE size > 2) c, (VALUES (2), (3)) s(m) WHERE m < size AND i + m - 1 <= size GROUP BY ALL)
SELECT cuts.lang, CAST(row_number() OVER (PARTITION BY cuts.lang ORDER BY score DESC, a DESC, cuts.phrase) AS BIGINT) AS rank, cuts.phrase AS phrase, a, l, r, n, score
FROM cuts JOIN n ON n.lang = cuts.lang LEFT JOIN inner_ ON inner_.lang = cuts.lang AND inner_.phrase = cuts.phrase
WHERE longer IS NULL OR CAST(100 AS HUGEINT) * longer < CAST(80 AS HUGEINT) * a
QUALIFY rank <= 2000"""

QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_mix_sources": op2_mix_sources,
    "op3_ngram_join": op3_ngram_join,
    "op4_nearest": op4_nearest,
    "op5_language": op5_language,
    "op6_pii": op6_pii,
    "op7_warc": op7_warc,
    "op8_token_counts": op8_token_counts,
    "op9_top_k": op9_top_k,
    "op10_line_dedup": op10_line_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_chat_format": op12_chat_format,
    "op13_collocations": op13_collocations,
}

ORACLE = {
    "op2_mix_sources": mixing.sql(),
    "op9_top_k": OP9_SQL,
    "op10_line_dedup": OP10_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op12_chat_format": OP12_SQL,
    "op13_collocations": OP13_SQL,
}
