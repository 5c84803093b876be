"""The queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, ann, bpe_tree, fixity, importance, language, media, mixing, packing, sharding, simhash, token_prefix, toxicity
from ._common import id_crc, scratch_path, table


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources to target weights takes of each document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "taken", "first_shard", "last_shard")


def op2_compact_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as read back from a store that it was appended to and compacted in."""
    docs = table(spark, sf_dir, "documents")
    return sharding.digests(sharding.compacted(docs, scratch_path(spark, "shards")))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact token counts of every document and whether it exceeds the limit."""
    return token_prefix.count_documents(table(spark, sf_dir, "documents"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest found of every hundredth vector."""
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs.select("doc_id", "text"), language.fit(docs))
    return found.select(
        "doc_id", (id_crc() % 4 == 2).alias("held_out"), F.col("_lang_pred").alias("lang_pred"), F.col("_lang_score").alias("score"), F.col("_lang_rejected").alias("rejected")
    )


def op6_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a sound with digests and a spectral fingerprint."""
    return media.describe_documents(table(spark, sf_dir, "documents")).drop("peak_hashes", "peak_times")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", (id_crc() % 5 == 0).alias("held_out"), F.col("_tox_score").alias("score"), F.col("_tox_predicted").alias("predicted"))


def op8_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record with the finding of an audit against a replica with known damage."""
    pages = table(spark, sf_dir, "pages")
    return fixity.audited(pages, fixity.damaged(pages))


def op9_simhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document under SimHash links."""
    found = simhash.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    return bpe_tree.encode_documents(table(spark, sf_dir, "documents")).drop("ids")


def op11_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document in a draw that follows the benchmark's word distribution."""
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups, links and pair counts of two tokenizers over every document."""
    return alignment.align(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_mix_sources, op2_compact_shards, op3_token_counts, op4_nearest_neighbours, op5_language_id, op6_media_columns, op7_toxicity, op8_warc_fixity, op9_simhash_classes, op10_bpe_round_trip,
        op11_pack_sequences, op12_importance_resampling, op13_tokenizer_alignment,
    )
    return {f.__name__: f for f in own}


_CRLF = "chr(13) || chr(10)"


def _laid_sql(pages: str) -> str:
    """The records of a replica and where they lie in their files, in plain SQL."""
    return f"""
  SELECT *, CAST(coalesce(sum(record_length) OVER (
    PARTITION BY warc_file ORDER BY page_id, record_sha256 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS record_offset
  FROM (
    SELECT page_id, url, CAST(floor(page_id / {fixity.FILE_RECORDS}.0) AS BIGINT) AS warc_file, CAST(strlen(body) AS BIGINT) AS record_length, sha256(body) AS record_sha256
    FROM (
      SELECT page_id, coalesce(url, '') AS url,
             'WARC/1.0' || {_CRLF} || 'WARC-Type: resource' || {_CRLF} || 'WARC-Date: {fixity.DATE}' || {_CRLF}
             || 'WARC-Record-ID: <urn:page:' || CAST(page_id AS VARCHAR) || '>' || {_CRLF} || 'WARC-Target-URI: ' || coalesce(url, '') || {_CRLF}
             || 'Content-Length: ' || CAST(strlen(coalesce(html, '')) AS VARCHAR) || {_CRLF} || {_CRLF} || coalesce(html, '') || {_CRLF} || {_CRLF} AS body
      FROM {pages}))"""


#: The file layouts of both replicas, the second one's damage and what differs; ids are unique in these pages.
_OP8_SQL = f"""
WITH replica AS (
  SELECT page_id, url, CASE WHEN page_id % 97 = 0 AND length(html) > 0 THEN '#' || substr(html, 2) ELSE html END AS html
  FROM pages WHERE NOT (page_id % 89 = 0 AND page_id % 97 <> 0)
  UNION ALL SELECT page_id, coalesce(url, '') || '#copy' AS url, html FROM pages WHERE page_id % 83 = 0),
a AS ({_laid_sql("pages")}),
b AS ({_laid_sql("replica")})
SELECT a.page_id, a.url, a.warc_file, a.record_offset, a.record_length, a.record_sha256,
       CASE WHEN b.page_id IS NULL THEN 'missing' WHEN a.record_sha256 <> b.record_sha256 THEN 'corrupt' ELSE 'ok' END AS status
FROM a LEFT JOIN b ON a.page_id = b.page_id AND a.url = b.url
UNION ALL
SELECT b.page_id, b.url, b.warc_file, b.record_offset, b.record_length, b.record_sha256, 'extra' AS status
FROM b LEFT JOIN a ON a.page_id = b.page_id AND a.url = b.url WHERE a.page_id IS NULL
"""


#: Unigrams, so a feature is a word; CRC-32 is taken of each distinct word, byte by byte with a table made by its rule.
_OP12_SQL = f"""
WITH RECURSIVE bits AS (
  SELECT i AS byte, i AS c, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT byte, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY byte) AS t FROM bits WHERE k = 8),
sides AS (
  SELECT 0 AS side, doc_id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
words AS (
  SELECT side, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM sides),
flat AS (SELECT side, doc_id, unnest(words) AS word FROM words),
per_doc AS (SELECT side, doc_id, word, count(*) AS n FROM flat GROUP BY ALL),
dictionary AS (
  SELECT word, list_transform(range(strlen(word)), lambda i: CAST('0x' || substr(hex(word), 2 * i + 1, 2) AS BIGINT)) AS bytes
  FROM (SELECT DISTINCT word FROM per_doc)),
hashed AS (
  SELECT word, xor(list_reduce(bytes, lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295), 4294967295) % {importance.BUCKETS} AS bucket
  FROM dictionary, crc_table),
counted AS (
  SELECT bucket, sum(CASE WHEN side = 0 THEN n ELSE 0 END) AS s, sum(CASE WHEN side = 1 THEN n ELSE 0 END) AS t FROM per_doc JOIN hashed USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln(CAST((t + 1) * ((SELECT sum(s) FROM counted) + {importance.BUCKETS}) AS DOUBLE)
                                 / CAST((s + 1) * ((SELECT sum(t) FROM counted) + {importance.BUCKETS}) AS DOUBLE))) AS gain FROM counted),
summed AS (SELECT doc_id, sum(n * gain) AS gain FROM per_doc JOIN hashed USING (word) JOIN gains USING (bucket) WHERE side = 0 GROUP BY doc_id),
weighed AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_features, CAST(coalesce(floor(gain / len(words)), 0) AS BIGINT) AS weight,
         CAST('0x' || substr(sha256('{importance.SALT}' || w.doc_id), 1, 8) AS BIGINT) AS h
  FROM words w LEFT JOIN summed USING (doc_id) WHERE side = 0),
scored AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM weighed),
placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS may FROM scored WHERE n_features >= {importance.LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= floor(may * {importance.DRAWN_PERCENT} / 100) THEN rank END AS rank
FROM scored LEFT JOIN placed USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op12_importance_resampling": _OP12_SQL,
        "op2_compact_shards": "SELECT doc_id, CAST(strlen(text) AS BIGINT) AS n_bytes, sha256(text) AS text_sha256 FROM documents",
        "op8_warc_fixity": _OP8_SQL,
    }
