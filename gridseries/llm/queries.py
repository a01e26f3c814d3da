"""Registered queries of the corpus operators, and their SQL where SQL can state them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.llm import alignment, bpe, embedding_dedup, fingerprints, language_id, maxent, ngram_join, packing, quality, repair, sharding, url_filters, warc
from gridseries.llm.common import table

SHARDS = 16
CAPACITY = 1024


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document's whole text, learned from two thirds of the rows' labels."""
    return language_id.identify(table(spark, sf_dir, "documents"), "doc_id", "text", "lang")


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's links by cosine >= 0.95 and its component."""
    return embedding_dedup.embedding_links(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's links by Jaccard >= 0.8 of five-word sets and its component."""
    return ngram_join.ngram_links(table(spark, sf_dir, "documents"), "doc_id", "text")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consistent-weighted-sampling fingerprints of every document, its edit, and their likeness."""
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"), "doc_id", "text")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"), CAPACITY)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record in ZIP packages, read back by byte range."""
    return warc.archive_round_trip(table(spark, sf_dir, "pages"), "page_id", "url", "html")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards by the jump hash of doc_id."""
    out = sharding.shard_rows(table(spark, sf_dir, "documents"), "doc_id", "text", SHARDS)
    return out.withColumn("law", F.lit("key"))


OP7_SQL = f"""
WITH RECURSIVE jump(doc_id, shards, b, j, k) AS (
  SELECT doc_id, n, 0::BIGINT, 0::BIGINT, (doc_id::HUGEINT + 18446744073709551616) % 18446744073709551616
  FROM documents, (VALUES ({SHARDS}), ({SHARDS + 1})) s(n)
  UNION ALL
  SELECT doc_id, shards, j, floor((j + 1) * (2147483648.0::DOUBLE / ((k2 // 8589934592) + 1)::DOUBLE))::BIGINT, k2
  FROM (SELECT *, (k * 2862933555777941757 + 1) % 18446744073709551616 AS k2 FROM jump WHERE j < shards)
),
placed AS (
  SELECT doc_id, max(b) FILTER (shards = {SHARDS})::INT AS shard, max(b) FILTER (shards = {SHARDS + 1})::INT AS grown_shard
  FROM jump GROUP BY doc_id
),
crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, r: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i))
),
sums AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
    xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(strlen(coalesce(text, ''))), lambda i: (('0x' || substring(hex(encode(coalesce(text, ''))), 2 * i + 1, 2))::BIGINT))),
      lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32
  FROM documents, crc_table
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, grown_shard
FROM sums JOIN placed USING (doc_id)
"""

LIST_START = "2024-01-01"


def _draw(text: Column, salt: str, sides: int) -> Column:
    """A number from 0 to sides - 1 that depends on the text only."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt), text)), 1, 6), 16, 10).cast("int") % sides


def list_events(pages: DataFrame) -> DataFrame:
    """A dated filter list derived from the captures' own hosts, parent domains and first path segments.

    A third of these keys are listed, from a day in the year on; two in three entries are
    removed later and half of those listed again; one entry in five allows.
    """
    host = url_filters.url_host(F.col("url"))
    parent = F.substring_index(host, ".", -3)
    segment = F.regexp_extract(url_filters.url_path(F.col("url")), "^/([^/]+)", 1)
    keys = F.array(host, parent, F.when(segment != "", F.concat(host, F.lit("/"), segment)))
    keys = pages.select(F.explode(keys).alias("key")).where("key IS NOT NULL AND key <> ''").distinct()
    k = F.col("key")
    listed = keys.where(_draw(k, "listed", 3) == 0).select(
        "key",
        F.date_add(F.lit(LIST_START).cast("date"), _draw(k, "from", 365)).alias("day"),
        F.when(_draw(k, "kind", 5) == 0, "allow").otherwise("block").alias("action"),
        (1 + _draw(k, "stay", 120)).alias("stay"),
        _draw(k, "gone", 3).alias("gone"),
    )
    removed = listed.where("gone > 0").select("key", F.date_add("day", F.col("stay")).alias("day"), F.lit("remove").alias("action"))
    again = listed.where("gone = 2").select("key", F.date_add("day", F.col("stay") * 2).alias("day"), "action")
    return listed.select("key", "day", "action").union(removed).union(again)


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page against the list entries active on its fetch day (a day of the year by page_id)."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    fetched = F.date_add(F.lit(LIST_START).cast("date"), F.pmod(F.col("page_id") * 37, F.lit(366)).cast("int"))
    captures = pages.select(F.col("page_id").alias("id"), "url", fetched.alias("fetched"))
    out = url_filters.filter_captures(captures, list_events(pages)).withColumnRenamed("id", "page_id")
    return out.withColumn("rule_from", F.col("rule_from").cast("string"))


def _sql_draw(salt: str, sides: int) -> str:
    return f"(('0x' || substring(md5('{salt}' || key), 1, 6))::INT % {sides})"


OP8_SQL = rf"""
WITH RECURSIVE parsed AS (
  SELECT page_id, url, DATE '{LIST_START}' + ((((page_id * 37) % 366) + 366) % 366)::INT AS fetched,
    rtrim(lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)', 1)), '.') AS host,
    list_filter(string_split(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]*(/[^?#]*)', 1), '/'), lambda p: p <> '') AS parts
  FROM pages
),
names AS (
  SELECT DISTINCT unnest([host, array_to_string(string_split(host, '.')[-3:], '.'), CASE WHEN len(parts) > 0 THEN host || '/' || parts[1] END]) AS key FROM parsed
),
listed AS (
  SELECT key, DATE '{LIST_START}' + {_sql_draw("from", 365)} AS day, CASE WHEN {_sql_draw("kind", 5)} = 0 THEN 'allow' ELSE 'block' END AS action,
    1 + {_sql_draw("stay", 120)} AS stay, {_sql_draw("gone", 3)} AS gone
  FROM names WHERE key IS NOT NULL AND key <> '' AND {_sql_draw("listed", 3)} = 0
),
events AS (
  SELECT key, day, action FROM listed
  UNION ALL SELECT key, day + stay, 'remove' FROM listed WHERE gone > 0
  UNION ALL SELECT key, day + 2 * stay, action FROM listed WHERE gone = 2
),
spans AS (
  SELECT key, day AS valid_from, lead(day) OVER (PARTITION BY key ORDER BY day) AS valid_to, r FROM (
    SELECT key, day, max(CASE action WHEN 'block' THEN 3 WHEN 'allow' THEN 2 ELSE 1 END) AS r FROM events GROUP BY key, day)
),
keyed AS (
  SELECT page_id, fetched, unnest(list_distinct(
    list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.')) ||
    list_transform(range(1, len(parts) + 1), lambda i: host || '/' || array_to_string(parts[1:i], '/')))) AS key
  FROM parsed WHERE host <> ''
),
hits AS (
  SELECT page_id, key, valid_from, CASE r WHEN 3 THEN 'block' ELSE 'allow' END AS action,
    row_number() OVER (PARTITION BY page_id ORDER BY contains(key, '/') DESC, length(key) DESC, key DESC) AS place, count(*) OVER (PARTITION BY page_id) AS n
  FROM keyed JOIN spans USING (key) WHERE r > 1 AND valid_from <= fetched AND (valid_to IS NULL OR fetched < valid_to)
)
SELECT p.page_id, coalesce(n, 0) AS n_active, h.key AS rule, action AS rule_action, valid_from::DATE::VARCHAR AS rule_from, coalesce(action = 'block', false) AS blocked
FROM parsed p LEFT JOIN hits h ON h.page_id = p.page_id AND place = 1
"""


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document's whole text, learned from four fifths of the labels."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.classify(docs, "doc_id", "text", labels, "doc_id", "quality")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document's whole text, and what they decode to, as digests."""
    docs = table(spark, sf_dir, "documents")
    return bpe.encode_texts(docs, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation after damage: its faults, its cheapest repair, and the hash of the repaired turns."""
    return repair.repair_conversations(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")


def op12_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximum-entropy and unigram log10 probabilities of every document's whole text."""
    return maxent.score_texts(table(spark, sf_dir, "documents"), "doc_id", "text")


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's groups and links between a byte-level and a piece tokenizer."""
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align_tokenizers(table(spark, sf_dir, "documents"), "doc_id", "text", *paths)


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_ngram_join": op3_ngram_join,
    "op4_fingerprints": op4_fingerprints,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_warc": op6_warc,
    "op7_sharding": op7_sharding,
    "op8_url_filters": op8_url_filters,
    "op9_quality": op9_quality,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_maxent_lm": op12_maxent_lm,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}
SQL = {"op7_sharding": OP7_SQL, "op8_url_filters": OP8_SQL}
