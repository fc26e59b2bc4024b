"""One query per operator, over its whole table, and SQL where SQL expresses it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilelake.llm import (
    entropy_mix,
    fuzzy_lines,
    k2_treap,
    line_frequency,
    order_minhash,
    pu_toxicity,
    qdwh_whiten,
    secret_grammar,
    segment_bpe,
    simhash_tiles,
    stream_dedup,
    url_intervals,
    warc_merge,
)
from tilelake.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


@query("op3_stream_dedup", """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256 FROM d""")
def op3(spark, sf):
    return stream_dedup.dedup(spark, f"{sf.rstrip('/')}/documents.parquet").withColumnRenamed("digest", "text_sha256")


@query("op4_entropy_mix")
def op4(spark, sf):
    return entropy_mix.plan(read(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


@query("op7_pu_toxicity")
def op7(spark, sf):
    return pu_toxicity.report(read(spark, sf, "documents"), read(spark, sf, "labels"))


@query("op8_simhash_tiles")
def op8(spark, sf):
    return simhash_tiles.report(read(spark, sf, "documents"))


@query("op9_line_frequency")
def op9(spark, sf):
    return line_frequency.verdicts(read(spark, sf, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "words_left")


@query("op10_segment_bpe")
def op10(spark, sf):
    return segment_bpe.digests(read(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op5_fuzzy_lines")
def op5(spark, sf):
    return fuzzy_lines.report(read(spark, sf, "documents"))


@query("op1_warc_merge", """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
g AS (SELECT body, max(page_id) AS stays FROM p WHERE octet_length(encode(body)) >= 1000 GROUP BY body)
SELECT page_id, octet_length(encode(p.body))::BIGINT AS payload_bytes, sha1(p.body) AS payload_digest,
  CASE WHEN g.stays <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN g.stays <> page_id THEN g.stays END AS refers_to
FROM p LEFT JOIN g ON g.body = p.body""")
def op1(spark, sf):
    return warc_merge.round_trip(read(spark, sf, "pages")).select(
        F.col("id").cast("long").alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("refers_to").cast("long").alias("refers_to"))


@query("op2_secret_grammar")
def op2(spark, sf):
    return secret_grammar.report(read(spark, sf, "documents"))


# The pages' own hosts make the dated list: every host and every pair of last labels has up to four
# entries in 2024, dated and signed by digits of an MD5; page n was fetched n * 977 seconds into it.
_HOST = "regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://([^/?#:@]+)', 1)"
_LIST = """
hosts AS (SELECT DISTINCT {host} AS host FROM pages),
keys AS (SELECT DISTINCT key FROM (SELECT host AS key FROM hosts UNION ALL SELECT regexp_extract(host, '([^.]+[.][^.]+)$', 1) AS key FROM hosts) k WHERE key <> ''),
dated AS (SELECT key, n, md5(concat(key, '/', CAST(n AS VARCHAR(1)))) AS m FROM keys CROSS JOIN (VALUES (1), (2), (3), (4)) AS v(n)),
entries AS (SELECT key, CASE WHEN substring(m, 1, 1) < '8' THEN 'block' ELSE 'allow' END AS action, {listed} AS listed_at
  FROM dated WHERE substring(m, 2, 1) < 'c')"""


@query("op6_url_intervals", f"""
WITH {_LIST.format(host=_HOST, listed="TIMESTAMP '2024-01-01' + to_hours(((strpos('0123456789abcdef', substring(m, 3, 1)) - 1) * 256 + (strpos('0123456789abcdef', substring(m, 4, 1)) - 1) * 16 + strpos('0123456789abcdef', substring(m, 5, 1)) - 1) * 2)")},
once AS (SELECT key, listed_at, max(action) AS action FROM entries GROUP BY key, listed_at),
spans AS (SELECT key, action, listed_at AS valid_from, lead(listed_at) OVER (PARTITION BY key ORDER BY listed_at) AS valid_to FROM once),
c AS (SELECT page_id, {_HOST} AS host, TIMESTAMP '2024-01-01' + to_seconds(page_id * 977 % 31622400) AS fetched_at FROM pages),
m AS (SELECT c.*, s.key AS entry, s.valid_from, s.action, row_number() OVER (PARTITION BY page_id ORDER BY length(s.key) DESC NULLS LAST) AS r
  FROM c LEFT JOIN spans s ON (s.key = c.host OR s.key = regexp_extract(c.host, '([^.]+[.][^.]+)$', 1)) AND c.fetched_at >= s.valid_from AND (s.valid_to IS NULL OR c.fetched_at < s.valid_to))
SELECT page_id, host, epoch_us(fetched_at) AS fetched_us, entry, epoch_us(valid_from) AS valid_from_us, coalesce(action = 'block', false) AS blocked FROM m WHERE r = 1""")
def op6(spark, sf):
    pages = read(spark, sf, "pages")
    digit = lambda i: F.conv(F.substring("m", i, 1), 16, 10).cast("int")
    hosts = pages.select(url_intervals.host_of(F.col("url")).alias("host")).distinct()
    keys = hosts.select(F.explode(F.array("host", F.regexp_extract("host", r"([^.]+[.][^.]+)$", 1))).alias("key")).where("key <> ''").distinct()
    dated = keys.select("key", F.explode(F.array(*map(F.lit, range(1, 5)))).alias("n")).withColumn("m", F.md5(F.concat("key", F.lit("/"), F.col("n").cast("string"))))
    listed = F.timestamp_seconds(F.lit(1_704_067_200) + (digit(3) * 256 + digit(4) * 16 + digit(5)) * 7200)
    entries = dated.where(F.substring("m", 2, 1) < "c").select(
        "key", F.when(F.substring("m", 1, 1) < "8", "block").otherwise("allow").alias("action"), listed.alias("listed_at"))
    captures = pages.select("page_id", "url", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("page_id") * 977 % 31_622_400).alias("at"))
    return url_intervals.judge(captures, entries, "page_id", "url", "at").select(
        "page_id", "host", F.unix_micros("fetched_at").alias("fetched_us"), "entry", F.unix_micros("valid_from").alias("valid_from_us"), "blocked")


@query("op11_order_minhash")
def op11(spark, sf):
    return order_minhash.report(read(spark, sf, "documents"))


@query("op12_qdwh_whiten")
def op12(spark, sf):
    return qdwh_whiten.report(read(spark, sf, "embeddings"))


@query("op13_k2_treap", r"""
WITH t AS (SELECT doc_id AS d, row_number() OVER () AS r, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
p AS (SELECT d, r, term, count(*) AS tf FROM t GROUP BY ALL),
len AS (SELECT r, sum(tf)::BIGINT AS n FROM p GROUP BY r),
s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM len),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
f AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, s WHERE term IN (SELECT term FROM i) GROUP BY term),
x AS (SELECT item_id, d, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score FROM i JOIN f USING (term) JOIN p USING (term) JOIN len USING (r), s GROUP BY ALL),
o AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, d) AS rank, d AS doc_id, score FROM x WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM o WHERE rank <= 10""")
def op13(spark, sf):
    return k2_treap.report(read(spark, sf, "documents"), read(spark, sf, "benchmark"))
