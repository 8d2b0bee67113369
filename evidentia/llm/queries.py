"""The thin queries opN_<name>: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.llm import bpe, conversations, decontam, importance, lattice_lm, media, ngram_join, pii, quality, secret_scan, suffix_dedup, token_counts, url_filter
from evidentia.llm.scratch import Scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(table(spark, sf_dir, "documents"), "doc_id", "text", Scratch(spark, "ngrams"))


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, "text", public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, decoded_col="decoded")
    return coded.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "media")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = media.media_columns(docs, "text", scratch, id_col="doc_id")
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", F.col("length").alias("media_bytes"), "media_sha256", "feature", "width", "height", "shard", "offset")


#: Rules (verdict, host, path).
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list stands for one from outside: keys (host and path) whose MD5 begins with the digit 0."""
    pages = table(spark, sf_dir, "pages").select("page_id", url_filter.host(F.col("url")).alias("host"), url_filter.path(F.col("url")).alias("path"))
    key = F.concat("host", "path")
    shards = url_filter.shard_count(pages.count())
    scratch = Scratch(spark, "urls")
    filters = scratch.keep(url_filter.cascades(pages, key, F.md5(key).startswith("0"), shards), "cascades")
    rows = url_filter.apply_cascades(pages, key, filters, shards)
    rule, verdict = url_filter.longest_rule(F.col("host"), F.col("path"), URL_RULES)
    return rows.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    judged = quality.classify(docs, table(spark, sf_dir, "labels"), Scratch(spark, "quality"), keep_text=False)
    return judged.select("doc_id", "source", "lang", "p_quality", "p_toxic", "site_shift", "posterior", "accepted")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup(table(spark, sf_dir, "documents"), "doc_id", "text", Scratch(spark, "suffixes"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.matches(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "benchmark"), "item_id", "text")
    return found.filter("contaminated")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each candidate; values leave as digests only."""
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), "text").select("doc_id", F.posexplode("candidates").alias("finding", "c"))
    return found.select("doc_id", "finding", F.sha2("c.value", 256).alias("value_sha256"), F.length("c.value").alias("n_chars"), "c.score", (F.col("c.score") >= secret_scan.ACCEPT).alias("is_secret"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, "text", public_tokenizers.path("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op10_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    train = F.crc32(F.col("doc_id").cast("string")) % 7 != 2
    return lattice_lm.score(docs, "doc_id", "text", train, public_tokenizers.path("piece_bpe_32k.model"), Scratch(spark, "lattice"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    rows = conversations.damaged(turns, "conv_id", "turn", "role", "text")
    return conversations.digests(rows, turns.select(F.col("conv_id").alias("conv"))).withColumnRenamed("conv", "conv_id")


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"), "doc_id", "text", Scratch(spark, "pii"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, pii.same_as(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return importance.resample(docs, "doc_id", "text", target, "text", Scratch(spark, "importance"))


OP4_SQL = r"""
WITH p AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
r AS (
  SELECT *,
    CASE WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
         WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
         WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
         WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
         WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM p)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
       WHEN rule IS NOT NULL THEN 'block'
       WHEN starts_with(md5(concat(host, path)), '0') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""

OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) >= 3 THEN array_to_string(ws[i:i + 2], ' ') ELSE array_to_string(ws, ' ') END AS shingle
  FROM (SELECT doc_id, ws, unnest(range(1, CASE WHEN len(ws) >= 3 THEN len(ws) - 1 WHEN len(ws) > 0 THEN 2 ELSE 1 END)) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
linked AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(min(r.b), d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id, n.n
"""

OP6_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, length(hex(encode(coalesce(text, '')))) // 2 AS n FROM documents),
windows AS (SELECT doc_id, i, md5(substr(h, 2 * i - 1, 400)) AS m FROM (SELECT doc_id, h, unnest(range(1, n - 198)) AS i FROM d)),
again AS (SELECT m FROM windows GROUP BY m HAVING count(*) > 1),
starts AS (SELECT doc_id, i, i > 200 + lag(i, 1, -1000) OVER (PARTITION BY doc_id ORDER BY i) AS opens FROM windows WHERE m IN (SELECT m FROM again)),
runs AS (SELECT doc_id, min(i) AS a, max(i) + 199 AS b FROM (SELECT doc_id, i, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS k FROM starts) GROUP BY doc_id, k),
cuts AS (SELECT doc_id, list(a ORDER BY a) AS a, list(b ORDER BY a) AS b, sum(b - a + 1) AS gone FROM runs GROUP BY doc_id),
parts AS (SELECT d.doc_id, h, n, coalesce(gone, 0)::BIGINT AS gone, list_concat(coalesce(a, []), [n + 1]) AS a, list_concat([0], coalesce(b, [])) AS b FROM d LEFT JOIN cuts USING (doc_id))
SELECT doc_id, n AS n_bytes, gone AS n_removed, len(a) - 1 AS n_spans, sha256(unhex(array_to_string(list_transform(range(1, len(a) + 1), lambda k: substr(h, 2 * b[k] + 1, 2 * (a[k] - b[k] - 1))), ''))) AS kept_sha256
FROM parts
"""

OP11_SQL = r"""
WITH RECURSIVE
coded AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
bits AS (SELECT *, flatten(list_transform(string_split(key, ''), lambda c: list_transform(range(8), lambda i: (ascii(c) >> i::INT) & 1))) AS b FROM coded),
dealt AS (SELECT conv_id, turn, role, text, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(b, lambda x: x::BIGINT)), lambda c, x: xor(c >> 1, 3988292384::BIGINT * xor(c & 1, x)))) % 20 AS n FROM bits),
damaged AS (SELECT conv_id, turn, CASE n WHEN 4 THEN 'user' ELSE role END AS role, CASE n WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE n WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM dealt WHERE n <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS p, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ink FROM damaged),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 AS again, role[1:1] AS i, lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY p) AS before FROM placed),
r AS (SELECT *, CASE WHEN ink = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN ink[-1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM seen),
ends AS (SELECT c.conv_id, coalesce(max(p), 0) + 1 AS p FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY 1),
back AS (
  SELECT conv_id, p, 0 AS c0, 10 AS c1, 5 AS c2, 0 AS c3 FROM ends
  UNION ALL
  SELECT conv_id, p, least(b0, 5 + b2, 10 + b3), least(b1, 5 + b2, 10 + b3), least(b2, 5 + b3), least(b3, 5 + b2) FROM (
    SELECT r.conv_id, r.p,
      CASE WHEN x THEN 2 + c0 ELSE least(2 + c0, CASE i WHEN 's' THEN t + c1 WHEN 'u' THEN t + c2 ELSE 99999999 END, 1 + t + c2) END AS b0,
      CASE WHEN x THEN 2 + c1 ELSE least(2 + c1, CASE i WHEN 'u' THEN t + c2 ELSE 99999999 END, 1 + t + c2) END AS b1,
      CASE WHEN x THEN 2 + c2 ELSE least(2 + c2, CASE i WHEN 'a' THEN t + c3 ELSE 99999999 END, 1 + t + c3) END AS b2,
      CASE WHEN x THEN 2 + c3 ELSE least(2 + c3, CASE i WHEN 'u' THEN t + c2 ELSE 99999999 END, 1 + t + c2) END AS b3
    FROM back JOIN (SELECT *, fault IN ('blank', 'duplicate') AS x, 5 * (fault = 'truncated')::INT AS t FROM r) r ON r.conv_id IS NOT DISTINCT FROM back.conv_id AND r.p = back.p - 1)),
togo AS (SELECT conv_id, p, [c0, c1, c2, c3] AS c FROM back),
options AS (
  SELECT r.conv_id, r.p, s, fault, role, text, now.c[s + 1] AS c, now.c AS cs, nxt.c AS cn, 5 * (fault = 'truncated')::INT AS t, fault IN ('blank', 'duplicate') AS x, [2, 2, 3, 2][s + 1] AS f,
    CASE i WHEN 's' THEN CASE s WHEN 0 THEN 1 END WHEN 'u' THEN CASE WHEN s <> 2 THEN 2 END WHEN 'a' THEN CASE s WHEN 2 THEN 3 END END AS k
  FROM r JOIN togo now ON now.conv_id IS NOT DISTINCT FROM r.conv_id AND now.p = r.p JOIN togo nxt ON nxt.conv_id IS NOT DISTINCT FROM r.conv_id AND nxt.p = r.p + 1, (SELECT unnest([0, 1, 2, 3]) AS s)
  UNION ALL
  SELECT conv_id, p, s, 'end', NULL, NULL, [0, 10, 5, 0][s + 1], [0, 10, 5, 0], [0, 0, 0, 0], 0, false, [2, 2, 3, 2][s + 1], NULL FROM ends, (SELECT unnest([0, 1, 2, 3]) AS s)),
edits AS (
  SELECT *, CASE WHEN fault = 'end' THEN CASE WHEN s IN (1, 2) THEN 'I' END WHEN c = 2 + cn[s + 1] THEN 'D' WHEN c = 5 + cs[f + 1] THEN 'I' WHEN NOT x AND k IS NOT NULL AND c = t + cn[k + 1] THEN 'K' ELSE 'R' END AS e FROM options),
walk AS (
  SELECT conv_id, 1::BIGINT AS p, 0 AS s, 0 AS n, '' AS e, 0 AS cost, NULL::VARCHAR AS turn FROM ends
  UNION ALL
  SELECT w.conv_id, CASE WHEN o.e = 'I' THEN w.p ELSE w.p + 1 END, CASE o.e WHEN 'D' THEN w.s WHEN 'K' THEN o.k ELSE o.f END, w.n + 1, o.e, CASE o.e WHEN 'D' THEN 2 WHEN 'I' THEN 5 WHEN 'K' THEN o.t ELSE 1 + o.t END,
    CASE o.e WHEN 'D' THEN NULL WHEN 'K' THEN o.role || ':' || o.text ELSE CASE o.f WHEN 2 THEN 'user:' ELSE 'assistant:' END || CASE o.e WHEN 'R' THEN o.text ELSE '' END END
  FROM walk w JOIN edits o ON o.conv_id IS NOT DISTINCT FROM w.conv_id AND o.p = w.p AND o.s = w.s WHERE o.e IS NOT NULL),
done AS (SELECT conv_id, sum(cost)::BIGINT AS cost, string_agg(e, '' ORDER BY n) AS audit, sha256(coalesce(string_agg(turn, chr(10) ORDER BY n) FILTER (turn IS NOT NULL), '')) AS repaired_sha256 FROM walk GROUP BY 1),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY 1)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit, repaired_sha256
FROM done d LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM d.conv_id
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_bpe_round_trip": op2_bpe_round_trip,
    "op3_media_columns": op3_media_columns,
    "op4_url_filter": op4_url_filter,
    "op5_quality": op5_quality,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_secret_scan": op8_secret_scan,
    "op9_token_counts": op9_token_counts,
    "op10_lattice_lm": op10_lattice_lm,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_personal_data": op12_personal_data,
    "op13_importance_resampling": op13_importance_resampling,
}

#: Operators without an entry cannot be said in SQL; tests/llm holds them against brute force.
ORACLE: dict[str, str] = {"op1_ngram_join": OP1_SQL, "op4_url_filter": OP4_SQL, "op6_suffix_dedup": OP6_SQL, "op11_conversation_repair": OP11_SQL}
