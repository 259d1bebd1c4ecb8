"""The queries of the training-data operators: name -> builder, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from tidemark.llm import op1_urls, op2_exact, op3_pii as op3, op6_bpe, op7_decontaminate, op8_licenses
from tidemark.llm import op4_suffix as op4
from tidemark.llm import op5_toxicity as op5_crf
from tidemark.llm import op10_ngram_join as op10
from tidemark.llm import op11_negatives as op11
from tidemark.llm import op12_trie as op12
from tidemark.llm import op13_katz as op13
from tidemark.llm import op9_warc as op9_warc_io
from tidemark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return deco


@register("op2_exact_dedup", r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents),
g AS (
  SELECT h, count(*) AS n, arg_min(doc_id, (-length(t), doc_id)) AS keep
  FROM d GROUP BY h)
SELECT d.doc_id, g.keep AS keep_id, g.n AS group_size, d.doc_id = g.keep AS kept,
       d.h AS text_sha256
FROM d JOIN g USING (h)
""")
def op2_exact_dedup(spark, d):
    return op2_exact.exact_dedup(table(spark, d, "documents")).drop("text_key", "uid")


@register("op1_url_filters", r"""
WITH u AS (
  SELECT page_id, CASE WHEN position('://' IN coalesce(url, '')) > 0
                       THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(rhost, rpath, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (
  SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
         arg_max(r.verdict, length(rhost || rpath)) AS verdict
  FROM h JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM h LEFT JOIN m USING (page_id)
""")
def op1_url_filters(spark, d):
    rules = spark.createDataFrame([("com", "/", "allow"), ("example.com", "/en/", "block"),
                                   ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
                                   ("net", "/fr/", "block")], "host string, path string, verdict string")
    return op1_urls.judge(table(spark, d, "pages"), rules)


@register("op9_warc", r"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                  sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest, max(page_id) AS top FROM p GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
FROM p JOIN g USING (payload_digest)
""")
def op9_warc(spark, d):
    index = op9_warc_io.write_archives(table(spark, d, "pages"))
    return (op9_warc_io.read_records(index, payloads=False)
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


@register("op6_byte_bpe")
def op6_byte_bpe(spark, d):
    return op6_bpe.round_trip(table(spark, d, "documents"),
                              public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@register("op8_license_scan")
def op8_license_scan(spark, d):
    return op8_licenses.scan(table(spark, d, "documents"))


@register("op10_ngram_jaccard", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(
           range(1, greatest(len(ws) - 3, 2)), lambda i: array_to_string(ws[i:i + 4], ' ')))) END AS sh FROM w),
c AS (SELECT sh, min(doc_id) AS id, len(sh) AS n FROM s WHERE len(sh) > 0 GROUP BY sh),
u AS (SELECT id, n, unnest(sh) AS x FROM c),
often AS (SELECT x FROM u GROUP BY x HAVING count(*) > 1),
v AS (SELECT id, n, x FROM u SEMI JOIN often USING (x)),
link AS (
  SELECT a.id AS a, b.id AS b FROM v a JOIN v b ON a.x = b.x AND a.id <> b.id
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least AS (SELECT a AS id, least(a, min(b)) AS component FROM reach GROUP BY a)
SELECT s.doc_id, len(s.sh) AS n_shingles, coalesce(least.component, c.id, s.doc_id) AS component_id
FROM s LEFT JOIN c ON s.sh = c.sh LEFT JOIN least ON least.id = c.id
""")
def op10_ngram_jaccard(spark, d):
    return op10.jaccard_components(table(spark, d, "documents"))


@register("op7_decontamination")
def op7_decontamination(spark, d):
    return (op7_decontaminate.contained(table(spark, d, "documents"), table(spark, d, "benchmark"))
            .select("doc_id", "item_id", "item_words", "covered", "coverage", F.size("tiles").alias("n_tiles")))


@register("op5_toxicity")
def op5_toxicity(spark, d):
    return (op5_crf.classify(table(spark, d, "documents"), table(spark, d, "labels"))
            .withColumn("n_spans", F.size("spans")).drop("spans"))


@register("op3_pii")
def op3_pii(spark, d):
    return op3.digest_columns(op3.find(table(spark, d, "documents")))


@register("op4_suffix_dedup", r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT k, p, md5_number(substr(h, 2 * p + 1, 800)) AS m
      FROM (SELECT k, h, unnest(range(0, greatest(length(h) // 2 - 399, 0))) AS p FROM d)),
r AS (SELECT k, p FROM w SEMI JOIN (SELECT m FROM w GROUP BY m HAVING count(*) > 1) often USING (m)),
island AS (SELECT k, p, sum(CASE WHEN p <= before + 400 THEN 0 ELSE 1 END) OVER (PARTITION BY k ORDER BY p) AS g
           FROM (SELECT k, p, lag(p) OVER (PARTITION BY k ORDER BY p) AS before FROM r)),
span AS (SELECT k, min(p) AS a, max(p) + 400 AS b FROM island GROUP BY k, g),
cut AS (SELECT k, a, b, lag(b, 1, 0) OVER (PARTITION BY k ORDER BY a) AS last,
               row_number() OVER (PARTITION BY k ORDER BY a DESC) = 1 AS final FROM span),
kept AS (SELECT k, count(*) AS n_spans, sum(b - a) AS n_removed,
                sha256(unhex(string_agg(substr(h, 2 * last + 1, 2 * (a - last))
                                        || CASE WHEN final THEN substr(h, 2 * b + 1) ELSE '' END, '' ORDER BY a))) AS sha
         FROM cut JOIN d USING (k) GROUP BY k)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, coalesce(sha, sha256(unhex(h))) AS kept_sha256
FROM d LEFT JOIN kept USING (k)
""")
def op4_suffix_dedup(spark, d):
    return op4.remove_repeats(table(spark, d, "documents"))


@register("op11_hard_negatives", r"""
WITH e AS (
  SELECT row_number() OVER () AS u, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.u AS au, a.vec_id AS aid, b.u AS bu, b.vec_id AS bid, a.label = b.label AS same,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.u <> b.u),
p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY au ORDER BY score DESC, bid, bu) <= 5)
SELECT p.aid AS anchor_id, p.bid AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.au, p.bu ORDER BY s.score DESC, s.bid, s.bu) AS INTEGER) AS rank,
       s.bid AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.au = s.au AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score
QUALIFY row_number() OVER (PARTITION BY p.au, p.bu ORDER BY s.score DESC, s.bid, s.bu) <= 5
""")
def op11_hard_negatives(spark, d):
    rows = op11.integer_vectors(table(spark, d, "embeddings"))
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return op11.mine(op11.build_index(rows, F.col("vec_id") % 100 == 0))


@register("op12_conversation_trie", r"""
WITH t AS (
  SELECT conv_id, size, item, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, item) AS i
  FROM (SELECT conv_id, turn, length(coalesce(text, '')) AS size,
               sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS item
        FROM conversations WHERE conv_id IS NOT NULL)),
c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS head, xor(list_reduce(
           list_prepend(4294967295::UBIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
           lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
                                    lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, 0 AS own, t.i, t.item, t.size FROM c JOIN t ON t.conv_id = c.head AND t.i <= c.h
  UNION ALL SELECT c.conv_id, 1, t.i, t.item, t.size FROM c JOIN t ON t.conv_id = c.conv_id AND t.i > c.h),
s AS (
  SELECT conv_id, coalesce(len(items), 0) AS n, items, sizes FROM c LEFT JOIN (
    SELECT conv_id, list(item ORDER BY own, i) AS items, list(size ORDER BY own, i) AS sizes FROM r GROUP BY conv_id) USING (conv_id)),
p AS (
  SELECT conv_id, n, d, CASE WHEN d = 0 THEN '' ELSE sha256(array_to_string(items[1:d], '')) END AS k,
         CASE WHEN d = 0 THEN 0 ELSE sizes[d] END AS size
  FROM (SELECT *, unnest(range(0, n + 1)) AS d FROM s)),
node AS (
  SELECT d, k, min(conv_id) AS id, count(*) AS n_convs, (count(*) - 1) * max(size) AS own,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends
  FROM p GROUP BY d, k),
up AS (SELECT node.*, p.k AS parent_key FROM node LEFT JOIN p ON p.conv_id = node.id AND p.d = node.d - 1),
kids AS (SELECT d - 1 AS d, parent_key AS k, count(*) AS n FROM up WHERE d > 0 GROUP BY ALL),
tree AS (
  SELECT up.*, coalesce(kids.n, 0) AS n_children, above.id AS parent FROM up LEFT JOIN kids ON kids.d = up.d AND kids.k = up.k
  LEFT JOIN node above ON above.d = up.d - 1 AND above.k = up.parent_key),
sums AS (
  SELECT p.d, p.k, count(*) FILTER (tree.n_children = 0) AS leaves, sum(tree.own) AS saved
  FROM tree JOIN p ON p.conv_id = tree.id AND p.d <= tree.d GROUP BY p.d, p.k)
SELECT id AS conv_id, d AS depth, parent AS parent_conv_id, n_convs, n_children, leaves AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, ends AS ends_sha256
FROM tree JOIN sums USING (d, k)
""")
def op12_conversation_trie(spark, d):
    return op12.prefix_trie(*op12.rebuild(op12.number_turns(table(spark, d, "conversations"))))


@register("op13_katz_scores")
def op13_katz_scores(spark, d):
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    return op13.score(table(spark, d, "documents"), held_out)[0]
