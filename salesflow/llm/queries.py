"""The corpus queries: thin columns over the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.llm import (
    fingerprints, html_text, language, licenses, ngram_join, packing, pii, prefix_trie, quality, repeats, sharding, suffixes, turn_repair,
)
from salesflow.llm.common import table

VOCABULARY = "word_bpe_49k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary_path())


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.similar_sets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("size").alias("n_shingles"), F.col("component").alias("component_id"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), quality.held_out()
    found = language.predict(docs, language.train(docs, ~held))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "ambiguous")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.detect(docs, pii.train(docs))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality.score(docs.select("doc_id", "text"), quality.train(docs, labels))
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licenses.scan(docs, licenses.train(docs))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair(table(spark, sf_dir, "conversations"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_fingerprints, op2_packing, op3_ngram_join, op4_decontamination, op5_language, op6_html_text, op7_pii, op8_quality,
    op9_licenses, op10_sharding, op11_turn_repair, op12_prefix_trie, op13_repeats)}

_FOLDED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP3_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all({_FOLDED}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[j:j + least(5, len(w)) - 1], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS j FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
e AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.v, r.c FROM r JOIN e ON e.u = r.doc_id AND r.c < e.v)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.c) AS component_id
FROM r LEFT JOIN n USING (doc_id) GROUP BY r.doc_id"""

_OP4_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, k, array_to_string(w[j:j + k - 1], ' ') AS win
       FROM (SELECT item, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS j FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, j, array_to_string(w[j:j + k - 1], ' ') AS win
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS j FROM d, ks WHERE len(w) >= k)),
hit AS (SELECT doc_id, item, j, dw.k FROM dw JOIN bw USING (k, win)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(j, j + k)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS items FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)"""

_OP12_SQL = """
WITH RECURSIVE c AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM conversations WHERE conv_id IS NOT NULL),
bits(conv_id, s, p, r) AS (SELECT conv_id, s, 0, CAST(4294967295 AS BIGINT) FROM c UNION ALL
  SELECT conv_id, s, p + 1, xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END)
  FROM (SELECT conv_id, s, p, CASE WHEN p % 8 = 0 THEN xor(r, ascii(substr(s, p // 8 + 1, 1))) ELSE r END AS x FROM bits WHERE p < 8 * length(s))),
h AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor(r, 4294967295) % 6 AS h FROM bits WHERE p = 8 * length(s)),
o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i FROM conversations),
t AS (SELECT h.conv_id, 0 AS part, i, role, text FROM h JOIN o ON o.conv_id = h.base AND i <= h
      UNION ALL SELECT conv_id, 1, i, role, text FROM h JOIN o USING (conv_id) WHERE i > h),
n AS (SELECT conv_id, row_number() OVER w AS d, length(text) AS chars,
        md5(string_agg(md5(length(role) || ':' || role || text), '' ) OVER (PARTITION BY conv_id ORDER BY part, i ROWS UNBOUNDED PRECEDING)) AS k
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY part, i)),
m AS (SELECT conv_id, d, chars, k FROM n UNION ALL SELECT conv_id, 0, 0, '' FROM c),
v AS (SELECT d, k, min(conv_id) AS owner, count(*) AS n_convs, any_value(chars) AS chars FROM m GROUP BY d, k),
p AS (SELECT v.*, up.k AS pk, above.owner AS parent FROM v LEFT JOIN m up ON up.conv_id = v.owner AND up.d = v.d - 1
      LEFT JOIN v above ON above.d = v.d - 1 AND above.k = up.k),
ch AS (SELECT d - 1 AS d, pk AS k, count(*) AS n_children FROM p WHERE d > 0 GROUP BY ALL),
x AS (SELECT p.*, coalesce(n_children, 0) AS n_children FROM p LEFT JOIN ch USING (d, k)),
tot AS (SELECT m.d, m.k, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * x.chars) AS saved
        FROM x JOIN m ON m.conv_id = x.owner AND m.d <= x.d GROUP BY m.d, m.k),
e AS (SELECT d, k, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ids
      FROM (SELECT conv_id, d, k FROM m QUALIFY d = max(d) OVER (PARTITION BY conv_id)) GROUP BY d, k)
SELECT owner AS conv_id, CAST(d AS BIGINT) AS depth, parent AS parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, coalesce(ids, sha256('')) AS ends_sha256 FROM x JOIN tot USING (d, k) LEFT JOIN e USING (d, k)"""

_OP13_SQL = """
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST) AS o, doc_id, hex(encode(coalesce(text, ''))) AS h,
             octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT o, j, md5_number(substr(h, 2 * j + 1, 200)) AS k FROM (SELECT o, h, unnest(range(n - 99)) AS j FROM d WHERE n >= 100)),
f AS (SELECT k, min(o * 4294967296 + j) AS first FROM w GROUP BY k),
g AS (SELECT o, j, coalesce(j > lag(j) OVER (PARTITION BY o ORDER BY j) + 100, true) AS opens FROM w JOIN f USING (k) WHERE o * 4294967296 + j <> first),
s AS (SELECT o, min(j) AS a, max(j) + 100 AS b
      FROM (SELECT o, j, sum(opens::INT) OVER (PARTITION BY o ORDER BY j) AS run FROM g) GROUP BY o, run),
p AS (SELECT o, a, b, coalesce(lag(b) OVER (PARTITION BY o ORDER BY a), 0) AS before FROM s),
r AS (SELECT o, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS tail,
        string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head FROM p JOIN d USING (o) GROUP BY o)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN tail IS NULL THEN h ELSE head || substr(h, 2 * tail + 1) END)) AS kept_sha256 FROM d LEFT JOIN r USING (o)"""

#: the other queries' hashes, tokenizers, trees and message passing have no SQL; tests/llm hold brute-force versions
ORACLE_SQL: dict[str, str] = {"op3_ngram_join": _OP3_SQL, "op4_decontamination": _OP4_SQL, "op12_prefix_trie": _OP12_SQL, "op13_repeats": _OP13_SQL}
