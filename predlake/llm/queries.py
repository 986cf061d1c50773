"""The registered queries of this subpackage: every operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .ann import nearest
from .common import table
from .langid import language_scores
from .packing import pack_documents
from .prefix_trie import prefix_trie
from .quality import quality_scores
from .secrets import find_secrets
from .sentencepiece_bpe import digest_texts
from .sharding import shard_by_bytes
from .simhash import simhash_groups
from .topk import top_k
from .toxicity import toxicity_scores
from .vector_codes import ENTRIES, PARTS, ROUNDS, SCALE, vector_codes
from .wrappers import extract_text

SCORES = ["doc_id", "held_out", "score", "predicted"]
SECRETS = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "scores"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_knn_quality": lambda spark, d: quality_scores(table(spark, d, "documents"), table(spark, d, "labels")).select(*SCORES),
    "op2_wrapper_extraction": lambda spark, d: extract_text(table(spark, d, "pages")).select("page_id", "url", "text", "n_chars"),
    "op3_cnn_secrets": lambda spark, d: find_secrets(table(spark, d, "documents")).select(*SECRETS),
    "op4_levenshtein_toxicity": lambda spark, d: toxicity_scores(table(spark, d, "documents"), table(spark, d, "labels")).select(*SCORES),
    "op5_inverted_multi_index": lambda spark, d: nearest(table(spark, d, "embeddings")),
    "op6_simhash_dedup": lambda spark, d: simhash_groups(table(spark, d, "documents")),
    "op7_topk_histogram": lambda spark, d: top_k(table(spark, d, "embeddings")),
    "op8_sentencepiece": lambda spark, d: digest_texts(table(spark, d, "documents"), public_tokenizers.path("piece_bpe_32k.model")),
    "op9_byte_sharding": lambda spark, d: shard_by_bytes(table(spark, d, "documents")),
    "op10_best_fit_packing": lambda spark, d: pack_documents(table(spark, d, "documents")),
    "op11_kneser_ney_language": lambda spark, d: language_scores(table(spark, d, "documents")).select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected"),
    "op12_resident_lloyd": lambda spark, d: vector_codes(table(spark, d, "embeddings")),
    "op13_prefix_trie": lambda spark, d: prefix_trie(table(spark, d, "conversations")),
}



def _lloyd_sql() -> str:
    """Lloyd's rounds on whole parts, one pair of expressions for each round."""
    parts = f"""
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS id, vec_id, label, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS (SELECT id, pos, list_slice(q, pos * len(q) // {PARTS} + 1, (pos + 1) * len(q) // {PARTS}) AS part FROM v, range({PARTS}) AS r(pos)),
b0 AS (SELECT pos, id - 1 AS entry, part FROM p WHERE id <= {ENTRIES})"""
    for r in range(ROUNDS + 1):
        parts += f""",
a{r} AS (SELECT id, pos, arg_min(entry, (d, entry)) AS entry, min(d) AS d, any_value(part) AS part
  FROM (SELECT id, pos, entry, p.part, CAST(list_sum([(x[1] - x[2]) * (x[1] - x[2]) FOR x IN list_zip(p.part, b.part)]) AS BIGINT) AS d FROM p JOIN b{r} AS b USING (pos)) GROUP BY id, pos)"""
        if r < ROUNDS:
            parts += f""",
m{r} AS (SELECT pos, entry, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS part
  FROM (SELECT pos, entry, i, sum(part[i]) AS s, count(*) AS n FROM a{r}, range(1, 129) AS k(i) WHERE i <= len(part) GROUP BY pos, entry, i) GROUP BY pos, entry),
b{r + 1} AS (SELECT pos, entry, coalesce(m{r}.part, b{r}.part) AS part FROM b{r} LEFT JOIN m{r} USING (pos, entry))"""
    return parts + f""",
coded AS (SELECT id, string_agg(printf('%02x', entry), '' ORDER BY pos) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY id),
books AS (SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY pos, entry)) AS codebooks_sha256 FROM b{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM v JOIN coded USING (id), books
"""


# CRC-32 of a decimal id, bit by bit: DuckDB has no function for it.
_CRC = """xor(list_reduce(list_concat([4294967295], [ascii(x) FOR x IN string_split(CAST(c AS VARCHAR), '')]),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""

_TRIE = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS rk
  FROM conversations WHERE conv_id IS NOT NULL),
size AS (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id),
c AS (SELECT conv_id AS c, c - c % 100 AS base, CAST({_CRC} AS BIGINT) % 6 AS h FROM (SELECT conv_id, conv_id AS c FROM size)),
m AS (SELECT c.c, c.base, c.h, least(c.h, coalesce(size.n, 0)) AS taken FROM c LEFT JOIN size ON size.conv_id = c.base),
turns AS (
  SELECT m.c, t.rk AS pos, role, text FROM m JOIN t ON t.conv_id = m.base AND t.rk <= m.h
  UNION ALL SELECT m.c, m.taken + t.rk - m.h, role, text FROM m JOIN t ON t.conv_id = m.c AND t.rk > m.h),
path AS (
  SELECT c, pos AS depth, length(text) AS n, string_agg(sha256(length(role) || ':' || role || text), ',') OVER (PARTITION BY c ORDER BY pos) AS node FROM turns
  UNION ALL SELECT c, 0, 0, '' FROM m),
parent AS (SELECT p.c, p.depth, p.n, p.node, q.node AS above FROM path p LEFT JOIN path q ON q.c = p.c AND q.depth = p.depth - 1),
last AS (SELECT c, max(depth) AS depth FROM path GROUP BY c),
ends AS (SELECT node, string_agg(CAST(path.c AS VARCHAR), ',' ORDER BY path.c) AS ids FROM path JOIN last USING (c, depth) GROUP BY node),
node AS (SELECT node, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(above) AS above, any_value(n) AS n FROM parent GROUP BY node, depth),
kids AS (SELECT above AS node, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY above),
sums AS (
  SELECT path.node, count(*) FILTER (WHERE kids.node IS NULL) AS n_leaves, sum((node.n_convs - 1) * node.n) AS saved
  FROM node LEFT JOIN kids USING (node) JOIN path ON path.c = node.conv_id AND path.depth <= node.depth GROUP BY path.node)
SELECT node.conv_id, node.depth, up.conv_id AS parent_conv_id, node.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM node JOIN sums USING (node) LEFT JOIN kids USING (node) LEFT JOIN ends USING (node) LEFT JOIN node AS up ON up.node = node.above
"""

# The other methods are not SQL: they learn, hash with XXH64 or CRC-32, tokenise, parse HTML or pack bins.
ORACLES: dict[str, str] = {
    "op7_topk_histogram": """
WITH v AS (
  SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
""",
    "op12_resident_lloyd": _lloyd_sql(),
    "op13_prefix_trie": _TRIE,
}
