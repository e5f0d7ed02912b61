"""The operators over whole tables, one query each, with SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditloom.llm import embedding_dedup, exact_dedup, language_id, mixing, ngram_join, packing, pii, prefix_trie, quality, repeats, sharding, toxicity, vector_codes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=90)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def remainder(of: int) -> Column:
    """crc32 of doc_id as text, modulo."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % of


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = quality.measured(table(spark, sf_dir, "documents"))
    model = quality.fit(stats, table(spark, sf_dir, "labels"), remainder(5) != 0)
    return quality.score(stats, model).select("doc_id", F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), remainder(4) != 2)
    return toxicity.score(docs, model).select("doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replaced(table(spark, sf_dir, "documents").select("doc_id", "text"), pii.session_key(spark))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.fit(docs, remainder(4) != 2))
    return found.select("doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, ids = prefix_trie.with_heads(prefix_trie.numbered(table(spark, sf_dir, "conversations")))
    return prefix_trie.trie(turns, ids)


QUERIES = {f.__name__: f for f in (op1_ngram_join, op2_suffix_dedup, op3_mixing, op4_quality, op5_exact_dedup, op6_embedding_dedup, op7_sharding, op8_toxicity, op9_packing, op10_pii, op11_language_id, op12_vector_codes, op13_prefix_trie)}


def _lloyd_sql(rounds: int = vector_codes.ROUNDS) -> str:
    """The rounds one after another: each assigns all parts and takes the means anew."""
    nearest = """(
  SELECT part, _row, arg_min({{e: entry, d: dist}}, [dist, entry]) AS best FROM (
    SELECT p.part, p._row, b.entry, list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS dist
    FROM parts p JOIN book{k} b ON b.part = p.part) GROUP BY part, _row)"""
    text = """
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS _row, vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 4096) AS BIGINT)) AS ints
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT _row, vec_id, label, part, ints[CAST(part * len(ints) / 8 + 1 AS INT) : CAST((part + 1) * len(ints) / 8 AS INT)] AS v FROM kept, range(8) t(part)
), book0 AS (SELECT part, _row - 1 AS entry, v FROM parts WHERE _row <= 16)"""
    for k in range(rounds):
        text += f""", near{k} AS {nearest.format(k=k)}, mean{k} AS (
  SELECT part, entry, list(m ORDER BY i) AS v FROM (
    SELECT n.part, n.best.e AS entry, i, CAST(floor(CAST(sum(p.v[i]) AS DOUBLE) / count(*)) AS BIGINT) AS m
    FROM near{k} n JOIN parts p ON p.part = n.part AND p._row = n._row, LATERAL (SELECT unnest(range(1, len(p.v) + 1)) AS i) GROUP BY ALL) GROUP BY part, entry
), book{k + 1} AS (SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM book{k} b LEFT JOIN mean{k} m ON m.part = b.part AND m.entry = b.entry)"""
    return (
        text
        + f""", last AS {nearest.format(k=rounds)}, coded AS (
  SELECT _row, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM last GROUP BY _row
), finger AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded JOIN kept USING (_row), finger"""
    )


SQL = {
    "op12_vector_codes": _lloyd_sql(),
    "op1_ngram_join": r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM split
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
keyed AS (SELECT doc_id, hash(g) AS h FROM grams),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM keyed a JOIN keyed b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL
), linked AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 90 * (p.n + q.n - c)
), sides AS (SELECT x, y FROM linked UNION SELECT y, x FROM linked),
reach(x, y) AS (
  SELECT x, y FROM sides UNION SELECT r.x, b.y FROM reach r JOIN sides b ON r.y = b.x
), least AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(least.y, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON least.x = d.doc_id""",
    "op3_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT source, source_size, CAST(2 * source_size AS DOUBLE) AS cap,
         [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight FROM per
), steps AS (
  SELECT cap, weight, 1.5::DOUBLE * sum(source_size) OVER () AS budget, sum(weight) OVER () AS weights,
         coalesce(sum(cap) OVER by_ratio, 0) AS caps, coalesce(sum(weight) OVER by_ratio, 0) AS gone,
         row_number() OVER (ORDER BY cap / weight, source) AS nth
  FROM weighed WINDOW by_ratio AS (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
  SELECT arg_min((budget - caps) / (weights - gone), nth) AS level FROM steps WHERE cap / weight >= (budget - caps) / (weights - gone)
), goals AS (
  SELECT source, source_size, least(cap, weight * coalesce(level, 0)) AS target FROM weighed, levels
), placed AS (
  SELECT doc_id, s.source, size, source_size, target,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY md5('mix-' || coalesce(CAST(doc_id AS VARCHAR), 'null')), doc_id NULLS LAST, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, source, size, source_size, target,
       CAST(whole * size + greatest(0, least(floor(target - whole * source_size - before), size)) AS BIGINT) AS taken
FROM placed""",
    "op5_exact_dedup": r"""
WITH hashed AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), groups AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM hashed GROUP BY text_sha256)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, text_sha256 FROM hashed JOIN groups USING (text_sha256)""",
    "op13_prefix_trie": r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS t, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL
), names AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS name FROM turns),
crc AS (
  SELECT conv_id, xor(4294967295, list_reduce(list_transform(range(1, length(name) + 1), lambda i: CAST(ascii(name[i]) AS BIGINT)),
    lambda c, b: list_reduce(range(8), lambda v, k: xor(v >> 1, 3988292384 * (v & 1)), xor(c, b)), 4294967295)) % 6 AS h FROM names
), ids AS (SELECT conv_id, conv_id - conv_id % 100 AS base, h FROM crc),
rebuilt AS (
  SELECT i.conv_id, 0 AS part, place, r, t FROM ids i JOIN turns b ON b.conv_id = i.base AND place < h
  UNION ALL SELECT conv_id, 1, place, r, t FROM turns JOIN ids USING (conv_id) WHERE place >= h
), numbered AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth, length(t) AS n, sha256(length(r) || ':' || r || t) AS own FROM rebuilt
), paths AS (
  SELECT conv_id, depth, n, sha256(string_agg(own, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS path FROM numbered
  UNION ALL SELECT conv_id, 0, 0, '' FROM ids
), linked AS (
  SELECT *, lag(path) OVER w AS up, lead(depth) OVER w IS NULL AS last FROM paths WINDOW w AS (PARTITION BY conv_id ORDER BY depth)
), nodes AS (
  SELECT path, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(up) AS up, count(*) AS n_convs, any_value(n) AS n,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256 FROM linked GROUP BY path
), children AS (SELECT up AS path, count(*) AS n_children FROM nodes WHERE up IS NOT NULL GROUP BY up),
full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (path)),
subtree AS (
  SELECT p.path, count(*) FILTER (WHERE v.n_children = 0) AS n_leaves, sum((v.n_convs - 1) * v.n) AS saved_tokens
  FROM full_nodes v JOIN paths p ON p.conv_id = v.conv_id AND p.depth <= v.depth GROUP BY p.path
)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, CAST(v.n_convs AS BIGINT) AS n_convs, CAST(v.n_children AS BIGINT) AS n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM full_nodes v JOIN subtree s USING (path) LEFT JOIN nodes u ON u.path = v.up""",
}
