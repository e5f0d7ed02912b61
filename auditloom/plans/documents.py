"""Queries over texts: quality reasons, contamination, duplicates, labels, samples."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from auditloom.functions import diff, text
from auditloom.operators import decontam, filters, reports, samples, windows
from auditloom.plans.common import Register

register = Register()

_REASONS = r"""
SELECT doc_id, lang, list_filter([
  CASE WHEN len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) < 40 THEN 'too_short' END,
  CASE WHEN regexp_matches(text, 'https?://\S+') THEN 'has_url' END,
  CASE WHEN regexp_matches(text, '(^|[^\p{L}\p{N}_])[0-9a-f]{7,40}([^\p{L}\p{N}_]|$)') THEN 'has_sha' END,
  CASE WHEN trim(regexp_replace(text, '!\[[^\]]*\]\([^)]*\)', '', 'g')) = '' THEN 'image_only' END,
  CASE WHEN (CASE WHEN text = '' THEN 0 ELSE len(string_split(text, chr(10))) - (CASE WHEN ends_with(text, chr(10)) THEN 1 ELSE 0 END) END) > 60 THEN 'too_large' END,
  CASE WHEN (CASE WHEN text = '' THEN 0 ELSE len(string_split(text, chr(10))) - (CASE WHEN ends_with(text, chr(10)) THEN 1 ELSE 0 END) END) < 1 THEN 'too_small' END
], lambda r: r IS NOT NULL) AS reasons FROM (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents)"""


def _reasons(docs):
    config = filters.FilterConfig(max_lines=60)
    rules = filters.statement_rules(F.col("text"), config) + filters.size_rules(F.col("text"), config)
    return docs.select("doc_id", "lang", filters.reasons(*rules).alias("reasons"))


@register(f"SELECT lang, reason, CAST(count(*) AS BIGINT) AS n FROM (SELECT lang, unnest(reasons) AS reason FROM ({_REASONS})) GROUP BY ALL")
def quality_reasons(read):
    return _reasons(read("documents")).select("lang", F.explode("reasons").alias("reason")).groupBy("lang", "reason").agg(F.count(F.lit(1)).alias("n"))


@register(f"SELECT lang, CAST(count(*) AS BIGINT) AS n, round(avg(CASE WHEN len(reasons) = 0 THEN 1.0 ELSE 0.0 END), 6) AS pass_rate FROM ({_REASONS}) GROUP BY lang")
def quality_pass_rate(read):
    passed = (F.size("reasons") == 0).cast("double")
    return _reasons(read("documents")).groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(passed), 6).alias("pass_rate"))


@register(r"SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS host, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE url LIKE 'https:%') AS BIGINT) AS n_https FROM pages WHERE regexp_matches(coalesce(url, ''), 'https?://\S+') GROUP BY 1")
def url_pages(read):
    return read("pages").where(text.has_url(F.col("url"))).groupBy(F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("host")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("url").startswith("https:")).alias("n_https"))


@register(r"""
WITH d AS (SELECT DISTINCT doc_id, sha256(regexp_replace(unnest(string_split(text, chr(10))), '\s+$', '')) AS h, length(unnest(string_split(text, chr(10)))) AS len FROM documents),
b AS (SELECT DISTINCT sha256(regexp_replace(unnest(string_split(text, chr(10))), '\s+$', '')) AS h FROM benchmark)
SELECT doc_id, CAST(count(DISTINCT h) AS BIGINT) AS n_lines FROM d SEMI JOIN b USING (h) WHERE len > 0 GROUP BY doc_id""")
def decontam_line_hash(read):
    lines = lambda df, *keys: df.select(*keys, F.explode(F.split("text", "\n", -1)).alias("line")).where("line <> ''").select(*keys, F.sha2(F.regexp_replace("line", r"\s+$", "").cast("binary"), 256).alias("h")).distinct()
    return lines(read("documents"), "doc_id").join(lines(read("benchmark")), "h", "left_semi").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"))


@register("SELECT doc_id, item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)")
def decontam_contains(read):
    return decontam.containing(read("documents").select("doc_id", "text"), read("benchmark").select("item_id", F.col("text").alias("passage")))


@register(r"""
WITH i AS (SELECT CAST(doc_id AS VARCHAR) AS instance_id, sha256(regexp_replace(text, '\s+$', '')) AS patch_hash FROM documents),
r AS (SELECT CAST(item_id * 3 AS VARCHAR) AS instance_id, sha256(regexp_replace(text, '\s+$', '')) AS patch_hash, CASE WHEN item_id % 2 = 0 THEN 'even' ELSE 'odd' END AS source, CAST(item_id % 2 AS INT) AS source_order FROM benchmark
      UNION ALL SELECT CAST(-doc_id AS VARCHAR), sha256(regexp_replace(text, '\s+$', '')), 'copy', 2 FROM documents)
SELECT i.instance_id, arg_min(r.source, r.source_order) AS source FROM i LEFT JOIN r ON i.instance_id = r.instance_id OR i.patch_hash = r.patch_hash GROUP BY i.instance_id""")
def decontam_first_source(read):
    """decontam_first_source with every document in the reference."""
    hashed = F.sha2(F.regexp_replace("text", r"\s+$", "").cast("binary"), 256).alias("patch_hash")
    bench = read("benchmark").select((F.col("item_id") * 3).cast("string").alias("instance_id"), hashed, F.when(F.col("item_id") % 2 == 0, "even").otherwise("odd").alias("source"), (F.col("item_id") % 2).cast("int").alias("source_order"))
    copies = read("documents").select((-F.col("doc_id")).cast("string").alias("instance_id"), hashed, F.lit("copy").alias("source"), F.lit(2).alias("source_order"))
    docs = read("documents").select(F.col("doc_id").cast("string").alias("instance_id"), hashed)
    return decontam.contaminated(docs, bench.union(copies)).select("instance_id", "source")


@register("SELECT doc_id, md5(coalesce(text, '')) AS text_md5 FROM documents QUALIFY row_number() OVER (PARTITION BY md5(coalesce(text, '')) ORDER BY doc_id) = 1")
def dedup_keep_first(read):
    docs = read("documents").select("doc_id", F.md5(text.blank(F.col("text")).cast("binary")).alias("text_md5"))
    return docs.groupBy("text_md5").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "text_md5")


@register(r"""
WITH w AS (SELECT doc_id AS id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents),
b AS (SELECT item_id AS id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM benchmark),
ds AS (SELECT DISTINCT id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2])) AS s FROM w WHERE len(w) >= 3),
bs AS (SELECT DISTINCT id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2])) AS s FROM b WHERE len(w) >= 3),
dn AS (SELECT id, count(*) AS n FROM ds GROUP BY id), bn AS (SELECT id, count(*) AS n FROM bs GROUP BY id),
c AS (SELECT ds.id AS left_id, bs.id AS right_id, count(*) AS c FROM ds JOIN bs USING (s) GROUP BY ALL)
SELECT left_id, right_id, round(c / (dn.n + bn.n - c), 6) AS similarity FROM c JOIN dn ON dn.id = left_id JOIN bn ON bn.id = right_id WHERE c / (dn.n + bn.n - c) > 0.15""")
def near_dup_jaccard(read):
    pairs = decontam.shared_shingles(read("documents").select(F.col("doc_id").alias("id"), "text"), read("benchmark").select(F.col("item_id").alias("id"), "text"))
    return pairs.where("similarity > 0.15").withColumn("similarity", F.round("similarity", 6))


@register(f"""
WITH p AS (SELECT doc_id, len(reasons) = 0 AS pass FROM ({_REASONS})),
c AS (SELECT CAST(count(*) FILTER (WHERE quality = 1 AND pass) AS BIGINT) AS tp, CAST(count(*) FILTER (WHERE quality <> 1 AND pass) AS BIGINT) AS fp,
  CAST(count(*) FILTER (WHERE quality = 1 AND NOT pass) AS BIGINT) AS fn, CAST(count(*) FILTER (WHERE quality <> 1 AND NOT pass) AS BIGINT) AS tn FROM labels JOIN p USING (doc_id)),
r AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS p, coalesce(tp / nullif(tp + fn, 0), 0) AS q FROM c)
SELECT tp, fp, fn, tn, round(coalesce((tp + tn) / nullif(tp + fp + fn + tn, 0), 0), 6) AS accuracy, round(p, 6) AS precision, round(q, 6) AS recall, round(coalesce(2 * p * q / nullif(p + q, 0), 0), 6) AS f1 FROM r""")
def label_confusion(read):
    rows = read("labels").join(_reasons(read("documents")).select("doc_id", (F.size("reasons") == 0).alias("pass")), "doc_id")
    return reports.confusion(rows, F.col("quality") == 1, F.col("pass"))


@register("""
WITH r AS (SELECT lang, source, avg(CASE WHEN toxic = 0 THEN 1.0 ELSE 0.0 END) AS rate FROM labels JOIN documents USING (doc_id) GROUP BY ALL)
SELECT lang, CAST(count(*) AS BIGINT) AS n_runs, round(avg(rate), 6) AS mean_rate, round(stddev_pop(rate), 6) AS std_rate FROM r GROUP BY lang""")
def label_evasion(read):
    return reports.rate_by_run(read("labels").join(read("documents").select("doc_id", "lang", "source"), "doc_id"), ["lang"], "source", F.col("toxic") == 0)


@register("""
WITH g AS (SELECT lang, count(*) AS n, count(DISTINCT source) AS n_distinct, avg(n_chars) AS m, coalesce(stddev_pop(n_chars) / nullif(avg(n_chars), 0), 0) AS cv FROM documents GROUP BY lang)
SELECT lang, CAST(n AS BIGINT) AS n, CAST(n_distinct AS BIGINT) AS n_distinct, round(m, 6) AS mean_size, round(cv, 6) AS cv_size, round((least(1.0, n_distinct / n) + least(1.0, round(cv, 6))) / 2, 5) AS composite FROM g""")
def diversity(read):
    return reports.diversity(read("documents"), ["lang"], F.col("source"), F.col("n_chars"))


@register("SELECT source, doc_id, CAST(row_number() OVER (PARTITION BY source ORDER BY md5('sample-' || CAST(doc_id AS VARCHAR)), doc_id) AS INT) AS rank FROM documents QUALIFY rank <= 5")
def stratified(read):
    return samples.stratified(read("documents").select("source", "doc_id"), "source", "doc_id", 5)


@register("""
WITH s AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5('sample-' || CAST(doc_id AS VARCHAR)), doc_id) AS r FROM documents),
f AS (SELECT doc_id, source, CASE WHEN r <= 1 THEN 0 ELSE 1 END AS first FROM s)
SELECT doc_id, source FROM f ORDER BY first, md5('sample-' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 30""")
def filled_sample(read):
    return samples.filled(read("documents").select("doc_id", "source"), "source", "doc_id", 30, 20)


@register("""
WITH a AS (SELECT doc_id, 0 AS pool FROM documents WHERE lang = 'en' ORDER BY md5('sample-' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 40),
b AS (SELECT doc_id, 1 AS pool FROM documents ORDER BY md5('sample-' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 60)
SELECT DISTINCT doc_id FROM (SELECT doc_id FROM a UNION ALL SELECT doc_id FROM b)""")
def quota_sample(read):
    docs = read("documents")
    return samples.quotas([(docs.where("lang = 'en'").select("doc_id"), 40), (docs.select("doc_id"), 60)], "doc_id")


@register("SELECT lang, doc_id, CAST(row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS INT) AS turn FROM documents")
def interleave(read):
    """interleave with every document's turn."""
    order = [F.desc("n_chars"), F.col("doc_id")]
    return samples.interleaved(read("documents").select("lang", "doc_id", "n_chars"), "lang", order).select("lang", "doc_id", "turn")


@register(r"""
SELECT doc_id, CAST(CASE WHEN coalesce(text, '') = '' THEN 0 ELSE len(string_split(text, chr(10))) - (CASE WHEN ends_with(text, chr(10)) THEN 1 ELSE 0 END) END AS INT) AS n_lines,
  CAST(len(list_distinct(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: x <> ''))) AS INT) AS n_distinct_lines,
  len(list_distinct(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: x <> ''))) > 1 AS multi_line FROM documents""")
def segmentation(read):
    distinct = F.size(F.array_distinct(F.filter(F.split(text.blank(F.col("text")), "\n"), lambda x: x != "")))
    return read("documents").select("doc_id", text.line_count(F.col("text")).cast("int").alias("n_lines"), distinct.alias("n_distinct_lines"), (distinct > 1).alias("multi_line"))


@register(r"""
WITH e AS (SELECT doc_id, regexp_extract_all(text, '(\w+)\s+#?(\d+)', 1) AS w, regexp_extract_all(text, '(\w+)\s+#?(\d+)', 2) AS n FROM documents)
SELECT doc_id, list_sort(list_distinct(list_transform(list_filter(list_zip(w, n), lambda p: lower(p[1]) IN ('the', 'of', 'de', 'that')), lambda p: TRY_CAST(p[2] AS BIGINT)))) AS numbers FROM e
WHERE len(list_filter(list_zip(w, n), lambda p: lower(p[1]) IN ('the', 'of', 'de', 'that'))) > 0""")
def issue_extract(read):
    found = text.numbers_after(F.col("text"), ("the", "of", "de", "that"))
    return read("documents").select("doc_id", found.alias("numbers")).where(F.size("numbers") > 0)


@register(r"""
SELECT doc_id, greatest(CASE WHEN regexp_matches(text, '(?im)^Apache\s+\S+') THEN 1.0 ELSE 0.0 END, CASE WHEN regexp_matches(text, '(?i)token = ') THEN 0.9 ELSE 0.0 END, CASE WHEN regexp_matches(text, '(?i)[a-z0-9.]+@mail') THEN 0.7 ELSE 0.0 END) AS score
FROM documents""")
def sign_scores(read):
    t = text.blank(F.col("text"))
    signs = ((r"(?im)^Apache\s+\S+", 1.0), (r"(?i)token = ", 0.9), (r"(?i)[a-z0-9.]+@mail", 0.7))
    return read("documents").select("doc_id", F.greatest(*[F.when(t.rlike(p), F.lit(s)).otherwise(F.lit(0.0)) for p, s in signs]).alias("score"))


@register(r"""
WITH l AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS i, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT doc_id, CAST(i - 1 AS INT) AS line_no, md5(line) AS line_md5 FROM (SELECT *, max(CASE WHEN contains(line, '@') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS near FROM l) WHERE near = 1""")
def line_context(read):
    lines = read("documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    near = windows.near_match(lines, ["doc_id"], [F.col("line_no")], F.col("line").contains("@"), 1, 2)
    return near.where("near").select("doc_id", "line_no", F.md5(F.col("line").cast("binary")).alias("line_md5"))


@register()
def greedy_batches(read):
    """Batches of at most 200,000 characters and 64 rows a source, in order of doc_id."""
    return windows.greedy_batches(read("documents").select("source", "doc_id", "n_chars"), "source", "doc_id", "n_chars", 200_000, 64)


@register("SELECT doc_id, substr(sha256(coalesce(text, '')), 1, 12) AS short_hash, 90000 + ('0x' || substr(sha256(coalesce(text, '')), 1, 8))::BIGINT % 10000 AS number FROM documents")
def synthetic_ids(read):
    t = text.blank(F.col("text"))
    return read("documents").select("doc_id", text.short_hash(t).alias("short_hash"), text.synthetic_number(t).alias("number"))


@register(r"SELECT doc_id, sha256(array_to_string(list_transform(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: starts_with(x, 'T') OR starts_with(x, 'A')), lambda x: regexp_replace(x, '\s+$', '')), chr(10))) AS patch_hash FROM documents")
def content_hash(read):
    kept = F.filter(diff.lines(F.col("text")), lambda x: x.startswith("T") | x.startswith("A"))
    return read("documents").select("doc_id", F.sha2(F.array_join(F.transform(kept, lambda x: F.regexp_replace(x, r"\s+$", "")), "\n").cast("binary"), 256).alias("patch_hash"))


@register("SELECT source, CAST(count(*) AS BIGINT) AS n, list_sort(list(doc_id))[1:20] AS first_ids FROM documents WHERE n_chars < 600 GROUP BY source")
def top_ids(read):
    """Only the first twenty of each source are sorted on; the count is an aggregate of its own."""
    few = read("documents").where("n_chars < 600").select("source", "doc_id")
    w = Window.partitionBy("source").orderBy("doc_id")
    first = few.withColumn("r", F.row_number().over(w)).where("r <= 20").groupBy("source").agg(F.array_sort(F.collect_list("doc_id")).alias("first_ids"))
    return few.groupBy("source").agg(F.count(F.lit(1)).alias("n")).join(first.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).select("source", "n", "first_ids")


@register("SELECT regexp_replace(substr(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), 1, 30), '-+$', '') AS slug, CAST(count(*) AS BIGINT) AS n FROM pages GROUP BY 1")
def slugs(read):
    return read("pages").groupBy(text.slug(F.col("url"), 30).alias("slug")).agg(F.count(F.lit(1)).alias("n"))
