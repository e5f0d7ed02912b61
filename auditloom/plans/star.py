"""Queries over the star schema: fallbacks, comparisons, roll-ups, set algebra at larger scale."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from auditloom.functions import text
from auditloom.operators import joins, reports, samples, windows
from auditloom.operators.verdicts import fishers_exact, graded
from auditloom.plans.common import Register

register = Register()


@register("SELECT coalesce(l_returnflag, 'missing') AS status, CAST(count(*) AS BIGINT) AS n FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem) ON o_orderkey = l_orderkey GROUP BY 1")
def missing_default(read):
    lines = read("lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_returnflag").alias("status")).distinct()
    return graded(read("orders").select(F.col("o_orderkey").alias("key")), lines, ["key"]).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@register("SELECT o_orderkey, o_orderdate FROM orders WHERE coalesce(o_orderstatus, '') <> '' AND o_totalprice > 1000 ORDER BY o_orderdate DESC, o_orderkey LIMIT 50")
def viable_top(read):
    fine = (text.blank(F.col("o_orderstatus")) != "") & (F.col("o_totalprice") > 1000)
    return read("orders").where(fine).orderBy(F.desc("o_orderdate"), "o_orderkey").limit(50).select("o_orderkey", "o_orderdate")


@register("SELECT c_custkey FROM customer ANTI JOIN (SELECT o_custkey AS c_custkey FROM orders WHERE o_totalprice > 300000) USING (c_custkey)")
def anti_existing(read):
    return read("customer").join(read("orders").where("o_totalprice > 300000"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@register("SELECT p_type, CAST(count(*) AS BIGINT) AS n FROM part SEMI JOIN (SELECT l_partkey AS p_partkey FROM lineitem WHERE l_quantity >= 49) USING (p_partkey) GROUP BY p_type")
def semi_specs(read):
    return read("part").join(read("lineitem").where("l_quantity >= 49"), F.col("p_partkey") == F.col("l_partkey"), "left_semi").groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))


@register("""
WITH a AS (SELECT DISTINCT c_nationkey AS nation, CAST(c_custkey % 100 AS BIGINT) AS id FROM customer), b AS (SELECT DISTINCT s_nationkey AS nation, CAST(s_suppkey % 100 AS BIGINT) AS id FROM supplier)
SELECT coalesce(a.nation, b.nation) AS nation, CAST(count(*) FILTER (WHERE a.id IS NOT NULL AND b.id IS NOT NULL) AS BIGINT) AS overlap, CAST(count(*) FILTER (WHERE b.id IS NULL) AS BIGINT) AS ours_only, CAST(count(*) FILTER (WHERE a.id IS NULL) AS BIGINT) AS theirs_only
FROM a FULL JOIN b ON a.nation = b.nation AND a.id = b.id GROUP BY 1""")
def outer_compare(read):
    ours = read("customer").select(F.col("c_nationkey").alias("nation"), (F.col("c_custkey") % 100).alias("id"))
    theirs = read("supplier").select(F.col("s_nationkey").alias("nation"), (F.col("s_suppkey") % 100).alias("id"))
    return reports.outer_comparison(ours, theirs, ["nation", "id"], ["nation"])


@register("""
WITH b AS (SELECT o_orderkey, CAST(date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS INT) AS d FROM orders), i AS (SELECT o_orderkey AS key, d AS lo, d + 3 AS hi FROM b)
SELECT key, CAST(count(*) AS BIGINT) AS n FROM i JOIN b ON d BETWEEN lo AND hi GROUP BY key""")
def interval_join(read):
    """Every order is an interval: points are counted by day first, so no pair of orders is made."""
    days = read("orders").select("o_orderkey", F.date_diff(F.to_date("o_orderdate"), F.lit("1990-01-01").cast("date")).alias("d"))
    spans = days.select(F.col("o_orderkey").alias("key"), F.col("d").alias("lo"), (F.col("d") + 3).alias("hi"))
    per_day = days.groupBy("d").agg(F.count(F.lit(1)).alias("m"))
    return joins.in_intervals(per_day, spans, "d", "lo", "hi", 4).groupBy("key").agg(F.sum("m").alias("n"))


@register("""
WITH k AS (SELECT DISTINCT p_name AS key FROM part UNION SELECT 'red' UNION SELECT 'small' UNION SELECT 'ECONOMY')
SELECT CASE WHEN a.key IS NOT NULL THEN 'full' WHEN b.key IS NOT NULL THEN 'word' WHEN c.key IS NOT NULL THEN 'type' END AS level, coalesce(a.key, b.key, c.key) AS key, CAST(count(*) AS BIGINT) AS n
FROM part LEFT JOIN k a ON p_name || ' ' || p_size = a.key LEFT JOIN k b ON string_split(p_name, ' ')[1] = b.key LEFT JOIN k c ON p_type = c.key GROUP BY ALL""")
def snap_fallback(read):
    """snap_fallback with the names of all parts known."""
    part, spark = read("part"), read("part").sparkSession
    known = part.select(F.col("p_name").alias("key")).union(spark.createDataFrame([("red",), ("small",), ("ECONOMY",)], "key string"))
    options = {"full": F.concat_ws(" ", "p_name", "p_size"), "word": F.split("p_name", " ")[0], "type": F.col("p_type")}
    return joins.snapped(part, known, options).groupBy("level", "key").agg(F.count(F.lit(1)).alias("n"))


@register("""
WITH p AS (SELECT DISTINCT o_orderpriority FROM orders), c AS (SELECT n_nationkey, n_name, o_orderpriority FROM nation CROSS JOIN p),
o AS (SELECT c_nationkey, o_orderpriority, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 400000 GROUP BY ALL)
SELECT n_name, c.o_orderpriority, CAST(coalesce(n, 0) AS BIGINT) AS n FROM c LEFT JOIN o ON n_nationkey = c_nationkey AND c.o_orderpriority = o.o_orderpriority""")
def cross_models(read):
    models = read("orders").select("o_orderpriority").distinct()
    counts = read("orders").where("o_totalprice > 400000").join(read("customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("n_nationkey"), "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return read("nation").crossJoin(models).join(counts, ["n_nationkey", "o_orderpriority"], "left").select("n_name", "o_orderpriority", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


@register("""
SELECT n_name, o_orderpriority, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS n_resolved, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END), 6) AS rate
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ROLLUP (n_name, o_orderpriority)""")
def resolve_report(read):
    rows = read("orders").join(read("customer"), F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(read("nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    solved = F.col("o_orderstatus") == "F"
    return rows.rollup("n_name", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.count_if(solved).alias("n_resolved"), F.round(F.avg(solved.cast("double")), 6).alias("rate"))


@register("""
WITH s AS (SELECT l_orderkey, bool_and(l_returnflag <> 'R') AS a, bool_or(l_returnflag <> 'R') AS b FROM lineitem GROUP BY l_orderkey)
SELECT CASE WHEN a THEN 'easy' WHEN NOT b THEN 'hard' ELSE 'separating' END AS class, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY 1""")
def difficulty_split(read):
    return reports.solved_classes(read("lineitem"), ["l_orderkey"], F.col("l_returnflag") != "R").groupBy("class").agg(F.count(F.lit(1)).alias("n"))


@register("""
SELECT o_orderstatus, CAST(count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS BIGINT) AS urgent, CAST(count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS BIGINT) AS low,
  CAST(count(*) FILTER (WHERE o_orderpriority = '1-URGENT') - count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS BIGINT) AS difference FROM orders GROUP BY o_orderstatus""")
def pivot_models(read):
    wide = read("orders").groupBy("o_orderstatus").pivot("o_orderpriority", ["1-URGENT", "5-LOW"]).count()
    urgent, low = F.coalesce(F.col("1-URGENT"), F.lit(0)), F.coalesce(F.col("5-LOW"), F.lit(0))
    return wide.select("o_orderstatus", urgent.alias("urgent"), low.alias("low"), (urgent - low).alias("difference"))


@register("""
WITH m AS (SELECT avg(CASE WHEN p_size % 5 = l_linenumber % 5 THEN 1.0 ELSE 0.0 END) AS size, avg(CASE WHEN substr(p_brand, 7, 1) = substr(CAST(l_suppkey AS VARCHAR), 1, 1) THEN 1.0 ELSE 0.0 END) AS brand, avg(CASE WHEN (p_type = 'ECONOMY') = (l_returnflag = 'A') THEN 1.0 ELSE 0.0 END) AS kind FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT 'size' AS field, round(size, 6) AS match_rate FROM m UNION ALL SELECT 'brand', round(brand, 6) FROM m UNION ALL SELECT 'kind', round(kind, 6) FROM m UNION ALL SELECT 'overall', round((size + brand + kind) / 3, 6) FROM m""")
def field_match(read):
    pairs = read("lineitem").join(read("part"), F.col("l_partkey") == F.col("p_partkey"))
    fields = {"size": F.col("p_size") % 5 == F.col("l_linenumber") % 5, "brand": F.substring("p_brand", 7, 1) == F.substring(F.col("l_suppkey").cast("string"), 1, 1), "kind": (F.col("p_type") == "ECONOMY") == (F.col("l_returnflag") == "A")}
    return reports.field_matches(pairs, fields)


@register("""
SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate) AS INT) AS rank FROM lineitem QUALIFY rank <= 3""")
def topk_per_group(read):
    order = [F.desc("l_extendedprice"), *map(F.col, ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate"))]
    return samples.first_n(read("lineitem"), ["l_suppkey"], order, 3).select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice", "rank")


@register("""
WITH r AS (SELECT o_orderpriority, CAST(year(o_orderdate) AS INT) AS y, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS rate FROM orders GROUP BY ALL), s AS (SELECT *, lag(rate) OVER (PARTITION BY o_orderpriority ORDER BY y) AS before FROM r)
SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n, bool_and(before IS NULL OR rate >= before) AS monotonic FROM s GROUP BY o_orderpriority""")
def monotonic(read):
    rates = read("orders").groupBy("o_orderpriority", F.year("o_orderdate").alias("y")).agg(F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("rate"))
    return windows.non_decreasing(rates, ["o_orderpriority"], [F.col("y")], "rate")


@register("""
WITH a AS (SELECT o_orderkey AS k FROM orders WHERE o_totalprice > 200000), b AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_quantity > 45)
SELECT 'intersect' AS op, CAST(count(*) AS BIGINT) AS n FROM (SELECT k FROM a INTERSECT SELECT k FROM b) UNION ALL SELECT 'ours', count(*) FROM (SELECT k FROM a EXCEPT SELECT k FROM b)
UNION ALL SELECT 'theirs', count(*) FROM (SELECT k FROM b EXCEPT SELECT k FROM a) UNION ALL SELECT 'union', count(*) FROM (SELECT k FROM a UNION SELECT k FROM b)""")
def setops(read):
    """Both sides of keys meet once; the four counts are sums over one full join."""
    a = read("orders").where("o_totalprice > 200000").select(F.col("o_orderkey").alias("k")).distinct().withColumn("ours", F.lit(True))
    b = read("lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("k")).distinct().withColumn("theirs", F.lit(True))
    ours, theirs = F.col("ours").isNotNull(), F.col("theirs").isNotNull()
    met = {"intersect": ours & theirs, "ours": ours & ~theirs, "theirs": theirs & ~ours, "union": ours | theirs}
    counts = a.join(b, "k", "full").agg(*[F.count_if(m).alias(n) for n, m in met.items()])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("op"), F.col(n).alias("n")) for n in met])).alias("r")).select("r.*")


@register("""SELECT p_partkey, sha256('{"brand":"' || p_brand || '","name":"' || p_name || '","size":"' || p_size || '","type":"' || p_type || '"}') AS spec_hash FROM part""")
def spec_hash(read):
    fields = F.struct(F.col("p_brand").alias("brand"), F.col("p_name").alias("name"), F.col("p_size").cast("string").alias("size"), F.col("p_type").alias("type"))
    return read("part").select("p_partkey", F.sha2(F.to_json(fields).cast("binary"), 256).alias("spec_hash"))


@register("""
WITH t AS (SELECT c_nationkey, CAST(count(*) FILTER (WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') AS BIGINT) AS a, CAST(count(*) FILTER (WHERE o_orderstatus <> 'F' AND o_orderpriority = '1-URGENT') AS BIGINT) AS b,
  CAST(count(*) FILTER (WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW') AS BIGINT) AS c, CAST(count(*) FILTER (WHERE o_orderstatus <> 'F' AND o_orderpriority = '5-LOW') AS BIGINT) AS d FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey),
x AS (SELECT *, unnest(range(greatest(0, a + b + a + c - (a + b + c + d)), least(a + b, a + c) + 1)) AS k FROM t),
p AS (SELECT *, lgamma(a + b + 1) + lgamma(c + d + 1) + lgamma(a + c + 1) + lgamma(b + d + 1) - lgamma(a + b + c + d + 1) - lgamma(k + 1) - lgamma(a + b - k + 1) - lgamma(a + c - k + 1) - lgamma(d - a + k + 1) AS lp,
  lgamma(a + b + 1) + lgamma(c + d + 1) + lgamma(a + c + 1) + lgamma(b + d + 1) - lgamma(a + b + c + d + 1) - lgamma(a + 1) - lgamma(b + 1) - lgamma(c + 1) - lgamma(d + 1) AS l0 FROM x)
SELECT c_nationkey, a, b, c, d, round(least(1.0, sum(CASE WHEN lp <= l0 + 1e-7 THEN exp(lp) ELSE 0 END)), 6) AS p_value FROM p GROUP BY ALL""")
def fisher_nations(read):
    """Over all orders."""
    rows = read("orders").join(read("customer"), F.col("o_custkey") == F.col("c_custkey"))
    solved, urgent, low = F.col("o_orderstatus") == "F", F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority") == "5-LOW"
    t = rows.groupBy("c_nationkey").agg(F.count_if(solved & urgent).alias("a"), F.count_if(~solved & urgent).alias("b"), F.count_if(solved & low).alias("c"), F.count_if(~solved & low).alias("d"))
    return t.withColumn("p_value", F.round(fishers_exact(F.col("a"), F.col("b"), F.col("c"), F.col("d")), 6))


@register("SELECT o_custkey % 100 AS job, max(length(n_name)) AS size, arg_max(n_name, (length(n_name), n_name)) AS name FROM orders JOIN nation ON contains(o_custkey || 'NATION_' || (o_custkey % 30), n_name) GROUP BY 1")
def longest_match(read):
    jobs = read("orders").select((F.col("o_custkey") % 100).alias("job"), F.concat(F.col("o_custkey").cast("string"), F.lit("NATION_"), (F.col("o_custkey") % 30).cast("string")).alias("text"))
    found = joins.longest_contained(jobs, "text", read("nation").select(F.col("n_name").alias("name"))).where("name is not null")
    return found.groupBy("job").agg(F.max(F.length("name")).cast("bigint").alias("size"), F.max_by("name", F.struct(F.length("name"), "name")).alias("name"))


@register("SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS avg_discount, CAST(count(*) AS BIGINT) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL")
def pricing_summary(read):
    return read("lineitem").where("l_shipdate <= timestamp'1998-09-02'").groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_discount"), F.count(F.lit(1)).alias("n"))


@register("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r = 1")
def first_trial(read):
    first = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    return read("orders").withColumn("r", first).where("r = 1").select("o_custkey", "o_orderkey")
