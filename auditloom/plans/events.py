"""Queries over ordered records: outcomes, runs, verdicts, sessions, windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from auditloom.operators import joins, reports, verdicts, windows
from auditloom.plans.common import Register

register = Register()

_TERMINAL = ("error", "purchase", "signup")


@register("SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, arg_max(event_type, (ts, event_id)) AS status FROM events WHERE event_type IN ('error', 'purchase', 'signup') GROUP BY ALL")
def terminal_status(read):
    from auditloom.operators.logs import terminal_status as last

    return last(read("events").withColumn("day", F.date_format("ts", "yyyy-MM-dd")), ["user_id", "day"], "event_type", ["ts", "event_id"], _TERMINAL)


@register("SELECT event_type, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k, CAST(count(DISTINCT CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS n_k FROM events GROUP BY event_type")
def props_json(read):
    k = F.from_json("props", "k bigint")["k"]
    return read("events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(k).alias("sum_k"), F.count_distinct(k).alias("n_k"))


_HALVES = """
WITH s AS (SELECT user_id, ts < TIMESTAMP '2024-01-16' AS first, arg_max(CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'skipped' ELSE 'passed' END, (ts, event_id)) AS status FROM events GROUP BY ALL),
c AS (SELECT a.user_id, CASE WHEN a.status = 'failed' AND b.status = 'passed' THEN 'fail_to_pass' WHEN a.status = 'passed' AND b.status = 'passed' THEN 'pass_to_pass' WHEN a.status = 'passed' AND b.status = 'failed' THEN 'pass_to_fail' END AS class
  FROM s a JOIN s b ON a.user_id = b.user_id AND a.first AND NOT b.first)"""


def _halves(read):
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "skipped").otherwise("passed")
    rows = read("events").withColumn("status", status).withColumn("first", F.col("ts") < F.lit("2024-01-16").cast("timestamp"))
    last = rows.groupBy("user_id", "first").agg(F.max_by("status", F.struct("ts", "event_id")).alias("status"))
    return last.where("first"), last.where("not first")


@register(_HALVES + " SELECT user_id, class FROM c WHERE class IS NOT NULL")
def f2p_p2p(read):
    before, after = _halves(read)
    return verdicts.transitions(before, after, ["user_id"]).where("class is not null")


@register("""
WITH q AS (SELECT user_id, event_type, count(DISTINCT date_trunc('week', ts)) AS n FROM events WHERE ts < TIMESTAMP '2024-01-29' GROUP BY ALL)
SELECT user_id, event_type, CAST(n AS BIGINT) AS n_runs, CASE WHEN n >= 4 THEN 'stable' ELSE 'flaky' END AS class FROM q""")
def quarantine(read):
    rows = read("events").where("ts < timestamp'2024-01-29'").withColumn("run", F.date_trunc("week", "ts"))
    return verdicts.quarantine(rows, ["user_id", "event_type"], "run", 4)


def _resolved(rule: str):
    def build(read):
        before, after = _halves(read)
        kinds = verdicts.transitions(before, after, ["user_id"]).where("class in ('fail_to_pass', 'pass_to_pass')")
        week = read("events").where("ts >= timestamp'2024-01-24'").groupBy("user_id").agg(F.max_by(F.when(F.col("event_type") == "error", "failed").otherwise("passed"), F.struct("ts", "event_id")).alias("status"))
        tests = verdicts.graded(kinds, week, ["user_id"]).withColumn("instance", F.col("user_id") % 50)
        return tests.groupBy("instance").agg(F.count(F.lit(1)).alias("n_tests"), verdicts.resolved(F.col("status"), F.col("class"), rule).alias("resolved"))

    return build


_GRADED = _HALVES + """,
w AS (SELECT user_id, arg_max(CASE event_type WHEN 'error' THEN 'failed' ELSE 'passed' END, (ts, event_id)) AS status FROM events WHERE ts >= TIMESTAMP '2024-01-24' GROUP BY ALL),
g AS (SELECT c.user_id % 50 AS instance, class, coalesce(w.status, 'missing') AS status FROM c LEFT JOIN w USING (user_id) WHERE class IN ('fail_to_pass', 'pass_to_pass'))
SELECT instance, CAST(count(*) AS BIGINT) AS n_tests, """

resolve_all = _resolved("strict")
resolve_all.__name__ = "resolve_all"
register(_GRADED + "bool_and(status = 'passed') AS resolved FROM g GROUP BY instance")(resolve_all)
resolve_lenient = _resolved("lenient")
resolve_lenient.__name__ = "resolve_lenient"
register(_GRADED + "count(*) FILTER (WHERE class = 'fail_to_pass') > 0 AND coalesce(bool_and(status = 'passed') FILTER (WHERE class = 'fail_to_pass'), true) AND coalesce(bool_and(status <> 'failed') FILTER (WHERE class = 'pass_to_pass'), true) AS resolved FROM g GROUP BY instance")(resolve_lenient)


@register("""
SELECT role, repo, CAST(count(*) AS BIGINT) AS n, CAST(sum(length(text)) AS BIGINT) AS cost FROM (SELECT role, conv_id % 10 AS repo, text FROM conversations)
GROUP BY GROUPING SETS ((), (role), (repo))""")
def session_rollup(read):
    rows = read("conversations").select("role", (F.col("conv_id") % 10).alias("repo"), F.length("text").alias("cost"))
    return reports.at_grains(rows, [[], ["role"], ["repo"]], F.count(F.lit(1)).alias("n"), F.sum("cost").alias("cost")).select("role", "repo", "n", "cost")


@register("SELECT conv_id, role, turn, CAST(row_number() OVER (PARTITION BY conv_id, role ORDER BY turn, text) - 1 AS INT) AS attempt FROM conversations")
def attempt_index(read):
    return windows.attempts(read("conversations"), ["conv_id", "role"], [F.col("turn"), F.col("text")]).select("conv_id", "role", "turn", F.col("attempt").cast("int"))


@register("SELECT conv_id, turn, md5(last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, text ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS last_user FROM conversations")
def last_user_locf(read):
    rows = windows.carried(read("conversations"), ["conv_id"], [F.col("turn"), F.col("text")], F.when(F.col("role") == "user", F.col("text")), "said")
    return rows.select("conv_id", "turn", F.md5(F.col("said").cast("binary")).alias("last_user"))


@register("SELECT conv_id, turn, CAST(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn, text ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS BIGINT) AS near_chars FROM conversations")
def context_frame(read):
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn", "text").rowsBetween(-1, 1)
    return read("conversations").select("conv_id", "turn", F.sum(F.length("text")).over(w).alias("near_chars"))


@register("SELECT conv_id, turn FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS a, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS b FROM (SELECT DISTINCT conv_id, turn FROM conversations)) WHERE a <= 1 OR b <= 1")
def head_tail(read):
    return windows.head_and_tail(read("conversations").select("conv_id", "turn").distinct(), ["conv_id"], "turn", 1, 1)


@register("""
WITH f AS (SELECT user_id, min(ts) AS bound FROM events WHERE event_type = 'signup' GROUP BY user_id)
SELECT user_id, CAST(count(*) AS BIGINT) AS n, round(sum(value), 2) AS value FROM events JOIN f USING (user_id) WHERE event_type = 'purchase' AND ts < bound GROUP BY user_id""")
def range_join_hints(read):
    events = read("events")
    first = events.where("event_type = 'signup'").groupBy("user_id").agg(F.min("ts").alias("bound"))
    early = joins.before(events.where("event_type = 'purchase'"), first, "user_id", "ts", "bound")
    return early.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("value"))


@register("SELECT user_id, arg_min(event_id, (ts, event_id)) AS event_id FROM events WHERE event_type = 'error' GROUP BY user_id")
def asof_earliest(read):
    return joins.earliest(read("events"), ["user_id"], "event_id", ["ts", "event_id"], F.col("event_type") == "error")


@register("""
WITH e AS (SELECT user_id, event_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
SELECT user_id, round(sum(epoch_us(ts) - epoch_us(before)) / 1e6, 1) AS seconds FROM e WHERE before IS NOT NULL GROUP BY user_id""")
def duration(read):
    from pyspark.sql import Window

    before = F.lag("ts").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    gaps = read("events").withColumn("before", before).where("before is not null")
    return gaps.groupBy("user_id").agg(F.round(F.sum(F.timestamp_diff("MICROSECOND", F.col("before"), F.col("ts"))) / 1e6, 1).alias("seconds"))


@register("SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, CAST(count(*) AS BIGINT) AS n, round(sum(value), 2) AS value FROM events GROUP BY ALL")
def daily_window(read):
    rows = read("events").groupBy(F.window("ts", "1 day"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("value"))
    return rows.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n", "value")


@register("""
WITH r AS (SELECT event_type, CAST(ts AS DATE) AS day, avg(value) AS rate FROM events GROUP BY ALL), s AS (SELECT *, lag(rate) OVER (PARTITION BY event_type ORDER BY day) AS before FROM r)
SELECT event_type, CAST(count(*) AS BIGINT) AS n, bool_and(before IS NULL OR rate >= before) AS monotonic FROM s GROUP BY event_type""")
def monotonic_days(read):
    rates = read("events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.avg("value").alias("rate"))
    return windows.non_decreasing(rates, ["event_type"], [F.col("day")], "rate")


@register("""
WITH s AS (SELECT user_id, list_sort(list_distinct(list(event_type) FILTER (WHERE ts < TIMESTAMP '2024-01-16'))) AS a, list_sort(list_distinct(list(event_type) FILTER (WHERE ts >= TIMESTAMP '2024-01-16'))) AS b FROM events GROUP BY user_id),
p AS (SELECT user_id % 10 AS repo, coalesce(a, []) AS a, coalesce(b, []) AS b FROM s),
q AS (SELECT repo, len(list_intersect(a, b)) AS c, len(list_distinct(list_concat(a, b))) AS u, len(a) AS na, len(b) AS nb FROM p)
SELECT repo, CAST(count(*) AS BIGINT) AS n, round(avg(CASE WHEN c = u THEN 1.0 ELSE 0.0 END), 6) AS exact_rate, round(avg(CASE WHEN c = nb THEN 1.0 ELSE 0.0 END), 6) AS superset_rate,
  round(avg(CASE WHEN c = na THEN 1.0 ELSE 0.0 END), 6) AS subset_rate, round(avg(CASE WHEN u = 0 THEN 1.0 ELSE c / u END), 6) AS mean_jaccard FROM q GROUP BY repo""")
def set_agreement(read):
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    sets = read("events").groupBy("user_id").agg(F.collect_set(F.when(early, F.col("event_type"))).alias("a"), F.collect_set(F.when(~early, F.col("event_type"))).alias("b"))
    return reports.agreement(sets.withColumn("repo", F.col("user_id") % 10), F.col("a"), F.col("b"), "repo")
