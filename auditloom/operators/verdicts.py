"""Verdicts over test outcomes: before/after classes, flake quarantine, resolution rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def transitions(before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """key and class of each test in both runs: fail_to_pass, pass_to_pass, pass_to_fail (null else). Both have status."""
    both = before.select(*key, F.col("status").alias("was")).join(after.select(*key, F.col("status").alias("now")), key)
    was, now = F.col("was"), F.col("now")
    bad = was.isin("failed", "error")
    kind = F.when(bad & (now == "passed"), "fail_to_pass").when((was == "passed") & (now == "passed"), "pass_to_pass").when((was == "passed") & now.isin("failed", "error"), "pass_to_fail")
    return both.select(*key, kind.alias("class"))


def quarantine(rows: DataFrame, key: list[str], run: str, runs: int) -> DataFrame:
    """key, n_runs and class: stable in all runs, flaky in some. One aggregation, whatever the number of runs."""
    seen = rows.groupBy(*key).agg(F.count_distinct(run).alias("n_runs"))
    return seen.select(*key, "n_runs", F.when(F.col("n_runs") >= runs, "stable").otherwise("flaky").alias("class"))


def graded(expected: DataFrame, actual: DataFrame, key: list[str]) -> DataFrame:
    """Expected tests with their outcome, missing where the run has none."""
    return expected.join(actual.select(*key, "status"), key, "left").withColumn("status", F.coalesce("status", F.lit("missing")))


def resolved(status: Column, kind: Column, rule: str = "strict") -> Column:
    """An aggregate over graded tests with kind fail_to_pass or pass_to_pass.

    strict: all passed, true without any. lenient: all of the first kind passed and there is one; of the
    second none failed. first_only: all of the first kind passed.
    """
    first, second = kind == "fail_to_pass", kind == "pass_to_pass"
    all_of = lambda which, met: F.coalesce(F.bool_and(F.when(which, met)), F.lit(True))
    if rule == "strict":
        return all_of(first, status == "passed") & all_of(second, status == "passed")
    if rule == "lenient":
        return (F.count_if(first) > 0) & all_of(first, status == "passed") & all_of(second, status != "failed")
    return all_of(first, status == "passed")


def resolved_by_log(log: Column, fixed: Column, kept: Column, language: str) -> Column:
    """Whether a log has all tests of fixed pass, of which there must be one, and none of kept fail (A-10b).

    python: a test's name may stand anywhere in a line that says PASSED or FAILED beside it; rust: lines of that very
    test count, and an error with a number fails the whole. Null logs and lists are empty, empty names count as none.
    """
    lines = F.split(F.coalesce(log, F.lit("")), "\n")
    names = lambda c: F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda t: t.isNotNull() & (t != ""))
    if language == "rust":
        ok, bad = (F.filter(lines, lambda x: x.startswith("test ") & x.contains(" ... ok")), F.filter(lines, lambda x: x.startswith("test ") & x.contains(" ... FAILED")))
        says = lambda said, t, w: F.exists(said, lambda x: x.startswith(F.concat(F.lit("test "), t, F.lit(f" ... {w}"))))
        compiled = ~F.exists(lines, lambda x: x.rlike(r"^error\[E\d{4}\]"))
        words = ("ok", "FAILED")
    else:
        ok, bad = F.filter(lines, lambda x: x.contains("PASSED")), F.filter(lines, lambda x: x.contains("FAILED"))
        says = lambda said, t, w: F.exists(said, lambda x: F.contains(x, t) & F.contains(F.replace(x, t, F.lit("\n")), F.lit(w)))
        compiled, words = F.lit(True), ("PASSED", "FAILED")
    return compiled & (F.size(names(fixed)) > 0) & F.forall(names(fixed), lambda t: says(ok, t, words[0])) & ~F.exists(names(kept), lambda t: says(bad, t, words[1]))


def validation_status(stable_first: Column, compiled: Column, error: Column) -> Column:
    return F.when(error.isNotNull(), "error").when(~compiled | (F.size(stable_first) == 0), "invalid").otherwise("valid")


def fishers_exact(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Two-sided p of a 2 x 2 table of counts, from sums of logarithms; tables no likelier than the given one add up."""
    log_factorial = lambda n: F.when(n > 1, F.aggregate(F.sequence(F.lit(2).cast("bigint"), n.cast("bigint")), F.lit(0.0), lambda s, x: s + F.log(x.cast("double")))).otherwise(0.0)
    rows, columns, total = a + b, a + c, a + b + c + d
    fixed = log_factorial(rows) + log_factorial(c + d) + log_factorial(columns) + log_factorial(b + d) - log_factorial(total)
    log_p = lambda x: fixed - log_factorial(x) - log_factorial(rows - x) - log_factorial(columns - x) - log_factorial(total - rows - columns + x)
    low, high = F.greatest(F.lit(0), rows + columns - total), F.least(rows, columns)
    # Each table's logarithm follows from the one before, so the work grows with the counts and not with their square.
    step = lambda x: F.log((rows - x).cast("double")) + F.log((columns - x).cast("double")) - F.log((x + 1).cast("double")) - F.log((total - rows - columns + x + 1).cast("double"))
    state = lambda at, own, sum_: F.struct(at.alias("at"), own.alias("own"), sum_.alias("sum"))
    add = lambda s, x: state(s["at"] + F.when(x < high, step(x)).otherwise(0.0), s["own"], s["sum"] + F.when(s["at"] <= s["own"] + 1e-7, F.exp(s["at"])).otherwise(0.0))
    return F.least(F.lit(1.0), F.aggregate(F.sequence(low.cast("bigint"), high.cast("bigint")), state(log_p(low), log_p(a), F.lit(0.0)), add, lambda s: s["sum"]))
