"""Validation logs of many runs to one result an instance: tests fixed, kept and flaky, status (A-06, A-07, W-13, W-14).

A log holds, for each run, what the tests said before and after a fix, each part under a marker line. Parts
are cut from the log's text where it lies; the language's parser reads each part as a log of its own. Every
test of an instance then has two bitmaps, the runs in which it was fixed and those in which it kept
passing; one aggregation by (instance, test) makes them with bit_or, their bit counts tell stable tests
from flaky ones, and one by instance gives the result. Runs are numbered from 1 to at most ``MOST_RUNS``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditloom.functions import text
from auditloom.operators import logs

MOST_RUNS = 63
#: Words with which a log says that it ended early, and the messages of results.
PATCH_FAILED, NOTHING_FAILED = "PATCH_APPLY_FAILED", "NO_FAILING_TESTS"
PATCH_FAILED_MESSAGE, NOTHING_FAILED_MESSAGE, ALL_FLAKY_MESSAGE = "Patch apply failed", "No tests failed in pre-fix run", "All F2P tests quarantined as flaky"

#: Names of tests as results have them, by language: of each id, null where it doesn't count.
NAMES: dict[str, Callable[[Column], Column]] = {"go": lambda t: F.when(~text.is_e2e(t), text.go_test_name(t))}


def parts(validation_logs: DataFrame, marker: str) -> DataFrame:
    """(instance_id, run, phase, log) of logs (instance_id, log): what follows each line that holds ``<marker>_RUN_<n>_PRE`` or ``_POST``.

    A part ends where the next marker begins; of parts with equal run and phase the first counts.
    """
    begin = rf"\Q{marker}\E_RUN_(\d+)_(PRE|POST)"
    every = rf"(?s){begin}[^\n]*\n?(.*?)(?=\Q{marker}\E_RUN_\d+_(?:PRE|POST)|\z)"
    group = lambda g: F.regexp_extract_all("log", F.lit(every), F.lit(g))
    cut = validation_logs.select("instance_id", F.posexplode(F.arrays_zip(group(1).alias("run"), group(2).alias("phase"), group(3).alias("log"))).alias("at", "part"))
    first = cut.groupBy("instance_id", F.col("part.run").cast("int").alias("run"), F.col("part.phase").alias("phase")).agg(F.min_by("part.log", "at").alias("log"))
    return first.where(F.col("run").between(1, MOST_RUNS))


def run_classes(pieces: DataFrame, language: str) -> tuple[DataFrame, DataFrame]:
    """(instance_id, run, test_id, fixed, kept) of parts() by the language's parser, and (instance_id, run, compiled) of their first phases.

    Where the first phase didn't compile and the second did, all that passes in the second counts as fixed.
    """
    parsed = logs.get_parser(language)(pieces.select(F.struct("instance_id", "run", "phase").alias("run_id"), "log"))
    rows = parsed.select("run_id.*", "tests", "compiled")
    compiled = rows.groupBy("instance_id", "run").agg(F.bool_or(F.when(F.col("phase") == "PRE", F.col("compiled"))).alias("before"), F.bool_or(F.when(F.col("phase") == "POST", F.col("compiled"))).alias("after"))
    compiled = compiled.select("instance_id", "run", F.coalesce("before", F.lit(False)).alias("compiled"), F.coalesce("after", F.lit(False)).alias("_after"))
    tests = rows.select("instance_id", "run", "phase", F.explode("tests").alias("test_id", "status"))
    was, now = F.max(F.when(F.col("phase") == "PRE", F.col("status"))), F.max(F.when(F.col("phase") == "POST", F.col("status")))
    both = tests.groupBy("instance_id", "run", "test_id").agg(was.alias("was"), now.alias("now")).join(compiled, ["instance_id", "run"])
    passes, rebuilt = F.col("now") == "passed", ~F.col("compiled") & F.col("_after")
    fixed = F.coalesce(passes & (rebuilt | (F.col("was") == "failed")), F.lit(False))
    kept = F.coalesce(passes & ~rebuilt & (F.col("was") == "passed"), F.lit(False))
    name = NAMES.get(language, lambda t: t)(F.col("test_id"))
    found = both.select("instance_id", "run", name.alias("test_id"), fixed.alias("fixed"), kept.alias("kept")).where("test_id is not null and (fixed or kept)")
    return found, compiled.drop("_after")


def quarantined(tests: DataFrame, runs: Column) -> DataFrame:
    """(instance_id, test_id, fixed_runs, kept_runs, class) from rows (instance_id, run, test_id, fixed, kept).

    class: fail_to_pass or pass_to_pass where all runs agree, flaky where some fix it, else null. A test in both classes of all runs counts as fixed.
    """
    bit = F.when(F.col("run").between(1, MOST_RUNS), F.expr("shiftleft(1L, run - 1)"))
    maps = lambda c: F.bit_or(F.when(F.col(c), bit).otherwise(F.lit(0).cast("long")))
    seen = tests.groupBy("instance_id", "test_id").agg(maps("fixed").alias("fixed_runs"), maps("kept").alias("kept_runs"))
    n, m = F.bit_count("fixed_runs"), F.bit_count("kept_runs")
    kind = F.when(n >= runs, "fail_to_pass").when(n > 0, "flaky").when(m >= runs, "pass_to_pass")
    return seen.select("*", kind.alias("class"), (m >= runs).alias("_kept"))


def folded(tests: DataFrame, runs: DataFrame, n_runs: int) -> DataFrame:
    """One result an instance from its tests (instance_id, run, test_id, fixed, kept) and runs (instance_id, run, status, error_message, compiled).

    (instance_id, status, fail_to_pass, pass_to_pass, error_message, compiled, n_runs, flake_count, quarantined_tests).
    The first run with status error gives the whole result. Runs that are missing fix and keep nothing and didn't compile.
    """
    classes = quarantined(tests, F.lit(n_runs))
    of = lambda met: F.array_sort(F.collect_list(F.when(met, F.col("test_id"))))
    lists = classes.groupBy("instance_id").agg(of(F.col("class") == "fail_to_pass").alias("fixed"), of(F.col("_kept")).alias("kept"), of(F.col("class") == "flaky").alias("flaky"))
    broken = F.min(F.when(F.col("status") == "error", F.struct("run", "error_message", "compiled")))
    per = runs.where(F.col("run").between(1, n_runs)).groupBy("instance_id").agg(broken.alias("broken"), F.bool_and("compiled").alias("compiled"), F.count_distinct("run").alias("n"))
    rows, none = per.join(lists, "instance_id", "left"), F.array().cast("array<string>")
    failed, fixed, flaky = F.col("broken").isNotNull(), F.coalesce("fixed", none), F.coalesce("flaky", none)
    return rows.select(
        "instance_id", F.when(failed, "error").when(F.size(fixed) > 0, "valid").otherwise("invalid").alias("status"),
        F.when(failed, none).otherwise(fixed).alias("fail_to_pass"), F.when(failed, none).otherwise(F.coalesce("kept", none)).alias("pass_to_pass"),
        F.when(failed, F.col("broken.error_message")).when((F.size(fixed) == 0) & (F.size(flaky) > 0), ALL_FLAKY_MESSAGE).alias("error_message"),
        F.when(failed, F.col("broken.compiled")).otherwise(F.col("compiled") & (F.col("n") >= n_runs)).alias("compiled"), F.when(failed, 1).otherwise(n_runs).alias("n_runs"),
        F.when(failed, 0).otherwise(F.size(flaky)).alias("flake_count"), F.when(failed, none).otherwise(flaky).alias("quarantined_tests"),
    )


def validated(validation_logs: DataFrame, language: str, n_runs: int = 1, marker: str = "===PHASE===") -> DataFrame:
    """folded() of logs (instance_id, log) of n_runs runs; a log that says so early is an error or invalid as a whole.

    A null log is an empty one: no run compiled. Rows that repeat an instance_id give a result each only where their logs differ in what ended them.
    """
    if not 1 <= n_runs <= MOST_RUNS:
        raise ValueError(f"runs must be 1 to {MOST_RUNS}")
    log = F.coalesce("log", F.lit(""))
    ended = F.when(log.contains(PATCH_FAILED), "error").when(log.contains(NOTHING_FAILED), "invalid")
    marked = validation_logs.select("instance_id", log.alias("log"), ended.alias("ended"))
    none = F.array().cast("array<string>")
    message = F.when(F.col("ended") == "error", PATCH_FAILED_MESSAGE).otherwise(NOTHING_FAILED_MESSAGE)
    early = marked.where("ended is not null").select(
        "instance_id", F.col("ended").alias("status"), none.alias("fail_to_pass"), none.alias("pass_to_pass"), message.alias("error_message"),
        F.lit(True).alias("compiled"), F.lit(1).alias("n_runs"), F.lit(0).alias("flake_count"), none.alias("quarantined_tests"),
    )
    whole = marked.where("ended is null")
    tests, compiled = run_classes(parts(whole, marker).where(F.col("run") <= n_runs), language)
    every = whole.select("instance_id", F.explode(F.sequence(F.lit(1), F.lit(n_runs))).alias("run")).distinct()
    runs = every.join(compiled, ["instance_id", "run"], "left").select("instance_id", "run", F.lit("valid").alias("status"), F.lit(None).cast("string").alias("error_message"), F.coalesce("compiled", F.lit(False)).alias("compiled"))
    return folded(tests, runs, n_runs).unionByName(early)
