"""Logs of several runs, and test code moved out of patches, against worked examples."""

import json
import random

import pytest
from pyspark.sql import functions as F

from auditloom.functions import code
from auditloom.operators import patches, runs

TESTS = "instance_id string, run int, test_id string, fixed boolean, kept boolean"
RUNS = "instance_id string, run int, status string, error_message string, compiled boolean"


def fold(spark, *sides, n=None):
    """sides: (fixed tests, kept tests) of each run, or an error message."""
    tests = [("i", k, t, t in side[0], t in side[1]) for k, side in enumerate(sides, 1) if isinstance(side, tuple) for t in {*side[0], *side[1]}]
    states = [("i", k, "error", side, True) if isinstance(side, str) else ("i", k, "valid", None, len(side) < 3) for k, side in enumerate(sides, 1)]
    return runs.folded(spark.createDataFrame(tests, TESTS), spark.createDataFrame(states, RUNS), n or len(sides)).first()


def test_quarantine_cases(spark):
    stable = fold(spark, (["A"], ["B"]), (["A"], ["B"]), (["A"], ["B"]))
    assert (stable.status, stable.fail_to_pass, stable.pass_to_pass, stable.quarantined_tests, stable.flake_count, stable.n_runs, stable.compiled) == ("valid", ["A"], ["B"], [], 0, 3, True)
    flaky = fold(spark, (["S", "F"], []), (["S"], []), (["S", "F"], []))
    assert (flaky.fail_to_pass, flaky.quarantined_tests, flaky.flake_count, flaky.error_message) == (["S"], ["F"], 1, None)
    none = fold(spark, (["F"], []), ([], []), (["F"], []))
    assert (none.status, none.fail_to_pass, none.flake_count, none.error_message) == ("invalid", [], 1, runs.ALL_FLAKY_MESSAGE)
    many = fold(spark, (["A", "B", "C"], ["P", "Q"]), (["A"], ["P"]), (["A", "B"], ["P"]))
    assert (many.quarantined_tests, many.flake_count, many.pass_to_pass) == (["B", "C"], 2, ["P"])
    assert (fold(spark, "agent exploded").status, fold(spark, (["A"], []), "late", "later").error_message) == ("error", "late")
    two = fold(spark, (["A", "F"], []), (["A"], []))
    assert (two.fail_to_pass, two.quarantined_tests) == (["A"], ["F"])
    assert fold(spark, ([], [])).status == "invalid" and fold(spark, ([], [])).error_message is None
    assert not fold(spark, (["A"], [], "broken"), (["A"], [])).compiled
    short = fold(spark, (["A"], ["B"]), n=2)  # a run that left nothing agrees with nothing
    assert (short.status, short.quarantined_tests, short.pass_to_pass, short.compiled) == ("invalid", ["A"], [], False)


def test_quarantine_against_sets(spark):
    rng = random.Random(7)
    rows, want = [], {}
    for i in range(40):
        n = 5
        fixed, kept = ([{t for t in "abcdefgh" if rng.random() < 0.8} for _ in range(n)] for _ in range(2))
        rows += [(str(i), k + 1, t, t in fixed[k], t in kept[k]) for k in range(n) for t in fixed[k] | kept[k]]
        stable = set.intersection(*fixed)
        want[str(i)] = (sorted(stable), sorted(set.intersection(*kept)), sorted(set.union(*fixed) - stable))
    states = spark.createDataFrame([(str(i), k, "valid", None, True) for i in range(40) for k in range(1, 6)], RUNS)
    got = {r.instance_id: (r.fail_to_pass, r.pass_to_pass, r.quarantined_tests) for r in runs.folded(spark.createDataFrame(rows, TESTS).repartition(3), states, 5).collect()}
    assert got == want


def event(action, test, package="p"):
    return json.dumps({"Action": action, "Package": package} | ({"Test": test} if test else {}))


def go_log(*phases):
    names = [f"##_RUN_{k // 2 + 1}_{'POST' if k % 2 else 'PRE'}" for k in range(len(phases))]
    return "clone\n" + "\n".join(f"{m}\n{p}" for m, p in zip(names, phases, strict=True))


def test_validated_logs(spark):
    before = "\n".join([event("fail", "TestA"), event("pass", "TestB"), event("fail", "TestA/sub"), event("fail", "TestX", "p/e2e/q"), event("skip", "TestS")])
    after = "\n".join([event("pass", "TestA"), event("pass", "TestB"), event("pass", "TestA/sub"), event("pass", "TestX", "p/e2e/q"), event("pass", "TestS")])
    broken = event("fail", None)
    logs = {
        "one": go_log(before, after), "built": go_log(broken, after), "patch": "x\nPATCH_APPLY_FAILED\n", "calm": go_log(before) + "\nNO_FAILING_TESTS", "null": None, "empty": "",
        "none": go_log(after, before), "flat": go_log(before, after).replace("\n##_RUN_1_POST", "##_RUN_1_POST"),
    }
    got = {r.instance_id: r for r in runs.validated(spark.createDataFrame(list(logs.items()), "instance_id string, log string"), "go", 1, "##").collect()}
    assert set(got) == set(logs)
    for name in ("one", "flat"):  # the marker may follow on the line where the output before it ended
        assert (got[name].status, got[name].fail_to_pass, got[name].pass_to_pass, got[name].compiled) == ("valid", ["TestA"], ["TestB"], True)
    assert (got["built"].fail_to_pass, got["built"].pass_to_pass, got["built"].compiled) == (["TestA", "TestB", "TestS"], [], False)
    assert (got["patch"].status, got["patch"].error_message, got["calm"].status, got["calm"].error_message) == ("error", runs.PATCH_FAILED_MESSAGE, "invalid", runs.NOTHING_FAILED_MESSAGE)
    assert all((got[k].status, got[k].compiled) == ("invalid", False) for k in ("null", "empty")) and got["none"].status == "invalid"


def test_validated_runs(spark):
    before, after = event("fail", "TestA") + "\n" + event("fail", "TestF"), event("pass", "TestA") + "\n" + event("pass", "TestF")
    half = event("pass", "TestA") + "\n" + event("fail", "TestF")
    logs = spark.createDataFrame([("i", go_log(before, after, before, half, before, after)), ("k", go_log(before, after, before, after))], "instance_id string, log string")
    got = {r.instance_id: r for r in runs.validated(logs, "go", 3, "##").collect()}
    assert (got["i"].fail_to_pass, got["i"].quarantined_tests, got["i"].n_runs) == (["TestA"], ["TestF"], 3)
    assert (got["k"].fail_to_pass, got["k"].quarantined_tests, got["k"].compiled) == ([], ["TestA", "TestF"], False)
    with pytest.raises(ValueError):
        runs.validated(logs, "go", 64)


def test_pytest_ids(spark):
    log = "t.py::a[x] PASSED [ 1%]\n t.py::b FAILED\nt.py::c d PASSED\nt.py::e \nFAILED\nt.py::a[x] FAILEDx\nx::y::z SKIPPED"
    from auditloom.operators.logs import pytest_verbose

    row = pytest_verbose(spark.createDataFrame([("r", log), ("s", " \n"), ("t", "ok")], "run_id string, log string")).orderBy("run_id").collect()
    assert row[0].tests == {"t.py::a[x]": "failed", "t.py::e": "failed", "x::y::z": "skipped"} and [r.compiled for r in row] == [True, False, True]


SOURCE = "pub fn add(a: i32, b: i32) -> i32 {\n    a + b + 1\n}\n\nfn z() {}\n\n\n#[cfg(test)]\nmod tests {\n    use super::*;\n\n    // existing\n}\n"
GOLD = """diff --git a/src/lib.rs b/src/lib.rs
index 1..2 100644
--- a/src/lib.rs
+++ b/src/lib.rs
@@ -1,3 +1,4 @@ pub fn add
 pub fn add(a: i32, b: i32) -> i32 {
-    a + b + 1
+    // sum
+    a + b
 }
@@ -9,4 +10,8 @@ mod tests
 mod tests {
     use super::*;

+    #[test]
+    fn test_add() {
+        assert_eq!(add(2, 3), 5);
+    }
     // existing
diff --git a/README.md b/README.md
--- a/README.md
+++ b/README.md
@@ -1 +1 @@
-a
+mod tests {
"""


def refined(spark, gold, test=None, source=SOURCE):
    rows = spark.createDataFrame([("i", gold, test)], "instance_id string, gold string, test string")
    sources = spark.createDataFrame([("i", "src/lib.rs", source)], "instance_id string, path string, source string")
    return patches.refined(rows, sources).first()


def test_refined(spark):
    for source in (SOURCE, None):
        got = refined(spark, GOLD, "diff --git a/t b/t", source)
        assert got.n_moved == 1 and "test_add" not in got.gold and "a + b\n" in got.gold and got.gold.endswith("-a\n+mod tests {\n")
        assert got.test.startswith("diff --git a/t b/t\ndiff --git a/src/lib.rs b/src/lib.rs\n--- a/src/lib.rs\n+++ b/src/lib.rs\n@@ -9,4 +9,8 @@ mod tests\n")  # one line less than with the hunk before
        df = spark.createDataFrame([(SOURCE, GOLD, got.gold, got.test, "src/lib.rs")], "s string, whole string, gold string, test string, p string")
        row = df.select(code.applied("s", "whole", "p").alias("a"), code.applied("s", F.concat("gold", "test"), "p").alias("b"), code.applied(F.lit("other"), "whole", "p").alias("c")).first()
        assert row.a == row.b and "test_add" in row.a and row.c is None


def test_refined_edges(spark):
    first = "\n".join(GOLD.split("\n")[:9]) + "\n"
    assert refined(spark, first) == (("i", first.replace("index 1..2 100644\n", "").replace("+1,4", "+1,4"), None, 0))
    for gold in (None, "", " \n", "no diff"):
        got = refined(spark, gold, "t")
        assert (got.gold, got.test, got.n_moved) == (gold, "t", 0)
    moved = "diff --git a/src/lib.rs b/src/lib.rs\n--- a/src/lib.rs\n+++ b/src/lib.rs\n@@ -10,1 +10,2 @@\n     use super::*;\n+    x\n"
    got = refined(spark, moved)
    assert got.gold is None and got.test == moved and got.n_moved == 1
    cross = moved.replace("@@ -10,1 +10,2 @@\n", "@@ -7,2 +7,3 @@\n")
    assert refined(spark, cross).n_moved == 0
    added = moved.replace("@@ -10,1 +10,2 @@\n     use super::*;\n", "@@ -10,0 +11,1 @@\n")
    assert refined(spark, added).n_moved == 0  # a hunk without old lines stays


def test_refined_of_several_files(spark):
    one = "diff --git a/{0} b/{0}\n--- a/{0}\n+++ b/{0}\n@@ -10,1 +10,2 @@\n     use super::*;\n+    x\n"
    rows = spark.createDataFrame([("i", one.format("a.rs") + one.format("b.rs") + one.format("c.py"), None), ("j", one.format("b.rs"), "t")], "instance_id string, gold string, test string")
    sources = spark.createDataFrame([("i", "a.rs", SOURCE), ("i", "b.rs", "x\n" * 20), ("i", "c.py", SOURCE), ("k", "b.rs", SOURCE)], "instance_id string, path string, source string")
    got = {r.instance_id: r for r in patches.refined(rows, sources).collect()}
    assert (got["i"].gold, got["i"].test, got["i"].n_moved) == (one.format("b.rs") + one.format("c.py"), one.format("a.rs"), 1)
    assert (got["j"].gold, got["j"].test, got["j"].n_moved) == (one.format("b.rs"), "t", 0)


def test_moved_hunks_makes_each_diff_once(spark):
    from auditloom import catalog

    plan = catalog.QUERIES["moved_hunks"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("unified_diff(") == 1 and "Exchange" not in plan


def test_regions_merge(spark):
    df = spark.createDataFrame([([(5, 9), (1, 4), (20, 30), (25, 27)],), ([],), (None,)], "r array<struct<start:int,end:int>>")
    assert [None if r.m is None else [tuple(x) for x in r.m] for r in df.select(patches.merged(F.col("r")).alias("m")).collect()] == [[(1, 9), (20, 30)], [], None]


def test_test_regions(spark):
    text = "line1\nline2\n#[cfg(test)]\nmod t {\n  fn f() {}\n}\nline7\n#[cfg(test)]\nfn alone() {}\n#[cfg(test)]\n#[allow(x)]\npub mod u {\n}"
    rows = spark.createDataFrame([(text,), ("",), (None,)], "s string").select(code.rust_test_regions("s").alias("r")).collect()
    assert [[tuple(x) for x in r.r] for r in rows] == [[(3, 6), (10, 13)], [], []]


def test_resolved_by_log(spark):
    from auditloom.operators import verdicts

    rows = [
        ("python", "t.py::a[x] PASSED [ 1%]\nPASSED t.py::b", ["a[x]", "t.py::b"], ["c"], True), ("python", "t.py::ab PASSED", ["t.py::a"], [], True), ("python", "t.py::a PASSED", [], [], False), ("python", "t.py::a PASSED", [""], None, False),
        ("python", "t.py::a PASSED\nt.py::b FAILED", ["a"], ["b"], False), ("python", "PASSED", ["PASSED"], [], False), ("python", None, ["a"], [], False),
        ("rust", "test m::a ... ok", ["m::a"], ["b"], True), ("rust", "test m::ab ... ok", ["m::a"], [], False), ("rust", "test a ... ok\nerror[E0432]: x", ["a"], [], False), ("rust", "test a ... ok\ntest b ... FAILED", ["a"], ["b"], False), ("rust", " test a ... ok", ["a"], [], False),
    ]
    df = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(rows)], "i int, log string, f array<string>, k array<string>, want boolean")
    for language in ("python", "rust"):
        got = {r.i: r.ok for r in df.select("i", verdicts.resolved_by_log(F.col("log"), F.col("f"), F.col("k"), language).alias("ok")).collect()}
        assert [got[i] for i, r in enumerate(rows) if r[0] == language] == [r[4] for r in rows if r[0] == language]
