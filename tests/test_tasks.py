"""Task folders, instance checks, module sets and related files against worked examples."""

import json

from pyspark.sql import functions as F

from auditloom.operators import tasks


def test_dashboard_and_files(spark):
    schema = "instance_id string, repo string, repo_language string, patch_lines int, files_touched int, cross_file boolean, n_fail_to_pass int, FAIL_TO_PASS string, fix_merge_date string, patch string"
    rows = spark.createDataFrame([("o__r-12", "o/r", None, None, 2, None, None, '["a","b"]', None, None), ("x", "o/r", "go", 3, None, True, 7, "broken", "d", "p")], schema)
    assert [tuple(r) for r in tasks.dashboard_rows(rows).collect()] == [("o__r-12", "o/r", "unknown", 0, 2, False, 2, "https://github.com/o/r/issues/12", None, ""), ("x", "o/r", "go", 3, 0, True, 7, "", "d", "p")]
    files = spark.createDataFrame([("t1", "b", "second"), ("t1", "a", ""), ("t2", "b", "y"), ("t2", "a", "x")], "key string, path string, content string")
    keys = spark.createDataFrame([("t1",), ("t2",), ("t3",)], "key string")
    assert {tuple(r) for r in tasks.first_file(keys, files, "key", ["a", "b"]).collect()} == {("t1", "second"), ("t2", "x"), ("t3", None)}


def test_task_errors(spark):
    expected = ("task.toml", "tests/test.sh", "solution/solve.sh", "environment/Dockerfile", "tests/config.json", "tests/test.patch")
    good = ("[task]\nname = 1", "#!/bin/sh\npytest > /logs/verifier/reward.txt", "git apply x", "FROM Python:3", '{"FAIL_TO_PASS": [], "PASS_TO_PASS": []}', "diff")
    bad = ("x = 1", "go", "patch", "FROM alpine", '{"a": 1}', " \n")
    names = [f"f{i}" for i in range(6)]
    df = spark.createDataFrame([(0, *good, True, True, "python"), (1, *bad, False, False, "go"), (2, *[None] * 6, None, None, "go"), (3, *good[:4], "{", "diff", True, True, "java")], ", ".join(["i int", *[f"{n} string" for n in names], "r1 boolean, r2 boolean, language string"]))
    errors = tasks.task_errors(dict(zip(expected, map(F.col, names), strict=True)), {"tests/test.sh": F.col("r1"), "solution/solve.sh": F.col("r2")}, F.col("language"), expected)
    got = {r["i"]: r["e"] for r in df.select("i", errors.alias("e")).collect()}
    assert got[0] == [] and got[2] == [f"MISSING: {p}" for p in expected] and got[3] == ["config.json: INVALID JSON"]
    assert [e.split(":")[0] for e in got[1]] == ["task.toml", *["test.sh"] * 4, *["solve.sh"] * 2, "Dockerfile", *["config.json"] * 2, "test.patch"]


def test_instance_checks(spark):
    whole = {n: "x" for n in tasks.REQUIRED} | {"FAIL_TO_PASS": '["a"]'}
    values = [whole, whole | {"FAIL_TO_PASS": "[]"}, {k: v for k, v in whole.items() if k != "version"}, whole | {"FAIL_TO_PASS": "no"}]
    rows = spark.createDataFrame([(json.dumps(v),) for v in values], "value string")
    assert tuple(tasks.schema_valid(rows).first()) == (4, 1) and tuple(tasks.schema_valid(rows.limit(0)).first()) == (0, 0)
    schema = "instance_id string, FAIL_TO_PASS string"
    first = spark.createDataFrame([("a", '["x","y"]'), ("b", '["x"]'), ("c", None)], schema)
    second = spark.createDataFrame([("a", '["y","x","x"]'), ("b", "[]"), ("d", "[]")], schema)
    assert tuple(tasks.stability(first, second).first()) == (3, 3, 2, 1)


def test_counts_and_summaries(spark):
    candidates = spark.createDataFrame([("a", "1.0"), ("b", None)], "instance_id string, snapped string")
    results = spark.createDataFrame([("a", "o/r", "valid"), ("b", "o/r", "valid"), ("c", "o/r", "valid"), ("d", "o/r", "invalid")], "instance_id string, repo string, status string")
    assert [tuple(r) for r in tasks.compatible_counts(candidates, results).collect()] == [("o/r", 3, 1, 1)]
    patches = spark.createDataFrame([("a", "p", "t"), ("b", "", "t"), ("c", "p", None), ("d", "p", "u")], "instance_id string, patch string, test_patch string")
    assert [r["instance_id"] for r in tasks.with_unit_tests(patches, F.col("test_patch") == "t").collect()] == ["a"]
    scores = spark.createDataFrame([("o/r", "1", 1, "python", False, "3 or 4"), ("o/r", "1", 0, "install", True, "same"), ("o/r", "1", 2, "x", None, None)], "repo string, version string, nth int, field string, match boolean, detail string")
    got = tasks.spec_summaries(scores).first()
    assert (got["matched"], got["total"], got["summary"]) == (1, 3, "o/r v1: 33% (1/3 fields)\n  [MATCH] install: same\n  [MISS] python: 3 or 4\n  [MISS] x: ")


FILES = {
    "src/app/core.py": "import app.util\nfrom app import x\nimport os\ndef run(): pass", "src/app/util.py": "u = 1\n", "src/app/__init__.py": "", "src/app/use.py": "# run\nfrom app.core import run\nrun()", "src/app/zed.py": "rerun = run", "src/app/no.py": "runs = 1",
    "tests/test_core.py": "import app.core\n\n# run\ndef test(): run()", "tests/deep/test_other.py": "import capp.core2", "vendor/v.py": "run", "examples/e.py": "run",
}


def test_modules_and_related_files(spark):
    files = spark.createDataFrame([("r", p, c) for p, c in FILES.items()] + [("q", "a.py", "run")], "repo string, path string, content string")
    modules = {r["module"] for r in tasks.repo_modules(files).collect() if r["repo"] == "r"}
    assert {"app", "app.core", "app.use", "src", "src.app", "src.app.util", "tests", "tests.test_core"} <= modules and not any("vendor" in m or "example" in m or "__init__" in m for m in modules)
    targets = spark.createDataFrame([(1, "r", "src/app/core.py", "run"), (2, "q", "a.py", "run")], "target_id int, repo string, file string, function_name string")
    got = tasks.related_files(targets, files, 9).orderBy("target_id", "nth").collect()
    assert [(r["target_id"], r["file"], r["line"]) for r in got] == [(1, "src/app/util.py", 0), (1, "tests/deep/test_other.py", 0), (1, "tests/test_core.py", 3), (1, "src/app/no.py", 0), (1, "src/app/use.py", 1), (1, "src/app/zed.py", 0)]
    assert got[2]["snippet"] == FILES["tests/test_core.py"]
    assert [r["file"] for r in tasks.related_files(targets, files, 1).collect()] == ["src/app/util.py"]
