"""Column expressions, one row a case."""

import pytest
from pyspark.sql import functions as F

from auditloom.functions import assertions, code, diff, text
from auditloom.operators import filters, samples, verdicts

PATCH = """diff --git a/pkg/core.py b/pkg/core.py
--- a/pkg/core.py
+++ b/pkg/core.py
@@ -1,2 +1,3 @@
 import os
+def added(x):
-def removed(x):
+    return x  
diff --git a/tests/test_core.py b/tests/test_core.py
--- a/tests/test_core.py
+++ b/tests/test_core.py
@@ -5 +5,2 @@
+def test_added():
+    assert added(1) == 1"""
GO = "diff --git a/srv/a.go b/srv/a.go\n--- a/srv/a.go\n+++ b/srv/a.go\n@@ -1 +1,2 @@\n+func (s *Srv) Open(x int) {\n+type Config struct {\n-func Close() {\ndiff --git a/srv/a_test.go b/srv/a_test.go\n@@ -1 +1 @@\n+x"


def value(spark, column, **cells):
    row = {"x": None, **cells}
    kinds = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in row.items())
    out = spark.createDataFrame([tuple(row.values())], kinds).select(column.alias("v")).first()["v"]
    return out.asDict(recursive=True) if hasattr(out, "asDict") else out


def given(spark, function, cell):
    return value(spark, function(F.col("x")), x=cell)


@pytest.mark.parametrize(
    ("function", "cell", "want"),
    [
        (text.line_count, "a\nb\n", 2), (text.line_count, "", 0), (text.line_count, None, 0), (text.line_count, "a\n\n", 2), (text.word_count, "  a b\t", 2), (text.word_count, " ", 0),
        (text.has_url, "see http://x.y/z", True), (text.has_sha, "at deadbeef1", True), (text.has_sha, "xdeadbeef1", False), (text.image_only, "![a](b) ", True), (text.image_only, "![a](b) c", False),
        (text.numbers_after, "Fixes #12, closes 3 and fixed #12; see #9", [3, 12]), (text.project_keys, "STOR-5 OCPBUGS-12 STOR-5 XX-1", ["OCPBUGS-12", "STOR-5"]),
        (text.link_confidence, "Closes #4", 1.0), (text.link_confidence, "x\nBug-Url: y", 0.95), (text.link_confidence, "rhbz#77", 0.9), (text.link_confidence, "MGMT-3", 0.7),
        (text.link_confidence, "Change-Id: Iabc", 0.5), (text.link_confidence, "", 0.0), (text.link_confidence, None, 0.0),
        (text.shingles, "A b c d", ["a b c", "b c d"]), (text.shingles, "a b", []), (text.go_test_name, "go.etcd.io/etcd/server.TestFoo/case1", "TestFoo"), (text.go_test_name, "TestBaz", "TestBaz"),
        (text.go_tests, ["x/e2e/a.TestA", "p.TestB/c", "q.TestB", "p.ExampleA"], ["ExampleA", "TestB"]), (text.decoded_list, '["a","b"]', ["a", "b"]), (text.decoded_list, "no", []),
        (text.python_version, "3.11.4", "3.11"), (text.python_version, "3", "3"), (text.major_minor, "v1.2.3", "1.2"), (text.clamp_version, "3.8", "3.11"), (text.clamp_version, "3.10", "3.10"),
        (text.clamp_version, "x", "3.11"), (text.install_command, " pip  install -e . ", "python -m pip install -e ."), (text.install_command, "python -m pip install x", "python -m pip install x"),
        (text.test_runner, "python -m pytest x", "pytest"), (text.test_runner, "tox -e x", "tox"), (text.test_runner, "make test", "make"), (text.test_runner, None, None),
        (text.package_names, ["A-b==1", "c>=2", " "], ["a_b", "c"]), (text.failed_names, "FAILED a::b x\nFAILED a::b\nFAILED c::d", ["a::b", "c::d"]), (text.first_failure, "ok\n--- FAIL: TestX (0.1s)", "TestX"),
        (text.code_block, "x\n```py\na\nb\n```\n", "a\nb\n"), (text.narrative, "A ```B``` C", "a  c"), (text.first_line, "\n  \n hello \nx", "hello"), (text.slug, "A/b C!", "a-b-c"), (text.number_of_id, "o__r-12", 12),
        (text.module_name, "a/b/__init__.py", "a.b"), (assertions.called, "len(x) + foo.bar(y)", "bar"), (text.identifier_like, "fooBar", True), (text.identifier_like, "word", False), (text.without_shas, "a deadbeef b", "a  b"),
        (diff.changed_lines, PATCH, 5), (diff.files, PATCH, ["pkg/core.py", "tests/test_core.py"]), (diff.new_python_symbols, PATCH, ["added", "test_added"]), (diff.new_go_symbols, GO, ["Open", "Config"]),
        (diff.is_test_file, "a/testdata/x", True), (diff.is_test_file, "src/foo_test.rs", True), (diff.is_test_file, "a/contest.py", False), (diff.go_scope, GO, "./srv"), (diff.python_scope, PATCH, "tests/test_core.py"),
        (diff.java_scope, "diff --git a/src/test/java/ATest.java b/src/test/java/ATest.java\n", "-Dtest=ATest"), (diff.summary, PATCH, "2 files, +4 -1: pkg/core.py, tests/test_core.py"),
    ],
)
def test_expression(spark, function, cell, want):
    assert given(spark, function, cell) == want


def test_structures(spark):
    parts = given(spark, diff.split_patch, PATCH)
    assert parts["gold"].startswith("diff --git a/pkg") and parts["test"].startswith("diff --git a/tests")
    assert given(spark, diff.split_patch, " ") == {"gold": None, "test": None} and given(spark, diff.split_patch, "raw") == {"gold": "raw", "test": None}
    same = PATCH.replace("pkg/core.py", "lib/other.py").replace("return x  ", "return x")
    assert given(spark, diff.patch_hash, PATCH) == given(spark, diff.patch_hash, same)
    verdict = given(spark, text.judge_verdict, "<classification>synthetic</classification><reasoning>because</reasoning>")
    assert verdict == {"classification": "SYNTHETIC", "confidence": "UNKNOWN", "reasoning": "because"}
    blocks = value(spark, text.repeated_blocks(F.col("x"), ("file", "line")), x="<file>a</file><line>1</line><file>b</file><line>2</line>")
    assert [b.asDict() for b in blocks] == [{"file": "a", "line": "1"}, {"file": "b", "line": "2"}]
    assert value(spark, text.last_block(F.col("x"), "p"), x="<p>1</p> <p>2</p>") == "2"
    hunks = given(spark, lambda c: diff.hunks(diff.sections(c)[0]), PATCH)
    assert (hunks[0]["start"], hunks[0]["count"], len(hunks[0]["lines"])) == (1, 3, 4)
    assert value(spark, text.seconds_between(F.col("x"), F.col("y")), x="2024-01-01T00:00:00Z", y="2024-01-01T00:01:01.250Z") == 61.3
    assert value(spark, text.seconds_between(F.col("x"), F.col("y")), x="soon", y="2024-01-01") is None
    assert value(spark, text.templated(F.col("x"), {"a": F.lit("1"), "ab": F.lit("2")}), x="$a ${ab} $ab $c") == "1 2 2 $c"
    kinds = [a["type"] for a in given(spark, assertions.python_assertions, "assert f(x) == 3\nx = 1\nassert not y\nself.assertTrue(z)\nassert a is None")]
    assert kinds == ["equality", "falsy", "truthy", "is_none"]
    assert value(spark, samples.latest_version(F.col("x")), x=["v1.9", "v1.10.1", "new", "1.2"]) == "v1.10.1"
    assert value(spark, text.trigram_jaccard(F.col("x"), F.col("y")), x="a b c d", y="a b c e") == pytest.approx(1 / 3)
    assert value(spark, diff.version_of({"pyproject": F.col("x"), "go.mod": F.col("y")}), x="[project]\nname='a'\nversion = \"1.4\"", y="go 1.22") == "1.4"
    assert value(spark, filters.leaks_identifier(F.col("x"), F.col("y")), x="the Foo ```bar```", y="foo") and not value(spark, filters.leaks_identifier(F.col("x"), F.col("y")), x="the ```bar```", y="bar")


def test_fisher(spark):
    rows = [(3, 1, 1, 3, 0.485714), (8, 2, 1, 5, 0.034965), (0, 0, 0, 0, 1.0), (10, 0, 0, 10, 1.1e-05)]
    df = spark.createDataFrame(rows, "a long, b long, c long, d long, want double")
    for r in df.withColumn("p", verdicts.fishers_exact(*[F.col(c) for c in "abcd"])).collect():
        assert r["p"] == pytest.approx(r["want"], rel=2e-2)


def test_code(spark):
    source = "def f(a):\n    return 1\n\nclass A:\n    def g(self):\n        pass\n"
    go = 'func (s *S) Run() {\n\tx := "}"\n\tif a { // }\n\t}\n}\nfunc B() {}\n'
    df = spark.createDataFrame([(source, "python"), (go, "go"), (None, "go"), ("x(", "python")], "s string, l string")
    got = [[(f["name"], f["start"], f["end"]) for f in r["f"]] for r in df.select(code.functions_of("s", "l").alias("f")).collect()]
    assert got == [[("f", 1, 2), ("g", 5, 6)], [("Run", 1, 5), ("B", 6, 6)], [], []]
    rust = "fn a() {}\n#[cfg(test)]\nmod tests {\n    fn t() { }\n}\nfn b() {}\n"
    two = spark.createDataFrame([(rust, "x = 1  # c", "x=1", "a\nb\n", "a\nc\n")], "r string, p string, q string, t string, u string")
    r = two.select(code.rust_test_regions("r").alias("r"), code.equivalent("p", "q", F.lit("python")).alias("e"), code.parses("p").alias("ok"), code.unified_diff("t", "u", F.lit("f")).alias("d"), code.found_at("r", F.lit("mod tests {\n  fn t() { }")).alias("at")).first()
    assert [(x["start"], x["end"]) for x in r["r"]] == [(2, 5)] and r["e"] and r["ok"] and r["at"] == 3
    assert r["d"].startswith("diff --git a/f b/f\n--- a/f\n+++ b/f\n@@") and "-b\n+c\n" in r["d"]


def test_spans_of_tests(spark):
    source = "class T:\n    def test_a(self):\n        try:\n            pass\n        except E:\n            def test_b(): pass\n        else:\n            async def test_c():\n                pass\nfor x in y:\n    match x:\n        case 1:\n            def test_d(): pass\nwhile z: pass\nelse:\n    with q:\n        def test_e(): return lambda: 1\n"
    rows = [(0, source, "python"), (1, None, "go"), (2, "def test_x(:", "python"), *((i, "#[test]\nfn a() {\n}\n", "rust") for i in range(3, 90))]
    df = spark.createDataFrame(rows, "i int, s string, l string").coalesce(1)
    got = {r.i: r for r in df.select("i", code.tests_of("s", "l").alias("t"), code.test_spans("s", "l").alias("p")).collect()}
    assert [(t.name, t.start_line, t.end_line) for t in got[0].p] == [("test_a", 1, 9), ("test_b", 5, 6), ("test_c", 7, 9), ("test_d", 12, 13), ("test_e", 16, 17)]
    assert got[0].t[1].source == "            def test_b(): pass\n" and got[1].p == got[2].p == got[1].t == []
    assert all([tuple(t) for t in got[i].t] == [("a", "#[test]\nfn a() {\n}\n", 0, 3)] and [tuple(t) for t in got[i].p] == [("a", 0, 3)] for i in range(3, 90))


def test_extracted_tests_looks_once_and_leaves_sources(spark):
    from auditloom import catalog

    plan = catalog.QUERIES["extracted_tests"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") <= 4 and "tests_of(" not in plan
