"""Instance assembly, message extraction and commands against worked examples."""

import pytest
from pyspark.sql import functions as F

from auditloom.functions import messages
from auditloom.operators import assembly


def one(spark, make, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} {'array<string>' if isinstance(v, list) else 'boolean' if isinstance(v, bool) else 'int' if isinstance(v, int) else 'string'}" for i, v in enumerate(values)))
    return df.select(make(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("make", "values", "want"),
    [
        (messages.go_message, ("a\n  got 3, want 4\nb",), "got 3, want 4"), (messages.go_message, ("Error:   no file\n",), "no file"), (messages.go_message, (None,), None),
        (messages.python_message, ("E   assert 1 == 2",), ("1 == 2", None)), (messages.python_message, ("FAILED t.py::a - ValueError: x",), (None, "ValueError: x")),
        (messages.loose_pytest, ("t.py::a PASSED [1%]\nFAILED t.py::b - boom\nx",), (["t.py::a"], ["t.py::b"])),
        (messages.test_files, ("x_test.go:5: a\ny a_test.go:1",), ["a_test.go", "x_test.go"]), (messages.test_names, ("--- FAIL: TestB (0s)\n    --- PASS: TestA/x",), ["TestA", "TestB"]),
        (messages.go_command, (["./b", "./a", "./b"], ["T"]), "go test -v -count=1 -timeout 300s ./a ./b -run '^T$'"), (messages.go_command, ([], []), None),
        (messages.verbose_pytest, ("python -m pytest pytest_x",), "python -m pytest -v pytest_x"), (messages.verbose_pytest, ("tox",), "tox -v"),
        (messages.test_command, ("python", "a.py", "tox"), "tox -v a.py"), (messages.test_command, ("c", "", ""), "echo 'Unsupported language'"),
        (messages.go_patch_command, ("diff --git a/srv/etcd/x_test.go b/srv/etcd/x_test.go\ndiff --git a/m_test.go b/m_test.go\ndiff --git a/srv/y.go b/srv/y.go",), "(cd srv && go test -v -count=1 ./etcd ./...) ; go test -v -count=1 ./..."),
        (messages.go_imports, ('package a\nimport (\n"x"\n)\nfunc',), 'import (\n"x"\n)\n'), (messages.python_imports, ("# c\nimport a\n\nfrom b import c\nx = 1\nimport d\n",), "# c\nimport a\n\nfrom b import c\n"), (messages.python_imports, ("x = 1\ny = 2\n",), ""),
        (messages.issue_titles, (["Fixes #12: a title long enough", "fix #3 short", "other"],), ["a title long enough"]),
        (lambda a, b: messages.aligned(a, b, ("rat check",)), ("RAT Check failed", "x = 1"), False), (lambda a, b: messages.aligned(a, b, ("rat check",)), ("rat check", "+ Copyright"), True),
        (messages.meaningful_test, ("assert f(1) == 2",), True), (messages.meaningful_test, ("assert True",), False), (messages.rust_tests_only, (" #[cfg(test)]\nmod",), True),
        (lambda c: messages.scored_code(c, ("None",), (r"\bfor\b",)), ("for x in y:\n return 1\n return 2\n return None",), 5),
        (lambda a, b: messages.described_change(a, b, ((" < ", " <= "),)), ("a < b", "a <= b"), "Changed '<' to '<=' in computation, producing wrong results for certain inputs"), (lambda a, b: messages.described_change(a, b, ()), ("if not a:", "if a:"), "Removed negation from condition, skipping important validation"),
        (lambda c: messages.without_labels(c, (r"(?m)^# STRATEGY.*$",)), ("a\n\n# STRATEGY 1\n\nb",), "a\n\nb"),
        (lambda a, b: messages.real_references(a, b), ("see :func:`f` and :ref:`gone`", ["f"]), "see :func:`f` and gone"), (lambda c: messages.opened(c, {"I noticed": "Found"}), ("  I noticed it",), "  Found it"),
        (assembly.version_label, ("1.2", "abcdefghijklm"), "1.2-abcdefgh"), (assembly.version_label, (None, "abcdefghijklm"), "unknown"), (assembly.version_label, ("1.2", None), "1.2"), (assembly.registry_version, (None, None, "abcdefghijklm"), "abcdefghijkl"),
        (assembly.registry_version, (None, "1.2", "abcdefghijklm"), "1.2-abcdefgh"), (assembly.registry_version, ("v9", "1.2", "abcdefghijklm"), "v9"), (assembly.listed, (["a", 'b "é"'],), '["a", "b \\"\\u00e9\\""]'), (assembly.listed, ([],), "[]"),
        (assembly.model_key, ("a", "vertex_ai/m"), "a__m"), (assembly.model_key, ("a", None), "a__adhoc"), (lambda c: assembly.task_parts(c, "p/"), ("p/go__o__r-1",), ("go", "o__r-1")), (lambda c: assembly.task_parts(c, "p/"), ("x",), ("unknown", "x")),
        (assembly.language_of_tests, (["TestA"],), "go"), (assembly.language_of_tests, (["a::b", "TestA"],), "python"), (assembly.language_of_tests, ([],), "python"), (assembly.well_formed, ("o/r", "abcdef1"), True), (assembly.well_formed, ("o", "abcdef1"), False),
        (assembly.issue_numbers, ("fix #3", "see #10, #3"), [3, 10]), (assembly.viability, (True, 30, "pass", 5), "Viable"), (assembly.viability, (True, 30, "timeout", 5), "Slow"), (assembly.viability, (False, 30, "pass", 5), "Broken"),
        (lambda c: assembly.shortened_tests(c, 2), (["a", "b", "c"],), '["a","b"]'), (lambda a, b: assembly.spec_score([a, b]), (True, False), 0.5),
    ],
)
def test_expression(spark, make, values, want):
    got = one(spark, make, *values)
    assert (tuple(got) if isinstance(got, tuple) else got) == want


def test_instances(spark):
    candidates = spark.createDataFrame([("a", "p1"), ("b", "p2"), ("c", "p3")], "instance_id string, patch string")
    results = spark.createDataFrame([("a", "valid", "[]", "[]", "1"), ("b", "invalid", "[]", "[]", "1"), ("c", "valid", "[]", "[]", "9")], "instance_id string, status string, FAIL_TO_PASS string, PASS_TO_PASS string, version string")
    specs = spark.createDataFrame([("1", "h2"), ("2", "h1")], "version string, env_spec_hash string")
    got = {r["instance_id"]: r["env_spec_hash"] for r in assembly.instances(candidates, results, specs).collect()}
    assert got == {"a": "h2", "c": "h1"}
    assert {r["instance_id"]: r["env_spec_hash"] for r in assembly.instances(candidates, results, specs.limit(0)).collect()} == {"a": None, "c": None}


def test_task_instances(spark):
    from auditloom.sources import jsonl

    base = dict.fromkeys(jsonl.CANDIDATE.names)
    patch = "diff --git a/x.py b/x.py\n+a\ndiff --git a/y.py b/y.py\n-b\n"
    rows = [base | {"instance_id": i, "repo": r, "patch": p, "merged_at": m} for i, r, p, m in (("a", "o/r", patch, "2024"), ("b", "o/r", None, ""), ("c", "o/s", patch, None), ("d", "o/r", "", None))]
    candidates = spark.createDataFrame([tuple(x[n] for n in jsonl.CANDIDATE.names) for x in rows], jsonl.CANDIDATE)
    results = spark.createDataFrame([("a", "valid", ["t", "u"], ["v"], 3, 1, ["q"], "h2"), ("b", "valid", None, None, None, None, None, None), ("c", "invalid", [], [], 1, 0, [], "h1"), ("d", "valid", ["t"], [], 1, 0, [], "gone")], "instance_id string, status string, fail_to_pass array<string>, pass_to_pass array<string>, n_runs int, flake_count int, quarantined_tests array<string>, spec string")
    specs = spark.createDataFrame([("h2", "go", "1.22"), ("h1", "python", None)], "env_spec_hash string, language string, language_version string")
    products = spark.createDataFrame([("o/r", "P")], "repo string, product string")
    df = assembly.task_instances(candidates, results, specs, products)
    assert set(df.columns) == set(jsonl.TASK.names) - {"language"}
    got = {r.instance_id: r for r in df.collect()}
    assert set(got) == {"a", "b", "d"}
    a, b, d = got["a"], got["b"], got["d"]
    assert (a.version, a.FAIL_TO_PASS, a.PASS_TO_PASS, a.n_fail_to_pass, a.patch_lines, a.files_touched, a.cross_file, a.repo_language, a.product) == ("1.22-h2", '["t", "u"]', '["v"]', 2, 4, 2, True, "go", "P")
    assert (a.n_runs, a.flake_count, a.quarantined_tests, a.fix_merge_date, a.provenance, a.env_spec_hash) == (3, 1, ["q"], "2024", "public_upstream", "h2")
    assert (b.version, b.FAIL_TO_PASS, b.n_fail_to_pass, b.patch, b.patch_lines, b.files_touched, b.env_spec_hash, b.repo_language, b.n_runs, b.fix_merge_date) == ("unknown", "[]", 0, "", 0, 0, "h1", "python", 1, None)
    assert d.env_spec_hash == "h1" and d.cross_file is False
    assert assembly.task_instances(candidates, results, specs.limit(0)).where("instance_id = 'a'").first().version == "unknown"


def test_folded_status(spark):
    lines = ["--- PASS: A (0s)", "--- FAIL: A/x (0s)", "  --- SKIP: B", "--- PASS: B", "--- SKIP: C", "FAIL: D 1", "ok"]
    df = spark.createDataFrame([(1, x) for x in lines], "run int, line string")
    assert {r["test"]: r["status"] for r in assembly.folded_status(df, ["run"]).collect()} == {"A": "failed", "B": "passed", "C": "skipped", "D": "failed"}


def test_frames_and_relations(spark):
    lines = spark.createDataFrame([(1, i, x) for i, x in enumerate(["x := f()", "y", "check(x)", "with raises:", "", "call()"])], "f int, n int, line string")
    assert assembly.assigned_before(lines, ["f"], "n", F.col("line").startswith("check"), F.col("line").contains(":=")).first()["assigned"] == "x := f()"
    assert assembly.call_after(lines, ["f"], "n", F.col("line").startswith("with"), F.col("line").contains("(")).first()["call"] == "call()"
    functions = spark.createDataFrame([("p", "a.go", "run"), ("p", "a.go", "gone")], "package string, file string, name string")
    sources = spark.createDataFrame([("p", "a.go", "run()"), ("p", "c.go", "x.run()"), ("p", "b.go", "runs run"), ("q", "a0.go", "run")], "package string, file string, text string")
    assert [tuple(r) for r in assembly.callers(functions, sources, 9).select("name", "caller").collect()] == [("run", "b.go")]
    asserted = spark.createDataFrame([(1, "f", "g(1)"), (2, None, "x.f == 2"), (3, "h", "ff")], "assertion_id int, called_function string, expression string")
    assert {tuple(r) for r in assembly.relevant_assertions(asserted, spark.createDataFrame([("f",)], "target string")).collect()} == {(1, "f"), (2, "f")}
    issues = spark.createDataFrame([(1, 2, "t2", None), (1, 1, "t1", "b1")], "pr int, nth int, title string, body string")
    assert assembly.statement(issues, "pr", "nth").first()["problem_statement"] == "t1\nb1\n\nt2\n"


def test_strict_read_raises_whatever_is_read(spark, tmp_path):
    from auditloom.sources import jsonl

    path = tmp_path / "x.jsonl"
    path.write_text('{"instance_id": "a", "resolved": true, "unknown": 1}\n')
    with pytest.raises(Exception, match="unknown"):
        jsonl.read_strict(spark, str(path), jsonl.EVAL).count()


def test_spec_hashes_as_canonical_ascii_json(spark):
    import hashlib
    import json

    from auditloom.sources import jsonl

    made = [{"language": "python", "language_version": "3.9", "install_cmd": "pip install é😀", "pip_packages": ["b", "a"]}, {"go_version": "1.21", "build_cmd": "go build"}, {"language": "rust", "rust_version": "1.7", "workspace_members": ["z", "y"]}, {"language": "java", "language_version": "17"}]
    rows = spark.createDataFrame([tuple(m.get(f.name) for f in jsonl.SPEC) for m in made], jsonl.SPEC)
    got = [r["h"] for r in rows.select(jsonl.env_spec_hash().alias("h")).collect()]
    for m, h in zip(made, got, strict=True):
        language = m.get("language", "go")
        fields = {n: sorted(m.get(n, [])) if n in ("pre_install", "pip_packages", "system_dependencies", "workspace_members") else m.get(n, "") for n in jsonl.HASHED[language]} | {"language": language}
        assert h == hashlib.sha256(json.dumps(fields, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def test_shingles_are_of_word_signs(spark):
    from auditloom.functions import text

    df = spark.createDataFrame([("Foo, bar-baz; été", "foo bar baz été", "a b")], "a string, b string, c string")
    assert tuple(df.select(text.trigram_jaccard(F.col("a"), F.col("b")), text.trigram_jaccard(F.col("a"), F.col("c"))).first()) == (1.0, 0.0)
