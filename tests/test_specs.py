"""Spec comparators and small projections against worked examples."""

import pytest
from pyspark.sql import functions as F

from auditloom.operators import filters, reports, specs, tasks


def one(spark, make, kinds, *values):
    schema = ", ".join(f"c{i} {k}" for i, k in enumerate(kinds))
    return spark.createDataFrame([values], schema).select(make(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first().x


LIST = "array<string>"
FIELDS = [
    (specs.same_python, "string", "3.9.1", "3.9", (True, "3.9")), (specs.same_python, "string", None, "3.9", (False, "gen=None exp=3.9")), (specs.same_python, "string", None, None, (True, "None")),
    (specs.same_install, "string", "pip install  -e .", "python -m pip install -e .", (True, "exact match")), (specs.same_install, "string", "pip install .", "pip install -e .[dev]", (True, "functional match (both pip install)")),
    (specs.same_install, "string", None, None, (True, "both None")), (specs.same_install, "string", "make", None, (False, "gen=make exp=None")), (specs.same_install, "string", "make", "pip install .", (False, "gen=make exp=python -m pip install .")),
    (specs.same_runner, "string", "pytest -rA", "pytest  -rA", (True, "exact match")), (specs.same_runner, "string", "pytest -x", "pytest", (True, "same runner (pytest)")), (specs.same_runner, "string", "tox", "pytest", (False, "different runners: gen=tox exp=pytest")),
    (specs.same_runner, "string", None, None, (True, "both None")), (specs.same_packages, LIST, ["A-b==1"], ["a_b>2"], (True, "1/1 expected packages covered (100%)")),
    (specs.same_packages, LIST, ["a", "z"], ["a", "b", "c"], (False, "1/3 expected packages covered (33%); missing: ['b', 'c']; extra: ['z']")), (specs.same_packages, LIST, None, [], (True, "both empty")), (specs.same_packages, LIST, ["a"], None, (True, "no expected packages to match")),
    (specs.same_packages, LIST, [], ["a", "b"], (False, "missing all 2 expected packages")), (specs.same_packages, LIST, ["a", "b", "c", "d"], ["a", "b", "c", "d", "e"], (True, "4/5 expected packages covered (80%); missing: ['e']")),
    (specs.same_steps, LIST, ["a", "b", "a"], ["b", "a"], (True, "match")), (specs.same_steps, LIST, None, [], (True, "both empty")), (specs.same_steps, LIST, ["a"], None, (False, "gen=['a'] exp=[]")),
]


def test_comparators(spark):
    for make, kind, a, b, want in FIELDS:
        got = one(spark, make, (kind, kind), a, b)
        assert (got["match"], got["detail"]) == want, (make.__name__, a, b)


def test_scores_and_lookups(spark):
    truth = spark.createDataFrame([("r", "1", "3.9", "make", "tox", ["a"], None), ("r", "3", None, None, None, None, None)], f"repo string, version string, python string, install string, test_cmd string, pip_packages {LIST}, pre_install {LIST}")
    own = spark.createDataFrame([("r", "1", "3.9", "pip install .", "tox", ["a"], []), ("r", "2", "3.9", None, None, None, None), ("q", "1", None, None, None, None, None)], f"repo string, version string, language_version string, install_cmd string, test_cmd string, pip_packages {LIST}, pre_install {LIST}")
    got = specs.scored(own, truth).collect()
    assert [(r.repo, r.version, r.matched, r.overall) for r in got] == [("r", "1", 4, pytest.approx(0.8))]
    assert tasks.spec_summaries(specs.field_rows(specs.scored(own, truth))).first().summary.startswith("r v1: 80% (4/5 fields)")
    adapted = {r.version: r for r in specs.bench_spec(own.where("repo = 'r'")).collect()}
    assert (adapted["2"].python, adapted["2"].install, adapted["2"].test_cmd, adapted["2"].pip_packages, adapted["2"].packages) == ("3.9", "pip install -e .", "pytest -rA", [], "") and adapted["1"].install == "pip install ."
    known = spark.createDataFrame([("r", {"1": "x", "2": "y"})], "repo string, specs map<string,string>")
    assert {tuple(r) for r in specs.ground_truth(known, "r").collect()} == {("1", "x"), ("2", "y")} and specs.ground_truth(known, "q").count() == 0
    registry = spark.createDataFrame([("r", "h", "v1", "c1")], "repo string, env_spec_hash string, version string, era_commit string")
    rows = spark.createDataFrame([("r", "h"), ("r", "g"), ("q", "h")], "repo string, env_spec_hash string")
    assert {tuple(r) for r in specs.with_registry(rows, registry).collect()} == {("r", "h", "v1", "c1"), ("r", "g", None, None), ("q", "h", None, None)}
    rust = lambda *v: one(spark, specs.declares_rust, ("string",) * 3, *v)
    assert rust('[toolchain]\nchannel = "1.70"\n', None, "1.70") and rust(None, "[package]\n rust-version='1.65'", "1.65") and not rust('channel = "1.70.1"', "", "1.70") and not rust(None, None, "1.70")


def test_small_rows(spark):
    rows = spark.createDataFrame([("r", "i", "b", "p", "t", "s", ["a", 'b"'], None)], f"repo string, instance_id string, base_commit string, patch string, test_patch string, problem_statement string, FAIL_TO_PASS {LIST}, version string")
    got = tasks.from_dataset(rows).first()
    assert (got.FAIL_TO_PASS, got.PASS_TO_PASS, got.version, got.hints_text) == ('["a", "b\\""]', "[]", "unknown", "")
    s = lambda make, *v: one(spark, make, ("string",) * len(v), *v)
    assert [s(tasks.repo_of_path, p) for p in ("data/clones/grpc__grpc-go", "o/r", "a/b/c", "x/y/o__r__z/", "plain")] == ["grpc/grpc-go", "o/r", "a/b/c", "o/r__z", "plain"]
    assert s(tasks.instance_folder, "owner__repo-x-123") == "owner__repo-x/instances/owner__repo-x-123"
    output = lambda text, failed=False: tuple(one(spark, tasks.validation_output, ("string", "boolean", "string", "string"), text, failed, "error_max_turns", None))
    assert output('{"status": "valid", "FAIL_TO_PASS": ["a"]}') == ("valid", ["a"], [], None) and output("{}") == ("error", [], [], None)
    assert output("{bad")[:3] == ("error", [], []) and output("{bad")[3] and output(None) == output("{}", True) == ("error", [], [], "Agent failed: error_max_turns - no output")
    assert tuple(s(tasks.toml_fields, 'docker_image = "x:1"\nrepo="o/r"\n')) == ("x:1", None, "o/r") and tuple(s(tasks.toml_fields, None)) == (None, None, None)
    assert s(tasks.script_command, '#!/bin/sh\n  (cd a && go test ./...) > "$LOG_FILE" 2>&1\n$X pytest') == "(cd a && go test ./...)" and s(tasks.script_command, "$$RUN pytest -v") == "$RUN pytest -v" and s(tasks.script_command, None).startswith("go test")
    pair = "repo string, target_id int"
    counted = tasks.target_counts(spark.createDataFrame([("r", 1), ("r", 2), ("q", 1)], pair), spark.createDataFrame([("r", 1), ("r", 1)], pair))
    assert {tuple(r) for r in counted.collect()} == {("r", 2, 1), ("q", 1, 0)}
    assert [s(tasks.relevance, *v) for v in (("def test_Run(): core.x", "run", "a/core.py"), ("x", "run", "a/core.py"), (None, "f", "f.py"), ("f f", "f", "f.py"))] == [2, 0, 0, 1]
    checks = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, ok boolean")
    assert [r.id for r in checks.where(filters.kept_unless_failed(F.col("ok"))).collect()] == [1, 3]
    logged = spark.createDataFrame([("r", "a", "b"), ("r", " ", "b"), ("q", "a", "b"), ("r", None, "b")], "repo string, x string, y string")
    assert filters.with_logs(logged, ["r"], ("x", "y")).count() == 1
    both = spark.createDataFrame([("i", ["a", "b"], ["b", "a", "a"]), ("k", ["a"], ["a", "c", "d"]), ("n", None, [])], f"instance_id string, a {LIST}, b {LIST}")
    assert {tuple(map(str, r)) for r in reports.comparison_lines(both, "a", "b").collect()} == {("i", "EXACT", "[]", "[]"), ("k", "J=0.33", "[]", "['c', 'd']"), ("n", "EXACT", "[]", "[]")}
