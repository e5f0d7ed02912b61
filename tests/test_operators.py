"""Operators over small tables: logs, verdicts, filters, contamination, joins, windows, sinks, streams."""

import json

from pyspark.sql import functions as F

from auditloom.functions import diff
from auditloom.operators import decontam, filters, joins, logs, reports, samples, verdicts, windows
from auditloom.sources import jsonl, sinks
from auditloom.streaming import streams


def run(spark, language, log):
    df = spark.createDataFrame([("r", log), ("empty", "")], "run_id string, log string")
    got = {r["run_id"]: r for r in logs.get_parser(language)(df).collect()}
    assert got["empty"]["tests"] == {} and not got["empty"]["compiled"] or language == "go"
    return got["r"]["tests"], got["r"]["compiled"]


def test_go_log(spark):
    event = lambda **k: json.dumps(k)
    log = "\n".join([event(Action="run", Package="p", Test="TestA"), "noise", event(Action="pass", Package="p", Test="TestA"), event(Action="fail", Package="q", Test="TestA"), event(Action="fail", Package="p", Test="TestA"), event(Action="skip", Package="p", Test="TestB"), event(Action="fail", Package="q"), "{bad"])
    assert run(spark, "go", log) == ({"p.TestA": "failed", "q.TestA": "failed", "p.TestB": "skipped"}, True)
    assert run(spark, "go", event(Action="fail", Package="p")) == ({}, False)


def test_other_logs(spark):
    assert run(spark, "python", "t.py::a PASSED [ 1%]\nt.py::b FAILED\nt.py::b PASSED\nt.py::c[x-y] XPASS\nt.py::f g PASSED\nt.py::d SKIPPED (why)\nt.py::e XFAIL") == ({"t.py::a": "passed", "t.py::b": "failed", "t.py::c[x-y]": "passed", "t.py::d": "skipped", "t.py::e": "failed"}, True)
    assert run(spark, "python", "E   ImportError: no module") == ({}, False)
    assert run(spark, "java", "[INFO] Tests run: 5, Failures: 0, Errors: 0, Skipped: 0, Time elapsed: 1 s -- in com.A\n[ERROR] Tests run: 3, Failures: 1, Errors: 0, Skipped: 0 <<< FAILURE! -- in com.B\nTests run: 2, Failures: 0, Errors: 0, Skipped: 2, x -- in com.C") == ({"com.A": "passed", "com.B": "failed", "com.C": "skipped"}, True)
    assert run(spark, "java", "BUILD FAILURE") == ({}, False)
    assert run(spark, "rust", "test m::a ... ok\ntest m::b ... FAILED\n  test m::a ... ignored") == ({"m::a": "skipped", "m::b": "failed"}, True)
    assert run(spark, "rust", "test m::a ... ok\nerror[E0432]: x") == ({}, False)


def test_sections_and_panics(spark):
    df = spark.createDataFrame([("r", "=== RUN   TestA\n=== RUN   TestB\npanic: x\n>>> before\na\nb\n>>> after\nc")], "run_id string, log string")
    assert [r["test_id"] for r in logs.panicked_tests(df).collect()] == ["TestB"]
    assert [(r["section"], r["line"]) for r in logs.section(df, {"before": ">>> before", "after": ">>> after"}).orderBy("line_no").collect()] == [("before", "a"), ("before", "b"), ("after", "c")]


def test_verdicts(spark):
    a = spark.createDataFrame([("i", "t1", "failed"), ("i", "t2", "passed"), ("i", "t3", "passed"), ("i", "t4", "error")], "instance_id string, test_id string, status string")
    b = spark.createDataFrame([("i", "t1", "passed"), ("i", "t2", "passed"), ("i", "t3", "failed"), ("i", "t5", "passed")], a.schema)
    kinds = verdicts.transitions(a, b, ["instance_id", "test_id"])
    assert {r["test_id"]: r["class"] for r in kinds.collect()} == {"t1": "fail_to_pass", "t2": "pass_to_pass", "t3": "pass_to_fail"}
    runs = spark.createDataFrame([("t1", 1), ("t1", 2), ("t2", 1), ("t2", 1)], "test_id string, run int")
    assert {r["test_id"]: r["class"] for r in verdicts.quarantine(runs, ["test_id"], "run", 2).collect()} == {"t1": "stable", "t2": "flaky"}
    expected = spark.createDataFrame([("i", "t1", "fail_to_pass"), ("i", "t9", "pass_to_pass"), ("k", "t1", "pass_to_pass")], "instance_id string, test_id string, kind string")
    actual = spark.createDataFrame([("i", "t1", "passed"), ("k", "t1", "passed")], "instance_id string, test_id string, status string")
    graded = verdicts.graded(expected, actual, ["instance_id", "test_id"])
    rules = {rule: {r["instance_id"]: r["ok"] for r in graded.groupBy("instance_id").agg(verdicts.resolved(F.col("status"), F.col("kind"), rule).alias("ok")).collect()} for rule in ("strict", "lenient", "first_only")}
    assert rules == {"strict": {"i": False, "k": True}, "lenient": {"i": True, "k": False}, "first_only": {"i": True, "k": True}}


def task(statement="word " * 40, patch="+x", tests='["a"]', key="i"):
    return (key, statement, patch, "t", tests)


def test_filters(spark):
    leak = "diff --git a/x b/x\n+def fresh():"
    rows = [task(), task("word " * 39, key="short"), task(tests="[", key="bad"), task(tests="[]", key="none"), task(patch=leak, tests='["m::test_fresh"]', key="leak"), task(patch="\n".join(["+x"] * 500), key="edge"), task(patch="\n".join(["+x"] * 501), key="large"), task("see http://a.b " + "w " * 50, key="url")]
    df = spark.createDataFrame(rows, "instance_id string, problem_statement string, patch string, test_patch string, FAIL_TO_PASS string")
    got = {r["instance_id"]: r["why"] for r in df.select("instance_id", filters.instance_reasons().alias("why")).collect()}
    assert got == {"i": [], "short": ["too_short"], "bad": ["invalid_tests"], "none": ["no_tests"], "leak": ["new_symbol"], "edge": [], "large": ["too_large"], "url": ["has_url"]}
    assert filters.passing(df).count() == 2
    results = spark.createDataFrame([("i", False)], "instance_id string, compiled boolean")
    assert {r["instance_id"] for r in filters.passing_go(df, results).collect()} == {"edge"}
    scores = spark.createDataFrame([("i", "exclude"), ("edge", "keep")], "instance_id string, recommendation string")
    assert filters.not_excluded(df, scores).count() == len(rows) - 1
    assert filters.viable(df.withColumn("patch", F.when(F.col("instance_id") == "i", "").otherwise(F.col("patch")))).count() == len(rows) - 1


def test_contamination(spark):
    instances = spark.createDataFrame([("a", "h1"), ("b", "h2"), ("c", "h3")], "instance_id string, patch_hash string")
    reference = spark.createDataFrame([("late", 1, "a", "x"), ("early", 0, "z", "h1"), ("late", 1, "y", "h2")], "source string, source_order int, instance_id string, patch_hash string")
    assert {r["instance_id"]: r["source"] for r in decontam.contaminated(instances, reference).collect()} == {"a": "early", "b": "late", "c": None}
    first = decontam.keep_first(instances, F.lit(1), [F.desc("instance_id")])
    assert [r["instance_id"] for r in first.collect()] == ["c"]


def test_joins(spark):
    lines = spark.createDataFrame([("f", 1, 3), ("f", 1, 4), ("f", 2, 4), ("f", 2, 9), ("g", 3, 1)], "path string, hunk int, line int")
    regions = spark.createDataFrame([("f", 3, 5)], "path string, start int, `end` int")
    assert {r["hunk"]: r["inside"] for r in joins.all_inside(lines, regions, ["path", "hunk"], "path", "line").collect()} == {1: True, 2: False, 3: False}
    names = spark.createDataFrame([("api",), ("api-server",)], "name string")
    jobs = spark.createDataFrame([("run-api-server-1",), ("api",), ("other",)], "job string")
    assert {r["job"]: r["name"] for r in joins.longest_contained(jobs, "job", names).collect()} == {"run-api-server-1": "api-server", "api": "api", "other": None}
    paths = spark.createDataFrame([("s", "b", 1), ("s", "a", 1), ("s", "0", 2)], "src string, path string, priority int")
    assert joins.by_priority(spark.createDataFrame([("s",), ("t",)], "src string"), paths, ["src"]).orderBy("src").collect()[0]["path"] == "a"


def test_windows_and_samples(spark):
    rows = spark.createDataFrame([("k", i, n) for i, n in enumerate([50, 40, 20, 90, 100, 5])] + [("m", 0, 300)], "g string, i int, n long")
    batches = {(r["g"], r["i"]): r["batch"] for r in windows.greedy_batches(rows, "g", "i", "n", 100, 2).collect()}
    assert batches == {("k", 0): 0, ("k", 1): 0, ("k", 2): 1, ("k", 3): 2, ("k", 4): 3, ("k", 5): 4, ("m", 0): 0}
    assert windows.head_and_tail(rows, ["g"], "i", 1, 1).count() == 3
    assert samples.first_n(rows, ["g"], [F.desc("n")], 2).count() == 3
    assert samples.stratified(rows.withColumn("id", F.col("i")), "g", "id", 2).collect() == samples.stratified(rows.withColumn("id", F.col("i")), "g", "id", 2).collect()
    confusion = reports.confusion(spark.createDataFrame([], "t boolean, p boolean"), F.col("t"), F.col("p")).first()
    assert (confusion["tp"], confusion["f1"], confusion["accuracy"]) == (0, 0.0, 0.0)


def test_sources_and_sinks(spark, tmp_path):
    path = tmp_path / "rows.jsonl"
    path.write_text('{"instance_id":"a","patch":"+x","other":1}\n\nnot json\n{"instance_id":"b","model_patch":"+y"}\n')
    assert jsonl.read_lines(spark, str(path), jsonl.TASK).count() == 2
    reference = jsonl.read_reference(spark, {"one": str(path)}, diff.patch_hash).collect()
    assert {r["instance_id"] for r in reference} == {"a", "b"} and all(r["patch_hash"] for r in reference)
    strict = tmp_path / "strict.jsonl"
    strict.write_text('{"instance_id":"a","other":1}\n')
    try:
        jsonl.read_strict(spark, str(strict), jsonl.TASK).collect()
        raise AssertionError("an unknown key passed")
    except Exception as e:
        assert "unknown keys: other" in str(e)
    out = str(tmp_path / "out")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "instance_id string, n int")
    for batch in (rows, rows, spark.createDataFrame([("c", 3)], rows.schema)):
        sinks.append_unseen(batch, out)
    assert spark.read.schema(rows.schema).json(out).count() == 3
    assert sinks.insert_absent(rows, spark.createDataFrame([("b", 9), ("d", 4)], rows.schema), "instance_id").count() == 3
    assert {r["n"] for r in sinks.updated(rows, spark.createDataFrame([("b", 9)], rows.schema), "instance_id", "n").collect()} == {1, 9}
    files = sinks.write_directories(rows.withColumn("body", F.lit("text")), str(tmp_path / "tree"), "instance_id", {"body.txt": "body"})
    assert files.where("error is not null").count() == 0 and (tmp_path / "tree/a/body.txt").read_text() == "text"


def test_spec_hash(spark, tmp_path):
    import hashlib

    spec = {"build_cmd": "make", "go_version": "1.22", "goflags": "", "language": "go", "module_mode": "modules", "system_dependencies": ["b", "a"], "test_cmd": "go test ./..."}
    canonical = json.dumps({**spec, "system_dependencies": ["a", "b"]}, sort_keys=True, separators=(",", ":"))
    key = hashlib.sha256(canonical.encode()).hexdigest()
    (tmp_path / f"{key}.json").write_text(json.dumps(spec))
    (tmp_path / f"{'0' * 64}.json").write_text(json.dumps(spec))
    assert [r["key"] for r in jsonl.read_specs(spark, str(tmp_path)).collect()] == [key]


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    for k in range(3):
        events.where(f"event_id % 3 = {k}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = streams.landed(spark, str(tmp_path / "in"), events.schema, 1, "parquet")
    query = streams.daily_totals(stream, "60 days").writeStream.format("memory").queryName("totals").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start()
    query.awaitTermination()
    got = {(r["day"], r["event_type"]): (r["n"], r["value"]) for r in spark.table("totals").collect()}
    want = {(r["day"], r["event_type"]): (r["n"], r["value"]) for r in streams.daily_totals(events).collect()}
    assert got == want
    landed = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "instance_id string, n int")
    for k in range(2):  # the second run finds what the first has taken
        landed.write.mode("append").json(str(tmp_path / "json"))
        streams.to_lines(streams.landed(spark, str(tmp_path / "json"), landed.schema), str(tmp_path / "lines"), str(tmp_path / "ck2")).awaitTermination()
        assert spark.read.schema(landed.schema).json(str(tmp_path / "lines")).count() == 2


def test_containing_is_brute_force_containment(spark):
    import random

    from auditloom.operators import decontam

    draw = random.Random(3)
    texts = [" ".join(draw.choice(("a", "bb", "abc", "c", "\n")) for _ in range(draw.randint(0, 40))) for _ in range(60)] + [None, ""]
    cut = [t[i : i + draw.randint(1, 45)] for t in texts[:60] if t for i in (draw.randrange(len(t)),)]
    passages = [*cut, "a", "b c", "zz", "abc abc a", " a ", "", None, *cut[:3]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    items = spark.createDataFrame(list(enumerate(passages)), "item_id int, passage string")
    want = {(d, i) for d, t in enumerate(texts) for i, p in enumerate(passages) if t is not None and p is not None and p in t}
    got = [tuple(r) for r in decontam.containing(docs, items).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert decontam.containing(docs, items.limit(0)).count() == 0 and decontam.containing(docs.limit(0), items).count() == 0


def test_names_in_texts(spark):
    """Against plain search; names of all lengths, signs beyond one UTF-16 unit, common and rare strings; no nested loop in the plan."""
    import random

    from auditloom.operators import substrings

    draw = random.Random(9)
    texts = ["".join(draw.choice("aab🙂é ") for _ in range(draw.randint(0, 60))) for _ in range(80)] + [None, "", "get_run run", "a" * 5000]
    names = [t[i : i + draw.randint(1, 9)] for t in texts[:80] if t for i in (draw.randrange(len(t)),)] + ["run", "zzz", "a", "🙂", "", None, "t_r"]
    left = spark.createDataFrame(list(enumerate(texts)) + [(0, texts[0])], "id int, text string")
    right = spark.createDataFrame(list(enumerate(names)), "name_id int, name string")
    want = {(i, k) for i, t in enumerate(texts) for k, n in enumerate(names) if t is not None and n and n in t}
    for size in (1, 3, 5):
        df = substrings.contained(left, right, size)
        got = [tuple(r) for r in df.collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert "NestedLoop" not in df._jdf.queryExecution().toString() and "Cartesian" not in df._jdf.queryExecution().toString()
    assert substrings.contained(left, right.limit(0)).count() == 0
    rows = spark.createDataFrame([("get_run",), ("x",), (None,), ("get_run",)], "t string")
    assert [r.name for r in joins.longest_contained(rows, "t", spark.createDataFrame([("run",), ("et_",), ("get",), ("",)], "name string")).orderBy("t").collect()] == [None, "run", "run", None]
