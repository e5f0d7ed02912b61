"""Paged sources, retries and log tails: what is opened, and streams against batches."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from auditloom.operators import collected
from auditloom.sources import paged
from auditloom.streaming import retries, tails


def day(n):
    return f"2024-{n // 28 + 1:02d}-{n % 28 + 1:02d}"


def write_pages(path, numbers, per_page=3):
    os.makedirs(path, exist_ok=True)
    for k in range(0, len(numbers), per_page):
        with open(f"{path}/page-{k // per_page + 1}.json", "w") as f:
            json.dump([{"number": n, "created_at": day(n), "title": f"t{n}", "more": 1} for n in numbers[k : k + per_page]], f)


class Counted(paged.Pages):
    """Pages that leave a mark for each page that is opened, and where it was."""

    @classmethod
    def name(cls):
        return "counted_pages"

    @staticmethod
    def page(options, n):
        open(f"{options['marks']}/{n}", "a").close()
        return paged.Pages.page(options, n)


@pytest.fixture
def pages(spark, tmp_path):
    spark.dataSource.register(Counted)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    folder, marks = tmp_path / "pages", tmp_path / "marks"
    marks.mkdir()
    write_pages(folder, list(range(150, 0, -1)))

    def read(where=None):
        for f in marks.iterdir():
            f.unlink()
        df = spark.read.format("counted_pages").option("path", f"file://{folder}").option("marks", str(marks)).option("pages_per_task", 2).load()
        got = sorted(r.number for r in (df if where is None else df.where(where)).collect())
        return got, sorted(int(f.name) for f in marks.iterdir())

    return read


def test_pages_stop_early(pages):
    got, opened = pages()
    assert got == list(range(1, 151)) and set(range(1, 51)) <= set(opened) and len(opened) <= 58  # the rest is the look for the end
    got, opened = pages(F.col("created_at") >= day(140))
    assert got == list(range(140, 151)) and set(range(1, 5)) <= set(opened) and max(opened) <= 7  # four pages hold them; the look for the end doubles
    got, opened = pages((F.col("created_at") >= day(60)) & (F.col("created_at") < day(66)))
    assert got == list(range(60, 66)) and len(opened) <= 20 and not set(range(45, 51)) & set(opened)
    got, opened = pages(F.col("created_at") > day(200))
    assert got == [] and opened == [1]
    assert pages((F.col("created_at") == day(7)) | (F.col("number") == 9))[0] == [7, 9]
    assert pages(F.col("created_at") == day(7))[0] == [7]


def test_pages_as_stream(spark, tmp_path):
    spark.dataSource.register(paged.Pages)
    folder, out, state = (str(tmp_path / x) for x in ("pages", "out", "state"))

    def run():
        stream = spark.readStream.format("pages").option("path", f"file://{folder}").option("pages_per_task", 2).load().select("number", "title")
        query = stream.writeStream.format("json").option("checkpointLocation", state).trigger(once=True)
        query.start(out).awaitTermination(120)
        return sorted(r.number for r in spark.read.schema("number long, title string").json(out).collect())

    write_pages(folder, list(range(10, 0, -1)))
    assert run() == list(range(1, 11))
    write_pages(folder, list(range(25, 0, -1)))  # what is new comes first and moves the rest on
    assert run() == list(range(1, 26))
    assert run() == list(range(1, 26))


def test_no_pages(spark, tmp_path):
    spark.dataSource.register(paged.Pages)
    assert spark.read.format("pages").option("path", f"file://{tmp_path}").load().count() == 0


def test_candidates(spark):
    rows = [
        ("o/r", 5, "Fixes #3", "see #9", "2024-05", "m", "sha5", "base5", "par5", None), ("o/r", 4, "x", "closes #1 and STOR-7", "2024-04", "m", "sha4", "base4", None, "u"), ("o/r", 3, "fixes #2", None, "2024-03", None, "s", "b", "p", None),
        ("o/r", 2, None, "resolves #8", "2024-02", "m", "sha2", None, "", None), ("o/r", 1, "no issue", "", "2024-01", "m", "s", "b", "p", None), ("o/s", 4, "OCPBUGS-12", None, "2024-04", "m", None, None, None, None),
    ]
    pulls = spark.createDataFrame(rows, "repo string, number long, title string, body string, created_at string, merged_at string, merge_commit_sha string, base_sha string, parent_sha string, diff_url string")
    got = {(r.repo, r.pr_number): r for r in collected.candidates(pulls).collect()}
    assert set(got) == {("o/r", 5), ("o/r", 4), ("o/r", 2), ("o/s", 4)}
    assert [got["o/r", n].base_commit for n in (5, 4, 2)] == ["par5", "base4", "sha2"] and got["o/s", 4].base_commit == ""
    assert got["o/r", 4].resolved_issues == [1] and got["o/r", 4].resolved_jira_issues == ["STOR-7"] and got["o/r", 4].diff_url == "u" and got["o/r", 5].diff_url.endswith("o/r/pull/5.diff")
    assert (got["o/r", 5].link_confidence, got["o/s", 4].link_confidence) == (1.0, 0.9)
    known = spark.createDataFrame([("o/r", 5), ("o/r", 5)], "repo string, number long")
    assert {r.pr_number for r in collected.candidates(pulls, known, "2024-02", "2024-04").collect()} == {4, 2}
    assert sorted((r.repo, r.pr_number) for r in collected.candidates(pulls, most=1).collect()) == [("o/r", 5), ("o/s", 4)]


RESULTS = "task_id string, at long, status string, output string, missing array<string>"


def outcomes(seed):
    rng = random.Random(seed)
    kinds = [("success", "", []), ("success", "", ["a.json", "b"]), ("success", None, None), ("error_max_turns", "x", None), ("error_max_turns", None, []), ("error_max_budget_usd", None, None), ("error_during_execution", "boom", None), (None, None, None)]
    return [(f"t{t}", at, *rng.choice(kinds)) for t in range(40) for at in range(rng.randint(1, 6))]


def test_retries_rule(spark):
    rows = [("a", 1, "error_max_turns", None, None), ("a", 2, "error_max_turns", None, None), ("a", 3, "error_max_turns", None, None), ("a", 4, "success", None, None), ("b", 1, "error_max_budget_usd", None, None), ("b", 2, "success", None, None), ("c", 1, "success", None, ["x", "y"]), ("c", 2, "success", None, [])]
    got = retries.steps(spark.createDataFrame(rows, RESULTS)).orderBy("task_id", "attempt").collect()
    assert [(r.task_id, r.attempt, r.max_turns, r.decision, r.next_turns) for r in got] == [("a", 1, 50, "retry", 75), ("a", 2, 75, "retry", 113), ("a", 3, 113, "gave up", None), ("b", 1, 50, "over budget", None), ("c", 1, 50, "retry", 50), ("c", 2, 50, "done", None)]
    assert got[0].reason == "Agent exhausted the turn limit (50 turns)." and got[4].reason.endswith("missing: ['x', 'y']")
    told = spark.createDataFrame([("p", 1, "why"), ("p", 1, None)], "p string, n int, r string").select(retries.amended(F.col("p"), F.col("n"), F.col("r")).alias("x")).collect()
    assert told[0].x == "p\n\nIMPORTANT: A previous attempt (attempt 1) failed. Here is what went wrong:\nwhy\nPlease avoid the same mistake and try again." and told[1].x == "p"


@pytest.fixture
def with_state(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def streamed(spark, make, folder, schema, batches, tmp_path):
    """Rows of a stream that is stopped and started again after each batch of files."""
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for k, batch in enumerate(batches):
        for name, text in batch.items():
            with open(f"{folder}/.{name}", "w") as f:
                f.write(text)
            os.rename(f"{folder}/.{name}", f"{folder}/{name}")
        query = make().writeStream.foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{out}/{n}")).outputMode("update").option("checkpointLocation", state).trigger(availableNow=True).start()
        query.awaitTermination()
        assert query.exception() is None, k
    return [r for d in sorted(os.listdir(out)) for r in spark.read.schema(schema).parquet(f"{out}/{d}").collect()]


def test_retries_as_stream(spark, tmp_path, with_state):
    rows = outcomes(5)
    folder = tmp_path / "in"
    folder.mkdir()
    batches = [{f"b{k}.json": "\n".join(json.dumps(dict(zip(("task_id", "at", "status", "output", "missing"), r, strict=True))) for r in rows if r[1] // 2 == k) or "\n"} for k in range(3)]
    got = streamed(spark, lambda: retries.retried(spark.readStream.schema(RESULTS).json(str(folder))), folder, retries.STEP, batches, tmp_path)
    want = retries.steps(spark.createDataFrame(rows, RESULTS)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str) and {r.decision for r in want} == {"retry", "done", "gave up", "over budget"}


def test_tail_of_any_split(spark, tmp_path, with_state):
    rng = random.Random(11)
    folder = tmp_path / "in"
    folder.mkdir()
    want, files = [], {}
    for log in ("alpha", "beta"):
        text = "".join(f"{'=== Stage for ' + rng.choice(['o/a', 'o/b', 'p/c']) if rng.random() < 0.2 else 'done ' + str(i)}\n" for i in range(60)) + "open end"
        cuts = [0, *sorted(rng.sample(range(len(text)), 7)), len(text)]
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            files[f"{log}.{k}"] = text[a:b]
        at = None
        for n, line in enumerate(text.split("\n")[:-1]):
            at = line.removeprefix("=== Stage for ") if line.startswith("===") else at
            want.append((log, n, at, line))
    names = sorted(files)
    rng.shuffle(names)
    batches = [{n: files[n] for n in names[k::3]} for k in range(3)]
    got = streamed(spark, lambda: tails.lines(tails.parts(spark, str(folder)), r"^=== Stage for (\S+)"), folder, tails.LINE, batches, tmp_path)
    assert sorted(map(tuple, got)) == sorted(want)
