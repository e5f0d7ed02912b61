"""Trees of trials: what is opened, and the fields' fallbacks."""

import json

import pytest
from pyspark.sql import functions as F

from auditloom.sources import trials


def write(folder, **files):
    for name, content in files.items():
        place = folder / trials.FILES[name]
        place.parent.mkdir(parents=True, exist_ok=True)
        place.write_text(content if isinstance(content, str) else json.dumps(content))


@pytest.fixture
def tree(tmp_path):
    times = {"started_at": "2024-01-01T00:00:00Z", "finished_at": "2024-01-01T00:01:01.500Z"}
    job = tmp_path / "jobs" / "job1"
    write(job / "go__o__r-1__x1", result=times | {"task_name": "p/go__o__r-1", "verifier_result": {"rewards": {"reward": 1}}, "agent_result": {"cost_usd": 0, "n_input_tokens": 5, "n_output_tokens": 6}},
          config={"agent": {"name": "cli", "model_name": "vertex_ai/m"}}, trajectory={"final_metrics": {"total_cost_usd": 1.23456, "total_prompt_tokens": 50}, "steps": [{"source": "agent"}, {"source": "user"}]},
          report={"test_results": {"a": "passed", "b": "failed"}}, exception="boom", patch_first="", patch_second="diff")
    write(job / "plain", result={"task_name": "plain"}, trajectory="{bad", config="[]")
    write(job / "py__t__2", result=times | {"finished_at": "soon", "agent_result": {"cost_usd": 0.5, "n_input_tokens": 7}, "verifier_result": None}, trajectory={"final_metrics": {"total_cost_usd": 9}}, config={"agent": {"name": "oracle"}}, patch_first="first", patch_second="second")
    write(job / "lost", config={})
    write(job / "broken", result="{")
    (job / "result.json").write_text("{}")
    for pruned in ("oracle-1", "nop", "other"):
        write(tmp_path / "jobs" / pruned / "t__1", result={})
    return f"file://{tmp_path}/jobs"


def opened(df):
    """Rows of the last run, and how many files its scan read."""
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.finalPhysicalPlan() if "Adaptive" in plan.getClass().getSimpleName() else plan
    todo, n = [leaf], 0
    while todo:
        node = todo.pop()
        if "QueryStage" in node.getClass().getSimpleName():
            todo.append(node.plan())
        if node.metrics().contains("numFiles"):
            n += node.metrics().apply("numFiles").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return rows, n


def test_pruned_jobs_stay_closed(spark, tree):
    rows, n = opened(trials.trial_files(spark, tree, exclude=["other"]))
    assert {r.trial for r in rows} == {"go__o__r-1__x1", "plain", "py__t__2", "broken"} and n == 16  # what job1 has of FILES; an empty one needs no read
    rows, n = opened(trials.trial_files(spark, tree, include=["other", "oracle-1"]))
    assert [(r.job, r.trial) for r in rows] == [("other", "t__1")] and n == 1


def test_compared(spark, tree):
    got = {r.trial: r for r in trials.compared(trials.trial_files(spark, tree, exclude=["other"])).collect()}
    a, b, c = got["go__o__r-1__x1"], got["plain"], got["py__t__2"]
    assert (a.instance_id, a.task_name, a.agent, a.model, a.resolved, a.cost_usd, a.input_tokens, a.output_tokens, a.duration_s, a.has_exception) == ("go__o__r-1", "p/go__o__r-1", "cli", "vertex_ai/m", True, 1.23456, 50, 6, 61, True)
    assert (b.instance_id, b.agent, b.model, b.reward, b.resolved, b.cost_usd, b.input_tokens, b.duration_s, b.has_exception) == ("plain", "unknown", "unknown", 0.0, False, 0.0, 0, 0, False)
    assert (c.instance_id, c.task_name, c.cost_usd, c.input_tokens, c.duration_s) == ("py__t", "py__t__2", 0.5, 7, 0) and set(got) == {a.trial, b.trial, c.trial}


def test_dashboard(spark, tree):
    tests = spark.createDataFrame([("go__o__r-1", ["a"], ["a", "b"])], "task string, f2p array<string>, p2p array<string>")
    got = {r.trial: r for r in trials.dashboard(trials.trial_files(spark, tree, exclude=["other"]), tests).collect()}
    a, c = got["go__o__r-1__x1"], got["py__t__2"]
    assert (a.instance_id, a.model_key, a.resolved, a.fixed, a.patch, a.input_tokens, a.output_tokens, a.turns, a.tool_calls, a.wall, a.cost, a.cli) == ("o__r-1", "cli__m", True, True, "diff", 50, 6, 2, 1, 61.5, 1.2346, True)
    assert [tuple(t) for t in a.p2p] == [("a", True), ("b", False)]
    assert (c.model_key, c.fixed, c.patch, c.cost, c.wall, c.cli, c.input_tokens, c.turns) == ("oracle__adhoc", False, "first", 9.0, None, False, 7, 0) and set(got) == {a.trial, c.trial}
    assert trials.dashboard(trials.trial_files(spark, tree, exclude=["other"])).where(F.col("fixed")).count() == 0
