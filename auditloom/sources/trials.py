"""Trees of evaluation trials, <jobs>/<job>/<trial>/..., read as text once and put together by trial (S-12 to S-14).

All files of a trial that matter are one scan of whole texts; jobs go by conditions on the path alone, which
Spark applies to its list of files, so that nothing of a pruned job is opened. One aggregation by trial
lays a trial's files side by side; fields fall back from one file to the next there.

Defined results: a trial without result.json has no row; a file that isn't JSON counts as missing; jobs whose
name begins with oracle or nop go; of files that repeat (there are none in one tree) the greatest text counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditloom.functions.text import seconds_between
from auditloom.operators.assembly import model_key, per_test

#: Places below a trial's folder of what is read.
FILES = {
    "result": "result.json", "config": "config.json", "trajectory": "agent/trajectory.json", "report": "verifier/report.json", "exception": "exception.txt",
    "patch_first": "artifacts/logs/artifacts/candidate_patch.diff", "patch_second": "artifacts/candidate_patch.diff",
}
#: Agents that are no command-line tools, and jobs that are controls.
NOT_CLI, CONTROLS = ("terminus-2", "oracle"), ("oracle", "nop")
RESULT = "task_name string, started_at string, finished_at string, verifier_result struct<rewards:struct<reward:double>>, agent_result struct<cost_usd:double,n_input_tokens:long,n_output_tokens:long>"
CONFIG = "agent struct<name:string,model_name:string>"
TRAJECTORY = "final_metrics struct<total_cost_usd:double,total_prompt_tokens:long,total_completion_tokens:long>, steps array<struct<source:string>>"
REPORT = "test_results map<string,string>"


def trial_files(spark: SparkSession, path: str, include: list[str] | None = None, exclude: list[str] | None = None) -> DataFrame:
    """(job, trial, one text column for each of FILES) of the trials below path whose job stays."""
    names = sorted({name.rsplit("/", 1)[-1] for name in FILES.values()})
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "{" + ",".join(names) + "}").text(path)
    root = path.rstrip("/").removeprefix("file://").removeprefix("file:")
    below = F.regexp_replace("_metadata.file_path", rf"^.*?\Q{root}\E/", "")
    job = F.regexp_extract(below, r"^([^/]+)/", 1)
    keep = F.lit(True)
    for control in CONTROLS:
        keep = keep & ~job.startswith(control)
    keep = keep & job.isin(include) if include else keep
    keep = keep & ~job.isin(exclude) if exclude else keep
    place = F.regexp_extract(below, r"^[^/]+/[^/]+/(.+)$", 1)
    rows = files.where(keep & place.isin(*FILES.values())).select(job.alias("job"), F.regexp_extract(below, r"^[^/]+/([^/]+)/", 1).alias("trial"), place.alias("place"), F.col("value").alias("text"))
    return rows.groupBy("job", "trial").agg(*[F.max(F.when(F.col("place") == p, F.col("text"))).alias(n) for n, p in FILES.items()]).where("result is not null")


def _parsed(files: DataFrame) -> DataFrame:
    read = {"result": RESULT, "config": CONFIG, "trajectory": TRAJECTORY, "report": REPORT}
    valid = lambda n: F.from_json(F.col(n), "map<string,string>").isNotNull()
    parsed = files.select("*", *[F.when(valid(n), F.from_json(n, s)).alias(f"_{n}") for n, s in read.items()])
    return parsed.where("_result is not null")


def _reward() -> Column:
    return F.coalesce("_result.verifier_result.rewards.reward", F.lit(0.0))


def compared(files: DataFrame) -> DataFrame:
    """A row a trial as runs are compared (S-12): a cost of 0 is taken from the trajectory's metrics with its tokens, each where they have it."""
    agent, metrics = F.col("_result.agent_result"), F.col("_trajectory.final_metrics")
    cost = F.coalesce(agent["cost_usd"], F.lit(0.0))
    free = (cost == 0) & F.col("_trajectory").isNotNull()
    either = lambda name, own: F.when(free, F.coalesce(metrics[name], own)).otherwise(own)
    tokens = lambda name: F.coalesce(agent[name], F.lit(0).cast("long"))
    seconds = seconds_between(F.col("_result.started_at"), F.col("_result.finished_at"))
    return _parsed(files).select(
        "job", "trial", F.regexp_extract("trial", r"^(.*?)(?:__(?!.*__).*)?$", 1).alias("instance_id"), F.coalesce("_result.task_name", "trial").alias("task_name"),
        F.coalesce("_config.agent.name", F.lit("unknown")).alias("agent"), F.coalesce("_config.agent.model_name", F.lit("unknown")).alias("model"), _reward().alias("reward"), (_reward() >= 1.0).alias("resolved"),
        either("total_cost_usd", cost).alias("cost_usd"), either("total_prompt_tokens", tokens("n_input_tokens")).alias("input_tokens"), either("total_completion_tokens", tokens("n_output_tokens")).alias("output_tokens"),
        F.coalesce(F.floor(seconds).cast("int"), F.lit(0)).alias("duration_s"), F.col("exception").isNotNull().alias("has_exception"),
    )


def dashboard(files: DataFrame, tests: DataFrame | None = None) -> DataFrame:
    """A row a trial as a dashboard has it (S-14): metrics of the trajectory first, then of the result; tests by the report.

    tests: (task, f2p, p2p) by the trial's name before its last ``__``; without one, no test is expected and none fixed.
    """
    agent, metrics, zero = F.col("_result.agent_result"), F.col("_trajectory.final_metrics"), F.lit(0).cast("long")
    some = lambda first, second: F.coalesce(F.nullif(first, zero), second, zero)
    cost = F.coalesce(metrics["total_cost_usd"], agent["cost_usd"])
    name = F.coalesce("_config.agent.name", F.lit("unknown"))
    task = F.regexp_replace(F.coalesce("_result.task_name", F.lit("")), r"^[^/]+/", "")
    rows = _parsed(files).withColumn("task", F.regexp_extract("trial", r"^(.*)__", 1)).where(F.col("trial").contains("__"))
    none = F.array().cast("array<string>")
    rows = rows.join(tests.select("task", "f2p", "p2p"), "task", "left") if tests is not None else rows.withColumn("f2p", none).withColumn("p2p", none)
    results = F.coalesce("_report.test_results", F.from_json(F.lit("{}"), "map<string,string>"))
    f2p, p2p = (per_test(F.coalesce(c, none), results) for c in ("f2p", "p2p"))
    steps = F.coalesce("_trajectory.steps", F.from_json(F.lit("[]"), "array<struct<source:string>>"))
    patch = F.coalesce(F.nullif("patch_first", F.lit("")), F.nullif("patch_second", F.lit("")))
    return rows.select(
        "job", "trial", F.when(task.contains("__"), F.regexp_extract(task, r"(?s)^.*?__(.*)$", 1)).otherwise(task).alias("instance_id"), model_key(name, F.col("_config.agent.model_name")).alias("model_key"), (_reward() >= 1.0).alias("resolved"),
        f2p.alias("f2p"), p2p.alias("p2p"), patch.alias("patch"), some(metrics["total_prompt_tokens"], agent["n_input_tokens"]).alias("input_tokens"),
        some(metrics["total_completion_tokens"], agent["n_output_tokens"]).alias("output_tokens"), F.size(steps).alias("turns"), F.size(F.filter(steps, lambda s: s["source"] == "agent")).alias("tool_calls"),
        seconds_between(F.col("_result.started_at"), F.col("_result.finished_at")).alias("wall"), F.bround(cost, 4).alias("cost"), (~name.isin(*NOT_CLI)).alias("cli"),
    ).withColumn("fixed", (F.size("f2p") > 0) & F.forall("f2p", lambda t: t["p"]))
