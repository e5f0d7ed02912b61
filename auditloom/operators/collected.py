"""Candidates from pulled records: merged ones that resolve an issue and aren't known yet (S-20, F-17)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditloom.functions import text


def candidates(pulls: DataFrame, known: DataFrame | None = None, after: str | None = None, before: str | None = None, projects: tuple[str, ...] = text.PROJECTS, most: int | None = None) -> DataFrame:
    """CANDIDATE_PR's columns of pulls (repo, number, title, body, created_at, merged_at, merge_commit_sha, base_sha, parent_sha, diff_url), newest first by number.

    known: (repo, number) that go; bounds are inclusive and compare as text. The base commit is the merge commit's first
    parent, else the base branch's commit, else the merge commit. most: so many of each repo, the newest. Nulls in title or body are empty; records that
    weren't merged, or name no issue, go; a record that repeats counts as often.
    """
    rows = pulls.where("merged_at is not null")
    rows = rows.where(F.col("created_at") >= after) if after else rows
    rows = rows.where(F.col("created_at") <= before) if before else rows
    if known is not None:
        rows = rows.join(known.select("repo", "number").distinct(), ["repo", "number"], "left_anti")
    title, body = text.blank(F.col("title")), text.blank(F.col("body"))
    both = lambda of: F.array_sort(F.array_union(of(title), of(body)))
    rows = rows.withColumn("_issues", both(text.numbers_after)).withColumn("_keys", both(lambda c: text.project_keys(c, projects))).where("size(_issues) > 0 or size(_keys) > 0")
    some = lambda c: F.nullif(F.col(c), F.lit(""))
    merge = text.blank(F.col("merge_commit_sha"))
    url = F.concat(F.lit("https://github.com/"), "repo", F.lit("/pull/"), F.col("number").cast("string"), F.lit(".diff"))
    out = rows.select(
        "repo", F.col("number").alias("pr_number"), title.alias("title"), body.alias("body"), F.coalesce(some("parent_sha"), some("base_sha"), merge).alias("base_commit"), merge.alias("merge_commit"),
        F.coalesce(some("diff_url"), url).alias("diff_url"), F.col("_issues").cast("array<long>").alias("resolved_issues"), F.col("_keys").alias("resolved_jira_issues"), "created_at", "merged_at",
        text.link_confidence(F.concat_ws("\n", title, body), projects).alias("link_confidence"),
    )
    if most is None:
        return out
    newest = Window.partitionBy("repo").orderBy(F.desc("created_at"), F.desc("pr_number"))
    return out.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= most).drop("_rank")
