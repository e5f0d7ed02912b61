"""Joins with fallbacks, intervals and as-of conditions, all of them keyed first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditloom.operators.substrings import contained


def before(events: DataFrame, bounds: DataFrame, key: str, at: str, bound: str) -> DataFrame:
    """Events earlier than their key's bound: an equi-join whose residual is the inequality."""
    return events.join(bounds.select(key, bound), key).where(F.col(at) < F.col(bound))


def in_intervals(points: DataFrame, intervals: DataFrame, at: str, lo: str, hi: str, width: int, on: list[str] | None = None) -> DataFrame:
    """Points in [lo, hi] of integer intervals. Intervals are dealt to cells of the width, so the join is on equal cells."""
    keys = [*(on or []), "_cell"]
    cells = intervals.withColumn("_cell", F.explode(F.sequence(F.floor(F.col(lo) / width), F.floor(F.col(hi) / width))))
    return points.withColumn("_cell", F.floor(F.col(at) / width)).join(cells, keys).where(F.col(at).between(F.col(lo), F.col(hi))).drop("_cell")


def all_inside(lines: DataFrame, regions: DataFrame, hunk: list[str], path: str, line: str) -> DataFrame:
    """hunk and whether all its lines lie in regions (start, end) of its file."""
    inside = lines.join(regions.select(path, "start", "end"), path, "left").withColumn("_in", F.coalesce(F.col(line).between(F.col("start"), F.col("end")), F.lit(False)))
    per_line = inside.groupBy(*hunk, line).agg(F.bool_or("_in").alias("_in"))
    return per_line.groupBy(*hunk).agg(F.bool_and("_in").alias("inside"))


def earliest(rows: DataFrame, key: list[str], value: str, order: list[str], where: Column | None = None) -> DataFrame:
    """The value of each key's first row in order that meets the condition."""
    kept = rows if where is None else rows.where(where)
    return kept.groupBy(*key).agg(F.min_by(value, F.struct(*order)).alias(value))


def snapped(rows: DataFrame, known: DataFrame, options: dict[str, Column]) -> DataFrame:
    """rows with key and level: the first option that is a known key. Options are tried by equi-joins on distinct keys."""
    out = rows
    keys = known.select("key").distinct()
    for level, option in options.items():
        out = out.withColumn(f"_try_{level}", option).join(keys.select(F.col("key").alias(f"_{level}")), F.col(f"_try_{level}") == F.col(f"_{level}"), "left")
    found = F.coalesce(*[F.col(f"_{level}") for level in options])
    level = F.coalesce(*[F.when(F.col(f"_{x}").isNotNull(), F.lit(x)) for x in options])
    return out.withColumn("key", found).withColumn("level", level).drop(*[f"{p}{x}" for x in options for p in ("_try_", "_")])


def longest_contained(rows: DataFrame, text: str, names: DataFrame) -> DataFrame:
    """rows with the longest of names that their text contains, the greatest of equal length; null if none. Equal texts are searched once."""
    texts = rows.select(F.col(text).alias("id"), F.col(text).alias("text")).distinct()
    hits = contained(texts, names.select(F.col("name").alias("name_id"), "name").distinct())
    best = hits.groupBy(F.col("id").alias("_text")).agg(F.max_by("name_id", F.struct(F.length("name_id"), "name_id")).alias("name"))
    return rows.join(best, F.col(text) == F.col("_text"), "left").drop("_text")


def by_priority(rows: DataFrame, candidates: DataFrame, key: list[str]) -> DataFrame:
    """rows with path, the candidate of least priority (then path) of their key."""
    return rows.join(candidates.groupBy(*key).agg(F.min_by("path", F.struct("priority", "path")).alias("path")), key, "left")


def first_per_key(rows: DataFrame, key: list[str], order: list[Column], n: int = 1) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")
