"""Roll-ups: costs at several grains, resolve rates, confusion, evasion, overlap, diversity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def at_grains(rows: DataFrame, grains: list[list[str]], *measures: Column) -> DataFrame:
    """Measures at each grain in one pass; columns outside a grain are null."""
    columns = list(dict.fromkeys(c for g in grains for c in g))
    return rows.groupingSets([[F.col(c) for c in g] for g in grains], *[F.col(c) for c in columns]).agg(*measures)


def confusion(rows: DataFrame, truth: Column, predicted: Column, keys: list[str] | None = None) -> DataFrame:
    counts = rows.groupBy(*(keys or [])).agg(
        F.count_if(truth & predicted).alias("tp"), F.count_if(~truth & predicted).alias("fp"), F.count_if(truth & ~predicted).alias("fn"), F.count_if(~truth & ~predicted).alias("tn")
    )
    precision, recall = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    accuracy = ratio(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))
    f1 = ratio(2 * precision * recall, precision + recall)
    return counts.withColumns({"accuracy": F.round(accuracy, 6), "precision": F.round(precision, 6), "recall": F.round(recall, 6), "f1": F.round(f1, 6)})


def rate_by_run(rows: DataFrame, group: list[str], run: str, hit: Column) -> DataFrame:
    """Mean and population deviation over runs of each run's rate."""
    rates = rows.groupBy(*group, run).agg(F.avg(hit.cast("double")).alias("_rate"))
    return rates.groupBy(*group).agg(F.count(F.lit(1)).alias("n_runs"), F.round(F.avg("_rate"), 6).alias("mean_rate"), F.round(F.stddev_pop("_rate"), 6).alias("std_rate"))


def solved_classes(rows: DataFrame, item: list[str], solved: Column) -> DataFrame:
    """easy: solved in all rows, hard: in none, separating: else."""
    some = rows.groupBy(*item).agg(F.bool_and(solved).alias("_all"), F.bool_or(solved).alias("_any"))
    return some.select(*item, F.when(F.col("_all"), "easy").when(~F.col("_any"), "hard").otherwise("separating").alias("class"))


def outer_comparison(ours: DataFrame, theirs: DataFrame, key: list[str], by: list[str]) -> DataFrame:
    """Numbers of keys in both and in one only, by the given columns."""
    a, b = ours.select(*key).distinct().withColumn("_a", F.lit(True)), theirs.select(*key).distinct().withColumn("_b", F.lit(True))
    a_has, b_has = F.col("_a").isNotNull(), F.col("_b").isNotNull()
    return a.join(b, key, "full_outer").groupBy(*by).agg(F.count_if(a_has & b_has).alias("overlap"), F.count_if(a_has & ~b_has).alias("ours_only"), F.count_if(~a_has & b_has).alias("theirs_only"))


def agreement(pairs: DataFrame, ours: Column, theirs: Column, *keys: str) -> DataFrame:
    """Exact and subset rates and mean Jaccard of two set columns."""
    union, common = F.size(F.array_union(ours, theirs)), F.size(F.array_intersect(ours, theirs))
    jaccard = F.when(union == 0, 1.0).otherwise(common / union)
    exact = (F.size(F.array_except(ours, theirs)) == 0) & (F.size(F.array_except(theirs, ours)) == 0)
    rate = lambda c: F.round(F.coalesce(F.avg(c.cast("double")), F.lit(0.0)), 6)
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), rate(exact).alias("exact_rate"), rate(F.size(F.array_except(theirs, ours)) == 0).alias("superset_rate"), rate(F.size(F.array_except(ours, theirs)) == 0).alias("subset_rate"), rate(jaccard).alias("mean_jaccard"))


def field_matches(pairs: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """Match rate of each field, and their mean as 'overall'."""
    rows = pairs.select(F.explode(F.array(*[F.struct(F.lit(n).alias("field"), c.cast("double").alias("match")) for n, c in fields.items()])).alias("r")).select("r.*")
    rates = rows.groupBy("field").agg(F.avg("match").alias("match_rate"))
    return rates.union(rates.agg(F.lit("overall").alias("field"), F.avg("match_rate").alias("match_rate"))).select("field", F.round("match_rate", 6).alias("match_rate"))


def diversity(rows: DataFrame, keys: list[str], thing: Column, size: Column) -> DataFrame:
    """Distinct things, mean size, coefficient of variation, and a composite capped at 1."""
    out = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(thing).alias("n_distinct"), F.round(F.avg(size), 6).alias("mean_size"), F.round(ratio(F.stddev_pop(size), F.avg(size)), 6).alias("cv_size"))
    return out.withColumn("composite", F.round((F.least(F.lit(1.0), ratio(F.col("n_distinct").cast("double"), F.col("n"))) + F.least(F.lit(1.0), F.col("cv_size"))) / 2, 5))


def comparison_lines(rows: DataFrame, ours: str, theirs: str) -> DataFrame:
    """(instance_id, status, only_ours, only_theirs) of both sides' test lists: EXACT, or the similarity to two places and what each has alone (R-01)."""
    a, b = (F.array_sort(F.array_distinct(F.coalesce(F.col(c), F.array().cast("array<string>")))) for c in (ours, theirs))
    union = F.size(F.array_union(a, b))
    similarity = F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)
    status = F.when(a == b, "EXACT").otherwise(F.concat(F.lit("J="), F.format_string("%.2f", similarity)))
    return rows.select("instance_id", status.alias("status"), F.array_except(a, b).alias("only_ours"), F.array_except(b, a).alias("only_theirs"))
