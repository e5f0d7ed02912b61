"""Reproducible samples, rankings and interleavings: order by hash, never by chance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_order(key: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}-"), key.cast("string")).cast("binary"))


def first_n(rows: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def stratified(rows: DataFrame, stratum: str, key: str, n: int, seed: str = "sample") -> DataFrame:
    """At most n rows of each stratum, by hash of key. Spark keeps a task's first n before it shuffles them."""
    return first_n(rows, [stratum], [hash_order(F.col(key), seed), F.col(key)], n)


def filled(rows: DataFrame, stratum: str, key: str, total: int, strata: int, seed: str = "sample") -> DataFrame:
    """An equal share of each stratum, the rest filled by hash from what is left, total in all."""
    shared = stratified(rows, stratum, key, max(1, total // max(1, strata)), seed).drop("rank").withColumn("_first", F.lit(0))
    left = rows.join(shared.select(key), key, "left_anti").withColumn("_first", F.lit(1))
    return shared.unionByName(left).orderBy("_first", hash_order(F.col(key), seed), key).limit(total).drop("_first")


def quotas(pools: list[tuple[DataFrame, int]], key: str, seed: str = "sample") -> DataFrame:
    """So many rows of each pool; a key that several pools drew counts for the first."""
    drawn = None
    for k, (pool, n) in enumerate(pools):
        part = pool.orderBy(hash_order(F.col(key), seed), key).limit(n).withColumn("_pool", F.lit(k))
        drawn = part if drawn is None else drawn.unionByName(part)
    w = Window.partitionBy(key).orderBy("_pool")
    return drawn.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank", "_pool")


def interleaved(rows: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """turn and group rank: sorted by (turn, group) the groups take turns."""
    w = Window.partitionBy(group).orderBy(*order)
    return rows.withColumn("turn", F.row_number().over(w))


def latest_version(tags: Column) -> Column:
    """The greatest of an array of version tags, number by number; tags without numbers don't count."""
    numbers = lambda t: F.transform(F.regexp_extract_all(t, F.lit(r"(\d+)"), F.lit(1)), lambda n: n.cast("bigint"))
    fine = F.filter(tags, lambda t: t.rlike(r"^v?\d+(?:\.\d+)*$"))
    return F.array_max(F.transform(fine, lambda t: F.struct(numbers(t).alias("n"), t.alias("tag"))))["tag"]
