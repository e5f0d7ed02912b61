"""Contamination and duplicates: hash and id semi-joins, containment, shingle joins, keep-first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditloom.functions import text
from auditloom.operators.substrings import contained


def contaminated(instances: DataFrame, reference: DataFrame) -> DataFrame:
    """Instances with source: the first source (by source_order) that has their id or their patch hash; null if none.

    instances and reference have instance_id and patch_hash. The OR is two equi-joins, whose hits are
    reduced to one row an instance; no pair of rows is compared otherwise.
    """
    hit = F.struct("source_order", "source")
    by_id = reference.groupBy("instance_id").agg(F.min(hit).alias("hit"))
    by_hash = reference.where("patch_hash is not null").groupBy("patch_hash").agg(F.min(hit).alias("hash_hit"))
    both = instances.join(by_id, "instance_id", "left").join(by_hash, "patch_hash", "left")
    return both.withColumn("source", F.least("hit", "hash_hit")["source"]).drop("hit", "hash_hit")


def keep_first(rows: DataFrame, key: Column, order: list[Column]) -> DataFrame:
    """Of rows with one key, the first in order."""
    w = Window.partitionBy("_key").orderBy(*order)
    return rows.withColumn("_key", key).withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_key", "_rank")


def shared_shingles(left: DataFrame, right: DataFrame, n: int = 3) -> DataFrame:
    """(left_id, right_id, similarity) of texts that share a shingle, with their Jaccard: an equi-join on shingle hashes.

    left and right have id and text. The counts aggregate before the ratio; pairs without a common
    shingle have similarity 0 and no row.
    """

    def exploded(side: DataFrame, name: str) -> DataFrame:
        sets = side.select(F.col("id").alias(f"{name}_id"), text.shingles(F.col("text"), n).alias("set")).withColumn(f"{name}_size", F.size("set"))
        return sets.select(f"{name}_id", f"{name}_size", F.explode(F.transform("set", lambda s: F.xxhash64(s))).alias("token"))

    both = exploded(left, "left").join(exploded(right, "right"), "token").groupBy("left_id", "left_size", "right_id", "right_size").agg(F.count_distinct("token").alias("common"))
    return both.select("left_id", "right_id", (F.col("common") / (F.col("left_size") + F.col("right_size") - F.col("common"))).alias("similarity"))


def containing(docs: DataFrame, passages: DataFrame, words: int = 8) -> DataFrame:
    """(doc_id, item_id), once each, where the document contains the passage.

    The words of a passage but its first and last stand whole in any text that contains it, so its key is
    the first of them, at most ``words``; documents give the hashes of their runs of the lengths in use and
    neither side carries its text to the candidates. The texts of candidates decide. Passages of one or two
    words have no such key: the rarest of their short strings is theirs (substrings.contained). An empty passage stands in every text.
    """
    sized = passages.select("item_id", "passage").withColumn("_w", text.words(F.col("passage"))).withColumn("_n", F.least(F.lit(words), F.size("_w") - 2))
    counts = {r["_n"]: r["n"] for r in sized.groupBy("_n").agg(F.count(F.lit(1)).alias("n")).collect()}  # words + 3 rows at most
    lengths = sorted(n for n in counts if n > 0)
    found = []
    if lengths:
        keyed = sized.where("_n > 0").select("item_id", F.xxhash64(F.array_join(F.slice("_w", 2, F.greatest("_n", F.lit(0))), " ")).alias("key"))
        runs = F.array_distinct(F.transform(F.flatten(F.array(*[text.word_runs(text.words(F.col("text")), n) for n in lengths])), lambda r: F.xxhash64(r)))
        pairs = docs.select("doc_id", F.explode(runs).alias("key")).join(keyed, "key").select("doc_id", "item_id").distinct()
        found.append(pairs.join(docs.select("doc_id", "text"), "doc_id").join(passages.select("item_id", "passage"), "item_id").where(F.contains("text", "passage")))
    if any(size <= 0 for size in counts):
        short = sized.where("_n <= 0").select(F.col("item_id").alias("name_id"), F.col("passage").alias("name"))
        found.append(contained(docs.select(F.col("doc_id").alias("id"), "text"), short).select(F.col("id").alias("doc_id"), F.col("name_id").alias("item_id")))
        empty = short.where("name = ''").select(F.col("name_id").alias("item_id"))
        if empty.limit(1).count():  # the result itself is all texts for each
            found.append(docs.where("text is not null").select("doc_id").join(empty, F.lit(True)))
    parts = [f.select("doc_id", "item_id") for f in found] or [docs.select("doc_id").join(passages.select("item_id").limit(0), F.lit(False))]
    return reduce(DataFrame.union, parts).distinct()
