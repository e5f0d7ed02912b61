"""Which of many names stand in which of many texts, by equal keys (J-24, J-26, O-15).

Every name that is in a text has all its strings of ``size`` signs there. Texts give their distinct strings
of that size (and of the shorter sizes that short names have), and each name is keyed by the one of its strings
that the fewest texts hold, so a name is tried only where its rarest string is. The texts of candidates decide.
No text is held against every name.

Defined results: null and empty names stand in no text; a null text holds none; ids that repeat count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def strings(text: Column, size: int) -> Column:
    """All strings of so many signs, in one pass."""
    return F.regexp_extract_all(text, F.lit(rf"(?s)(?=(.{{{size}}}))"), F.lit(1))


def contained(texts: DataFrame, names: DataFrame, size: int = 3, on: tuple[str, ...] = ()) -> DataFrame:
    """(on, id, name_id) of texts (on, id, text) that contain names (on, name_id, name); both must agree in the columns of on, where null agrees with nothing."""
    named = names.where("name is not null and name <> ''").withColumn("_size", F.least(F.lit(size), F.length("name")))
    sizes = sorted(r[0] for r in named.select("_size").distinct().collect())  # so many rows at most
    if not sizes:
        return texts.select(*on, "id").join(names.select("name_id").limit(0), F.lit(False))
    keys = [*on, "key"]
    own = named.select(*on, "name_id", F.explode(F.array_distinct(F.coalesce(*[F.when(F.col("_size") == k, strings(F.col("name"), k)) for k in sizes]))).alias("key"))
    every = texts.where("text is not null").select(*on, "id", F.explode(F.array_distinct(F.flatten(F.array(*[strings(F.col("text"), k) for k in sizes])))).alias("key"))
    held = every.join(own.select(keys).distinct(), keys, "left_semi").groupBy(keys).agg(F.count(F.lit(1)).alias("n"))
    rarest = own.join(held, keys, "left").groupBy(*on, "name_id").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key")).alias("least")).where("least.n > 0")
    tried = every.join(rarest.select(*on, "name_id", F.col("least.key").alias("key")), keys).select(*on, "id", "name_id").distinct()
    met = tried.join(texts.select(*on, "id", "text"), [*on, "id"]).join(names.select(*on, "name_id", "name"), [*on, "name_id"]).where(F.contains("text", "name"))
    return met.select(*on, "id", "name_id").distinct()
