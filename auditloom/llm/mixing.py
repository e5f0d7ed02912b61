"""Mixing sources to target weights by capped water-filling (DataFrame operations only).

Sources share ``budget`` times all words by weight; none goes beyond ``epochs`` times its own words, and
what it leaves is shared by weight among the others until none is above. The level at which all shares
hold is found by rounds over the table of sources, of which two sums come back. A source then takes
each document a whole number of times, and the fraction that remains from its documents in seeded hash
order: whole documents up to the last, of which the first words fill the target.

Defined results: a null text has no words; null is a source of its own, last in order; empty documents
and sources take nothing; rows that repeat count each; an empty table gives no row. Reruns agree: the
order within a source is the md5 of seed and doc_id (then doc_id, then size).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.llm.common import SPACES, WORD, narrowed, running, saved, widened

WEIGHTS = (3.0, 1.0, 2.0)
BUDGET = 1.5
EPOCHS = 2
SEED = "mix"


def sizes(docs: DataFrame) -> DataFrame:
    return docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))


def targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, target) from rows with source and size."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("_one", F.lit(1))
    ranked = running(per, [F.col("source").asc_nulls_last()], [], "_one")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_before") % len(weights) + 1).cast("int"))
    table = saved(ranked.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * epochs).cast("double").alias("cap")))
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, clamped = 0.0, -1
    while True:
        over = F.col("cap") < F.col("weight") * F.lit(level)
        n, caps, free = table.agg(F.sum(over.cast("long")), F.sum(F.when(over, F.col("cap"))), F.sum(F.when(~over, F.col("weight")))).first()
        if n is None or n == clamped or not free:
            break
        clamped, level = n, (budget * total - (caps or 0.0)) / free
    return table.select("source", "source_size", F.least("cap", F.col("weight") * F.lit(level)).alias("target"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, epochs: int = EPOCHS, seed: str = SEED, carried: tuple[str, ...] = ()) -> DataFrame:
    """docs' rows with size, source_size, target and taken, the words that the mix takes of each; carried: columns that come along."""
    rows = saved(sizes(docs).select("doc_id", "source", "size", F.xxhash64("text").alias("_text"), *carried))
    goals = targets(rows, weights, budget, epochs)
    keyed = rows.withColumn("_order", F.md5(F.concat_ws("-", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary")))
    placed = running(keyed, [F.col("_order"), F.col("doc_id").asc_nulls_last(), F.col("size"), F.col("_text")], ["source"], "size")
    goals = goals.withColumnRenamed("source", "_source")
    both = placed.join(goals, F.col("source").eqNullSafe(F.col("_source")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    part = F.floor(F.col("target") - whole * F.col("source_size") - F.col("_before"))
    taken = whole * F.col("size") + F.greatest(F.lit(0), F.least(part, F.col("size")))
    return both.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"), *carried)


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: docs' rows as often as taken, the last one cut to the words that fill its source's target."""
    used = [c for c in ("doc_id", "text", "source", "n_chars") if c in docs.columns]
    rows = saved(narrowed(docs, used).withColumn("_row", F.monotonically_increasing_id()))
    takes = mix(rows.select("doc_id", "source", "text", "_row"), carried=("_row",), **how).select("_row", "size", "taken")
    whole = F.expr("cast(taken div greatest(size, 1) as int)")
    rest = F.col("taken") - whole * F.col("size")
    copies = takes.filter("taken > 0").select("_row", F.explode(F.concat(F.array_repeat(F.lit(0).cast("long"), whole), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<long>")))).alias("_words"))
    words = F.filter(F.split("text", SPACES), lambda w: w != "")
    first = F.array_join(F.slice(words, 1, F.greatest(F.col("_words"), F.lit(1)).cast("int")), " ")
    cut = F.when(F.col("_words") == 0, F.col("text")).otherwise(first)
    out = rows.join(copies, "_row").withColumn("text", cut)
    if "n_chars" in used:
        out = out.withColumn("n_chars", F.when(F.col("_words") == 0, F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return widened(out, docs.columns, used)
