"""Order-sensitive functions: attempt numbers, carried values, frames, monotonic runs, batches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def attempts(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return rows.withColumn("attempt", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)


def carried(rows: DataFrame, keys: list[str], order: list[Column], value: Column, name: str) -> DataFrame:
    """The last value that isn't null, at this row or before."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(w))


def near_match(rows: DataFrame, keys: list[str], order: list[Column], match: Column, before: int, after: int, name: str = "near") -> DataFrame:
    """Whether a row in the frame around this one matches."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-after, before)
    return rows.withColumn(name, F.max(match.cast("int")).over(w) == 1)


def head_and_tail(rows: DataFrame, keys: list[str], order: str, head: int, tail: int) -> DataFrame:
    up, down = Window.partitionBy(*keys).orderBy(order), Window.partitionBy(*keys).orderBy(F.desc(order))
    return rows.withColumn("_up", F.row_number().over(up)).withColumn("_down", F.row_number().over(down)).where((F.col("_up") <= head) | (F.col("_down") <= tail)).drop("_up", "_down")


def non_decreasing(rows: DataFrame, keys: list[str], order: list[Column], value: str) -> DataFrame:
    """Each key's number of values and whether none falls below the one before."""
    w = Window.partitionBy(*keys).orderBy(*order)
    step = rows.withColumn("_ok", F.coalesce(F.col(value) >= F.lag(value).over(w), F.lit(True)))
    return step.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.bool_and("_ok").alias("monotonic"))


def greedy_batches(rows: DataFrame, key: str, order: str, size: str, most_size: int, most_rows: int) -> DataFrame:
    """rows with batch: a key's rows in order, a new batch where the next row would pass either limit.

    Batches reset their sums, which no window frame states. Rows stream through a task sorted by key, so
    a key's rows are never held together.
    """

    def deal(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, batch, held, count = object(), 0, 0, 0
        for part in parts:
            numbers = []
            for k, n in zip(part[key].tolist(), part[size].tolist(), strict=True):
                if k != current:
                    current, batch, held, count = k, 0, 0, 0
                elif held + n > most_size or count + 1 > most_rows:
                    batch, held, count = batch + 1, 0, 0
                held, count = held + n, count + 1
                numbers.append(batch)
            yield part.assign(batch=numbers)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.repartition(key).sortWithinPartitions(key, order).mapInPandas(deal, f"{schema}, batch int")
