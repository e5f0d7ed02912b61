"""Sinks: idempotent appends, insert-if-absent registries, manifests, summaries, updates."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def overwrite_lines(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def existing(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table at path, empty where there is none yet."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
    return spark.read.schema(schema).json(path) if there else spark.createDataFrame([], schema)


def append_unseen(rows: DataFrame, path: str, key: str = "instance_id") -> None:
    """Appends rows whose key the table lacks. A batch isn't made distinct within itself; callers do that."""
    old = existing(rows.sparkSession, path, rows.schema).select(key)
    rows.join(old.distinct(), key, "left_anti").select(*rows.columns).write.mode("append").json(path)


def insert_absent(registry: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """The registry with one row for each key that is new."""
    first = fresh.dropDuplicates([key]).join(registry.select(key), key, "left_anti")
    return registry.unionByName(first.select(*registry.columns))


def updated(rows: DataFrame, values: DataFrame, key: str, column: str) -> DataFrame:
    """rows with column replaced where values has one for the key."""
    new = values.select(key, F.col(column).alias("_new"))
    return rows.join(new, key, "left").withColumn(column, F.coalesce("_new", column)).select(*rows.columns)


def manifest(candidates: DataFrame, spec: dict[str, str]) -> DataFrame:
    """What a remote run needs of each candidate with both patches."""
    fine = (F.coalesce("patch", F.lit("")) != "") & (F.coalesce("test_patch", F.lit("")) != "")
    return candidates.where(fine).select("instance_id", "repo", "base_commit", "patch", "test_patch", F.struct(*[F.lit(v).alias(k) for k, v in spec.items()]).alias("spec"))


def summary(rows: DataFrame) -> DataFrame:
    sets = [F.array_sort(F.collect_set(c)).alias(n) for c, n in (("repo", "repos"), ("language", "languages"))]
    return rows.agg(F.count(F.lit(1)).alias("n"), *sets)


def nested_runs(trials: DataFrame) -> DataFrame:
    """One row a model: its instances, each with its attempts in order."""
    attempts = trials.groupBy("model", "instance_id").agg(F.array_sort(F.collect_list(F.struct("attempt", "resolved", "cost_usd"))).alias("attempts"))
    return attempts.groupBy("model").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("instance_id", "attempts")))).alias("runs"))


def write_directories(rows: DataFrame, root: str, key: str, files: dict[str, str]) -> DataFrame:
    """A directory a row with a file a column; (key, error) of all rows, error null where it went well.

    root must be a path that executors share as a mounted folder. A file is renamed into place, so a task
    that runs again leaves one whole copy.
    """
    columns = list(files.values())

    def write(parts):
        for part in parts:
            errors = []
            for row in part.to_dict("records"):
                try:
                    folder = os.path.join(root, str(row[key]))
                    os.makedirs(folder, exist_ok=True)
                    for name, column in files.items():
                        temporary = os.path.join(folder, f".{uuid.uuid4().hex}")
                        with open(temporary, "w") as f:
                            f.write(row[column] or "")
                        os.replace(temporary, os.path.join(folder, name))
                    errors.append(None)
                except OSError as e:
                    errors.append(str(e))
            yield part[[key]].assign(error=errors)

    return rows.select(key, *columns).mapInPandas(write, f"{key} string, error string")
