"""Incremental forms: file streams whose checkpoint replaces sets of what was processed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from auditloom.sources.sinks import existing


def landed(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None, format: str = "json") -> DataFrame:
    """New files of a folder as a stream; the limit holds back how many are taken at once."""
    reader = spark.readStream.schema(schema).format(format)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def daily_totals(events: DataFrame, delay: str = "2 days") -> DataFrame:
    rows = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay).groupBy(F.window("ts", "1 day"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("value"))
    return rows.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n", "value")


def running_state(lines: DataFrame, key: str, status: str) -> DataFrame:
    """Counts by key and status, updated as lines come."""
    return lines.groupBy(key, status).agg(F.count(F.lit(1)).alias("n"))


def distinct_within(rows: DataFrame, key: list[str], time: str, delay: str) -> DataFrame:
    """The first row of each key; state older than the delay goes, so it doesn't grow for ever."""
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(key)


def with_cache(stream: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    return stream.join(cache, key)


def to_lines(stream: DataFrame, path: str, checkpoint: str, key: str = "instance_id") -> StreamingQuery:
    """All that has landed, each key once, a folder ``batch=<n>`` a batch (K-06).

    The keys seen are state of the stream, so that a batch reads nothing of what was written before; one
    that runs again overwrites its own folder.
    """
    once = stream.dropDuplicates([key])
    return once.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(lambda rows, n: rows.write.mode("overwrite").json(f"{path}/batch={n}")).start()


def stage(spark: SparkSession, source: str, schema: StructType, where: Column, columns: list[Column], path: str, checkpoint: str) -> StreamingQuery:
    """One stage of a chain: landed rows that meet the condition, projected, to the folder that the next stage reads."""
    rows = landed(spark, source, schema).where(where).select(*columns)
    return rows.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).format("json").start(path)


def snapshots(stream: DataFrame, path: str, checkpoint: str, key: str = "instance_id", every: str | None = None, keep: int = 2) -> StreamingQuery:
    """All rows so far, written anew with each batch as a folder of the batch's number; the folder with the largest is whole (K-15, T-09).

    A batch that runs again overwrites its own folder, which it makes from the one before it. Folders but the last ``keep`` go.
    """

    def write(rows: DataFrame, batch: int) -> None:
        before = existing(rows.sparkSession, f"{path}/{batch - 1}", rows.schema)
        fresh = rows.dropDuplicates([key])
        before.join(fresh.select(key), key, "left_anti").select(*rows.columns).unionByName(fresh).write.mode("overwrite").json(f"{path}/{batch}")
        old = rows.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{path}/{batch - max(keep, 2)}")
        old.getFileSystem(rows.sparkSession._jsc.hadoopConfiguration()).delete(old, True)

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
