"""Stages as streams, each over what the one before has written, ending one after another (T-01, T-05, T-08).

Every stage reads its predecessor's folder of Parquet files as a stream and appends to its own, exactly once by
its checkpoint. All stages of a chain run at the same time, each on what has come so far. A folder that will
grow no more holds an end mark. A stage ends after it has taken all of a folder that was marked before it
looked, and marks its own, so the end passes down the chain. A chain that is run again, after whatever stopped
it, passes over marked stages and goes on with the others where their checkpoints stand.

Defined results: an empty source gives empty folders with their marks; a stage that fails ends the run with its
error, and leaves what it has committed.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from dataclasses import dataclass
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

END = "_ended"


@dataclass
class Stage:
    """A name, what it makes of its rows, and the schema of those."""

    name: str
    made: Callable[[DataFrame], DataFrame]
    schema: StructType | str


def _file(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def ended(spark: SparkSession, folder: str) -> bool:
    """Whether the folder will grow no more."""
    files, place = _file(spark, f"{folder}/{END}")
    return files.exists(place)


def end(spark: SparkSession, folder: str) -> None:
    """Marks the folder as one that will grow no more."""
    files, place = _file(spark, f"{folder}/{END}")
    files.mkdirs(place.getParent())
    files.create(place, True).close()


def drain(spark: SparkSession, stage: Stage, source: str, target: str, checkpoint: str, stop: Event, wait_s: float = 0.5) -> None:
    """Takes what comes to source until it has ended and all of it is taken."""
    while not ended(spark, target):
        last = ended(spark, source)  # before the look at the files: what is written later isn't missed
        files, place = _file(spark, source)
        if files.exists(place):
            rows = stage.made(spark.readStream.schema(stage.schema).parquet(source))
            query = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)
            query.awaitTermination()
        if last:
            end(spark, target)
        elif stop.wait(wait_s):
            return


def run(spark: SparkSession, stages: list[Stage], source: str, folder: str) -> dict[str, str]:
    """Runs the stages until the source's end has passed through all; (name: folder) of what they wrote, below folder."""
    targets = {s.name: f"{folder}/{k}-{s.name}" for k, s in enumerate(stages)}
    sources, stop = [source, *targets.values()], Event()
    with ThreadPoolExecutor(len(stages)) as pool:
        jobs = [pool.submit(drain, spark, s, sources[k], targets[s.name], f"{folder}/checkpoints/{s.name}", stop) for k, s in enumerate(stages)]
        done, _ = wait(jobs, return_when=FIRST_EXCEPTION)
        stop.set()
    for job in jobs:
        job.result()
    return targets
