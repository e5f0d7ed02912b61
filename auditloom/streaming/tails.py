"""Logs that come in parts, line by line with the repository that the last marker named (T-03, S-25, W-03).

A part is a row (log, part, text), parts of a log numbered from 0; a file that a writer has closed, read whole. They may be cut
anywhere, within a line too, and may come in any order and any micro-batch: state holds, for each log, the number of
the part that is due, the end of a line not finished, the repository in force, and the parts that came too early.
The lines that come out, and all that is counted of them, are those of the uncut log.

Defined results: a line counts once it has ended; a part that comes again is passed over; a null text is empty;
lines before the first marker have a null repository. State grows with the parts that wait, not with the log.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

LINE = "log string, line_no long, repository string, line string"


def parts(spark: SparkSession, path: str, name: str = r"([^/]+?)\.(\d+)$") -> DataFrame:
    """Files of a folder as a stream of parts; the pattern's groups give a file's log and part."""
    rows = spark.readStream.format("text").option("wholetext", True).load(path).withColumn("_file", F.col("_metadata.file_path"))
    return rows.select(F.regexp_extract("_file", name, 1).alias("log"), F.regexp_extract("_file", name, 2).cast("int").alias("part"), F.col("value").alias("text"))


class Tail(StatefulProcessor):
    """The lines of a log with the repository in force."""

    def __init__(self, marker: str):
        self.marker = marker

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("log", "due int, rest string, repository string, lines long")
        self.early = handle.getMapState("early", "part int", "text string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        due, rest, repository, number = self.state.get() if self.state.exists() else (0, "", None, 0)
        for r in rows:
            if r.part >= due:
                self.early.updateValue((r.part,), (r.text or "",))
        marker = re.compile(self.marker)
        while self.early.containsKey((due,)):
            *lines, rest = (rest + self.early.getValue((due,))[0]).split("\n")
            self.early.removeKey((due,))
            due += 1
            for line in lines:
                if m := marker.search(line):
                    repository = m[1]
                yield Row(log=key[0], line_no=number, repository=repository, line=line)
                number += 1
        self.state.update((due, rest, repository, number))

    def close(self) -> None:
        pass


def lines(log_parts: DataFrame, marker: str) -> DataFrame:
    """LINE of a stream of parts; the marker's first group names a repository, from its own line on."""
    return log_parts.groupBy("log").transformWithState(Tail(marker), LINE, "Append", "None")
