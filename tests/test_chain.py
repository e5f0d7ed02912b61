"""A chain of stages: the end passes down, and a run after any failure gives the same tables."""

import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from auditloom.streaming import chain

SCHEMA = "id long, word string"


def land(spark, source, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)


def stages(broken=None, mark=None):
    """Three stages; the broken one fails once on a row with id 3."""

    def checked(name, df):
        if name != broken:
            return df

        def fail(batches):
            for b in batches:
                if 3 in b.column("id").to_pylist() and not os.path.exists(mark):
                    open(mark, "w").close()
                    raise RuntimeError("lost")
                yield b

        return df.mapInArrow(fail, df.schema)

    return [
        chain.Stage("found", lambda d: checked("found", d.where("word <> ''")), SCHEMA),
        chain.Stage("shown", lambda d: checked("shown", d.withColumn("word", F.upper("word"))), SCHEMA),
        chain.Stage("kept", lambda d: checked("kept", d.where("id % 2 = 1")), SCHEMA),
    ]


def tables(spark, targets):
    return {n: sorted(tuple(r) for r in spark.read.schema(SCHEMA).parquet(p).collect()) for n, p in targets.items()}


ROWS = [(i, "" if i % 4 == 0 else f"w{i}") for i in range(12)]
WANT = {"found": [r for r in ROWS if r[1]], "shown": [(i, w.upper()) for i, w in ROWS if w], "kept": [(i, w.upper()) for i, w in ROWS if w and i % 2]}


def test_end_passes_down(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")

    def feed():
        for k in range(0, 12, 4):
            time.sleep(1)
            land(spark, source, ROWS[k : k + 4])
        chain.end(spark, source)

    thread = threading.Thread(target=feed)
    thread.start()
    targets = chain.run(spark, stages(), source, folder)
    thread.join()
    assert tables(spark, targets) == WANT and all(chain.ended(spark, p) for p in targets.values())
    assert tables(spark, chain.run(spark, stages(), source, folder)) == WANT


@pytest.mark.parametrize("broken", ["found", "shown", "kept"])
def test_run_again_after_failure(spark, tmp_path, broken):
    source, folder, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    for k in range(0, 12, 2):
        land(spark, source, ROWS[k : k + 2])
    chain.end(spark, source)
    with pytest.raises(Exception, match="lost|STREAM_FAILED|PythonException"):
        chain.run(spark, stages(broken, mark), source, folder)
    assert not chain.ended(spark, f"{folder}/2-kept")
    assert tables(spark, chain.run(spark, stages(broken, mark), source, folder)) == WANT


def test_empty_source(spark, tmp_path):
    source = str(tmp_path / "in")
    chain.end(spark, source)
    targets = chain.run(spark, stages(), source, str(tmp_path / "out"))
    assert all(chain.ended(spark, p) for p in targets.values())
