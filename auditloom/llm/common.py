"""What the operators of this subpackage share: scratch tables, running totals, components."""

from __future__ import annotations

import atexit
import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: ASCII white space; words are what lies between.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Rows and bytes of an Arrow batch: whole texts may be long, and a Python worker holds a batch at a time.
ARROW_ROWS = 256
ARROW_BYTES = 1 << 22
#: 64-bit keys that may be broadcast: some ten megabytes as a hash table.
FEW_KEYS = 250_000

_paths: dict[str, SparkSession] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; where it is unset, as in tests, a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        found = tempfile.mkdtemp(prefix="auditloom-")
        spark.sparkContext.setCheckpointDir(found)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def removed(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _forget(spark: SparkSession, path: str) -> None:
    name = path.rsplit("/", 1)[-1]
    if name.startswith("scratch_"):  # bucketed() keeps a table of that name
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    removed(spark, path)


def saved(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read back: lineage is cut, a lost executor loses nothing."""
    spark, path = df.sparkSession, f"{shared_folder(df.sparkSession)}/scratch-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[path], out._scratch = spark, path
    return out


def bucketed(df: DataFrame, *keys: str, dealt: bool = False) -> DataFrame:
    """df as a table in the shared folder, bucketed and sorted by keys: joins on them read it without a shuffle.

    dealt: df's rows lie by such buckets already, as those that come from another such table do.
    """
    spark, name, n = df.sparkSession, f"scratch_{uuid.uuid4().hex}", shuffle_parts(df.sparkSession)
    path = f"{shared_folder(spark)}/{name}"
    (df if dealt else df.repartition(n, *keys)).write.format("parquet").bucketBy(n, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    out = spark.table(name)
    _paths[path], out._scratch = spark, path
    return out


def dropped(*frames: DataFrame) -> None:
    """Deletes the tables behind frames that saved() made and no later plan reads."""
    for df in frames:
        if spark := _paths.pop(path := getattr(df, "_scratch", None), None):
            _forget(spark, path)


@atexit.register
def _sweep() -> None:
    for path, spark in list(_paths.items()):
        try:
            _forget(spark, path)
        except Exception:  # the session may be gone, and its folder with it
            return


def python_batches(spark: SparkSession) -> None:
    """Keeps the session's Arrow batches small enough for long texts; plans are run later, so the setting stays."""
    for name, most in (("maxRecordsPerBatch", ARROW_ROWS), ("maxBytesPerBatch", ARROW_BYTES)):
        if int(spark.conf.get(f"spark.sql.execution.arrow.{name}").rstrip("bB")) > most:
            spark.conf.set(f"spark.sql.execution.arrow.{name}", most)


def frugal(stage: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """A stage's function of batches that returns freed memory to the system at its end: Spark reuses the worker for other stages."""

    @functools.wraps(stage)
    def run(*args, **kwargs) -> Iterator:
        try:
            yield from stage(*args, **kwargs)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return run


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(right[k])
    return on


def narrowed(docs: DataFrame, used: list[str]) -> DataFrame:
    """docs with the used columns and all others in one, ``rest_columns``, so that no name of theirs meets a name of ours."""
    others = [docs[c].alias(c) for c in docs.columns if c not in used]
    rest = F.struct(*others) if others else F.lit(None).cast("boolean")
    return docs.select(*used, rest.alias("rest_columns"))


def widened(docs: DataFrame, names: list[str], used: list[str]) -> DataFrame:
    """The columns of the frame that narrowed() got, in its order."""
    return docs.select(*[F.col(n) if n in used else F.col("rest_columns").getField(n).alias(n) for n in names])


def without_rows(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """rows but for those whose key gone holds. Few keys go to the rows, beyond ``FEW_KEYS`` both sides are dealt by key; texts travel only then."""
    gone = saved(gone)
    few = gone.count() <= FEW_KEYS
    return rows.join(F.broadcast(gone) if few else gone.hint("merge"), key, "left_anti")


def running_all(df: DataFrame, order: list[Column], keys: list[str], amounts: tuple[str, ...]) -> DataFrame:
    """df with ``_before<amount>`` for each of amounts: its sum over the rows of the same keys that come earlier in order.

    Rows are range-partitioned by keys and order, so that a hot key spreads over many tasks; each range
    adds what the ranges before it hold of the key. Only those sums (one a range and key) meet in one
    window. Rows that tie in keys and order share a range; their order among themselves is arbitrary.
    """
    n = shuffle_parts(df.sparkSession)
    dealt = saved(df.repartitionByRange(n, *[F.col(k).asc_nulls_last() for k in keys], *order).withColumn("_part", F.spark_partition_id()))
    inner = Window.partitionBy("_part", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    dealt_in = dealt.select("*", *[F.coalesce(F.sum(a).over(inner), F.lit(0)).alias(f"_inner{i}") for i, a in enumerate(amounts)])
    outer = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("_part", *keys).agg(*[F.sum(a).alias(f"_sum{i}") for i, a in enumerate(amounts)])
    sums = sums.select("*", *[F.coalesce(F.sum(f"_sum{i}").over(outer), F.lit(0)).alias(f"_outer{i}") for i in range(len(amounts))])
    sums = sums.select(F.col("_part").alias("_p"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[f"_outer{i}" for i in range(len(amounts))])
    on = dealt_in["_part"] == sums["_p"]
    for i, k in enumerate(keys):
        on = on & dealt_in[k].eqNullSafe(sums[f"_k{i}"])
    return dealt_in.join(sums, on).select(*df.columns, *[(F.col(f"_inner{i}") + F.col(f"_outer{i}")).alias(f"_before{a}") for i, a in enumerate(amounts)])


def running(df: DataFrame, order: list[Column], keys: list[str], amount: str) -> DataFrame:
    """running_all() of one amount, as ``_before``."""
    return running_all(df, order, keys, (amount,)).withColumnRenamed(f"_before{amount}", "_before")


def components(links: DataFrame) -> DataFrame:
    """(node, label) for each node of links (a, b): label is the smallest node that links reach.

    Labels fall to the least label among neighbours and then jump to that label's own label, so chains
    shorten by half a round. Every round is written to the shared folder; only a count comes back.
    """
    both = saved(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("label")), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("next"))
        fresh = saved(step.join(jump, "low", "left").select("node", F.col("label").alias("old"), F.least("low", F.coalesce("next", "low")).alias("label")))
        moved = fresh.filter("old <> label").limit(1).count()
        dropped(labels)
        labels = fresh
        if not moved:
            dropped(both)
            out = labels.select("node", "label")
            out._scratch = labels._scratch
            return out
