"""Exact dedup against a persistent digest index (DataFrame operations only).

The index is a table of one row per distinct text, bucketed by the text's digest and sorted in each
bucket. A batch is reduced to one row per digest before any join; a sort-merge anti-join with the
index, whose side needs no exchange, leaves the digests that are new, and these are appended. Later
batches therefore move only their own digests, never the index.

A batch has a name. Adding it again, as after a job that was lost halfway, appends nothing that the index
holds and keeps the same rows: what a batch may keep are the digests that stand under its name.

Defined results: a null text counts as empty; texts are equal when identical after each run of ASCII
white space becomes one space. Of equal texts in one batch the row with the smallest doc_id stays (null
ids after all others; of rows that tie, one); a digest that an earlier batch added keeps that batch's
row and drops all of the new ones. An empty batch adds nothing. Other columns are left alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from auditloom.llm.common import SPACES, dropped, narrowed, removed, saved, shared_folder, widened, without_rows

#: Batches that a table is added in where the caller names none.
BATCHES = 2


def normal_text(text: str = "text"):
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACES, " ")


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(_row, _id, digest), written once: the text is read and hashed a single time; _row tells repeated rows apart."""
    return saved(docs.select(F.col(doc_id).alias("_id"), F.unhex(F.sha2(normal_text(text), 256)).alias("digest")).withColumn("_row", F.monotonically_increasing_id()))


class DigestIndex:
    """A digest table (digest, keep_id, batch) bucketed and sorted by digest. Without a name it is one of its own in the shared folder, for the caller to drop."""

    def __init__(self, spark: SparkSession, table: str | None = None, buckets: int | None = None, path: str | None = None):
        self.spark, self.table, self.path = spark, table or f"digest_index_{uuid.uuid4().hex}", path
        self.scratch = None if table or path else f"{shared_folder(spark)}/{self.table}"
        self.path = self.path or self.scratch
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def extend(self, rows: DataFrame, batch: str) -> None:
        """Appends the digests of rows (of digests()) that the index lacks."""
        first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"))).alias("first")
        fresh = rows.groupBy("digest").agg(first).select("digest", F.col("first.id").alias("keep_id"), F.lit(batch).alias("batch"))
        if self.exists():
            fresh = fresh.join(self.read().select("digest").hint("merge"), "digest", "left_anti")
        out = fresh.write.bucketBy(self.buckets, "digest").sortBy("digest").format("parquet").mode("append")
        (out.option("path", self.path) if self.path else out).saveAsTable(self.table)

    def resolved(self, rows: DataFrame, batches: list[str]) -> DataFrame:
        """rows, added under these batches, with keep_id, group_size, kept.

        group_size counts these rows with that digest; kept is the first of them where one of these batches added the digest.
        """
        first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_row").alias("row"))).alias("first")
        groups = rows.groupBy("digest").agg(first, F.count(F.lit(1)).alias("group_size"))
        owner = groups.join(self.read().hint("merge"), "digest").select("digest", "keep_id", "group_size", F.when(F.col("batch").isin(*batches), F.col("first.row")).alias("stays"))
        known = rows.join(owner, "digest")
        return known.select("_row", "_id", "digest", "keep_id", "group_size", F.col("_row").eqNullSafe(F.col("stays")).alias("kept"))

    def add(self, rows: DataFrame, batch: str) -> DataFrame:
        """One batch: extend() and resolved()."""
        self.extend(rows, batch)
        return self.resolved(rows, [batch])

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        if self.scratch:
            removed(self.spark, self.scratch)


def in_batches(rows: DataFrame, batches: int) -> list[DataFrame]:
    """rows by ascending id, null ids last, in so many parts of about equal size; where ids aren't numbers by digest, so that equal texts share a part."""
    if batches < 2:
        return [rows]
    if not isinstance(rows.schema["_id"].dataType, NumericType):
        return [rows.filter(F.pmod(F.xxhash64("digest"), F.lit(batches)) == k) for k in range(batches)]
    edges = rows.agg(F.percentile_approx("_id", [k / batches for k in range(1, batches)])).first()[0] or []
    cuts = [None, *sorted(set(edges)), None]
    parts = []
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        within = F.lit(True) if lo is None else F.col("_id") > F.lit(lo)
        parts.append(rows.filter(F.coalesce(within & (F.lit(True) if hi is None else F.col("_id") <= F.lit(hi)), F.lit(hi is None))))
    return parts


def added(rows: DataFrame, index: DigestIndex | None, batch: str | None, batches: int) -> DataFrame:
    """resolved() rows, written; without an index, one of their own that earlier parts fill before later ones meet it."""
    if index is not None:
        return saved(index.add(rows, batch or uuid.uuid4().hex))
    index = DigestIndex(rows.sparkSession)
    try:
        parts = in_batches(rows, batches)
        for k, part in enumerate(parts):
            index.extend(part, str(k))
        return saved(index.resolved(rows, [str(k) for k in range(len(parts))]))
    finally:
        index.drop()


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None, batches: int = BATCHES) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), a row for each of docs' rows.

    With an index, docs are one batch of it; without, they go to an index of their own in ascending batches.
    """
    rows = digests(docs)
    out = added(rows, index, batch, batches)
    dropped(rows)
    return out.select(F.col("_id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def distinct_documents(docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None, batches: int = BATCHES) -> DataFrame:
    """The rows of docs that stay, with docs' own columns: of rows that repeat id and text, one stays."""
    used = ["doc_id", "text"]
    rows = saved(narrowed(docs, used).withColumn("_row", F.monotonically_increasing_id()))
    keys = saved(rows.select("_row", F.col("doc_id").alias("_id"), F.unhex(F.sha2(normal_text(), 256)).alias("digest")))
    gone = added(keys, index, batch, batches).filter("not kept").select("_row")
    dropped(keys)
    return widened(without_rows(rows, gone, "_row"), docs.columns, used)
