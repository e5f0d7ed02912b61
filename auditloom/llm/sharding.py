"""Sharding by a consistent-hash ring with virtual nodes and bounded loads (DataFrame operations only).

Every shard owns ``vnodes`` points of a ring of 64-bit positions; a row lies where its text's hash
falls, and belongs to the next point clockwise. A shard holds at most its share; rows beyond it go on
clockwise to the next point whose shard has room. With ``slack`` 0 the shares sum to the number of
rows and differ by one at most, so the law ``rows`` holds exactly. Another shard adds points but moves
none, so that rows leave their shard only for the new one's arcs or where the smaller shares overflow.

Only the number of rows in each arc (shards x vnodes numbers) reaches the driver, which decides which
ranks of an arc go where. Rows find their rank in their arc by range partitions, so an arc that holds
a third of all rows, of one text even, spreads over tasks and, as far as the shares demand, shards.

Defined results: a null text is empty (size 1); equal texts are neighbours on the ring, ordered by
doc_id, nulls last, so a group stays together unless a shard fills up; repeated rows count each;
an empty table gives no row.
"""

from __future__ import annotations

from collections import defaultdict

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditloom.llm.common import running, saved

VNODES = 32


def ring(shards: int, vnodes: int = VNODES, seed: int = 0) -> list[tuple[int, int]]:
    """(position, shard), clockwise; a shard's points don't depend on how many shards there are."""
    return sorted((xxhash.xxh64_intdigest(f"{s}/{v}", seed) - (1 << 63), s) for s in range(shards) for v in range(vnodes))


def arc_of(position: Column, points: list[int]) -> Column:
    """Index of the first point at or after the position; beyond the last, 0. A search tree of comparisons."""

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo % len(points))
        mid = (lo + hi) // 2
        return F.when(position <= F.lit(points[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(points))


def shares(rows: int, shards: int, slack: float) -> list[int]:
    if slack:
        return [-(-int(rows * (1 + slack) * 1_000_000) // (shards * 1_000_000)) + 1] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def plan(counts: dict[int, int], points: list[tuple[int, int]], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end, shard, first slot): where the ranks of each arc go."""
    room, used, out = list(room), [0] * len(room), []
    waiting = [(i, i, 0, counts[i]) for i in range(len(points)) if counts.get(i)]
    while waiting:
        left = []
        for arc, at, lo, hi in waiting:
            shard = points[at][1]
            if take := min(hi - lo, room[shard]):
                out.append((arc, lo, lo + take, shard, used[shard]))
                room[shard] -= take
                used[shard] += take
            if lo + take < hi:
                left.append((arc, (at + 1) % len(points), lo + take, hi))
        waiting = left
    return out


def shard(docs: DataFrame, shards: int = 8, vnodes: int = VNODES, slack: float = 0.0, seed: int = 0) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row of docs."""
    points = ring(shards, vnodes, seed)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("_at"))
    rows = saved(rows.withColumn("_arc", arc_of(F.col("_at"), [p for p, _ in points])).withColumn("_one", F.lit(1)))
    counts = defaultdict(int, {r["_arc"]: r["n"] for r in rows.groupBy("_arc").agg(F.count(F.lit(1)).alias("n")).collect()})
    pieces = plan(counts, points, shares(sum(counts.values()), shards, slack))
    table = docs.sparkSession.createDataFrame(pieces, "arc int, lo long, hi long, shard int, base long")
    ranked = running(rows, [F.col("_at"), F.col("doc_id").asc_nulls_last()], ["_arc"], "_one")
    on = (F.col("_arc") == F.col("arc")) & (F.col("_before") >= F.col("lo")) & (F.col("_before") < F.col("hi"))
    placed = ranked.join(F.broadcast(table), on)  # at most shards x vnodes x shards rows
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("base") + F.col("_before") - F.col("lo")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
