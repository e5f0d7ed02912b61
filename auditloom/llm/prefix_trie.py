"""The prefix trie of conversations, by each conversation's first owned depth.

Turns get digests before anything moves; texts never do. A prefix's digest is made of running sums over
the digests of its turns with their places, so that a conversation of any length spreads over tasks. Of
the conversations that share a prefix the smallest id owns its node. Whoever owns a prefix owns all its
longer ones, so that a binary search finds each conversation's first owned depth: a round looks up one
prefix of each conversation still open, by a join with the bucketed prefixes, and that prefix's owner, by a
join with the bucketed minima; the number of rounds is the logarithm of the longest conversation. The last
prefix found to be another's is the parent. What a conversation owns is a chain of nodes; the chains,
each under its parent, are the tree. Sums go up along a chain first and then, one row for each prefix
above it, to all that stands above, in one aggregation whatever the nesting of chains.

Defined results: rows without conv_id are left out; a null role or text is empty; turns go by number,
null first, those that tie by the digest of role and text; rows that repeat are turns of their own; an
empty table has no root and gives no row. Columns other than the four are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.llm.common import bucketed, dropped, frugal, python_batches, running, running_all, saved, shuffle_parts

#: Ids that one row of members holds at most, on their way to their digest.
CHUNK = 4096
_SUMS = ("_s0", "_s1", "_s2", "_s3")


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, place from 0, content, n_chars): each turn's place, the digest of its role and text, its code points."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    content = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = conversations.where("conv_id is not null").select("conv_id", "turn", content.alias("content"), F.char_length(text).cast("long").alias("n_chars"), F.lit(1).alias("_one"))
    return running(rows, [F.col("turn").asc_nulls_first(), F.col("content")], ["conv_id"], "_one").select("conv_id", F.col("_before").cast("long").alias("place"), "content", "n_chars")


def with_heads(turns: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Turns (of numbered()) in which conversation c begins with the first h turns of c - c % every in place of its own; and all ids.

    h is the CRC-32 of c in decimals modulo most; an absent conversation gives none. At most every - 1
    conversations on either side of zero take one's head, so the join's groups are bounded.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    sizes = saved(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")))
    base = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("there"))
    wants = sizes.select("conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), h.alias("h")).join(base, "base", "left")
    wants = saved(wants.select("conv_id", "base", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("lead")))
    heads = turns.where((F.col("conv_id") % every == 0) & (F.col("place") < most - 1)).withColumnRenamed("conv_id", "base")
    moved = wants.where("lead > 0").join(heads, "base").where("place < lead")
    own = turns.join(wants, "conv_id").where("place >= h").withColumn("place", F.col("place") - F.col("h") + F.col("lead"))
    names = ["conv_id", "place", "content", "n_chars"]
    return moved.select(names).union(own.select(names)), wants.select("conv_id")


def prefixes(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """(conv_id, depth, digest, n_chars) for depth 0 and each turn, bucketed by conversation and depth; n_chars is the last turn's."""
    placed = F.sha2(F.concat(F.col("place").cast("string").cast("binary"), F.col("content")), 256)
    pieces = [F.conv(F.substring("_placed", 8 * k + 1, 8), 16, 10).cast("long").alias(s) for k, s in enumerate(_SUMS)]
    rows = turns.withColumn("_placed", placed).select("conv_id", "place", "n_chars", *pieces)
    summed = running_all(rows, [F.col("place")], ["conv_id"], _SUMS)
    depth = F.col("place") + 1
    digest = lambda depth, *sums: F.unhex(F.md5(F.concat_ws("-", depth, *sums).cast("binary")))
    deep = summed.select("conv_id", depth.alias("depth"), digest(depth, *[F.col(s) + F.col(f"_before{s}") for s in _SUMS]).alias("digest"), "n_chars")
    root = ids.select("conv_id", F.lit(0).cast("long").alias("depth"), digest(F.lit(0)).alias("digest"), F.lit(0).cast("long").alias("n_chars"))
    return bucketed(deep.union(root), "conv_id", "depth")


def first_owned(paths: DataFrame, minima: DataFrame) -> DataFrame:
    """(conv_id, length, first, above): the first depth that a conversation owns, length + 1 where none, and the owner of the prefix before it."""
    lengths = paths.groupBy("conv_id").agg(F.max("depth").alias("length"))
    none = F.lit(None).cast(paths.schema["conv_id"].dataType)
    state = saved(lengths.select("conv_id", "length", F.lit(0).cast("long").alias("first"), (F.col("length") + 1).alias("last"), none.alias("above")))
    found = None
    while True:
        done, still = state.where("first = last"), state.where("first < last")
        found = done if found is None else found.union(done)
        if not still.limit(1).count():
            return found.drop("last")
        probed = still.withColumn("depth", F.expr("(first + last) div 2")).join(paths.select("conv_id", "depth", "digest"), ["conv_id", "depth"]).join(minima.select("digest", "owner"), "digest")
        own = F.col("owner") == F.col("conv_id")
        step = probed.select(
            "conv_id", "length", F.when(own, F.col("first")).otherwise(F.col("depth") + 1).alias("first"),
            F.when(own, F.col("depth")).otherwise(F.col("last")).alias("last"), F.when(own, F.col("above")).otherwise(F.col("owner")).alias("above"),
        )
        state = saved(step)


@frugal
def _chunks(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (digest, conv_id) to rows of at most CHUNK ids, comma-joined."""
    digest, ids, out = None, [], ([], [], [])

    def close() -> None:
        if ids:
            for column, value in zip(out, (digest, int(ids[0]), ",".join(ids)), strict=True):
                column.append(value)

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())], ["digest", "first_id", "ids"])
        for column in out:
            column.clear()
        return made

    for part in parts:
        for d, i in zip(part.column("digest").to_pylist(), part.column("conv_id").to_pylist(), strict=True):
            if d != digest or len(ids) >= CHUNK:
                close()
                digest, ids = d, []
            ids.append(str(i))
        if len(out[0]) >= 256:
            yield batch()
    close()
    if out[0]:
        yield batch()


@frugal
def _hashed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ids sorted by (digest, first_id) to one SHA-256 a digest; the hash takes the rows as they come."""
    digest, state = None, None
    for part in parts:
        keys, sums = [], []
        for d, ids in zip(part.column("digest").to_pylist(), part.column("ids").to_pylist(), strict=True):
            if d == digest:
                state.update(b",")
            else:
                if state:
                    keys.append(digest)
                    sums.append(state.hexdigest())
                digest, state = d, hashlib.sha256()
            state.update(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sums, pa.string())], ["digest", "ends_sha256"])
    if state:
        yield pa.RecordBatch.from_arrays([pa.array([digest], pa.binary()), pa.array([state.hexdigest()])], ["digest", "ends_sha256"])


def ends(paths: DataFrame, lengths: DataFrame) -> DataFrame:
    """(digest, ends_sha256) of the prefixes at which conversations end.

    Ranges of (digest, id) write their ids as text first, so that the one task that a SHA-256 needs reads
    a row for each CHUNK members, and holds one of them at a time.
    """
    python_batches(paths.sparkSession)
    last = lengths.select("conv_id", F.col("length").alias("depth")).join(paths, ["conv_id", "depth"]).select("digest", "conv_id")
    n = shuffle_parts(paths.sparkSession)
    chunks = last.repartitionByRange(n, "digest", "conv_id").sortWithinPartitions("digest", "conv_id").mapInArrow(_chunks, "digest binary, first_id long, ids string")
    return chunks.repartition(n, "digest").sortWithinPartitions("digest", "first_id").mapInArrow(_hashed, "digest binary, ends_sha256 string")


def trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """The nodes of the trie of turns (conv_id, place, content, n_chars) of conversations ids (conv_id; those without turns too).

    Per node conv_id (owner), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    paths = prefixes(turns, ids)
    minima = bucketed(paths.groupBy("digest").agg(F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs")), "digest")
    searched = saved(first_owned(paths, minima))
    attached = searched.where("first > 0 and first <= length").groupBy(F.col("above").alias("conv_id"), (F.col("first") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_attached"))
    attached = saved(attached)
    ended = attached.select("conv_id", F.col("depth").alias("length"), F.lit(0).cast("long").alias("leaf"))
    chains = searched.where("first <= length").join(ended, ["conv_id", "length"], "left").withColumn("leaf", F.coalesce("leaf", F.lit(1).cast("long")))
    chains = saved(chains.select("conv_id", "length", "first", "above", "leaf"))

    owned = paths.join(chains, "conv_id").where("depth >= first").join(minima.select("digest", "n_convs"), "digest")
    nodes = running(owned.withColumn("_own", (F.col("n_convs") - 1) * F.col("n_chars")), [F.col("depth").desc()], ["conv_id"], "_own")
    nodes = saved(nodes.withColumn("_saved", F.col("_own") + F.col("_before")))
    heads = chains.join(nodes.where("depth = first").select("conv_id", "_saved"), "conv_id").select("conv_id", "first", "leaf", F.col("_saved").alias("_gives"))
    above = paths.select("conv_id", "depth", "digest").join(heads, "conv_id").where("depth < first")
    above = above.groupBy("digest").agg(F.sum("leaf").alias("_leaves"), F.sum("_gives").alias("_below"))

    zero = F.lit(0).cast("long")
    both = nodes.join(attached, ["conv_id", "depth"], "left").join(above, "digest", "left").join(ends(paths, searched), "digest", "left")
    out = saved(both.select(
        F.col("conv_id").cast("long").alias("conv_id"), "depth", F.when(F.col("depth") > F.col("first"), F.col("conv_id")).otherwise(F.col("above")).cast("long").alias("parent_conv_id"), "n_convs",
        (F.coalesce("n_attached", zero) + (F.col("depth") < F.col("length")).cast("long")).alias("n_children"), (F.col("leaf") + F.coalesce("_leaves", zero)).alias("n_leaves"),
        (F.col("_saved") + F.coalesce("_below", zero)).alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    ))
    dropped(paths, minima, searched, attached, chains, nodes)
    return out


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """trie() of conversations (conv_id, turn, role, text) as they are."""
    turns = saved(numbered(conversations))
    out = trie(turns, turns.select("conv_id").distinct())
    dropped(turns)
    return out
