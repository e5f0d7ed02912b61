"""N-gram Jaccard join by adaptive multi-match prefixes.

Documents with equal shingle sets are one class. All shingles are ordered by their count over the whole
corpus (from a count sketch of fixed width that every partition adds to) and by hash, rare ones first.
Two sets at the threshold share ``l`` shingles among the first n - ceil(threshold n) + l of both, for any
l; a document takes the l whose prefix costs least by those counts, candidates being fewer the more
shingles they must share. Pairs that share at least the smaller l of theirs, counted over the prefix
shingles that a round looks at, are verified on whole sets; no pair is verified on fewer.

A shingle that many classes hold in their prefix would give pairs by the square. So each shingle's
classes are compared with one of them first, the one whose prefix is held by most others. What follows
goes only across the components that the links found so far leave: all pairs where at most ``SMALL``
classes hold a shingle, else a few partners, then more, and at last all, of all shingles. A pair that a
round's shingles leave short of its number waits for the last one, which counts all. A large group of near copies falls
together after the first rounds, and no link between classes of different components is lost.

Shingles that more than ``HOT`` documents may hold are dealt in parts, and their partners to each part.
What classes hold lies in tables bucketed by shingle and part, so that rounds join and count it where it lies.
The sketch's counters go to the driver by way of compressed planes of bytes.
A pair is dropped before its texts are moved if the places of a shared shingle prove it too far apart:
what both hold before it is at most what either's prefix shares with anyone, and what they hold after
it at most what either has left. In the last round over frequent shingles it is dropped, too, if the sets'
marks prove it: of 256 bits each shingle turns one over, so that sets differ in at least as many shingles as
their marks in bits. Texts that share much, but too little, give no row then.

Defined results: null and empty texts, and texts of white space, have the empty set and link with
nothing; texts shorter than a shingle are one shingle as a whole; rows that repeat are links of their
class; a component's id is its smallest document id (null where all are null); empty tables give no
row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditloom.llm.common import FEW_KEYS, bucketed, components, dropped, frugal, narrowed, python_batches, saved, shuffle_parts, widened, without_rows
from auditloom.llm.shingles import mixed, shingle_sets

SHINGLE = 5
PERCENT = 80
SKETCH_BITS = 22
BLOCK_BITS = 16
#: Classes of one shingle up to which all their pairs are taken at once.
SMALL = 64
#: Most shingles that two documents may have to share, and the cost of a verification in postings.
MOST_SHARED = 4
VERIFY_COST = 20.0
#: Partners that a class is compared with in each round over frequent shingles; then come all.
ROUNDS = (8, 64)
#: Partners whose texts stand with a copy of one text.
CHUNK = 64
#: Documents of one shingle, by the sketch, that stand in one part.
HOT = 1 << 16
#: Words of 64 bits of a set's marks.
MARKS = ("m0", "m1", "m2", "m3")
#: How tables of shingles are bucketed.
BUCKETS = ["token", "part"]
#: What a class brings to a pair.
FIELDS = ("set", "n", "shared", "label", "place", "nth")


def set_key(tokens: np.ndarray) -> int:
    """A hash of the set; 0 for the empty one."""
    if not len(tokens):
        return 0
    h = mixed(np.array([np.add.reduce(mixed(tokens)), np.bitwise_xor.reduce(tokens * np.uint64(0x9E3779B97F4A7C15))], np.uint64) + np.uint64(len(tokens)))
    return int(mixed(h[:1] * np.uint64(3) + h[1:])[0].astype(np.int64))


def marks(tokens: np.ndarray) -> np.ndarray:
    """256 bits, each whether an odd number of the set's shingles falls on it."""
    odd = np.bincount((mixed(tokens) >> np.uint64(56)).astype(np.int64), minlength=256) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def packed(counters: np.ndarray) -> bytes:
    """32-bit counters, small for the most part, as compressed planes of their bytes."""
    return zstandard.ZstdCompressor(level=1).compress(counters.view(np.uint8).reshape(-1, 4).T.tobytes())


def unpacked(planes: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(planes), np.uint8).reshape(4, -1).T.copy().view(np.int32).ravel()


@frugal
def described(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """(id, n, set, text_key, MARKS): each document's set size, key and marks, of rows (id, text, text_key); and (block, counts) of the partition's sketch."""
    counters = np.zeros(1 << SKETCH_BITS, np.int32)
    mask, kind = np.uint64((1 << SKETCH_BITS) - 1), pa.int64()
    names = ["id", "n", "set", "text_key", *MARKS, "block", "counts"]
    for batch in batches:
        kind = batch.schema.field(0).type
        sets = shingle_sets(batch.column(1), k)
        for s in sets:
            np.add.at(counters, (s & mask).astype(np.int64), 1)
        m = len(sets)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_key(s) for s in sets], pa.int64()), batch.column(2), *[pa.array(x, pa.int64()) for x in (np.array([marks(s) for s in sets]).reshape(m, 4).T)], pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names=names)
    blocks, counts = [], []
    for b in range(1 << (SKETCH_BITS - BLOCK_BITS)):
        part = counters[b << BLOCK_BITS : (b + 1) << BLOCK_BITS]
        if part.any():
            blocks.append(b)
            counts.append(packed(part))
    m = len(blocks)
    if m:
        yield pa.RecordBatch.from_arrays([pa.nulls(m, kind), *[pa.nulls(m, pa.int64())] * (3 + len(MARKS)), pa.array(blocks, pa.int32()), pa.array(counts, pa.binary())], names=names)


@frugal
def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a block: the sums of its counters."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for b, counts in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
            own = total.setdefault(b, np.zeros(1 << BLOCK_BITS, np.int64))
            own += unpacked(counts)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([packed(np.minimum(v, (1 << 31) - 1).astype(np.int32)) for v in total.values()], pa.binary())], names=["block", "counts"])


def sketch_of(blocks: DataFrame) -> np.ndarray:
    """The corpus's sketch; its width is fixed, so its size on the driver is."""
    rows = blocks.repartition(min(16, shuffle_parts(blocks.sparkSession)), "block").mapInArrow(summed, "block int, counts binary").collect()
    out = np.zeros(1 << SKETCH_BITS, np.int32)
    for r in rows:
        out[r["block"] << BLOCK_BITS : (r["block"] + 1) << BLOCK_BITS] = unpacked(r["counts"])
    return out


def prefix(tokens: np.ndarray, sketch: np.ndarray, floor: float, percent: int) -> tuple[np.ndarray, int]:
    """The document's prefix and how many of its shingles a partner must share."""
    n = len(tokens)
    need = -(-percent * n // 100)
    counts = sketch[(tokens & np.uint64(len(sketch) - 1)).astype(np.int64)]
    order = np.argsort(counts, kind="stable")  # tokens are sorted: ties go by hash
    lengths = [n - need + shared for shared in range(1, min(MOST_SHARED, need) + 1)]
    mass = np.cumsum(np.maximum(counts[order[: lengths[-1]]] - floor, 1.0) - 0.99)
    costs = [mass[m - 1] * (1 + VERIFY_COST / (i + 1)) for i, m in enumerate(lengths)]
    best = int(np.argmin(costs))
    return tokens[order[: lengths[best]]], best + 1


@frugal
def postings(batches: Iterator[pa.RecordBatch], shared, k: int, percent: int) -> Iterator[pa.RecordBatch]:
    """(token, set, n, shared, place, part, parts) for each shingle of each document's prefix, the first at place 1."""
    counts, floor = shared.value
    cell = np.uint64(len(counts) - 1)
    for batch in batches:
        found = []
        for s in shingle_sets(batch.column(0), k):
            if len(s):
                tokens, least = prefix(s, counts, floor, percent)
                found.append((tokens, set_key(s), len(s), least))
        if found:
            sizes = [len(p[0]) for p in found]
            token = np.concatenate([p[0] for p in found])
            sets, n, least = (np.repeat(np.array([p[i] for p in found], np.int64), sizes) for i in (1, 2, 3))
            parts = 1 + np.maximum(counts[(token & cell).astype(np.int64)] - int(floor), 0) // HOT
            arrays = [token.view(np.int64), sets, n, least, np.concatenate([np.arange(1, m + 1) for m in sizes]), (sets % parts).astype(np.int32), parts.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["token", "set", "n", "shared", "place", "part", "parts"])


@frugal
def with_sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """(set, text): the text compressed, which it stays until it is verified."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        keys = pa.array([set_key(s) for s in shingle_sets(batch.column(0), k)], pa.int64())
        texts = pa.array([squeeze(t or b"") for t in batch.column(0).cast(pa.binary()).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([keys, texts], names=["set", "text"])


@frugal
def verified(batches: Iterator[pa.RecordBatch], k: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Links among rows (a, part, b, text) sorted so that a's own text (b null) comes before its partners'."""
    current, own = None, np.zeros(0, np.uint64)
    expand = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        out: tuple[list, list] = ([], [])
        texts = pa.array([expand(t) for t in batch.column(3).to_pylist()], pa.binary())
        keys = zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), shingle_sets(texts, k), strict=True)
        for a, b, tokens in keys:
            if b is None:
                current, own = a, tokens
                continue
            assert a == current
            common = len(np.intersect1d(own, tokens, assume_unique=True))
            if 100 * common >= percent * (len(own) + len(tokens) - common):
                out[0].append(a)
                out[1].append(b)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["a", "b"])


def texts_of(wanted: DataFrame, docs: DataFrame, keys: DataFrame, k: int) -> DataFrame:
    """(set, text) for the wanted sets, one text each. The texts are found by their hash as docs is read again, so that no copy of all is kept."""
    few = wanted.count() <= FEW_KEYS
    side = lambda df: F.broadcast(df) if few else df.hint("merge")
    named = saved(keys.join(side(wanted), "set", "left_semi").groupBy("set").agg(F.min("text_key").alias("text_key")).select("text_key").distinct())
    found = docs.select("text").withColumn("text_key", F.xxhash64("text")).join(side(named), "text_key", "left_semi")
    rows = found.select("text").mapInArrow(lambda b: with_sets(b, k), "set long, text binary")
    near = saved(rows.join(side(wanted), "set", "left_semi").dropDuplicates(["set"]))
    dropped(named)
    return near


def verify(pairs: DataFrame, docs: DataFrame, keys: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold. Only texts of a pair move, and one goes once to every CHUNK of its partners."""
    parts = shuffle_parts(pairs.sparkSession)
    wanted = saved(pairs.select(F.col("a").alias("set")).union(pairs.select("b")).distinct())
    near = texts_of(wanted, docs, keys, k)
    sizes = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("partners"))
    dealt = pairs.join(sizes, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.expr(f"partners div {CHUNK} + 1")).cast("int")).select("a", "part", "b")
    dealt = saved(dealt)
    own = dealt.select("a", "part").distinct().join(near.withColumnRenamed("set", "a").hint("merge"), "a").select("a", "part", F.lit(None).cast("long").alias("b"), "text")
    other = dealt.join(near.withColumnRenamed("set", "b").hint("merge"), "b").select("a", "part", "b", "text")
    rows = own.union(other).repartition(parts, "a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    out = saved(rows.mapInArrow(lambda x: verified(x, k, percent), "a long, b long"))
    dropped(wanted, near, dealt)
    return out


def each_part(rows: DataFrame) -> DataFrame:
    """rows once for each part of their shingle."""
    return rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))


def meetings(left: DataFrame, right: DataFrame, percent: int, marked: bool) -> DataFrame:
    """(a, b, least) for each shingle and part in which a class of left meets one of right, unless it proves them apart."""
    there = {"set": "b", "n": "m", "shared": "shared_b", "label": "label_b", "place": "place_b", "nth": "nth_b"}
    there |= {m: f"{m}_b" for m in MARKS} if marked else {}
    r = right.select(F.col("token").alias("token_b"), F.col("part").alias("part_b"), *[F.col(k).alias(v) for k, v in there.items()])
    most = F.least("nth", "nth_b") + F.least(F.col("n") - F.col("place"), F.col("m") - F.col("place_b"))
    near = most * (100 + percent) >= (F.col("n") + F.col("m")) * percent
    if marked:
        apart = sum((F.bit_count(F.col(m).bitwiseXOR(F.col(f"{m}_b"))) for m in MARKS), F.lit(0))
        near = near & (apart * (100 + percent) <= (F.col("n") + F.col("m")) * (100 - percent))
    once = (F.col("set") < F.col("b")) | (~F.col("chosen") & (F.col("set") != F.col("b")))
    both = left.join(r.hint("merge"), (F.col("token") == F.col("token_b")) & (F.col("part") == F.col("part_b")) & once & (F.col("label") != F.col("label_b")) & near)
    return both.select(F.least("set", "b").alias("a"), F.greatest("set", "b").alias("b"), F.least("shared", "shared_b").alias("least"))


def possible_pairs(held: DataFrame, chosen: Column, partners: Callable[[DataFrame, list[str]], DataFrame], percent: int, marked: bool = False) -> DataFrame:
    """(a, b, common, least), a < b, from shingles that held's classes have and ``partners``, some of them, too.

    Classes are of different components; chosen marks the rows of held that are partners, so that a pair
    comes once a shingle. common: how many shingles the two share here that don't prove them apart.
    partners: gets rows and the columns that name a shingle in them. marked: rows have MARKS, and pairs
    that these prove apart are dropped. Shingles of one part meet where held lies.
    """
    rows = held.withColumn("chosen", chosen)
    cold, hot = held.filter("parts = 1"), held.filter("parts > 1")
    met = meetings(rows.filter("parts = 1"), partners(cold, ["token", "part"]), percent, marked)
    met = met.union(meetings(rows.filter("parts > 1"), each_part(partners(hot, ["token", "parts"]).drop("part")), percent, marked))
    return met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("common"), F.first("least").alias("least"))


def central(rows: DataFrame, shingle: list[str]) -> DataFrame:
    """Of each shingle's classes the one whose prefix most others hold."""
    one = rows.groupBy(*shingle).agg(F.max_by(F.struct(*FIELDS), F.struct("weight", F.xxhash64("set"))).alias("one"))
    return one.select(*shingle, "one.*")


def merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """(set, label) of the classes in any link so far; only the links' components are sought, among labels."""
    if labels is None:
        return components(links).withColumnRenamed("node", "set")
    for side in ("a", "b"):
        links = links.join(labels.select(F.col("set").alias(side), F.col("label").alias("of")), side, "left").withColumn(side, F.coalesce("of", side)).drop("of")
    more = components(links.filter("a <> b"))
    fresh = labels.join(more.select(F.col("node").alias("label"), F.col("label").alias("low")), "label", "left").select("set", F.coalesce("low", "label").alias("label"))
    alone = more.withColumnRenamed("node", "set").join(labels, "set", "left_anti")
    return saved(fresh.union(alone.select("set", "label")))


def relabelled(held: DataFrame, labels: DataFrame) -> DataFrame:
    """held with labels, without the shingles whose classes are all in one component."""
    few = labels.count() <= FEW_KEYS
    named = held.drop("label", "classes").join(F.broadcast(labels) if few else labels.hint("merge"), "set", "left").withColumn("label", F.coalesce("label", "set"))
    fresh = bucketed(named, *BUCKETS, dealt=few)
    cold, hot = fresh.filter("parts = 1"), fresh.filter("parts > 1")
    whole = Window.partitionBy(*BUCKETS)
    split = cold.select("*", F.min("label").over(whole).alias("lo"), F.max("label").over(whole).alias("hi"), F.count(F.lit(1)).over(whole).alias("classes")).filter("lo <> hi").drop("lo", "hi")
    parted = hot.groupBy("token", "parts").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("classes")).filter("lo <> hi")
    parted = hot.drop("parts").join(each_part(parted).drop("lo", "hi").hint("merge"), BUCKETS)
    out = bucketed(split.unionByName(parted), *BUCKETS, dealt=True)
    dropped(fresh)
    return out


def shared_shingles(docs: DataFrame, sketch: np.ndarray, k: int, percent: int) -> DataFrame:
    """(token, part, parts, classes, weight, FIELDS): the prefix shingles of each class that another holds too."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((sketch, float(np.median(sketch))))
    rows = docs.select("text").mapInArrow(lambda b: postings(b, shared, k, percent), "token long, set long, n long, shared long, place long, part int, parts int")
    where = ["token", "part", "parts"]
    single = rows.repartition(shuffle_parts(spark), "token", "part").groupBy(*where, "set").agg(*[F.first(c).alias(c) for c in ("n", "shared", "place")])
    counted = saved(single.withColumn("classes", F.count(F.lit(1)).over(Window.partitionBy(*where))).filter("classes > 1 or parts > 1"))
    shared.destroy()
    cold, hot = counted.filter("parts = 1"), counted.filter("parts > 1").drop("classes")
    sums = hot.groupBy("token", "parts").agg(F.count(F.lit(1)).alias("classes")).filter("classes > 1")
    both = cold.unionByName(hot.drop("parts").join(each_part(sums), ["token", "part"]))
    nth = F.row_number().over(Window.partitionBy("set").orderBy("place")).cast("long")
    weight = F.sum("classes").over(Window.partitionBy("set"))
    held = bucketed(both.withColumn("nth", nth).withColumn("weight", weight).withColumn("label", F.col("set")), *BUCKETS)
    dropped(counted)
    return held


def topped(pairs: DataFrame, rare: DataFrame) -> DataFrame:
    """pairs, those short of their number with what they share in rare added to ``common``."""
    left, right = rare.select(F.col("set").alias("a"), "token"), rare.select(F.col("set").alias("b"), "token")
    more = pairs.filter("common < least").join(left, "a").join(right, ["b", "token"]).groupBy("a", "b").agg(F.count(F.lit(1)).alias("more"))
    return pairs.join(more, ["a", "b"], "left").select("a", "b", (F.col("common") + F.coalesce("more", F.lit(0))).alias("common"), "least")


def class_components(docs: DataFrame, keys: DataFrame, sketch: np.ndarray, k: int, percent: int) -> DataFrame:
    """(set, label) for each class that links with another."""
    held = shared_shingles(docs, sketch, k, percent)
    enough = lambda pairs: pairs.filter("common >= least").select("a", "b")

    tested = saved(enough(possible_pairs(held, F.lit(False), central, percent)))
    found = verify(tested, docs, keys, k, percent)
    labels = merged(None, found)
    last, held = held, relabelled(held, labels)
    dropped(last, found)
    rare, frequent = held.filter(F.col("classes") <= SMALL), held.filter(F.col("classes") > SMALL)
    for most in (*ROUNDS, None):
        few = F.pmod(F.xxhash64("set", F.lit(most)), F.col("classes")) < most if most else F.lit(True)
        rows, chosen = (held, few | (F.col("classes") <= SMALL)) if most == ROUNDS[0] else (frequent, few)
        if not rows.limit(1).count():
            break
        if not most:
            rows = bucketed(rows.join(keys.select("set", *MARKS).dropDuplicates(["set"]), "set"), *BUCKETS)
        pairs = possible_pairs(rows, chosen, lambda r, _, chosen=chosen: r.filter(chosen), percent, marked=not most)
        pairs = saved(enough(pairs if most else topped(saved(pairs), rare)).join(tested, ["a", "b"], "left_anti"))
        if not most:
            dropped(rows)
        found = verify(pairs, docs, keys, k, percent)
        seen, known = saved(tested.union(pairs)), merged(labels, found)
        last, frequent = frequent, relabelled(frequent, known)
        dropped(tested, pairs, labels, found, last)
        tested, labels = seen, known
    dropped(held, frequent, tested)
    return labels


def near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs: who reaches whom by links of Jaccard >= percent / 100."""
    python_batches(docs.sparkSession)
    docs = docs.select(F.col(doc_id).alias("id"), "text")
    schema = f"id {docs.schema['id'].dataType.simpleString()}, n long, set long, text_key long, m0 long, m1 long, m2 long, m3 long, block int, counts binary"
    seen = saved(docs.withColumn("text_key", F.xxhash64("text")).mapInArrow(lambda b: described(b, k), schema))
    rows = seen.filter("block is null").select("id", "n", "set")
    keys = seen.filter("block is null and n > 0").select("set", "text_key", *MARKS)
    labels = class_components(docs, keys, sketch_of(seen.filter("block is not null").select("block", "counts")), k, percent)
    labelled = saved(rows.join(labels.hint("merge"), "set", "left").withColumn("label", F.coalesce("label", "set")))
    dropped(seen, labels)
    least = labelled.filter("n > 0").groupBy("label").agg(F.min("id").alias("least"))
    out = labelled.join(least.hint("merge"), "label", "left")
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id")).alias("component_id"))


def one_of_each(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of docs, with their columns, of which each component keeps the one with the smallest doc_id (nulls last, one of equals)."""
    used = ["doc_id", "text"]
    rows = saved(narrowed(docs, used).withColumn("_row", F.monotonically_increasing_id()))
    groups = near_duplicates(rows, k, percent, "_row").select(F.col("doc_id").alias("_row"), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row"))
    groups = saved(rows.select("_row", "doc_id").join(groups, "_row"))
    kept = groups.groupBy("component_id").agg(first.alias("first")).select("first._row")
    gone = groups.select("_row").join(kept, "_row", "left_anti")
    return widened(without_rows(rows, gone, "_row"), docs.columns, used)
