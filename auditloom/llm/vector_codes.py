"""Vector codes by delta-maintained Lloyd: a codebook for each part of the vectors, refined in integers.

Components become integers, vectors equal parts. The vectors lie once in a bucketed table. A round reads
them beside their former codes, bucketed alike (a join without a shuffle), assigns every part to its nearest
entry and writes the new codes. Where a part changed its entry, its task adds it to the new entry's sums
and takes it from the old one's; only these sums, one row a task that saw a change, are shuffled. Running
integer sums and counts take them up, and each entry becomes the floor of its mean. Codes and deltas are
exact in any order, so a lost executor changes nothing. A round without changes ends the rounds: all later
ones would give the same.

The driver holds codebooks and sums: parts x entries x width integers, whatever the number of vectors.

Defined results: vectors that are null, empty or hold null or non-finite components go, as do those of
another length than the first kept one; a null vec_id comes last in order; rows that repeat count each;
fewer vectors than entries give fewer entries; an empty table gives no row. Where the length isn't a
multiple of the parts the last parts are shorter. Integers are clamped so that a squared distance fits 62
bits (at 64 components: beyond +-32,767 as a component). Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.llm.common import bucketed, dropped, frugal, python_batches, saved

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096


def kept_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, ints) of the vectors that stay."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = embeddings.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).where(finite)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select(F.size("embedding")).first()
    d = first[0] if first else 0
    most = math.isqrt(2**62 // max(d, 1)) // 2
    whole = lambda x: F.floor(F.greatest(F.lit(float(-most)), F.least(F.lit(float(most)), x.cast("double") * scale)))
    return rows.where(F.size("embedding") == d).select("vec_id", "label", F.transform("embedding", whole).alias("ints"))


def widths(d: int, parts: int) -> list[tuple[int, int]]:
    """(from, to) of each part of d components."""
    wide = -(-d // parts)
    return [(min(d, k * wide), min(d, (k + 1) * wide)) for k in range(parts)]


def nearest(vectors: np.ndarray, books: np.ndarray, cuts: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Each part's nearest entry (the lowest of equals) and its squared distance; books are entries x components."""
    codes, errors = np.zeros((len(vectors), len(cuts)), np.uint8), np.zeros(len(vectors), np.int64)
    for k, (a, b) in enumerate(cuts):
        far = np.empty((len(vectors), len(books)), np.int64)
        for e in range(len(books)):
            gap = vectors[:, a:b] - books[e, a:b]
            far[:, e] = (gap * gap).sum(axis=1)
        codes[:, k] = far.argmin(axis=1)
        errors += far.min(axis=1)
    return codes, errors


def _matrix(part: pa.RecordBatch) -> np.ndarray:
    return part.column("ints").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)


#: What changed, by entry of a part: how many parts came less those that went, and the sums of their integers.
_DELTA = pa.list_(pa.struct([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))]))


def moves(books: np.ndarray, cuts: list[tuple[int, int]]):
    """A function of batches (_row, ints, was) to (_row, codes, delta): delta, in a task's last row, sums what changed in the task."""
    entries, d = books.shape

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums, moved, held = np.zeros((entries, len(cuts)), np.int64), np.zeros((entries, d), np.int64), False, None
        made = lambda rows, codes, last: pa.RecordBatch.from_arrays([rows, pa.array([x.tobytes() for x in codes], pa.binary()), pa.array([None] * (len(codes) - 1) + [last], _DELTA)], ["_row", "codes", "delta"])
        for part in batches:
            if not part.num_rows:
                continue
            if held:
                yield made(*held, None)
            vectors, was = _matrix(part), part.column("was")
            codes, _ = nearest(vectors, books, cuts)
            old = np.full(codes.shape, -1, np.int64) if was.null_count else np.frombuffer(b"".join(was.to_pylist()), np.uint8).reshape(codes.shape).astype(np.int64)
            for k, (a, b) in enumerate(cuts):
                changed = old[:, k] != codes[:, k]
                moved |= bool(changed.any())
                for at, sign in ((codes[changed, k], 1), (old[changed, k], -1)):
                    known = at >= 0
                    np.add.at(counts[:, k], at[known], sign)
                    np.add.at(sums[:, a:b], at[known], sign * vectors[changed, a:b][known])
            held = part.column("_row"), codes
        if held:
            changed = [(k, e) for k in range(len(cuts)) for e in range(entries) if counts[e, k] or sums[e, cuts[k][0] : cuts[k][1]].any()]
            delta = [{"part": k, "entry": e, "n": int(counts[e, k]), "sums": sums[e, cuts[k][0] : cuts[k][1]].tolist()} for k, e in changed]
            yield made(*held, delta if moved else None)

    return run


def coded(books: np.ndarray, cuts: list[tuple[int, int]]):
    """A function of batches (vec_id, label, ints) to (_row, code, error)."""

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            codes, errors = nearest(_matrix(part), books, cuts) if part.num_rows else (np.zeros((0, 1), np.uint8), np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("label"), pa.array([x.tobytes().hex() for x in codes], pa.string()), pa.array(errors)], ["vec_id", "label", "code", "error"])

    return run


def fitted(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The codebooks (entries x components) of vectors (_row, vec_id, ints; bucketed by _row), and the parts' places."""
    first = [r[0] for r in vectors.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).select("ints").collect()]
    books = np.array(first, np.int64).reshape(len(first), len(first[0]) if first else 0)
    cuts = widths(books.shape[1], parts)
    if not len(books):
        return books, cuts
    counts, sums, codes = np.zeros((len(books), parts), np.int64), np.zeros(books.shape, np.int64), None
    for _ in range(rounds):
        rows = vectors.select("_row", "ints")
        rows = rows.join(codes.select("_row", F.col("codes").alias("was")), "_row") if codes else rows.withColumn("was", F.lit(None).cast("binary"))
        kind = "_row long, codes binary, delta array<struct<part:int,entry:int,n:long,sums:array<long>>>"
        fresh = bucketed(rows.mapInArrow(moves(books, cuts), kind), "_row", dealt=True)
        if codes:
            dropped(codes)
        codes = fresh
        wide = max(b - a for a, b in cuts)
        deltas = codes.where("delta is not null").select(F.explode("delta").alias("d")).select("d.*")
        change = deltas.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(wide)]).alias("sums")).collect()
        if not codes.where("delta is not null").limit(1).count():
            break
        for r in change:
            a, b = cuts[r["part"]]
            counts[r["entry"], r["part"]] += r["n"]
            sums[r["entry"], a:b] += np.array(r["sums"][: b - a], np.int64)
        books = books.copy()
        for k, (a, b) in enumerate(cuts):
            used = counts[:, k] > 0
            books[used, a:b] = sums[used, a:b] // counts[used, k][:, None]
    if codes:
        dropped(codes)
    return books, cuts


def fingerprint(books: np.ndarray, cuts: list[tuple[int, int]]) -> str:
    """SHA-256 of all entries' integers in decimals, by part, entry and place, comma-joined."""
    return hashlib.sha256(",".join(str(x) for a, b in cuts for entry in books[:, a:b].tolist() for x in entry).encode()).hexdigest()


def compressed(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray, list[tuple[int, int]]]:
    """(vec_id, label, code, error) of each kept vector, the codebooks and the parts' places."""
    python_batches(embeddings.sparkSession)
    rows = kept_vectors(embeddings, scale)
    vectors = bucketed(rows.withColumn("_row", F.monotonically_increasing_id()), "_row")
    books, cuts = fitted(vectors, parts, entries, rounds)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    out = saved(vectors.select("vec_id", "label", "ints").mapInArrow(coded(books, cuts), f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"))
    dropped(vectors)
    return out, books, cuts


def vector_codes(embeddings: DataFrame, **how: int) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of each kept vector; label_error sums over equal labels, nulls together."""
    rows, books, cuts = compressed(embeddings, **how)
    per = rows.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return rows.join(per, F.col("label").eqNullSafe(F.col("_label"))).select("vec_id", "code", "error", "label_error", F.lit(fingerprint(books, cuts)).alias("codebooks_sha256"))
