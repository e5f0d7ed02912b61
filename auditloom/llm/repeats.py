"""Suffix-array dedup: bytes covered by a string of ``length`` bytes that also starts anywhere else.

Finding candidates. Each start of a ``length``-byte window is given to the window's anchor, the place
whose hash of ``ANCHOR`` bytes is least in it (the first of equals). Equal windows have equal anchors,
so windows whose anchor's hash occurs once in the corpus are unique. The starts of one anchor with the
bytes they cover are a record. Equal records that follow one another in a text, as in text of a short
period, are one row with their number: all their starts repeat. Where all records of an anchor are equal,
all their starts repeat too; where they differ, they go to the index, one of each with its number of
occurrences.

Deciding. Records of the same anchors are put together into blocks of about ``BLOCK`` bytes. A block
gets its suffix array by prefix doubling, its Burrows-Wheeler transform, and its common prefixes by
threshold-bounded interval expansion: breadth-first backward extension of the intervals of all strings
of length 1, 2, 3, ... sets the common prefix of each boundary it meets first, in increasing order, and
stops below ``length``. Boundaries still unset then separate suffixes that share ``length`` bytes; a
run of such suffixes is one string, which repeats if its records occur more than once together.

Each start belongs to one anchor, so a start is judged once, and by all others of its anchor. An anchor
with very many different records is split by hash into parts of about ``PART`` records. Their strings
are then compared across parts by runs: the starts of a record in ``STEP`` neighbouring places before the
anchor have a core of bytes in common, and give one row with the core's hash. Only where a core comes
twice are the hashes of the run's strings themselves compared, so nothing is left out.

Texts are taken up in slices of about ``SLICE`` bytes, long ones in overlapping slices; a record that a
slice cuts is two records of one anchor.

Defined results: a null text is empty; a shorter text keeps all; equal rows repeat each other wholly if
long enough; overlapping occurrences count; matches stay within a document and its bytes (UTF-8);
strings are judged on the input; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.llm.common import dropped, python_batches, saved, shuffle_parts
from auditloom.llm.shingles import _power_tables, mixed

LENGTH = 400
ANCHOR = 64
BLOCK = 1 << 19
PART = 4096
#: Neighbouring starts of a record that are compared across parts by their common core first.
STEP = 16
#: Bytes of texts whose anchors are found at once.
SLICE = 1 << 22

_SIGNS = np.random.default_rng(77).integers(1, 1 << 63, 256, dtype=np.uint64)


def text_key(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) - (1 << 63)


def prefix_sums(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_SIGNS[data] * _power_tables(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hashes of the spans [lo, hi) of the data behind the sums."""
    return mixed((sums[hi] - sums[lo]) * _power_tables(len(sums))[1][lo] + (hi - lo).astype(np.uint64))


def least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - (width - span)], values[width - span :]) if width > span else values


def records(texts: list[bytes], length: int) -> list[np.ndarray]:
    """[text number, anchor hash, record hash, first start, end of starts, the anchor's place after the first start], an entry a record."""
    size = min(ANCHOR, length)
    data = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.cumsum([0, *map(len, texts)])
    if len(data) < length:
        return [np.zeros(0, np.int64)] * 6
    sums = prefix_sums(data)
    at = np.arange(len(data) - size + 1)
    hashes = span_hashes(sums, at, at + size)
    packed = (hashes & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    anchors = (least(packed, length - size + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.concatenate([np.arange(a, b - length + 1) for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
    owner = anchors[starts]
    first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (starts[1:] != starts[:-1] + 1)])) if len(starts) else np.zeros(0, np.int64)
    if not len(first):
        return [np.zeros(0, np.int64)] * 6
    last = np.concatenate([first[1:], [len(starts)]]) - 1
    lo, hi = starts[first], starts[last] + 1
    text = np.searchsorted(bounds, lo, side="right") - 1
    # Empty texts share a bound with the next one; the last of equal bounds holds the start.
    return [text, hashes[owner[first]].view(np.int64), span_hashes(sums, lo, hi - 1 + length).view(np.int64), lo - bounds[text], hi - bounds[text], owner[first] - lo]


def sliced(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(text number, place of the slice in it, bytes): every start of a text is in one slice."""
    part, size = [], 0
    for k, t in enumerate(texts):
        for base in range(0, len(t) - length + 1, SLICE):
            piece = t if len(t) <= SLICE else t[base : base + SLICE + length - 1]
            if part and size + len(piece) > SLICE:
                yield part
                part, size = [], 0
            part.append((k, base, piece))
            size += len(piece)
            if piece is t:
                break
    if part:
        yield part


def anchored(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(key, bytes, anchor, record, lo, hi, place, copies): records of each text, equal ones that adjoin as one row with lo, hi and place of the first."""
    for batch in batches:
        texts = [t for t in batch.column(0).cast(pa.binary()).to_pylist() if t and len(t) >= length]
        keys, sizes = np.array([text_key(t) for t in texts], np.int64), np.array([len(t) for t in texts], np.int64)
        for part in sliced(texts, length):
            found = records([p[2] for p in part], length)
            piece, anchor, record, lo, hi, _ = found
            apart = (piece[1:] != piece[:-1]) | (anchor[1:] != anchor[:-1]) | (record[1:] != record[:-1]) | (lo[1:] != hi[:-1])
            first = np.flatnonzero(np.concatenate([np.ones(min(len(lo), 1), bool), apart]))
            copies = np.diff(np.concatenate([first, [len(lo)]]))
            piece, anchor, record, lo, hi, place = (x[first] for x in found)
            text, base = np.array([p[0] for p in part])[piece], np.array([p[1] for p in part])[piece]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (keys[text], sizes[text], anchor, record, lo + base, hi + base, place, copies)], names=["key", "bytes", "anchor", "record", "lo", "hi", "place", "copies"])


def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, key, bytes)."""
    for batch in batches:
        texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()), pa.array([text_key(t) for t in texts], pa.int64()), pa.array([len(t) for t in texts], pa.int64())], names=["id", "text", "key", "bytes"])


def cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(anchor, record, copies, kinds, place, data): the bytes of the records that rows (text, wanted) name."""
    for batch in batches:
        out: list[list] = [[], [], [], [], [], []]
        for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for w in wanted:
                for column, value in zip(out, (w["anchor"], w["record"], w["copies"], w["kinds"], w["place"], text[w["lo"] : w["hi"] - 1 + length]), strict=True):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in out[:5]], pa.array(out[5], pa.binary())], names=["anchor", "record", "copies", "kinds", "place", "data"])


def suffix_array(signs: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of all suffixes and each one's rank. Signs are unique at record ends, so ``longest`` + 1 signs tell all apart."""
    n = len(signs)
    rank = signs.astype(np.uint64)
    width = 1
    while True:
        later = np.zeros(n, np.uint64)
        later[: n - width] = rank[width:] + np.uint64(1)
        key = (rank << np.uint64(32)) | later
        order = np.argsort(key)
        ahead = key[order]
        fresh = np.concatenate([[False], ahead[1:] != ahead[:-1]])
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(fresh).astype(np.uint64)
        width *= 2
        if width > longest + 1 or fresh[1:].all():
            return order.astype(np.int32), rank.astype(np.int32)


def long_boundaries(signs: np.ndarray, ends: int, order: np.ndarray, rank: np.ndarray, length: int) -> np.ndarray:
    """For each place in the order, whether its suffix shares ``length`` signs with the one before.

    ``ends`` is the number of signs that are unique record ends, the lowest ones. An interval (lo, hi) of
    the order holds the suffixes that begin with one string; its backward extensions by the signs that
    precede these suffixes are the intervals of the strings one longer.
    """
    n = len(signs)
    before = order - 1  # the sign before suffix 0 is the last record's end, as if the text went round
    bwt, back = signs[before], rank[before]
    run = np.zeros(n, np.int32)
    np.cumsum(bwt[1:] != bwt[:-1], out=run[1:])
    run_first = np.concatenate([[0], np.flatnonzero(bwt[1:] != bwt[:-1]) + 1])
    run_last = np.concatenate([run_first[1:] - 1, [n - 1]])
    unset = np.ones(n + 1, bool)
    unset[n] = False
    heads = signs[order]
    lo = np.concatenate([[0], np.flatnonzero(heads[1:] != heads[:-1]) + 1])
    hi = np.concatenate([lo[1:] - 1, [n - 1]])
    unset[lo] = False
    keep = heads[lo] >= ends
    ended = lo[~keep]
    lo, hi = np.concatenate([lo[keep], ended]), np.concatenate([hi[keep], ended])
    for _ in range(1, length):
        one = run[lo] == run[hi]
        a, b = lo[one], hi[one]
        fine = bwt[a] >= ends
        new_lo, new_hi = [back[a[fine]]], [back[b[fine]]]
        if not one.all():
            x, y = lo[~one], hi[~one]
            r0, counts = run[x], run[y] - run[x] + 1
            owner = np.repeat(np.arange(len(x)), counts)
            runs = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + r0[owner]
            first, last = np.maximum(run_first[runs], x[owner]), np.minimum(run_last[runs], y[owner])
            sign = bwt[first]
            pick = sign >= ends
            owner, first, last, sign = owner[pick], first[pick], last[pick], sign[pick]
            at = np.argsort(owner.astype(np.int64) * (int(signs.max()) + 1) + sign, kind="stable")
            owner, first, last, sign = owner[at], first[at], last[at], sign[at]
            edge = np.concatenate([[True], (owner[1:] != owner[:-1]) | (sign[1:] != sign[:-1])]) if len(at) else np.zeros(0, bool)
            begin = np.flatnonzero(edge)
            finish = np.concatenate([begin[1:] - 1, [len(at) - 1]]) if len(at) else begin
            new_lo.append(back[first[begin]])
            new_hi.append(back[last[finish]])
        lo, hi = np.concatenate(new_lo), np.concatenate(new_hi)
        pick = unset[hi + 1]
        lo, hi = lo[pick], hi[pick]
        unset[hi + 1] = False
        if not len(lo):
            break
    return unset[:n]


def repeated_starts(datas: list[bytes], copies: np.ndarray, length: int) -> np.ndarray:
    """Over the records one after another: whether the string of ``length`` bytes at each byte occurs more than once."""
    m, sizes = len(datas), np.array([len(d) for d in datas])
    ends = np.cumsum(sizes + 1) - 1
    raw = np.frombuffer(b"\0".join(datas) + b"\0", np.uint8)
    signs = raw.astype(np.int32) + m
    signs[ends] = np.arange(m)
    order, rank = suffix_array(signs, int(sizes.max()))
    same = long_boundaries(signs, m, order, rank, length)
    group = np.cumsum(~same) - 1
    of = np.repeat(np.arange(m), sizes + 1)
    total = np.bincount(group, copies[of[order]].astype(np.float64))
    at = np.arange(len(signs))
    out = np.zeros(len(signs), bool)
    out[order] = total[group] >= 2
    return out & (at + length <= ends[of])


def runs_of(anchor: int, record: int, place: int, data: bytes, hit: np.ndarray, length: int, told: set) -> Iterator[tuple]:
    """(anchor, record, lo, None, core, strings, known) for each run of a record's starts that may have to be met in other parts.

    strings: the hash of each start's string, null where it is known to repeat and was told before.
    """
    n, step = len(hit), max(1, min(STEP, length // 4))
    sums, at = prefix_sums(np.frombuffer(data, np.uint8)), np.arange(len(hit))
    strings = span_hashes(sums, at, at + length).view(np.int64).tolist()
    number = (place - at) // step
    begin = np.concatenate([[0], np.flatnonzero(np.diff(number)) + 1])
    first = place - number[begin] * step  # the latest start that such a run may have, and from there to the end of the earliest's string
    cores = span_hashes(sums, first, first - step + 1 + length).view(np.int64).tolist()
    known = hit.tolist()
    for lo, hi, core in zip(begin.tolist(), [*begin[1:].tolist(), n], cores, strict=True):
        own: list[int | None] = strings[lo:hi]
        for i in range(lo, hi):
            if known[i]:
                if (anchor, strings[i]) in told:
                    own[i - lo] = None
                told.add((anchor, strings[i]))
        if any(h is not None for h in own):
            yield anchor, record, lo, None, core, own, known[lo:hi]


VERDICT = "anchor long, record long, lo long, hi long, core long, strings array<long>, known array<boolean>"


def judged(batches: Iterator[pa.RecordBatch], length: int, most: int, block: int) -> Iterator[pa.RecordBatch]:
    """Rows (anchor, part, record, copies, kinds, place, data), sorted by anchor and part, to VERDICT.

    A row with a null core gives starts that repeat; one with a core is a run of starts of an anchor
    that is split into parts, as runs_of() gives it.
    """
    held: list[tuple] = []
    size = 0

    def settle() -> pa.RecordBatch:
        datas = [h[6] for h in held]
        found = repeated_starts(datas, np.array([h[3] for h in held]), length)
        rows: list[tuple] = []
        offset, told = 0, set()
        for anchor, _, record, _, kinds, place, data in held:
            hit = found[offset : offset + len(data) - length + 1]
            edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))).tolist()
            rows += [(anchor, record, a, b, None, None, None) for a, b in zip(edges[::2], edges[1::2], strict=True)]
            if kinds > most:
                rows += runs_of(anchor, record, place, data, hit, length, told)
            offset += len(data) + 1
        columns = zip(*rows, strict=True) if rows else [()] * 7
        types = [pa.int64()] * 5 + [pa.list_(pa.int64()), pa.list_(pa.bool_())]
        return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(columns, types, strict=True)], names=["anchor", "record", "lo", "hi", "core", "strings", "known"])

    last = None
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
            if row[:2] != last and size > block:
                yield settle()
                held, size = [], 0
            last = row[:2]
            held.append(row)
            size += len(row[6])
    if held:
        yield settle()


def joined(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans in order, those that overlap or touch as one."""
    at = np.argsort(lo, kind="stable")
    lo, hi = lo[at], np.maximum.accumulate(hi[at]) if len(at) else hi
    first = np.flatnonzero(np.concatenate([np.ones(min(len(lo), 1), bool), lo[1:] > hi[:-1]]))
    return lo[first], hi[np.concatenate([first[1:] - 1, [len(lo) - 1]])] if len(lo) else hi


def covered(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, text) from rows (id, text, lo, hi): the first and last but one start of each span."""
    for batch in batches:
        out: list[list] = [[], [], [], [], []]
        for k in range(batch.num_rows):
            text = batch.column(1)[k].as_py()
            lo, hi = ((x.values.to_numpy(zero_copy_only=False) if x.is_valid else np.zeros(0, np.int64)) for x in (batch.column(2)[k], batch.column(3)[k]))
            lo, hi = joined(lo, hi - 1 + length)
            rest = b"".join([text[a:b] for a, b in zip([0, *hi.tolist()], [*lo.tolist(), len(text)], strict=True)])
            for column, value in zip(out, (len(text), len(text) - len(rest), len(lo), hashlib.sha256(rest).hexdigest(), rest), strict=True):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x, k) for x, k in zip(out, kinds, strict=True)]], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def repeats(docs: DataFrame, length: int = LENGTH, most: int = PART, block: int = BLOCK) -> DataFrame:
    """(key, bytes, lo, hi): the starts of repeated strings of each text, by the text's key and size."""
    spark = docs.sparkSession
    parts = shuffle_parts(spark)
    seen = saved(docs.select("text").mapInArrow(lambda b: anchored(b, length), "key long, bytes long, anchor long, record long, lo long, hi long, place long, copies long"))
    common = seen.groupBy("anchor").agg(F.sum("copies").alias("n"), F.min("record").alias("r0"), F.max("record").alias("r1")).filter("n > 1").select("anchor", (F.col("r0") == F.col("r1")).alias("alike"))
    twice = saved(seen.join(common, "anchor"))
    dropped(seen)
    mixed_rows = twice.filter("not alike")
    kinds = mixed_rows.groupBy("anchor", "record").agg(F.sum("copies").alias("copies"), F.min(F.struct("key", "bytes", "lo", "hi", "place")).alias("at"))
    kinds = saved(kinds)
    number = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"))
    wanted = kinds.join(number, "anchor").select("at.key", "at.bytes", F.struct("anchor", "record", "copies", "kinds", "at.lo", "at.hi", "at.place").alias("one")).groupBy("key", "bytes").agg(F.collect_list("one").alias("wanted"))
    long_docs = docs.filter(F.octet_length("text") >= length)
    texts = long_docs.select(F.lit(0).alias("id"), "text").mapInArrow(keyed, "id int, text binary, key long, bytes long")
    cuts = texts.join(wanted, ["key", "bytes"]).select("text", "wanted").mapInArrow(lambda b: cut(b, length), "anchor long, record long, copies long, kinds long, place long, data binary").dropDuplicates(["anchor", "record"])
    split = cuts.select("anchor", F.pmod(F.xxhash64("record"), F.expr(f"(kinds + {most} - 1) div {most}")).alias("part"), "record", "copies", "kinds", "place", "data")
    dealt = split.repartition(parts, "anchor", "part").sortWithinPartitions("anchor", "part", "record")
    verdicts = saved(dealt.mapInArrow(lambda b: judged(b, length, most, block), VERDICT))
    runs = verdicts.filter("core is not null")
    weight = F.when(F.exists("known", lambda k: k), 2).otherwise(1)
    met = runs.groupBy("anchor", "core").agg(F.sum(weight).alias("total")).filter("total > 1").select("anchor", "core")
    strings = runs.join(met, ["anchor", "core"]).select("anchor", "record", "lo", F.posexplode(F.arrays_zip("strings", "known")).alias("nth", "one"))
    strings = strings.select("anchor", "record", (F.col("lo") + F.col("nth")).alias("lo"), F.col("one.strings").alias("string"), F.col("one.known").alias("known")).filter("string is not null")
    across = strings.groupBy("anchor", "string").agg(F.sum(F.when(F.col("known"), 2).otherwise(1)).alias("total")).filter("total > 1").select("anchor", "string")
    late = strings.filter("not known").join(across, ["anchor", "string"]).select("anchor", "record", "lo", (F.col("lo") + 1).alias("hi"))
    found = verdicts.filter("core is null").select("anchor", "record", "lo", "hi").union(late)
    found = found.withColumnsRenamed({"lo": "from", "hi": "to"})
    in_place = mixed_rows.filter("copies = 1").join(found, ["anchor", "record"]).select("key", "bytes", (F.col("lo") + F.col("from")).alias("lo"), (F.col("lo") + F.col("to")).alias("hi"))
    whole = twice.filter("alike or copies > 1").select("key", "bytes", "lo", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("copies")).alias("hi"))
    return whole.union(in_place)


def without_repeats(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", most: int = PART, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept), a row for each of docs; kept is what remains, as bytes.

    most: different records of an anchor from which it is split; block: bytes that are indexed together. Neither changes the result.
    """
    python_batches(docs.sparkSession)
    docs = docs.select(F.col(doc_id).alias("id"), "text")
    kind = docs.schema["id"].dataType.simpleString()
    spans = saved(repeats(docs, length, most, block).groupBy("key", "bytes").agg(F.collect_set(F.struct("lo", "hi")).alias("spans")).select("key", "bytes", F.col("spans.lo").alias("lo"), F.col("spans.hi").alias("hi")))
    schema = f"id {kind}, text binary, key long, bytes long"
    small = F.coalesce(F.octet_length("text"), F.lit(0)) < length
    long_docs = docs.filter(~small).mapInArrow(keyed, schema).join(spans, ["key", "bytes"], "left").select("id", "text", "lo", "hi")
    short_docs = docs.filter(small).select("id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"), *[F.lit(None).cast("array<long>").alias(x) for x in ("lo", "hi")])
    out = f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return long_docs.union(short_docs).mapInArrow(lambda b: covered(b, length), out).withColumnRenamed("id", "doc_id")
