"""Language identification by interpolated Kneser-Ney models of characters, one a language.

A text counts in lower case, with each run of signs other than letters and marks as one space, a space
before and after. Tasks count the five-character strings of all texts to learn from; lower orders follow
from the distinct strings of the order above them, as Kneser and Ney's continuation counts do, in
aggregations over (language, string). Each order has its own discount, n1 / (n1 + 2 n2). What a model
needs at scoring (discounted probabilities of strings, weights of contexts) is held as arrays sorted by a
64-bit hash of the string, one pair for each language and order. A text gets each language's mean bits a
character; the lowest wins.

Counts cover every text to learn from but for at most ``CALIBRATION`` rows kept apart, which calibrate:
the score is a softmax of the models' bits whose slope (and power of the length) has the least log loss on
them, and a text is rejected where its bits lie above the 0.999 quantile of the bits that rows of its
language have under their own model.

Arrays hold at most ``MOST`` strings an order: those whose count over all languages reaches a
bound that doubles until they fit, and contexts likewise, so that what is left is rare in any text. The
others are the tail, a table in the shared folder with the values of rare strings and contexts. So what the
driver gathers and broadcasts is bounded: 16 bytes a string or context, some 75 MB at the default with all
orders full, and a Bloom filter of the tail of at most ``FILTER`` bits. A text's strings that arrays settle
count in its task; the few whose value may stand in the tail are met with it by joins, each distinct string
once. The filter only spares joins: a full one makes more strings meet the tail, and the bits are the same
as if the arrays held all.

Defined results: a text that is null or has no letter is ``und`` with score 0; so is every text where
nothing can be learnt; a null lang, or a learn condition that is null, teaches nothing; rows that repeat
count each; ties between languages go to the first in order. Texts of any length are read whole, in
slices. An empty table gives no row.
"""

from __future__ import annotations

import functools
import itertools
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditloom.llm.common import dropped, frugal, python_batches, saved

ORDER = 5
MOST = 500_000
CALIBRATION = 5000
#: Bits of the filter of strings beyond the arrays, and its probes.
FILTER = 1 << 27
PROBES = 3
UNKNOWN = "und"
#: Characters of a slice, strings that a task gathers before it hands them on, cells of a worker's table of known strings.
SLICE = 1 << 19
GATHERED = 1 << 20
CELLS = 1 << 19
_SPACE = 32


@functools.cache
def _classes() -> np.ndarray:
    """2 for letters, 1 for marks, else 0, by code point."""
    kind = {"L": 2, "M": 1}
    return np.array([kind.get(unicodedata.category(chr(c))[0], 0) for c in range(sys.maxunicode + 1)], np.uint8)


def normal(text: str) -> tuple[np.ndarray, bool]:
    """A text's code points as they count, and whether it has a letter."""
    points = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "replace"), np.uint32)
    kinds = _classes()[points]
    word = kinds > 0
    keep = word.copy()
    keep[:-1] |= word[1:]  # the last sign before a word stands for the run
    keep[-1] = not word[-1]
    return np.where(word, points, _SPACE)[keep].astype(np.uint32), bool((kinds == 2).any())


def pieces(texts: list[np.ndarray], order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts in blocks of about SLICE characters: signs, whether each is a text's own, and the own signs' text.

    Before each text or slice of one stand the order - 1 signs before it, spaces at a text's beginning.
    """
    before = np.full(order - 1, _SPACE, np.uint32)
    signs, owners, held = [], [], 0

    def block() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own = np.concatenate([np.arange(len(x)) >= order - 1 for x in signs])
        return np.concatenate(signs), own, np.repeat([o for o, _ in owners], [n for _, n in owners])

    for owner, text in enumerate(texts):
        for at in range(0, len(text), SLICE):
            new = text[at : at + SLICE]
            signs.append(np.concatenate([text[at - order + 1 : at] if at else before, new]))
            owners.append((owner, len(new)))
            held += len(new)
            if held >= SLICE:
                yield block()
                signs, owners, held = [], [], 0
    if signs:
        yield block()


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


def hash_of(windows: np.ndarray) -> np.ndarray:
    """The hash of each row of signs; it begins at the last, so that suffixes are met on the way."""
    h = np.zeros(len(windows), np.uint64)
    for j in range(windows.shape[1] - 1, -1, -1):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + windows[:, j].astype(np.uint64) + np.uint64(1))
    return h


def windows_of(signs: np.ndarray, own: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The strings of order signs that end at a text's own signs, as a view and the rows of it that count."""
    return np.lib.stride_tricks.sliding_window_view(signs, order), np.flatnonzero(own[order - 1 :])


class _Counter:
    """The strings of one language in a task: their hashes in order, counts and signs."""

    def __init__(self) -> None:
        self.parts, self.size = [], 0

    def add(self, signs: np.ndarray, own: np.ndarray, order: int) -> None:
        view, rows = windows_of(signs, own, order)
        keys, first, counts = np.unique(hash_of(view)[rows], return_index=True, return_counts=True)
        self.parts.append((keys, counts, view[rows[first]]))
        self.size += len(keys)

    def merge(self) -> None:
        keys, counts, strings = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        at = np.argsort(keys, kind="stable")
        keys, counts, strings = keys[at], counts[at], strings[at]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        self.parts = [(keys[first], np.add.reduceat(counts, first), strings[first])]
        self.size = len(first)

    def rows(self, lang: str) -> Iterator[pa.RecordBatch]:
        if self.parts:
            self.merge()
            _, counts, signs = self.parts[0]
            strings = np.ascontiguousarray(signs).view(f"<U{signs.shape[1]}").ravel()
            for at in range(0, len(counts), 65_536):
                part = strings[at : at + 65_536].tolist()
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), pa.array(part, pa.string()), pa.array(counts[at : at + 65_536], pa.int64())], ["lang", "gram", "n"])
        self.parts, self.size = [], 0


def counted(order: int):
    """A function of batches (lang, text) to (lang, gram, n): a task's strings, handed on when GATHERED differ."""

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[str, _Counter] = {}
        for part in batches:
            texts: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                found, letters = normal(text or "")
                if letters:
                    texts.setdefault(lang, []).append(found)
            for lang, found in texts.items():
                counter = counters.setdefault(lang, _Counter())
                for signs, own, _ in pieces(found, order):
                    counter.add(signs, own, order)
            if sum(c.size for c in counters.values()) > GATHERED:
                for counter in counters.values():
                    if counter.parts:
                        counter.merge()
                if sum(c.size for c in counters.values()) > GATHERED // 2:
                    for lang, counter in counters.items():
                        yield from counter.rows(lang)
        for lang, counter in counters.items():
            yield from counter.rows(lang)

    return run


@frugal
def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(code, gram, value) to (code, hash, value); a code's last four bits are the string's length."""
    for part in batches:
        grams, sizes = part.column("gram").to_pylist(), part.column("code").to_numpy() % 16
        out = np.zeros(len(grams), np.uint64)
        for k in np.unique(sizes):
            at = np.flatnonzero(sizes == k)
            out[at] = hash_of(np.frombuffer("".join(grams[i] for i in at).encode("utf-32-le"), np.uint32).reshape(len(at), k))
        yield pa.RecordBatch.from_arrays([part.column("code"), pa.array(out.view(np.int64)), part.column("value")], ["code", "hash", "value"])


@dataclass
class Model:
    """By language: sorted hashes and discounted probabilities of strings of each order, and weights of contexts of each length."""

    langs: list[str]
    order: int
    floor: float
    strings: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]
    contexts: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]
    rest: list[float]
    slope: float = 1.0
    power: float = 0.0
    limits: list[float] = field(default_factory=list)
    #: Strings and contexts beyond the arrays: (code, hash, value), which codes have any, and the filter's bits.
    tail: DataFrame | None = None
    tail_codes: frozenset[int] = frozenset()
    bitmap: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"tail": None}  # tasks have no use for a frame

    def lookups(self, windows: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """(language, kind, size, hashes, values, whether the tail may hold the value) of all that the bits of rows of order signs need, orders ascending."""
        n, order = windows.shape
        ends = [hash_of(windows[:, order - k :]) for k in range(1, order + 1)]
        before = [hash_of(windows[:, order - 1 - k : order - 1]) for k in range(1, order)]
        for j in range(len(self.langs)):
            for kind, k, table, keys, default in [(0, 1, self.strings, ends[0], 0.0)] + [x for k in range(2, order + 1) for x in ((0, k, self.strings, ends[k - 1], 0.0), (1, k - 1, self.contexts, before[k - 2], 1.0))]:
                values, hit = found(table.get((j, k)), keys, default)
                code, maybe = j * 32 + kind * 16 + k, np.zeros(n, bool)
                if code in self.tail_codes:
                    at = np.flatnonzero(~hit)
                    maybe[at[may_hold(self.bitmap, code, keys[at])]] = True
                yield j, kind, k, keys, values, maybe

    def bits(self, windows: np.ndarray, known: dict[int, tuple[np.ndarray, np.ndarray]] | None = None) -> np.ndarray:
        """Each language's bits for the last sign of each row of order signs after those before it.

        A row of which the tail may hold a value is NaN, unless known gives what the tail holds: (rows, values) by code.
        """
        out, open_rows = np.empty((len(windows), len(self.langs)), np.float32), np.zeros(len(windows), bool)
        p = held = None
        for j, kind, k, _, values, maybe in self.lookups(windows):
            if known is None:
                open_rows |= maybe
            elif (code := j * 32 + kind * 16 + k) in known:
                values[known[code][0]] = known[code][1]
            if kind == 0 and k == 1:
                p = self.floor * self.rest[j] + values
            elif kind == 0:
                held = values
            else:
                p = held + values * p
            if k == self.order - 1 and kind == 1 or self.order == 1:
                out[:, j] = -np.log2(p)
        out[open_rows] = np.nan
        return out


def found(table: tuple[np.ndarray, np.ndarray] | None, keys: np.ndarray, default: float) -> tuple[np.ndarray, np.ndarray]:
    """The values of keys in a table of sorted hashes, default where it lacks them, and whether it has them."""
    if table is None or not len(table[0]):
        return np.full(len(keys), default), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
    hit = table[0][at] == keys
    return np.where(hit, table[1][at], default), hit


def places(size: int, code: np.ndarray | int, keys: np.ndarray) -> Iterator[np.ndarray]:
    """The bits of a filter of so many that stand for (code, hash)."""
    h = mixed(keys ^ (np.uint64(0x9E3779B97F4A7C15) * (np.asarray(code, np.uint64) + np.uint64(1))))
    step = mixed(h) | np.uint64(1)
    for _ in range(PROBES):
        yield h & np.uint64(size - 1)
        h = h + step


def may_hold(bitmap: np.ndarray, code: int, keys: np.ndarray) -> np.ndarray:
    """The places of those keys that a filter may hold."""
    at = np.arange(len(keys))
    for i in range(PROBES):
        bit = next(itertools.islice(places(64 * len(bitmap), code, keys[at]), i, None))
        at = at[(bitmap[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1]
    return at


def marks(size: int):
    """A function of batches (code, hash) to (word, mask): the bits of a filter of so many, by 64-bit words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            bit = np.concatenate(list(places(size, part.column("code").to_numpy().astype(np.uint64), part.column("hash").to_numpy().view(np.uint64))))
            mask = np.uint64(1) << (bit & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array((bit >> np.uint64(6)).astype(np.int64)), pa.array(mask.view(np.int64))], ["word", "mask"])

    return run


def measured(model):
    """A function of batches (doc_id, text) to (doc_id, letters, n, bits, open): each language's sum of bits, and the strings left to the tail with their numbers."""

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        cells = 1 << max(8, (8 * CELLS // max(len(known.langs), 1)).bit_length() - 1)
        keys, values = np.zeros(cells, np.uint64), np.zeros((cells, len(known.langs)), np.float32)
        for part in batches:
            texts, letters = zip(*[normal(t or "") for t in part.column("text").to_pylist()], strict=True) if part.num_rows else ((), ())
            sums, opened = np.zeros((part.num_rows, len(known.langs))), [{} for _ in range(part.num_rows)]
            for signs, own, owner in pieces(list(texts), known.order):
                view, rows = windows_of(signs, own, known.order)
                h = hash_of(view)[rows]
                cell = (h & np.uint64(cells - 1)).astype(np.int64)
                at = np.flatnonzero(keys[cell] != h)
                bits = values[cell]
                if len(at):  # strings that the table of known ones lacks; of those that share a cell one stays
                    fresh, first, back = np.unique(h[at], return_index=True, return_inverse=True)
                    got = known.bits(view[rows[at[first]]])
                    bits[at] = got[back]
                    place = (fresh & np.uint64(cells - 1)).astype(np.int64)
                    _, one = np.unique(place, return_index=True)
                    keys[place[one]], values[place[one]] = fresh[one], got[one]
                left = np.flatnonzero(np.isnan(bits[:, 0]))
                if len(left):
                    bits[left] = 0
                    for mine, gram in zip(owner[left].tolist(), np.ascontiguousarray(view[rows[left]]).view(f"<U{known.order}").ravel().tolist(), strict=True):
                        opened[mine][gram] = opened[mine].get(gram, 0) + 1
                begin = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                sums[owner[begin]] += np.add.reduceat(bits, begin, axis=0, dtype=np.float64)
            n = np.array([len(t) for t in texts], np.int64)
            grams = pa.array([list(x.items()) for x in opened], pa.map_(pa.string(), pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(letters, pa.bool_()), pa.array(n), pa.array(list(sums), pa.list_(pa.float64())), grams], ["doc_id", "letters", "n", "bits", "open"])

    return run


def signs_of(grams: list[str], order: int) -> np.ndarray:
    return np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32).reshape(len(grams), order)


def sought(model):
    """A function of batches (gram) to (gram, code, hash): what the tail may hold of each string's bits."""

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for j, kind, k, keys, _, maybe in model.value.lookups(signs_of(part.column("gram").to_pylist(), model.value.order)):
                if len(at := np.flatnonzero(maybe)):
                    yield pa.RecordBatch.from_arrays([part.column("gram").take(pa.array(at)), pa.array(np.full(len(at), j * 32 + kind * 16 + k, np.int32)), pa.array(keys[at].view(np.int64))], ["gram", "code", "hash"])

    return run


def settled(model):
    """A function of batches (gram, codes, values) to (gram, bits): the bits of strings, given what the tail holds of them."""

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            sizes = np.array([len(x or ()) for x in part.column("codes").to_pylist()], np.int64)
            rows = np.repeat(np.arange(part.num_rows), sizes)
            codes, values = (np.array([y for x in part.column(c).to_pylist() for y in x or ()], t) for c, t in (("codes", np.int64), ("values", np.float32)))
            known = {int(c): (rows[codes == c], values[codes == c]) for c in np.unique(codes)}
            bits = model.value.bits(signs_of(part.column("gram").to_pylist(), model.value.order), known)
            yield pa.RecordBatch.from_arrays([part.column("gram"), pa.array(list(bits), pa.list_(pa.float32()))], ["gram", "bits"])

    return run


def orders(counts: DataFrame, order: int) -> Iterator[tuple[int, DataFrame]]:
    """(k, (lang, gram, c)) from the longest strings down: counts, then continuation counts."""
    rows = counts.withColumnRenamed("n", "c")
    for k in range(order, 0, -1):
        yield k, rows
        if k > 1:
            rows = saved(rows.groupBy("lang", F.substring("gram", 2, k - 1).alias("gram")).agg(F.count(F.lit(1)).alias("c")))


def learned(counts: DataFrame, order: int = ORDER, most: int = MOST) -> Model:
    """The model of counts (lang, gram, n) of strings of order characters, at most 15."""
    langs = sorted(r[0] for r in counts.select("lang").distinct().collect())  # the languages themselves
    number = F.array_position(F.array(*[F.lit(x) for x in langs]), F.col("lang")).cast("int") - 1
    code = lambda kind, size: (number * 32 + kind * 16 + size).alias("code")
    tables, signs, whole = [], 0, True
    for k, rows in orders(counts, order):
        one, two = F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)
        discount = F.when(one * two > 0, one / (one + 2 * two)).otherwise(F.lit(0.5))
        discounts = rows.groupBy("lang").agg(F.greatest(F.lit(0.05), F.least(F.lit(0.95), discount)).alias("d"))
        totals = rows.groupBy("lang", F.substring("gram", 1, k - 1).alias("context")).agg(F.sum("c").alias("total"))
        part = rows.withColumn("w", F.sum("c").over(Window.partitionBy("gram"))).withColumn("context", F.substring("gram", 1, k - 1)).join(totals, ["lang", "context"]).join(discounts, "lang")
        part = saved(part.select("lang", "context", "gram", ((F.col("c") - F.col("d")) / F.col("total")).cast("float").alias("value"), F.col("c"), "w"))
        weights = part.groupBy("lang", F.col("context").alias("gram")).agg((1 - F.sum("value")).cast("float").alias("value"), F.sum("c").alias("total"))
        weights = saved(weights.withColumn("w", F.sum("total").over(Window.partitionBy("gram"))))
        for kind, size, found_rows in ((0, k, part), (1, k - 1, weights)):
            fits = found_rows.agg(*[F.count_if(F.col("w") >= 2**j).alias(f"c{j}") for j in range(40)]).first()
            cutoff = next((2**j for j in range(40) if (fits[j] or 0) <= most), 2**40)
            near = F.lit(True) if (kind, size) == (1, 0) else F.col("w") >= cutoff  # the context of no signs is always at hand
            whole = whole and (cutoff == 1 or (kind, size) == (1, 0))
            tables.append(found_rows.select(code(kind, size), "gram", "value", near.alias("near")))
        signs = rows.select("gram").distinct().count() if k == 1 else 0
    every = tables[0]
    for t in tables[1:]:
        every = every.union(t)
    keyed = every.where("near").select("code", "gram", "value").mapInArrow(_keyed, "code int, hash long, value float")
    rows = keyed.toArrow()
    codes, keys, values = rows.column("code").to_numpy(), rows.column("hash").to_numpy().view(np.uint64), rows.column("value").to_numpy()
    held: tuple[dict, dict] = ({}, {})
    for j in range(len(langs)):
        for kind in (0, 1):
            for k in range(order + 1):
                at = np.flatnonzero(codes == j * 32 + kind * 16 + k)
                if len(at):
                    at = at[np.argsort(keys[at])]
                    held[kind][j, k] = keys[at], values[at]
    model = Model(langs, order, 1 / (signs + 1), held[0], held[1], [float(held[1].pop((j, 0), (None, [1.0]))[1][0]) for j in range(len(langs))])
    if not whole:
        model.tail = saved(every.where("not near").select("code", "gram", "value").mapInArrow(_keyed, "code int, hash long, value float"))
        model.tail_codes = frozenset(r[0] for r in model.tail.select("code").distinct().collect())  # two a language and order
        size = 1 << min(FILTER.bit_length() - 1, max(6, (256 * model.tail.count()).bit_length()))
        found_bits = model.tail.select("code", "hash").mapInArrow(marks(size), "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
        model.bitmap = np.zeros(size // 64, np.uint64)
        model.bitmap[found_bits.column("word").to_numpy()] = found_bits.column("mask").to_numpy().view(np.uint64)
    return model


def bits_of(docs: DataFrame, model, tail: DataFrame | None = None) -> DataFrame:
    """(doc_id, letters, n, bits) of docs by a broadcast model, and its tail where it has one: each language's mean bits a character."""
    python_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").mapInArrow(measured(model), f"doc_id {kind}, letters boolean, n long, bits array<double>, open map<string,long>")
    mean = lambda sums: F.transform(sums, lambda x: x / F.greatest("n", F.lit(1)))
    if tail is None:
        return rows.select("doc_id", "letters", "n", mean("bits").alias("bits"))
    rows = saved(rows.withColumn("row", F.monotonically_increasing_id()))
    opened = rows.select("row", F.explode("open").alias("gram", "times"))
    grams = saved(opened.select("gram").distinct())
    held = grams.mapInArrow(sought(model), "gram string, code int, hash long").join(tail, ["code", "hash"])
    held = held.groupBy("gram").agg(F.collect_list(F.struct("code", "value")).alias("x")).select("gram", F.col("x.code").alias("codes"), F.col("x.value").alias("values"))
    bits = grams.join(held, "gram", "left").select("gram", "codes", "values").mapInArrow(settled(model), "gram string, bits array<float>")
    # Sums of whole numbers, so that they come out the same in whatever order rows arrive.
    parts = opened.join(bits, "gram").select("row", F.posexplode("bits").alias("lang", "b"), "times")
    sums = parts.groupBy("row", "lang").agg((F.sum(F.round(F.col("b").cast("double") * 2**32).cast("long") * F.col("times")) / 2**32).alias("more"))
    sums = sums.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("lang", "more")))["more"].alias("more"))
    both = rows.join(sums, "row", "left").withColumn("bits", F.when(F.col("more").isNull(), F.col("bits")).otherwise(F.zip_with("bits", "more", lambda a, b: a + b)))
    return both.select("doc_id", "letters", "n", mean("bits").alias("bits"))


def confidence(bits: np.ndarray, n: np.ndarray, slope: float, power: float) -> np.ndarray:
    """The share of each language in a softmax of minus its bits."""
    gap = (bits - bits.min(axis=1, keepdims=True)) * (slope * np.maximum(n, 1) ** power)[:, None]
    weight = np.exp(-np.minimum(gap, 700))
    return weight / weight.sum(axis=1, keepdims=True)


def calibrate(model: Model, truth: list[str], bits: np.ndarray, n: np.ndarray) -> None:
    """Slope, power and limits from rows that taught the model nothing."""
    known = np.array([t in model.langs for t in truth], bool)
    right = np.array([model.langs.index(t) if t in model.langs else 0 for t in truth])
    model.limits = [float("inf")] * len(model.langs)
    if not known.any():
        return
    bits, n, right = bits[known], n[known], right[known]
    loss = lambda s, p: -np.log(np.maximum(confidence(bits, n, s, p)[np.arange(len(right)), right], 1e-12)).mean()
    model.slope, model.power = min(((s, p) for p in (0.0, 0.5, 1.0) for s in 2.0 ** np.arange(-8, 8)), key=lambda x: loss(*x))
    own = bits[np.arange(len(right)), right]
    for j in range(len(model.langs)):
        rows = own[right == j] if (right == j).sum() >= 20 else own
        model.limits[j] = float(np.quantile(rows, 0.999))


def fit(docs: DataFrame, learn: Column, order: int = ORDER, most: int = MOST, calibration: int = CALIBRATION) -> Model | None:
    """The calibrated model of the rows of docs (doc_id, text, lang) for which learn holds; None where nothing can be learnt."""
    python_batches(docs.sparkSession)
    rows = docs.where(learn & F.col("lang").isNotNull()).select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    n = rows.count()
    draw = F.md5(F.concat(F.lit("calibration-"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    apart = saved(rows.select("doc_id").orderBy(draw, "doc_id").limit(min(calibration, n // 10)).distinct())
    taught = rows.join(F.broadcast(apart), "doc_id", "left_anti")
    counts = saved(taught.select("lang", "text").mapInArrow(counted(order), "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    if not counts.limit(1).count():
        return None
    model = learned(counts, order, most)
    test = rows.join(F.broadcast(apart), "doc_id", "left_semi").withColumnRenamed("doc_id", "_id").withColumn("doc_id", F.struct("_id", "lang")).select("doc_id", "text")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    got = bits_of(test, sent, model.tail).where("letters").select("doc_id.lang", "n", "bits").collect()
    calibrate(model, [r[0] for r in got], np.array([r[2] for r in got], float).reshape(len(got), len(model.langs)), np.array([r[1] for r in got], np.int64))
    dropped(apart, counts)
    return model


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score, bits, rejected) of each row of docs: the best language, its share, its bits a character, and whether these pass its limit."""
    none = F.lit(None).cast("double")
    if model is None:
        return docs.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), none.alias("bits"), F.lit(True).alias("rejected"))
    rows = bits_of(docs, docs.sparkSession.sparkContext.broadcast(model), model.tail)
    best = F.array_min("bits")
    scale = F.lit(float(model.slope)) * F.pow(F.greatest("n", F.lit(1)).cast("double"), F.lit(float(model.power)))
    share = 1 / F.aggregate("bits", F.lit(0.0), lambda s, x: s + F.exp(-F.least(F.lit(700.0), (x - best) * scale)))
    place = F.array_position("bits", best).cast("int")
    at = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), place)
    return rows.select(
        "doc_id", F.when(F.col("letters"), at(model.langs)).otherwise(F.lit(UNKNOWN)).alias("lang_pred"), F.when(F.col("letters"), share).otherwise(F.lit(0.0)).alias("score"),
        F.when(F.col("letters"), best).alias("bits"), F.when(F.col("letters"), best > at(model.limits)).otherwise(F.lit(True)).alias("rejected"),
    )
