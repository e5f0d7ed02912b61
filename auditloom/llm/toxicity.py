"""Toxicity by compression distance: two zstandard dictionaries, window by window.

Each dictionary is trained by zstandard on text of its class. What toxic documents have in common with
ordinary ones would fill the toxic one, so its samples are the passages of toxic documents that ordinary
documents lack (runs of 5-byte strings whose rate is ``ENRICHED`` times higher); the ordinary one's are
pieces of ordinary documents. Both go on with one common stock of ordinary text, which is nearest to a
window and serves what both have alike. A document is cut at white space into windows of about 64 bytes;
how many bytes shorter a window becomes with the toxic dictionary is its distance.

Calibration: a logistic function of the number of windows at each distance is fitted on distances under
dictionaries that did not see the row (``FOLDS`` folds), and moved to the share of toxic rows among all
rows that may be learnt from. The score is then a probability at the corpus's own rate, so the threshold
of 0.3 means the same at every size, whatever part of each class is fitted on.

At most ``FIT_ROWS`` toxic and twice as many ordinary labelled rows, the first by md5 of their id, are
fitted on the driver, ``FIT_BYTES`` bytes in all (a third of them toxic); a row whose text is longer
than the room left is passed over and takes none. Stock and samples are spread evenly over all fitted
texts, from end to end. Every document is scored over its whole text, however long.

Defined results: null and empty texts have one empty window; rows without a label are never learnt
from; of labels that contradict, toxic counts; a null id is never held out; where a class has fewer than
three rows, every score is the share of toxic rows among those that have a label (0 without any).
Repeated rows are scored each; an empty table gives no row; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.llm.common import frugal, python_batches, saved
from auditloom.llm.shingles import mixed

WINDOW = 64
STOCK_BYTES = 100_000
STOCK_PIECE = 600
OWN_BYTES = 4096
GRAM = 5
ENRICHED = 30
FIT_ROWS = 2000
FIT_BYTES = 24_000_000
THRESHOLD = 0.3
STEPS = 9
LEVEL = 12
FOLDS = 3
#: Pieces of ordinary text that the ordinary dictionary is trained on, and the bytes of each.
SAMPLES = 20_000
SAMPLE_BYTES = 256
#: Cells (a power of two) in which documents are counted by the 5-byte strings they hold.
CELLS = 1 << 22


def grams(text: bytes) -> np.ndarray:
    """Cells of all runs of GRAM bytes."""
    a = np.frombuffer(text, np.uint8).astype(np.uint64)
    n = len(a) - GRAM + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(GRAM if n > 0 else 0):
        out = (out << np.uint64(8)) | a[k : n + k]
    return (mixed(out) & np.uint64(CELLS - 1)).astype(np.int32)


def document_counts(texts: list[bytes]) -> np.ndarray:
    """How many texts hold each cell."""
    out = np.zeros(CELLS, np.int32)
    for t in texts:
        out[np.unique(grams(t))] += 1
    return out


def enriched(toxic: list[bytes], plain: list[bytes]) -> np.ndarray:
    """For each cell, whether toxic texts hold it so much more often."""
    ours, theirs = document_counts(toxic), document_counts(plain)
    rate = min(ENRICHED, len(plain) / 3)
    return (ours >= max(3, 0.01 * len(toxic))) & (ours * (len(plain) / len(toxic)) >= rate * (theirs + 1))


def passages(text: bytes, rich: np.ndarray) -> list[bytes]:
    cover = np.zeros(len(text) + 2, np.int32)
    at = np.flatnonzero(rich[grams(text)])
    np.add.at(cover, at + 1, 1)
    np.add.at(cover, at + GRAM + 1, -1)
    edges = np.flatnonzero(np.diff((np.cumsum(cover) > 0).astype(np.int8)))
    return [text[a:b] for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]


def spread(texts: list[bytes], n: int, size: int) -> list[bytes]:
    """n pieces of so many bytes from texts at even distances, from places all over them."""
    out = []
    for j in range(n if texts else 0):
        text = texts[j * len(texts) // n]
        at = int(j * 0.6180339887 % 1 * max(0, len(text) - size))
        out.append(text[at : at + size])
    return out


def trained(samples: list[bytes], size: int) -> bytes:
    """The content that zstandard's trainer picks from samples; the samples themselves where they are too few to train on."""
    try:
        data = zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        data = b" ".join(dict.fromkeys(samples))
    return data[-(size * 3 // 4) :]


def windows(text: bytes) -> list[bytes]:
    a = np.frombuffer(text, np.uint8)
    gaps = np.flatnonzero((a == 32) | ((a >= 9) & (a <= 13)))
    grid = np.arange(WINDOW, len(a), WINDOW)
    cuts = grid
    if len(gaps):
        at = np.searchsorted(gaps, grid)
        cuts = np.minimum(np.where(at < len(gaps), gaps[np.minimum(at, len(gaps) - 1)], grid + WINDOW), grid + WINDOW)
    edges = np.unique(np.concatenate([[0], np.minimum(cuts, len(a)), [len(a)]])).tolist()
    return [text[x:y] for x, y in zip(edges, edges[1:], strict=False)] or [b""]


class Distances:
    """Window lengths under the ordinary dictionary less those under the toxic one."""

    def __init__(self, toxic: bytes, plain: bytes):
        self.dictionaries = toxic, plain
        self._ready()

    def _ready(self) -> None:
        self.lengths = []
        for content in self.dictionaries:
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.lengths.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress)

    def __getstate__(self) -> tuple:
        return self.dictionaries

    def __setstate__(self, state: tuple) -> None:
        self.dictionaries = state
        self._ready()

    def features(self, text: bytes) -> list[float]:
        toxic, plain = self.lengths
        cut = windows(text.lower())
        gains = np.fromiter((len(plain(w)) - len(toxic(w)) for w in cut), np.int64, len(cut))
        counts = [np.log1p(np.count_nonzero(gains >= k)) for k in range(1, STEPS + 1)]
        return [*counts, float(np.clip(gains.max(), -5, 20)), float(np.log1p(len(cut)))]


def dictionaries(toxic: list[bytes], plain: list[bytes]) -> Distances:
    rich = enriched(toxic, plain)
    extra = trained([p for t in toxic for p in passages(t, rich)] or toxic, OWN_BYTES)
    stock = b" ".join(spread(plain, STOCK_BYTES // STOCK_PIECE, STOCK_PIECE))
    other = trained(spread(plain, SAMPLES, SAMPLE_BYTES), OWN_BYTES)
    return Distances(extra + stock, other + stock)


class Model:
    """Dictionaries of all rows; the logistic weights come from distances under dictionaries that did not see the row.

    population: how many toxic and ordinary rows the given ones stand for; the given ones themselves if None.
    """

    def __init__(self, toxic: list[bytes], plain: list[bytes], population: tuple[int, int] | None = None):
        toxic, plain = [t.lower() for t in toxic], [t.lower() for t in plain]
        n_toxic, n_plain = population or (len(toxic), len(plain))
        self.share = n_toxic / max(1, n_toxic + n_plain)
        self.distances = None
        if len(toxic) < FOLDS or len(plain) < FOLDS:
            return
        rows, marks = [], []
        for k in range(FOLDS):
            unseen = dictionaries([t for i, t in enumerate(toxic) if i % FOLDS != k], [t for i, t in enumerate(plain) if i % FOLDS != k])
            rows += [unseen.features(t) for t in [*toxic[k::FOLDS], *plain[k::FOLDS]]]
            marks += [1.0] * len(toxic[k::FOLDS]) + [0.0] * len(plain[k::FOLDS])
        self.distances = dictionaries(toxic, plain)
        self._fit(np.array(rows), np.array(marks))
        self.bias += float(np.log(n_toxic / len(toxic)) - np.log(n_plain / len(plain)))

    def _fit(self, x: np.ndarray, y: np.ndarray) -> None:
        """Ridge logistic regression by Newton's steps."""
        mean, scale = x.mean(0), x.std(0) + 1e-9
        z = np.c_[(x - mean) / scale, np.ones(len(x))]
        w, ridge = np.zeros(z.shape[1]), np.r_[np.ones(x.shape[1]), 0.0]
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            w = w - np.linalg.solve((z.T * (p * (1 - p))) @ z + np.diag(ridge + 1e-6), z.T @ (p - y) + ridge * w)
        self.weights, self.bias = w[:-1] / scale, w[-1] - float((w[:-1] * mean / scale).sum())

    def score(self, text: bytes) -> float:
        if self.distances is None:
            return self.share
        return float(1 / (1 + np.exp(-np.clip(np.dot(self.weights, self.distances.features(text)) + self.bias, -30, 30))))


def fit(docs: DataFrame, labels: DataFrame, learn=None, rows: int = FIT_ROWS, most_bytes: int = FIT_BYTES) -> Model:
    """A model of the labelled documents; learn: which label rows may be learnt from."""
    known = labels.select("doc_id", "toxic").filter("toxic in (0, 1)").filter(F.lit(True) if learn is None else learn).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.md5(F.col("doc_id").cast("string").cast("binary"))
    # Labels count by document row, as the fitted texts do.
    counts = {r["toxic"]: r["n"] for r in docs.select("doc_id").join(known, "doc_id").groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = known.filter("toxic = 1").orderBy(order).limit(rows).union(known.filter("toxic = 0").orderBy(order).limit(2 * rows))
    both = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")  # 3 x rows at most
    texts: dict[int, list[bytes]] = {0: [], 1: []}
    room = {1: most_bytes // 3, 0: most_bytes * 2 // 3}
    for r in saved(both).withColumn("_order", order).orderBy("_order", "text").toLocalIterator():
        data = r["text"].encode()
        if len(data) <= room[r["toxic"]]:
            room[r["toxic"]] -= len(data)
            texts[r["toxic"]].append(data)
    return Model(texts[1], texts[0], (counts.get(1, 0), counts.get(0, 0)))


@frugal
def scored(batches: Iterator[pa.RecordBatch], model: Model, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        scores = np.array([model.score(t.as_py() or b"") for t in texts], np.float64)
        keep = [batch.column(i) for i in range(batch.num_columns) if i != 1]
        names = [n for i, n in enumerate(batch.schema.names) if i != 1]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], names=[*names, "score", "predicted"])


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) for each row of docs."""
    python_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(lambda b: scored(b, model, threshold), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def clean_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with their columns, whose score is below the threshold."""
    python_batches(docs.sparkSession)
    names = docs.columns

    @frugal
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fine = [model.score(t.as_py() or b"") < threshold for t in batch.column(names.index("text")).cast(pa.binary())]
            yield batch.filter(pa.array(fine, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
