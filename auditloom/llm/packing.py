"""Best-fit packing of tokenised documents into sequences, by bounded-space online best fit.

Documents are tokenised in Arrow batches; only the place, length and checksum of each piece move on.
Pieces are dealt by hash into groups of about ``group_tokens`` tokens, and each group is packed on its
own: at most ``open_bins`` bins are open, a bitset marks which amounts of free space occur among them,
and a piece goes to the bin whose free space is least among those that hold it (the lowest set bit from
its length on). If none holds it and no more may open, the fullest open bin closes. A group's tokens and
rows are bounded, however large one document or one source is and however short documents are.

Defined results: a null text is empty and gives the end id alone; a null id stays null and other ids
are kept exactly; a document longer than a sequence is cut into whole sequences and a rest, which may be
packed with others; repeated rows are packed each; an empty table gives no row; other columns are left out.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.llm.common import frugal, python_batches, saved
from auditloom.llm.shingles import span_keys, word_spans

SEQUENCE = 4096
END_ID = 1
#: Words of which a Python worker remembers the ids; then it starts anew.
REMEMBERED = 1_000_000
#: Bytes of texts whose words are looked up together.
PART_BYTES = 1 << 18
#: Tokens and pieces that a group holds about; 4096 sequences' worth, so that the open bins are far fewer than the bins.
GROUP_TOKENS = 1 << 24
GROUP_PIECES = 1 << 18
OPEN_BINS = 256

_GAP = re.compile(rb"[\x20\x09-\x0D]")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ALNUM = np.array([chr(b).isalnum() and b < 128 for b in range(256)])


def _byte_signs() -> list[str]:
    """The sign by which a byte-level vocabulary writes each byte: itself if printable, else the next free one from 256 on."""
    own = [33 <= b <= 126 or 161 <= b <= 172 or b >= 174 for b in range(256)]
    return [chr(b if own[b] else 256 + b - sum(own[:b])) for b in range(256)]


class WordIds:
    """Ids of texts, word by word, with arrays in place of a loop over words.

    The tokenizer drops white space and merges within words only, so that a text's ids are those of its
    words in a row, and a word is encoded once. It lower-cases ASCII letters anyway (but for its special
    tokens, which begin with ``<|``; texts with these go to it whole), and a full stop or comma after an
    ASCII letter or digit is a piece of its own. Words are known by 64-bit hashes, kept sorted.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, signs = self.tokenizer.model, _byte_signs()
        self.model._resize_cache(0)  # no word comes twice
        self.signs = {b: signs[b] for b in range(256)} | {32: " "}
        self._forget()

    def _forget(self) -> None:
        self.keys, self.first, self.sizes, self.flat, self.used = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1 << 16, np.uint32), 0

    def _encoded(self, words: list[bytes], plain: np.ndarray) -> list[list[int]]:
        """A word of Latin letters alone is one piece, lower-cased and composed already: the model takes it as it is. plain: ASCII letters only."""
        tokenize, signs, rest = self.model.tokenize, self.signs, []
        mapped = b" ".join(words).decode("latin-1").translate(signs).split(" ")
        out: list = [None] * len(words)
        for k, sure in enumerate(plain.tolist()):
            if not sure:
                word = words[k].decode()
                if not (word.isalpha() and max(word) < "\u0250" and word == word.lower()):
                    rest.append((k, word))
                    continue
            out[k] = [t.id for t in tokenize(mapped[k])]
        if rest:
            for (k, _), e in zip(rest, self.tokenizer.encode_batch_fast([w for _, w in rest], add_special_tokens=False), strict=True):
                out[k] = e.ids
        return out

    def _learn(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        if len(self.keys) + len(keys) > REMEMBERED:
            self._forget()
        sizes = ends - starts
        at = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        held = _LOWER[data[at]]
        odd = np.concatenate([[0], np.cumsum((held < 97) | (held > 122))])
        stops = np.cumsum(sizes)
        raw = held.tobytes()
        words = [raw[a:b] for a, b in zip((stops - sizes).tolist(), stops.tolist(), strict=True)]
        ids = self._encoded(words, odd[stops] == odd[stops - sizes])
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        fresh = np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum()))
        if self.used + len(fresh) > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(self.used + 2 * len(fresh), np.uint32)])
        self.flat[self.used : self.used + len(fresh)] = fresh
        begin = self.used + np.cumsum(lengths) - lengths
        self.used += len(fresh)
        keys, begin, lengths = np.concatenate([self.keys, keys]), np.concatenate([self.first, begin]), np.concatenate([self.sizes, lengths])
        order = np.argsort(keys, kind="stable")
        self.keys, self.first, self.sizes = keys[order], begin[order], lengths[order]

    def _found(self, keys: np.ndarray) -> np.ndarray:
        """Places of keys among those known; -1 where they lack."""
        at = np.searchsorted(self.keys, keys)
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(at, len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def _part(self, texts: list[bytes]) -> list[np.ndarray]:
        data = np.frombuffer(b"".join(texts), np.uint8)
        bounds = np.cumsum([0, *map(len, texts)])
        starts, ends = word_spans(data, bounds)
        if not len(starts):
            return [np.zeros(0, np.uint32)] * len(texts)
        last = data[ends - 1]
        apart = ((last == 46) | (last == 44)) & (ends - starts > 1) & _ALNUM[data[ends - 2]]
        times = 1 + apart
        tail = np.cumsum(times)[apart] - 1
        starts, ends, cut = np.repeat(starts, times), np.repeat(ends, times), ends[apart] - 1
        starts[tail], ends[tail - 1] = cut, cut
        keys, sample, back = np.unique(span_keys(data, starts, ends), return_index=True, return_inverse=True)
        place = self._found(keys)
        if (lacking := place < 0).any():
            full = len(self.keys) + int(lacking.sum()) > REMEMBERED
            lacking |= full
            self._learn(keys[lacking], data, starts[sample[lacking]], ends[sample[lacking]])
            place = self._found(keys)
        sizes = self.sizes[place][back]
        stops = np.cumsum(sizes)
        ids = self.flat[np.repeat(self.first[place][back] - stops + sizes, sizes) + np.arange(stops[-1])]
        edges = np.concatenate([[0], stops])[np.searchsorted(starts, bounds)].tolist()
        return [ids[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each text. Texts are taken up in parts of about PART_BYTES, cut at white space."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        held: list[tuple[int, bytes]] = []
        size = 0

        def settle() -> None:
            for (k, _), ids in zip(held, self._part([t for _, t in held]), strict=True):
                out[k].append(ids)

        for k, text in enumerate(texts):
            if b"<|" in text:
                out[k].append(np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, np.uint32))
                continue
            while text:
                cut = text
                if len(text) > PART_BYTES and (gap := _GAP.search(text, PART_BYTES)):
                    cut = text[: gap.start()]
                held.append((k, cut))
                size += len(cut)
                text = text[len(cut) :]
                if size >= PART_BYTES:
                    settle()
                    held, size = [], 0
        settle()
        return [b"".join(x.astype("<u4").tobytes() for x in parts) for parts in out]


_words: dict[str, WordIds] = {}


@frugal
def tokenised(batches: Iterator[pa.RecordBatch], path: str, sequence: int, end: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, piece, start, length, ids_crc32) for each piece of each document."""
    words = _words.get(path) or _words.setdefault(path, WordIds(path))
    tail = end.to_bytes(4, "little")
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1).cast(pa.binary())
        out: tuple[list, ...] = ([], [], [], [], [])
        for lo in range(0, len(ids), 256):
            part = [t or b"" for t in texts.slice(lo, 256).to_pylist()]
            for doc, data in zip(ids.slice(lo, 256).to_pylist(), words.encode(part), strict=True):
                data += tail
                for piece, at in enumerate(range(0, len(data), 4 * sequence)):
                    cut = data[at : at + 4 * sequence]
                    for column, value in zip(out, (doc, piece, at // 4, len(cut) // 4, zlib.crc32(cut)), strict=True):
                        column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], batch.schema.field(0).type), pa.array(out[1], pa.int32()), *[pa.array(x, pa.int64()) for x in out[2:]]], names=["doc_id", "piece", "start", "length", "ids_crc32"])


class OpenBins:
    """At most ``most`` open bins, found by free space."""

    def __init__(self, most: int = OPEN_BINS, size: int = SEQUENCE):
        self.most, self.size, self.spaces, self.bins, self.count, self.made = most, size, 0, [[] for _ in range(size + 1)], 0, 0

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) for a piece of this length."""
        fits = self.spaces >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            found = self._take(free)
        else:
            if self.count == self.most:
                self._take((self.spaces & -self.spaces).bit_length() - 1)  # the fullest closes
            free, found, self.made = self.size, self.made, self.made + 1
        if left := free - length:
            self.bins[left].append(found)
            self.spaces |= 1 << left
            self.count += 1
        return found, self.size - free

    def _take(self, free: int) -> int:
        found = self.bins[free].pop()
        if not self.bins[free]:
            self.spaces &= ~(1 << free)
        self.count -= 1
        return found


def packed(rows: pa.Table, open_bins: int, sequence: int) -> pa.Table:
    """A group's pieces in order of id, each with its sequence and offset."""
    rows = rows.sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])  # nulls come last
    bins, n, base = OpenBins(open_bins, sequence), rows.num_rows, rows["_group"][0].as_py() << 32
    sequences, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for k, length in enumerate(rows["length"].to_numpy().tolist()):
        sequences[k], offsets[k] = bins.place(length)
    return rows.drop_columns(["_group"]).append_column("sequence_id", pa.array(sequences + base)).append_column("offset", pa.array(offsets))


def pack(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, end_id: int = END_ID, open_bins: int = OPEN_BINS, group_tokens: int = GROUP_TOKENS, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for each piece of docs."""
    python_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    plain = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    pieces = saved(docs.select("doc_id", "text").mapInArrow(lambda b: tokenised(b, tokenizer_path, sequence, end_id), plain).withColumn("_row", F.monotonically_increasing_id()))
    tokens, n = pieces.agg(F.sum("length"), F.count(F.lit(1))).first()
    groups = max(1, -(-(tokens or 0) // group_tokens), -(-n // group_pieces))
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("_row", "ids_crc32"), F.lit(groups)).cast("int")).drop("_row")
    return dealt.groupBy("_group").applyInArrow(lambda rows: packed(rows, open_bins, sequence), f"{plain}, sequence_id long, offset long")
