"""The joins against brute force: n-gram Jaccard, suffix dedup, embeddings."""

import hashlib
import random
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from pyspark.sql import functions as F

from auditloom.llm import embedding_dedup, ngram_join, repeats, shingles
from tests.llm.helpers import WORD, component_ids, edge_rows, family, frame, lower


def sets_of(text, k):
    w = WORD.findall(lower(text or ""))
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or {tuple(w)}


def test_shingle_sets_match_words():
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["a", "B", "cc", "Dé", " x"]) for _ in range(rng.randrange(9))) + rng.choice(["", "\n", "\x0b"]) for _ in range(300)] + [None, "", "   "]
    for k in (1, 3, 5):
        got, want = shingles.shingle_sets(pa.array(texts, pa.string()), k), [sets_of(t, k) for t in texts]
        assert [len(g) for g in got] == [len(w) for w in want]
        for a, b in combinations(range(0, len(texts), 7), 2):
            assert len(np.intersect1d(got[a], got[b])) == len(want[a] & want[b])
    part = pa.array(["junk here", *texts], pa.string()).slice(1)
    assert [g.tolist() for g in shingles.shingle_sets(part, 3)] == [g.tolist() for g in shingles.shingle_sets(pa.array(texts, pa.string()), 3)]


def check_join(spark, rows, k, percent):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(frame(spark, rows), k, percent).collect()}
    sets = {i: sets_of(t, k) for i, t, _ in rows}
    linked = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    assert got == {i: (len(sets[i]), c) for i, c in component_ids(sets, linked).items()}
    return linked


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_join_finds_all_components(spark, k, percent):
    texts = family(1, 60, 80, 6) + family(2, 40, 30, 3) + family(3, 20, 8, 1) + family(4, 5, 400, 12) + ["a b", "A  b", "a", "", None, " "]
    random.Random(5).shuffle(texts)
    assert check_join(spark, [(i, t, "s") for i, t in enumerate(texts)], k, percent)


def test_join_with_frequent_shingles(spark, monkeypatch):
    """The later rounds, which only large groups reach."""
    monkeypatch.setattr(ngram_join, "SMALL", 3)
    monkeypatch.setattr(ngram_join, "ROUNDS", (1, 2))
    texts = family(1, 50, 60, 7) + family(9, 30, 40, 5)
    assert check_join(spark, [(i, t, "s") for i, t in enumerate(texts)], 3, 90)


def test_join_with_shingles_in_parts(spark, monkeypatch):
    """Shingles that the sketch calls hot are dealt in parts, beside others that are not."""
    hot = np.where(np.arange(1 << 10) % 5 < 2, 200_000, 0).astype(np.int32)
    monkeypatch.setattr(ngram_join, "sketch_of", lambda blocks: hot)
    monkeypatch.setattr(ngram_join, "SMALL", 3)
    monkeypatch.setattr(ngram_join, "ROUNDS", (1,))
    texts = family(1, 30, 60, 7) + family(9, 20, 40, 5)
    assert check_join(spark, [(i, t, "s") for i, t in enumerate(texts)], 3, 90)


def test_sketch_takes_less_than_a_byte_a_shingle():
    rng = np.random.default_rng(2)
    texts = [" ".join(map(str, rng.integers(0, 10**9, 40_000))) for _ in range(30)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(30)), pa.array(texts), pa.array(range(30))], names=["id", "text", "text_key"])
    found = pa.Table.from_batches(ngram_join.described(iter([batch]), 3))
    total = sum(n for n in found["n"].to_pylist() if n)
    binary = [f.name for f in found.schema if pa.types.is_binary(f.type)]
    assert sum(len(v) for c in binary for v in found[c].to_pylist() if v) < total
    blocks = found.filter(pa.compute.is_valid(found["block"])).select(["block", *binary])
    summed = pa.Table.from_batches(ngram_join.summed(iter(blocks.to_batches() * 2)))
    assert sum(int(ngram_join.unpacked(v).sum()) for v in summed["counts"].to_pylist()) == 2 * total


def test_shingles_meet_where_they_lie(spark):
    """Only partners of shingles in parts move; before, all that classes hold did, three times a round."""
    docs = frame(spark, [(i, t, "s") for i, t in enumerate(family(1, 20, 40, 2))]).select("text")
    pairs = ngram_join.possible_pairs(ngram_join.shared_shingles(docs, np.zeros(16, np.int32), 3, 90), F.lit(False), ngram_join.central, 90)
    assert pairs._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(token") <= 2
    assert pairs.count()


def test_join_edges(spark):
    rows = ngram_join.near_duplicates(frame(spark, edge_rows()), 3, 90).collect()
    assert len(rows) == len(edge_rows())
    by = {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] is not None}
    assert by[1] == 1 and by[2] == 2 and by[3] == 3 and by[4] == by[5] == 4 and by[6] == by[7] == 6 and by[8] == by[9] == 8
    assert sorted(str(r["component_id"]) for r in rows if r["doc_id"] is None) == ["6", "None"]
    assert ngram_join.near_duplicates(frame(spark, []), 3, 90).count() == 0
    kept = ngram_join.one_of_each(frame(spark, edge_rows()))
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [1, 2, 3, 4, 6, 8, 10, 11]
    assert kept.columns == frame(spark, []).columns and {r["_row"] for r in kept.collect()} == {"r"}


def plain_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[p : p + length] for d in data for p in range(len(d) - length + 1))
    out = []
    for d in data:
        cover = bytearray(len(d))
        for p in range(len(d) - length + 1):
            if counts[d[p : p + length]] > 1:
                cover[p : p + length] = b"\1" * length
        kept = bytes(b for b, c in zip(d, cover, strict=True) if not c)
        runs = sum(c and not (i and cover[i - 1]) for i, c in enumerate(cover))
        out.append((len(d), sum(cover), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize(("length", "part", "block"), [(400, 256, 1 << 19), (30, 256, 500), (30, 2, 500), (12, 3, 1 << 19)])
def test_repeats_against_all_windows(spark, length, part, block):
    rng = random.Random(length)
    word = lambda: "".join(rng.choice("abé\n ") for _ in range(rng.randrange(1, 9)))
    passages = ["".join(word() for _ in range(length // 3)) for _ in range(3)]
    texts = []
    for _ in range(60):
        body = [word() for _ in range(rng.randrange(length))]
        if rng.random() < 0.6:
            body.insert(rng.randrange(len(body) + 1), rng.choice(passages)[rng.randrange(5) :])
        texts.append("".join(body))
    texts += [texts[0], texts[1] + "z", "x" * (3 * length), "x" * (length - 1), "", None, texts[3]]
    texts += [("ab" * length)[:-1] + "q" + "ab" * length, passages[0] + "xyz" * length, "x" * (length + 1) + "y" * length, "y" * (length + 3)]
    got = repeats.without_repeats(frame(spark, [(i, t, "s") for i, t in enumerate(texts)]), length, most=part, block=block).orderBy("doc_id").collect()
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got] == plain_repeats(texts, length)


@pytest.mark.parametrize("unit", ["a", "one line of filler\nand another one\n", "".join(random.Random(3).choices("abcdefgh \n", k=300))])
def test_repeats_of_long_periodic_text(spark, unit):
    """10 MB of one period: a few rows, whatever the period; all of the text goes, a text of its own stays."""
    n = 10_000_000 // len(unit)
    docs = spark.range(2).select(F.col("id").alias("doc_id"), F.when(F.col("id") == 0, F.repeat(F.lit(unit), n)).otherwise(F.concat(F.lit("0123"), F.repeat(F.lit("z"), 350))).alias("text"))
    spans = repeats.repeats(docs.select("text")).count()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in repeats.without_repeats(docs).drop("kept").collect()}
    assert got == {0: (n * len(unit), n * len(unit), 1), 1: (354, 0, 0)} and spans < 200


def test_repeats_edges(spark):
    got = repeats.without_repeats(frame(spark, edge_rows())).collect()
    assert len(got) == len(edge_rows())
    assert {r["doc_id"]: r["n_removed"] == r["n_bytes"] for r in got if r["doc_id"] in (8, 9, 11, 4)} == {8: True, 9: True, 11: True, 4: False}
    assert repeats.without_repeats(frame(spark, [])).count() == 0


@pytest.mark.parametrize("hashes", [1, 2, 3, 4])
def test_recall_for_each_number_of_hashes(hashes):
    """Pairs at the threshold exactly: how many meet in a bucket where one is at home."""
    rng = np.random.default_rng(hashes)
    a, b = rng.normal(size=(2, 4000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(1)[:, None] * a
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * b / np.linalg.norm(b, axis=1)[:, None]
    x, y = (embedding_dedup.codes(v, embedding_dedup.tables_for(hashes), hashes, embedding_dedup.PROBES, embedding_dedup.SEED) for v in (a, b))
    met = ((x[:, :, :1] == y) | (y[:, :, :1] == x)).any((1, 2))
    assert met.mean() >= 0.96


@pytest.mark.parametrize("tile", [3, 1024])
def test_block_labels_join_whole_components(monkeypatch, tile):
    """Chains of links in any order of keys: each member's label leads to the least of its component."""
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    rng = np.random.default_rng(tile)
    for _ in range(20):
        n = 40
        angles = np.cumsum(rng.choice([0.1, 0.5], n, p=[0.8, 0.2]))[rng.permutation(n)]
        unit, key = np.c_[np.cos(angles / 10), np.sin(angles / 10)], rng.choice(10_000, n, replace=False)
        code = np.zeros(1 + embedding_dedup.PROBES, np.int64).tobytes()
        table = pa.table({"table_no": [0] * n, "bucket": [0] * n, "dim": [2] * n, "key": key, "copies": [1] * n, "home": [True] * n, "block": [0] * n, "unit": [u.tobytes() for u in unit], "codes": [code] * n, "lo": [0] * n, "hi": [0] * n})
        got = embedding_dedup.joined(table, float(np.cos(0.015))).to_pylist()
        near = unit @ unit.T >= float(np.cos(0.015))
        want = component_ids(key.tolist(), [(int(key[a]), int(key[b])) for a, b in zip(*np.nonzero(near), strict=True)])
        assert {**{int(k): int(k) for k in key}, **{r["key"]: r["label"] for r in got}} == want
        assert sum(r["links"] for r in got) == near.sum() - near.trace()


@pytest.mark.parametrize(("block", "tile"), [(16, 1024), (64, 7)])
def test_embeddings(spark, monkeypatch, block, tile):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(40, 48))
    x = [*(centres[i % 40] + 0.22 * rng.normal(size=48) for i in range(400)), *[centres[0]] * 5, *(centres[1] + 0.02 * rng.normal(size=48) for _ in range(60))]
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    odd = [(1000, None, 0), (1001, [0.0] * 48, 0), (1002, [1.0, None], 0), (1003, [float("nan")] * 48, 0), (1004, [], 0), (1005, [1.0, 2.0, 3.0], 0), (None, [1.0, 2.0, 3.0], 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int").repartition(3)
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(df).collect()}
    unit = np.array(x) / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    links = near.sum(1)
    assert links.sum() > 3000
    assert all(got[i]["n_links"] <= links[i] for i in range(len(x)))
    assert sum(got[i]["n_links"] for i in range(len(x))) >= 0.95 * links.sum()
    want = component_ids(range(len(x)), list(zip(*np.nonzero(near), strict=True)))
    assert np.mean([got[i]["component_id"] == want[i] for i in range(len(x))]) > 0.95
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i in range(1000, 1005))
    assert got[1005]["n_links"] == 1 and got[None]["component_id"] == 1005 and not got[None]["kept"]
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0
    clashing = df.limit(3).selectExpr("*", "1 AS key", "'x' AS unit", "2 AS links", "3 AS id", "4 AS dim")
    assert embedding_dedup.near_duplicates(clashing).columns == ["vec_id", "n_links", "component_id", "kept"]
