"""Language models, vector codes and the conversation trie against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from auditloom.llm import language_id, prefix_trie, vector_codes
from tests.llm.helpers import edge_rows, frame


def brute_trie(rows, every=None, most=6):
    """Nodes of rows (conv_id, turn, role, text) by plain dictionaries of prefixes."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most if every else 0
        base = int(math.fmod(c, every)) if every else 0
        built[c] = (own.get(c - base, [])[:h] if every else []) + turns[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, gain = Counter(), Counter()
    for p, who in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            gain[p[:d]] += (len(who) - 1) * (len(p[-1][1]) if p else 0)
    return sorted(
        (min(who), len(p), min(members[p[:-1]]) if p else None, len(who), children[p], leaves[p], gain[p], hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, who in members.items()
    )


NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def nodes(df):
    assert set(NODE) <= set(df.columns)
    return sorted((tuple(r[c] for c in NODE) for r in df.collect()), key=lambda r: (r[0], r[1]))


def conversations(spark, rows):
    full = [(*r, "x", 1, 2) for r in rows]
    return spark.createDataFrame(full, "conv_id long, turn long, role string, text string, digest string, depth int, place int").repartition(3)


def chains(seed):
    """Conversations that branch off one another at any depth, some of them equal, one of them long, with ties and nulls."""
    rng, rows, texts = random.Random(seed), [], {}
    for c in range(60):
        kin = texts.get(rng.randrange(c)) if c and rng.random() < 0.8 else None
        turns = list(kin[: rng.randint(0, len(kin))]) if kin else []
        turns += [(rng.choice(["user", "bot", None]), rng.choice(["a", "é🙂", "", None, "bb"])) for _ in range(rng.randint(0, 4))]
        texts[c] = turns or [("user", "a")]
        rows += [(c * 7 % 251, None if i == 0 else i, r, t) for i, (r, t) in enumerate(texts[c])]
    rows += [(100, i, "u", f"t{i % 3}") for i in range(300)] + [(101, i, "u", f"t{i % 3}") for i in range(200)] + [(None, 1, "u", "x"), (5000, 3, "u", "tie"), (5000, 3, "u", "tie"), (5000, 3, "u", "other"), (-150, 1, "u", "neg"), (-100, 1, "u", "base")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_against_brute_force(spark, seed):
    rows = chains(seed)
    got = nodes(prefix_trie.conversation_trie(conversations(spark, rows)))
    assert got == sorted(brute_trie(rows), key=lambda r: (r[0], r[1]))


def test_trie_with_heads(spark):
    rows = chains(3)
    turns, ids = prefix_trie.with_heads(prefix_trie.numbered(conversations(spark, rows)))
    assert nodes(prefix_trie.trie(turns, ids)) == sorted(brute_trie(rows, every=100), key=lambda r: (r[0], r[1]))


def test_trie_of_a_staircase(spark):
    """Every conversation goes one turn further than the one before: as many nested chains as turns."""
    rows = [(c, i, "u", f"t{i}") for c in range(30) for i in range(c + 1)]
    assert nodes(prefix_trie.conversation_trie(conversations(spark, rows))) == sorted(brute_trie(rows), key=lambda r: (r[0], r[1]))


def test_trie_of_nothing(spark):
    assert prefix_trie.conversation_trie(conversations(spark, [])).count() == 0


def test_ends_in_chunks():
    """Ids of one end that pass several rows give the hash of all."""
    import pyarrow as pa

    ids = list(range(10_000))
    part = pa.RecordBatch.from_arrays([pa.array([b"d"] * len(ids) + [b"e"], pa.binary()), pa.array([*ids, 7], pa.int64())], ["digest", "conv_id"])
    chunks = list(prefix_trie._chunks(iter([part.slice(0, 3000), part.slice(3000)])))
    got = [x for b in prefix_trie._hashed(iter(chunks)) for x in b.to_pylist()]
    assert got == [{"digest": d, "ends_sha256": hashlib.sha256(",".join(map(str, i)).encode()).hexdigest()} for d, i in ((b"d", ids), (b"e", [7]))]


def brute_codes(rows, parts=8, entries=16, rounds=6):
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ints = [[math.floor(4096 * float(np.float32(x))) for x in r[1]] for r in kept]
    wide = len(ints[0]) // parts
    cut = lambda v, k: v[k * wide : (k + 1) * wide]
    books = [[cut(v, k) for v in ints[:entries]] for k in range(parts)]

    def near(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for k in range(parts):
            groups = defaultdict(list)
            for v in ints:
                groups[near(cut(v, k), books[k])[1]].append(cut(v, k))
            for e, members in groups.items():
                books[k][e] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    found = [[near(cut(v, k), books[k]) for k in range(parts)] for v in ints]
    total = Counter()
    for r, f in zip(kept, found, strict=True):
        total[r[2]] += sum(d for d, _ in f)
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{i:02x}" for _, i in f), sum(d for d, _ in f), total[r[2]], sha) for r, f in zip(kept, found, strict=True)), key=str)


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, code string, _row int").repartition(3)


@pytest.mark.parametrize(("n", "d"), [(300, 16), (5, 8), (1, 16)])
def test_codes_against_brute_force(spark, n, d):
    rng = random.Random(n)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(d)], rng.choice([0, 1, None])) for i in range(n)]
    rows += [(7, rows[-1][1], 1), (7, rows[-1][1], 1), (None, rows[0][1], 2), (900, None, 1), (901, [], 1), (902, [None] * d, 1), (903, [float("nan")] * d, 1), (904, [1.0] * (d - 1) + [float("inf")], 1)]
    got = vector_codes.vector_codes(vectors(spark, rows))
    got = sorted((tuple(r[c] for c in ("vec_id", "code", "error", "label_error", "codebooks_sha256")) for r in got.collect()), key=str)
    assert got == brute_codes(rows)


def test_codes_edges(spark):
    assert vector_codes.vector_codes(vectors(spark, [])).count() == 0
    assert vector_codes.vector_codes(vectors(spark, [(1, None, 1), (2, [float("nan")], 1)])).count() == 0
    huge = vector_codes.vector_codes(vectors(spark, [(1, [3e38] * 8, 1), (2, [-3e38] * 8, 1), (3, [0.0] * 8, 1), (4, [1.0] * 9, 1)])).collect()
    assert sorted(r.vec_id for r in huge) == [1, 2, 3] and all(r.error >= 0 for r in huge)
    odd = vector_codes.vector_codes(vectors(spark, [(i, [float(i), 1.0, 2.0], 1) for i in range(20)])).collect()
    assert len(odd) == 20 and all(len(r.code) == 16 for r in odd)


def plain_bits(taught, text, order):
    """Mean bits a character by interpolated Kneser-Ney over strings, one language's texts at a time."""
    string = lambda t: "".join(map(chr, language_id.normal(t)[0]))
    out = {}
    signs = {c for ts in taught.values() for t in ts for c in string(t)}
    for lang, texts in taught.items():
        counts = {order: Counter()}
        for t in texts:
            s = " " * (order - 1) + string(t)
            counts[order].update(s[i : i + order] for i in range(len(s) - order + 1))
        for k in range(order - 1, 0, -1):
            counts[k] = Counter(g[1:] for g in counts[k + 1])
        discount, total, kinds = {}, defaultdict(Counter), defaultdict(Counter)
        for k, found in counts.items():
            one, two = (sum(v == x for v in found.values()) for x in (1, 2))
            discount[k] = min(0.95, max(0.05, one / (one + 2 * two) if one * two else 0.5))
            for g, v in found.items():
                total[k][g[:-1]] += v
                kinds[k][g[:-1]] += 1
        s, bits = " " * (order - 1) + string(text), 0.0
        for i in range(order - 1, len(s)):
            p = 1 / (len(signs) + 1)
            for k in range(1, order + 1):
                g = s[i - k + 1 : i + 1]
                if all_of := total[k][g[:-1]]:
                    p = max(counts[k][g] - discount[k], 0) / all_of + discount[k] * kinds[k][g[:-1]] / all_of * p
            bits -= math.log2(p)
        out[lang] = bits / (len(s) - order + 1)
    return out


TAUGHT = {"x": ["the thin thing", "Then, the other: 12 feather!", "a", "𝒜 thé"], "y": ["der die das", "Das ist dieser Hund.", "Straße"]}


def test_language_bits_against_plain(spark):
    rows = [(i, t, lang, "s", 1) for i, (lang, t) in enumerate((lang, t) for lang, ts in TAUGHT.items() for t in ts * 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n int").repartition(3)
    for order in (3, 5):
        model = language_id.fit(docs, F.lit(True), order=order, calibration=0)
        texts = ["the dieser", "zzz", "thé Straße a 𝒜", "x" * 50]
        got = language_id.bits_of(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.sparkContext.broadcast(model)).collect()
        for r in got:
            want = plain_bits(TAUGHT, texts[r.doc_id], order)
            assert r.bits == pytest.approx([want[x] for x in model.langs], rel=1e-4)


def test_language_slices(monkeypatch):
    text = "abc def ghi " * 50
    whole = [x for s, own, _ in language_id.pieces([language_id.normal(text)[0]], 5) for x in language_id.hash_of(language_id.windows_of(s, own, 5)[0])[language_id.windows_of(s, own, 5)[1]]]
    monkeypatch.setattr(language_id, "SLICE", 37)
    cut = [x for s, own, _ in language_id.pieces([language_id.normal(text)[0]], 5) for x in language_id.hash_of(language_id.windows_of(s, own, 5)[0])[language_id.windows_of(s, own, 5)[1]]]
    assert whole == cut and len(whole) == len(language_id.normal(text)[0])


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    from auditloom.llm import queries

    got = queries.op11_language_id(spark, sf)
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").where("held_out").collect()
    assert len(rows) > 200 and sum(r.lang == r.lang_pred for r in rows) / len(rows) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)
    strange = spark.createDataFrame([(1, "Qxzw jkvq wxqz " * 20), (2, "12 34 !?"), (3, None), (4, "")], "doc_id long, text string")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = {r.doc_id: r for r in language_id.identify(strange, language_id.fit(docs, queries.remainder(4) != 2)).collect()}
    assert found[1].rejected and found[1].lang_pred in {"en", "de", "fr", "es"}
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (2, 3, 4))


def test_language_edges(spark):
    docs = frame(spark, edge_rows())
    found = language_id.identify(docs, language_id.fit(docs, F.lit(True)))
    rows = found.collect()
    assert len(rows) == len(edge_rows())
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 3)} == {"und"} and {r.lang_pred for r in rows if r.doc_id in (4, 5, 8, 11)} == {"en"}
    assert language_id.fit(docs.limit(0), F.lit(True)) is None and language_id.fit(docs, F.lit(None).cast("boolean")) is None
    assert {r.lang_pred for r in language_id.identify(docs, None).collect()} == {"und"}
    long = spark.createDataFrame([(1, "wort " * 400_000)], "doc_id long, text string")
    assert language_id.identify(long, language_id.fit(docs, F.lit(True))).first().lang_pred == "en"


@pytest.mark.parametrize(("most", "full"), [(40, False), (3, False), (40, True)])
def test_language_strings_beyond_the_arrays_count(spark, monkeypatch, most, full):
    if full:  # a filter of 64 bits that all strings pass
        monkeypatch.setattr(language_id, "FILTER", 64)
    rows = [(i, text, lang) for i, (lang, text) in enumerate((lang, t) for lang, ts in TAUGHT.items() for t in ts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    texts = ["the dieser", "zzz", "thé Straße a 𝒜", "x" * 50, "the dieser", None, *(t for ts in TAUGHT.values() for t in ts)]
    asked = spark.createDataFrame([(None if i == 4 else i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    model = language_id.fit(docs, F.lit(True), order=4, most=most, calibration=0)
    assert model.tail is not None and all(sum(len(v[0]) for (_, k), v in model.strings.items() if k == size) <= most for size in range(1, 5))
    got = language_id.bits_of(asked, spark.sparkContext.broadcast(model), model.tail).collect()
    assert len(got) == len(texts)
    for r in got:
        text = texts[4 if r.doc_id is None else r.doc_id]
        if text:
            want = plain_bits(TAUGHT, text, 4)
            assert r.bits == pytest.approx([want[x] for x in model.langs], rel=1e-4)


def test_language_cutoff(spark):
    """Where strings don't fit, rare ones go and their mass goes to the lower order: the model stays a distribution."""
    docs = spark.createDataFrame([(i, " ".join(random.Random(i).choices(["eins", "zwei", "drei", "vier", "baum"], k=30)), "de") for i in range(20)], "doc_id long, text string, lang string")
    model = language_id.fit(docs, F.lit(True), order=4, most=60, calibration=0)
    assert all(len(v[0]) <= 60 for v in model.strings.values())
    got = language_id.identify(spark.createDataFrame([(1, "zwei baum")], "doc_id long, text string"), model).first()
    assert got.lang_pred == "de" and 0 < got.bits < 20
