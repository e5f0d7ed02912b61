"""Queries over every row against brute force."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from auditloom import catalog
from auditloom.operators.verdicts import fishers_exact

DATA = "/root/testdata/sf0.001"


def rows(spark, table, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{DATA}/{table}.parquet").select(*columns).collect()]


def test_every_order_is_an_interval(spark):
    days = [(k, d.toordinal()) for k, d in rows(spark, "orders", "o_orderkey", "o_orderdate")]
    want = {k: sum(lo <= d <= lo + 3 for _, d in days) for k, lo in days}
    assert {r["key"]: r["n"] for r in catalog.QUERIES["interval_join"](spark, DATA).collect()} == want


def test_every_order_is_counted(spark):
    nation = dict(rows(spark, "customer", "c_custkey", "c_nationkey"))
    want = defaultdict(Counter)
    for customer, status, priority in rows(spark, "orders", "o_custkey", "o_orderstatus", "o_orderpriority"):
        if customer in nation:
            want[nation[customer]][("ab" if priority == "1-URGENT" else "cd" if priority == "5-LOW" else "--")[status != "F"]] += 1
    got = catalog.QUERIES["fisher_nations"](spark, DATA).collect()
    assert {r["c_nationkey"]: tuple(r[x] for x in "abcd") for r in got} == {k: tuple(c[x] for x in "abcd") for k, c in want.items()}


def test_fisher_of_large_counts(spark):
    a, b, c, d = 2100, 1900, 1950, 2050
    total, top, left = a + b + c + d, a + b, a + c
    p = lambda x: math.comb(top, x) * math.comb(total - top, left - x)
    likely = p(a)
    want = sum(p(x) for x in range(max(0, top + left - total), min(top, left) + 1) if p(x) <= likely) / math.comb(total, left)
    counts = spark.createDataFrame([(a, b, c, d)], "a long, b long, c long, d long")
    assert counts.select(fishers_exact(*map(F.col, "abcd"))).first()[0] == pytest.approx(want, rel=1e-6)


def test_every_part_is_known(spark):
    parts = rows(spark, "part", "p_name", "p_size", "p_type")
    known = {p[0] for p in parts} | {"red", "small", "ECONOMY"}
    want = Counter(next(((level, o) for level, o in (("full", f"{n} {s}"), ("word", n.split(" ")[0]), ("type", t)) if o in known), (None, None)) for n, s, t in parts)
    assert {(r["level"], r["key"]): r["n"] for r in catalog.QUERIES["snap_fallback"](spark, DATA).collect()} == want


def test_every_document_has_a_turn(spark):
    docs = rows(spark, "documents", "lang", "doc_id", "n_chars")
    want, seen = set(), Counter()
    for lang, i, _ in sorted(docs, key=lambda d: (-d[2], d[1])):
        seen[lang] += 1
        want.add((lang, i, seen[lang]))
    got = [tuple(r) for r in catalog.QUERIES["interleave"](spark, DATA).select("lang", "doc_id", "turn").collect()]
    assert len(got) == len(docs) and set(got) == want and max(seen.values()) > 20


def test_every_document_is_reference(spark):
    docs, bench = rows(spark, "documents", "doc_id", "text"), rows(spark, "benchmark", "item_id", "text")
    found = defaultdict(set)
    for i, t in bench:
        for key in (str(i * 3), t.rstrip()):
            found[key].add((i % 2, ("even", "odd")[i % 2]))
    want = {str(i): min(found[str(i)] | (found[t.rstrip()] if t is not None else set()) | ({(2, "copy")} if t is not None else set()), default=(0, None))[1] for i, t in docs}
    assert {r["instance_id"]: r["source"] for r in catalog.QUERIES["decontam_first_source"](spark, DATA).collect()} == want
