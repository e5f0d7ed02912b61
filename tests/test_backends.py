"""Records by language, environments, lines kept and snapshots."""

from pyspark.sql import functions as F

from auditloom.functions import code, text
from auditloom.operators import backends
from auditloom.streaming import streams


def test_commands(spark):
    cases = [("python", None, "pytest -v"), ("python", "tox", "tox -v"), ("go", "x", "go test -json -count=1"), ("java", "", "mvn test -B -Dmaven.test.failure.ignore=true"), ("rust", "cargo t", "cargo t"), ("rust", None, "cargo test"), ("c", "x", None)]
    df = spark.createDataFrame([(i, *c[:2]) for i, c in enumerate(cases)], "i int, language string, own string")
    assert {r["i"]: r["c"] for r in df.select("i", backends.command(F.col("language"), F.col("own")).alias("c")).collect()} == {i: c[2] for i, c in enumerate(cases)}
    assert backends.get("go").seconds == 600 and backends.get("c") is None and set(backends.BACKENDS) == {"go", "python", "java", "rust"}


def test_environments(spark):
    spec = "struct<spec_type:string,go_version:string,rust_version:string,base_image:string,language_version:string,system_dependencies:array<string>,pre_install:array<string>,install_cmd:string,goflags:string>"
    none = (None,) * 9
    rows = [("go", ("go", "1.21", *none[2:8], "-mod=mod")), ("python", ("python", *none[1:4], "3.9", ["gcc", "git"], ["a"], "pip install .", None)), ("rust", ("rust", None, "", *none[3:])), ("java", none), ("c", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, language string, spec {spec}")
    got = [tuple(r) for r in df.orderBy("i").select(backends.base_image(F.col("language"), F.col("spec")), backends.extra_setup(F.col("spec"))).collect()]
    assert [g[0] for g in got] == ["FROM golang:1.21", "FROM python:3.9-slim", "FROM rust:latest", "FROM maven:3-eclipse-temurin-17", "FROM ubuntu:22.04"]
    assert got[0][1] == 'ENV GOFLAGS="-mod=mod"\nRUN cd /testbed && go mod download'
    assert got[1][1].splitlines() == [backends.APT.format("gcc git"), "RUN cd /testbed && a", "RUN cd /testbed && pip install ."] and got[2][1] == backends.APT.format("git ca-certificates")


def test_lines_kept(spark):
    cases = [("def f():\n\treturn 1  \n\tx", "def f():\n    return 1\n    y", "def f():\n\treturn 1  \n    y"), (None, "a ", "a "), ("a", None, "")]
    df = spark.createDataFrame([(i, *c[:2]) for i, c in enumerate(cases)], "i int, a string, b string")
    assert {r["i"]: r["c"] for r in df.select("i", code.unchanged_kept("a", "b").alias("c")).collect()} == {i: c[2] for i, c in enumerate(cases)}
    moves = [("    def f():\n", "def f():\n  x\n\n", "    def f():\n      x\n"), ("def f():", "  def f():\n y\n    x", "def f():\ny\n  x"), ("a", "b\n", "b\n"), ("", "  b", "  b"), (None, None, "")]
    df = spark.createDataFrame([(i, *c[:2]) for i, c in enumerate(moves)], "i int, a string, b string")
    assert {r["i"]: r["c"] for r in df.select("i", text.indented_as(F.col("b"), F.col("a")).alias("c")).collect()} == {i: c[2] for i, c in enumerate(moves)}


def test_snapshots(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    for n, rows in enumerate(([("a", 1), ("b", 1)], [("b", 2), ("c", 2)])):
        spark.createDataFrame(rows, "instance_id string, v int").coalesce(1).write.mode("append").json(source)
        streams.snapshots(streams.landed(spark, source, spark.read.json(source).schema), out, mark).awaitTermination()
        got = {(r["instance_id"], r["v"]) for r in spark.read.json(f"{out}/{n}").collect()}
        assert got == [{("a", 1), ("b", 1)}, {("a", 1), ("b", 2), ("c", 2)}][n]
