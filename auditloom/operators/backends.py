"""What differs by language when tests run: one record a language, made of column builders, and their registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditloom.functions import diff
from auditloom.functions.messages import verbose_pytest
from auditloom.functions.text import blank
from auditloom.operators import logs


@dataclass(frozen=True)
class Backend:
    """command: from a spec's own test command (null where it has none); scope: from a test patch, '' where all tests run (X-03)."""

    language: str
    test_files: str
    failures: str
    seconds: int
    parser: Callable[[DataFrame], DataFrame]
    command: Callable[[Column], Column]
    scope: Callable[[Column], Column]


BACKENDS: dict[str, Backend] = {}


def register(backend: Backend) -> None:
    BACKENDS[backend.language] = backend


def get(language: str) -> Backend | None:
    return BACKENDS.get(language)  # X-04


def _given(command: Column, default: str) -> Column:
    return F.coalesce(F.nullif(command, F.lit("")), F.lit(default))


def go_command(command: Column) -> Column:
    return F.lit("go test -json -count=1")


def python_command(command: Column) -> Column:
    return verbose_pytest(_given(command, "pytest"))


def java_command(command: Column) -> Column:
    base, flag = _given(command, "mvn test -B"), " -Dmaven.test.failure.ignore=true"
    return F.when(base.contains("-Dmaven.test.failure.ignore"), base).otherwise(F.concat(base, F.lit(flag)))


def rust_command(command: Column) -> Column:
    return _given(command, "cargo test")


#: Ends of test files, what a failing line holds, seconds a run may take, images to start from.
register(Backend("go", "_test.go", '"Action":"fail"', 600, logs.go_json, go_command, diff.go_scope))
register(Backend("python", ".py", r"FAILED\|ERROR", 600, logs.pytest_verbose, python_command, diff.python_scope))
register(Backend("java", "Test.java", r"<<< FAILURE\|<<< ERROR", 900, logs.maven_surefire, java_command, diff.java_scope))
register(Backend("rust", ".rs", r"FAILED\|error\[E", 600, logs.cargo, rust_command, lambda patch: F.lit("")))
IMAGES = {"go": "golang:latest", "python": "python:3.11-slim", "java": "maven:3-eclipse-temurin-17", "rust": "rust:latest"}
OTHER_IMAGE = "ubuntu:22.04"
PYTHON_VERSION = "3.11"
APT = "RUN apt-get update -qq && apt-get install -y --no-install-recommends {} && rm -rf /var/lib/apt/lists/*"


def by_language(language: Column, make: Callable[[Backend], Column]) -> Column:
    """A column by the row's language; null for languages without a record."""
    out = F.lit(None).cast("string")
    for b in BACKENDS.values():
        out = F.when(language == b.language, make(b)).otherwise(out)
    return out


def command(language: Column, spec_command: Column) -> Column:
    """The command that runs the tests, from the spec's own or the language's default (R-10)."""
    return by_language(language, lambda b: b.command(spec_command))


def base_image(language: Column, spec: Column) -> Column:
    """The FROM line of an environment (R-14). spec: a struct with spec_type ('go', 'rust', 'python' or null), go_version, rust_version, base_image, language_version."""
    some = lambda name: F.nullif(spec[name], F.lit(""))
    own = F.when(spec["spec_type"] == "go", F.concat(F.lit("golang:"), some("go_version"))).when(spec["spec_type"] == "rust", F.concat(F.lit("rust:"), some("rust_version"), F.lit("-slim")))
    own = own.when(spec["spec_type"] == "python", F.coalesce(some("base_image"), F.concat(F.lit("python:"), F.coalesce(some("language_version"), F.lit(PYTHON_VERSION)), F.lit("-slim"))))
    default = F.lit(OTHER_IMAGE)
    for name, image in IMAGES.items():
        default = F.when(language == name, image).otherwise(default)
    return F.concat(F.lit("FROM "), F.coalesce(own, default))


def extra_setup(spec: Column) -> Column:
    """The lines after the base image of an environment with a spec, in order (R-14). spec: as above, with system_dependencies, pre_install, install_cmd, goflags."""
    listed = lambda name: F.coalesce(spec[name], F.array().cast("array<string>"))
    before, after = APT.split("{}")
    system = F.when(F.size(listed("system_dependencies")) > 0, F.array(F.concat(F.lit(before), F.array_join(listed("system_dependencies"), " "), F.lit(after)))).otherwise(F.array().cast("array<string>"))
    run = lambda c: F.concat(F.lit("RUN cd /testbed && "), c)
    flags = F.when(blank(spec["goflags"]) != "", F.concat(F.lit('ENV GOFLAGS="'), spec["goflags"], F.lit('"')))
    install = F.when(blank(spec["install_cmd"]) != "", run(spec["install_cmd"]))
    go = F.concat(system, F.array(flags, F.lit("RUN cd /testbed && go mod download")))
    rust = F.concat(F.array(F.lit(APT.format("git ca-certificates"))), system)
    python = F.concat(system, F.transform(listed("pre_install"), run), F.array(install))
    lines = F.when(spec["spec_type"] == "go", go).when(spec["spec_type"] == "rust", rust).when(spec["spec_type"] == "python", python)
    return F.array_join(F.filter(lines, lambda x: x.isNotNull()), "\n")
