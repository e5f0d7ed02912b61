"""Explainable filters: arrays of reasons, fixed in order; a row passes when its array is empty."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditloom.functions import diff, text


@dataclass(frozen=True)
class FilterConfig:
    min_words: int = 40
    max_lines: int = 500
    min_lines: int = 1
    min_tests: int = 1
    urls: bool = True
    shas: bool = True
    images: bool = True
    new_symbols: bool = True


def reasons(*rules: tuple[Column, str | Column]) -> Column:
    """The reasons whose predicate holds, in the order given; a null predicate doesn't hold."""
    marked = [F.when(met, F.lit(why) if isinstance(why, str) else why) for met, why in rules]
    return F.filter(F.array(*marked), lambda r: r.isNotNull())


def first_reason(*rules: tuple[Column, str]) -> Column:
    """Only the first reason that holds, as a chain of tiers stops at it; null if none."""
    return F.coalesce(*[F.when(met, F.lit(why)) for met, why in rules])


def statement_rules(statement: Column, config: FilterConfig) -> list[tuple[Column, str]]:
    rules = [(text.word_count(statement) < config.min_words, "too_short")]
    rules += [(text.has_url(statement), "has_url")] * config.urls
    rules += [(text.has_sha(statement), "has_sha")] * config.shas
    rules += [(text.image_only(statement), "image_only")] * config.images
    return rules


def size_rules(patch: Column, config: FilterConfig) -> list[tuple[Column, str]]:
    return [(text.line_count(patch) > config.max_lines, "too_large"), (text.line_count(patch) < config.min_lines, "too_small")]


def instance_reasons(config: FilterConfig = FilterConfig(), language: str = "python", compiled: Column | None = None) -> Column:
    """Reasons against rows with problem_statement, patch and FAIL_TO_PASS."""
    tests = F.from_json("FAIL_TO_PASS", "array<string>")
    rules = statement_rules(F.col("problem_statement"), config) + size_rules(F.col("patch"), config)
    rules += [(tests.isNull(), "invalid_tests"), (F.size(tests) < config.min_tests, "no_tests")]
    if config.new_symbols:
        rules.append((diff.leaked_symbol(tests, diff.new_python_symbols(F.col("patch"))).isNotNull(), "new_symbol"))
    if language == "go":
        if compiled is not None:
            rules.append((~compiled, "build_failed"))
        rules.append((diff.leaked_symbol(tests, diff.new_go_symbols(F.col("patch"))).isNotNull(), "new_exported_symbol"))
    return reasons(*rules)


def passing(instances: DataFrame, config: FilterConfig = FilterConfig()) -> DataFrame:
    return instances.where(F.size(instance_reasons(config)) == 0)


def passing_go(instances: DataFrame, results: DataFrame, config: FilterConfig = FilterConfig()) -> DataFrame:
    """Go rows, with each one's build flag from its validation result; without a result the flag isn't checked."""
    flagged = instances.join(results.select("instance_id", "compiled"), "instance_id", "left")
    return flagged.where(F.size(instance_reasons(config, "go", F.coalesce("compiled", F.lit(True)))) == 0).drop("compiled")


def viable(instances: DataFrame) -> DataFrame:
    held = [text.blank(F.col(c)) != "" for c in ("patch", "test_patch", "problem_statement")]
    return instances.where(held[0] & held[1] & held[2])


def not_excluded(instances: DataFrame, scores: DataFrame, default: str = "review") -> DataFrame:
    """Rows whose judged recommendation isn't to exclude; unjudged rows count as the default."""
    judged = instances.join(scores.select("instance_id", "recommendation"), "instance_id", "left")
    return judged.where(F.coalesce("recommendation", F.lit(default)) != "exclude").drop("recommendation")


def kept_by_screen(classification: Column, confidence: Column) -> Column:
    """Only a confident synthetic verdict rejects; a missing one keeps."""
    return ~F.coalesce((classification == "SYNTHETIC") & (confidence == "HIGH"), F.lit(False))


def valid_output(log: Column, denied: tuple[str, ...], signals: tuple[str, ...], least: int = 100) -> Column:
    any_of = lambda names: F.exists(F.array(*[F.lit(n) for n in names]), lambda n: log.contains(n))
    return (F.length(log) >= least) & ~any_of(denied) & any_of(signals)


def leaks_identifier(statement: Column, name: Column) -> Column:
    return F.contains(text.narrative(statement), F.lower(name))


def too_simple(patch: Column, lines: int = 12, size: int = 600) -> Column:
    return (diff.changed_lines(patch) < lines) | (F.length(patch) < size)


def same_package(a: Column, b: Column, language: str) -> Column:
    """Whether two paths are of one package: one directory, for Java below its source root, for Python one first directory."""
    folder = lambda p: F.regexp_replace(p, r"/?[^/]*$", "")
    if language == "python":
        return F.split(a, "/")[0] == F.split(b, "/")[0]
    if language == "java":
        return folder(F.regexp_replace(a, r"^.*?src/(?:main|test)/java/", "")) == folder(F.regexp_replace(b, r"^.*?src/(?:main|test)/java/", ""))
    return folder(a) == folder(b)


def resolved_imports(sources: DataFrame, modules: DataFrame, standard: DataFrame) -> DataFrame:
    """(repo, path, module, prefix, resolved) of each import of Python sources (repo, path, content), once a file (F-41, R-20).

    modules: (repo, module) with all packages, as tasks.repo_modules() gives it; standard: module, with submodules that may be
    imported. prefix is the longest beginning of the dotted name that either holds, null without one; an import is
    resolved where that is the whole name. Prefixes meet modules by equal keys, as many rows as a name has parts.
    A name relative to its package isn't read, as it names no module by itself.
    """
    pattern = r"(?m)^\s*(?:from\s+([A-Za-z_][\w.]*)\s+import|import\s+([A-Za-z_][\w.]*))"
    both = lambda g: F.regexp_extract_all(F.coalesce("content", F.lit("")), F.lit(pattern), F.lit(g))
    names = F.array_distinct(F.transform(F.arrays_zip(both(1).alias("a"), both(2).alias("b")), lambda x: F.coalesce(F.nullif(x["a"], F.lit("")), x["b"])))
    used = sources.select("repo", "path", F.explode(names).alias("module")).distinct()
    parts = F.split("module", r"\.")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "."))
    tried = used.select("*", F.explode(prefixes).alias("prefix"))
    own = modules.select("repo", F.col("module").alias("prefix"), F.lit(True).alias("_own")).distinct()
    common = standard.select(F.col("module").alias("prefix"), F.lit(True).alias("_standard")).distinct()
    met = tried.join(own, ["repo", "prefix"], "left").join(common, "prefix", "left").withColumn("_met", F.when(F.col("_own") | F.col("_standard"), F.col("prefix")))
    longest = met.groupBy("repo", "path", "module").agg(F.max_by("_met", F.when(F.col("_met").isNotNull(), F.length("_met"))).alias("prefix"))
    return longest.select("repo", "path", "module", "prefix", F.coalesce(F.col("prefix") == F.col("module"), F.lit(False)).alias("resolved"))


def unresolved_imports(sources: DataFrame, modules: DataFrame, standard: DataFrame) -> DataFrame:
    """(repo, path, module) of the imports that resolved_imports() doesn't resolve."""
    return resolved_imports(sources, modules, standard).where("not resolved").select("repo", "path", "module")


def kept_unless_failed(check: Column) -> Column:
    """Rows whose check wasn't made stay, those that failed it go (R-38)."""
    return F.coalesce(check, F.lit(True))


def with_logs(rows: DataFrame, repos: list[str], logs: tuple[str, ...]) -> DataFrame:
    """Rows of the repositories whose logs are all there (F-33)."""
    there = F.col("repo").isin(repos)
    for name in logs:
        there = there & (F.trim(F.coalesce(F.col(name), F.lit(""))) != "")
    return rows.where(there)
