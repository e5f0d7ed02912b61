"""Environment specs against known ones, field by field (C-20, A-19, P-12, P-14, R-03).

Each comparator is a column (field, match, detail) of both sides' values; a spec's score is the share of its
five fields that match, so scoring is a projection of the join on repository and version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditloom.functions import text

LIST = "array<string>"


def shown(c: Column) -> Column:
    """A value as Python prints it in a text: None where null."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def shown_list(c: Column) -> Column:
    """A list of strings as Python prints it; null as an empty one."""
    return F.concat(F.lit("["), F.array_join(F.transform(F.coalesce(c, F.array().cast(LIST)), lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "), F.lit("]"))


def _field(name: str, match: Column, detail: Column) -> Column:
    return F.struct(F.lit(name).alias("field"), F.coalesce(match, F.lit(False)).alias("match"), detail.alias("detail"))


def _both(generated: Column, expected: Column) -> Column:
    return F.concat(F.lit("gen="), shown(generated), F.lit(" exp="), shown(expected))


def same_python(generated: Column, expected: Column) -> Column:
    a, b = text.python_version(generated), text.python_version(expected)
    return _field("python", a.eqNullSafe(b), F.when(a.eqNullSafe(b), shown(a)).otherwise(_both(a, b)))


def same_install(generated: Column, expected: Column) -> Column:
    """Equal once normalised, or both by pip."""
    a, b = text.install_command(generated), text.install_command(expected)
    pip = a.contains("pip install") & b.contains("pip install")
    none = a.isNull() & b.isNull()
    detail = F.when(none, "both None").when(a == b, "exact match").when(pip, "functional match (both pip install)").otherwise(_both(a, b))
    return _field("install", none | F.coalesce(a == b, F.lit(False)) | F.coalesce(pip, F.lit(False)), detail)


def same_runner(generated: Column, expected: Column) -> Column:
    """The same runner of tests, whatever its flags."""
    a, b = text.test_runner(generated), text.test_runner(expected)
    exact = text.squeezed(generated).eqNullSafe(text.squeezed(expected))
    apart = F.concat(F.lit("different runners: "), _both(a, b))
    detail = F.when(a.isNull() & b.isNull(), "both None").when(exact, "exact match").when(a.eqNullSafe(b), F.concat(F.lit("same runner ("), shown(a), F.lit(")"))).otherwise(apart)
    return _field("test_cmd", a.eqNullSafe(b), detail)


def same_packages(generated: Column, expected: Column, share: float = 0.8) -> Column:
    """At least the share of the expected packages by name, whatever their versions."""
    a, b = text.package_names(generated), text.package_names(expected)
    common, missing, extra = F.array_intersect(a, b), F.array_except(b, a), F.array_except(a, b)
    covered = F.size(common) / F.greatest(F.size(b), F.lit(1))
    counts = F.concat(F.size(common).cast("string"), F.lit("/"), F.size(b).cast("string"), F.lit(" expected packages covered ("), F.bround(covered * 100).cast("int").cast("string"), F.lit("%)"))
    lists = F.concat_ws("; ", counts, F.when(F.size(missing) > 0, F.concat(F.lit("missing: "), shown_list(missing))), F.when(F.size(extra) > 0, F.concat(F.lit("extra: "), shown_list(extra))))
    empty_a, empty_b = F.size(a) == 0, F.size(b) == 0
    none = F.concat(F.lit("missing all "), F.size(b).cast("string"), F.lit(" expected packages"))
    detail = F.when(empty_a & empty_b, "both empty").when(empty_b, "no expected packages to match").when(empty_a, none).otherwise(lists)
    return _field("pip_packages", empty_b | (~empty_a & (covered >= share)), detail)


def same_steps(generated: Column, expected: Column) -> Column:
    """The same set of commands before the installation."""
    a, b = (F.coalesce(c, F.array().cast(LIST)) for c in (generated, expected))
    match = F.array_sort(F.array_distinct(a)) == F.array_sort(F.array_distinct(b))
    detail = F.when((F.size(a) == 0) & (F.size(b) == 0), "both empty").when(match, "match").otherwise(F.concat(F.lit("gen="), shown_list(a), F.lit(" exp="), shown_list(b)))
    return _field("pre_install", match, detail)


def scored(specs: DataFrame, truth: DataFrame) -> DataFrame:
    """(repo, version, fields, matched, overall) of specs that truth has too, by repo and version.

    specs: repo, version, language_version, install_cmd, test_cmd, pip_packages, pre_install; truth: repo, version, python,
    install, test_cmd, pip_packages, pre_install. Specs without a known one have no row; null fields are compared as such.
    """
    names = ("language_version", "install_cmd", "test_cmd", "pip_packages", "pre_install")
    own = specs.select("repo", "version", *[F.col(n).alias(f"_{n}") for n in names])
    both = own.join(truth.select("repo", "version", "python", "install", "test_cmd", "pip_packages", "pre_install"), ["repo", "version"])
    g = {n: F.col(f"_{n}") for n in names}
    fields = F.array(
        same_python(g["language_version"], F.col("python")), same_install(g["install_cmd"], F.col("install")), same_runner(g["test_cmd"], F.col("test_cmd")),
        same_packages(g["pip_packages"], F.col("pip_packages")), same_steps(g["pre_install"], F.col("pre_install")),
    )
    rows = both.select("repo", "version", fields.alias("fields")).withColumn("matched", F.size(F.filter("fields", lambda f: f["match"])))
    return rows.withColumn("overall", F.col("matched") / F.size("fields"))


def field_rows(scores: DataFrame) -> DataFrame:
    """(repo, version, nth, field, match, detail) of scored(), as tasks.spec_summaries() takes it."""
    return scores.select("repo", "version", F.posexplode("fields").alias("nth", "f")).select("repo", "version", "nth", "f.*")


def bench_spec(specs: DataFrame) -> DataFrame:
    """specs under the names of known ones, with the defaults of those (P-12, P-14)."""
    held = set(specs.columns)
    first = lambda default, *names: F.coalesce(*[F.col(n) for n in names if n in held], default)
    none = F.array().cast(LIST)
    return specs.select(
        "repo", "version", first(F.lit("3.9"), "language_version", "python").alias("python"), first(F.lit("pip install -e ."), "install_cmd", "install").alias("install"), first(F.lit("pytest -rA"), "test_cmd").alias("test_cmd"),
        first(none, "pip_packages").alias("pip_packages"), first(none, "pre_install").alias("pre_install"), first(F.lit(""), "packages").alias("packages"),
    )


def ground_truth(known: DataFrame, repo: str) -> DataFrame:
    """(version, spec) of one repository from rows (repo, specs map); none for an unknown one (R-03)."""
    return known.where(F.col("repo") == repo).select(F.explode("specs").alias("version", "spec"))


def with_registry(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """rows with version and era_commit that a registry (repo, env_spec_hash, version, era_commit) holds for their repo and hash, null without one (R-07)."""
    first = registry.groupBy("repo", "env_spec_hash").agg(F.min(F.struct("version", "era_commit")).alias("_r"))
    return rows.join(first, ["repo", "env_spec_hash"], "left").withColumn("version", F.col("_r.version")).withColumn("era_commit", F.col("_r.era_commit")).drop("_r")


def declares_rust(toolchain: Column, cargo: Column, version: Column) -> Column:
    """Whether a commit's toolchain file or manifest names the version (R-06)."""
    values = lambda c, key: F.transform(F.regexp_extract_all(text.blank(c), F.lit(rf"(?m)^[^\S\n]*{key}[^=\n]*=([^\n]*)$"), F.lit(1)), lambda v: F.regexp_replace(F.trim(v), r"^['\"]+|['\"]+$", ""))
    return F.array_contains(F.concat(values(toolchain, "channel"), values(cargo, "rust-version")), version)
