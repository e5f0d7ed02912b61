"""JSON-lines and file-tree sources with explicit schemas, strict, lenient or tolerant of bad lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditloom.functions.text import decoded_list

_S, _L, _D, _B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()
_LIST = T.ArrayType(_S)
_LONGS = T.ArrayType(_L)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


CANDIDATE_PR = _struct(repo=_S, pr_number=_L, title=_S, body=_S, base_commit=_S, merge_commit=_S, diff_url=_S, resolved_issues=T.ArrayType(_L), resolved_jira_issues=_LIST, created_at=_S, merged_at=_S, link_confidence=_D)
CANDIDATE = _struct(repo=_S, pr_number=_L, instance_id=_S, base_commit=_S, merge_commit=_S, patch=_S, test_patch=_S, problem_statement=_S, hints_text=_S, created_at=_S, resolved_issues=_LONGS, resolved_jira_issues=_LIST, merged_at=_S, link_confidence=_D, provenance=_S)
TASK = _struct(repo=_S, instance_id=_S, base_commit=_S, patch=_S, test_patch=_S, problem_statement=_S, hints_text=_S, created_at=_S, version=_S, FAIL_TO_PASS=_S, PASS_TO_PASS=_S, environment_setup_commit=_S, language=_S, product=_S, image_name=_S, fix_merge_date=_S, provenance=_S, link_confidence=_D, repo_language=_S, n_fail_to_pass=_L, patch_lines=_L, files_touched=_L, cross_file=_B, env_spec_hash=_S, n_runs=_L, flake_count=_L, quarantined_tests=_LIST, decontamination_overlap=_B, decontamination_overlap_source=_S)
EVAL = _struct(instance_id=_S, resolved=_B, agent_patch=_S, tests_passed=_LIST, tests_failed=_LIST, cost_usd=_D, error_message=_S)
SPEC = _struct(language=_S, language_version=_S, go_version=_S, rust_version=_S, package_manager=_S, install_cmd=_S, build_cmd=_S, test_cmd=_S, module_mode=_S, workspace_mode=_S, workspace_members=_LIST, edition=_S, features=_S, goflags=_S, pre_install=_LIST, pip_packages=_LIST, system_dependencies=_LIST, base_image=_S, env_spec_hash=_S)


def read_lines(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Unknown keys dropped, missing ones null, lines that aren't JSON skipped."""
    bad = "_corrupt"
    full = T.StructType([*schema.fields, T.StructField(bad, _S, True)])
    lines = spark.read.text(path).where(F.trim("value") != "")
    rows = lines.select(F.from_json("value", full, {"columnNameOfCorruptRecord": bad}).alias("r")).select("r.*")
    return rows.where(F.col(bad).isNull()).drop(bad)


def read_strict(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """As read_lines, but a line that isn't JSON or has an unknown key fails the read."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    extra = F.array_except(F.json_object_keys("value"), F.array(*[F.lit(f.name) for f in schema]))
    why = F.when(F.json_object_keys("value").isNull(), F.lit("a line is no JSON object")).when(F.size(extra) > 0, F.concat(F.lit("unknown keys: "), F.array_join(extra, ", ")))
    fine = F.when(why.isNotNull(), F.raise_error(why).cast("boolean")).otherwise(F.lit(True))  # a filter, so that it is checked whatever columns are read
    return lines.where(fine).select(F.from_json("value", schema).alias("r")).select("r.*")


def tests_of(rows: DataFrame) -> DataFrame:
    return rows.select("instance_id", decoded_list(F.col("FAIL_TO_PASS")).alias("tests"))


def read_reference(spark: SparkSession, sources: dict[str, str], hashed) -> DataFrame:
    """(source, source_order, instance_id, patch_hash) of several reference sets; hashed: patch column -> hash column."""
    out = None
    for k, (name, path) in enumerate(sources.items()):
        rows = read_lines(spark, path, _struct(instance_id=_S, patch=_S, model_patch=_S))
        patch = F.coalesce(F.nullif("patch", F.lit("")), F.nullif("model_patch", F.lit("")))
        part = rows.select(F.lit(name).alias("source"), F.lit(k).alias("source_order"), "instance_id", F.when(patch.isNotNull(), hashed(patch)).alias("patch_hash"))
        out = part if out is None else out.union(part)
    return out


def read_tree(spark: SparkSession, path: str, schema: T.StructType, include: str | None = None, exclude: str | None = None) -> DataFrame:
    """One JSON record a file, with job and trial from its path; jobs are pruned by pattern before their files are read."""
    rows = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "result.json").json(path)
    parts = F.split("_metadata.file_path", "/")
    rows = rows.withColumn("job", F.element_at(parts, -3)).withColumn("trial", F.element_at(parts, -2))
    if include:
        rows = rows.where(F.col("job").rlike(include))
    if exclude:
        rows = rows.where(~F.col("job").rlike(exclude))
    return rows.where(~F.col("job").startswith("oracle") & ~F.col("job").startswith("nop"))


def latest_per_key(files: DataFrame, pattern: str) -> DataFrame:
    """(key, path): of files (path) whose name matches, the last by name for each first group of the pattern."""
    key = F.regexp_extract("path", pattern, 1)
    return files.where(F.col("path").rlike(pattern)).groupBy(key.alias("key")).agg(F.max("path").alias("path"))


def read_sources(spark: SparkSession, path: str, suffix: str, excluded: str) -> DataFrame:
    """(path, source) of source files; directories that match the pattern are left out by path."""
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").text(path)
    rows = files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("source"))
    return rows.where(~F.col("path").rlike(excluded))


def ascii_json(text: Column) -> Column:
    """JSON text with signs beyond ASCII as escapes of four small hexadecimal digits, two where a sign needs two."""
    escaped = lambda c: F.regexp_replace(F.lower(F.hex(F.encode(c, "UTF-16BE"))), "(.{4})", r"\\u$1")
    signs = F.transform(F.regexp_extract_all(text, F.lit("(?s)(.)"), F.lit(1)), lambda c: F.when(F.ascii(c) > 127, escaped(c)).otherwise(c))
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.array_join(signs, "")).otherwise(text)


def canonical_hash(fields: dict[str, Column]) -> Column:
    """sha256 of the fields as JSON with sorted keys; list fields must come sorted, nulls as empty."""
    return F.sha2(ascii_json(F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]))).cast("binary"), 256)


#: Fields of each language's environment that its hash covers.
HASHED = {
    "go": ("language", "go_version", "build_cmd", "test_cmd", "module_mode", "goflags", "system_dependencies"),
    "python": ("language", "language_version", "package_manager", "install_cmd", "test_cmd", "pre_install", "pip_packages", "system_dependencies", "base_image"),
    "java": ("language", "language_version", "package_manager", "install_cmd", "test_cmd", "pre_install", "system_dependencies"),
    "rust": ("language", "rust_version", "build_cmd", "test_cmd", "workspace_mode", "workspace_members", "edition", "features", "system_dependencies"),
}
_LISTS = {"pre_install", "pip_packages", "system_dependencies", "workspace_members"}


def spec_hash(language: str) -> Column:
    value = lambda n: F.array_sort(F.coalesce(F.col(n), F.array().cast("array<string>"))) if n in _LISTS else F.coalesce(F.col(n), F.lit(""))
    fields = {n: value(n) for n in HASHED[language]}
    return canonical_hash(fields | {"language": F.coalesce(F.nullif("language", F.lit("")), F.lit(language))})


def env_spec_hash() -> Column:
    """The hash of a row of SPEC by its language; a missing language counts as Go, an unknown one as Python."""
    out, language = spec_hash("python"), F.coalesce(F.nullif("language", F.lit("")), F.lit("go"))
    for name in ("go", "java", "rust"):
        out = F.when(language == name, spec_hash(name)).otherwise(out)
    return out


def read_specs(spark: SparkSession, path: str) -> DataFrame:
    """Environment records named by their own hash; files whose content doesn't match their name are left out."""
    rows = spark.read.schema(SPEC).option("multiLine", True).json(path).withColumn("key", F.regexp_extract("_metadata.file_name", r"^(\w+)\.json$", 1))
    return rows.where(env_spec_hash() == F.col("key"))
