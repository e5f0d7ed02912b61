"""Instances put together from candidates, results and environments, and what is derived from their rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditloom.functions import diff
from auditloom.functions.text import blank
from auditloom.sources.jsonl import ascii_json


def version_label(language_version: Column, digest: Column) -> Column:
    """Language version and the first signs of the environment's hash; the version alone without a hash, else unknown (P-10)."""
    version = F.nullif(blank(language_version), F.lit(""))
    return F.when(version.isNull(), "unknown").otherwise(F.concat_ws("-", version, F.nullif(F.substring(blank(digest), 1, 8), F.lit(""))))


def registry_version(known: Column, language_version: Column, digest: Column) -> Column:
    """The version that a registry holds for the environment's hash, else version and hash, else more of the hash (P-11)."""
    inline = F.when(blank(language_version) != "", F.concat_ws("-", language_version, F.substring(digest, 1, 8))).otherwise(F.substring(digest, 1, 12))
    return F.coalesce(F.nullif(known, F.lit("")), inline)


def instances(candidates: DataFrame, results: DataFrame, specs: DataFrame, carried: tuple[str, ...] = ("FAIL_TO_PASS", "PASS_TO_PASS", "version")) -> DataFrame:
    """Valid candidates with their test lists and environment (P-04, J-01, J-04).

    results: instance_id, status and carried columns; specs: version and env_spec_hash, one row a version.
    A version without an environment takes the first one by hash (J-05); none at all leaves it null.
    """
    valid = results.where("status = 'valid'").select("instance_id", *carried)
    first = specs.agg(F.min("env_spec_hash").alias("first_spec"))
    found = candidates.join(valid, "instance_id").join(specs.select("version", "env_spec_hash"), "version", "left").join(F.broadcast(first))  # one row
    return found.withColumn("env_spec_hash", F.coalesce("env_spec_hash", "first_spec")).drop("first_spec")


def listed(tests: Column) -> Column:
    """A list of strings as Python writes it in JSON: a space after each comma, signs beyond ASCII as escapes; null as an empty list."""
    quoted = F.transform(F.coalesce(tests, F.array().cast("array<string>")), lambda t: F.regexp_replace(F.to_json(F.array(t)), r"^\[|\]$", ""))
    return ascii_json(F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]")))


def task_instances(candidates: DataFrame, results: DataFrame, specs: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """The task record of each valid candidate (P-04, J-01, J-02, J-04, J-05, R-37): all its columns, with those derived from patch, result and environment.

    candidates: CANDIDATE's columns; results: instance_id, status, fail_to_pass, pass_to_pass, n_runs, flake_count,
    quarantined_tests, spec (the environment it ran in, may be null); specs: env_spec_hash, language, language_version;
    products: repo, product, one row a repo. An environment that specs lack, and a null one, is the first by hash, and none where specs are empty.
    """
    valid = results.where("status = 'valid'").select("instance_id", "fail_to_pass", "pass_to_pass", "n_runs", "flake_count", "quarantined_tests", "spec")
    every = specs.select("env_spec_hash", "language", "language_version").dropDuplicates(["env_spec_hash"])
    first = every.agg(F.min(F.struct("env_spec_hash", "language", "language_version")).alias("first"))
    found = candidates.join(valid, "instance_id").join(every.select(F.col("env_spec_hash").alias("spec"), F.struct("env_spec_hash", "language", "language_version").alias("own")), "spec", "left")
    found = found.join(F.broadcast(first)).withColumn("env", F.coalesce("own", "first"))  # one row
    if products is not None:
        found = found.join(products.groupBy("repo").agg(F.min("product").alias("product")), "repo", "left")
    patch, n_files = blank(F.col("patch")), F.size(diff.sections(F.col("patch")))
    lines = F.when(patch == "", 0).otherwise(F.size(F.split(F.regexp_replace(patch, r"(\r\n|\r|\n)\z", ""), r"\r\n|\r|\n")))
    null = F.lit(None).cast("string")
    return found.select(
        "repo", "instance_id", "base_commit", patch.alias("patch"), blank(F.col("test_patch")).alias("test_patch"), blank(F.col("problem_statement")).alias("problem_statement"),
        blank(F.col("hints_text")).alias("hints_text"), "created_at", version_label(F.col("env.language_version"), F.col("env.env_spec_hash")).alias("version"),
        listed(F.col("fail_to_pass")).alias("FAIL_TO_PASS"), listed(F.col("pass_to_pass")).alias("PASS_TO_PASS"), null.alias("environment_setup_commit"), null.alias("image_name"),
        F.nullif(F.col("merged_at"), F.lit("")).alias("fix_merge_date"), F.lit("public_upstream").alias("provenance"), F.coalesce("link_confidence", F.lit(0.0)).alias("link_confidence"),
        F.col("env.language").alias("repo_language"), (F.col("product") if products is not None else null).alias("product"), F.size(F.coalesce("fail_to_pass", F.array().cast("array<string>"))).alias("n_fail_to_pass"),
        lines.alias("patch_lines"), n_files.alias("files_touched"), (n_files > 1).alias("cross_file"), F.col("env.env_spec_hash").alias("env_spec_hash"),
        F.coalesce("n_runs", F.lit(1)).alias("n_runs"), F.coalesce("flake_count", F.lit(0)).alias("flake_count"), F.coalesce("quarantined_tests", F.array().cast("array<string>")).alias("quarantined_tests"),
        F.lit(False).alias("decontamination_overlap"), null.alias("decontamination_overlap_source"),
    )


def statement(issues: DataFrame, key: str, order: str) -> DataFrame:
    """One text a key from its issues in order: title, line break and body of each, null parts empty, blank lines between (J-21, C-12)."""
    one = F.concat(blank(F.col("title")), F.lit("\n"), blank(F.col("body")))
    parts = F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), one.alias("text")))), lambda x: x["text"])
    return issues.groupBy(key).agg(F.array_join(parts, "\n\n").alias("problem_statement"))


def issue_numbers(title: Column, body: Column) -> Column:
    """Distinct issue numbers of title and body, ascending (E-12)."""
    numbers = lambda c: F.transform(F.regexp_extract_all(blank(c), F.lit(r"#(\d+)"), F.lit(1)), lambda n: n.cast("bigint"))
    return F.array_sort(F.array_union(numbers(title), numbers(body)))


def split_supported(rows: DataFrame, supported: Column) -> tuple[DataFrame, DataFrame]:
    """(rows with a supported version, the others), a null verdict among the others (F-21)."""
    ok = F.coalesce(supported, F.lit(False))
    return rows.where(ok), rows.where(~ok)


def well_formed(repo: Column, commit: Column) -> Column:
    """owner/name and a hexadecimal commit of 7 to 40 signs (F-31)."""
    return blank(repo).rlike(r"^[\w.-]+/[\w.-]+$") & blank(commit).rlike(r"^[0-9a-f]{7,40}$")


def unit_tests_only(patch: Column) -> Column:
    """A patch that touches a Python file under test/units/ (F-30)."""
    return blank(patch).rlike(r"(?m)^diff --git .*test/units/.*\.py")


def language_of_tests(tests: Column) -> Column:
    """Python where a test id has ``::``, else Go where one begins with Test and a capital, else Python (R-31)."""
    some = lambda p: F.coalesce(F.exists(tests, lambda t: t.rlike(p)), F.lit(False))
    return F.when(some("::"), "python").when(some("^Test[A-Z]"), "go").otherwise("python")


def required_language(language: Column, instance_id: Column) -> Column:
    """The language; a row without one fails the query (R-12)."""
    return F.coalesce(F.nullif(language, F.lit("")), F.raise_error(F.concat(F.lit("no language for instance "), blank(instance_id))).cast("string"))


def model_key(agent: Column, model: Column) -> Column:
    """Agent and model without its provider's prefix; without a model, ad hoc (P-19)."""
    clean = F.replace(F.replace(model, F.lit("vertex_ai/"), F.lit("")), F.lit("bedrock/"), F.lit(""))
    return F.concat_ws("__", agent, F.when(blank(model) != "", clean).otherwise("adhoc"))


def task_parts(task: Column, prefix: str) -> Column:
    """(language, instance_id) of a task name: what is left and right of the first double underscore (P-20)."""
    rest = F.when(task.startswith(prefix), F.substring(task, F.lit(len(prefix) + 1), F.length(task))).otherwise(task)
    parts = F.split(rest, "__", 2)
    return F.when(F.size(parts) == 2, F.struct(parts[0].alias("language"), parts[1].alias("instance_id"))).otherwise(F.struct(F.lit("unknown").alias("language"), rest.alias("instance_id")))


def image_name(slug: Column, version: Column, registry: str) -> Column:
    return F.concat(F.lit(f"{registry}/"), slug, F.lit(":"), version)  # P-23


def per_test(names: Column, results: Column) -> Column:
    """For each name whether its result is a pass; results: map of name to status (P-24)."""
    return F.transform(names, lambda n: F.struct(n.alias("n"), F.coalesce(F.element_at(results, n).isin("pass", "passed"), F.lit(False)).alias("p")))


def shortened_tests(tests: Column, most: int = 50) -> Column:
    """The first tests of a list as JSON text (P-13)."""
    return F.to_json(F.slice(F.coalesce(tests, F.array().cast("array<string>")), 1, most))


def first_distinct(values: DataFrame, key: str, value: str, order: str, most: int) -> DataFrame:
    """The first distinct values of each key in order, at most so many (U-06)."""
    once = values.groupBy(key, value).agg(F.min(order).alias("_at"))
    nth = F.row_number().over(Window.partitionBy(key).orderBy("_at", value))
    return once.withColumn("_nth", nth).where(F.col("_nth") <= most).groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("_nth", value))), lambda x: x[value]).alias("values"))


def in_priority(frames: list[DataFrame]) -> DataFrame:
    """The frames' rows with their place in the list as ``priority`` (E-13)."""
    out = frames[0].withColumn("priority", F.lit(0))
    for k, df in enumerate(frames[1:], 1):
        out = out.unionByName(df.withColumn("priority", F.lit(k)))
    return out


def boosted(rows: DataFrame, failing: Column, rank: str, most: int = 3) -> DataFrame:
    """Rows that fail first, then by rank, at most so many (O-05)."""
    return rows.orderBy(F.coalesce(failing, F.lit(False)).desc(), F.col(rank)).limit(most)


def by_count(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), key)  # O-08


def spec_score(matches: list[Column]) -> Column:
    """Share of comparators that hold, an unknown one counting as not (A-19)."""
    return sum((F.coalesce(m, F.lit(False)).cast("int") for m in matches), F.lit(0)) / F.lit(float(len(matches)))


def difficulty_score(results: DataFrame, categories: DataFrame, kinds: float = 5.0) -> DataFrame:
    """(model_failure, diversity, score) of one run: unresolved share, kinds of bugs up to five, and their weighted sum (A-30)."""
    failed = results.agg(F.coalesce(F.avg((~F.coalesce("resolved", F.lit(False))).cast("double")), F.lit(0.0)).alias("model_failure"))
    spread = categories.agg(F.least(F.lit(1.0), F.count_distinct(F.coalesce("category", F.lit("unknown"))) / kinds).alias("diversity"))
    return failed.join(F.broadcast(spread)).withColumn("score", F.col("model_failure") * 0.7 + F.col("diversity") * 0.15 + F.lit(0.15 * 0.5))  # one row each


def usability(yield_rate: Column, valid_rate: Column, evasion: Column, diversity: Column) -> Column:
    return yield_rate * valid_rate * evasion * diversity  # A-29


def viability(builds: Column, with_tests: Column, status: Column, seconds: Column) -> Column:
    """Class of a repository from its build and test figures (A-46)."""
    slow = (status == "timeout") | (seconds > 120)
    return F.when(~builds, "Broken").when(with_tests < 20, "Thin").when(slow, "Slow").when(status.isin("pass", "test_fail", "skipped"), "Viable").otherwise("Broken")


def progress(rows: DataFrame, key: str, total: str) -> DataFrame:
    """By key: rows done by status, seconds spent, and seconds left at the mean so far (A-35). total: rows planned for the key."""
    done = rows.groupBy(key).agg(F.count_if(F.col("status") == "valid").alias("valid"), F.count_if(F.col("status") == "invalid").alias("invalid"), F.count_if(F.col("status") == "error").alias("errors"), F.count(F.lit(1)).alias("done"), F.sum("seconds").alias("seconds"), F.avg("seconds").alias("mean"), F.max(total).alias("total"))
    return done.withColumn("eta", F.col("mean") * F.greatest(F.col("total") - F.col("done"), F.lit(0))).drop("mean")


def usual_gap(lines: DataFrame, key: str) -> DataFrame:
    """By key: the most frequent number of blank lines between blocks, the smaller of ties (A-47)."""
    return lines.groupBy(key, "gap").agg(F.count(F.lit(1)).alias("n")).groupBy(key).agg(F.max_by("gap", F.struct(F.col("n"), -F.col("gap"))).alias("gap"))


def folded_status(lines: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, test, status) from raw lines of Go test output in any order: failed before passed before skipped (A-50, A-51).

    A subtest counts for what is before its last slash; a bare FAIL line names what follows it.
    """
    line = F.trim("line")
    name = F.coalesce(*[F.nullif(F.regexp_extract(line, p, 1), F.lit("")) for p in (r"^--- PASS: (\S+)", r"^--- FAIL: (\S+)", r"^FAIL:?\s?(.+?)\s", r"^--- SKIP: (\S+)")])
    rank = F.when(line.rlike(r"^--- PASS: \S"), 2).when(line.rlike(r"^--- FAIL: \S|^FAIL:?\s?.+?\s"), 3).when(line.rlike(r"^--- SKIP: \S"), 1)
    told = lines.select(*keys, F.regexp_replace(name, r"/[^/]*$", "").alias("test"), rank.alias("rank")).where("rank is not null and test is not null")
    best = told.groupBy(*keys, "test").agg(F.max("rank").alias("rank"))
    return best.select(*keys, "test", F.element_at(F.array(F.lit("skipped"), F.lit("passed"), F.lit("failed")), F.col("rank")).alias("status"))


def assigned_before(lines: DataFrame, keys: list[str], order: str, used: Column, assigned: Column, most: int = 3) -> DataFrame:
    """lines that use a value, with the earliest of the few lines before that assigns it (W-11)."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-most, -1)
    return lines.withColumn("assigned", F.first(F.when(assigned, F.col("line")), ignorenulls=True).over(w)).where(used)


def call_after(lines: DataFrame, keys: list[str], order: str, opens: Column, call: Column, most: int = 4) -> DataFrame:
    """lines that open a block, with the first call in the few lines after (W-12)."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(1, most)
    return lines.withColumn("call", F.first(F.when(call, F.col("line")), ignorenulls=True).over(w)).where(opens)


def callers(functions: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """(name, file, caller): for each function the first other file of its package whose text has its name as a word (J-23).

    functions: package, file, name; sources: package, file, text. Words of each text are exploded once and met
    by equal keys, so no text is searched for every name.
    """
    words = sources.select("package", F.col("file").alias("caller"), F.explode(F.array_distinct(F.regexp_extract_all(blank(F.col("text")), F.lit(r"(\w+)"), F.lit(1)))).alias("name"))
    pairs = functions.join(words, ["package", "name"]).where("file <> caller")
    return pairs.groupBy("package", "file", "name").agg(F.min("caller").alias("caller")).orderBy("package", "file", "name").limit(most)


def relevant_assertions(assertions: DataFrame, targets: DataFrame) -> DataFrame:
    """(assertion_id, target) where an assertion calls the target or has its name as a word of its expression (J-27): two equal-key branches."""
    called = assertions.select("assertion_id", F.col("called_function").alias("target"))
    named = assertions.select("assertion_id", F.explode(F.regexp_extract_all(blank(F.col("expression")), F.lit(r"(\w+)"), F.lit(1))).alias("target"))
    return called.union(named).join(targets.select("target").distinct(), "target").distinct().select("assertion_id", "target")


def next_round(names: Column) -> Column:
    """One more than the largest round number in file names; 1 where none has one (R-40). An aggregate."""
    return F.coalesce(F.max(F.regexp_extract(names, r"(\d+)", 1).try_cast("int")), F.lit(0)) + 1
