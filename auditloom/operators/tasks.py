"""Checks and projections of task folders and instances, module sets and related files of repositories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditloom.functions.text import blank, module_name, number_of_id
from auditloom.operators.assembly import listed
from auditloom.operators.substrings import contained

#: Fields an instance must have, files of a task, parts of paths that hold no code of a repository's own.
REQUIRED = ("repo", "instance_id", "base_commit", "patch", "test_patch", "problem_statement", "version", "FAIL_TO_PASS", "PASS_TO_PASS")
NOT_OWN = r"demo|example|benchmark|vendor"
IMPORT = r"(?m)^\s*(?:from\s+([\w.]+)\s+import|import\s+([\w.]+))"


def tests_in(c: Column) -> Column:
    """A JSON list of test names as an array; empty where it can't be read."""
    return F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>"))


def dashboard_rows(tasks: DataFrame) -> DataFrame:
    """Instances as a dashboard shows them, with a default for each column that a row lacks (R-29)."""
    kept = lambda name, default: F.coalesce(F.col(name), F.lit(default)).alias(name)
    number = number_of_id(F.col("instance_id"))
    url = F.when((blank(F.col("repo")) != "") & number.isNotNull(), F.concat(F.lit("https://github.com/"), "repo", F.lit("/issues/"), F.regexp_extract("instance_id", r"-(\d+)$", 1))).otherwise("")
    return tasks.select(
        "instance_id", "repo", F.coalesce("repo_language", F.lit("unknown")).alias("language"), kept("patch_lines", 0), kept("files_touched", 0), kept("cross_file", False),
        F.coalesce("n_fail_to_pass", F.size(tests_in(F.col("FAIL_TO_PASS")))).alias("n_fail_to_pass"), url.alias("issue_url"), "fix_merge_date", blank(F.col("patch")).alias("human_patch"),
    )


def first_file(rows: DataFrame, files: DataFrame, key: str, paths: list[str]) -> DataFrame:
    """rows with the content of the first path that is there and not empty, null if none is (R-30). files: key, path, content."""
    place = F.array_position(F.lit(paths), F.col("path"))
    found = files.where(F.col("path").isin(paths) & (F.length("content") > 0)).groupBy(key).agg(F.min_by("content", place).alias("content"))
    return rows.join(found, key, "left")


def task_errors(files: dict[str, Column], runnable: dict[str, Column], language: Column, expected: tuple[str, ...]) -> Column:
    """What is missing or wrong in a task's folder, in order (R-34).

    files: content by path, null where absent; runnable: whether a script may be executed, by path.
    """
    toml, run, solve, docker, config, patch = (files[p] for p in ("task.toml", "tests/test.sh", "solution/solve.sh", "environment/Dockerfile", "tests/config.json", "tests/test.patch"))
    fields = F.from_json(config, "map<string,string>")
    rules = [(files[p].isNull(), f"MISSING: {p}") for p in expected] + [
        (~toml.rlike(r"(?m)^\s*\[task[.\]]"), "task.toml: missing [task] section"),
        (~run.startswith("#!/"), "test.sh: missing shebang"),
        (~run.contains("/logs/verifier/reward.txt"), "test.sh: missing reward.txt write"),
        (run.isNotNull() & ~runnable["tests/test.sh"], "test.sh: not executable"),
        ((language == "go") & ~run.contains("go test"), "test.sh: Go instance missing 'go test' command"),
        ((language == "python") & ~run.contains("pytest"), "test.sh: Python instance missing 'pytest' command"),
        (~solve.contains("git apply"), "solve.sh: missing 'git apply'"),
        (solve.isNotNull() & ~runnable["solution/solve.sh"], "solve.sh: not executable"),
        ((language == "go") & ~F.lower(docker).contains("golang"), "Dockerfile: Go instance missing golang base image"),
        ((language == "python") & ~F.lower(docker).contains("python"), "Dockerfile: Python instance missing python base image"),
        (config.isNotNull() & fields.isNull(), "config.json: INVALID JSON"),
        (~F.map_contains_key(fields, "FAIL_TO_PASS"), "config.json: missing FAIL_TO_PASS"),
        (~F.map_contains_key(fields, "PASS_TO_PASS"), "config.json: missing PASS_TO_PASS"),
        (patch.rlike(r"^\s*$"), "test.patch: empty file"),
    ]
    return F.filter(F.array(*[F.when(wrong, F.lit(text)) for wrong, text in rules]), lambda e: e.isNotNull())


def schema_valid(rows: DataFrame) -> DataFrame:
    """(instances, valid): rows, and those with every required field and a test that must turn to pass (R-42). rows: a JSON object as ``value``."""
    fields = F.from_json("value", "map<string,string>")
    whole = reduce(lambda ok, n: ok & F.map_contains_key(fields, n), REQUIRED, F.lit(True)) & (F.size(tests_in(F.element_at(fields, "FAIL_TO_PASS"))) > 0)
    return rows.agg(F.count(F.lit(1)).alias("instances"), F.count_if(whole).alias("valid"))


def stability(first: DataFrame, second: DataFrame) -> DataFrame:
    """(first, second, common, stable) of two runs' instances; stable ones have equal sets of tests (R-42). Null lists count as empty."""
    tests = lambda df, name: df.select("instance_id", F.array_sort(F.array_distinct(tests_in(F.col("FAIL_TO_PASS")))).alias(name))
    both = tests(first, "a").join(tests(second, "b"), "instance_id", "full")
    met = F.col("a").isNotNull() & F.col("b").isNotNull()
    return both.agg(F.count("a").alias("first"), F.count("b").alias("second"), F.count_if(met).alias("common"), F.count_if(met & (F.col("a") == F.col("b"))).alias("stable"))


def compatible_counts(candidates: DataFrame, results: DataFrame) -> DataFrame:
    """(repo, valid, compatible, incompatible): valid results by repository, and whether their candidate's snapped version is supported (R-37).

    results: instance_id, repo, status; candidates: instance_id, snapped (null where no supported version is near).
    """
    found = results.where("status = 'valid'").join(candidates.select("instance_id", "snapped", F.lit(True).alias("known")), "instance_id", "left")
    known = F.coalesce("known", F.lit(False))
    ok = F.col("snapped").isNotNull()
    return found.groupBy("repo").agg(F.count(F.lit(1)).alias("valid"), F.count_if(known & ok).alias("compatible"), F.count_if(known & ~ok).alias("incompatible"))


def with_unit_tests(candidates: DataFrame, unit_tests: Column) -> DataFrame:
    """Candidates with a patch, a test patch and unit tests in it (R-41)."""
    return candidates.where((blank(F.col("patch")) != "") & (blank(F.col("test_patch")) != "") & F.coalesce(unit_tests, F.lit(False)))


def spec_summaries(scores: DataFrame) -> DataFrame:
    """(repo, version, matched, total, overall, summary) from one row a field: repo, version, nth, field, match, detail (R-02)."""
    ok = F.coalesce("match", F.lit(False))
    line = F.format_string("  [%s] %s: %s", F.when(ok, "MATCH").otherwise("MISS"), F.col("field"), blank(F.col("detail")))
    lines = F.transform(F.sort_array(F.collect_list(F.struct("nth", line.alias("line")))), lambda x: x["line"])
    out = scores.groupBy("repo", "version").agg(F.count_if(ok).alias("matched"), F.count(F.lit(1)).alias("total"), lines.alias("lines"))
    out = out.withColumn("overall", F.col("matched") / F.col("total"))
    head = F.format_string("%s v%s: %d%% (%d/%d fields)", "repo", "version", F.bround(F.col("overall") * 100).cast("int"), "matched", "total")
    return out.select("repo", "version", "matched", "total", "overall", F.array_join(F.concat(F.array(head), "lines"), "\n").alias("summary"))


def repo_modules(files: DataFrame) -> DataFrame:
    """(repo, module): importable dotted modules of each repository's Python files with all their packages, below the root and below src (R-19)."""
    path = F.explode(F.array_distinct(F.array("path", F.regexp_replace("path", "^src/", "")))).alias("path")
    python = files.where(F.col("path").endswith(".py") & ~F.regexp_replace("path", r"[^/]*$", "").rlike(NOT_OWN)).select("repo", path)
    parts = F.split(F.regexp_replace(module_name(F.col("path")), r"(?:^|\.)__init__$", ""), r"\.")
    upto = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "."))
    return python.select("repo", F.explode(upto).alias("module")).where("module <> ''").distinct()


def related_files(targets: DataFrame, files: DataFrame, most: int = 3) -> DataFrame:
    """(target_id, file, line, snippet, nth): up to so many files related to each target function (J-24).

    targets: target_id, repo, file, function_name; files: repo, path, content. In order: modules that the
    target's file imports, test files that name its module or package, other files that name the function;
    each file once, none of vendored or example code. A name may be part of a word; names and texts of a
    repository meet by equal keys (substrings.contained), so no text is searched for every target. line: where
    the snippet begins to be about the function, from 0.
    """
    own = files.where(~F.col("path").rlike(NOT_OWN)).select("repo", "path")
    source = files.withColumnRenamed("path", "file").join(targets.select("target_id", "repo", "file").hint("shuffle_hash"), ["repo", "file"])
    name = F.posexplode(F.regexp_extract_all(blank(F.col("content")), F.lit(IMPORT), F.lit(0))).alias("at", "text")
    imported = source.select("target_id", "repo", name)
    module = F.regexp_replace(F.coalesce(F.nullif(F.regexp_extract("text", IMPORT, 1), F.lit("")), F.regexp_extract("text", IMPORT, 2)), r"\.", "/")
    places = imported.select("target_id", "repo", "at", F.posexplode(F.array(F.concat(module, F.lit(".py")), F.concat(F.lit("src/"), module, F.lit(".py")))).alias("place", "path"))
    imports = places.join(own, ["repo", "path"]).groupBy("target_id", "at").agg(F.min_by(F.struct("repo", "path"), "place").alias("f")).select("target_id", F.lit(0).alias("kind"), F.col("at").cast("string").alias("rank"), "f.repo", "f.path")

    dotted = F.regexp_replace(module_name(F.col("file")), r"^src\.", "")
    keys = F.filter(F.array(dotted, F.regexp_replace(dotted, r"\.?[^.]*$", "")), lambda k: k != "")
    wanted = targets.select("target_id", "repo", F.explode(keys).alias("key"))
    tests = files.where(F.col("path").rlike(r"^tests?/(?:.*/)?test_[^/]*\.py$") & ~F.col("path").rlike(NOT_OWN))
    names_in = lambda texts, names: contained(texts.select("repo", F.col("path").alias("id"), F.col("content").alias("text")), names, on=("repo",)).select("repo", F.col("id").alias("path"), F.col("name_id").alias("key"))
    named = names_in(tests, wanted.select("repo", F.col("key").alias("name_id"), F.col("key").alias("name")).distinct())
    order = F.when(F.col("path").startswith("tests/"), F.concat(F.lit("0"), "path")).otherwise(F.concat(F.lit("1"), "path"))
    tested = wanted.join(named, ["repo", "key"]).select("target_id", F.lit(1).alias("kind"), order.alias("rank"), "repo", "path").distinct()

    plain = files.where(F.col("path").endswith(".py") & ~F.col("path").rlike(NOT_OWN) & ~F.col("path").rlike(r"(^|/)tests?/|(^|/)test_[^/]*\.py$"))
    tokens = names_in(plain, targets.select("repo", F.col("function_name").alias("name_id"), F.col("function_name").alias("name")).distinct())
    named_in = targets.select("target_id", "repo", F.col("function_name").alias("key")).join(tokens, ["repo", "key"]).select("target_id", F.lit(2).alias("kind"), F.col("path").alias("rank"), "repo", "path")

    found = imports.unionByName(tested).unionByName(named_in).join(targets.select("target_id", "file", "function_name"), "target_id").where("path <> file")
    once = found.groupBy("target_id", "repo", "path", "function_name").agg(F.min(F.struct("kind", F.when(F.col("kind") == 0, F.lpad("rank", 9, "0")).otherwise(F.col("rank")).alias("rank"))).alias("first"))
    nth = F.row_number().over(Window.partitionBy("target_id").orderBy("first", "path"))
    few = once.withColumn("nth", nth).where(F.col("nth") <= most)

    lines = F.split(blank(F.col("content")), r"\r\n|\n|\r")
    about = F.filter(F.transform(lines, lambda x, i: F.when(x.contains(F.col("function_name")) & ~F.trim(x).startswith("#"), i)), lambda i: i.isNotNull())
    line = F.when(F.col("first.kind") == 0, 0).otherwise(F.coalesce(F.get(about, F.lit(0)), F.lit(0)))
    start = F.greatest(F.lit(0), F.col("line") - 5)
    out = few.join(files, ["repo", "path"]).withColumn("line", line)
    return out.select("target_id", F.col("path").alias("file"), "line", F.array_join(F.slice(lines, start + 1, F.col("line") + 15 - start), "\n").alias("snippet"), "nth")


def from_dataset(rows: DataFrame) -> DataFrame:
    """Task records from a dataset's rows whose test lists may be JSON or arrays, with defaults for what rows may lack (P-15)."""
    kinds = dict(rows.dtypes)
    tests = lambda n: listed(F.col(n)) if kinds.get(n, "").startswith("array") else F.coalesce(F.col(n), F.lit("[]")) if n in kinds else F.lit("[]")
    kept = lambda n, default: (F.coalesce(F.col(n), F.lit(default)) if n in kinds else F.lit(default)).alias(n)
    needed = ("repo", "instance_id", "base_commit", "patch", "test_patch", "problem_statement")
    return rows.select(*needed, kept("hints_text", ""), kept("created_at", ""), kept("version", "unknown"), tests("FAIL_TO_PASS").alias("FAIL_TO_PASS"), tests("PASS_TO_PASS").alias("PASS_TO_PASS"))


def repo_of_path(path: Column) -> Column:
    """owner/name from a local path that ends in owner__name; anything else as it is (P-18)."""
    slug = F.regexp_extract(F.regexp_replace(path, "/+$", ""), r"([^/]*)$", 1)
    local = (F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit(""))) > 1) & slug.contains("__")
    return F.when(local, F.regexp_replace(slug, "^(.*?)__", "$1/")).otherwise(path)


def instance_folder(instance_id: Column) -> Column:
    """A folder's name for an instance: its id up to the last dash, then the id (R-08)."""
    return F.concat(F.regexp_replace(instance_id, "-[^-]*$", ""), F.lit("/instances/"), instance_id)


def validation_output(output: Column, failed: Column, status: Column, said: Column) -> Column:
    """(status, fail_to_pass, pass_to_pass, error_message) of what an agent left, an error where it failed or left nothing that can be read (R-16)."""
    left = F.from_json(output, "status string, FAIL_TO_PASS array<string>, PASS_TO_PASS array<string>, error_message string, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    none = F.array().cast("array<string>")
    told = F.concat(F.lit("Agent failed: "), F.coalesce(status, F.lit("None")), F.lit(" - "), F.coalesce(F.nullif(said, F.lit("")), F.lit("no output")))
    read = ~F.coalesce(failed, F.lit(False)) & output.isNotNull()
    fine = read & left.isNotNull() & left["_bad"].isNull()
    return F.struct(
        F.when(fine, F.coalesce(left["status"], F.lit("error"))).otherwise("error").alias("status"), F.when(fine, F.coalesce(left["FAIL_TO_PASS"], none)).otherwise(none).alias("fail_to_pass"),
        F.when(fine, F.coalesce(left["PASS_TO_PASS"], none)).otherwise(none).alias("pass_to_pass"), F.when(fine, left["error_message"]).when(read, "result can't be read").otherwise(told).alias("error_message"),
    )


def toml_fields(toml: Column) -> Column:
    """(docker_image, instance_id, repo) of a task's description, null where absent (R-27)."""
    value = lambda k: F.nullif(F.regexp_extract(blank(toml), rf'{k}\s*=\s*"([^"]+)"', 1), F.lit("")).alias(k)
    return F.struct(*[value(k) for k in ("docker_image", "instance_id", "repo")])


def script_command(script: Column, default: str = "go test -v -count=1 ./...") -> Column:
    """The command by which a test script runs its tests: of lines that begin with a variable or a folder, the first that calls a runner, without its redirection (R-27)."""
    lines = F.filter(F.transform(F.split(blank(script), r"\r\n|\r|\n"), lambda x: F.trim(x)), lambda x: x.startswith("$") | x.startswith("(cd "))
    clean = F.transform(lines, lambda x: F.regexp_replace(F.replace(x, F.lit("$$"), F.lit("$")), r'\s*>\s*"\$LOG_FILE".*', ""))
    return F.coalesce(F.get(F.filter(clean, lambda x: x.rlike("go test|pytest|cargo test")), F.lit(0)), F.lit(default))


def target_counts(targets: DataFrame, tests: DataFrame) -> DataFrame:
    """(repo, total, with_tests): each repository's targets (repo, target_id), and those that tests (repo, target_id) name (R-39)."""
    found = targets.join(tests.select("repo", "target_id", F.lit(True).alias("_tested")).distinct(), ["repo", "target_id"], "left")
    return found.groupBy("repo").agg(F.count(F.lit(1)).alias("total"), F.count("_tested").alias("with_tests"))


def relevance(source: Column, function_name: Column, file: Column) -> Column:
    """How many of a bug's function and file name a test's source holds, in any case (R-43, O-03)."""
    stem = F.regexp_replace(F.regexp_extract(file, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")
    names = F.array_distinct(F.filter(F.array(F.lower(function_name), F.lower(stem)), lambda n: n.isNotNull() & (n != "")))
    return F.size(F.filter(names, lambda n: F.lower(blank(source)).contains(n)))
