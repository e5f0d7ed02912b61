"""Column expressions over unified diffs: files, sections, symbols, scopes, hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from auditloom.functions.text import blank, first_of

#: Directories and base names of tests.
TEST_DIRECTORIES = ("test", "tests", "e2e", "testing", "testdata")
TEST_NAMES = r"^test_|_test\.go$|_test\.rs$|_test\.|\.test\.|_spec\.|\.spec\."


def lines(patch: Column) -> Column:
    return F.split(blank(patch), "\n", -1)


def content_lines(patch: Column) -> Column:
    """Added and removed lines without file headers."""
    return F.filter(lines(patch), lambda x: (x.startswith("+") | x.startswith("-")) & ~x.startswith("+++") & ~x.startswith("---"))


def normal_patch(patch: Column) -> Column:
    return F.array_join(F.transform(content_lines(patch), lambda x: F.regexp_replace(x, r"\s+$", "")), "\n")


def patch_hash(patch: Column) -> Column:
    return F.sha2(normal_patch(patch).cast("binary"), 256)


def changed_lines(patch: Column) -> Column:
    return F.size(content_lines(patch))


def is_test_file(path: Column) -> Column:
    p = F.replace(path, F.lit("\\"), F.lit("/"))
    parts = F.split(p, "/")
    inside = F.exists(parts, lambda x: F.lower(x).isin(*TEST_DIRECTORIES))
    return inside | p.startswith("src/test/") | p.contains("/src/test/") | F.element_at(parts, -1).rlike(TEST_NAMES)


def sections(patch: Column) -> Column:
    """One element a file: its part of the diff, header first."""
    cut = F.split(F.concat(F.lit("\n"), blank(patch)), r"\n(?=diff --git )")
    return F.filter(cut, lambda x: x.startswith("diff --git "))


def path_of(section: Column) -> Column:
    return F.regexp_extract(section, r"^diff --git a/\S+ b/(\S+)", 1)


def files(patch: Column) -> Column:
    return F.array_distinct(F.transform(sections(patch), path_of))


def split_patch(patch: Column) -> Column:
    """(gold, test): sections of source and of test files. Without sections all is gold; blank gives nulls."""
    parts = sections(patch)
    joined = lambda keep: F.nullif(F.array_join(F.filter(parts, keep), "\n"), F.lit(""))
    gold = F.when(F.size(parts) > 0, joined(lambda s: ~is_test_file(path_of(s)))).otherwise(F.nullif(blank(patch), F.lit("")))
    test = F.when(F.size(parts) > 0, joined(lambda s: is_test_file(path_of(s))))
    none = F.trim(blank(patch)) == ""
    return F.struct(F.when(~none, gold).alias("gold"), F.when(~none, test).alias("test"))


def hunks(section: Column) -> Column:
    """(start, count, lines) of each hunk, by the new file's line numbers."""
    cut = F.filter(F.split(section, r"\n(?=@@ )"), lambda x: x.startswith("@@ "))
    number = lambda h, g: F.regexp_extract(h, r"^@@ -\d+(?:,\d+)? \+(\d+)(?:,(\d+))? @@", g)
    return F.transform(
        cut,
        lambda h: F.struct(number(h, 1).try_cast("int").alias("start"), F.coalesce(number(h, 2).try_cast("int"), F.lit(1)).alias("count"), F.filter(F.split(h, "\n"), lambda x: ~x.startswith("@@")).alias("lines")),
    )


def rebuilt(section: Column, kept: Column) -> Column:
    """A file's header with the chosen hunks."""
    return F.concat_ws("\n", F.split(section, r"\n(?=@@ )")[0], kept)


def symbols(patch: Column, pattern: str, sign: str) -> Column:
    full = rf"^{'[+]' if sign == '+' else '-'}{pattern}"
    return F.filter(F.array_distinct(F.transform(lines(patch), lambda x: F.regexp_extract(x, full, 1))), lambda s: s != "")


PYTHON_SYMBOL = r"\s*(?:async\s+)?(?:def|class)\s+(\w+)"
GO_FUNCTION = r"\s*func\s+(?:\([^)]+\)\s+)?([A-Z]\w*)\s*\("
GO_TYPE = r"\s*type\s+([A-Z]\w*)\s+"


def new_python_symbols(patch: Column) -> Column:
    return F.array_except(symbols(patch, PYTHON_SYMBOL, "+"), symbols(patch, PYTHON_SYMBOL, "-"))


def new_go_symbols(patch: Column) -> Column:
    both = lambda sign: F.array_union(symbols(patch, GO_FUNCTION, sign), symbols(patch, GO_TYPE, sign))
    return F.array_except(both("+"), both("-"))


def names_symbol(test: Column, symbol: Column) -> Column:
    return F.exists(F.split(test, "::"), lambda part: F.endswith(F.split(part, r"\[")[0], symbol))


def leaked_symbol(tests: Column, found: Column) -> Column:
    """The least of the new symbols that a test's name ends with; null if none does."""
    return F.array_min(F.filter(found, lambda s: F.exists(tests, lambda t: names_symbol(t, s))))


def summary(patch: Column, most: int = 3) -> Column:
    count = lambda sign: F.size(F.filter(content_lines(patch), lambda x: x.startswith(sign)))
    names = files(patch)
    return F.concat(F.size(names).cast("string"), F.lit(" files, +"), count("+").cast("string"), F.lit(" -"), count("-").cast("string"), F.lit(": "), F.array_join(F.slice(names, 1, most), ", "))


def go_scope(patch: Column) -> Column:
    """Distinct directories of Go tests, in order, as the go tool takes them."""
    tests = F.filter(files(patch), lambda p: p.endswith("_test.go"))
    return F.array_join(F.array_sort(F.array_distinct(F.transform(tests, lambda p: F.concat(F.lit("./"), F.regexp_replace(p, r"/?[^/]*$", ""))))), " ")


def python_scope(patch: Column) -> Column:
    return F.array_join(F.filter(F.transform(sections(patch), path_of), lambda p: p.endswith(".py") & is_test_file(p)), " ")


def java_scope(patch: Column) -> Column:
    tests = F.filter(files(patch), lambda p: p.endswith(".java") & is_test_file(p))
    names = F.array_distinct(F.transform(tests, lambda p: F.regexp_extract(p, r"([^/]+)\.java$", 1)))
    return F.when(F.size(names) > 0, F.concat(F.lit("-Dtest="), F.array_join(names, ",")))


def by_top_directory(patch: Column) -> Column:
    """(root, paths) for each first directory of the files, in order."""
    names = files(patch)
    root = lambda p: F.when(p.contains("/"), F.split(p, "/")[0]).otherwise(F.lit("."))
    return F.transform(F.array_sort(F.array_distinct(F.transform(names, root))), lambda r: F.struct(r.alias("root"), F.filter(names, lambda p: root(p) == r).alias("paths")))


def version_of(sources: dict[str, Column]) -> Column:
    """The first version that the given files declare, by kind, in this order."""
    patterns = (
        ("pyproject", r'(?s)\[(?:project|tool\.poetry)\].*?\bversion\s*=\s*"([^"]+)"'), ("setup.cfg", r"(?m)^version\s*=\s*(\S+)"), ("setup.py", r"version\s*=\s*['\"]([^'\"]+)['\"]"),
        ("package.json", r'"version"\s*:\s*"([^"]+)"'), ("cargo", r'(?s)\[package\].*?\bversion\s*=\s*"([^"]+)"'), ("go.mod", r"(?m)^go\s+(\S+)"), ("pom", r"<version>([^<]+)</version>"),
    )
    found = [F.regexp_extract(sources[k], p, 1) for k, p in patterns if k in sources]
    return first_of(*found)
