"""Column expressions over test output, issue texts, commands and test code.

Null texts count as empty. Where a rule has an order, the first alternative that matches wins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from auditloom.functions.text import blank

#: Words of lines by which tools report a failure, marks of tests, and words of texts that must go together.
GOT, WANT, EXPECTED, OUTCOME = ("got", "Got"), ("want", "Want", "expected"), ("Expected", "expected"), ("to equal", "to be", "but got")
TEST_PATTERNS = {"go": r"(?m)^func\s+Test\w+", "rust": r"#\[test\]", "java": r"@Test\b", "python": r"(?m)^\s*def\s+test_\w+"}
ISSUE_TITLE = r"(?i)(?:fix(?:e[sd])?|clos(?:e[sd])?|resolv(?:e[sd])?)\s+#\d+[:\s]+(.+)"
LICENSE_WORDS = ("license", "copyright", "apache", "mit", "header")
OPERATORS = (" == ", " != ", " <= ", " >= ", " < ", " > ", " + ", " - ", " and ", " or ")


def told(text: Column, before: str, said: str = r"\S[^\n]*") -> Column:
    """What the first line that has it says after some sign, trimmed; null if none does."""
    pattern = rf"(?m){before}({said})"
    return F.when(blank(text).rlike(pattern), F.trim(F.regexp_extract(blank(text), pattern, 1)))


def go_message(output: Column) -> Column:
    """What a failing Go test says: got and want, then an expectation and its outcome, then an error (C-34)."""
    one = lambda words: f"(?:{'|'.join(words)})"
    pair = lambda lead, link, tail: rf"{one(lead)}\s+[^\n]+?{link}{one(tail)}\s+[^\n]+"
    return F.coalesce(told(output, "", pair(GOT, r",\s*", WANT)), told(output, "", pair(EXPECTED, r"\s+", OUTCOME)), told(output, r"Error:\s+"))


def python_message(output: Column) -> Column:
    """(assertion, detail) of a failing Python test: the error's message, else the source line, else the evaluated one; detail, the summary's reason, only without them (C-34b)."""
    assertion = F.coalesce(told(output, r"AssertionError:\s*"), told(output, r">\s+assert\s+"), told(output, r"^E\s+assert\s+"))
    return F.struct(assertion.alias("assertion"), F.when(assertion.isNull(), told(output, r"FAILED[^\n]*?-\s+")).alias("detail"))


def loose_pytest(output: Column) -> Column:
    """(passed, failed): on lines that begin with or hold a verdict, the first token with ``::`` (C-57)."""
    lines = F.transform(F.split(blank(output), r"\r\n|\r|\n"), lambda x: F.trim(x))
    told = lambda word: lambda x: x.startswith(word) | x.contains(f" {word}")
    named = lambda xs: F.filter(F.transform(xs, lambda x: F.regexp_extract(x, r"(\S*::\S*)", 1)), lambda t: t != "")
    passed = F.filter(lines, told("PASSED"))
    failed = F.filter(lines, lambda x: told("FAILED")(x) & ~told("PASSED")(x))
    return F.struct(named(passed).alias("passed"), F.transform(named(failed), lambda t: F.regexp_replace(t, r"[ -]+$", "")).alias("failed"))


def test_files(output: Column) -> Column:
    """Distinct sorted Go test files that an output's lines name."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(blank(output), F.lit(r"\b(\w+_test\.go):\d+"), F.lit(1))))


def test_names(output: Column) -> Column:
    """Distinct sorted Go tests with a verdict line of their own; subtests by their parent."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(blank(output), F.lit(r"(?m)^\s*--- (?:FAIL|PASS): (\w+)"), F.lit(1))))


def go_command(packages: Column, names: Column) -> Column:
    """A targeted Go test command from package paths and test names; null without packages (C-56)."""
    run = F.when(F.size(names) > 0, F.concat(F.lit(" -run '"), F.array_join(F.transform(F.array_sort(names), lambda n: F.concat(F.lit("^"), n, F.lit("$"))), "|"), F.lit("'"))).otherwise("")
    return F.when(F.size(packages) > 0, F.concat(F.lit("go test -v -count=1 -timeout 300s "), F.array_join(F.array_sort(F.array_distinct(packages)), " "), run))


def verbose_pytest(command: Column) -> Column:
    """The command with -v after pytest, or at its end (R-09)."""
    parts = F.split(command, "pytest", 2)
    return F.when(command.contains("-v"), command).when(command.contains("pytest"), F.concat(parts[0], F.lit("pytest -v"), parts[1])).otherwise(F.concat(command, F.lit(" -v")))


def test_command(language: Column, scope: Column, spec_command: Column) -> Column:
    """The command that runs an instance's tests, by language (R-13). scope: for Go the whole command of the patch, else what to append."""
    scoped = lambda base: F.when(blank(scope) != "", F.concat(base, F.lit(" "), scope)).otherwise(base)
    python = F.when(blank(spec_command) != "", verbose_pytest(spec_command)).otherwise(F.lit("pytest -v"))
    go = F.coalesce(F.nullif(scope, F.lit("")), F.lit("go test -v -count=1 ./..."))
    by = F.when(language == "go", go).when(language == "python", scoped(python)).when(language == "java", scoped(F.lit("mvn test -B")))
    return by.when(language == "rust", F.lit("cargo test 2>&1")).otherwise(F.lit("echo 'Unsupported language'"))


def go_patch_command(patch: Column) -> Column:
    """Go test command of a test patch: one a top directory, in order of appearance (C-55)."""
    paths = F.regexp_extract_all(blank(patch), F.lit(r"(?m)^diff --git \S+ (?:b/)?(\S+)"), F.lit(1))
    parts = F.transform(paths, lambda p: F.split(p, "/"))
    rel = lambda p: F.array_join(F.slice(p, 2, F.greatest(F.size(p) - 2, F.lit(0))), "/")
    pairs = F.transform(parts, lambda p: F.struct(F.when(F.size(p) > 1, p[0]).otherwise(".").alias("top"), F.when((F.size(p) > 2) & (rel(p) != ""), F.concat(F.lit("./"), rel(p))).otherwise("./...").alias("package")))
    tops = F.array_distinct(pairs["top"])

    def command(top: Column) -> Column:
        packages = F.array_join(F.array_distinct(F.transform(F.filter(pairs, lambda x: x["top"] == top), lambda x: x["package"])), " ")
        quoted = F.when(top.rlike(r"^[\w@%+=:,./-]+$"), top).otherwise(F.concat(F.lit("'"), top, F.lit("'")))
        run = F.concat(F.lit("go test -v -count=1 "), packages)
        return F.when(top == ".", run).otherwise(F.concat(F.lit("(cd "), quoted, F.lit(" && "), run, F.lit(")")))

    return F.when(F.size(tops) == 0, F.lit("go test -v -count=1 ./...")).otherwise(F.array_join(F.transform(tops, command), " ; "))


def test_count(code: Column, language: Column) -> Column:
    """How many tests a piece of code defines; Python's rule for other languages (C-47)."""
    counted = lambda p: F.regexp_count(blank(code), F.lit(p)).cast("int")
    return F.when(language == "go", counted(TEST_PATTERNS["go"])).when(language == "rust", counted(TEST_PATTERNS["rust"])).when(language == "java", counted(TEST_PATTERNS["java"])).otherwise(counted(TEST_PATTERNS["python"]))


def go_imports(source: Column) -> Column:
    """The first import block or line of a Go file with a line end; empty if there is none (C-48)."""
    found = F.regexp_extract(blank(source), r'(?s)(import\s+\(.*?\)|import\s+"[^"]*")', 1)
    return F.when(found != "", F.concat(found, F.lit("\n"))).otherwise("")


def python_imports(source: Column) -> Column:
    """Lines before the first that is no import, comment or blank; once a line is kept, such a line ends them (C-48)."""
    lines = F.split(F.regexp_replace(blank(source), r"\n$", ""), r"\r\n|\r|\n")
    header = lambda x: x.rlike(r"^\s*(?:import |from |#)") | (F.trim(x) == "")
    flags = F.transform(lines, header)
    first = F.greatest(F.array_position(flags, True), F.lit(1)).cast("int")
    tail = F.slice(flags, first, F.greatest(F.size(flags) - first + 1, F.lit(0)))
    ends = F.array_position(tail, False).cast("int")
    kept = F.slice(lines, first, F.when(ends > 0, ends - 1).otherwise(F.size(tail)))
    return F.when((blank(source) == "") | (F.size(kept) == 0), F.lit("")).otherwise(F.concat(F.regexp_replace(F.array_join(kept, "\n"), r"\s+$", ""), F.lit("\n")))


def issue_titles(subjects: Column, most: int = 3) -> Column:
    """Titles of issues that commit subjects close, of 11 to 119 signs, the first few (C-60)."""
    titles = F.transform(subjects, lambda s: F.trim(F.regexp_extract(s, ISSUE_TITLE, 1)))
    return F.slice(F.filter(titles, lambda t: (F.length(t) > 10) & (F.length(t) < 120)), 1, most)


def aligned(issue: Column, patch: Column, signals: tuple[str, ...]) -> Column:
    """Unless an issue speaks of licensing (one of the signals) while the patch has no word of it (F-24)."""
    speaks = F.lower(blank(issue)).rlike("|".join(rf"\Q{s}\E" for s in signals))
    return ~speaks | F.lower(blank(patch)).rlike("|".join(LICENSE_WORDS))


def meaningful_test(code: Column, tautologies: tuple[str, ...] = (r"assert\s+True\b", r"assertTrue\(\s*True\s*\)", r"assert\s+1\s*==\s*1\b")) -> Column:
    """Python test code without a tautology and with an assertion (F-39); that it parses is ``code.parses``."""
    empty = F.lit(False)
    for p in tautologies:
        empty = empty | blank(code).rlike(p)
    return ~empty & (blank(code).contains("assert") | blank(code).contains("pytest.raises"))


def import_failure(log: Column) -> Column:
    """Whether a log tells of a name that could not be imported or found (F-13)."""
    return blank(log).contains("ImportError") | blank(log).contains("AttributeError")


def rust_tests_only(source: Column) -> Column:
    """A file that is a test module as a whole (F-35)."""
    return F.trim(blank(source)).startswith("#[cfg(test)]")


def scored_code(source: Column, edges: tuple[str, ...], branches: tuple[str, ...]) -> Column:
    """Edge signals once, branch signals twice, one for every ten lines up to five, two for three returns (C-38)."""
    hits = lambda patterns: sum((blank(source).rlike(p).cast("int") for p in patterns), F.lit(0))
    lines = F.size(F.split(F.regexp_replace(blank(source), r"\n$", ""), "\n"))
    returns = F.when(F.regexp_count(blank(source), F.lit(r"\breturn\s+")) >= 3, 2).otherwise(0)
    return hits(edges) + hits(branches) * 2 + F.least(F.floor(lines / 10).cast("int"), F.lit(5)) + returns


#: How changes are described, by what the changed line gained or lost.
SWAPPED = "Changed '{}' to '{}' in computation, producing wrong results for certain inputs"
DESCRIPTIONS = (
    ("gained", " not ", "Inverted guard condition, causing validation to trigger for wrong inputs"),
    ("lost", " not ", "Removed negation from condition, skipping important validation"),
    ("lost", "raise ", "Removed error handling, allowing invalid state to propagate silently"),
    ("gained", "return None", "Changed return value to None, breaking callers that expect a value"),
    ("lost", "return None", "Changed None return to a value, breaking callers that check for None"),
)
OTHER_CHANGE = "Subtle logic change affecting function output under certain inputs"


def described_change(before: Column, after: Column, swaps: tuple[tuple[str, str], ...]) -> Column:
    """What a mutation does, in words (C-43): the first exchanged operator of swaps, else the first thing gained or lost. A bare return is one of None that can be lost."""
    was = F.when(F.trim(before) == "return", "return None").otherwise(F.trim(before))
    exchanged = [F.when(before.contains(old) & after.contains(new), SWAPPED.format(old.strip(), new.strip())) for old, new in swaps]
    holder = {"gained": (F.trim(after), F.trim(before)), "lost": (was, F.trim(after))}
    found = [F.when(holder[how][0].contains(what) & ~holder[how][1].contains(what), words) for how, what, words in DESCRIPTIONS]
    return F.coalesce(*exchanged, *found, F.lit(OTHER_CHANGE))


def without_labels(code: Column, patterns: tuple[str, ...]) -> Column:
    """Code without the labels; more than two line ends in a row become two (C-64)."""
    out = blank(code)
    for p in patterns:
        out = F.regexp_replace(out, p, "")
    return F.regexp_replace(out, r"\n{3,}", "\n\n")


def real_references(text: Column, known: Column) -> Column:
    """RST references kept as they are where their target is known, else as plain text (C-25)."""
    pattern = r":\w+:`~?[^`]+`"
    refs, gaps = F.regexp_extract_all(blank(text), F.lit(f"({pattern})"), F.lit(1)), F.split(blank(text), pattern, -1)
    target = lambda r: F.regexp_extract(r, r"`~?([^`]+)`", 1)
    kept = F.transform(refs, lambda r: F.when(F.array_contains(known, target(r)), r).otherwise(target(r)))
    return F.array_join(F.zip_with(gaps, kept, lambda g, r: F.concat(F.coalesce(g, F.lit("")), F.coalesce(r, F.lit("")))), "")


def opened(text: Column, openers: dict[str, str]) -> Column:
    """A text whose first line with content begins with one of the openers, with its replacement (C-62)."""
    out, t = F.when(F.lit(False), ""), blank(text)
    for old, new in openers.items():
        out = out.when(t.rlike(rf"^\s*\Q{old}\E"), F.concat(F.regexp_extract(t, r"^(\s*)", 1), F.lit(new), F.substring(F.ltrim(F.regexp_replace(t, r"^\s+", "")), F.lit(len(old) + 1), F.length(t))))
    return out.otherwise(text)
