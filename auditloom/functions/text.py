"""Column expressions over texts: words, references, identifiers, commands, verdict tags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Keywords that resolve an issue, trailers with their score, default project keys.
RESOLVING = ("close", "closes", "closed", "fix", "fixes", "fixed", "resolve", "resolves", "resolved")
TRAILERS = ((r"(?mi)^Resolves:\s+\S+", 1.0), (r"(?mi)^Fixes:\s+\S+", 1.0), (r"(?mi)^Bug-Url:\s+\S+", 0.95))
PROJECTS = ("STOR", "MGMT")
LETTER = r"[\p{L}\p{N}_]"


def blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def words(c: Column) -> Column:
    t = F.regexp_replace(blank(c), r"^\s+|\s+$", "")
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, r"\s+"))


def word_count(c: Column) -> Column:
    return F.size(words(c))


def line_count(c: Column) -> Column:
    """Lines as splitlines counts them for newline alone: a last newline ends a line, blank text has none."""
    t = blank(c)
    return F.when(t == "", 0).otherwise(F.size(F.split(t, "\n", -1)) - F.endswith(t, F.lit("\n")).cast("int"))


def has_url(c: Column) -> Column:
    return blank(c).rlike(r"https?://\S+")


def has_sha(c: Column) -> Column:
    return blank(c).rlike(r"(^|[^\p{L}\p{N}_])[0-9a-f]{7,40}([^\p{L}\p{N}_]|$)")


def image_only(c: Column) -> Column:
    return F.trim(F.regexp_replace(blank(c), r"!\[[^\]]*\]\([^)]*\)", "")) == ""


def first_of(*options: Column) -> Column:
    """The first option that is neither null nor empty."""
    return F.coalesce(*[F.nullif(o, F.lit("")) for o in options])


def numbers_after(c: Column, keywords: tuple[str, ...] = RESOLVING) -> Column:
    """Distinct numbers, in order, that follow one of the keywords (``fixes #12``)."""
    t = blank(c)
    pattern = r"(\w+)\s+#?(\d+)"
    pairs = F.arrays_zip(F.regexp_extract_all(t, F.lit(pattern), F.lit(1)).alias("w"), F.regexp_extract_all(t, F.lit(pattern), F.lit(2)).alias("n"))
    kept = F.filter(pairs, lambda p: F.lower(p["w"]).isin(*keywords))
    return F.array_sort(F.array_distinct(F.transform(kept, lambda p: p["n"].cast("bigint"))))


def project_keys(c: Column, projects: tuple[str, ...] = PROJECTS) -> Column:
    names = "|".join(("OCPBUGS", *projects))
    return F.array_sort(F.array_distinct(F.regexp_extract_all(blank(c), F.lit(rf"\b((?:{names})-\d+)\b"), F.lit(1))))


def link_confidence(c: Column, projects: tuple[str, ...] = PROJECTS) -> Column:
    """Highest score among the references found; 0 without any."""
    t = blank(c)
    signs = [(t.rlike(p), s) for p, s in TRAILERS]
    signs += [(t.rlike(r"(?i)rhbz#\d+"), 0.9), (t.rlike(r"\bOCPBUGS-\d+\b"), 0.9), (t.rlike(r"(?m)^Change-Id:\s+I[0-9a-f]+"), 0.5)]
    signs += [(t.rlike(rf"\b{p}-\d+\b"), 0.7) for p in projects]
    signs += [(F.size(numbers_after(c)) > 0, 1.0)]
    return F.greatest(*[F.when(met, F.lit(score)).otherwise(F.lit(0.0)) for met, score in signs])


def word_runs(w: Column, n: int) -> Column:
    """All runs of n neighbours of an array, each as one text: the array against itself moved on, so it is computed n times only."""
    size = F.greatest(F.size(w) - (n - 1), F.lit(0))
    return F.transform(F.arrays_zip(*[F.slice(w, i + 1, size).alias(f"w{i}") for i in range(n)]), lambda r: F.concat_ws(" ", *[r[f"w{i}"] for i in range(n)]))


def shingles(c: Column, n: int = 3) -> Column:
    """Distinct runs of n lower-cased words, words being letters, digits and underscores."""
    return F.array_distinct(word_runs(F.regexp_extract_all(F.lower(blank(c)), F.lit(rf"({LETTER}+)"), F.lit(1)), n))


def jaccard(a: Column, b: Column, both_empty: float = 1.0) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(both_empty)).otherwise(F.size(F.array_intersect(a, b)) / union)


def trigram_jaccard(a: Column, b: Column) -> Column:
    return jaccard(shingles(a), shingles(b), 0.0)


def go_test_name(c: Column) -> Column:
    """Bare function name of a test id: from its first Test, Benchmark or Example on, without subtests."""
    name = first_of(F.regexp_extract(c, r"(?:^|\.)((?:Test|Benchmark|Example)\w*)", 1), c)
    return F.split(name, "/")[0]


def is_e2e(c: Column) -> Column:
    return c.rlike(r"/(?:e2e|integration)[/.]")


def go_tests(ids: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(F.filter(ids, lambda t: ~is_e2e(t)), go_test_name)))


def distinct_tests(ids: Column) -> Column:
    return F.array_sort(F.array_distinct(ids))


def decoded_list(c: Column) -> Column:
    """A JSON list held in a string; empty if absent or malformed."""
    return F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>"))


def python_version(c: Column) -> Column:
    return F.coalesce(first_of(F.regexp_extract(F.trim(c), r"^(\d+\.\d+)", 1)), F.trim(c))


def major_minor(c: Column) -> Column:
    return first_of(F.regexp_extract(F.regexp_replace(F.trim(c), "^v", ""), r"^(\d+\.\d+)", 1))


def clamp_version(c: Column, least: tuple[int, int] = (3, 9), default: str = "3.11") -> Column:
    major = F.regexp_extract(c, r"^(\d+)\.(\d+)", 1).try_cast("int")
    minor = F.regexp_extract(c, r"^(\d+)\.(\d+)", 2).try_cast("int")
    fine = (major > least[0]) | ((major == least[0]) & (minor >= least[1]))
    return F.when(fine, c).otherwise(F.lit(default))


def squeezed(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), r"\s+", " ")


def install_command(c: Column) -> Column:
    return F.replace(F.replace(squeezed(c), F.lit("pip install"), F.lit("python -m pip install")), F.lit("python -m python -m"), F.lit("python -m"))


def test_runner(c: Column) -> Column:
    t = F.trim(c)
    known = reduce(lambda out, name: F.when(t.contains(name), F.lit(name)).otherwise(out), ("unittest", "tox", "pytest"), first_of(F.split(t, r"\s+")[0]))
    return F.when(c.isNotNull(), known)


def package_names(c: Column) -> Column:
    names = F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda p: F.replace(F.lower(F.split(F.trim(p), "[=<>!~]")[0]), F.lit("-"), F.lit("_")))
    return F.array_sort(F.array_distinct(F.filter(names, lambda n: n != "")))


def last_block(c: Column, tag: str) -> Column:
    """Text of the last <tag>...</tag>; null without one."""
    return F.when(c.contains(f"<{tag}>"), F.trim(F.substring_index(F.substring_index(c, f"<{tag}>", -1), f"</{tag}>", 1)))


def judge_verdict(c: Column) -> Column:
    """(classification, confidence, reasoning), UNKNOWN where the tags are missing."""
    tag = lambda name: first_of(F.trim(F.regexp_extract(c, rf"(?s)<{name}>(.*?)</{name}>", 1)))
    return F.struct(
        F.upper(F.coalesce(tag("classification"), F.lit("UNKNOWN"))).alias("classification"),
        F.upper(F.coalesce(tag("confidence"), F.lit("UNKNOWN"))).alias("confidence"),
        F.coalesce(tag("reasoning"), F.lit("")).alias("reasoning"),
    )


def repeated_blocks(c: Column, tags: tuple[str, ...]) -> Column:
    """An array of structs, one field a tag, for blocks that repeat."""
    parts = [F.regexp_extract_all(c, F.lit(rf"(?s)<{t}>(.*?)</{t}>"), F.lit(1)).alias(t) for t in tags]
    return F.transform(F.arrays_zip(*parts), lambda p: F.struct(*[F.trim(p[t]).alias(t) for t in tags]))


def failed_names(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"FAILED (\S+::\S+)"), F.lit(1)))


#: How tools name a failing test.
FAILURE_LINES = (r"FAILED\s+(\S+::(?:\S+::)?\S+)", r"(?m)^---\s+FAIL:\s+(\S+/\S+)", r"(?m)^---\s+FAIL:\s+(\S+)", r"(?m)^FAIL\s+(\S+)", r"(?m)^test\s+(\S+)\s+\.\.\.\s+FAILED", r"<<<\s+(?:FAILURE|ERROR)!\s+-\s+in\s+(\S+)")


def first_failure(c: Column) -> Column:
    """The first failing test by the lines of several tools, in this order; a subtest before its parent."""
    return first_of(*[F.regexp_extract(c, p, 1) for p in FAILURE_LINES])


def code_block(c: Column) -> Column:
    return first_of(F.regexp_extract(c, r"(?s)```[^\n]*\n(.*?)```", 1))


def narrative(c: Column) -> Column:
    """Prose in lower case, fenced code left out."""
    return F.lower(F.regexp_replace(c, r"(?s)```.*?```", ""))


def without_shas(c: Column) -> Column:
    return F.regexp_replace(c, r"\b[0-9a-f]{7,40}\b", "")


def rewritten(c: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """Regular-expression rules applied in order, as a redaction rule set needs."""
    return reduce(lambda out, rule: F.regexp_replace(out, rule[0], rule[1]), rules, c)


def without_lines(c: Column, pattern: str) -> Column:
    return F.array_join(F.filter(F.split(c, "\n", -1), lambda x: ~x.rlike(pattern)), "\n")


def first_line(c: Column, most: int = 120) -> Column:
    lines = F.filter(F.split(blank(c), "\n"), lambda x: F.trim(x) != "")
    return F.substring(F.coalesce(F.get(F.transform(lines, lambda x: F.trim(x)), F.lit(0)), F.lit("")), 1, most)


def slug(c: Column, most: int = 50) -> Column:
    return F.rtrim(F.substring(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), 1, most), F.lit("-"))


def repo_slug(c: Column) -> Column:
    return F.replace(c, F.lit("/"), F.lit("__"))


def instance_id(repo: Column, number: Column) -> Column:
    return F.concat(repo_slug(repo), F.lit("-"), number.cast("string"))


def number_of_id(c: Column) -> Column:
    return F.regexp_extract(c, r"-(\d+)$", 1).try_cast("bigint")


def short_hash(c: Column, digits: int = 12) -> Column:
    return F.substring(F.sha2(c.cast("binary"), 256), 1, digits)


def synthetic_number(c: Column) -> Column:
    """90000 and up to 9999 more, from a hash: ids of it may collide, patches don't."""
    return F.lit(90000) + F.pmod(F.conv(F.substring(F.sha2(c.cast("binary"), 256), 1, 8), 16, 10).cast("bigint"), F.lit(10000))


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds, rounded to one place, between ISO or spaced times; null if either can't be read."""
    formats = ("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]", "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]", "yyyy-MM-dd")
    time = lambda c: F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])
    return F.round((F.unix_micros(time(end)) - F.unix_micros(time(start))) / 1e6, 1)


def module_name(path: Column) -> Column:
    return F.replace(F.regexp_replace(F.regexp_replace(path, r"\.py$", ""), r"/__init__$", ""), F.lit("/"), F.lit("."))


def templated(c: Column, values: dict[str, Column]) -> Column:
    """$name and ${name} replaced; others stay."""
    out = c
    for name in sorted(values, key=len, reverse=True):
        out = F.replace(F.replace(out, F.lit(f"${{{name}}}"), values[name]), F.lit(f"${name}"), values[name])
    return out


def identifier_like(c: Column) -> Column:
    return c.contains("_") | c.rlike("[a-z][A-Z]") | c.rlike("^[A-Z0-9]{2,}$")


def indented_as(changed: Column, original: Column) -> Column:
    """The changed code moved so that its first line with text stands as far in as the original's; blank lines become empty (C-46)."""
    lines = F.split(F.regexp_replace(blank(changed), r"\r?\n\z", ""), r"\r\n|\r|\n")
    depth = lambda c: F.length(F.regexp_extract(c, r"^(?:\s*\n)?([^\S\n]*)\S", 1))
    more = depth(blank(original)) - depth(blank(changed))
    empty = lambda c: blank(c).rlike(r"^\s*$")
    moved = lambda x: F.when(empty(x), "").when(more > 0, F.concat(F.repeat(F.lit(" "), more), x)).otherwise(F.substring(x, F.least(-more, F.length(F.regexp_extract(x, r"^(\s*)", 1))) + 1, F.length(x)))
    return F.when((more == 0) | empty(original) | empty(changed), blank(changed)).otherwise(F.array_join(F.transform(lines, moved), "\n"))
