"""The few functions that built-in expressions can't state, as Arrow-batched functions of whole columns."""

from __future__ import annotations

import ast
import difflib
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

FUNCTION = T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
REGION = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))

_BRACED = {"go": r"^func\s+(?:\([^)]*\)\s*)?(\w+)", "rust": r"^\s*(?:pub(?:\([^)]*\))?\s+)?(?:async\s+)?fn\s+(\w+)", "java": r"^\s*(?:public|private|protected)[\w<>\[\], ]*\s(\w+)\s*\([^;]*$"}


#: The attribute of a test module with what may stand before its opening brace.
_TEST_MODULE = re.compile(r"[^\S\n]*#\[cfg\(test\)\](?:\s|#\[[^\]]*\]|//[^\n]*\n)*(?:pub(?:\([^)]*\))?\s+)?mod\s+\w+\s*\{")


def _depths(text: str) -> list[tuple[int, int]]:
    """Greatest brace depth in each line and the depth after it; braces in strings, characters and comments don't count."""
    clean = re.sub(r'//[^\n]*|/\*.*?\*/|"(?:\\.|[^"\\\n])*"|`[^`]*`|\'(?:\\.|[^\'\\\n])\'', lambda m: "\n" * m[0].count("\n"), text, flags=re.S)
    depth, out = 0, []
    for line in clean.split("\n"):
        most = depth
        if "{" in line or "}" in line:
            for sign in re.findall("[{}]", line):
                depth += 1 if sign == "{" else -1
                most = max(most, depth)
        out.append((most, depth))
    return out


def _closed(depths: list[tuple[int, int]], at: int) -> int | None:
    """The line that closes what opens at the line or after it."""
    base = depths[at - 1][1] if at else 0
    opened = False
    for k in range(at, len(depths)):
        opened = opened or depths[k][0] > base
        if opened and depths[k][1] <= base:
            return k
    return None


def _functions(source: str | None, language: str | None) -> list[dict]:
    if not source:
        return []
    if language == "python":
        try:
            tree = ast.parse(source)
        except (SyntaxError, ValueError):
            return []
        found = [n for n in ast.walk(tree) if isinstance(n, ast.FunctionDef | ast.AsyncFunctionDef)]
        return [{"name": n.name, "start": n.lineno, "end": n.end_lineno} for n in sorted(found, key=lambda n: n.lineno)]
    if language not in _BRACED:
        return []
    depths, out = _depths(source), []
    for k, line in enumerate(source.split("\n")):
        if (m := re.match(_BRACED[language], line)) and (end := _closed(depths, k)) is not None:
            out.append({"name": m[1], "start": k + 1, "end": end + 1})
    return out


@F.pandas_udf(FUNCTION)
def functions_of(source: pd.Series, language: pd.Series) -> pd.Series:
    """(name, start, end) of a source's functions: by syntax tree for Python, by braces for Go, Rust and Java."""
    return pd.Series([_functions(s, x) for s, x in zip(source, language, strict=True)])


TEST = T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("source", T.StringType()), T.StructField("start_line", T.IntegerType()), T.StructField("end_line", T.IntegerType())]))
#: What marks a test where its name doesn't, how many lines may stand between the mark and the head, and the head with the name.
_TESTS = {
    "go": (None, 0, r"func\s+(?:\([^)]*\)\s*)?(Test\w*)\s*[(\[]"),
    "rust": (r"#\[test\]", 3, r"\s*(?:pub(?:\([^)]*\))?\s+)?(?:(?:async|unsafe|const)\s+)*fn\s+(\w+)"),
    "java": (r"@Test\b", 3, r"\s*(?:(?:public|private|protected|static|final|synchronized)\s+)*(?:<[^>]*>\s+)?[\w.]+(?:<[^()]*>)?(?:\[\])*\s+(\w+)\s*\("),
}


#: Rows whose tests are Python objects at once.
_HELD = 32


def _statements(tree: ast.AST) -> list[ast.AST]:
    """All statements of a tree, with what holds statements; expressions are left out."""
    out = [tree]
    for node in out:  # grows meanwhile
        for name in ("body", "orelse", "finalbody", "handlers", "cases"):
            if isinstance(below := getattr(node, name, None), list):
                out += below
    return out


def _spans(source: str | None, language: str | None) -> list[tuple[str, int, int]]:
    """(name, first line, end) of each test, in order."""
    lines = (source or "").split("\n")
    spans: list[tuple[str, int, int]] = []
    if language == "python":
        try:
            found = _statements(ast.parse(source or ""))
            spans = [(n.name, n.lineno - 1, n.end_lineno) for n in found if isinstance(n, ast.FunctionDef | ast.AsyncFunctionDef) and n.name.startswith("test_")]
        except (SyntaxError, ValueError):
            return []
    elif language in _TESTS:
        mark, gap, head = _TESTS[language]
        depths, done = _depths(source or ""), 0
        for k, line in enumerate(lines):
            if k >= done and (mark is None or re.search(mark, line)):
                heads = ((j, re.match(head, lines[j])) for j in range(k if mark is None else k + 1, min(k + gap + 1, len(lines))))
                if at := next(((j, m) for j, m in heads if m), None):
                    end = _closed(depths, at[0])
                    done = len(lines) if end is None else end + 1
                    spans.append((at[1][1], k, done))
    return sorted(spans, key=lambda s: s[1:])


def _listed(source: pa.Array, language: pa.Array, whole: bool) -> pa.Array:
    """The tests of each row as one list array; few rows at a time are Python objects."""
    done = []
    for at in range(0, max(len(source), 1), _HELD):
        ends, names, texts, starts, stops = [0], [], [], [], []
        for text, kind in zip(source.slice(at, _HELD).to_pylist(), language.slice(at, _HELD).to_pylist(), strict=True):
            lines = (text or "").split("\n") if whole else []
            for name, a, b in _spans(text, kind):
                names.append(name)
                starts.append(a)
                stops.append(b)
                if whole:
                    texts.append("\n".join(lines[a:b]) + ("\n" if b < len(lines) else ""))
            ends.append(len(names))
        columns = {"name": pa.array(names, pa.string())} | ({"source": pa.array(texts, pa.string())} if whole else {}) | {"start_line": pa.array(starts, pa.int32()), "end_line": pa.array(stops, pa.int32())}
        done.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(list(columns.values()), list(columns))))
    return pa.concat_arrays(done)


@F.arrow_udf(TEST)
def tests_of(source: pa.Array, language: pa.Array) -> pa.Array:
    """(name, source, start_line, end_line) of each test once, in order, lines from 0 and the end beyond the last (C-47).

    Python by syntax tree, none where it doesn't parse; Go by name; Rust and Java from the attribute or annotation on, up
    to three lines above the head. A test ends where its braces close, those in strings and comments aside; one that
    never closes takes the rest.
    """
    return _listed(source, language, True)


@F.arrow_udf(T.ArrayType(T.StructType([f for f in TEST.elementType.fields if f.name != "source"])))
def test_spans(source: pa.Array, language: pa.Array) -> pa.Array:
    """(name, start_line, end_line) of each test that tests_of() gives."""
    return _listed(source, language, False)


tests_of, test_spans = tests_of.asNondeterministic(), test_spans.asNondeterministic()  # so that a filter on tests isn't pushed below, which would look for them twice


@F.pandas_udf(REGION)
def rust_test_regions(source: pd.Series) -> pd.Series:
    """Line ranges of modules under #[cfg(test)], from the attribute to the brace that closes the module."""

    def regions(text: str | None) -> list[dict]:
        if "#[cfg(test)]" not in (text or ""):
            return []
        lines, depths = text.split("\n"), _depths(text)
        out = []
        for k, line in enumerate(lines):
            if "#[cfg(test)]" in line and _TEST_MODULE.match("\n".join(lines[k : k + 8])):
                end = _closed(depths, k)
                out.append({"start": k + 1, "end": (end if end is not None else len(lines) - 1) + 1})
        return out

    return source.map(regions)


@F.pandas_udf(T.BooleanType())
def parses(source: pd.Series) -> pd.Series:
    """Whether a Python source has a syntax tree."""

    def fine(s: str | None) -> bool:
        try:
            ast.parse(s or "")
        except (SyntaxError, ValueError):
            return False
        return True

    return source.map(fine)


@F.pandas_udf(T.BooleanType())
def equivalent(a: pd.Series, b: pd.Series, language: pd.Series) -> pd.Series:
    """Equal syntax trees (Python), or equal tokens without comments."""

    def form(s: str, kind: str) -> object:
        if kind == "python":
            try:
                return ast.dump(ast.parse(s))
            except (SyntaxError, ValueError):
                return s
        return re.findall(r"\w+|[^\w\s]", re.sub(r"//[^\n]*|/\*.*?\*/", "", s, flags=re.S))

    return pd.Series([form(x or "", k) == form(y or "", k) for x, y, k in zip(a, b, language, strict=True)])


@F.pandas_udf(T.StringType())
def unified_diff(before: pd.Series, after: pd.Series, path: pd.Series) -> pd.Series:
    """The diff of two texts, empty where they are equal."""
    out = []
    for x, y, p in zip(before, after, path, strict=True):
        body = "".join(difflib.unified_diff((x or "").splitlines(True), (y or "").splitlines(True), f"a/{p}", f"b/{p}")) if x != y else ""
        out.append(f"diff --git a/{p} b/{p}\n{body}" if body else "")
    return pd.Series(out)


unified_diff = unified_diff.asNondeterministic()  # so that a filter on diffs isn't pushed below them, which would make every diff twice


@F.pandas_udf(T.StringType())
def unchanged_kept(original: pd.Series, changed: pd.Series) -> pd.Series:
    """The changed code with every line that the original has too, white space at its ends aside, as the original has it (C-46)."""

    def kept(x: str | None, y: str | None) -> str:
        old, new = (x or "").splitlines(), (y or "").splitlines()
        same = difflib.SequenceMatcher(None, [line.strip() for line in old], [line.strip() for line in new])
        for block in same.get_matching_blocks():
            new[block.b : block.b + block.size] = old[block.a : block.a + block.size]
        return "\n".join(new)

    return pd.Series([kept(x, y) for x, y in zip(original, changed, strict=True)])


@F.pandas_udf(T.IntegerType())
def found_at(text: pd.Series, snippet: pd.Series) -> pd.Series:
    """Line at which the snippet stands, white space at line ends aside; else the most alike window, from 0.85 on; 0 if none."""

    def place(t: str | None, s: str | None) -> int:
        have, want = [x.strip() for x in (t or "").split("\n")], [x.strip() for x in (s or "").strip("\n").split("\n")]
        n, best = len(want), (0.0, 0)
        if not any(want):
            return 0
        for k in range(len(have) - n + 1):
            if have[k : k + n] == want:
                return k + 1
        for k in range(len(have) - n + 1):
            best = max(best, (difflib.SequenceMatcher(None, "\n".join(have[k : k + n]), "\n".join(want)).ratio(), k + 1), key=lambda b: (b[0], -b[1]))
        return best[1] if best[0] >= 0.85 else 0

    return pd.Series([place(t, s) for t, s in zip(text, snippet, strict=True)])


@F.pandas_udf(T.StringType())
def applied(source: pd.Series, patch: pd.Series, path: pd.Series) -> pd.Series:
    """The source with a patch's hunks for its path; null where their old lines aren't what the source has there.

    All hunks count by their places in the old file, so that a patch may name a file in several parts.
    """

    def changed(text: str | None, diff: str | None, name: str | None) -> str | None:
        lines, found = (text or "").split("\n"), []
        for section in re.split(r"\n(?=diff --git )", diff or ""):
            if section.startswith(f"diff --git a/{name} "):
                for m in re.finditer(r"(?m)^@@ -(\d+)(?:,(\d+))? \+\S+ @@.*\n((?:[ +\\-].*(?:\n|$)|\n(?!$))*)", section):
                    body = [x or " " for x in m[3].removesuffix("\n").split("\n")] if m[3] else []  # a bare line break is an empty line kept
                    found.append((int(m[1]), int(m[2] or 1), body))
        for start, count, body in sorted(found, reverse=True):
            at = start - 1 if count else start
            if [x[1:] for x in body if x[:1] in (" ", "-")] != lines[at : at + count]:
                return None
            lines[at : at + count] = [x[1:] for x in body if x[:1] in (" ", "+")]
        return "\n".join(lines)

    return pd.Series([changed(*x) for x in zip(source, patch, path, strict=True)])
