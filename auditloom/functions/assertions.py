"""Column expressions over test and function sources: assertions, the change that breaks one, blank lines.

Sources are split into lines and only lines that can hold an assertion are parsed; all is built of
higher-order functions, so no source leaves the JVM. Null sources count as empty.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from auditloom.functions.text import blank

#: Calls that aren't what a test is about.
PYTHON_BUILTINS = (
    "len", "str", "int", "float", "list", "dict", "set", "tuple", "type", "isinstance", "issubclass", "print", "range", "sorted", "reversed", "enumerate", "zip", "map",
    "filter", "any", "all", "min", "max", "sum", "abs", "round", "repr", "bool", "bytes", "ord", "chr", "hex", "oct", "bin", "hash", "id", "format",
)
GO_BUILTINS = (
    "make", "len", "cap", "append", "copy", "close", "delete", "new", "panic", "recover", "print", "println", "string", "int", "int32", "int64", "float32", "float64", "byte",
    "Errorf", "Fatalf", "Error", "Fatal", "Logf", "Log", "Run", "Cleanup", "Helper", "Skip", "Skipf", "Sprintf", "Printf", "Fprintf",
    "Equal", "NotEqual", "True", "False", "Nil", "NotNil", "NoError", "Equalf", "NoErrorf", "Truef", "Falsef", "Nilf", "NotNilf", "Contains",
)
GO_MESSAGE_CALLS = ("Error", "Errorf", "Fatal", "Fatalf", "Sprintf", "Printf", "Fprintf")

#: What methods assert. (type, expression, expected): a number is an argument's place, a word stands for itself.
PYTHON_METHODS = {
    "Equal": ("equality", 0, 1), "Equals": ("equality", 0, 1), "AlmostEqual": ("equality", 0, 1), "Raises": ("raises", 1, 0), "In": ("in", 1, 0),
    "True": ("truthy", 0, "True"), "False": ("falsy", 0, "False"), "IsNone": ("is_none", 0, "None"), "IsNotNone": ("not_none", 0, "not None"),
}
GO_METHODS = {
    "Equal": ("equality", 2, 1), "NoError": ("error_check", 1, "nil"), "Error": ("error_check", 1, "error"), "True": ("truthy", 1, "true"), "False": ("falsy", 1, "false"),
    "Nil": ("nil_check", 1, "nil"), "NotNil": ("not_nil", 1, "not nil"),
}
#: Text with brackets in balance, up to five deep: strings, groups and what an argument is made of.
_STRING = r"""\"(?:[^"\\]|\\.)*+\"|'(?:[^'\\]|\\.)*+'|`[^`]*+`"""
_PLAIN = r"""[^()\[\]{}"'`]++"""


def _group(depth: int) -> str:
    inner = f"|{_group(depth - 1)}" if depth > 1 else ""
    return rf"[(\[{{](?:{_PLAIN}|{_STRING}{inner})*+[)\]}}]"


_GROUP = _group(5)
_ARGUMENT = rf"""(?:[^,()\[\]{{}}"'`]++|{_STRING}|{_GROUP})++"""
_OPERATOR = r"==|!=|\s(?:is\s+not|is|not\s+in|in)\s"
_TOKEN = rf"(?s){_STRING}|{_GROUP}|{_OPERATOR}|\w+|."
#: Operators that a small mistake exchanges, in the order they are tried.
SWAPS = (
    (" + ", " - "), (" - ", " + "), (" * ", " + "), (" // ", " % "), (" >= ", " > "), (" <= ", " < "), (" > ", " >= "), (" < ", " <= "),
    (" == ", " != "), (" != ", " == "), (" and ", " or "), (" or ", " and "),
)
NOT_COMPUTED = ("def ", "@", "#", '"""', "'''", "class ", "return ")
BY_VALUE = ("equality", "inequality", "truthy", "falsy", "in", "error_check", "nil_check", "not_nil")

FOUND = "array<struct<type:string,expression:string,expected:string,called_function:string,line:int>>"


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _some(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _lines(source: Column) -> Column:
    return F.split(blank(source), r"\r\n|\r|\n")


def called(c: Column, builtins: tuple[str, ...] = PYTHON_BUILTINS) -> Column:
    """The last name of the first call that is no builtin, else of the first call; null without a call (C-41)."""
    calls = F.regexp_extract_all(c, F.lit(r"(?:[\w.]+\.)?(\w+)\s*\("), F.lit(1))
    return F.coalesce(F.get(F.filter(calls, lambda n: ~n.isin(*builtins)), F.lit(0)), F.get(calls, F.lit(0)))


def arguments(inner: Column) -> Column:
    """What stands between the commas of an argument list; commas in brackets and strings separate nothing."""
    return F.transform(F.regexp_extract_all(inner, F.lit(_ARGUMENT), F.lit(0)), _strip)


def _bound(value: Column, use) -> Column:
    """use(value) with value computed once: a lambda's body is evaluated anew wherever it stands."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def comparison(condition: Column) -> Column:
    """(left, operator, right) by the first operator outside of brackets and strings; operator and right are null without one."""

    def cut(x: Column) -> Column:
        tokens, at = x["tokens"], x["at"]
        text = lambda xs: _strip(F.array_join(xs, ""))
        left = F.when(at > 0, F.slice(tokens, F.lit(1), F.greatest(at - 1, F.lit(0)))).otherwise(tokens)
        operator = F.when(at > 0, F.regexp_replace(_strip(F.get(tokens, at - 1)), r"\s+", " "))
        return F.struct(text(left).alias("left"), operator.alias("operator"), F.when(at > 0, text(F.slice(tokens, at + 1, F.size(tokens)))).alias("right"))

    place = lambda tokens: F.coalesce(F.array_position(F.transform(tokens, lambda t: t.rlike(rf"^(?:{_OPERATOR})$")), True), F.lit(0)).cast("int")
    tokens = F.regexp_extract_all(condition, F.lit(_TOKEN), F.lit(0))
    return _bound(_bound(tokens, lambda t: F.struct(t.alias("tokens"), place(t).alias("at"))), cut)


def _asserted(kind: str | Column, expression: Column, expected: str | Column) -> Column:
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.struct(lit(kind).alias("type"), expression.alias("expression"), lit(expected).alias("expected"))


def _by_method(name: Column, inner: Column, methods: dict[str, tuple]) -> Column:
    """What a call of one of the methods with such arguments asserts; null for other methods and where an argument lacks."""

    def read(args: Column) -> Column:
        arg = lambda x: F.get(args, F.lit(x)) if isinstance(x, int) else F.lit(x)
        enough = lambda m: F.size(args) > max(x for x in m if isinstance(x, int))
        return F.coalesce(*[F.when((name == n) & enough(m), _asserted(m[0], arg(m[1]), arg(m[2]))) for n, m in methods.items()])

    return F.when(name.isin(*methods), _bound(arguments(inner), read))


def _found(a: Column, called_function: Column, at: Column) -> Column:
    return F.struct(a["type"].alias("type"), a["expression"].alias("expression"), a["expected"].alias("expected"), called_function.alias("called_function"), (at + 1).cast("int").alias("line"))


def _candidates(lines: Column, may: str) -> Column:
    """(at, text) of the lines that can hold an assertion."""
    return F.filter(F.transform(lines, lambda x, i: F.struct(i.alias("at"), _strip(x).alias("text"))), lambda x: x["text"].rlike(may))


def _stated(condition: Column) -> Column:
    """What a Python assert statement asserts: its comparison, else that its condition holds or doesn't."""

    def by(c: Column) -> Column:
        left, op, right = c["left"], c["operator"], c["right"]
        compared = F.when(op == "==", _asserted("equality", left, right)).when(op == "!=", _asserted("inequality", left, right)).when(op == "in", _asserted("in", right, left))
        compared = compared.when((op == "is") & (right == "None"), _asserted("is_none", left, "None")).when((op == "is not") & (right == "None"), _asserted("not_none", left, "not None"))
        negated = F.regexp_extract(left, r"(?s)^not\s+(.+)$", 1)
        bare = F.when(negated != "", _asserted("falsy", negated, "False")).when(left != "", _asserted("truthy", left, "True"))
        return F.when(op.isNotNull(), compared).otherwise(bare)

    return _bound(comparison(condition), by)


def python_assertions(source: Column) -> Column:
    """(type, expression, expected, called_function, line) of a Python test's assertions in order (C-39).

    Calls of unittest's methods, assert statements (without their message) and pytest.raises, whose call is sought in the
    four lines after it, comments left out. What spans several lines isn't read.
    """
    return _bound(_lines(source), _python_found)


def _python_found(lines: Column) -> Column:
    def read(x: Column) -> Column:
        text = x["text"]
        unittest = r"^self\.assert(\w+)\s*\((.*)\)$"
        of_method = F.when(text.rlike(unittest), _by_method(F.regexp_extract(text, unittest, 1), F.regexp_extract(text, unittest, 2), PYTHON_METHODS))
        statement = F.when(text.rlike(r"^assert\s"), _stated(F.get(arguments(F.regexp_extract(text, r"^assert\s+(.*)$", 1)), F.lit(0))))
        error = _some(F.regexp_extract(text, r"^with\s+pytest\.raises\s*\(\s*(\w+)", 1))
        block = F.when(error.isNotNull(), _asserted("raises", F.lit(""), error))
        return F.struct(x["at"].alias("at"), F.coalesce(of_method, statement, block).alias("a"), of_method.isNotNull().alias("method"))

    def with_call(x: Column) -> Column:
        a = x["a"]
        after = F.filter(F.transform(F.slice(lines, x["at"] + 2, F.lit(4)), _strip), lambda y: ~y.startswith("#"))
        in_block = F.get(F.filter(F.transform(after, lambda y: called(y)), lambda n: n.isNotNull()), F.lit(0))
        raised = F.when(a["expression"] == "", in_block).otherwise(F.regexp_extract(a["expression"], r"(\w*)$", 1))
        other = F.coalesce(called(a["expression"]), F.when(x["method"] & (a["type"] == "equality"), called(a["expected"])))
        return _found(a, F.when(a["type"] == "raises", raised).otherwise(other), x["at"])

    return F.transform(F.filter(F.transform(_candidates(lines, "assert|Assert|raises"), read), lambda x: x["a"].isNotNull()), with_call)


def go_assertions(source: Column) -> Column:
    """The same of a Go test (C-40): calls of assert and require, conditions of if statements, and failure messages.

    A condition with a value of its own (``if got := f(); got != want``) asserts that value; one over two names, or an
    error that isn't nil, asserts the call assigned in the three lines before, the earliest first; one between a call and
    nil asserts the call. A message that names a function counts unless the line before asserts that function.
    """
    return _bound(_lines(source), _go_found)


def _go_found(lines: Column) -> Column:
    go = lambda c: called(c, GO_BUILTINS)

    def assigned(at: Column, names: str) -> Column:
        """The first call that one of the three lines before assigns to such names; null if none."""
        before = F.transform(F.slice(lines, F.greatest(at - 2, F.lit(1)), F.least(at, F.lit(3))), _strip)
        return F.get(F.filter(F.transform(before, lambda y: F.regexp_extract(y, rf"^{names}\s*:=\s*(.+)", 1)), lambda y: go(y).isNotNull()), F.lit(0))

    def conditional(text: Column, at: Column) -> Column:
        shape = r"^if\s+(?:\w+\s*:=\s*(.+?)\s*;\s*)?([^;]+?)\s*\{"
        value = F.regexp_extract(text, shape, 1)

        def by(c: Column) -> Column:
            left, op, right = c["left"], c["operator"], c["right"]
            of_value = F.when(op == "!=", _asserted("equality", value, right)).when(op == "==", _asserted("inequality", value, right))
            failed, result = assigned(at, r"[\w,\s]+"), assigned(at, r"\w+")
            of_error = F.when(failed.isNotNull(), _asserted("error_check", failed, "nil"))
            of_names = F.when(result.isNotNull(), _asserted("equality", result, ""))
            of_nil = F.when(go(left).isNotNull(), F.when(op == "==", _asserted("nil_check", left, "nil")).when(op == "!=", _asserted("not_nil", left, "not nil")))
            names = (op == "!=") & left.rlike(r"^\w+$") & right.rlike(r"^\w+$")
            return F.when(value != "", of_value).when(names & (left == "err") & (right == "nil"), of_error).when(names, of_names).when(right == "nil", of_nil)

        return F.when(text.rlike(shape), _bound(comparison(F.regexp_extract(text, shape, 2)), by))

    def read(x: Column) -> Column:
        text = x["text"]
        testify = r"^(?:assert|require)\.(\w+?)f?\s*\((.*)\)$"
        of_method = F.when(text.rlike(testify), _by_method(F.regexp_extract(text, testify, 1), F.regexp_extract(text, testify, 2), GO_METHODS))
        names = F.when(text.rlike(r"^t\.(?:Error|Fatal)f?\s*\("), _some(F.regexp_extract(text, r'"(\w+)\(', 1)))
        a = F.coalesce(of_method, conditional(text, x["at"]))
        call = F.coalesce(go(a["expression"]), F.when(of_method.isNotNull() & (a["type"] == "equality"), go(a["expected"])))
        return F.struct(x["at"].alias("at"), a.alias("a"), call.alias("call"), F.when(~names.isin(*GO_MESSAGE_CALLS), names).alias("names"))

    def given(every: Column) -> Column:
        """What each line asserts, then what its message names."""

        def one(x: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get(every, i - 1))
            known = F.coalesce((before["at"] == x["at"] - 1) & before["a"].isNotNull() & (before["call"] == x["names"]), F.lit(False))
            own = F.when(x["a"].isNotNull(), _found(x["a"], x["call"], x["at"]))
            told = F.when(x["names"].isNotNull() & ~known, _found(_asserted("equality", F.lit(""), ""), x["names"], x["at"]))
            return F.filter(F.array(own, told), lambda a: a.isNotNull())

        return F.flatten(F.transform(every, one))

    return _bound(F.transform(_candidates(lines, r"^(?:if\s|assert\.|require\.|t\.)"), read), given)


def assertions(source: Column, language: Column) -> Column:
    """Assertions of a source by its language; none for others (C-40b)."""
    return F.when(language == "go", go_assertions(source)).when(language == "python", python_assertions(source)).otherwise(F.from_json(F.lit("[]"), FOUND))


def _exchanged(line: Column, old: str, new: str) -> Column:
    """The line with the first occurrence exchanged; null without one."""
    at = F.instr(line, old)
    return F.when(at > 0, F.concat(F.substring(line, F.lit(1), at - 1), F.lit(new), F.substring(line, at + len(old), F.length(line))))


def _change(line: Column, changed: Column) -> Column:
    return F.when(line.isNotNull() & changed.isNotNull(), F.struct(line.alias("original"), changed.alias("mutated")))


def _indented(line: Column, words: str) -> Column:
    return F.concat(F.regexp_extract(line, r"^(\s*)", 1), F.lit(words))


def swapped_operator(source: Column) -> Column:
    """(original, mutated): the first line that returns, else computes, with its first listed operator exchanged (C-42); null without one."""
    swap = lambda line: F.coalesce(*[_exchanged(line, a, b) for a, b in SWAPS])
    lines = F.filter(_lines(source), lambda x: swap(x).isNotNull())
    returns = F.filter(lines, lambda x: _strip(x).startswith("return "))
    computes = F.filter(lines, lambda x: reduce(lambda ok, p: ok & ~_strip(x).startswith(p), NOT_COMPUTED, _strip(x) != ""))
    line = F.coalesce(F.get(returns, F.lit(0)), F.get(computes, F.lit(0)))
    return _change(line, swap(line))


def removed_raise(source: Column, error: Column) -> Column:
    """(original, mutated): the first raise of the error: the condition before it inverted, else the raise passed over (C-42b)."""
    lines = _lines(source)
    at = F.get(F.filter(F.transform(lines, lambda x, i: F.when(_strip(x).startswith("raise ") & _strip(x).contains(blank(error)), i)), lambda i: i.isNotNull()), F.lit(0))
    line, guard = F.get(lines, at), F.get(lines, at - 1)
    guarded = (at > 0) & _strip(guard).startswith("if ")
    inverted = F.when(_strip(guard).contains(" not "), _exchanged(guard, " not ", " ")).otherwise(_exchanged(guard, "if ", "if not "))
    return F.when(guarded, _change(guard, inverted)).otherwise(_change(line, _indented(line, "pass")))


def returned_none(source: Column) -> Column:
    """(original, mutated): the last return of something returns None (C-42b)."""
    line = F.try_element_at(F.filter(_lines(source), lambda x: _strip(x).startswith("return ") & (_strip(x) != "return None")), F.lit(-1))
    return _change(line, _indented(line, "return None"))


def returned_some(source: Column) -> Column:
    """(original, mutated): the last return of nothing returns 0 (C-42b)."""
    line = F.try_element_at(F.filter(_lines(source), lambda x: _strip(x).isin("return None", "return")), F.lit(-1))
    return _change(line, _indented(line, "return 0"))


def breaking_change(source: Column, kind: Column, expected: Column, language: Column) -> Column:
    """(original, mutated) that breaks an assertion of this type; null where none is found or the language has none (C-42b)."""
    by_kind = F.coalesce(
        F.when(kind == "raises", removed_raise(source, expected)),
        F.when(kind.isin(*BY_VALUE), swapped_operator(source)),
        F.when(kind.isin("is_none", "nil_check"), returned_some(source)).when(kind.isin("not_none", "not_nil"), returned_none(source)),
        swapped_operator(source),
    )
    return F.when(language.isin("python", "go"), by_kind)


def usual_separator(original: Column) -> Column:
    """The most frequent number of blank lines before a top-level definition, the one seen first of ties; 2 without any."""
    runs = F.regexp_extract_all(F.concat(F.lit("\n"), blank(original)), F.lit(r"\n((?:[^\S\n]*\n)+)(?=def |class |@)"), F.lit(1))
    sizes = F.transform(runs, lambda r: F.length(F.regexp_replace(r, r"[^\n]", "")))
    count = lambda n: F.size(F.filter(sizes, lambda m: m == n))
    return F.coalesce(F.array_max(F.transform(F.array_distinct(sizes), lambda n: F.struct(count(n).alias("n"), (-F.array_position(sizes, n)).alias("at"), n.alias("size"))))["size"], F.lit(2))


def normal_whitespace(generated: Column, original: Column) -> Column:
    """Generated code with the original's blank lines before definitions, no longer runs elsewhere, no spaces at ends of lines (C-63)."""
    gap = F.repeat(F.lit("\n"), usual_separator(original).cast("int") + 1)
    bare = F.regexp_replace(F.concat(F.lit("\n"), blank(generated)), r"[^\S\n]+(?=\n|$)", "")
    bare = F.regexp_replace(bare, r"\n+$", "")
    spaced = F.regexp_replace(bare, F.lit(r"\n{2,}(?=def |class |@)"), gap)
    spaced = F.regexp_replace(spaced, F.concat(F.lit(r"\n{"), (F.length(gap) + 1).cast("string"), F.lit(",}")), gap)
    return F.concat(F.regexp_replace(spaced, r"^\n", ""), F.lit("\n"))


def repo_context(files: dict[str, Column], inits: Column, log: Column) -> Column:
    """(version, lang_version, recent_issues) from a repository's files, null where absent (C-59).

    files: pyproject.toml, setup.cfg, setup.py, go.mod, Cargo.toml, pom.xml; inits: texts of package roots in order.
    A later Python file is read only while no version is found; one that is read says the language's version before an earlier one.
    """
    hit = lambda c, p: _some(F.regexp_extract(c, p, 1))
    quoted, plain = r"""version\s*=\s*["']([^"']+)["']""", r"version\s*=\s*(\S+)"
    version = lambda c: F.when(F.regexp_instr(c, F.lit(quoted)) == F.regexp_instr(c, F.lit(plain)), hit(c, quoted)).otherwise(hit(c, plain))
    names = ("pyproject.toml", "setup.cfg", "setup.py")
    versions = [version(files[n]) for n in names]
    needs = [F.when(F.coalesce(*versions[:k], F.lit(None)).isNull(), hit(files[n], r"""python_requires\s*=\s*["']([^"']+)["']""")) for k, n in enumerate(names)]
    of_init = F.get(F.filter(F.transform(inits, lambda c: hit(c, r"""__version__\s*=\s*["']([^"']+)["']""")), lambda v: v.isNotNull()), F.lit(0))
    cargo = F.when(files["Cargo.toml"].isNotNull(), F.coalesce(F.concat(F.lit("Rust "), hit(files["Cargo.toml"], r'rust-version\s*=\s*"([^"]+)"')), F.lit("Rust stable")))
    java = F.coalesce(hit(files["pom.xml"], r"<java\.version>([^<]+)</java\.version>"), hit(files["pom.xml"], r"<maven\.compiler\.source>([^<]+)</maven\.compiler\.source>"))
    language = F.coalesce(*reversed(needs), F.concat(F.lit("Go "), hit(files["go.mod"], r"(?m)^go\s+(\S+)")), cargo, F.concat(F.lit("Java "), java), F.lit(""))
    issues = F.slice(F.array_distinct(F.regexp_extract_all(blank(log), F.lit(r"(#\d+)"), F.lit(1))), 1, 5)
    return F.struct(F.coalesce(*versions, of_init, F.lit("")).alias("version"), language.alias("lang_version"), issues.alias("recent_issues"))
