"""Assertions, breaking changes and blank lines against worked examples."""

from pyspark.sql import functions as F

from auditloom.functions import assertions as A


def got(spark, make, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} {'array<string>' if isinstance(v, list) else 'string'}" for i, v in enumerate(values)))
    return df.select(make(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first()["x"]


PYTHON = {
    "self.assertEqual(len(a), 3)": ("equality", "len(a)", "3", "len"), "self.assertAlmostEqual(f(x), g(y))": ("equality", "f(x)", "g(y)", "f"), "self.assertRaises(ValueError, m.parse, 1)": ("raises", "m.parse", "ValueError", "parse"),
    "self.assertIn(1, h.get(k))": ("in", "h.get(k)", "1", "get"), "self.assertTrue(o.run(len(x)))": ("truthy", "o.run(len(x))", "True", "run"), "self.assertFalse(b)": ("falsy", "b", "False", None),
    "self.assertIsNone(f())": ("is_none", "f()", "None", "f"), "self.assertIsNotNone(f())": ("not_none", "f()", "not None", "f"), "assert f(1) == 2": ("equality", "f(1)", "2", "f"), "assert a != b": ("inequality", "a", "b", None),
    "assert f(a) is None": ("is_none", "f(a)", "None", "f"), "assert a is not None": ("not_none", "a", "not None", None), "assert 3 in f(a)": ("in", "f(a)", "3", "f"), "assert not f()": ("falsy", "f()", "False", "f"),
    "\tassert ok(x)": ("truthy", "ok(x)", "True", "ok"), "assert a not in b": None, 'assert g("a, b == c", [1, 2]) == h(3, 4), f"x, {y}"': ("equality", 'g("a, b == c", [1, 2])', "h(3, 4)", "g"), "self.assertEqual(f({1: [2, 3]}), (4, 5), 'why, so')": ("equality", "f({1: [2, 3]})", "(4, 5)", "f"),
    "assert all(x in y for x in z)": ("truthy", "all(x in y for x in z)", "True", "all"), "self.assertRaises(E)": None, "self.assertFoo(f(x))": None, "assert island(x) is  not None": ("not_none", "island(x)", "not None", "island"), "assert": None, "assert a is b": None, "# raises": None,
}


def test_python_forms(spark):
    rows = spark.createDataFrame([(s,) for s in PYTHON], "s string").select("s", A.python_assertions(F.col("s")).alias("x")).collect()
    for r in rows:
        want = PYTHON[r["s"]]
        assert [tuple(a) for a in r["x"]] == ([(*want, 1)] if want else []), r["s"]


def test_python_block_and_languages(spark):
    source = "import pytest\nwith pytest.raises(KeyError) as e:\n    # call(x)\n\n    store.fetch(len(k))\nassert a == 1\n"
    want = [("raises", "", "KeyError", "fetch", 2), ("equality", "a", "1", None, 6)]
    assert [tuple(a) for a in got(spark, A.python_assertions, source)] == want
    assert got(spark, A.assertions, source, "rust") == [] and got(spark, A.assertions, None, "python") == [] and got(spark, A.assertions, "", "go") == []
    assert [tuple(a) for a in got(spark, A.assertions, source, "python")] == want


GO = [
    ("if got := family(m); got != want {", [("equality", "family(m)", "want", "family", 1)]), ("if x := f(1); x == 2 {", [("inequality", "f(1)", "2", "f", 1)]),
    ('\tassert.Equal(t, 4, Sum(2, 2), "sum")', [("equality", "Sum(2, 2)", "4", "Sum", 1)]), ("require.NoError(t, Open(p))", [("error_check", "Open(p)", "nil", "Open", 1)]), ("assert.Truef(t, ok(x))", [("truthy", "ok(x)", "true", "ok", 1)]),
    ("assert.False(t, len(x))", [("falsy", "len(x)", "false", "len", 1)]), ("assert.NotNil(t, New2())", [("not_nil", "New2()", "not nil", "New2", 1)]), ("require.Error(t, Do())", [("error_check", "Do()", "error", "Do", 1)]),
    ("a, err := pkg.Load(x)\n\nif err != nil {", [("error_check", "pkg.Load(x)", "nil", "Load", 3)]), ("a := f(x)\nb\nc\nd\nif a != b {", []), ("got := Run2(x)\nif got != want {", [("equality", "Run2(x)", "", "Run2", 2)]),
    ("if Find(n) == nil {", [("nil_check", "Find(n)", "nil", "Find", 1)]), ("if x != nil {", []),
    ('if got := F(1); got != 2 {\n\tt.Errorf("F(1) = %v", got)\n}\nt.Fatal("G() bad")', [("equality", "F(1)", "2", "F", 1), ("equality", "", "", "G", 4)]), ('t.Error("Sprintf(")', []), (None, []),
]


def test_go_forms(spark):
    rows = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(GO)], "i int, s string").select("i", A.go_assertions(F.col("s")).alias("x")).collect()
    for r in rows:
        source, want = GO[r["i"]]
        found = [tuple(a) for a in r["x"]]
        assert found == want, source


F_SOURCE = "def f(a, b):\n    if a < 0:\n        raise ValueError('a')\n    c = a * b\n    return c + 1"


CHANGES = [
    (A.swapped_operator, (F_SOURCE,), ("    return c + 1", "    return c - 1")), (A.swapped_operator, ("x = a // b",), ("x = a // b", "x = a % b")), (A.swapped_operator, ("# a + b\nreturn x",), None), (A.swapped_operator, (None,), None),
    (A.removed_raise, (F_SOURCE, "ValueError"), ("    if a < 0:", "    if not a < 0:")), (A.removed_raise, ("if x is not y:\n  raise E()", ""), ("if x is not y:", "if x is y:")), (A.removed_raise, ("x\n  raise E()", None), ("  raise E()", "  pass")), (A.removed_raise, (F_SOURCE, "KeyError"), None),
    (A.returned_none, ("\treturn a\n\treturn b\n\treturn None",), ("\treturn b", "\treturn None")), (A.returned_some, ("  return\nreturn None\nreturn 1",), ("return None", "return 0")), (A.returned_some, ("return 1",), None),
    (A.breaking_change, (F_SOURCE, "raises", "ValueError", "python"), ("    if a < 0:", "    if not a < 0:")), (A.breaking_change, (F_SOURCE, "not_none", "", "python"), ("    return c + 1", "    return None")),
    (A.breaking_change, (F_SOURCE, "is_none", "", "go"), ("    return c + 1", "    return c - 1")), (A.breaking_change, (F_SOURCE, "equality", "", "rust"), None),
    (A.normal_whitespace, ("import a  \n\n\n\n\nx = 1\n\n\ndef f():\n\n\n\n  y\n\n", "a\n\ndef g():\n  b\n\ndef h():\n  c\n\n\nclass K:"), "import a\n\nx = 1\n\ndef f():\n\n  y\n"), (A.normal_whitespace, (None, None), "\n"), (A.normal_whitespace, ("a\n\ndef f():", ""), "a\n\n\ndef f():\n"),
]


def test_changes_and_whitespace(spark):
    for make in dict.fromkeys(m for m, _, _ in CHANGES):
        cases = [(v, w) for m, v, w in CHANGES if m is make]
        width = len(cases[0][0])
        df = spark.createDataFrame([(i, *v) for i, (v, _) in enumerate(cases)], ", ".join(["i int", *[f"c{k} string" for k in range(width)]]))
        for r in df.select("i", make(*[F.col(f"c{k}") for k in range(width)]).alias("x")).collect():
            assert (tuple(r["x"]) if isinstance(r["x"], tuple) else r["x"]) == cases[r["i"]][1], (make.__name__, cases[r["i"]])


def test_repo_context(spark):
    names = ("pyproject.toml", "setup.cfg", "setup.py", "go.mod", "Cargo.toml", "pom.xml")

    def context(inits=(), log="", **texts):
        texts = {k.replace("_", "."): v for k, v in texts.items()}
        row = spark.createDataFrame([tuple(texts.get(n) for n in names) + (list(inits), log)], ", ".join(f"`{n}` string" for n in names) + ", inits array<string>, log string")
        return tuple(row.select(A.repo_context({n: F.col(f"`{n}`") for n in names}, F.col("inits"), F.col("log")).alias("x")).first()["x"])

    assert context(pyproject_toml='version = "1.2"\n', setup_py='python_requires=">=3.1"', log="a (#3) #12\n#3") == ("1.2", "", ["#3", "#12"])
    assert context(pyproject_toml="python_requires = '>=3.8'", setup_cfg="version = 2.0\n", inits=['__version__ = "9"']) == ("2.0", ">=3.8", [])
    assert context(inits=["", "__version__ = '9'"], go_mod="module x\n\ngo 1.21\n") == ("9", "Go 1.21", [])
    assert context(Cargo_toml="[package]") == ("", "Rust stable", []) and context(pom_xml="<java.version>17</java.version>") == ("", "Java 17", []) and context(log=None) == ("", "", [])
