"""Queries over what is written: assertions, tests, imports, commands, statements, task records. The given tables' words make the sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditloom.functions import assertions, code, diff, messages
from auditloom.operators import assembly, collected, filters, specs, tasks
from auditloom.plans.common import Register
from auditloom.streaming import retries

register = Register()

_NAMES = "list_transform(string_split(lower(coalesce(text, '')), ' '), lambda w: 'f_' || regexp_replace(w, '[^a-z]', '', 'g'))"


def names(text: str = "text") -> Column:
    """A name for each word of a text."""
    return F.transform(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), " "), lambda w: F.concat(F.lit("f_"), F.regexp_replace(w, "[^a-z]", "")))


def turn_lines(read, forms: dict[int, str], n: int) -> DataFrame:
    """(conv_id, turn, source): line i of a turn's source is form i % n with the i-th word's name for {w} and i for {i}."""

    def line(w: Column, i: Column) -> Column:
        out = F.lit("")
        for k, form in forms.items():
            out = F.when(i % n == k, F.replace(F.replace(F.lit(form), F.lit("{w}"), w), F.lit("{i}"), i.cast("string"))).otherwise(out)
        return out

    return read("conversations").select("conv_id", "turn", F.array_join(F.transform(names(), line), "\n").alias("source"))


_PYTHON = {0: "    assert {w}({i}) == {i}, 'a, b'", 1: "self.assertIn('x, y', {w}([1, 2], {'a': (3, 4)}))", 2: "assert {w} is not None", 3: "v = {w}({i})", 4: "with pytest.raises(E{i}):", 5: "    {w}(len({i}))", 6: "assert not {w}.g_{w}(x)"}
_GO = {0: "x", 1: "y", 2: "v, err := p.{w}({i})", 3: "if err != nil {", 4: 'assert.Equal(t, []int{1, {i}}, {w}(a, "b, c"), "d, e")', 5: "if got := {w}({i}); got != want.A {", 6: "if {w}({i}) == nil {", 7: 't.Fatalf("{w}(%d) is bad", {i})'}


@register(f"""
WITH t AS (SELECT conv_id, turn, {_NAMES} AS names FROM conversations),
l AS (SELECT conv_id, turn, unnest(range(len(names))) AS i, names, len(names) AS n FROM t), w AS (SELECT *, names[i + 1] AS w, CAST(i AS VARCHAR) AS s FROM l),
p AS (
  SELECT 'python' AS language, conv_id, turn, i, CASE i % 7
    WHEN 0 THEN 'equality|' || w || '(' || s || ')|' || s || '|' || w
    WHEN 1 THEN 'in|' || w || '([1, 2], {{''a'': (3, 4)}})|''x, y''|' || w
    WHEN 2 THEN 'not_none|' || w || '|not None|'
    WHEN 4 THEN 'raises||E' || s || '|' || coalesce(CASE WHEN i + 1 < n THEN names[i + 2] END, '')
    WHEN 6 THEN 'falsy|' || w || '.g_' || w || '(x)|False|g_' || w END AS a FROM w
), g AS (
  SELECT 'go' AS language, conv_id, turn, i, CASE i % 8
    WHEN 3 THEN 'error_check|p.' || names[i] || '(' || CAST(i - 1 AS VARCHAR) || ')|nil|' || names[i]
    WHEN 4 THEN 'equality|' || w || '(a, "b, c")|[]int{{1, ' || s || '}}|' || w
    WHEN 5 THEN 'equality|' || w || '(' || s || ')|want.A|' || w
    WHEN 6 THEN 'nil_check|' || w || '(' || s || ')|nil|' || w
    WHEN 7 THEN CASE WHEN names[i] <> w THEN 'equality|||' || w END END AS a FROM w
)
SELECT language, conv_id, turn, CAST(count(*) AS INT) AS n, md5(string_agg(a || '|' || CAST(i + 1 AS VARCHAR), chr(10) ORDER BY i)) AS digest
FROM (SELECT * FROM p UNION ALL SELECT * FROM g) WHERE a IS NOT NULL GROUP BY ALL""")
def code_assertions(read):
    sources = turn_lines(read, _PYTHON, 7).withColumn("language", F.lit("python")).union(turn_lines(read, _GO, 8).withColumn("language", F.lit("go")))
    found = sources.select("language", "conv_id", "turn", assertions.assertions(F.col("source"), F.col("language")).alias("a")).where("size(a) > 0")
    part = lambda c: F.coalesce(c, F.lit(""))
    text = F.transform("a", lambda a: F.concat(a["type"], F.lit("|"), part(a["expression"]), F.lit("|"), part(a["expected"]), F.lit("|"), part(a["called_function"]), F.lit("|"), a["line"].cast("string")))
    return found.select("language", "conv_id", "turn", F.size("a").alias("n"), F.md5(F.array_join(text, "\n").cast("binary")).alias("digest"))


_TESTS = {
    "python": "def test_{w}{i}():\n    assert 1\n", "go": "func (s *S) Test_{w}{i}(t *testing.T) {\n\tif x { // }\n\t}\n}",
    "rust": "#[test]\nfn t_{w}{i}() {\n    a(\"}\");\n}", "java": "    @Test\n    public void t_{w}{i}() {\n    }",
}


@register(f"""
WITH t AS (SELECT conv_id, turn, {_NAMES} AS names FROM conversations), l AS (SELECT conv_id, turn, unnest(range(len(names))) AS i, names FROM t),
f(language, prefix, step, length) AS (VALUES ('python', 'test_', 3, 2), ('go', 'Test_', 4, 4), ('rust', 't_', 4, 4), ('java', 't_', 3, 3))
SELECT language, conv_id, turn, CAST(count(*) AS INT) AS n, md5(string_agg(prefix || names[i + 1] || i || ':' || (i * step) || '-' || (i * step + length), ' ' ORDER BY i)) AS digest FROM l, f GROUP BY ALL""")
def extracted_tests(read):
    every = None
    for language, form in _TESTS.items():
        part = turn_lines(read, {0: form}, 1).withColumn("language", F.lit(language))
        every = part if every is None else every.union(part)
    found = every.withColumn("t", code.test_spans("source", "language")).where("size(t) > 0")
    text = F.transform("t", lambda t: F.concat(t["name"], F.lit(":"), t["start_line"].cast("string"), F.lit("-"), t["end_line"].cast("string")))
    return found.select("language", "conv_id", "turn", F.size("t").alias("n"), F.md5(F.array_join(text, " ").cast("binary")).alias("digest"))


@register("""
WITH p AS (SELECT p_partkey, lower(p_type) AS a, string_split(p_name, ' ')[1] AS b, string_split(p_name, ' ')[2] AS c, p_size FROM part),
files AS (SELECT DISTINCT 'r' || (p_size % 3) AS repo, a, b, c FROM p), m AS (SELECT repo, a AS module FROM files UNION SELECT repo, a || '.' || b FROM files UNION SELECT repo, a || '.' || b || '.' || c FROM files),
s(module) AS (VALUES ('os'), ('os.path'), ('re')),
used AS (SELECT 'r' || ((p_size + 1) % 3) AS repo, p_partkey, unnest([a || '.' || b, a || '.' || b || '.' || c || '.gone', 'os.path', 're.gone', 'none.' || b]) AS module FROM p),
tried AS (SELECT u.*, unnest(list_transform(range(1, len(string_split(module, '.')) + 1), lambda n: array_to_string(string_split(module, '.')[1:n], '.'))) AS prefix FROM (SELECT DISTINCT * FROM used) u),
met AS (SELECT t.*, CASE WHEN EXISTS (SELECT 1 FROM m WHERE m.repo = t.repo AND m.module = t.prefix) OR EXISTS (SELECT 1 FROM s WHERE s.module = t.prefix) THEN prefix END AS hit FROM tried t)
SELECT repo, 'p' || p_partkey || '.py' AS path, module, arg_max(hit, length(hit)) AS prefix, coalesce(arg_max(hit, length(hit)) = module, false) AS resolved FROM met GROUP BY repo, p_partkey, module""")
def import_resolution(read):
    part = read("part")
    a, (b, c) = F.lower("p_type"), (F.get(F.split("p_name", " "), F.lit(k)) for k in range(2))
    repo = lambda more: F.concat(F.lit("r"), ((F.col("p_size") + more) % 3).cast("string")).alias("repo")
    modules = tasks.repo_modules(part.select(repo(0), F.concat_ws("/", a, b, F.concat(c, F.lit(".py"))).alias("path")))
    content = F.concat(F.lit("from "), a, F.lit("."), b, F.lit(" import x\nimport "), a, F.lit("."), b, F.lit("."), c, F.lit(".gone\n  import os.path\nfrom re.gone import y\nfrom . import z\nimport none."), b)
    sources = part.select(repo(1), F.concat(F.lit("p"), F.col("p_partkey").cast("string"), F.lit(".py")).alias("path"), content.alias("content"))
    standard = read("region").limit(1).select(F.explode(F.array(*[F.lit(m) for m in ("os", "os.path", "re")])).alias("module"))
    return filters.resolved_imports(sources, modules, standard)


@register("""
WITH p AS (SELECT p_brand, p_partkey, CASE WHEN p_size % 5 = 0 THEN '.' ELSE lower(p_type) END AS top, string_split(p_name, ' ')[1] AS mid, p_size FROM part),
q AS (SELECT p_brand, top, CASE WHEN top = '.' OR p_size % 2 = 0 THEN './...' ELSE './' || mid END AS package, min(p_partkey) AS first FROM p GROUP BY ALL),
c AS (SELECT p_brand, top, min(first) AS first, 'go test -v -count=1 ' || string_agg(package, ' ' ORDER BY first) AS run FROM q GROUP BY ALL)
SELECT p_brand, string_agg(CASE WHEN top = '.' THEN run ELSE '(cd ' || top || ' && ' || run || ')' END, ' ; ' ORDER BY first) AS command FROM c GROUP BY p_brand""")
def go_test_commands(read):
    t = F.lower("p_type"), F.get(F.split("p_name", " "), F.lit(0))
    name = F.concat(F.lit("x"), F.col("p_partkey").cast("string"), F.lit("_test.go"))
    path = F.when(F.col("p_size") % 5 == 0, name).when(F.col("p_size") % 2 == 0, F.concat_ws("/", t[0], name)).otherwise(F.concat_ws("/", t[0], t[1], name))
    section = F.concat(F.lit("diff --git a/"), path, F.lit(" b/"), path, F.lit("\n+x"))
    patches = read("part").groupBy("p_brand").agg(F.array_join(F.sort_array(F.collect_list(F.struct("p_partkey", section.alias("s"))))["s"], "\n").alias("patch"))
    return patches.select("p_brand", messages.go_patch_command(F.col("patch")).alias("command"))


@register("SELECT conv_id, md5(string_agg(coalesce(CASE WHEN turn % 3 > 0 THEN role END, '') || chr(10) || coalesce(CASE WHEN turn % 2 = 0 THEN text END, ''), chr(10) || chr(10) ORDER BY turn)) AS digest FROM conversations GROUP BY conv_id")
def problem_statements(read):
    issues = read("conversations").select("conv_id", "turn", F.when(F.col("turn") % 3 > 0, F.col("role")).alias("title"), F.when(F.col("turn") % 2 == 0, F.col("text")).alias("body"))
    return assembly.statement(issues, "conv_id", "turn").select("conv_id", F.md5(F.col("problem_statement").cast("binary")).alias("digest"))


@register(r"""
WITH l AS (SELECT doc_id, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i, string_split(coalesce(text, ''), chr(10)) AS x FROM documents),
s AS (SELECT doc_id, string_agg(CASE i % 3 WHEN 0 THEN '+' ELSE '-' END || regexp_replace(regexp_replace(x[i], '^[-+]+', ''), '[ \t\r\f\v]+$', ''), chr(10) ORDER BY i) FILTER (WHERE i % 3 < 2) AS t, count(*) FILTER (WHERE i % 3 < 2) AS n FROM l GROUP BY doc_id)
SELECT doc_id, CAST(n AS INT) AS n_lines, sha256(coalesce(t, '')) AS digest FROM s""")
def patch_hashes(read):
    """Documents as patches: of three lines one is removed, one kept, one added, with white space of their own at the end."""
    body = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x, i: F.concat(F.when(i % 3 == 0, "-").when(i % 3 == 1, " ").otherwise("+"), F.regexp_replace(x, r"^[-+]+", ""), F.lit(" \t")))
    patches = read("documents").select("doc_id", F.array_join(body, "\n").alias("patch"))
    return patches.select("doc_id", diff.changed_lines(F.col("patch")).alias("n_lines"), diff.patch_hash(F.col("patch")).alias("digest"))


@register("""
WITH d AS (SELECT doc_id, source, lang, text, len(string_split(coalesce(text, ''), chr(10))) AS n FROM documents), v AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id)
SELECT 'i-' || d.doc_id AS instance_id, d.source AS repo, 'v-' || CASE lang WHEN 'fr' THEN 'de' ELSE lang END || '-h-' || CASE lang WHEN 'fr' THEN 'de' ELSE lang END || '-111' AS version_label,
  '["t.py::' || d.lang || '", "t.py::x"]' AS fail_to_pass, CASE WHEN toxic = 1 THEN '[]' ELSE '["t.py::y"]' END AS pass_to_pass, CAST(2 AS INT) AS n_fail_to_pass,
  CAST(n + 2 + CASE WHEN d.doc_id % 3 = 0 THEN 2 ELSE 0 END AS INT) AS patch_lines, CAST(CASE WHEN d.doc_id % 3 = 0 THEN 2 ELSE 1 END AS INT) AS files_touched, d.doc_id % 3 = 0 AS cross_file
FROM d JOIN v USING (doc_id) WHERE quality = 1""")
def task_records(read):
    """Documents with quality as task records: the patch is the text, one in three touches two files; French has no environment and takes the first."""
    text = F.regexp_replace(F.coalesce("text", F.lit("")), "\r", " ")
    second = F.when(F.col("doc_id") % 3 == 0, "\ndiff --git a/y.py b/y.py\n+y").otherwise("")
    patch = F.concat(F.lit("diff --git a/x.py b/x.py\n--- a/x.py\n+"), F.array_join(F.split(text, "\n"), "\n+"), second, F.lit("\n"))
    null = F.lit(None).cast("string")
    candidates = read("documents").select(
        F.col("source").alias("repo"), F.concat(F.lit("i-"), F.col("doc_id").cast("string")).alias("instance_id"), "lang", "doc_id", null.alias("base_commit"), patch.alias("patch"), null.alias("test_patch"),
        null.alias("problem_statement"), null.alias("hints_text"), null.alias("created_at"), null.alias("merged_at"), F.lit(0.5).alias("link_confidence"),
    )
    marks = read("labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    tests = F.array(F.concat(F.lit("t.py::"), "lang"), F.lit("t.py::x"))
    digest = F.when(F.col("lang") != "fr", F.concat(F.lit("h-"), "lang", F.lit("-111111")))
    results = candidates.select("instance_id", "lang", "doc_id").join(marks, "doc_id").select(
        "instance_id", F.when(F.col("quality") == 1, "valid").otherwise("invalid").alias("status"), tests.alias("fail_to_pass"), F.when(F.col("toxic") == 1, F.array().cast("array<string>")).otherwise(F.array(F.lit("t.py::y"))).alias("pass_to_pass"),
        F.lit(1).alias("n_runs"), F.lit(0).alias("flake_count"), F.array().cast("array<string>").alias("quarantined_tests"), digest.alias("spec"),
    )
    specs = read("documents").where("lang <> 'fr'").select("lang").distinct().select(digest.alias("env_spec_hash"), F.lit("python").alias("language"), F.concat(F.lit("v-"), "lang").alias("language_version"))
    out = assembly.task_instances(candidates, results, specs)
    return out.select("instance_id", "repo", F.col("version").alias("version_label"), F.col("FAIL_TO_PASS").alias("fail_to_pass"), F.col("PASS_TO_PASS").alias("pass_to_pass"), "n_fail_to_pass", "patch_lines", "files_touched", "cross_file")


@register("""
WITH r AS (
  SELECT CAST(user_id AS VARCHAR) AS task_id, CASE event_type WHEN 'click' THEN 'success' WHEN 'purchase' THEN 'success' WHEN 'view' THEN 'error_max_turns' WHEN 'error' THEN 'error_max_budget_usd' ELSE 'error_during_execution' END AS status,
         event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS attempt FROM events
), t AS (
  SELECT *, coalesce(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) OVER (PARTITION BY task_id ORDER BY attempt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k,
    CASE WHEN event_type = 'error' THEN 'over budget' WHEN event_type = 'click' THEN 'done' WHEN attempt >= 3 THEN 'gave up' ELSE 'retry' END AS decision FROM r WHERE attempt <= 3
), u AS (SELECT *, coalesce(sum(CASE WHEN decision <> 'retry' THEN 1 ELSE 0 END) OVER (PARTITION BY task_id ORDER BY attempt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS over FROM t)
SELECT task_id, CAST(attempt AS INT) AS attempt, [50, 75, 113][CAST(k + 1 AS INT)] AS max_turns, status, decision,
  CASE WHEN decision = 'retry' THEN [50, 75, 113][CAST(k + 1 + CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS INT)] END AS next_turns,
  CASE WHEN decision = 'retry' THEN CASE event_type WHEN 'view' THEN 'Agent exhausted the turn limit (' || [50, 75, 113][CAST(k + 1 AS INT)] || ' turns).' WHEN 'purchase' THEN 'Agent reported success but the following required output files are missing: [''out.json'']'
    ELSE 'Agent returned status ''' || status || '''. Output: ' || event_type END END AS reason FROM u WHERE over = 0""")
def retry_steps(read):
    kinds = {"click": "success", "purchase": "success", "view": retries.OUT_OF_TURNS, "error": retries.OVER_BUDGET}
    status = F.coalesce(*[F.when(F.col("event_type") == e, s) for e, s in kinds.items()], F.lit("error_during_execution"))
    missing = F.when(F.col("event_type") == "purchase", F.array(F.lit("out.json")))
    return retries.steps(read("events").select(F.col("user_id").cast("string").alias("task_id"), F.struct("ts", "event_id").alias("at"), status.alias("status"), F.col("event_type").alias("output"), missing.alias("missing")))


@register("""
WITH p AS (SELECT p_partkey, p_size, string_split(p_name, ' ') AS w, lower(p_type) AS t FROM part),
f AS (
  SELECT p_partkey, p_size % 4 = (p_size % 5) % 4 AS python, CASE WHEN p_size % 3 = 0 THEN p_size % 6 = 0 ELSE p_size % 6 <> 5 END AS install, p_size % 2 = p_size % 3 AS runner,
    list_distinct([w[1], w[2]]) AS a, list_distinct(CASE WHEN p_size % 7 = 0 THEN [] WHEN p_size % 2 = 0 THEN [w[2], t] ELSE [w[1]] END) AS b, p_size % 3 <> 1 AS steps FROM p
), g AS (SELECT *, len(list_intersect(a, b)) AS c, len(b) AS n FROM f)
SELECT p_partkey AS version, python, install, runner, n = 0 OR c >= 0.8 * n AS packages, steps,
  CASE WHEN n = 0 THEN 'no expected packages to match' ELSE c || '/' || n || ' expected packages covered (' || CASE WHEN c = n THEN '100' WHEN c = 0 THEN '0' ELSE '50' END || '%)'
    || CASE WHEN c < n THEN '; missing: [' || list_aggregate(list_transform(list_sort(list_filter(b, lambda x: list_position(a, x) IS NULL OR list_position(a, x) = 0)), lambda x: chr(39) || x || chr(39)), 'string_agg', ', ') || ']' ELSE '' END
    || CASE WHEN c < len(a) THEN '; extra: [' || list_aggregate(list_transform(list_sort(list_filter(a, lambda x: list_position(b, x) IS NULL OR list_position(b, x) = 0)), lambda x: chr(39) || x || chr(39)), 'string_agg', ', ') || ']' ELSE '' END END AS detail,
  CAST(python AS INT) + CAST(install AS INT) + CAST(runner AS INT) + CAST(n = 0 OR c >= 0.8 * n AS INT) + CAST(steps AS INT) AS matched FROM g""")
def spec_scores(read):
    """Parts as environments: a generated and a known spec each, from the part's size and words."""
    size, word = F.col("p_size"), lambda k: F.get(F.split("p_name", " "), F.lit(k))
    runners = lambda c: F.when(c == 0, "pytest -rA").when(c == 1, "tox -e py").otherwise("python -m unittest")
    none = F.array().cast("array<string>")
    part = read("part")
    key = (F.lit("r").alias("repo"), F.col("p_partkey").alias("version"))
    generated = part.select(
        *key, F.concat(F.lit("3."), (size % 4 + 8).cast("string"), F.when(size % 3 == 0, ".1").otherwise("")).alias("language_version"), F.when(size % 3 == 0, "make").otherwise("pip  install .").alias("install_cmd"),
        runners(size % 2).alias("test_cmd"), F.array(F.concat(F.upper(word(0)), F.lit("==1.0")), F.concat(word(1), F.lit(">2"))).alias("pip_packages"), F.when(size % 3 == 1, F.array(F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit("b"), F.lit("a"))).alias("pre_install"),
    )
    known = part.select(
        *key, F.concat(F.lit("3."), ((size % 5) % 4 + 8).cast("string")).alias("python"), F.when(size % 6 == 0, "make").when(size % 6 == 5, "./setup").otherwise("python -m pip install -e .").alias("install"),
        runners(size % 3).alias("test_cmd"), F.when(size % 7 == 0, none).when(size % 2 == 0, F.array(word(1), F.lower("p_type"))).otherwise(F.array(word(0))).alias("pip_packages"), F.array(F.lit("b"), F.lit("a")).alias("pre_install"),
    )
    rows = specs.scored(generated, known)
    match = lambda k: F.get("fields", F.lit(k))["match"]
    return rows.select("version", *[match(k).alias(n) for k, n in enumerate(("python", "install", "runner", "packages", "steps"))], F.get("fields", F.lit(3))["detail"].alias("detail"), "matched")


@register("""
WITH p AS (
  SELECT source AS repo, doc_id AS n, '2024-' || lpad(CAST(doc_id % 12 + 1 AS VARCHAR), 2, '0') AS created,
    CASE doc_id % 4 WHEN 0 THEN 'Fixes #' || (doc_id % 50 + 1) || ' and closes #7' WHEN 1 THEN 'About STOR-' || doc_id WHEN 2 THEN 'rhbz#12 OCPBUGS-5' ELSE 'plain' END AS title FROM documents
)
SELECT repo, n AS pr_number, title, CASE n % 4 WHEN 0 THEN list_sort(list_distinct([n % 50 + 1, 7])) ELSE [] END AS resolved_issues, CASE n % 4 WHEN 1 THEN ['STOR-' || n] WHEN 2 THEN ['OCPBUGS-5'] ELSE [] END AS resolved_keys,
  CASE n % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.7 ELSE 0.9 END AS link_confidence, CASE n % 2 WHEN 0 THEN 'parent' ELSE 'base' END AS base_commit, 'https://github.com/' || repo || '/pull/' || n || '.diff' AS diff_url
FROM p WHERE n % 5 <> 0 AND created BETWEEN '2024-03' AND '2024-10' AND n % 4 <> 3 AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = p.n)""")
def collected_pulls(read):
    """Documents as merge requests, those with a label known already."""
    docs, n = read("documents"), F.col("doc_id")
    title = F.when(n % 4 == 0, F.concat(F.lit("Fixes #"), (n % 50 + 1).cast("string"), F.lit(" and closes #7"))).when(n % 4 == 1, F.concat(F.lit("About STOR-"), n.cast("string"))).when(n % 4 == 2, "rhbz#12 OCPBUGS-5").otherwise("plain")
    pulls = docs.select(
        F.col("source").alias("repo"), n.alias("number"), title.alias("title"), F.lit(None).cast("string").alias("body"), F.concat(F.lit("2024-"), F.lpad((n % 12 + 1).cast("string"), 2, "0")).alias("created_at"),
        F.when(n % 5 != 0, "2025").alias("merged_at"), F.lit("merge").alias("merge_commit_sha"), F.lit("base").alias("base_sha"), F.when(n % 2 == 0, "parent").alias("parent_sha"), F.lit(None).cast("string").alias("diff_url"),
    )
    known = docs.select(F.col("source").alias("repo"), n.alias("number")).join(read("labels").select(n.alias("number")).distinct(), "number", "left_semi")
    found = collected.candidates(pulls, known, "2024-03", "2024-10")
    return found.select("repo", "pr_number", "title", "resolved_issues", F.col("resolved_jira_issues").alias("resolved_keys"), "link_confidence", "base_commit", "diff_url")


@register("""
WITH e AS (SELECT event_id, event_type AS t, CAST(json_extract(props, '$.k') AS VARCHAR) AS k FROM events)
SELECT event_id, CASE t WHEN 'error' THEN 'got ' || k || ', want 3' WHEN 'view' THEN 'expected ' || k || ' to equal 4' WHEN 'click' THEN 'no ' || k END AS go,
  CASE t WHEN 'error' THEN k || ' != 2' WHEN 'view' THEN 'f(' || k || ')' WHEN 'click' THEN k || ' == 1' END AS assertion, CASE t WHEN 'purchase' THEN 'ValueError: ' || k END AS detail,
  CASE t WHEN 'error' THEN 'Changed ''<'' to ''<='' in computation, producing wrong results for certain inputs' WHEN 'view' THEN 'Removed negation from condition, skipping important validation'
    WHEN 'click' THEN 'Changed return value to None, breaking callers that expect a value' WHEN 'purchase' THEN 'Removed error handling, allowing invalid state to propagate silently' ELSE 'Subtle logic change affecting function output under certain inputs' END AS change FROM e""")
def failure_messages(read):
    """Events as outputs of failing tests in two languages, and as changes of a line."""
    k, kind = F.from_json("props", "k bigint")["k"].cast("string"), F.col("event_type")
    by = lambda **forms: F.coalesce(*[F.when(kind == e, F.concat(*[k if part is None else F.lit(part) for part in form])) for e, form in forms.items()], F.lit("ok"))
    go = by(error=("x\n  x_test.go:5: got ", None, ", want 3\nError: late"), view=("expected ", None, " to equal 4\n"), click=("a\n\tError:  \tno ", None, "\nb"))
    python = by(error=("> assert f()\nE   AssertionError: ", None, " != 2\n"), view=(">       assert f(", None, ")\n"), click=("E    assert ", None, " == 1"), purchase=("FAILED t.py::a - ValueError: ", None))
    before = by(error=("return a < ", None), view=("if not a[", None, "]:"), click=("return ", None), purchase=("raise E(", None, ")"), signup=("a",))
    after = by(error=("return a <= ", None), view=("if a[", None, "]:"), click=("return None",), purchase=("pass",), signup=("b",))
    said = messages.python_message(python)
    return read("events").select("event_id", messages.go_message(go).alias("go"), said["assertion"].alias("assertion"), said["detail"].alias("detail"), messages.described_change(before, after, assertions.SWAPS).alias("change"))
