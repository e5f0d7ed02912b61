"""Test logs to outcomes: tables of numbered lines in, one row a test out, and whether the run compiled."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PARSERS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def register(language: str, parser: Callable[[DataFrame], DataFrame]) -> None:
    PARSERS[language] = parser


def get_parser(language: str) -> Callable[[DataFrame], DataFrame] | None:
    return PARSERS.get(language)


def numbered(logs: DataFrame) -> DataFrame:
    """(run_id, line_no, line) from (run_id, log); numbers are positions in the text, so they survive any shuffle."""
    return logs.select("run_id", F.posexplode(F.split("log", "\n")).alias("line_no", "line"))


def with_compiled(logs: DataFrame, tests: DataFrame, compiled: DataFrame) -> DataFrame:
    """(run_id, tests map, compiled), a row for each log."""
    maps = tests.groupBy("run_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("test_id", "status")))).alias("tests"))
    empty = F.from_json(F.lit("{}"), "map<string,string>")
    out = logs.select("run_id").join(maps, "run_id", "left").join(compiled, "run_id", "left")
    return out.select("run_id", F.coalesce("tests", empty).alias("tests"), F.coalesce("compiled", F.lit(False)).alias("compiled"))


def terminal_status(events: DataFrame, keys: list[str], status: str, order: list[str], terminal: tuple[str, ...]) -> DataFrame:
    """The last terminal status of each key, in the events' order; two-phase, without a window."""
    return events.where(F.col(status).isin(*terminal)).groupBy(*keys).agg(F.max_by(status, F.struct(*order)).alias("status"))


def go_json(logs: DataFrame) -> DataFrame:
    """go test -json: the last pass, fail or skip of each package.test; a package that fails without a test didn't compile."""
    event = F.from_json("line", "Action string, Package string, Test string")
    rows = numbered(logs).where(F.ltrim("line").startswith("{")).select("run_id", "line_no", event.alias("e")).select("run_id", "line_no", "e.*")
    named = rows.where("Test is not null and Test <> ''").withColumn("test_id", F.concat_ws(".", "Package", "Test"))
    words = F.create_map(*[F.lit(x) for x in ("pass", "passed", "fail", "failed", "skip", "skipped")])
    tests = terminal_status(named, ["run_id", "test_id"], "Action", ["line_no"], ("pass", "fail", "skip")).select("run_id", "test_id", words[F.col("status")].alias("status"))
    packages = rows.groupBy("run_id", "Package").agg(F.bool_or(F.coalesce((F.col("Test").isNull() | (F.col("Test") == "")) & (F.col("Action") == "fail"), F.lit(False))).alias("failed"), F.count_if(F.col("Test") != "").alias("n"))
    broken = packages.groupBy("run_id").agg(F.bool_or(F.col("failed") & (F.col("n") == 0)).alias("broken"))
    compiled = logs.select("run_id", "log").join(broken, "run_id", "left").select("run_id", (~F.coalesce("broken", F.lit(False)) & F.col("log").rlike(r"\S")).alias("compiled"))
    return with_compiled(logs, tests, compiled)


def first_unless_failed(rows: DataFrame) -> DataFrame:
    """One status a test: failed if any line says so, else the first."""
    status = F.when(F.bool_or(F.col("status") == "failed"), F.lit("failed")).otherwise(F.min_by("status", "line_no"))
    return rows.groupBy("run_id", "test_id").agg(status.alias("status"))


def pytest_verbose(logs: DataFrame) -> DataFrame:
    """pytest -v: an id without spaces that holds ``::``, then its status, at the start of a line or on the next one."""
    pattern = r"(?m)^(\S*::\S+)\s+(PASSED|FAILED|ERROR|SKIPPED|XFAIL|XPASS)"
    found = F.arrays_zip(F.regexp_extract_all("log", F.lit(pattern), F.lit(1)).alias("test_id"), F.regexp_extract_all("log", F.lit(pattern), F.lit(2)).alias("word"))
    rows = logs.select("run_id", F.posexplode(found).alias("line_no", "m"))
    status = F.when(F.col("m.word").isin("PASSED", "XPASS"), "passed").when(F.col("m.word") == "SKIPPED", "skipped").otherwise("failed")
    tests = first_unless_failed(rows.select("run_id", "line_no", "m.test_id", status.alias("status")))
    broken = F.col("log").rlike("ERROR collecting|ModuleNotFoundError|ImportError|SyntaxError")
    compiled = logs.select("run_id", (F.col("log").rlike(r"\S") & (F.col("log").rlike(pattern) | ~broken)).alias("compiled"))
    return with_compiled(logs, tests, compiled)


def maven_surefire(logs: DataFrame) -> DataFrame:
    pattern = r"Tests run:\s*(\d+),\s*Failures:\s*(\d+),\s*Errors:\s*(\d+),\s*Skipped:\s*(\d+).*?--\s+in\s+([\w.$]+)"
    n = lambda g: F.regexp_extract("line", pattern, g).try_cast("int")
    status = F.when((n(2) > 0) | (n(3) > 0), "failed").when(n(4) == n(1), "skipped").otherwise("passed")
    rows = numbered(logs).where(F.col("line").rlike(pattern)).select("run_id", "line_no", F.regexp_extract("line", pattern, 5).alias("test_id"), status.alias("status"))
    tests = rows.groupBy("run_id", "test_id").agg(F.max_by("status", "line_no").alias("status"))
    return with_compiled(logs, tests, tests.groupBy("run_id").agg(F.lit(True).alias("compiled")))


def cargo(logs: DataFrame) -> DataFrame:
    """cargo test: the last status of each test; a compiler error empties the run."""
    pattern = r"^test\s+(\S+)\s+\.\.\.\s+(ok|FAILED|ignored)"
    lines = numbered(logs).withColumn("line", F.trim("line"))
    broken = lines.groupBy("run_id").agg((~F.bool_or(F.col("line").rlike(r"^error\[E\d{4}\]")) & F.bool_or(F.col("line") != "")).alias("compiled"))
    words = F.create_map(*[F.lit(x) for x in ("ok", "passed", "FAILED", "failed", "ignored", "skipped")])
    rows = lines.where(F.col("line").rlike(pattern)).select("run_id", "line_no", F.regexp_extract("line", pattern, 1).alias("test_id"), words[F.regexp_extract("line", pattern, 2)].alias("status"))
    tests = rows.groupBy("run_id", "test_id").agg(F.max_by("status", "line_no").alias("status")).join(broken.where("compiled"), "run_id", "left_semi")
    return with_compiled(logs, tests, broken)


def panicked_tests(logs: DataFrame) -> DataFrame:
    """(run_id, line_no, test_id): the test that last began before a panic line."""
    w = Window.partitionBy("run_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    begun = F.nullif(F.regexp_extract("line", r"^=== RUN\s+(\S+)", 1), F.lit(""))
    rows = numbered(logs).withColumn("test_id", F.last(begun, ignorenulls=True).over(w))
    return rows.where(F.col("line").startswith("panic:") & F.col("test_id").isNotNull()).select("run_id", "line_no", "test_id")


def section(logs: DataFrame, markers: dict[str, str]) -> DataFrame:
    """(run_id, section, line_no, line): each line with the marker it stands under."""
    w = Window.partitionBy("run_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    own = F.coalesce(*[F.when(F.col("line").contains(m), F.lit(name)) for name, m in markers.items()])
    rows = numbered(logs).withColumn("_own", own).withColumn("section", F.last("_own", ignorenulls=True).over(w))
    return rows.where("_own is null and section is not null").select("run_id", "section", "line_no", "line")


for _language, _parser in (("go", go_json), ("python", pytest_verbose), ("java", maven_surefire), ("rust", cargo)):
    register(_language, _parser)
