"""Test code that stands in source files, moved out of a patch (C-05, C-06, J-22).

A patch is cut into its files in its own row, where each meets the test regions of its file's source. A
hunk's lines in the old file are one run, so it is test code where that run lies in one of the regions, those
that touch or overlap merged first. Both parts are put together again, and as each leaves hunks out, the
places that its hunk headers give in the new file are counted anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditloom.functions import code, diff
from auditloom.functions.text import blank

_HEAD = r"^@@ -(\d+)(?:,(\d+))? \+(\d+)(?:,(\d+))? @@([^\n]*)"


def merged(regions: Column) -> Column:
    """Regions (start, end) in order, those that touch or overlap as one."""
    pair = lambda a, b: F.struct(a.cast("int").alias("start"), b.cast("int").alias("end"))
    none = F.array().cast("array<struct<start:int,end:int>>")

    def add(out: Column, r: Column) -> Column:
        last = F.get(out, F.size(out) - 1)
        one = F.concat(F.slice(out, F.lit(1), F.size(out) - 1), F.array(pair(last["start"], F.greatest(last["end"], r["end"]))))
        return F.when((F.size(out) > 0) & (r["start"] <= last["end"] + 1), one).otherwise(F.concat(out, F.array(pair(r["start"], r["end"]))))

    return F.aggregate(F.array_sort(F.transform(regions, lambda r: pair(r["start"], r["end"]))), none, add)


def hunks(section: Column) -> Column:
    """(old, n_old, new, n_new, title, body) of each hunk of a file's part of a patch."""
    cut = F.filter(F.split(F.regexp_replace(section, r"\n+$", ""), r"\n(?=@@ )"), lambda h: h.rlike(_HEAD))
    number = lambda h, g: F.coalesce(F.regexp_extract(h, _HEAD, g).try_cast("int"), F.lit(1))
    return F.transform(
        cut,
        lambda h: F.struct(
            number(h, 1).alias("old"), number(h, 2).alias("n_old"), number(h, 3).alias("new"), number(h, 4).alias("n_new"), F.regexp_extract(h, _HEAD, 5).alias("title"),
            F.regexp_replace(h, r"^[^\n]*\n?", "").alias("body"),
        ),
    )


def in_tests(hunk: Column, regions: Column) -> Column:
    """Whether a hunk is test code: by the regions (merged) where the source is known, else by what its title and lines say."""
    inside = (hunk["n_old"] > 0) & F.exists(regions, lambda r: (r["start"] <= hunk["old"]) & (hunk["old"] + hunk["n_old"] - 1 <= r["end"]))
    says = hunk["title"].contains("mod tests") | F.exists(F.split(hunk["body"], "\n"), lambda x: x.rlike(r"^[ +]") & (x.contains("#[cfg(test)]") | (x.contains("mod tests") & x.contains("{"))))
    return F.when(regions.isNotNull(), inside).otherwise(says)


def part(path: Column, section: Column, marked: Column, own: bool) -> Column:
    """A file's header with those of its marked hunks (fields of hunks() and test) that are test code or not; null without one.

    A hunk's place in the new file loses what the hunks before it that went to the other part would have added.
    """
    line = lambda p: F.regexp_extract(section, rf"(?m)^{p} [^\n]*", 0)
    header = F.concat_ws("\n", F.concat(F.lit("diff --git a/"), path, F.lit(" b/"), path), line("---"), line(r"\+\+\+"))
    gone = lambda i: F.aggregate(F.filter(F.slice(marked, F.lit(1), i), lambda h: h["test"] != F.lit(own)), F.lit(0), lambda n, h: n + h["n_new"] - h["n_old"])
    told = lambda a, n: F.concat(a.cast("string"), F.lit(","), n.cast("string"))
    text = lambda h, i: F.concat(F.lit("@@ -"), told(h["old"], h["n_old"]), F.lit(" +"), told(h["new"] - gone(i), h["n_new"]), F.lit(" @@"), h["title"], F.lit("\n"), h["body"])
    kept = F.filter(F.transform(marked, lambda h, i: F.when(h["test"] == F.lit(own), text(h, i))), lambda x: x.isNotNull())
    return F.when(F.size(kept) > 0, F.concat(header, F.lit("\n"), F.array_join(kept, "\n"), F.lit("\n")))


def bound(value: Column, body) -> Column:
    """body of a value that is worked out once, however often body names it."""
    return F.transform(F.array(value), body)[0]


def parted(gold: Column, test: Column, known: Column, extension: str = ".rs") -> Column:
    """(gold, test, n_moved) of one row's patches, as refined() gives them; known: (path, regions) of the files whose source is known, regions merged."""

    def cut(section: Column, path: Column, regions: Column, found: Column) -> Column:
        names = ("old", "n_old", "new", "n_new", "title", "body")
        marked = F.transform(found, lambda h: F.struct(*[h[n].alias(n) for n in names], in_tests(h, regions).alias("test")))
        whole = F.concat(F.regexp_replace(section, r"\n+$", ""), F.lit("\n"))

        def halves(m: Column) -> Column:
            apart = path.endswith(extension) & (F.size(m) > 0)
            return F.struct(
                F.when(apart, part(path, section, m, False)).otherwise(whole).alias("gold"), F.when(apart, part(path, section, m, True)).alias("test"),
                F.when(apart, F.size(F.filter(m, lambda h: h["test"]))).otherwise(0).alias("n"),
            )

        return bound(marked, halves)

    def of(section: Column, files: Column) -> Column:
        regions = lambda path: F.get(F.filter(files, lambda k: k["path"] == path), F.lit(0))["regions"]
        return bound(diff.path_of(section), lambda path: bound(F.struct(regions(path).alias("r"), hunks(section).alias("h")), lambda x: cut(section, path, x["r"], x["h"])))

    def put(cuts: Column) -> Column:
        joined = lambda name: F.array_join(F.filter(F.transform(cuts, lambda c: c[name]), lambda x: x.isNotNull()), "")
        moved = F.aggregate(cuts, F.lit(0), lambda n, c: n + c["n"])
        extra = F.concat(F.regexp_replace(blank(test), r"([^\n])$", "$1\n"), joined("test"))
        return F.struct(F.when(F.size(cuts) == 0, gold).otherwise(F.nullif(joined("gold"), F.lit(""))).alias("gold"), F.when(moved > 0, extra).otherwise(test).alias("test"), moved.alias("n_moved"))

    both = F.struct(diff.sections(gold).alias("s"), known.alias("k"))
    return bound(bound(both, lambda x: F.transform(x["s"], lambda section: of(section, x["k"]))), put)


def refined(patches: DataFrame, sources: DataFrame | None = None, extension: str = ".rs") -> DataFrame:
    """(instance_id, gold, test, n_moved) of patches (instance_id, gold, test): hunks of test code in files of the extension go from gold to test.

    sources: (instance_id, path, source) before the change; without a file's source its hunks are judged by what they say.
    Files of other extensions and files without hunks stay as they are. A gold patch that loses all is null; a
    null or blank gold patch stays. Rows of sources that repeat a path count with all their regions.
    Each table is read once, and only regions meet the patches.
    """
    if sources is None:
        rows = patches.withColumn("_known", F.lit(None).cast("array<struct<path:string,regions:array<struct<start:int,end:int>>>>"))
    else:
        found = sources.where(F.col("path").endswith(extension) & F.col("source").isNotNull()).select("instance_id", "path", code.rust_test_regions("source").alias("r"))
        found = found.groupBy("instance_id", "path").agg(F.flatten(F.collect_list("r")).alias("r"))
        found = found.groupBy("instance_id").agg(F.collect_list(F.struct("path", merged(F.col("r")).alias("regions"))).alias("_known"))
        rows = patches.join(found, "instance_id", "left")
    return rows.select("instance_id", parted(F.col("gold"), F.col("test"), F.col("_known"), extension).alias("_x")).select("instance_id", "_x.gold", "_x.test", "_x.n_moved")
