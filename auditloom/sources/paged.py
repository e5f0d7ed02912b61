"""Numbered pages of records in descending order of creation, as a data source with early stop (S-20, S-21).

``spark.dataSource.register(Pages)``, then ``spark.read.format("pages").schema(...)`` or ``readStream``. Records
of a page, and the pages among themselves, go from new to old; a page shorter than ``per_page`` is the last.
Bounds on ``created_at`` in a where clause are pushed down: the first and last page that can hold a record
within them are found by doubling and bisection, which opens a logarithmic number of pages, and only the
pages between are read, a range of ``pages_per_task`` of them a task. What the filters say is checked again by Spark.

As a stream, the offset is the greatest ``number`` seen; a batch reads the pages from the newest on until it
meets a number that an earlier batch had.

Pages come from ``Pages.page(options, n)``: the JSON array or lines of ``<path>/page-<n>.json`` on any file system that
pyarrow opens. A subclass with its own ``page`` reads them from a service.

Defined results: a page that is missing or empty ends the source; keys that the schema lacks are dropped, missing
ones are null; a record without created_at is within no bound. Pages must be in order; records that tie may stand in any.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

ORDER, NUMBER = "created_at", "number"


class Range(InputPartition):
    """Pages first to last; of a stream, the records with numbers above floor and not above ceiling."""

    def __init__(self, first: int, last: int, floor: int | None = None, ceiling: int | None = None):
        self.first, self.last, self.floor, self.ceiling = first, last, floor, ceiling


class Pages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return f"{NUMBER} long, {ORDER} string, merged_at string, title string, body string"

    @staticmethod
    def page(options: dict[str, str], n: int) -> list[dict]:
        found, base = fs.FileSystem.from_uri(options["path"])
        name = f"{base.rstrip('/')}/page-{n}.json"
        if found.get_file_info(name).type == fs.FileType.NotFound:
            return []
        with found.open_input_stream(name) as source:
            text = source.read().decode()
        return json.loads(text) if text.lstrip().startswith("[") else [json.loads(x) for x in text.splitlines() if x.strip()]

    def reader(self, schema: StructType) -> DataSourceReader:
        return PageReader(dict(self.options), schema, type(self).page)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return PageStream(dict(self.options), schema, type(self).page)


def first_true(met: Callable[[int], bool], start: int = 1) -> int:
    """The least n from start on for which met(n) holds; met must stay true once it is. Opens about twice the logarithm of n - start."""
    low, step = start, 1
    while not met(low + step - 1):
        low, step = low + step, 2 * step
    high = low + step - 1
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if met(middle) else (middle + 1, high)
    return low


class PageReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType, page: Callable[[dict[str, str], int], list[dict]]):
        self.options, self.names, self.fetch = options, schema.names, page
        self.per_page, self.per_task = int(options.get("per_page", 100)), int(options.get("pages_per_task", 10))
        self.after: str | None = None
        self.before: str | None = None

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if getattr(f, "attribute", None) == (ORDER,):
                if isinstance(f, GreaterThan | GreaterThanOrEqual | EqualTo):
                    self.after = max(self.after or "", f.value)
                if isinstance(f, LessThan | LessThanOrEqual | EqualTo):
                    self.before = min(self.before or f.value, f.value)
            yield f

    def partitions(self) -> list[InputPartition]:
        heads: dict[int, list[dict]] = {}

        def page(n: int) -> list[dict]:
            if n not in heads:
                heads[n] = self.fetch(self.options, n)
            return heads[n]

        newest, oldest = (lambda p: max((r.get(ORDER) or "" for r in p), default="")), (lambda p: min((r.get(ORDER) or "" for r in p), default=""))
        start = first_true(lambda n: not page(n) or self.before is None or oldest(page(n)) <= self.before)
        ended = lambda n: not page(n) or (self.after is not None and newest(page(n)) < self.after)
        stop = first_true(ended, start)
        return [Range(n, min(n + self.per_task, stop) - 1) for n in range(start, stop, self.per_task)] or [Range(1, 0)]

    def read(self, partition: Range) -> Iterator[tuple]:
        for n in range(partition.first, partition.last + 1):
            for record in self.fetch(self.options, n):
                yield tuple(record.get(name) for name in self.names)


class PageStream(DataSourceStreamReader):
    def __init__(self, options: dict[str, str], schema: StructType, page: Callable[[dict[str, str], int], list[dict]]):
        self.options, self.names, self.fetch, self.per_task = options, schema.names, page, int(options.get("pages_per_task", 10))

    def initialOffset(self) -> dict:
        return {NUMBER: 0}

    def latestOffset(self) -> dict:
        return {NUMBER: max((r[NUMBER] for r in self.fetch(self.options, 1)), default=0)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        floor, ceiling = start[NUMBER], end[NUMBER]
        if floor >= ceiling:
            return []
        stop = first_true(lambda n: max((r[NUMBER] for r in self.fetch(self.options, n)), default=0) <= floor)
        cut = [Range(n, min(n + self.per_task, stop) - 1, floor, ceiling) for n in range(1, stop, self.per_task)]
        cut[-1].last += 1  # records that came meanwhile have moved others on to the next page
        return cut

    def read(self, partition: Range) -> Iterator[tuple]:
        for n in range(partition.first, partition.last + 1):
            for record in self.fetch(self.options, n):
                if partition.floor < record[NUMBER] <= partition.ceiling:
                    yield tuple(record.get(name) for name in self.names)
