"""A Python data source for paged JSON histories, in batch and as a stream.

spark.dataSource.register(PagedHistory)
spark.read.format("paged_history").option("root", folder).load().where("base_date >= '20260101'")

A task is one source, observation date and authority. What a read fetches is planned from the first page of
each task: its announced total and page size give the number of pages. Neighbouring pages make a partition, the
more the more there are, up to a bound. A page that announces another total later, or holds another number of items than its place says, fails the
read. Comparisons of source_key, base_date and authority_code with literals prune tasks before anything is
fetched (spark.sql.python.filterPushdown.enabled). As a stream, the offset is the observation date: a batch reads
the tasks of the dates that came since.

Options: `root`, a folder <root>/<source>/<date>/<authority>/page-<n>.json in any store that pyarrow.fs.FileSystem
knows by URI, or a local path; or `fetcher`, "module:name" of a class made from the options, with tasks() giving
(source, date, authority) and fetch(source, date, authority, page) giving a page's text, which must be importable
on the executors. `most_pages` bounds the pages of a task, `pages_a_partition` those that one task of Spark reads (256), `planners` the
threads that fetch first pages (8).
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from math import ceil

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from sedimenta.sources.pages import Body, PageError, parse_page

Task = tuple[str, str, str]
COLUMNS = ("source_key", "base_date", "authority_code")
#: Filters that prune tasks, as comparisons of a task's value with the filter's.
_COMPARE: dict[type, Callable] = {
    EqualTo: lambda a, b: a == b,
    In: lambda a, b: a in b,
    GreaterThan: lambda a, b: a > b,
    GreaterThanOrEqual: lambda a, b: a >= b,
    LessThan: lambda a, b: a < b,
    LessThanOrEqual: lambda a, b: a <= b,
}


class Folder:
    """Pages as files of a folder."""

    def __init__(self, options: dict):
        from pyarrow import fs

        root = options["root"]
        self.fs, self.root = fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)
        self.root = self.root.rstrip("/")

    def tasks(self) -> list[Task]:
        from pyarrow import fs

        level = [self.root]
        for _ in range(3):
            level = [f.path for folder in level for f in self.fs.get_file_info(fs.FileSelector(folder)) if f.type == fs.FileType.Directory]
        return sorted(tuple(folder.split("/")[-3:]) for folder in level)

    def pages(self, source: str, date: str, authority: str) -> list[int]:
        """The pages that there are, for sources that don't announce their page size."""
        from pyarrow import fs

        names = [f.base_name for f in self.fs.get_file_info(fs.FileSelector(f"{self.root}/{source}/{date}/{authority}"))]
        return sorted(int(n[5:-5]) for n in names if n.startswith("page-") and n.endswith(".json"))

    def fetch(self, source: str, date: str, authority: str, page: int) -> str:
        with self.fs.open_input_stream(f"{self.root}/{source}/{date}/{authority}/page-{page}.json") as stream:
            return stream.read().decode("utf-8")


def fetcher_of(options: dict):
    if "fetcher" not in options:
        return Folder(options)
    module, _, name = options["fetcher"].partition(":")
    return getattr(importlib.import_module(module), name)(dict(options))


#: Partitions that a read has at least, if it has as many pages.
SPREAD = 64


class Page:
    """A page to be read, and what the first page of its task announced."""

    def __init__(self, task: Task, page: int, pages: int, total: int, size: int | None):
        self.task, self.page, self.pages, self.total, self.size = task, page, pages, total, size


class Pages(InputPartition):
    """Pages that one task of Spark reads."""

    def __init__(self, pages: list[Page]):
        self.pages = pages


def plan_task(fetcher, task: Task, most_pages: int | None) -> list[Page]:
    """The pages of a task, from what its first page announces; a task of no rows has one page."""
    first = parse_page(fetcher.fetch(*task, 1))
    if first.size is None and hasattr(fetcher, "pages"):  # nothing to plan from: what is there, with a steady total
        there = fetcher.pages(*task)
        return [Page(task, n, len(there), first.total, None) for n in there]
    if first.size is None:
        raise PageError(f"{'/'.join(task)}: no page size")
    if first.total and first.size < 1:
        raise PageError(f"{'/'.join(task)}: a page size of {first.size} for {first.total} rows")
    pages = max(1, ceil(first.total / max(1, first.size)))
    if most_pages is not None and pages > most_pages:
        raise PageError(f"{'/'.join(task)}: {pages} pages, more than {most_pages}")
    return [Page(task, n, pages, first.total, first.size) for n in range(1, pages + 1)]


def check_page(part: Page, body: Body) -> None:
    """Raise PageError where a page isn't what the plan of its task says."""
    name = f"{'/'.join(part.task)}, page {part.page}"
    if body.total != part.total:
        raise PageError(f"{name}: the total went from {part.total} to {body.total}")
    if body.page is not None and body.page != part.page:
        raise PageError(f"{name}: it says that it is page {body.page}")
    if part.size is None:
        return
    rows = part.size if part.page < part.pages else part.total - part.size * (part.pages - 1)
    if body.rows != rows:
        raise PageError(f"{name}: {body.rows} items instead of {rows}")


class PagedHistory(DataSource):
    """(source_key, base_date, authority_code, page, total_count, body string)"""

    @classmethod
    def name(cls) -> str:
        return "paged_history"

    def schema(self) -> str:
        return "source_key string, base_date string, authority_code string, page int, total_count long, body string"

    def reader(self, schema) -> HistoryReader:
        return HistoryReader(dict(self.options))

    def streamReader(self, schema) -> HistoryStream:
        return HistoryStream(dict(self.options))


class _Reading:
    def __init__(self, options: dict):
        self.options = options
        self.keep: list[Filter] = []

    def wanted(self, tasks: list[Task]) -> list[Task]:
        def passes(task: Task) -> bool:
            return all(_COMPARE[type(f)](task[COLUMNS.index(f.attribute[0])], f.value) for f in self.keep)

        return [t for t in tasks if passes(t)]

    def planned(self, tasks: list[Task]) -> list[Pages]:
        fetcher = fetcher_of(self.options)
        most = int(self.options["most_pages"]) if "most_pages" in self.options else None
        with ThreadPoolExecutor(int(self.options.get("planners", 8))) as pool:
            pages = [p for some in pool.map(lambda t: plan_task(fetcher, t, most), tasks) for p in some]
        size = max(1, min(int(self.options.get("pages_a_partition", 256)), ceil(len(pages) / SPREAD)))
        return [Pages(pages[lo : lo + size]) for lo in range(0, len(pages), size)]

    def read(self, part: Pages) -> Iterator[tuple]:
        fetcher = fetcher_of(self.options)
        for page in part.pages:
            text = fetcher.fetch(*page.task, page.page)
            check_page(page, parse_page(text))
            yield (*page.task, page.page, page.total, text)


class HistoryReader(_Reading, DataSourceReader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if type(f) in _COMPARE and len(f.attribute) == 1 and f.attribute[0] in COLUMNS:
                self.keep.append(f)
            else:
                yield f

    def partitions(self) -> list[Pages]:
        return self.planned(self.wanted(fetcher_of(self.options).tasks()))


class HistoryStream(_Reading, DataSourceStreamReader):
    """Tasks of observation dates after the last offset; a date must be complete when it first shows."""

    def initialOffset(self) -> dict:
        return {"base_date": ""}

    def latestOffset(self) -> dict:
        return {"base_date": max((t[1] for t in fetcher_of(self.options).tasks()), default="")}

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        return self.planned([t for t in fetcher_of(self.options).tasks() if start["base_date"] < t[1] <= end["base_date"]])
